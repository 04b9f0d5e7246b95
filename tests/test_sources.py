import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.operators import columns, routing
from weirline.plans import registry
from weirline.sources import files, sinks
from weirline.streaming import logs


def test_typed_csv_keeps_bad_rows_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,2021-7-3,"x,y"\n2,bad,z\n3,4\n')
    kinds = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("d", T.TimestampType(), metadata={"dtformat": "yyyy-MM-dd"}), T.StructField("s", T.StringType())])
    good, bad = files.scan_csv_typed(spark, str(tmp_path), kinds)
    got = [(r.k, str(r.d)[:10], r.s) for r in good.orderBy("k").collect()]
    assert got == [(1, "2021-07-03", "x,y"), (2, "None", "z")] and [r[0] for r in bad.collect()] == ["3,4"]


def test_whole_files_heads_and_names(spark, tmp_path):
    (tmp_path / "a.txt").write_text("h\n1\n2\n")
    (tmp_path / "b.txt").write_text("x")
    lines = files.scan_whole_file(spark, str(tmp_path))
    assert sorted((r.key[-5:], r.pos, r.value) for r in lines.collect()) == [("a.txt", 0, "h"), ("a.txt", 1, "1"), ("a.txt", 2, "2"), ("b.txt", 0, "x")]
    heads = {r.key[-5:]: (r.headlines, r.taillines) for r in files.file_head_tail(spark, str(tmp_path), 1, 2).collect()}
    assert heads == {"a.txt": (["h"], ["2", "1"]), "b.txt": (["x"], ["x"])}
    assert files.scan_file_names(spark, str(tmp_path), ["*/a.*"]).count() == 1


def test_lines_of_files_in_several_stretches(spark, tmp_path):
    """Files read in many small splits: numbers, sections, heads and tails are as of the whole files."""
    texts = {"a.txt": [f"line {k}" if k % 50 else f"# {k}" for k in range(1000)], "b.txt": ["# only"], "c.txt": [f"{k}" for k in range(7)]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\r\n".join(lines) + ("\n" if name != "c.txt" else ""))
    (tmp_path / "empty.txt").write_text("")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got: dict = {}
        for r in files.scan_whole_file(spark, str(tmp_path)).collect():
            got.setdefault(r.key.rsplit("/", 1)[1], {})[r.pos] = r.value
        assert got == {name: dict(enumerate(lines)) for name, lines in texts.items()}
        heads = {r.key.rsplit("/", 1)[1]: (r.headlines, r.taillines) for r in files.file_head_tail(spark, str(tmp_path), 3, 2).collect()}
        assert heads == {name: (lines[:3], lines[::-1][:2]) for name, lines in texts.items()}
        found = [(r.key[-5:], r.section, len(r.lines)) for r in files.scan_sections(spark, str(tmp_path), "^#").collect()]
        assert sorted(found) == [*(("a.txt", k + 1, 50) for k in range(20)), ("b.txt", 1, 1)]
        merged = sinks.merge_small_files(spark, str(tmp_path), f"file://{tmp_path}-merged", files=1)
        assert [r[0] for r in merged.collect()] == [x for lines in texts.values() for x in lines]
        first = sinks.merge_small_files(spark, str(tmp_path), f"file://{tmp_path}-first", limit=2)
        assert first.count() == 1001
        assert files.first_line_values(spark, str(tmp_path)).first()[0] == ["# 0"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sections_across_stretches(spark, monkeypatch):
    monkeypatch.setattr(routing, "STRETCH", 4)
    data = [(f, k, v) for f in "fg" for k, v in enumerate(["x", "T1", "a", "b", "c", "d", "e", "g", "h", "T2", "i"])]
    lines = spark.createDataFrame(data, "file string, pos int, line string")
    titles = spark.createDataFrame([("T1", "one"), ("T2", "two")], "title string, tablename string")
    out = {(r.file, r.line): r.tablename for r in routing.split_sections_by_title(lines, titles).collect()}
    assert out == {(f, v): "two" if v == "i" else "one" for f in "fg" for v in "abcdeghi"}
    found = files.sections(lines, "^T", None, "file", "pos", "line")
    assert sorted((r.file, r.section, len(r.lines)) for r in found.collect()) == [("f", 1, 8), ("f", 2, 2), ("g", 1, 8), ("g", 2, 2)]


def test_tables_loaded_together(spark, tmp_path):
    kinds = {t: T.StructType.fromDDL("k int, s string") for t in ("t_many_a", "t_many_b")}
    paths = {}
    for t in (*kinds, "t_many_c"):
        (tmp_path / t).write_text("1,x\n2,y\n")
        paths[t] = [str(tmp_path / t)]
    for t in kinds:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    assert sinks.load_tables(spark, paths, kinds, only=list(kinds)) == {"t_many_a": 2, "t_many_b": 2}
    sinks.load_tables(spark, paths, kinds, only=list(kinds), clean=["t_many_b"])
    assert (spark.table("t_many_a").count(), spark.table("t_many_b").count()) == (4, 2)
    sinks.load_tables(spark, paths, kinds, only=list(kinds), clean=[sinks.EVERY_TABLE], before="REFRESH TABLE {table}")
    assert (spark.table("t_many_a").count(), spark.table("t_many_b").count()) == (2, 2)
    with pytest.raises(KeyError):
        sinks.load_tables(spark, paths, kinds)
    for t in kinds:
        spark.sql(f"DROP TABLE {t}")


def test_archives_of_nothing(spark):
    rows = spark.createDataFrame([("a.zip", None)], "path string, content binary")
    assert files.unpacked(rows).count() == 0


def test_intervals():
    assert [logs.stream_interval(s) for s in ({}, {"stream.interval": 5}, {"stream.interval": "2 minutes"})] == ["30 seconds", "5 seconds", "2 minutes"]


def test_file_attributes(spark, tmp_path):
    (tmp_path / "x.txt").write_text("v\n")
    row = columns.file_attributes(spark.read.text(str(tmp_path)), "b1").first()
    assert (row.filename, row.batchid) == ("x.txt", "b1") and row.pathname.endswith("/x.txt")


def test_sections_with_footer(spark):
    data = [("f", k, v) for k, v in enumerate(["junk", "BEGIN 1", "a", "END", "between", "BEGIN 2", "b"])]
    out = files.sections(spark.createDataFrame(data, "key string, pos int, value string"), "^BEGIN", "^END")
    assert sorted((r.section, r.lines) for r in out.collect()) == [(1, ["BEGIN 1", "a", "END"]), (2, ["BEGIN 2", "b"])]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("m/a.txt", "A")
        z.writestr("b.bin", "B")
    (tmp_path / "c.txt").write_text("C")
    with tarfile.open(tmp_path / "y.tar.gz", "w:gz") as tar:
        tar.add(tmp_path / "c.txt", "c.txt")
    (tmp_path / "c.txt").unlink()
    out = files.unpack_archives(spark, str(tmp_path), member_glob="*.txt", prefix=True)
    assert sorted((r.archive, r.member, bytes(r.content)) for r in out.collect()) == [
        ("x.zip", "x.zip.m/a.txt", b"A"), ("y.tar.gz", "y.tar.gz.c.txt", b"C"),
    ]


def test_csv_output(spark):
    df = spark.createDataFrame([("2021-7-3 04:05:06", "tide", "high,low,ebb", None, None)], "a string, b string, c string, n int, s string")
    line = df.select(sinks.csv_escape_output(df.select("a", "b", "c")), sinks.rows_to_csv(df.select("b", "n", "s"))).first()
    assert tuple(line) == ('2021-7-3 04:05:06,tide,"high,low,ebb"', "tide,0,")


def test_load_table_counts_and_truncates(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1|x\n2|y\n")
    kinds = T.StructType.fromDDL("k int, s string")
    spark.sql("DROP TABLE IF EXISTS t_load_test")
    assert sinks.load_table(spark, "t_load_test", str(tmp_path), kinds, "|") == 2
    assert sinks.load_table(spark, "t_load_test", str(tmp_path), kinds, "|") == 2
    assert spark.table("t_load_test").count() == 4
    sinks.load_table(spark, "t_load_test", str(tmp_path), kinds, "|", truncate=True)
    assert spark.table("t_load_test").count() == 2
    spark.sql("DROP TABLE t_load_test")


def test_log_record(spark):
    ts = F.to_timestamp(F.lit("2019-08-20 21:22:23.456"))
    end = F.to_timestamp(F.lit("2019-08-21 01:02:03.004"))
    line = logs.etl_log_record(ts, end, F.lit(None), F.lit(None), F.lit("sweep"), [F.lit(40), F.lit(2)])
    assert spark.range(1).select(line).first()[0] == "2019-08-20T21:22:23.456,2019-08-21T01:02:03.004,,,sweep,40,2,,"


def test_stream_batches_are_written_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([("k", "v"), (None, "junk")], "key string, value string").write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        stream = logs.stream_log_route(logs.stream_source(spark, "parquet", "key string, value string", source), now=F.lit("t"))
        logs.stream_micro_batch_sink(stream, out, state, available_now=True).awaitTermination()
    rows = spark.read.option("basePath", out).text(f"{out}/batch=*").select("tablename", "value").collect()
    assert sorted(map(tuple, rows)) == [("etlexception", 't,,,,"junk";'), ("k", "v")]


def test_sql_statements_see_earlier_results(spark):
    out = registry.sql_query(spark, {"t0": spark.range(5)}, [("a", "select id from t0 where id > 1"), ("b", "select sum(id) as s from a")])
    assert out["b"].first()[0] == 9


def test_operators_by_name():
    registry.register_operator("same", lambda tables: tables)
    assert registry.run_operator("same", {}) == {}


KEYS = [None, "", "a:b", "a/b", "x y+z", "%41", "ü=1", "{g}*[h]?", "q'\"\\"]


def test_any_key_finds_its_folder(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(KEYS)], "tablename string, value string")
    found = sinks.save_keyed_text(df, f"{tmp_path}/out").collect()
    want = {}
    for i, k in enumerate(KEYS):
        want.setdefault(k or "", set()).add(f"v{i}")
    got = {}
    for r in found:
        got.setdefault(r.tablename, set()).update(x.value for x in spark.read.text(r.path).collect())
    assert got == want
    folders = sinks.keyed_folders(spark, f"{tmp_path}/out")
    assert {k: {r.value for r in spark.read.text(p).collect()} for k, p in folders.items()} == want


def test_a_batch_is_loaded_once(spark, tmp_path):
    from weirline.sources.commits import Ledger, publish

    kinds = T.StructType.fromDDL("a bigint, b string")
    spark.createDataFrame([("1|x",), ("2|y",)], "value string").write.text(f"{tmp_path}/one")
    spark.createDataFrame([("3|z",)], "value string").write.text(f"{tmp_path}/two")
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    spark.sql("DROP TABLE IF EXISTS t_batches")
    load = lambda path, batch, known=ledger: sinks.load_table(spark, "t_batches", f"{tmp_path}/{path}", kinds, "|", batch=batch, ledger=known)
    assert load("one", "b'1\\", None) == 2  # lost before the ledger had it
    assert load("one", "b'1\\") == 2 and load("two", "b'1\\") == 2  # known by now, so not looked at again
    assert load("two", "x/2") == 1
    assert sorted(map(tuple, spark.table("t_batches").collect())) == [(1, "x", "b'1\\"), (2, "y", "b'1\\"), (3, "z", "x/2")]
    assert sorted(map(tuple, ledger.commits().collect())) == [("t_batches", "b'1\\", 2), ("t_batches", "x/2", 1)]
    assert publish(spark, f"file://{tmp_path}/p/x", "1") and not publish(spark, f"file://{tmp_path}/p/x", "2")
    assert (tmp_path / "p" / "x").read_text() == "1" and [f.name for f in (tmp_path / "p").iterdir() if not f.name.endswith(".crc")] == ["x"]
    spark.sql("DROP TABLE t_batches")
    sinks.load_table(spark, "t_batches", f"{tmp_path}/one", kinds, "|")
    with pytest.raises(ValueError, match="partitioned"):
        load("one", "late")
    spark.sql("DROP TABLE t_batches")


def test_xml_rows_know_what_they_lie_in(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        "<?xml version='1.0'?>\n<!-- <f id='no'><r>0</r></f> -->\n<all><f\n  id = \"A\"\n kind='x>y &amp; &lt;z'>\n<r no='1'>one</r><g/><f id='B'><r\nno='2'>two<r no='9'>in</r></r></f>"
        "<r no='3'/>tail</f><r no='4'>out</r><f kind='k'><r no='5'><b>5</b> five</r></f><f/><!-- <r no='8'>x</r> --><r no='6'>--&gt; six</r><d><![CDATA[<r no='7'>]]></d></all>"
    )
    (tmp_path / "b.xml").write_text("<f id='C'>" + "".join(f"<r no='{k}'>v{k}</r>\n" for k in range(100, 400)) + "</f>")
    (tmp_path / "empty.xml").write_text("")
    kind = T.StructType.fromDDL("_no int, _VALUE string, b int")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        got = files.scan_xml_rows(spark, str(tmp_path), "r", "f", ["id", "kind"], kind).cache()
        found = {r._no: (r.id, r.kind) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    first = "x>y & <z"
    assert {k: v for k, v in found.items() if k < 100} == {1: ("A", first), 2: ("B", None), 3: ("A", first), 4: (None, None), 5: (None, "k"), 6: (None, None)}
    assert {k: v for k, v in found.items() if k >= 100} == {k: ("C", None) for k in range(100, 400)} and got.count() == 306
    values = {r._no: r._VALUE for r in got.collect()}
    assert values[1] == "one" and values[250] == "v250" and "five" in values[5]
    got.unpersist()
    inferred = files.scan_xml_rows(spark, f"{tmp_path}/b.xml", "r", "f", ["id"])
    assert inferred.filter("id = 'C' and _no = 399 and _VALUE = 'v399'").count() == 1


def test_xml_rows_of_cut_files_are_whole(spark, tmp_path):
    body = [f"<r no='{k}'><!-- <r no='0'> {'c' * (k % 50)} --><![CDATA[<a{k}>]]>x{'<r/>' if k % 7 == 0 else ''}<?p </r>?></r>" for k in range(300)]
    long = "<r no='300'>" + "y<g/>" * 2000 + "</r>"  # over many splits
    (tmp_path / "a.xml").write_text("<all>" + "".join(f"<f id='&#65;{k // 100}'>\n" * (k % 100 == 0) + x + "</f>" * (k % 100 == 99) for k, x in enumerate(body)) + f"<f id='L'><f>{long}</f>{long}</f></all>")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        rows = files.scan_xml_rows(spark, f"file://{tmp_path}/a.xml", "r", "f", ["id"], "_no int, _VALUE string, g array<string>").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert sorted((r._no, r.id) for r in rows if r._no < 300) == [(k, f"A{k // 100}") for k in range(300)]
    assert all(f"<a{r._no}>" in r._VALUE for r in rows if r._no < 300)
    assert sorted((r.id or "", len(r.g)) for r in rows if r._no == 300) == [("", 2000), ("L", 2000)]
    # an uncut file's rows go nowhere but to the parser
    (tmp_path / "b.xml").write_text("<f id='B'>" + "".join(body) + "</f>")
    whole = files.scan_xml_rows(spark, f"file://{tmp_path}/b.xml", "r", "f", ["id"], "_no int, _VALUE string")
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString() and whole.filter("id = 'B'").count() == 300


def test_width_of_rows_with_quotes(spark, tmp_path):
    (tmp_path / "q.csv").write_text('"a,b",c\n"x ""y, z"" ",\'d,e\'\n 1 , "2,3,4,5,6" \na"b,c"d\n')
    out = files.scan_csv_schemaless(spark, f"file://{tmp_path}/q.csv")
    assert out.columns == ["c0", "c1", "c2"]
    assert {"a,b", 'x "y, z"'} <= {r.c0.strip() for r in out.collect()}
    (tmp_path / "r.csv").write_text('"a|b"|"c"\n' + '"' + "x|" * 50_000 + '"|y\n')
    assert files.scan_csv_schemaless(spark, f"file://{tmp_path}/r.csv", "|").columns == ["c0", "c1"]


def test_ranges_of_a_skewed_key():
    keys = [5] * 6000 + list(range(1000)) + [10**12 + 7 * k for k in range(3000)] + [-(10**9)]
    asked = []

    def ask(a, z, width):
        asked.append(a)
        out = {}
        for k in keys:
            if a <= k < z:
                out[(k - a) // width] = out.get((k - a) // width, 0) + 1
        return out

    got = files.balanced_ranges(ask, min(keys), max(keys), len(keys), 20)
    assert all(a < z <= b for (a, z, _), (b, _, _) in zip(got, got[1:])) and sum(n for *_, n in got) == len(keys) and len(asked) < 60
    assert all(n == sum(a <= k < z for k in keys) for a, z, n in got)
    assert [n for a, z, n in got if n > 501] == [6001] and len(got) < 40


def test_jdbc_keys_that_are_null_or_missing(spark):
    url = "jdbc:derby:memory:keys;create=true"
    rows = [(k, None if k % 3 == 0 else k % 5 * 10**9) for k in range(300)]
    spark.createDataFrame(rows, "a long, k long").write.format("jdbc").options(url=url, dbtable="t_keys").mode("overwrite").save()
    got = files.jdbc_by_key(spark, url, "SELECT * FROM t_keys", '"k"', 4)
    assert sorted(map(tuple, got.collect())) == rows and got.rdd.getNumPartitions() >= 4
    none = files.jdbc_by_key(spark, url, 'SELECT * FROM t_keys WHERE "a" < 0', '"k"', 4)
    assert none.count() == 0 and none.columns == ["a", "k"]
    assert files.jdbc_by_key(spark, url, 'SELECT * FROM t_keys WHERE "k" IS NULL', '"k"', 4).count() == 100


class Pipe:
    """A stream that can't go back, so that sizes follow the data."""

    def __init__(self, path):
        self.f = open(path, "wb")

    def write(self, b):
        return self.f.write(b)

    def flush(self):
        self.f.flush()


def test_zip_members_in_splits(spark, tmp_path):
    import io
    import random

    rng, want = random.Random(1), {}

    def filled(z, archive, names):
        for k, name in enumerate(names):
            body = rng.randbytes(rng.randrange(5000)) if k % 2 else (f"line {name}\n" * rng.randrange(400)).encode()
            z.writestr(name, body)
            want[archive, name] = body

    with zipfile.ZipFile(tmp_path / "a b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        filled(z, "a b.zip", [f"d/m{k}.txt" for k in range(60)] + ["é.txt", "empty.bin"])
        z.writestr("d/", b"")
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        filled(z, "none", [f"in{k}" for k in range(10)])
    with zipfile.ZipFile(tmp_path / "nested.jar", "w", zipfile.ZIP_STORED) as z:
        z.writestr("before", b"x")
        z.writestr("in.zip", inner.getvalue())
        z.writestr("after PK", b"PK\x03\x04 is no member")
    want = {k: v for k, v in want.items() if k[0] != "none"}
    want |= {("nested.jar", "before"): b"x", ("nested.jar", "in.zip"): inner.getvalue(), ("nested.jar", "after PK"): b"PK\x03\x04 is no member"}
    pipe = Pipe(tmp_path / "piped.zip")
    with zipfile.ZipFile(pipe, "w", zipfile.ZIP_DEFLATED) as z:
        filled(z, "piped.zip", [f"p{k}" for k in range(20)])
    pipe.f.close()
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000b")
    try:
        rows = files.unpack_zip_members(spark, str(tmp_path), chunk_bytes=1000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    got = {}
    for r in sorted(rows, key=lambda r: r.part):
        assert len(r.content) <= 1000
        got[r.archive, r.member] = got.get((r.archive, r.member), b"") + bytes(r.content)
    assert got == want
    assert files.unpack_zip_members(spark, f"{tmp_path}/piped.zip", "p1*", prefix=True).select("member").distinct().count() == 11


def test_damaged_zip_members_are_errors(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("m", b"hello world")
    raw = (tmp_path / "x.zip").read_bytes().replace(b"hello", b"hellO", 1)
    (tmp_path / "x.zip").write_bytes(raw)
    with pytest.raises(Exception, match="m is damaged"):
        files.unpack_zip_members(spark, f"{tmp_path}/x.zip").count()

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.operators import aggregates, columns, merging, reshape, routing, schema, sizes
from weirline.operators.aggregates import Op
from weirline.plans import registry


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def catches(spark):
    data = [("10", "quay", "cod"), ("20", "quay", "eel"), ("30", "quay", "cod"), ("40", "pier", "eel"), ("50", "pier", "ray"), ("60", "pier", "ray")]
    return spark.createDataFrame(data, "Id string, Place string, Kind string")


def test_counts(catches):
    out = aggregates.aggregate(catches, "1-2", [Op("count")])
    assert rows(out, "Place", "Kind") == [("pier", "eel", 1), ("pier", "ray", 2), ("quay", "cod", 2), ("quay", "eel", 1)]


def test_dialects(spark):
    df = spark.createDataFrame([("a", "2"), ("a", ""), ("a", " 4 "), ("a", "x"), ("b", "-3"), ("b", None)], "k string, v string")
    ops = [Op(o, ["v"]) for o in ("sum", "avg", "max", "min")]
    assert rows(aggregates.aggregate(df, ["k"], ops), "k") == [("a", 6.0, 1.5, 4.0, 0.0), ("b", -3.0, -1.5, 0.0, -3.0)]
    assert rows(aggregates.aggregate(df, ["k"], ops, dialect="sql"), "k") == [("a", 6.0, 3.0, 4.0, 2.0), ("b", -3.0, -3.0, -3.0, -3.0)]
    assert rows(aggregates.aggregate(df, ["k"], [Op("max", ["v"])], clamp=False), "k") == [("a", 4.0), ("b", 0.0)]


def test_dialects_agree_on_clean_positive_numbers(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), (F.col("id") * 1.5 + 1).cast("string").alias("v"))
    ops = [Op(o, ["v"]) for o in ("sum", "avg", "max")]
    assert rows(aggregates.aggregate(df, ["k"], ops), "k") == rows(aggregates.aggregate(df, ["k"], ops, dialect="sql"), "k")


def test_keep_gives_every_row(catches):
    ops = [Op("keep", ["Id"]), Op("sum", ["Id"]), Op("count")]
    out = aggregates.aggregate(catches, ["Place"], ops)
    assert out.columns == ["Place", "Id", "sum_Id", "cnt"]
    assert rows(out, "Id")[0] == ("quay", "10", 60.0, 3) and out.count() == 6
    assert rows(aggregates.aggregate(catches, (), ops), "Id")[-1] == ("60", 210.0, 6)
    assert rows(aggregates.aggregate(catches, ["Place"], ops, hide=("Place",)), "Id")[0] == ("10", 60.0, 3)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_keep_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    out = aggregates.aggregate(df, ["k"], [Op("keep", ["v"]), Op("count")])
    assert rows(out, "v") == [(None, 1, 2), (None, 2, 2), ("a", 3, 1)]


def test_time_buckets(spark):
    data = [("2020-02-29 23:59:33", "2020-02-29 23:59:58"), ("2020-02-29 23:59:40", "2020-03-01 00:00:00")]
    df = spark.createDataFrame(data, "s string, e string").select(F.to_timestamp("s").alias("s"), F.to_timestamp("e").alias("e"))
    out = aggregates.time_buckets(df, "s", "e", 20).withColumn("bucket", F.date_format("bucket", "HH:mm:ss"))
    assert rows(out, "bucket") == [("00:00:00", 1), ("23:59:20", 1), ("23:59:40", 2)]


def test_empty_input_aggregates(spark):
    df = spark.createDataFrame([], "k string, v string")
    assert rows(aggregates.aggregate(df, ["k"], [Op("sum", ["v"])])) == []
    assert aggregates.aggregate(df, (), [Op("count")]).first()[0] == 0


def test_unknown_operation():
    with pytest.raises(ValueError):
        Op("median")


def test_selectors():
    names = list("abcdefgh")
    assert columns.column_ranges(names, "0-2;5;6-") == list("abcfgh")
    assert columns.column_ranges_complement(names, "0-2;5;6-") == ["d", "e"]
    with pytest.raises(ValueError):
        columns.column_ranges(names, "x")


def test_edits_see_the_original_columns(spark):
    df = spark.createDataFrame([("1", "x y", None)], "a string, b string, c string")
    out = columns.edit(
        df, columns.Update("a", "concat(a, b)"), columns.Insert("b", "a", "a0"), columns.Split("b", " ", ("b1", "b2", "b3")),
        columns.Update("c", "a"), columns.Update("a", "null"),
    )
    assert out.columns == ["a", "a0", "b1", "b2", "b3", "c"] and rows(out) == [("1x y", "1", "x", "y", None, "1")]


def test_validation_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "a int")
    assert rows(columns.row_validation(df, "a > 0"), "a") == [(None,), (1,)]


def test_select_expansion():
    groups = {"a": ["x", "y"], "ab": ["z"]}
    assert columns.select_expansion("select $ab, sum($a) from t", groups) == "select `z`, sum(`x`) AS `x`, sum(`y`) AS `y` from t"


def test_merges(spark):
    a = spark.createDataFrame([("k1", "1"), ("k2", "2"), (None, "5")], "k string, v string")
    b = spark.createDataFrame([("k2", "x"), ("k3", "y"), (None, "n")], "id string, w string")
    parts = {"z": merging.Part(a, ["k"], [Op("sum", ["v"]), Op("count")]), "b": merging.Part(b, ["id"], [Op("keep", ["w"])])}
    outer = merging.merge(parts)
    assert outer.columns == ["k", "b_w", "z_v", "z_cnt"]
    assert rows(outer, "k") == [(None, "n", 5.0, 1), ("k1", "", 1.0, 1), ("k2", "x", 2.0, 1), ("k3", "y", 0.0, 0)]
    assert rows(merging.merge(parts, "left"), "k") == [(None, "n", 5.0, 1), ("k1", "", 1.0, 1), ("k2", "x", 2.0, 1)]
    assert rows(merging.merge(parts, "inner"), "k") == [(None, "n", 5.0, 1), ("k2", "x", 2.0, 1)]
    assert rows(merging.merge(parts, dialect="sql"), "k")[-1] == ("k3", "y", None, None)


def test_prefix_lookups(spark):
    numbers = spark.createDataFrame([("12025550100",), ("13335550100",), ("447700900000",), ("999",), (None,)], "n string")
    codes = spark.createDataFrame([("1",), ("44",), ("447",)], "code string")
    areas = spark.createDataFrame([("202-555",)], "area string")
    out = merging.composite_prefix_lookup(numbers, codes, areas, "n")
    assert dict(rows(out)) == {"12025550100": "1,202-555", "13335550100": "1,", "447700900000": "44,", "999": ",", None: ","}


def test_transpose(spark):
    data = [("dawn", "wind", "3"), ("dawn", "rain", "0"), ("noon", "rain", "2"), ("noon", "fog", "1"), ("dusk", "sun", "9"), ("dawn", "rain", "1")]
    df = spark.createDataFrame(data, "n string, s string, g string").withColumn("o", F.monotonically_increasing_id())
    out = reshape.transpose(df, ["n"], "s", "g", ["wind", "rain", "fog"], "o")
    assert rows(out, "n") == [("dawn", "3", "1", ""), ("noon", "", "2", "1")]


def test_records(spark):
    df = spark.createDataFrame([(r"a=1,b=x\,y,c=p=q,a=2",), ("broken",), (None,), ("",)], "r string")
    m = reshape.record_map(F.col("r"))
    got = [r[0] for r in df.select(m).collect()]
    assert got == [{"a": "2", "b": "x,y", "c": "p=q"}, None, None, {}]


def test_records_with_escaped_backslashes(spark):
    texts = [r"a=x\\,b=2", r"a=1\,2,b\=c=\d", r"a=x\\\,y,b=", "a=end\\", "a==b", "b=1,a=2,b=3,c=4"]
    df = spark.createDataFrame([(t,) for t in texts], "r string")
    got = [r.asDict() for r in df.select(reshape.record_map(F.col("r")).alias("m"), reshape.kv_text_parse(F.col("r"), False).alias("k")).collect()]
    assert [g["m"] for g in got] == [{"a": "x\\", "b": "2"}, {"a": "1,2", "b=c": "d"}, {"a": "x\\,y", "b": ""}, {"a": "end\\"}, {"a": "=b"}, {"a": "2", "b": "3", "c": "4"}]
    assert [e.key for e in got[-1]["k"]] == ["a", "b", "c"]


def test_wide_records_take_linear_time(spark):
    """Records of 5,000 keys, each several times; the map is made once for many columns."""
    entry = F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"), F.lit("="), F.col("id").cast("string"))
    one = spark.range(15000).orderBy("id").coalesce(1).agg(F.array_join(F.collect_list(entry), ",").alias("r"))
    df = one.select(F.explode(F.array_repeat("r", 20)).alias("r"))
    out = reshape.map_to_table(df, "r", [f"k{k}" for k in range(40)])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 4
    assert set(map(tuple, out.collect())) == {tuple(str(10000 + k) for k in range(40))}


def test_kcv(spark):
    df = spark.createDataFrame([("TIME:12:00? no",), ("A: 1 B: 2 C: 3",)], "r string")
    out = reshape.kcv_to_table(df, "r", ["x", "y", "z"])
    assert rows(out)[1] == ("1", "2", "3")
    assert rows(reshape.kcv_to_table(df, "r", ["x", "y", "z"], keep_last=False))[1] == ("1", "2", None)


def test_sections_by_title(spark):
    lines = [("#A,,b", 0), ("1", 1), ("#B", 2), ("2,,3", 3), ("#A,b", 4), ("4", 5)]
    df = spark.createDataFrame([("f", p, v) for v, p in [("before", -1), *lines]], "file string, pos int, line string")
    titles = spark.createDataFrame([("#A,b", "ta"), ("#B", "tb")], "title string, tablename string")
    out = routing.split_sections_by_title(df, titles).select("line", "tablename", "pos")
    assert rows(out, "pos") == [("1", "ta", 1), ("2,3", "tb", 3), ("4", "ta", 5)]


def test_event_decode(spark):
    df = spark.createDataFrame([("a", "u7 x"), ("b", "z"), ("c", "free"), (None, "none"), ("a", "bad")], "t string, m string")
    out = reshape.event_decode(df, "t", "m", {"a": (r"^u(\d+)", ["u"]), "b": ("^(.)$", ["v"])}, ["u", "v", "rest"], ("^(.*)$", ["rest"]))
    assert [tuple(r)[1:] for r in out.collect()] == [("7", "", ""), ("", "z", ""), ("", "", "free"), ("", "", "none"), ("", "", "")]


def test_schema_evolution(spark):
    old = T.StructType.fromDDL("a bigint, b double")
    grown, new = schema.evolve_add_columns(old, T.StructType.fromDDL("B string, c string"))
    assert [f.name for f in grown] == ["a", "b", "c"] and [f.name for f in new] == ["c"]
    df = spark.createDataFrame([("1", "2.5"), ("2", "x"), ("3", "")], "a string, b string")
    retyped, changed = schema.evolve_retype(df, old)
    assert changed == ["b"] and isinstance(retyped["b"].dataType, T.StringType)


def test_names_of_nested_columns(spark):
    kind = T.StructType.fromDDL("_id STRING, buyer STRUCT<name: STRING, at: STRUCT<x: STRING>>, seller STRUCT<name: STRING>, `a b` STRING")
    assert schema.flat_names(kind) == {
        "_id": "_Attri_id", "buyer.name": "name_4_buyer", "buyer.at.x": "x", "seller.name": "name_4_seller", "a b": "a_b",
    }


def test_xml_schema_of_many_siblings_shapes_and_nothing(spark):
    many = "<o>" + "<v a='1'>2</v>" * 100_000 + "</o>"
    shapes = ["<o>" + "".join(f"<f{k}>{k}</f{k}>" for k in range(12) if n >> k & 1) + "</o>" for n in range(4096)]
    texts = [many, *shapes, None, "", "<o><broken></o>", "<o><v>2.5</v></o>", "<o/>", "plain"]
    found = schema.discover_xml_schema(spark.createDataFrame([(x,) for x in texts], "x string"), "x")
    kinds = {f.name: f.dataType.simpleString() for f in found}
    assert kinds == {f"f{k}": "bigint" for k in range(12)} | {"v": "array<struct<_VALUE:double,_a:bigint>>"}
    nothing = spark.createDataFrame([], "x string")
    assert schema.discover_xml_schema(nothing, "x") == T.StructType() == schema.discover_xml_schema(spark.createDataFrame([(None,)], "x string"), "x")


def test_xml_tables(spark):
    xml = ("<day><place code='7'><name>pier</name></place><tide><at>6</at><at>18</at><gauge id='g1'><r>1</r><r>2</r></gauge><gauge id='g2'><r>3</r></gauge></tide>"
           "<tide><at>9</at><note>calm <b>sea</b></note></tide></day>")  # fmt: skip
    df = spark.createDataFrame([(xml,), (None,), ("<day><place code='8'><name>quay</name></place></day>",)], "x string")
    found = schema.discover_xml_schema(df, "x")
    tables = reshape.xml_tables(df, "x", found, {
        "tides": reshape.XmlTable("tide", raw=("tide.note",), skip=("tide.gauge",), associate={"place": "place.name"}, keep="at > 6", set_values={"place": "upper(place)"}),
        "gauges": reshape.XmlTable("tide.gauge", associate={"code": "place._code"}),
        "places": reshape.XmlTable("place"),
    })
    tides = sorted((r.place, r.at, r.note is not None and "<b>sea</b>" in r.note) for r in tables["tides"].collect())
    assert tides == [("PIER", 9, True), ("PIER", 18, False)]
    assert sorted((r.code, r._Attri_id, r.r) for r in tables["gauges"].collect()) == [(7, "g1", 1), (7, "g1", 2), (7, "g2", 3)]
    assert sorted((r._Attri_code, r.name) for r in tables["places"].collect()) == [(7, "pier"), (8, "quay")]
    with pytest.raises(ValueError):
        reshape.xml_tables(df, "x", found, {"none": reshape.XmlTable("absent")})


def test_measurement_tables_are_named_by_rule(spark):
    df = spark.createDataFrame([(["t", "u"], [("b=2,a=1,c=3", ["5", "6"]), ("a=9", ["7"])])], "n array<string>, o array<struct<name: string, r: array<string>>>")
    out = reshape.xml_measurements(df, "n", "o", ["u", "t"], object_name="name", skip=("c",), with_value=("b",))
    assert rows(out, "t") == [("b=2,a=1,c=3", "a_b_2", "6", "5"), ("a=9", "a", "", "7")]


def test_custom_discovery_grows_the_registry(spark, tmp_path):
    known = schema.Registry(spark, f"file://{tmp_path}")

    def discover(docs):
        return {"t": schema.discover_xml_schema(docs, "x")}

    def flatten(docs, table):
        return docs.select(F.from_xml("x", schema.discover_xml_schema(docs, "x").simpleString()).alias("r")).select("r.*")

    first = spark.createDataFrame([("<d><a>1</a></d>",)], "x string")
    second = spark.createDataFrame([("<d><b>z</b></d>",)], "x string")
    assert rows(registry.schema_discovering(first, discover, flatten, known)["t"]) == [(1,)]
    assert rows(registry.schema_discovering(second, discover, flatten, known)["t"]) == [(None, "z")]
    assert schema.Registry(spark, f"file://{tmp_path}").get("t").names == ["a", "b"]


def test_tables_are_small_by_bytes(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"), "id")
    assert 10_000 < sizes.payload(df) < 20_000
    def hinted(f):
        return "broadcast" in f._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(sizes.small(df)) and not hinted(sizes.small(df, 1000)) and sizes.payload(df.limit(0)) == 0


def test_shared_parts_of_merges_are_made_once(spark):
    a = merging.Part(spark.createDataFrame([("k", "1")], "k string, v string"), ["k"], [Op("sum", ["v"])])
    b = merging.Part(spark.createDataFrame([("k", "2"), ("m", "3")], "k string, v string"), ["k"], [Op("sum", ["v"])])
    out, held = merging.merge_multi({h: {"parts": {"a": a, "b": b}, "how": h} for h in ("inner", "outer")})
    assert len(held) == 2 and rows(out["inner"]) == [("k", 1.0, 2.0)] and out["outer"].count() == 2
    for df in held:
        df.unpersist()


def test_inferred_types(spark):
    df = spark.createDataFrame([("1.5", "abc", "2024-01-01"), ("", None, "2024-01-02")], "n string, s string, startTime string")
    assert dict(rows(schema.infer_field_types(df))) == {"n": "numeric(15,5)", "s": "varchar(20)", "startTime": "timestamp"}


def test_registry(spark, tmp_path):
    r = schema.Registry(spark, f"file://{tmp_path}")
    kind = T.StructType.fromDDL("a bigint, b string")
    r.put("t1", kind)
    assert schema.Registry(spark, f"file://{tmp_path}").get("t1") == kind


@pytest.mark.parametrize("slice_buckets,step", [(1 << 16, 1 << 12), (3, 2)])
def test_time_buckets_against_counting(spark, monkeypatch, slice_buckets, step):
    monkeypatch.setattr(aggregates, "SLICE_BUCKETS", slice_buckets)
    monkeypatch.setattr(aggregates, "STEP_BUCKETS", step)
    rng = random.Random(4)
    table = [(rng.choice(["a", "b", None]), a := rng.randrange(-300, 900), a + rng.choice([-5, 0, 1, 59, 60, 61, 400])) for _ in range(150)]
    df = spark.createDataFrame([*table, ("a", None, 5), ("a", 5, None)], "k string, x long, y long")
    df = df.select("k", F.timestamp_seconds("x").alias("s"), F.timestamp_seconds(F.col("y") + 0.5).alias("e"))
    want = Counter((b, k) for k, a, z in table if a <= z for b in range(a // 20, z // 20 + 1))
    got = aggregates.time_buckets(df, "s", "e", 20, ("k",)).select(F.unix_seconds("bucket").alias("b"), "k", "cnt").collect()
    assert {(r.b // 20, r.k): r.cnt for r in got} == want and len(got) == len(want)
    assert aggregates.time_buckets(df.limit(0), "s", "e", 20).count() == 0


def test_decades_by_the_second(spark):
    day = 86400
    df = spark.range(2000).select(F.timestamp_seconds(F.col("id") * 0).alias("s"), F.timestamp_seconds(F.col("id") + 24 * 365 * day).alias("e"))
    runs = aggregates.time_bucket_runs(df, "s", "e", 1)
    r = runs.agg(F.count("*").alias("n"), F.sum((F.unix_seconds("last") - F.unix_seconds("first") + 1) * F.col("cnt")).alias("t"), F.max("cnt").alias("m")).first()
    assert (r.n, r.m, r.t) == (2000, 2000, sum(k + 24 * 365 * day + 1 for k in range(2000)))
    some = spark.range(1).select(F.timestamp_seconds(F.lit(0)).alias("s"), F.timestamp_seconds(F.lit(40 * day)).alias("e"))
    assert aggregates.time_buckets(some, "s", "e", 1).count() == 40 * day + 1


ODD = (
    "<n:doc xmlns:n='urn:x' xml:lang='en'><md-name>m1</md-name><n:b id.x='7'><v.1>1.5</v.1><v.1>2</v.1></n:b><n:b id.x='8'/><md_name>low</md_name>"
    "<a.b><c-d e:f='q'>t</c-d></a.b></n:doc>"
)


def test_paths_with_odd_names():
    for names in (("a",), ("a.b", "c-d", "e:f"), ("x`y", "z"), ("_VALUE",), ("a.b.c", "d.")):
        assert schema.steps(schema.joined(names)) == names
    assert schema.steps("tide.at") == ("tide", "at") and schema.steps("") == ()


def test_xml_tables_of_odd_names_in_one_parse(spark, tmp_path):
    df = spark.createDataFrame([(1, ODD), (2, None), (3, "<n:doc/>")], "doc long, x string")
    found = schema.discover_xml_schema(df, "x")
    tables = {
        "head": reshape.XmlTable("", skip=("n:b", "`a.b`")),
        "parts": reshape.XmlTable("n:b", associate={"lang": "`_xml:lang`", "deep": "`a.b`.c-d._e:f"}),
        "dots": reshape.XmlTable("`a.b`", set_values={"twice": "concat(`c_d`, `c_d`)"}),
    }
    whole = reshape.xml_records(df, "x", found, tables)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1 and plan.count("LogicalRDD") == 1
    for out in (reshape.xml_tables(df, "x", found, tables), reshape.xml_tables(df, "x", found, tables, f"{tmp_path}/xml")):
        assert rows(out["head"].select("doc", "md_name", "md_name_2", "_Attri_xml_lang"), "doc") == [(1, "m1", "low", "en"), (3, None, None, None)]
        assert sorted((r.lang, r.deep, r._Attri_id_x, r.v_1) for r in out["parts"].collect() if r.v_1) == [("en", "q", 7, 1.5), ("en", "q", 7, 2.0)]
        assert sorted(r._Attri_id_x for r in out["parts"].collect()) == [7, 7, 8]
        assert [(r.c_d, r._Attri_e_f, r.twice) for r in out["dots"].collect()] == [("t", "q", "tt")]


def test_xml_raw_in_one_table_and_opened_in_another(spark):
    df = spark.createDataFrame([("<d><p><q>1</q><q>2</q></p></d>",)], "x string")
    found = schema.discover_xml_schema(df, "x")
    tables = {"raw": reshape.XmlTable("p", raw=("p",)), "open": reshape.XmlTable("p")}
    whole = reshape.xml_records(df, "x", found, tables)
    assert whole._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 2 and whole.count() == 3
    out = reshape.xml_tables(df, "x", found, tables)
    assert out["raw"].first()[0].replace(" ", "").replace("\n", "").count("<q>") == 2 and rows(out["open"], "q") == [(1,), (2,)]


def test_tables_transposed_in_one_pass(spark, tmp_path):
    data = [("g1", f"t{k % 4}", f"n{k % 3}", str(k), k) for k in range(40)] + [("g2", "t1", "n1", None, 5), (None, "t2", "n0", "x", 1), ("g3", "t9", "n0", "y", 1), ("g3", "t1", "zz", "y", 1)]
    df = spark.createDataFrame(data, "g string, f string, n string, v string, o int")
    schemas = {f"T_t{k}": [f"n{j}" for j in range(3) if j != k] for k in range(3)}
    args = (df.withColumn("T", F.lit("T")), ["g"], ["T", "f"], "n", "v", schemas, "o")
    plan = reshape.transposed_cells(*args)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Scan ExistingRDD") == 1
    for folder in (None, f"{tmp_path}/cells"):
        out = reshape.transpose_split_tables(*args, folder=folder)
        for k in range(3):
            want = {}
            for g, f, n, v, o in sorted(data, key=lambda r: r[4]):
                if f == f"t{k}" and n in schemas[f"T_t{k}"]:
                    want.setdefault(g, dict.fromkeys(schemas[f"T_t{k}"], ""))[n] = v or ""
            assert sorted(rows(out[f"T_t{k}"]), key=str) == sorted(((g, *r.values()) for g, r in want.items()), key=str)


@pytest.mark.parametrize("limit", [1 << 25, 0])
def test_kept_rows_of_a_hot_group(spark, monkeypatch, limit):
    monkeypatch.setattr(aggregates, "BROADCAST_BYTES", limit)
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), F.lit("2").alias("v"))
    out = aggregates.aggregate(df, ["k"], [Op("keep", ["v"]), Op("sum", ["v"])])
    got = {(r[0], r[2]): r[3] for r in out.groupBy(*out.columns).count().collect()}
    assert got[("hot", 8000.0)] == 4000 and got[(None, 2000.0)] == 1000 and len(got) == 1002 and sum(got.values()) == 6000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("Window" not in plan) and (limit == 0 or "SortMergeJoin" not in plan)


def test_prefixes_of_any_length(spark):
    codes = spark.createDataFrame([("4",), ("49",), ("4930",), ("4930123456",), ("7",), ("",), (None,), ("49",)], "code string")
    numbers = spark.createDataFrame([("4930123456789",), ("498",), ("7",), ("8",), ("",), (None,), ("4",)], "n string")
    short = {r.n: r.cc for r in merging.prefix_lookup_join(numbers, codes, "n", longest=None).collect()}
    long = {r.n: r.cc for r in merging.prefix_lookup_join(numbers, codes, "n", longest=None, shortest_wins=False).collect()}
    assert short == {"4930123456789": "4", "498": "4", "7": "7", "8": None, "": None, None: None, "4": "4"}
    assert long == {**short, "4930123456789": "4930123456", "498": "49"}
    assert merging.prefix_lookup_join(numbers, codes.limit(0), "n").filter("cc is not null").count() == 0


def test_documents_of_one_shape_are_parsed_once(spark, monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    values = ["1", "0.5", "-.5", "", " 7 ", "abc", "it's", "5\">12", "=\"12\"", "1234567890123456789", "123456789012345678", "ü1", "٣", "a\x01b", "]]", "k=\" d=\" c", "&amp;", "<b>", "<!-- <a>5</a> -->"]

    def element(depth):
        name, quote = rng.choice("abc"), rng.choice("\"'")
        attribute = f" {rng.choice('de')}{rng.choice(['=', '= '])}{quote}{rng.choice(values)}{quote}" if rng.random() < 0.5 else ""
        body = "".join(element(depth - 1) if depth and rng.random() < 0.5 else rng.choice(values) for _ in range(rng.randrange(4)))
        return f"<{name}{attribute}>{body}</{name}>"

    for _ in range(4000):
        text, want, got = element(2), {}, {}
        schema._facts(text, want)
        for shape in schema._shapes(pa.array([text, None])):
            schema._facts(shape, got)
        assert got == want, text
    docs = pa.array([f"<o id='{k}'><n>{k / 2}</n><s>text {k}</s></o>" for k in range(1000)])
    assert len(schema._shapes(docs)) == 1


def test_groups_together(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), "id")

    def ranked(frame):
        assert list(frame.columns) == ["k", "id"]
        return frame.assign(place=frame.groupby("k", dropna=False)["id"].rank().astype("int64"), groups=frame["k"].nunique(dropna=False))

    got = registry.map_groups(df, ["k"], ranked, "k long, id long, place long, groups long", together=10_000).collect()
    assert sorted((r.id, r.place) for r in got) == [(k, k // 7 + 1) for k in range(1000)] and {r.groups for r in got} == {7}
    split = registry.map_groups(df, ["k"], ranked, "k long, id long, place long, groups long", together=300).collect()
    assert sorted((r.id, r.place) for r in split) == sorted((r.id, r.place) for r in got)

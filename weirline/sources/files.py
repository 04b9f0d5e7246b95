"""Reading text, CSV, sections, sequence files, XML, archives and databases into DataFrames."""

from __future__ import annotations

import fnmatch
import io
import json
import re
import struct
import tarfile
import zipfile
import zlib
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parsed
from ..functions.text import glob_match
from ..operators.columns import drop_trailing_delimiter
from ..operators.routing import carried
from ..operators.schema import discover_xml_schema
from ..operators.sizes import small
from ..plans.scratch import written
from . import xml_rows


def scan_keyed_text(spark: SparkSession, path) -> DataFrame:
    """(key, value): each line with the path of its file."""
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_path").alias("key"), "value")


def table_from_filename(df: DataFrame, exp: str) -> DataFrame:
    """Adds tablename, an expression over ``filename`` and ``pathname`` of a file scan's rows."""
    named = df.withColumns({"filename": F.col("_metadata.file_name"), "pathname": F.col("_metadata.file_path")})
    return named.withColumn("tablename", F.expr(exp)).drop("filename", "pathname")


def scan_csv(
    spark: SparkSession, path, names: list[str], delimiter: str = ",", quote: str = '"', trim: bool = True, header: bool = False,
    trailing_delimiter: bool = False,
) -> DataFrame:
    """Delimited text under given names, all text; short rows have nulls."""
    fields = [*names, "_trailing"] if trailing_delimiter else names
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    out = spark.read.csv(
        path, schema=schema, sep=delimiter, quote=quote, escape=quote, header=header, enforceSchema=True,
        ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim,
    )
    return out.drop("_trailing")


def scan_csv_schemaless(spark: SparkSession, path, delimiter: str = ",", width: int | None = None) -> DataFrame:
    """Delimited text as c0, c1, ...; the width is given or that of the widest row (one more pass). A delimiter in quotes doesn't count."""
    if width is None:
        # what is quoted is taken out, doubled quotes with it; possessive, as fields may be long
        bare = F.regexp_replace("value", f"""((?:^|{re.escape(delimiter)})\\s*)"(?:[^"]++|"")*+("|$)""", "$1")
        width = spark.read.text(path).agg(F.max(F.size(F.split(bare, re.escape(delimiter))))).first()[0] or 0
    return scan_csv(spark, path, [f"c{k}" for k in range(width)], delimiter)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns by a schema; a value that doesn't fit is null, as is an empty one. A field's metadata may give a
    ``dtformat`` pattern. Other columns stay."""
    def value(f) -> Column:
        text = F.nullif(F.trim(F.col(f"`{f.name}`").cast("string")), F.lit(""))
        if isinstance(f.dataType, (T.TimestampType, T.DateType)):
            pattern = f.metadata.get("dtformat")
            ts = parsed(text, pattern) if pattern else F.coalesce(
                F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss.SSS")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")),
                F.try_to_timestamp(text, F.lit("yyyy-MM-dd")),
            )
            return ts.cast(f.dataType)
        return text.try_cast(f.dataType)

    return df.withColumns({f.name: value(f) for f in schema if f.name in df.columns})


def scan_csv_typed(spark: SparkSession, path, schema: T.StructType, delimiter: str = ",") -> tuple[DataFrame, DataFrame]:
    """Typed rows, and as a side output the lines (``_corrupt``) whose number of fields isn't the schema's."""
    names = [f.name for f in schema]
    row = F.from_csv("value", ", ".join(f"`{n}` string" for n in names), {"sep": delimiter})
    # fields are counted with quoted stretches taken out
    bare = F.regexp_replace("value", '"(?:[^"]++|"")*+"', "")
    fits = F.size(F.split(bare, re.escape(delimiter))) == len(names)
    rows = spark.read.text(path).select("value", row.alias("r"), fits.alias("fits"))
    good = rows.filter("fits").select(*(F.col(f"r.`{n}`").alias(n) for n in names))
    return typed(good, schema), rows.filter("not fits").select(F.col("value").alias("_corrupt"))


def skip_header(spark: SparkSession, paths: list[str], names: list[str], has_header, delimiter: str = ",") -> DataFrame:
    """CSV files of which some begin with a header: ``has_header`` says for a path whether its file does, or is True or False."""
    says = has_header if callable(has_header) else lambda _: has_header
    groups = [(h, [p for p in paths if bool(says(p)) == h]) for h in (True, False)]
    out = None
    for h, group in groups:
        if group:
            part = scan_csv(spark, group, names, delimiter, header=h)
            out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))


def _numbered(spark: SparkSession, path, end: str = "\n") -> tuple[DataFrame, DataFrame]:
    """(key, pos, value) of all lines, and (key, n) of each file: no file has to be in one task.

    A task reads stretches of files, each in order, so a line's number is its place in its stretch and the lines
    of the stretches before it, of which there are few.
    """
    lines = spark.read.text(path, lineSep=end).select(
        F.col("_metadata.file_path").alias("key"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"), (F.regexp_replace("value", "\r$", "") if end == "\n" else F.col("value")).alias("value"),
    )
    stretches = lines.groupBy("key", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("key").orderBy("_start")
    placed = stretches.select("key", "_start", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"))
    rows = lines.join(small(placed), ["key", "_start"]).select("key", (F.col("_id") + F.col("_shift")).alias("pos"), "value")
    return rows, stretches.groupBy("key").agg(F.sum("_n").alias("n"))


def scan_whole_file(spark: SparkSession, path) -> DataFrame:
    """(key, pos, value): the lines of each file with their numbers from 0. The empty line after a last newline isn't one, and an
    empty file has none."""
    return _numbered(spark, path)[0]


def scan_sequence_file(spark: SparkSession, path: str, key: str = "org.apache.hadoop.io.LongWritable", value: str = "org.apache.hadoop.io.Text") -> DataFrame:
    """(key, value) of Hadoop sequence files. Spark SQL has no reader for them, so pairs pass through Python, in batches."""
    pairs = spark.sparkContext.sequenceFile(path, key, value, batchSize=1000)
    return spark.createDataFrame(pairs, "key long, value string" if key.endswith("LongWritable") else "key string, value string")


def scan_parquet(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_xml_elements(spark: SparkSession, path, row_tag: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A row for each element of a tag; without a schema it is inferred (one more pass)."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def scan_xml_rows(spark: SparkSession, path, row_tag: str, outer_tag: str, attributes: list[str], schema: str | T.StructType | None = None) -> DataFrame:
    """As scan_xml_elements, with attributes of the innermost ``outer_tag`` element that a row lies in.

    Files are read in splits, and a task cuts the rows out of a split as it reads it, so a tag may begin and end on any line, and a
    file may hold any number of enclosing elements, also within each other. Files of several splits are read once more before, for
    what is open where a split begins; of rows that lie in several, the parts are put together. An attribute that the element
    lacks, or any of a row outside, is null. A row within a row is part of it. Without a schema it is inferred from the rows.
    """
    meta, tags = (lambda name: F.col(f"_metadata.{name}")), (row_tag, outer_tag, attributes)
    pieces = spark.read.text(path, lineSep="<").select(meta("file_path").alias("key"), meta("file_block_start").alias("start"), "value", (meta("file_block_length") < meta("file_size")).alias("cut"))
    begins = pieces.filter("cut").drop("cut").mapInArrow(xml_rows.summaries(*tags), xml_rows.SUMMARY).groupBy("key").applyInPandas(xml_rows.states, xml_rows.STATE)
    known = {(r["key"], r["start"]): r["state"] for r in begins.filter("start > 0").collect()}  # as few as splits
    rows = pieces.drop("cut").mapInArrow(xml_rows.rows(*tags, known), xml_rows.ROW)
    if any(json.loads(state)["depth"] for state in known.values()):
        rows = written(rows, "xml_rows")
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "xml"))), lambda p: p["xml"]), "")
        around = F.max(F.when(F.col("start") == F.col("opened"), F.col("around")))
        parts = rows.filter("opened is not null").groupBy("key", "opened").agg(text.alias("xml"), around.alias("around"))
        rows = rows.filter("opened is null").select("xml", "around").unionByName(parts.select("xml", "around"))
    schema = discover_xml_schema(rows, "xml") if schema is None else schema
    values = [F.col("around")[k].alias(a) for k, a in enumerate(attributes)]
    return rows.select(F.from_xml("xml", schema).alias("_r"), *values).select("_r.*", *(f"`{a}`" for a in attributes))


def sections(lines: DataFrame, header: str, footer: str | None = None, file: str = "key", pos: str = "pos", line: str = "value") -> DataFrame:
    """(file, section, pos, lines): lines of a file cut into sections, each from a line that matches ``header`` to the one before the
    next, or to one that matches ``footer``. Lines outside go. A section is one row; a file may be any length."""
    starts = F.when(F.col(line).rlike(header), 1).otherwise(0)
    marked = carried(lines, file, pos, "section", starts, last=False).filter("section > 0")
    grouped = marked.groupBy(file, "section").agg(F.array_sort(F.collect_list(F.struct(pos, line))).alias("_l"))
    if footer:
        ends = F.filter(F.transform("_l", lambda x, i: F.when(x[line].rlike(footer), i + 1)), lambda k: k.isNotNull())
        grouped = grouped.withColumn("_l", F.slice("_l", F.lit(1), F.coalesce(F.get(ends, F.lit(0)), F.size("_l"))))
    return grouped.select(file, "section", F.col(f"_l.{pos}")[0].alias(pos), F.col(f"_l.{line}").alias("lines"))


def scan_sections(spark: SparkSession, path, header: str, footer: str | None = None) -> DataFrame:
    """The sections of text files."""
    return sections(scan_whole_file(spark, path), header, footer)


def scan_file_names(spark: SparkSession, path, globs: list[str] | None = None) -> DataFrame:
    """(path, modificationTime, length) of each file, content unread; with globs only paths that match one."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = files.select("path", "modificationTime", "length")
    return named.filter(glob_match("path", *globs)) if globs else named


def path_glob_filter(df: DataFrame, *globs: str) -> DataFrame:
    """Rows of a file scan from paths that match one of the globs."""
    return df.filter(glob_match(F.col("_metadata.file_path"), *globs))


def _members(name: str, raw: bytes, wanted: str | None):
    if zipfile.is_zipfile(io.BytesIO(raw)):
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            for m in z.infolist():
                if not m.is_dir() and (wanted is None or fnmatch.fnmatch(m.filename, wanted)):
                    yield m.filename, z.read(m)
        return
    with tarfile.open(fileobj=io.BytesIO(raw)) as t:
        for m in t:
            if m.isfile() and (wanted is None or fnmatch.fnmatch(m.name, wanted)):
                yield m.name, t.extractfile(m).read()


def unpack_archives(spark: SparkSession, path, archive_glob: str | None = None, member_glob: str | None = None, prefix: bool = False) -> DataFrame:
    """(archive, member, content) of zip, jar and tar files, compressed or not. ``prefix`` puts 'archive.' before member names. Spark
    spreads the archives; each is opened in one task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    name = F.element_at(F.split("path", "/"), -1)
    return unpacked(files.filter(glob_match(name, archive_glob)) if archive_glob else files, member_glob, prefix)


def unpacked(archives: DataFrame, member_glob: str | None = None, prefix: bool = False) -> DataFrame:
    """The members of archives held as rows (path, content); a null content has none."""
    def run(frames):
        import pandas as pd

        for f in frames:
            for p, raw in zip(f["path"], f["content"]):
                if raw is None:
                    continue
                base = p.rsplit("/", 1)[-1]
                for member, content in _members(base, bytes(raw), member_glob):
                    yield pd.DataFrame({"archive": [base], "member": [f"{base}.{member}" if prefix else member], "content": [content]})

    return archives.select("path", "content").mapInPandas(run, "archive string, member string, content binary")


#: What a member of a zip file begins with, and its header behind that.
_SIGNATURE, _HEADER = "PK\x03\x04", struct.Struct("<HHHHHIIIHH")
#: Bytes of a member's content in a row.
CHUNK_BYTES = 32 << 20


class _Member(NamedTuple):
    name: str
    method: int
    crc: int | None
    begin: int
    size: int | None


def _header(raw: bytes) -> _Member | None:
    """The header of a member behind its signature: where its data begin, and their size and checksum unless they follow the data."""
    if len(raw) < _HEADER.size:
        return None
    _, flags, method, _, _, crc, size, _, n, m = _HEADER.unpack_from(raw)
    begin = _HEADER.size + n + m
    if len(raw) < begin:
        return None
    name, extra = raw[_HEADER.size : _HEADER.size + n].decode("utf-8" if flags & 0x800 else "cp437", "replace"), raw[_HEADER.size + n : begin]
    if flags & 1:
        raise ValueError(f"{name} is encrypted")
    while len(extra) >= 4:  # sizes beyond 32 bits
        kind, length = struct.unpack_from("<HH", extra)
        if kind == 1 and size == 0xFFFFFFFF and length >= 16:
            size = struct.unpack_from("<Q", extra, 12)[0]
        extra = extra[4 + length :]
    later = bool(flags & 8)
    return _Member(name, method, None if later else crc, begin, None if later else size)


def _contents(member: _Member, raw: bytes, chunk: int):
    """The member's content in chunks; an error if it isn't whole."""
    crc, sent = 0, False
    if member.method == 0:
        if member.size is None:
            raise ValueError(f"{member.name} is stored without its size")
        data = memoryview(raw)[member.begin : member.begin + member.size]
        if len(data) < member.size:
            raise ValueError(f"{member.name} is cut off")
        pieces, want = (bytes(data[k : k + chunk]) for k in range(0, len(data), chunk)), member.crc
        for piece in pieces:
            crc, sent = zlib.crc32(piece, crc), True
            yield piece
    elif member.method == 8:
        inflate, data = zlib.decompressobj(-15), raw[member.begin :] if member.size is None else raw[member.begin : member.begin + member.size]
        while not inflate.eof:
            piece = inflate.decompress(data, chunk)
            data = inflate.unconsumed_tail
            if not piece and not inflate.eof:
                raise ValueError(f"{member.name} is cut off")
            if piece:
                crc, sent = zlib.crc32(piece, crc), True
                yield piece
        after = inflate.unused_data
        want = member.crc if member.crc is not None else struct.unpack_from("<I", after, 4 if after[:4] == b"PK\x07\x08" else 0)[0]
    else:
        raise ValueError(f"{member.name} is packed by method {member.method}")
    if crc != want:
        raise ValueError(f"{member.name} is damaged")
    if not sent:
        yield b""


def unpack_zip_members(spark: SparkSession, path, member_glob: str | None = None, prefix: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(archive, member, part, content) of the members of zip and jar files of any size, each content in parts of at most ``chunk_bytes``.

    Files are read in splits, cut where the signature of a member stands, so that the members of one archive go to many tasks; no file
    is ever one row. A signature within a member's data, as in an archive that is stored in another, is told by
    the offsets: what lies inside a member is put back into it. Checksums are verified. Tar files, which can't be cut so, are left to
    unpack_archives(). Encrypted members and methods other than storing and deflating are errors.
    """
    records = _numbered(spark, path, _SIGNATURE)[0].select("key", "pos", F.col("value").cast("binary").alias("raw"))
    sized = carried(records, "key", "pos", "end", (F.octet_length("raw") + len(_SIGNATURE)).cast("long"), last=False)
    sized = sized.withColumn("at", F.col("end") - F.octet_length("raw") - len(_SIGNATURE))

    def long_ones(batches):
        for b in batches:
            rows = []
            for key, at, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                m = _header(raw.as_buffer().to_pybytes())
                if m is not None and m.size is not None and m.begin + m.size > len(raw.as_buffer()):
                    rows.append((key, at, at + m.begin + m.size))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))], names=["file", "first", "behind"])

    members = sized.filter("pos > 0")
    inner = written(members.select("key", "at", "raw").mapInArrow(long_ones, "file string, first long, behind long"), "zip_members")
    if inner.isEmpty():
        whole = members.select("key", "at", "raw")
    else:
        # records that begin inside a longer member are its data; the outermost counts
        within = (F.col("key") == F.col("file")) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("behind"))
        owned = members.join(small(inner), within, "left").groupBy("key", "at").agg(F.min("first").alias("owner"), F.first("raw").alias("raw"))
        parts = owned.withColumn("owner", F.coalesce("owner", "at")).groupBy("key", F.col("owner").alias("at")).agg(F.array_sort(F.collect_list(F.struct(F.col("at").alias("a"), "raw"))).alias("p"))
        sign = F.lit(_SIGNATURE).cast("binary")
        joined = F.aggregate(F.slice("p", F.lit(2), F.size("p")), F.col("p")[0]["raw"], lambda whole, x: F.concat(whole, sign, x["raw"]))
        whole = parts.select("key", "at", joined.alias("raw"))

    def run(batches):
        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(2)):
                raw, base = raw.as_buffer().to_pybytes(), key.rsplit("/", 1)[-1]
                m = _header(raw)
                if m is None or m.name.endswith("/") or not (member_glob is None or fnmatch.fnmatch(m.name, member_glob)):
                    continue
                for k, piece in enumerate(_contents(m, raw, chunk_bytes)):
                    columns = [[unquote(base)], [f"{unquote(base)}.{m.name}" if prefix else m.name], [k], [piece]]
                    kinds = [pa.string(), pa.string(), pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["archive", "member", "part", "content"])

    return whole.mapInArrow(run, "archive string, member string, part int, content binary")


def file_head_tail(spark: SparkSession, path, head: int, tail: int) -> DataFrame:
    """(key, headlines, taillines): the first and the last lines of each file, the newest of the last ones first."""
    lines, sizes = _numbered(spark, path)
    wanted = lines.join(small(sizes), "key").filter((F.col("pos") < head) | (F.col("pos") >= F.col("n") - tail))
    ends = wanted.groupBy("key").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("l"))
    first = F.filter("l", lambda x: x["pos"] < head)
    last = F.reverse(F.filter("l", lambda x: x["pos"] >= F.col("n") - tail))
    return ends.select("key", F.transform(first, lambda x: x["value"]).alias("headlines"), F.transform(last, lambda x: x["value"]).alias("taillines"))


def first_line_values(spark: SparkSession, path, delimiter: str = ",") -> DataFrame:
    """(values): the fields of the first line of the first file by name that has one, one row that can be broadcast to every other.
    Files are listed, and of one file its first split is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter("length > 0")
    first = listed.select(F.min("path")).first()[0]
    if first is None:
        return spark.createDataFrame([], "values array<string>")
    lines = spark.read.text(_escaped(first)).filter(F.col("_metadata.file_block_start") == 0)
    return lines.limit(1).select(F.split("value", re.escape(delimiter)).alias("values"))


def _escaped(path: str) -> str:
    """A path in which nothing is a pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def jdbc_extract(spark: SparkSession, url: str, queries: dict[str, str], fetchsize: int = 1000, **options) -> dict[str, DataFrame]:
    """The result of each SELECT on a JDBC source, by name. ``options`` may name partitionColumn, bounds and numPartitions for
    reads in parallel; otherwise each result comes through one task. jdbc_by_key() finds the bounds itself."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize).options(**options)
    return {name: reader.option("query", q).load() for name, q in queries.items()}


#: Ranges into which one that holds too many rows is cut at a time.
CUTS = 64


def balanced_ranges(ask, low: int, high: int, rows: int, parts: int) -> list[tuple[int, int, int]]:
    """(from, to, rows) of half-open ranges of a whole-number key, in order, that hold about ``rows / parts`` each.

    ``ask`` gives the rows of each of the equal cuts of a range, (from, width) -> {cut: rows}. Only ranges with too many are cut further,
    down to single keys; a key with more than its share is a range of its own. Small neighbours are put together.
    """
    most = max(1, -(-rows // parts))
    done, todo = [], [(low, high + 1, rows)]
    while todo:
        a, z, n = todo.pop()
        if n <= most or z - a == 1:
            done.append((a, z, n))
            continue
        width = max(1, -(-(z - a) // CUTS))
        todo += [(a + k * width, min(z, a + (k + 1) * width), m) for k, m in ask(a, z, width).items() if m]
    out: list[tuple[int, int, int]] = []
    for a, z, n in sorted(done):
        if out and out[-1][2] + n <= most:
            out[-1] = (out[-1][0], z, out[-1][2] + n)
        else:
            out.append((a, z, n))
    return out


def jdbc_by_key(spark: SparkSession, url: str, query: str, key: str, parts: int, fetchsize: int = 1000, **options) -> DataFrame:
    """The result of a SELECT on a JDBC source, read in about ``parts`` tasks of like size.

    ``key`` is a column of whole numbers in the result, as the database writes it, and need not be even: how its values are spread
    is asked of the database, in counts of ranges and of ranges within those that hold too many. Each row comes once; rows
    without a key come in a task of their own, as do all rows of a key with more than a task's share.
    """
    def ask(sql: str) -> list:
        return spark.read.format("jdbc").option("url", url).options(**options).option("query", sql).load().collect()

    low, high, n, keyed = ask(f"SELECT MIN({key}) AS a, MAX({key}) AS z, COUNT(*) AS n, COUNT({key}) AS k FROM ({query}) q")[0]

    def counts(a: int, z: int, width: int) -> dict[int, int]:
        cut = f"SELECT FLOOR((CAST({key} AS BIGINT) - {a}) / {width}) AS b FROM ({query}) q WHERE {key} >= {a} AND {key} < {z}"
        return {int(b): int(m) for b, m in ask(f"SELECT b, COUNT(*) AS n FROM ({cut}) c GROUP BY b")}

    ranges = balanced_ranges(counts, int(low), int(high), int(keyed), parts) if keyed else []
    where = [f"{key} >= {a} AND {key} < {z}" for a, z, _ in ranges] + ([f"{key} IS NULL"] if n > keyed else [])
    properties = {"fetchsize": str(fetchsize), **{k: str(v) for k, v in options.items()}}
    return spark.read.jdbc(url, f"({query}) q", predicates=where or ["1 = 0"], properties=properties)


def generate_rows(spark: SparkSession, schema: T.StructType, n: int, seed: int = 0) -> DataFrame:
    """n random rows for a schema: text string0-9, numbers 0-9 or d.d, the current time."""
    def value(k, f):
        digit = F.floor(F.rand(seed + k) * 10).cast("int")
        if isinstance(f.dataType, T.StringType):
            return F.concat(F.lit("string"), digit.cast("string"))
        if isinstance(f.dataType, (T.TimestampType, T.DateType)):
            return F.current_timestamp().cast(f.dataType)
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            return (F.floor(F.rand(seed + k) * 100) / 10).cast(f.dataType)
        return digit.cast(f.dataType)

    return spark.range(n).select(*(value(k, f).alias(f.name) for k, f in enumerate(schema)))


def fields_of(line: Column, delimiter: str = ",", trailing_delimiter: bool | Column = False) -> Column:
    """The fields of delimited text without quotes, as an array."""
    return drop_trailing_delimiter(F.split(line, re.escape(delimiter)), trailing_delimiter)

"""Registered queries of the sources, sinks, reshaping, schema and stream operators.

Text and files are derived from the tables by Spark, written to a shared folder where a file is what
an operator reads, and read back whole.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates
from ..operators import columns, reshape, routing, schema
from ..sources import files, sinks
from ..streaming import logs
from . import registry
from .queries_tables import t, timed
from .scratch import database, scratch_path, written

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return put


def _order_lines(spark, d):
    """Orders as delimited text."""
    return t(spark, d, "orders").select(
        F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.col("o_custkey").cast("string")).alias("value"),
        "o_orderstatus",
    )


def _order_files(spark, d):
    path = scratch_path(spark, "orders")
    _order_lines(spark, d).select("value").write.text(path)
    return path


ORDER_NAMES = ["k", "status", "at", "cust"]


@query("SELECT o_orderstatus AS status, count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM orders GROUP BY 1")
def scan_keyed_text(spark, d):
    path = scratch_path(spark, "keyed")
    _order_lines(spark, d).write.partitionBy("o_orderstatus").text(path)
    rows = files.scan_keyed_text(spark, path)
    status = F.regexp_extract("key", "o_orderstatus=([^/]*)/", 1)
    return rows.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.split("value", ",")[0]).alias("keys"))


@query("SELECT 'status_' || o_orderstatus AS tablename, count(*) AS n FROM orders GROUP BY 1")
def table_from_filename(spark, d):
    path = scratch_path(spark, "named")
    _order_lines(spark, d).write.partitionBy("o_orderstatus").text(path)
    rows = files.table_from_filename(spark.read.text(path), "concat('status_', regexp_extract(pathname, 'o_orderstatus=([^/]*)/', 1))")
    return rows.groupBy("tablename").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS k, c_name || ', \"x\"' AS name FROM customer")
def scan_csv(spark, d):
    path = scratch_path(spark, "csv")
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(' |"'), "c_name", F.lit(', ""x"""|'))
    t(spark, d, "customer").select(line).write.text(path)
    return files.scan_csv(spark, path, ["k", "name"], "|", trailing_delimiter=True)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS c0, o_orderstatus AS c1, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS c2, CAST(o_custkey AS VARCHAR) AS c3 FROM orders")
def scan_csv_schemaless(spark, d):
    return files.scan_csv_schemaless(spark, _order_files(spark, d))


@query("""SELECT o_orderkey AS k, o_orderstatus AS status, strftime(o_orderdate, '%d/%m/%Y') AS day,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS cust FROM orders WHERE o_orderkey % 11 <> 0""")
def scan_csv_typed(spark, d):
    path = scratch_path(spark, "typed")
    key = F.col("o_orderkey")
    cust = F.when(key % 5 == 0, "none").otherwise(F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", key.cast("string"), "o_orderstatus", F.date_format("o_orderdate", "dd/MM/yyyy"), cust)
    t(spark, d, "orders").select(F.when(key % 11 == 0, F.concat(line, F.lit(",more"))).otherwise(line)).write.text(path)
    kinds = T.StructType([
        T.StructField("k", T.LongType()), T.StructField("status", T.StringType()),
        T.StructField("day", T.TimestampType(), metadata={"dtformat": "dd/MM/yyyy"}), T.StructField("cust", T.IntegerType()),
    ])
    good, _ = files.scan_csv_typed(spark, path, kinds)
    return good.withColumn("day", F.date_format("day", "dd/MM/yyyy"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS name FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier")
def skip_header(spark, d):
    with_, without = scratch_path(spark, "headed"), scratch_path(spark, "plain")
    t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).write.csv(with_, header=True)
    t(spark, d, "supplier").select("s_suppkey", "s_name").write.csv(without)
    return files.skip_header(spark, [with_, without], ["k", "name"], lambda p: "headed" in p)


@query("SELECT DISTINCT conv_id, turn AS pos FROM conversations")
def scan_whole_file(spark, d):
    path = scratch_path(spark, "whole")
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: F.concat_ws(" ", x["turn"].cast("string"), x["role"])
    )
    by = t(spark, d, "conversations").dropDuplicates(["conv_id", "turn"]).groupBy("conv_id").agg(F.array_join(lines, "\n").alias("value"))
    bucket = by.groupBy(F.floor(F.col("conv_id") / 200).alias("b")).agg(
        F.array_join(F.collect_list(F.concat(F.lit("#"), F.col("conv_id").cast("string"), F.lit("\n"), "value")), "\n").alias("value")
    )
    bucket.repartition(16, "b").select("value", "b").write.partitionBy("b").text(path)
    rows = files.sections(files.scan_whole_file(spark, path), "^#")
    return rows.select(
        F.substring(F.col("lines")[0], 2, 20).cast("long").alias("conv_id"), F.explode(F.slice("lines", 2, F.size("lines"))).alias("l")
    ).select("conv_id", F.split("l", " ")[0].cast("long").alias("pos"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderpriority AS value FROM orders")
def scan_sequence_file(spark, d):
    path = scratch_path(spark, "sequence")
    pairs = t(spark, d, "orders").select(F.col("o_custkey").cast("string"), "o_orderpriority").rdd.map(tuple)
    pairs.saveAsNewAPIHadoopFile(
        path, "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat",
        "org.apache.hadoop.io.Text", "org.apache.hadoop.io.Text",
    )
    return files.scan_sequence_file(spark, path, "org.apache.hadoop.io.Text")


def _item(prefix="l"):
    parts = [F.lit('<item no="'), F.col("l_linenumber").cast("string"), F.lit('"><part>'), F.col("l_partkey").cast("string"), F.lit("</part><flag>"), "l_returnflag", F.lit("</flag></item>")]
    return F.concat(*parts)


ITEM = "_no INT, part BIGINT, flag STRING"


def _xml_orders(spark, d):
    """One XML document for each order, its line items inside."""
    items = F.array_join(F.array_sort(F.collect_list(_item())), "")
    head = F.concat(F.lit('<order id="'), F.col("l_orderkey").cast("string"), F.lit('">'))
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(items.alias("items")).select("l_orderkey", F.concat(head, "items", F.lit("</order>")).alias("xml"))


def _xml_batches(spark, d):
    """The orders' documents in files of a bounded number each, with one root."""
    path = scratch_path(spark, "batches")
    rows = _xml_orders(spark, d).withColumn("b", F.floor(F.col("l_orderkey") / 4000))
    body = rows.groupBy("b").agg(F.array_join(F.collect_list("xml"), "\n").alias("body"))
    whole = F.concat(F.lit('<batch name="b'), F.col("b").cast("string"), F.lit('">\n'), "body", F.lit("\n</batch>"))
    body.select("b", whole.alias("value")).write.partitionBy("b").text(path)
    return path


@query("SELECT l_linenumber AS no, l_partkey AS part, l_returnflag AS flag FROM lineitem")
def scan_xml_elements(spark, d):
    found = files.scan_xml_elements(spark, _xml_batches(spark, d), "item", ITEM)
    return found.select(F.col("_no").alias("no"), "part", "flag")


@query("SELECT l_linenumber AS no, l_partkey AS part, l_returnflag AS flag, 'b' || l_orderkey // 4000 AS batch FROM lineitem")
def scan_xml_rows(spark, d):
    found = files.scan_xml_rows(spark, _xml_batches(spark, d), "item", "batch", ["name"], ITEM)
    return found.select(F.col("_no").alias("no"), "part", "flag", F.col("name").alias("batch"))


SECTIONS = """x AS (SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS s
  FROM conversations)"""


@query(f"WITH {SECTIONS} SELECT conv_id AS key, CAST(s AS BIGINT) AS section, min(turn) AS pos, count(*) AS n FROM x WHERE s > 0 GROUP BY 1, 2")
def scan_sections(spark, d):
    lines = t(spark, d, "conversations").select(
        F.col("conv_id").alias("key"), F.col("turn").alias("pos"), F.concat_ws(": ", "role", "text").alias("value")
    )
    return files.sections(lines, "^user: ").select("key", "section", "pos", F.size("lines").cast("long").alias("n"))


@query("SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder FROM orders")
def scan_file_names(spark, d):
    path = scratch_path(spark, "listed")
    _order_lines(spark, d).write.partitionBy("o_orderstatus").text(path)
    found = files.scan_file_names(spark, path, ["*/o_orderstatus=*/part-*"])
    return found.filter("length > 0").select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct()


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'P')")
def path_glob_filter(spark, d):
    path = scratch_path(spark, "globbed")
    _order_lines(spark, d).write.partitionBy("o_orderstatus").text(path)
    return files.path_glob_filter(spark.read.text(path), "*/o_orderstatus={O,P}/*").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'n' || c_nationkey || '.txt' AS member, count(*) AS n FROM customer GROUP BY 1")
def unpack_archives(spark, d):
    """A zip for each nation's customers, made by Spark tasks and kept in a table; opened again by the reader's own code."""
    def zipped(frame):
        import io
        import zipfile

        import pandas as pd

        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            z.writestr(f"n{frame['c_nationkey'].iloc[0]}.txt", "\n".join(frame["c_name"]))
            z.writestr("skip.bin", "x")
        return pd.DataFrame({"path": [f"/a/n{frame['c_nationkey'].iloc[0]}.zip"], "content": [raw.getvalue()]})

    archives = t(spark, d, "customer").select("c_nationkey", "c_name").groupBy("c_nationkey").applyInPandas(zipped, "path string, content binary")
    members = files.unpacked(archives, member_glob="*.txt")
    return members.select("member", F.size(F.split(F.col("content").cast("string"), "\n")).cast("long").alias("n"))


@query("""SELECT 'm' || o_orderkey % 40 || '.csv' AS member, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""")
def unpack_zip_members(spark, d):
    """Orders in zip files, each with many members, read member by member from the files."""
    path = scratch_path(spark, "zips")

    def archive(frame):
        import io
        import zipfile

        import pandas as pd

        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
            for m, rows in frame.groupby("m"):
                z.writestr(f"m{m}.csv", "\n".join(rows["line"]))
        return pd.DataFrame({"a": [int(frame["a"].iloc[0])], "raw": [raw.getvalue()]})

    lines = t(spark, d, "orders").select((F.col("o_orderkey") % 40).alias("m"), F.floor(F.col("o_orderkey") / 40_000).alias("a"), F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("line"))
    files_of = lines.groupBy("a").applyInPandas(archive, "a long, raw binary")  # archives grow in number, not in size
    files_of.select("a", F.col("raw").cast("string").alias("value")).write.partitionBy("a").text(path)  # a file is its bytes and a line end
    members = files.unpack_zip_members(spark, path, "*.csv")
    each = members.select("member", F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line"))
    return each.groupBy("member").agg(F.count("*").alias("n"), F.sum(F.split("line", ",")[0].cast("long")).alias("keys"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey > 0")
def jdbc_extract(spark, d):
    url = database(t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), "customer_copy")
    select = 'SELECT "c_custkey", "c_name" FROM "customer_copy" WHERE "c_nationkey" > 0'
    return files.jdbc_extract(spark, url, {"customers": select})["customers"]


@query("""SELECT o_orderkey AS k, o_custkey AS cust, CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN o_orderkey % 7
  ELSE CAST(o_orderkey AS BIGINT) * 100003 END AS id, true AS balanced FROM orders""")
def jdbc_by_key(spark, d):
    """Orders read from a database by a key of which half the rows have one of seven values, some none, and the others lie far apart."""
    k = F.col("o_orderkey")
    key = F.when(k % 50 == 0, None).when(k % 2 == 0, (k % 7).cast("long")).otherwise(k.cast("long") * 100003)
    url = database(t(spark, d, "orders").select(k.alias("k"), F.col("o_custkey").alias("cust"), key.alias("id")), "orders_copy")
    read = files.jdbc_by_key(spark, url, 'SELECT * FROM "orders_copy"', '"id"', 16)
    rows = written(read.withColumn("p", F.spark_partition_id()), "by_key")  # the database is read once
    per = rows.groupBy("p").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))
    share = rows.count() / 16
    balanced = per.filter((F.col("n") > 1.2 * share) & (F.col("ids") > 1)).isEmpty() and per.count() >= 10
    return rows.drop("p").withColumn("balanced", F.lit(balanced))


@query("""SELECT o_orderstatus AS status, 'part-' AS filename, 'o_orderstatus=' || o_orderstatus AS folder, 'b7' AS batchid, count(*) AS n
  FROM orders GROUP BY o_orderstatus""")
def file_attr_columns(spark, d):
    """Names and paths of the files that rows came from, and the batch's id."""
    path = scratch_path(spark, "attributes")
    _order_lines(spark, d).write.partitionBy("o_orderstatus").text(path)
    rows = columns.file_attributes(spark.read.text(path), "b7")
    named = rows.select(
        F.split("value", ",")[1].alias("status"), F.substring("filename", 1, 5).alias("filename"), "batchid",
        F.regexp_extract("pathname", "(o_orderstatus=[^/]*)/", 1).alias("folder"),
    )
    return named.groupBy("status", "filename", "folder", "batchid").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM orders")
def merge_small_files(spark, d):
    path, out = _order_files(spark, d), scratch_path(spark, "merged")
    rows = sinks.merge_small_files(spark, path, out)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.split("value", ",")[0]).alias("keys"))


@query("SELECT o_orderstatus AS status, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1")
def file_head_tail(spark, d):
    path = scratch_path(spark, "heads")
    rows = t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("value"), "o_orderstatus", "o_orderkey")
    rows.repartition(4, "o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey").drop("o_orderkey").write.partitionBy("o_orderstatus").text(path)
    found = files.file_head_tail(spark, path, 2, 2)
    return found.select(
        F.regexp_extract("key", "o_orderstatus=([^/]*)/", 1).alias("status"),
        F.col("headlines")[0].cast("long").alias("first"), F.col("taillines")[0].cast("long").alias("last"),
    )


@query("SELECT c_custkey, 'customer' AS kind FROM customer")
def fn_first_line_values(spark, d):
    path = scratch_path(spark, "first")
    t(spark, d, "supplier").agg(F.concat(F.lit("customer,"), F.count(F.lit(1)).cast("string")).alias("value")).write.text(path)
    values = files.first_line_values(spark, path).select(F.col("values")[0])
    return columns.with_globals(t(spark, d, "customer").select("c_custkey"), {"kind": values})


@query("SELECT count(*) AS n, true AS fits FROM customer")
def generate_rows(spark, d):
    """As many rows as the customers, for their schema."""
    customer = t(spark, d, "customer")
    rows = files.generate_rows(spark, customer.schema, customer.count(), seed=3)
    fits = F.bool_and(F.col("c_name").rlike("^string[0-9]$") & F.col("c_custkey").between(0, 9))
    return rows.agg(F.count(F.lit(1)).alias("n"), fits.alias("fits"))


@query("SELECT l_orderkey, l_tax FROM lineitem WHERE l_tax > 0.05")
def scan_parquet(spark, d):
    return files.scan_parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_tax"]).filter("l_tax > 0.05")


@query("SELECT page_id, md5(html) AS digest, url FROM pages")
def scan_pages(spark, d):
    """Web pages as rows of their own: a scan of the long column, for its digest."""
    return files.scan_parquet(spark, f"{d}/pages.parquet").select("page_id", F.md5("html").alias("digest"), "url")


# sinks


@query("SELECT 'customer' AS tablename, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier")
def save_by_table(spark, d):
    paths = sinks.save_by_table({n: t(spark, d, n) for n in ("customer", "supplier")}, scratch_path(spark, "tables"))
    return routing.union_inputs(*(spark.read.parquet(p).agg(F.lit(n).alias("tablename"), F.count(F.lit(1)).alias("n")) for n, p in paths.items()))


@query("SELECT o_orderstatus || '-' || replace(o_orderpriority, '-', '_') AS tablename, count(*) AS n FROM orders GROUP BY 1")
def save_keyed_text(spark, d):
    routed = routing.split_by_keys(t(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])
    path = scratch_path(spark, "routes")
    listed = sinks.save_keyed_text(routed.withColumn("value", F.col("o_orderkey").cast("string")), path)
    lines = files.scan_keyed_text(spark, path)
    key = F.url_decode(F.regexp_extract("key", "tablename=([^/]*)/", 1))
    counted = lines.groupBy(key.alias("tablename")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(listed.select("tablename").distinct(), "tablename", "left_semi")


@query("SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at, CAST(o_custkey AS DOUBLE) AS cust FROM orders")
def save_parquet_typed(spark, d):
    kinds = T.StructType([T.StructField("k", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("cust", T.DecimalType(15, 5))])
    rows = files.scan_csv(spark, _order_files(spark, d), ORDER_NAMES)
    path = scratch_path(spark, "parquet")
    sinks.save_parquet_typed(rows, kinds, path)
    return spark.read.parquet(path).withColumns({"at": F.date_format("at", "yyyy-MM-dd HH:mm:ss"), "cust": F.col("cust").cast("double")})


@query("SELECT c_name, NULL AS s_name FROM customer UNION ALL SELECT NULL, s_name FROM supplier")
def output_single_or_multiple(spark, d):
    tables = {"customer": t(spark, d, "customer").select("c_name"), "supplier": t(spark, d, "supplier").select("s_name")}
    return sinks.output_single_or_multiple(tables, True)[""]


@query("""SELECT s_suppkey || ',' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END || ',' ||
  CASE WHEN s_suppkey % 4 = 0 THEN '0' ELSE CAST(s_nationkey AS VARCHAR) END AS line FROM supplier""")
def rows_to_csv(spark, d):
    df = t(spark, d, "supplier").select(
        "s_suppkey", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).alias("name"),
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_nationkey")).alias("nation"),
    )
    return df.select(sinks.rows_to_csv(df).alias("line"))


@query('''SELECT c_custkey || ',"' || c_name || ',""' || c_nationkey || '"""' AS line FROM customer''')
def csv_escape_output(spark, d):
    risky = F.concat("c_name", F.lit(',"'), F.col("c_nationkey").cast("string"), F.lit('"'))
    df = t(spark, d, "customer").select("c_custkey", risky.alias("x"))
    return df.select(sinks.csv_escape_output(df).alias("line"))


@query("SELECT o_orderkey AS k, o_custkey AS cust, (SELECT count(*) FROM orders) AS loaded FROM orders")
def load_table(spark, d):
    kinds = T.StructType([T.StructField(n, T.LongType() if n in ("k", "cust") else T.StringType()) for n in ORDER_NAMES])
    name = "loaded_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    n = sinks.load_table(spark, name, _order_files(spark, d), kinds, truncate=True)
    rows = spark.table(name).select("k", "cust", F.lit(n).cast("long").alias("loaded"))
    path = scratch_path(spark, "loaded")
    rows.write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("""SELECT 'O' AS tablename, 2 * count(*) AS n, min(o_orderkey) AS first FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 'F', count(*), min(o_orderkey) FROM orders WHERE o_orderstatus = 'F'""")
def load_tables(spark, d):
    """Files matched to their tables and loaded twice: one table is emptied before the second time, a third isn't asked for."""
    path, tag = scratch_path(spark, "loads"), scratch_path(spark, "x").rsplit("-", 1)[1]
    _order_lines(spark, d).write.partitionBy("o_orderstatus").text(path)
    found = sinks.file_to_table_match(files.scan_file_names(spark, path), f"'t{tag}_' || regexp_extract(path, 'o_orderstatus=([^/]*)/', 1)", None)
    by_table = {r.tablename: r.paths for r in found.filter(f"tablename <> 't{tag}_'").collect()}  # one row for each status
    kinds = T.StructType([T.StructField(n, T.LongType() if n in ("k", "cust") else T.StringType()) for n in ORDER_NAMES])
    schemas, only = dict.fromkeys(by_table, kinds), [f"t{tag}_O", f"t{tag}_F"]
    sinks.load_tables(spark, by_table, schemas, only, [sinks.EVERY_TABLE])
    sinks.load_tables(spark, by_table, schemas, only, [f"t{tag}_F"], before="DROP TABLE IF EXISTS {table}_old")
    out = scratch_path(spark, "loaded")
    counts = [spark.table(n).agg(F.lit(n[-1]).alias("tablename"), F.count(F.lit(1)).alias("n"), F.min("k").alias("first")) for n in only]
    routing.union_inputs(*counts).write.parquet(out)
    for n in only:
        spark.sql(f"DROP TABLE {n}")
    return spark.read.parquet(out)


@query("SELECT DISTINCT o_orderstatus AS tablename, true AS some FROM orders WHERE o_orderstatus <> 'P'")
def file_to_table_match(spark, d):
    path = scratch_path(spark, "matched")
    _order_lines(spark, d).write.partitionBy("o_orderstatus").text(path)
    found = sinks.file_to_table_match(files.scan_file_names(spark, path), "nullif(regexp_extract(path, 'o_orderstatus=([^/]*)/', 1), '')", ["O", "F"])
    return found.select("tablename", (F.size("paths") > 0).alias("some"))


@query("SELECT event_type AS key, event_id || ',' || CASE WHEN event_id % 2 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS value FROM events")
def emit_messages(spark, d):
    return sinks.emit_messages(t(spark, d, "events"), "event_type", ["event_id", "case when event_id % 2 = 1 then user_id end"])


@query("SELECT event_type AS key, event_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE user_id END AS user_id FROM events")
def decode_messages(spark, d):
    kinds = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
    return sinks.decode_messages(emit_messages(spark, d), kinds)


@query("SELECT path FROM (SELECT 'f' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS path FROM orders) ORDER BY path LIMIT 25")
def limit_files(spark, d):
    listed = t(spark, d, "orders").select(F.concat(F.lit("f"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("path"))
    return routing.limited(listed, 25, "path")


# reshaping

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CELLS = ", ".join(f"""coalesce(CAST(max_by(o_orderkey, o_orderdate) FILTER (o_orderpriority = '{p}') AS VARCHAR), '') AS "{p}" """ for p in PRIORITIES)
LAST = """(SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
  ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1)"""


@query(f"SELECT o_custkey, {CELLS} FROM {LAST} GROUP BY o_custkey")
def transpose(spark, d):
    rows = t(spark, d, "orders").withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return reshape.transpose(rows, ["o_custkey"], "o_orderpriority", "o_orderkey", PRIORITIES, "at")


@query("""SELECT 'T_' || l_returnflag AS tablename, l_orderkey, coalesce(max(CASE WHEN l_linenumber = 1 THEN l_partkey END), 0) AS R1,
  coalesce(max(CASE WHEN l_linenumber = 2 THEN l_partkey END), 0) AS R2 FROM lineitem
  WHERE l_returnflag IN ('A', 'R') AND l_linenumber IN (1, 2) GROUP BY 1, 2""")
def transpose_split_tables(spark, d):
    schemas = {"T_A": ["R1", "R2"], "T_R": ["R1", "R2"]}
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey", F.lit("T").alias("g"))
    rows = rows.withColumn("reg", F.col("l_linenumber").cast("string"))
    out = reshape.transpose_split_tables(rows, ["l_orderkey"], ["g", "l_returnflag"], "reg", "l_partkey", schemas, "l_partkey", name_exp="concat('R', reg)", folder=scratch_path(spark, "cells"))
    number = lambda c: F.coalesce(F.nullif(c, F.lit("")).cast("long"), F.lit(0).cast("long")).alias(c)
    return routing.union_inputs(*(df.select(F.lit(n).alias("tablename"), "l_orderkey", number("R1"), number("R2")) for n, df in out.items()))


def _records(spark, d):
    """Events as k=v records; every ninth is malformed."""
    record = F.concat(
        F.lit("Table="), "event_type", F.lit(",Id="), F.col("event_id").cast("string"), F.lit(",Note=a\\,b\\="), F.col("user_id").cast("string"),
        F.when(F.col("event_id") % 3 == 0, F.lit(",Extra=x")).otherwise(""), F.when(F.col("event_id") % 9 == 4, F.lit(",broken")).otherwise(""),
    )
    return t(spark, d, "events").select(record.alias("record"))


@query(r"""SELECT o_orderkey, 'x\' AS a, CAST(o_custkey AS VARCHAR) AS b, 'p,q=' || o_orderstatus AS c FROM orders""")
def map_escapes(spark, d):
    """Records with escaped separators, an escaped backslash before a separator, and a key that comes twice."""
    text = F.concat(F.lit("b=old,a=x\\\\,b="), F.col("o_custkey").cast("string"), F.lit(", c=p\\,q\\="), "o_orderstatus")
    rows = t(spark, d, "orders").select("o_orderkey", text.alias("rec"))
    return reshape.map_to_table(rows, "rec", ["a", "b", "c"])


@query("""SELECT CAST(event_id AS VARCHAR) AS Id, 'a,b=' || user_id AS Note, CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '-' END AS Extra
  FROM events WHERE event_type = 'click' AND event_id % 9 <> 4""")
def map_to_table(spark, d):
    return reshape.map_to_table(_records(spark, d), "record", ["Id", "Note", "Extra"], "Table", "click", "-")


@query("SELECT CAST(event_id AS VARCHAR) AS Id, 'y' || event_id AS Extra FROM events WHERE event_id % 9 <> 4")
def map_set(spark, d):
    m = reshape.record_map(F.col("record"))
    rows = _records(spark, d).withColumn("record", reshape.map_set(m, "Extra", F.concat(F.lit("y"), F.try_element_at(m, F.lit("Id")))))
    return reshape.map_to_table(rows, "record", ["Id", "Extra"])


@query("SELECT CAST(event_id AS VARCHAR) AS Id, CASE WHEN event_id % 3 = 0 THEN 'y' ELSE '' END AS Extra FROM events WHERE event_id % 9 <> 4")
def map_set_when_exist(spark, d):
    m = reshape.record_map(F.col("record"))
    rows = _records(spark, d).withColumn("record", reshape.map_set(m, "Extra", F.lit("y"), "Extra"))
    return reshape.map_to_table(rows, "record", ["Id", "Extra"])


@query("SELECT event_id, 'Extra,Id,Note,Table' AS ks FROM events WHERE event_id % 9 <> 4 AND event_id % 3 = 0")
def kv_text_parse(spark, d):
    entries = reshape.kv_text_parse(F.col("record"))
    rows = _records(spark, d).select(reshape.record_map(F.col("record"))["Id"].cast("long").alias("event_id"), F.array_join(F.transform(entries, lambda e: e["key"]), ",").alias("ks"))
    return rows.filter("event_id is not null and event_id % 3 = 0")


@query("SELECT event_id, strftime(ts, '%H%M') AS time, event_type AS kind, CAST(user_id AS VARCHAR) AS who FROM events")
def kcv_to_table(spark, d):
    record = F.concat(F.lit("TIME:"), F.date_format("ts", "HHmm"), F.lit(" KIND: "), "event_type", F.lit("  USER:"), F.col("user_id").cast("string"))
    return reshape.kcv_to_table(t(spark, d, "events").select("event_id", record.alias("rec")), "rec", ["time", "kind", "who"])


@query("""SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN CAST(user_id AS VARCHAR) ELSE '' END AS who,
  CASE event_type WHEN 'error' THEN CAST(event_id % 10 AS VARCHAR) ELSE '' END AS code,
  CASE WHEN event_type IN ('click', 'view', 'error') THEN '' ELSE 'user ' || user_id || ' code ' || event_id % 10 END AS rest FROM events""")
def event_decode(spark, d):
    message = F.concat(F.lit("user "), F.col("user_id").cast("string"), F.lit(" code "), (F.col("event_id") % 10).cast("string"))
    rules = {
        "click": ("^user (\\d+)", ["who"]),
        "view": ("^user (\\d+)", ["who"]),
        "error": ("^user (\\d+) code (\\d)$", ["who", "code"]),
    }
    rows = t(spark, d, "events").select("event_id", "event_type", message.alias("msg"))
    return reshape.event_decode(rows, "event_type", "msg", rules, ["who", "code", "rest"], ("^(.*)$", ["rest"])).drop("event_type")


ORDER_XML = "_id BIGINT, item ARRAY<STRUCT<_no: INT, part: BIGINT, flag: STRING>>"


@query("SELECT l_orderkey AS id, l_linenumber AS no, l_partkey AS part, lower(l_returnflag) AS flag FROM lineitem")
def xml_flatten(spark, d):
    paths = {"id": "_id", "no": "item._no", "part": "item.part", "flag": "item.flag"}
    return reshape.xml_flatten(_xml_orders(spark, d).select("xml"), "xml", ORDER_XML, paths, ("item",), set_values={"flag": "lower(flag)"})


@query("SELECT l_orderkey AS id, l_partkey AS part FROM lineitem WHERE l_returnflag = 'R'")
def xml_insert_filter(spark, d):
    paths = {"id": "_id", "part": "item.part", "flag": "item.flag"}
    return reshape.xml_flatten(_xml_orders(spark, d).select("xml"), "xml", ORDER_XML, paths, ("item",), keep="flag = 'R'").drop("flag")


@query("""SELECT o_custkey, 'order_status_' || o_orderstatus AS tablename, CAST(o_orderkey AS VARCHAR) AS total, '' AS missing FROM orders""")
def xml_measurement_names(spark, d):
    """Tables of measurements named by the objects' keys, one key left out and one with its value."""
    name = F.concat(F.lit("status="), "o_orderstatus", F.lit(",order="), F.col("o_orderkey").cast("string"), F.lit(",cust="), F.col("o_custkey").cast("string"))
    value = F.struct(name.alias("measObjLdn"), F.array("o_orderstatus", F.col("o_orderkey").cast("string")).alias("r"))
    rows = t(spark, d, "orders").select("o_custkey", F.array(F.lit("status"), F.lit("total")).alias("names"), F.array(value).alias("objects"))
    out = reshape.xml_measurements(rows, "names", "objects", ["total", "missing"], ["o_custkey"], skip=("cust",), with_value=("status",))
    return out.select("o_custkey", "tablename", "total", "missing")


@query("""SELECT o_custkey, 'cust_order' AS tablename, CAST(o_orderkey AS VARCHAR) AS total, '' AS missing FROM orders""")
def xml_measurements(spark, d):
    """A measurement document for each customer: names once, results by order."""
    value = F.concat(
        F.lit("<measValue measObjLdn='order="), F.col("o_orderkey").cast("string"), F.lit(",cust="), F.col("o_custkey").cast("string"),
        F.lit("'><r>"), F.col("o_orderstatus"), F.lit("</r><r>"), F.col("o_orderkey").cast("string"), F.lit("</r></measValue>"),
    )
    body = F.concat(F.lit("<info><measType>status</measType><measType>total</measType>"), F.array_join(F.collect_list(value), ""), F.lit("</info>"))
    docs = t(spark, d, "orders").groupBy("o_custkey").agg(body.alias("xml"))
    kinds = "measType ARRAY<STRING>, measValue ARRAY<STRUCT<_measObjLdn: STRING, r: ARRAY<STRING>>>"
    rows = docs.select("o_custkey", F.from_xml("xml", kinds).alias("x")).select("o_custkey", "x.*")
    out = reshape.xml_measurements(rows, "measType", "measValue", ["total", "missing"], ["o_custkey"], "_measObjLdn")
    return out.select("o_custkey", "tablename", "total", "missing")


# schemas


@query("""SELECT 'p_size' AS name, 'numeric(15,5)' AS type UNION ALL SELECT 'p_name', 'varchar(' || greatest(20, 2 * max(length(p_name))) || ')' FROM part
  UNION ALL SELECT 'p_brand', 'varchar(' || greatest(20, 2 * max(length(p_brand))) || ')' FROM part UNION ALL SELECT 'starttime', 'timestamp'""")
def infer_field_type(spark, d):
    df = t(spark, d, "part").select(F.col("p_size").cast("string").alias("p_size"), "p_name", "p_brand", F.lit("2024-01-01 00:00:00").alias("starttime"))
    return schema.infer_field_types(df)


@query("SELECT c_custkey, c_name, c_nationkey, NULL AS note, false AS same FROM customer")
def evolve_add_columns(spark, d):
    old = t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    seen = T.StructType([T.StructField("C_NAME", T.StringType()), T.StructField("note", T.StringType())])
    grown, new = schema.evolve_add_columns(old.schema, seen)
    return schema.with_schema(old, grown).withColumn("same", F.lit(not new))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS user_id, 'user_id' AS changed FROM events")
def evolve_retype(spark, d):
    user = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("user_id").cast("string"))
    df = t(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), user.alias("user_id"))
    declared = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType())])
    grown, changed = schema.evolve_retype(df, declared)
    return schema.with_schema(df, grown).withColumn("changed", F.lit(",".join(changed)))


@query("""SELECT DISTINCT l_returnflag AS shape, '_Attri_id,name_4_buyer,name_4_seller' AS names FROM lineitem""")
def evolve_rename_collision(spark, d):
    """Documents with the same element under two parents, by return flag; columns are named from the schema they show."""
    xml = F.concat(F.lit("<o id='1'><buyer><name>"), "l_returnflag", F.lit("</name></buyer><seller><name>x</name></seller></o>"))
    docs = t(spark, d, "lineitem").select("l_returnflag", xml.alias("xml"))
    names = schema.flat_names(schema.discover_xml_schema(docs, "xml"))
    return docs.select(F.col("l_returnflag").alias("shape"), F.lit(",".join(sorted(names.values()))).alias("names")).distinct()


@query("""SELECT 'item' AS path, 'ARRAY<STRUCT<_no: BIGINT, price: DOUBLE, ship: STRING>>' AS kind UNION ALL SELECT 'key', 'BIGINT'
  UNION ALL SELECT 'note._lang', 'STRING' UNION ALL SELECT 'note._VALUE', 'STRING' ORDER BY 1""")
def discover_xml_shapes(spark, d):
    """Documents of many shapes: optional parts and notes, one to seven items, prices whole or not; nulls and broken ones between."""
    price = F.when(F.col("l_orderkey") % 3 == 0, F.col("l_quantity").cast("int").cast("string")).otherwise(F.format_string("%.2f", F.col("l_extendedprice").cast("double")))
    ship = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("<ship>"), "l_linestatus", F.lit("</ship>"))).otherwise("")
    item = F.concat(F.lit("<item no='"), F.col("l_linenumber").cast("string"), F.lit("'><price>"), price, F.lit("</price>"), ship, F.lit("</item>"))
    key = F.col("l_orderkey").cast("string")
    note = F.when(F.col("l_orderkey") % 5 == 0, "<note lang='en'>said</note>").otherwise("")
    whole = F.concat(F.lit("<o><key>"), key, F.lit("</key>"), note, F.array_join(F.collect_list(item), ""), F.lit("</o>"))
    broken = F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).when(F.col("l_orderkey") % 11 == 0, "<o><key>x</o>").otherwise(F.col("xml"))
    docs = t(spark, d, "lineitem").groupBy("l_orderkey").agg(whole.alias("xml")).select(broken.alias("xml"))
    found = schema.discover_xml_schema(docs, "xml")
    rows = [(f"{f.name}.{g.name}", g.dataType) for f in found if isinstance(f.dataType, T.StructType) for g in f.dataType]
    rows += [(f.name, f.dataType) for f in found if not isinstance(f.dataType, T.StructType)]
    return spark.createDataFrame([(p, _type_name(k)) for p, k in rows], "path string, kind string")


def _type_name(kind) -> str:
    """A type as text, with the names that SQL gives it."""
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_type_name(kind.elementType)}>"
    if isinstance(kind, T.StructType):
        return f"STRUCT<{', '.join(f'{f.name}: {_type_name(f.dataType)}' for f in kind)}>"
    return kind.simpleString().upper()


@query("""SELECT 'items' AS tablename, o_orderstatus AS status, l_linenumber AS no, CAST(l_partkey AS VARCHAR) AS rest
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N'
  UNION ALL SELECT 'heads', o_orderstatus, o_custkey, '<cust>' || o_custkey || '</cust>' FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def xml_tables(spark, d):
    """Two tables from the same documents: their items with the head's status, and their heads with a node as its text."""
    items = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(_item()), "").alias("items"))
    o = t(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    head = F.concat(F.lit("<head status='"), "o_orderstatus", F.lit("'><cust>"), F.col("o_custkey").cast("string"), F.lit("</cust><who><cust>"), F.col("o_custkey").cast("string"), F.lit("</cust></who></head>"))
    docs = written(o.select(F.concat(F.lit("<o>"), head, F.lit("<list>"), "items", F.lit("</list></o>")).alias("xml")), "xml_docs")
    found = schema.discover_xml_schema(docs, "xml")
    tables = reshape.xml_tables(docs, "xml", found, {
        "items": reshape.XmlTable("list.item", associate={"status": "head._status"}, keep="flag <> 'N'"),
        "heads": reshape.XmlTable("head", raw=("head.who",), set_values={"cust": "cast(cust as bigint)"}),
    }, scratch_path(spark, "xml"))
    items = tables["items"].select(F.lit("items").alias("tablename"), "status", F.col("_Attri_no").alias("no"), F.col("part").cast("string").alias("rest"))
    heads = tables["heads"].select(F.lit("heads").alias("tablename"), F.col("_Attri_status").alias("status"), F.col("cust").alias("no"), F.regexp_extract("who", "<cust>.*?</cust>", 0).alias("rest"))
    return items.unionByName(heads)


@query("""SELECT 'heads' AS tablename, o_orderkey AS k, 'en' AS lang, CAST(NULL AS BIGINT) AS cust, NULL AS v FROM orders
  UNION ALL SELECT 'parts', o_orderkey, NULL, o_custkey, unnest([o_orderpriority, 'x']) FROM orders""")
def xml_odd_names(spark, d):
    """Two tables of documents with prefixes, hyphens and dots in their names, written in one pass and parse."""
    text = lambda *parts: F.concat(*(F.col(p) if p.startswith("o_") else F.lit(p) for p in parts))
    xml = text("<n:ord xml:lang='en'><md-key>", "o_orderkey", "</md-key><n:cust id.no='", "o_custkey", "'><v.1>", "o_orderpriority", "</v.1><v.1>x</v.1></n:cust></n:ord>")
    docs = t(spark, d, "orders").select(xml.alias("xml"))
    tables = reshape.xml_tables(docs, "xml", schema.discover_xml_schema(docs, "xml"), {
        "heads": reshape.XmlTable("", skip=("n:cust",)),
        "parts": reshape.XmlTable("n:cust", associate={"k": "md-key"}),
    }, scratch_path(spark, "xml"))
    heads = tables["heads"].select(F.lit("heads").alias("tablename"), F.col("md_key").alias("k"), F.col("_Attri_xml_lang").alias("lang"), F.lit(None).cast("long").alias("cust"), F.lit(None).cast("string").alias("v"))
    return heads.unionByName(tables["parts"].select(F.lit("parts").alias("tablename"), "k", F.lit(None).cast("string").alias("lang"), F.col("_Attri_id_no").alias("cust"), F.col("v_1").alias("v")))


@query("""SELECT 'order_' || n AS tablename, n AS total, CASE WHEN n % 2 = 0 THEN 'R' END AS note FROM
  (SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS n FROM lineitem)""")
def custom_xml_command(spark, d):
    """A user's own discovery and flattening: a table for each line number, whose schema grows when new documents bring a note."""
    known = schema.Registry(spark, scratch_path(spark, "registry"))
    total = F.col("l_linenumber").cast("string")
    plain = F.concat(F.lit("<m><total>"), total, F.lit("</total></m>"))
    noted = F.concat(F.lit("<m><total>"), total, F.lit("</total>"), F.when(F.col("l_linenumber") % 2 == 0, "<note>R</note>").otherwise(""), F.lit("</m>"))

    def discover(docs):
        names = [r[0] for r in docs.select("name").distinct().orderBy("name").collect()]
        return {n: schema.discover_xml_schema(docs.filter(F.col("name") == n), "xml") for n in names}

    def flatten(docs, table):
        found = schema.discover_xml_schema(docs.filter(F.col("name") == table), "xml")
        return docs.filter(F.col("name") == table).select(F.from_xml("xml", found.simpleString()).alias("x")).select("x.*").distinct()

    rows = t(spark, d, "lineitem")
    name = F.concat(F.lit("order_"), total).alias("name")
    registry.schema_discovering(rows.select(name, plain.alias("xml")).distinct(), discover, flatten, known)
    out = registry.schema_discovering(rows.select(name, noted.alias("xml")).distinct(), discover, flatten, known)
    return routing.union_inputs(*(df.withColumn("tablename", F.lit(n)) for n, df in out.items())).select("tablename", "total", "note")


@query("SELECT '_id' AS path, '_Attri_id' AS name UNION ALL SELECT 'item._no', '_Attri_no' UNION ALL SELECT 'item.part', 'part' UNION ALL SELECT 'item.flag', 'flag'")
def discover_xml_schema(spark, d):
    found = schema.flat_names(schema.discover_xml_schema(_xml_orders(spark, d), "xml"))
    return spark.createDataFrame(list(found.items()), "path string, name string")


@query("""WITH f AS (SELECT DISTINCT l_returnflag AS g, l_linenumber AS r FROM lineitem),
c AS (SELECT 'COLLECT_DATETIME' AS name, 0 AS pos, 'timestamp' AS type UNION ALL SELECT 'SITE', 1, 'varchar(20)' UNION ALL SELECT 'CPUID', 2, 'varchar(20)')
SELECT g AS tablename, CAST(row_number() OVER (PARTITION BY g ORDER BY r) + 2 AS INTEGER) AS pos, 'R' || r || '_line_' || r || '__' AS name, 'numeric(30,2)' AS type FROM f
UNION ALL SELECT g, pos, name, type FROM (SELECT DISTINCT g FROM f), c""")
def discover_stat_schema(spark, d):
    text = F.concat(F.lit("line "), F.col("l_linenumber").cast("string"), F.lit(" %"))
    rows = t(spark, d, "lineitem").select("l_returnflag", "l_linenumber", F.concat(text, F.lit("-")).alias("desc"), "l_orderkey")
    rows = rows.withColumn("desc", F.regexp_replace("desc", " %-", "--"))
    return schema.discover_stat_schema(rows, "l_returnflag", "l_linenumber", "desc", "l_orderkey")


@query("""SELECT 'seg_' || n_regionkey AS tablename, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS pos,
  repeat('_', CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER)) || 'N' AS name, 'numeric(15,5)' AS type, 'SUM' AS aggregation FROM nation""")
def schema_from_dictionary(spark, d):
    from pyspark.sql import Window as W

    first = F.row_number().over(W.partitionBy("n_regionkey").orderBy("n_nationkey")) == 1
    df = t(spark, d, "nation").select(
        F.format_string("%03d%05d", "n_regionkey", "n_nationkey").alias("o"),
        F.when(first, F.concat(F.lit("seg-"), F.col("n_regionkey").cast("string"))).otherwise("").alias("table"),
        F.when(F.col("n_nationkey") % 2 == 0, "N").otherwise("N ").alias("field"), F.lit("Counter").alias("kind"), F.lit("8").alias("size"), F.lit("sum").alias("agg"),
    )
    return schema.schema_from_dictionary(df, "o", "table", "field", "kind", "size", "agg")


# streams


def _log_lines(spark, d):
    """Events as log records: keyed ones, audits, errors, others, and lines of no form."""
    k = F.col("event_id") % 5
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    user = F.col("user_id").cast("string")
    line = (
        F.when(k == 0, F.concat_ws(",", F.lit("x"), user))
        .when(k == 1, F.concat_ws(",", F.lit("VERSION=1"), F.lit("AUDIT"), ts, ts, F.lit("wf"), user, F.lit("act"), F.lit("1,2,,")))
        .when(k == 2, F.concat_ws(",", F.lit("VERSION=1"), F.lit("ERROR"), ts, F.lit("wf"), user, F.lit("act"), F.lit('a "b"; c,d/e')))
        .when(k == 3, F.concat_ws(",", F.lit("VERSION=1"), F.lit("NOTE"), ts, F.concat(F.lit("msg "), user)))
        .otherwise(F.concat(F.lit("junk "), user))
    )
    return t(spark, d, "events").select("event_id", F.when(k == 0, "keyed").alias("key"), line.alias("value"))


ROUTED = """SELECT CASE event_id % 5 WHEN 0 THEN 'keyed' WHEN 1 THEN 'etlstat' ELSE 'etlexception' END AS tablename,
  CASE event_id % 5 WHEN 0 THEN 'x,' || user_id
   WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || ',' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || ',wf,' || user_id || ',act,1,2,,'
   WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || ',wf,' || user_id || ',act,"a /"b/"/; c,d//e";'
   WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || ',,,,"msg ' || user_id || '";'
   ELSE 'now,,,,"junk ' || user_id || '";' END AS value FROM events"""


@query(ROUTED)
def stream_log_route(spark, d):
    return logs.stream_log_route(_log_lines(spark, d), now=F.lit("now"))


@query("""SELECT c_custkey, '"a//' || c_name || '/";"/;"' AS s FROM customer""".replace('/";"/;"', '/"/;"'))
def stream_log_escape(spark, d):
    return t(spark, d, "customer").select("c_custkey", logs.stream_log_escape(F.concat(F.lit("a/"), "c_name", F.lit('";'))).alias("s"))


def _streamed(spark, d, loaded):
    source, out, state = (scratch_path(spark, n) for n in ("topic", "batches", "state"))
    _log_lines(spark, d).select("key", "value").write.parquet(source)
    stream = logs.stream_log_route(logs.stream_source(spark, "parquet", "key string, value string", source), now=F.lit("now"))
    run = logs.stream_micro_batch_sink(stream, out, state, loaded, available_now=True)
    run.awaitTermination()
    return out


@query(f"SELECT tablename, count(*) AS n FROM ({ROUTED}) GROUP BY 1")
def stream_micro_batch_sink(spark, d):
    out = _streamed(spark, d, None)
    lines = spark.read.option("basePath", out).text(f"{out}/batch=*")
    return lines.groupBy("tablename").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'etlstat' AS tablename, count(*) AS n FROM events WHERE event_id % 5 = 1")
def stream_source(spark, d):
    """The stream's records of one table, loaded batch by batch into typed rows."""
    target = scratch_path(spark, "stat")

    def load(table, path, epoch):
        if table == logs.STAT:
            kinds = T.StructType.fromDDL(logs.STAT_SCHEMA)
            rows = files.scan_csv(spark, path, [f.name for f in kinds])
            sinks.save_parquet_typed(rows, kinds, f"{target}/batch={epoch}")

    _streamed(spark, d, load)
    rows = spark.read.parquet(target).filter("wfname = 'wf' and cnt2 = 2")
    return rows.agg(F.lit("etlstat").alias("tablename"), F.count(F.lit(1)).alias("n"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || ',' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || ',,,' || event_type || ',123,' || user_id || ',,' AS line
  FROM events""")
def etl_log_record(spark, d):
    line = logs.etl_log_record(F.col("ts"), F.col("ts"), F.lit(None), F.lit(None), F.col("event_type"), [F.lit(123), F.col("user_id")])
    return t(spark, d, "events").select("event_id", line.alias("line"))


@query("""SELECT strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS cnt
  FROM events GROUP BY 1, 2""")
def stream_counts(spark, d):
    out = logs.stream_counts(timed(spark, d, "events", "ts"), "ts", ["event_type"]).drop("end")
    return out.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT '2 seconds' AS every, true AS spaced, count(*) AS n FROM events")
def stream_interval(spark, d):
    """The events as three files, a file for each micro-batch, and how far apart the batches began under the interval of the settings."""
    source, out, state = (scratch_path(spark, n) for n in ("topic", "batches", "state"))
    _log_lines(spark, d).select("key", "value").repartition(3).write.parquet(source)
    every = logs.stream_interval({"stream.interval": 2})
    feed = logs.stream_source(spark, "parquet", "key string, value string", source, maxFilesPerTrigger=1)
    run = logs.stream_micro_batch_sink(logs.stream_log_route(feed, now=F.lit("now")), out, state, interval=every)
    run.processAllAvailable()
    began = [datetime.fromisoformat(p["timestamp"]).timestamp() for p in run.recentProgress if p["numInputRows"]]
    run.stop()
    # the first batch begins at once, each later one with an interval, also behind a slow batch: no two within the same one
    spaced = len(began) == 3 == len({int(b // 2) for b in began})
    lines = spark.read.option("basePath", out).text(f"{out}/batch=*")
    return lines.agg(F.lit(every).alias("every"), F.lit(spaced).alias("spaced"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at FROM orders")
def fn_spark_pattern(spark, d):
    """Dates with one-digit months and days, under a pattern with two."""
    x = F.date_format("o_orderdate", "yyyy-M-d H:m:s")
    ts = dates.parsed(x, "YYYY-MM-dd HH:mm:ss")
    return t(spark, d, "orders").select("o_orderkey", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("at"))

"""Registered queries of stored tables that evolve, and of loads that are replayed. Tables are filled from the given ones."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import schema
from ..sources import sinks
from ..sources.commits import Ledger
from ..sources.stored import StoredTable, replay
from ..streaming import logs
from .queries_tables import t
from .scratch import scratch_path

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return put


def kept(spark, table: StoredTable, df):
    """The rows, written before the table goes."""
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    table.drop()
    return spark.read.parquet(path)


def _new(spark, known, kind: str, *keys: str) -> StoredTable:
    return StoredTable(spark, known, f"stored_{uuid.uuid4().hex}").create(T.StructType.fromDDL(kind), keys)


@query("""SELECT o_orderkey AS k, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS prio FROM orders""")
def evolve_stored_columns(spark, d):
    """Orders in a stored table, to which two jobs add a column each at the same time; later rows bring both."""
    known = schema.Registry(spark, scratch_path(spark, "registry"))
    orders = t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("prio"))
    table = _new(spark, known, "k bigint, status string", "status")
    table.append(orders.filter("k % 2 = 0").select("k", "status"))
    with ThreadPoolExecutor(2) as jobs:
        list(jobs.map(lambda kind: StoredTable(spark, known, table.name).add_columns(T.StructType.fromDDL(kind)), ["price double", "prio string"]))
    table.append(orders.filter("k % 2 = 1"))
    return kept(spark, table, table.read().select("k", "status", "price", "prio"))


@query("""SELECT o_orderkey AS k, o_orderstatus AS status, CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 1
  THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS code FROM orders""")
def evolve_stored_retype(spark, d):
    """A number column of a stored table in which later rows carry text: it becomes text, and the partition that has none of it stays as
    it was written."""
    known = schema.Registry(spark, scratch_path(spark, "registry"))
    code = F.when(F.col("o_orderstatus") != "O", F.col("o_custkey").cast("string"))
    odd = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 1)
    rows = t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.when(odd, "n/a").otherwise(code).alias("code"), F.col("o_orderstatus").alias("status"))
    table = _new(spark, known, "k bigint, code bigint, status string", "status")
    table.append(rows.filter("code is null or code <> 'n/a'"))
    table.append(rows.filter("code = 'n/a'"))
    return kept(spark, table, table.read().select("k", "status", "code"))


@query("""SELECT 'c_' || n_nationkey AS name, n_nationkey + 1 AS place, CASE WHEN n_nationkey % 2 = 0 THEN 'bigint' ELSE 'string' END AS type,
  n_name AS v FROM nation""")
def replay_statements(spark, d):
    """A table grows by a column for each nation; its logged statements make the same of another, twice, and rows fill both."""
    known, other = (schema.Registry(spark, scratch_path(spark, "registry")) for _ in range(2))
    nations = t(spark, d, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey")
    first, second = _new(spark, known, "v string"), _new(spark, other, "v string")
    for r in nations.collect():  # a statement for each nation
        first.add_columns(T.StructType.fromDDL(f"c_{r.n_nationkey} {'bigint' if r.n_nationkey % 2 == 0 else 'string'}"))
    log = schema.sort_statements(known.statements())
    for _ in range(2):
        replay(spark, log.collect(), {first.name: second})
    second.append(nations.select(F.col("n_name").alias("v"), F.col("n_nationkey").alias("c_0")))
    kinds = spark.createDataFrame([(f.name, k, f.dataType.simpleString()) for k, f in enumerate(second.schema) if k], "name string, place int, type string")
    out = kinds.join(second.read().select("v", F.concat(F.lit("c_"), "c_0").alias("name")), "name").select("name", "place", "type", "v")
    first.drop()
    return kept(spark, second, out)


@query("""SELECT coalesce('t:' || nullif(event_type, 'click') || '/%41', '') AS tablename, event_id, user_id FROM events""")
def stream_exactly_once(spark, d):
    """Records under keys with signs that paths escape, or none, streamed in three batches. Loading the second fails after its rows are
    in, so that it runs again; every row is there once."""
    source, out, state, known = (scratch_path(spark, n) for n in ("topic", "batches", "state", "ledger"))
    key = F.concat(F.lit("t:"), F.when(F.col("event_type") != "click", F.col("event_type")), F.lit("/%41"))
    rows = t(spark, d, "events").select(key.alias("key"), F.concat_ws(",", "event_id", "user_id").alias("value"))
    rows.repartition(3).write.parquet(source)
    names = [r.key or "" for r in rows.select("key").distinct().collect()]  # a handful
    tables = {n: (f"streamed_{uuid.uuid4().hex}", T.StructType.fromDDL("event_id bigint, user_id bigint")) for n in names}
    load, failed = logs.batch_loader(spark, tables, Ledger(spark, known)), []

    def fragile(table, path, epoch):
        if epoch == 1 and not failed:  # all but the note in the ledger
            failed.append(sinks.load_table(spark, tables[table][0], path, tables[table][1], batch=f"{table}-{epoch}"))
            raise OSError("lost after loading")
        load(table, path, epoch)

    for _ in range(2):
        feed = logs.stream_source(spark, "parquet", "key string, value string", source, maxFilesPerTrigger=1)
        run = logs.stream_micro_batch_sink(feed.withColumnRenamed("key", "tablename"), out, state, fragile, available_now=True)
        try:
            run.awaitTermination()
        except StreamingQueryException:
            continue
    path = scratch_path(spark, "streamed")
    for name, (table, _) in tables.items():
        spark.table(table).select(F.lit(name).alias("tablename"), "event_id", "user_id").write.mode("append").parquet(path)
        spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(path)


@query("""SELECT coalesce(CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a:b' WHEN 3 THEN 'a/b+c %2F' ELSE 'ü=x' END, '') AS k,
  o_orderkey AS v FROM orders""")
def keyed_text_names(spark, d):
    """Orders under null and empty keys and under keys that paths escape, each line read back from the files of its key."""
    k = F.element_at(F.array(*map(F.lit, (None, "", "a:b", "a/b+c %2F", "ü=x"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    lines = t(spark, d, "orders").select(k.alias("k"), F.col("o_orderkey").cast("string").alias("value"))
    found = sinks.save_keyed_text(lines, scratch_path(spark, "keyed"), "k")
    paths = {r.k: r.paths for r in found.groupBy("k").agg(F.collect_list("path").alias("paths")).collect()}  # four keys
    parts = [spark.read.text(p).select(F.lit(key).alias("k"), F.col("value").cast("long").alias("v")) for key, p in paths.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])

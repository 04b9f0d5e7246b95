import os
import subprocess
import sys

from pyspark.sql import functions as F

from weirline.operators import reshape
from weirline.plans import queries_files, queries_tables, scratch
from weirline.sources import files, sinks

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: Runs a query where executors have JVMs of their own; prints its sorted rows.
RUN = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__
name, sf, shared = sys.argv[1:]
build = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.checkpoint.dir", "file://" + shared)
spark = build.config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
rows = __spark_entry__.queries()[name](spark, sf).collect()
print(sorted(map(tuple, rows), key=str))
spark.stop()
"""


def on_cluster(name, sf, tmp_path):
    env = {**os.environ, "PYTHONPATH": HERE + os.pathsep + os.environ.get("PYTHONPATH", "")}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    done = subprocess.run([sys.executable, "-c", RUN, name, sf, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    return eval(done.stdout.strip().splitlines()[-1])


def test_jdbc_by_key_where_executors_are_apart(spark, tmp_path):
    spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") + 7).alias("o_custkey")).write.parquet(f"{tmp_path}/sf/orders.parquet")
    got = on_cluster("jdbc_by_key", f"{tmp_path}/sf", tmp_path)
    key = lambda k: None if k % 50 == 0 else k % 7 if k % 2 == 0 else k * 100003
    assert sorted(r[:3] for r in got) == [(k, k + 7, key(k)) for k in range(400)]


def test_sorted_places_whatever_the_parts(spark, tmp_path):
    """Ranges are cut by a sample; places must not come from two of them."""
    names = F.concat(F.lit("t"), F.col("id") % 3)
    rows = spark.range(40_000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.hash("id") % 1000 + 10**6).alias("ts"), names.alias("event_type"))
    rows.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        out = queries_tables.sort_statements(spark, str(tmp_path))
        got = sorted(map(tuple, out.select("place", "event_id").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    want = [r.event_id for r in rows.orderBy("ts", "event_type", "event_id").collect()]
    assert got == [(k, e) for k, e in enumerate(want, 1)]
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()  # sorted once, before


def test_database_of_odd_texts(spark):
    rows = [(1, ' "a", b\n c '), (2, None), (None, "ü,")]
    url = scratch.database(spark.createDataFrame(rows, "k long, v string"), "odd")
    got = spark.read.format("jdbc").option("url", url).option("query", 'SELECT "k", "v" FROM "odd"').load()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_jdbc_extract_where_executors_are_apart(spark, tmp_path):
    spark.range(50).selectExpr("id c_custkey", "concat('n', id) c_name", "id % 5 c_nationkey").write.parquet(f"{tmp_path}/sf/customer.parquet")
    got = on_cluster("jdbc_extract", f"{tmp_path}/sf", tmp_path)
    assert sorted(got) == [(k, f"n{k}") for k in range(50) if k % 5]


def test_archives_grow_in_number(spark, tmp_path, monkeypatch):
    orders = spark.range(200_000).selectExpr("id o_orderkey", "id o_custkey", "'F' o_orderstatus")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    read, unpack = [], files.unpack_zip_members
    monkeypatch.setattr(files, "unpack_zip_members", lambda spark, path, *rest: read.append(path) or unpack(spark, path, *rest))
    got = {r.member: r.n for r in queries_files.unpack_zip_members(spark, str(tmp_path)).collect()}
    assert got == {f"m{k}.csv": 5000 for k in range(40)}
    assert len([n for n in os.listdir(read[0].removeprefix("file:")) if n.startswith("a=")]) == 5


def test_xml_tables_are_parsed_once(spark, tmp_path, monkeypatch):
    spark.range(200).selectExpr("id o_orderkey", "id o_custkey", "'F' o_orderstatus").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(500).selectExpr("id % 100 l_orderkey", "id l_partkey", "id % 7 l_linenumber", "'R' l_returnflag").write.parquet(f"{tmp_path}/lineitem.parquet")
    parsed, parse = [], reshape.xml_records
    monkeypatch.setattr(reshape, "xml_records", lambda *args: parsed.append(1) or parse(*args))
    assert queries_files.xml_tables(spark, str(tmp_path)).groupBy("tablename").count().orderBy("tablename").collect() == [("heads", 100), ("items", 500)]
    assert len(parsed) == 1


def test_merged_lines_are_sorted_without_their_paths(spark, tmp_path, monkeypatch):
    for name in ("b", "a", "c d"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.txt").write_text("".join(f"{name}{k}\n" for k in range(50)))
    sorted_, repartition = [], type(spark.range(0)).repartitionByRange
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", lambda df, *by: sorted_.append(df.dtypes) or repartition(df, *by))
    got = sinks.merge_small_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", 1)
    assert [r[0] for r in got.collect()] == [f"{name}{k}" for name in ("a", "b", "c d") for k in range(50)]
    assert [c for c, kind in sorted_[0] if kind == "string"] == ["value"]

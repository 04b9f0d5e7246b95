"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table, in bytes of its payload, that an operator broadcasts; beyond it each has a shuffled way.
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local master may leave that unset, as in tests: it gets a fresh local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("weirline.scratch", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that the cluster shares")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("weirline.scratch", folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the application ends."""
    path = f"{shared_dir(spark)}/weirline/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


#: Bytes of a batch that goes to a Python worker at a time; documents are long, so Spark's own limit makes workers and executors large.
BATCH_BYTES, SPARKS_OWN = 2 << 20, str(64 << 20)


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of BATCH_BYTES for what is run inside, where the session has Spark's own limit, which it has again afterwards."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key)
    if was.rstrip("b") != SPARKS_OWN:
        yield
        return
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key)
        if spark.conf.get(key) != was:
            spark.conf.set(key, was)


def saved(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, in small batches, and read back.

    Cuts the lineage: a lost executor costs no recomputation of what lies before. The files go when
    the application ends, or by deleted() where ``path`` was given.
    """
    path = path or shared_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes what saved() wrote and no later step reads."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def ascii_lower(c):
    """A-Z lower-cased, nothing else. lower() does the same, and faster, where all is ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def unused(df: DataFrame, name: str) -> str:
    """The name, with a _ before it for as long as a column has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


#: A key with more than this share of the rows is hot; fewer than HOT_SHARE keys can be.
HOT_SHARE = 256


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Inner join of ``rows`` with ``groups``, which has one row for each key and the number of its rows in ``count``.

    Keys that hold more than 1 / HOT_SHARE of all rows are fewer than HOT_SHARE whatever the data, so
    they are broadcast and their rows stay where they are; the others are joined by a shuffle in which
    no key is large. Both tables should be written ones, as they are read twice.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    limit = max(1000, total // HOT_SHARE)
    hot = groups.filter(F.col(count) > limit).drop(count)
    if hot.isEmpty():
        return rows.join(groups.drop(count), keys)
    cold_rows = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    cold = cold_rows.join(groups.filter(F.col(count) <= limit).drop(count), keys)
    return cold.unionByName(rows.join(F.broadcast(hot), keys))

"""A folder that driver and executors share, for what a query writes and reads back."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir; it goes when the application ends. A local folder serves only a local master, where
    that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("weirline.scratch", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that the cluster shares")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("weirline.scratch", folder)
    path = f"{folder.rstrip('/')}/weirline/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back, for what is used several times; it goes when the application ends."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What a database calls the types of the columns that it is filled with.
SQL_TYPES = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE", T.StringType: "VARCHAR(32672)"}


def database(df: DataFrame, table: str) -> str:
    """The JDBC URL of a read-only Derby database with ``df`` as its one table, whose columns are named as they are, in lower case
    or not. Stands for a database server where there is none.

    Derby has no server here, only an engine in each JVM. The rows are written by tasks, imported by the driver's engine as a stream, and
    the database is stored in a zip file in the shared folder, from which the engine of any JVM reads pages in place. That folder
    must be a local path on each machine.
    """
    spark = df.sparkSession
    rows, packed = (scratch_path(spark, name) for name in ("rows", "database"))
    if not packed.startswith(("file:", "/")):
        raise ValueError("Derby opens no path but a local one")
    df.write.csv(rows, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows, packed = ("/" + p.removeprefix("file:").lstrip("/") for p in (rows, packed))
    manager = spark._jvm.java.sql.DriverManager
    with tempfile.TemporaryDirectory(prefix="spark-") as folder:
        lines, home = f"{folder}/lines", f"{folder}/db"
        with open(lines, "wb") as to:
            for name in sorted(os.listdir(rows)):
                if name.startswith("part-"):
                    with open(f"{rows}/{name}", "rb") as part:
                        shutil.copyfileobj(part, to, 1 << 20)
        link = manager.getConnection(f"jdbc:derby:{home};create=true")
        columns = ", ".join(f'"{f.name}" {SQL_TYPES[type(f.dataType)]}' for f in df.schema)
        for sql in (f'CREATE TABLE "{table}" ({columns})', f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{table}', '{lines}', ',', '\"', 'UTF-8', 1)"):
            statement = link.createStatement()
            statement.execute(sql)
            statement.close()
        link.close()
        try:
            manager.getConnection(f"jdbc:derby:{home};shutdown=true")
        except Py4JJavaError as done:  # which is how it says that it has shut down
            if done.java_exception.getSQLState() != "08006":
                raise
        os.makedirs(os.path.dirname(packed), exist_ok=True)
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_STORED) as z:
            for at, _, names in os.walk(home):
                for name in names:
                    z.write(f"{at}/{name}", os.path.relpath(f"{at}/{name}", folder))
    return f"jdbc:derby:jar:({packed})db"

"""Files that are written once: whoever comes second is told so."""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def at(spark: SparkSession, name: str):
    """The path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, name: str) -> str:
    path, fs = at(spark, name)
    return spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(path), "UTF-8")


def publish(spark: SparkSession, name: str, text: str) -> bool:
    """Writes a file that isn't there yet, whole or not at all; False where it is there.

    The text goes to a file of its own, which a rename that replaces nothing puts in place: one step on file systems whose
    renames are, such as HDFS.
    """
    target, fs = at(spark, name)
    own, _ = at(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(own)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if own.toUri().getScheme() in (None, "file"):  # a local rename would replace the other's file, a link can't
            os.link(own.toUri().getPath(), target.toUri().getPath())
            return True
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(own, target, options)
        return True
    except (FileExistsError, Py4JJavaError) as failed:
        if isinstance(failed, Py4JJavaError) and not fs.exists(target):
            raise
        return False
    finally:
        fs.delete(own, False)


class Ledger:
    """Which batches each table has taken in: a small file for each, with the number of rows."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _file(self, table: str, batch: str) -> str:
        return f"{self.folder}/{quote(table, safe='')}/{quote(batch, safe='')}.json"

    def rows(self, table: str, batch: str) -> int | None:
        """The number of rows of a batch that was taken in, None for another."""
        path, fs = at(self.spark, self._file(table, batch))
        return json.loads(read_text(self.spark, self._file(table, batch)))["rows"] if fs.exists(path) else None

    def commit(self, table: str, batch: str, rows: int) -> bool:
        """Notes a batch; False if it has been noted before."""
        return publish(self.spark, self._file(table, batch), json.dumps({"tablename": table, "batch": batch, "rows": rows}))

    def commits(self) -> DataFrame:
        """(tablename, batch, rows) of all that was taken in."""
        lines = self.spark.read.text(f"{self.folder}/*/*.json", wholetext=True)
        return lines.select(F.from_json("value", "tablename string, batch string, rows long").alias("j")).select("j.*")

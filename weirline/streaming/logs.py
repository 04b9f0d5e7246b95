"""The log stream: records routed to tables, and a sink that loads each micro-batch once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.routing import ROUTE
from ..sources.commits import Ledger
from ..sources.sinks import keyed_folders, load_table

#: Where settings name the batches' interval, and what it is where they don't.
INTERVAL_KEY, INTERVAL = "stream.interval", "30 seconds"
STAT, EXCEPTION = "etlstat", "etlexception"
#: How a job record's marker field and version line look.
VERSION, AUDIT, ERROR = "VERSION=1", "AUDIT", "ERROR"
#: The columns of the log tables.
STAT_SCHEMA = "startdt timestamp, enddt timestamp, wfname string, wfid string, actionname string, cnt1 double, cnt2 double, cnt3 double, cnt4 double"
EXCEPTION_SCHEMA = "startdt timestamp, wfname string, wfid string, actionname string, exception string"


def stream_source(spark: SparkSession, fmt: str = "kafka", schema: str | None = None, path: str | None = None, **options) -> DataFrame:
    """(key, value) text from a stream: Kafka where the connector is there, or any other source with those columns."""
    reader = spark.readStream.format(fmt).options(**options)
    reader = reader.schema(schema) if schema else reader
    rows = reader.load(path) if path else reader.load()
    return rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def stream_interval(settings: dict) -> str:
    """The interval of micro-batches that settings name: seconds, or a duration such as '2 minutes'."""
    value = str(settings.get(INTERVAL_KEY, INTERVAL)).strip()
    return f"{value} seconds" if value.isdigit() else value


def stream_log_escape(c: Column) -> Column:
    """Text for a quoted field: / doubled, / before quotes and semicolons, quotes around."""
    text = F.replace(F.coalesce(c, F.lit("")), F.lit("/"), F.lit("//"))
    text = F.replace(text, F.lit('"'), F.lit('/"'))
    text = F.replace(text, F.lit(";"), F.lit("/;"))
    return F.concat(F.lit('"'), text, F.lit('"'))


def stream_log_route(df: DataFrame, now: Column | None = None) -> DataFrame:
    """(tablename, value) of log records (key, value), in a batch or a stream.

    A record with a key passes under it. One without is 'VERSION=1,marker,...': with marker AUDIT a job's record,
    with ERROR an exception's with its workflow fields, with any other an exception's with blank ones.
    Anything else is an exception of now. An exception's message is one escaped field ending in ';'.
    """
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSS") if now is None else now
    value = F.coalesce(F.col("value"), F.lit(""))
    parts = F.split(value, ",", 3)
    marker, rest = F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))), F.coalesce(F.get(parts, F.lit(2)), F.lit(""))
    fields = F.split(rest, ",", 5)

    def part(k):
        return F.coalesce(F.get(fields, F.lit(k)), F.lit(""))

    keyed = F.coalesce(F.col("key"), F.lit("")) != ""
    versioned = F.get(parts, F.lit(0)) == VERSION
    error = F.concat_ws(",", part(0), part(1), part(2), part(3), F.concat(stream_log_escape(part(4)), F.lit(";")))
    short = F.split(rest, ",", 2)
    other = F.concat_ws(
        ",", F.coalesce(F.get(short, F.lit(0)), F.lit("")), F.lit(",,"), F.concat(stream_log_escape(F.get(short, F.lit(1))), F.lit(";"))
    )
    unknown = F.concat_ws(",", now, F.lit(",,"), F.concat(stream_log_escape(value), F.lit(";")))
    table = F.when(keyed, F.col("key")).when(versioned & (marker == AUDIT), STAT).otherwise(EXCEPTION)
    line = (
        F.when(keyed, value).when(versioned & (marker == AUDIT), rest).when(versioned & (marker == ERROR), error)
        .when(versioned, other).otherwise(unknown)
    )
    return df.select(table.alias(ROUTE), line.alias("value"))


def etl_log_record(start: Column, end: Column, workflow: Column, workflow_id: Column, action: Column, counts: list[Column]) -> Column:
    """A job's record as text: times, workflow, id, action and up to four counts, blank where there is none."""
    if len(counts) > 4:
        raise ValueError("a job record has four counts at most")
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSS"
    parts = [F.date_format(start, pattern), F.date_format(end, pattern), workflow, workflow_id, action, *counts]
    blank = [F.coalesce(p.cast("string"), F.lit("")) for p in parts] + [F.lit("")] * (4 - len(counts))
    return F.concat_ws(",", *blank)


def stream_micro_batch_sink(stream: DataFrame, folder: str, checkpoint: str, load: Callable | None = None, interval: str = INTERVAL, available_now: bool = False):
    """Writes each non-empty micro-batch by table under ``folder``/batch=<id>, then hands (table, path, id) to ``load``.

    A batch that runs again after a failure overwrites what it left, and ``load`` gets all its tables again: one made by
    batch_loader() takes each row in once. A null table name is an empty one.
    """
    def save(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                path = f"{folder}/batch={epoch}"
                batch.select(F.coalesce(ROUTE, F.lit("")).alias(ROUTE), "value").write.mode("overwrite").partitionBy(ROUTE).text(path)
                for table, place in keyed_folders(batch.sparkSession, path).items() if load else ():  # a handful of log tables
                    load(table, place, epoch)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def batch_loader(spark: SparkSession, tables: dict[str, tuple[str, T.StructType]], ledger: Ledger, stream: str = "", **options) -> Callable:
    """A ``load`` for stream_micro_batch_sink() that takes each row of a batch in once, however often the batch runs.

    ``tables`` gives the warehouse table and the schema for each table of the stream (others are passed over), ``stream`` a name
    by which streams that load into the same tables are told apart. ``options`` are those of load_table().
    """

    def load(table: str, path: str, epoch: int) -> None:
        if table in tables:
            target, schema = tables[table]
            load_table(spark, target, path, schema, batch=f"{stream}{table}-{epoch}", ledger=ledger, **options)

    return load


def stream_counts(events: DataFrame, time: str, keys: list[str], width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """An extension: counts by event-time window, with a watermark where the input streams."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "cnt"
    )

"""Writing tables, keyed text and messages."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.routing import ROUTE
from ..operators.sizes import small
from .commits import Ledger, at
from .files import typed

ZERO_FOR_NULL = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)


def save_by_table(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> dict[str, str]:
    """Each table in a folder of its own; the paths by table."""
    out = {}
    for name, df in tables.items():
        out[name] = f"{folder.rstrip('/')}/{name}"
        df.write.mode(mode).format(fmt).options(**options).save(out[name])
    return out


#: Fixed value: the folder of a null or empty partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def save_keyed_text(df: DataFrame, folder: str, key: str = ROUTE, value: str = "value", mode: str = "overwrite") -> DataFrame:
    """Keyed lines in one pass, a folder for each key; (key, path) of what was written. A null key is an empty one."""
    df.select(F.coalesce(F.col(key), F.lit("")).alias(key), value).write.mode(mode).partitionBy(key).text(folder)
    files = df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    found = F.regexp_extract("path", f"/{key}=([^/]*)/", 1)
    own = F.when(found == NO_VALUE, F.lit("")).otherwise(F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))))
    return files.filter(F.col("path").contains(f"/{key}=")).select(own.alias(key), "path")


def keyed_folders(spark: SparkSession, folder: str, key: str = ROUTE) -> dict[str, str]:
    """The folder of each key under ``folder``, as save_keyed_text() leaves them."""
    path, fs = at(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    out = {}
    for name in names:
        if name.startswith(f"{key}="):
            value = name[len(key) + 1 :]
            out["" if value == NO_VALUE else unquote(value)] = f"{folder.rstrip('/')}/{name}"
    return out


def save_parquet_typed(df: DataFrame, schema: T.StructType, path: str, mode: str = "overwrite") -> None:
    """Text rows as typed Parquet by a schema."""
    typed(df, schema).select(*(f.name for f in schema)).write.mode(mode).parquet(path)


def output_single_or_multiple(tables: dict[str, DataFrame], single: bool) -> dict[str, DataFrame]:
    """All tables merged into one under '' (columns by name, missing ones null), or as they are."""
    if not single:
        return tables
    out = None
    for df in tables.values():
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return {"": out}


def rows_to_csv(df: DataFrame, delimiter: str = ",") -> Column:
    """A row as delimited text: null numbers (but decimals) as 0, other nulls empty."""
    parts = [
        F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("0" if isinstance(f.dataType, ZERO_FOR_NULL) else ""))
        for f in df.schema
    ]
    return F.concat_ws(delimiter, *parts)


def csv_escape_output(df: DataFrame, delimiter: str = ",") -> Column:
    """A row as delimited text in which fields with the delimiter, a quote or a line end are quoted, quotes doubled."""
    def one(f):
        text = F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit(""))
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        risky = F.contains(text, F.lit(delimiter)) | text.rlike('["\\n\\r]')
        return F.when(risky, quoted).otherwise(text)

    return F.concat_ws(delimiter, *(one(f) for f in df.schema))


#: The column by which a table that takes batches is partitioned.
BATCH = "batch"


def load_table(
    spark: SparkSession, table: str, paths, schema: T.StructType, delimiter: str = ",", escape: str = "\\", record_end: str | None = None,
    truncate: bool = False, before: str | None = None, batch: str | None = None, ledger: Ledger | None = None,
) -> int:
    """Loads delimited files into a warehouse table, creating it if need be; the number of rows loaded.

    ``before`` is a statement to run first; ``truncate`` empties the table. With ``batch`` the load can be repeated: rows go to the
    partition of that name, replacing what an earlier try left there, and a batch that ``ledger`` knows is not loaded again.
    """
    if batch is not None and ledger is not None and (known := ledger.rows(table, batch)) is not None:
        return known
    if before:
        spark.sql(before)
    reader = spark.read.option("sep", delimiter).option("escape", escape)
    reader = reader.option("lineSep", record_end) if record_end else reader
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = typed(reader.schema(text).csv(paths), schema)
    from pyspark.sql import Observation

    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    if batch is None:
        rows.write.mode("overwrite" if truncate else "append").saveAsTable(table)
        return seen.get["n"]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, `{BATCH}` string) USING parquet PARTITIONED BY (`{BATCH}`)")
    if BATCH not in [c.name for c in spark.catalog.listColumns(table) if c.isPartition]:
        raise ValueError(f"{table} is not partitioned by {BATCH}")
    if truncate:
        spark.sql(f"TRUNCATE TABLE {table}")
    names = ", ".join(f"`{f.name}`" for f in schema)
    value = batch.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{BATCH}` = '{value}') SELECT {names} FROM {{rows}}", rows=rows.select(*(f"`{f.name}`" for f in schema)))
    if ledger is not None:
        ledger.commit(table, batch, seen.get["n"])
    return seen.get["n"]


#: Stands for every table in a list of tables to empty.
EVERY_TABLE = "-ALL-"


def load_tables(
    spark: SparkSession, files: dict[str, list[str]], schemas: dict[str, T.StructType], only: list[str] | None = None, clean: list[str] = (),
    before: str | None = None, **options,
) -> dict[str, int]:
    """Loads the files of several tables, as file_to_table_match() finds them; rows loaded by table.

    ``only`` names the tables to load, ``clean`` those to empty first (EVERY_TABLE: all that are loaded).
    ``before`` is a statement run before each load, with {table} for its name. A table without a schema is an error.
    """
    tables = [name for name in files if only is None or name in only]
    unknown = [name for name in tables if name not in schemas]
    if unknown:
        raise KeyError(f"no schema for {unknown}")
    return {
        name: load_table(
            spark, name, files[name], schemas[name], truncate=EVERY_TABLE in clean or name in clean,
            before=before.replace("{table}", name) if before else None, **options,
        )
        for name in tables
    }


def file_to_table_match(files: DataFrame, exp: str, only: list[str] | None = None) -> DataFrame:
    """(tablename, paths): the distinct files (path) of each table, a table being an expression over ``path``."""
    named = files.withColumn(ROUTE, F.expr(exp)).filter(F.col(ROUTE).isNotNull())
    named = named.filter(F.col(ROUTE).isin(only)) if only is not None else named
    return named.groupBy(ROUTE).agg(F.array_sort(F.collect_set("path")).alias("paths"))


#: Bytes of input for each merged file where their number isn't given.
MERGED_BYTES = 256 << 20


def merge_small_files(spark: SparkSession, path, out: str, files: int | None = None, container: bool = False, limit: int | None = None) -> DataFrame:
    """Many small text files in few: their lines one after another by file name, or as Parquet rows (name, body). The number of
    files follows from the input's bytes where it isn't given. ``limit``: the first so many files by name."""
    source = F.col("_metadata.file_path").alias("_path")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(source, "length")
    if files is None:
        files = max(1, -(-(listed.agg(F.sum("length")).first()[0] or 0) // MERGED_BYTES))
    # a file's place by name stands for its name and path in rows that are sorted, which may be shorter than those
    places = listed.select("_path", F.row_number().over(W.orderBy(F.element_at(F.split("_path", "/"), -1), "_path")).alias("_place"))
    if limit is not None:
        places = places.filter(F.col("_place") <= limit)
    if container:
        rows = spark.read.text(path, wholetext=True).select(source, F.col("_metadata.file_name").alias("name"), F.col("value").alias("body"))
        order = ["_place"]
    else:
        rows = spark.read.text(path).select(
            source, F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"), "value"
        )
        order = ["_place", "_start", "_id"]
    rows = rows.join(small(places), "_path").drop("_path")
    few = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_place", "_start", "_id")
    if container:
        few.write.mode("overwrite").parquet(out)
        return spark.read.schema("name string, body string").parquet(out)
    few.select("value").write.mode("overwrite").text(out)
    return spark.read.text(out)


def emit_messages(df: DataFrame, key_exp: str, attribute_exps: list[str], delimiter: str = ",") -> DataFrame:
    """(key, value): a message for each row, its attributes by expressions; null ones are empty. Written with
    ``write.format("kafka")`` where the connector is there."""
    parts = [F.coalesce(F.expr(e).cast("string"), F.lit("")) for e in attribute_exps]
    return df.select(F.coalesce(F.expr(key_exp).cast("string"), F.lit("")).alias("key"), F.concat_ws(delimiter, *parts).alias("value"))


def decode_messages(df: DataFrame, schema: T.StructType, value: str = "value", delimiter: str = ",") -> DataFrame:
    """Typed attributes of delimited messages."""
    text = ", ".join(f"`{f.name}` string" for f in schema)
    row = F.from_csv(F.col(value), text, {"sep": delimiter})
    others = [c for c in df.columns if c != value]
    return typed(df.select(*others, row.alias("_r")).select(*others, *(F.col(f"_r.`{f.name}`").alias(f.name) for f in schema)), schema)

"""Named operators over named tables, and SQL over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import select_expansion
from ..operators.schema import Registry, with_schema

Tables = dict[str, DataFrame]
_OPERATORS: dict[str, Callable[..., Tables]] = {}


def register_operator(name: str, fn: Callable[..., Tables]) -> None:
    """Makes a function from tables to tables callable by name. Row-to-rows and group-to-rows work goes in it as mapInPandas and
    applyInPandas."""
    _OPERATORS[name] = fn


def run_operator(name: str, tables: Tables, **options) -> Tables:
    if name not in _OPERATORS:
        raise KeyError(f"no operator {name!r}; there are {sorted(_OPERATORS)}")
    return _OPERATORS[name](tables, **options)


def sql_query(spark: SparkSession, tables: Tables, statements: list[tuple[str | None, str]], groups: dict[str, list[str]] | None = None) -> Tables:
    """Runs statements over the tables as views. Each gives a named table that later ones see, or (None) is run for its effect.
    $name in a statement stands for a group of columns."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    out: Tables = {}
    for name, text in statements:
        result = spark.sql(select_expansion(text, groups or {}))
        if name:
            result.createOrReplaceTempView(name)
            out[name] = result if name not in out else out[name].unionByName(result)
    return out


def schema_discovering(
    docs: DataFrame, discover: Callable[[DataFrame], dict[str, T.StructType]], flatten: Callable[[DataFrame, str], DataFrame], registry: Registry | None = None
) -> Tables:
    """A command for documents of its own kind. ``discover`` gives the schema of each table that they hold; what the registry
    knows of a table grows by the attributes that it lacks. ``flatten`` gives a table's rows, which come under that schema."""
    out: Tables = {}
    for table, seen in discover(docs).items():
        grown = registry.grow(table, seen) if registry else seen
        out[table] = with_schema(flatten(docs, table), grown)
    return out


def map_rows(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """Row to many rows: ``fn`` takes and yields pandas frames."""
    return df.mapInPandas(fn, schema)


def map_groups(df: DataFrame, keys: list[str], fn: Callable, schema: str, together: int | None = None) -> DataFrame:
    """Group to many rows: ``fn`` takes a group's pandas frame and gives one. A group is held by one task.

    Where groups are many and small, a frame for each costs far more than what is done with it: with ``together`` ``fn`` takes a frame
    of many whole groups, about so many rows, and groups it itself."""
    if together is None:
        return df.groupBy(*keys).applyInPandas(fn, schema)
    buckets = max(1, -(-df.count() // together))
    parted = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    return parted.groupBy("_bucket").applyInPandas(lambda frame: fn(frame.drop(columns="_bucket")), schema)

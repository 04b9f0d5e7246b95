"""One input routed to several tables. A route is a column ``tablename``; tables are filters on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .sizes import small

ROUTE = "tablename"


def split_by_keys(df: DataFrame, keys: list[str], omit_keys: bool = False) -> DataFrame:
    """Routes rows by their key values, joined by '-' with '-' inside a value as '_'. Null counts as empty."""
    parts = [F.translate(F.coalesce(F.col(k).cast("string"), F.lit("")), "-", "_") for k in keys]
    out = df.withColumn(ROUTE, F.concat_ws("-", *parts))
    return out.drop(*keys) if omit_keys else out


def split_by_exp(df: DataFrame, exp: str) -> DataFrame:
    """Routes rows by an expression over the columns (and an earlier route)."""
    return df.withColumn(ROUTE, F.expr(exp).cast("string"))


def route(df: DataFrame, table: str) -> DataFrame:
    """The rows of one table."""
    return df.filter(F.col(ROUTE) == table)


def route_outlets(df: DataFrame, tables: list[str]) -> dict[str, DataFrame]:
    """A DataFrame for each outlet. Persist the input first if several are used."""
    return {t: route(df, t) for t in tables}


def not_key(df: DataFrame, table: str) -> DataFrame:
    """All rows but one table's; rows without a route stay."""
    return df.filter(~F.col(ROUTE).eqNullSafe(table))


def distinct_tables(df: DataFrame) -> DataFrame:
    return df.select(ROUTE).distinct()


#: Lines of a file that a window sees at a time.
STRETCH = 100_000


def carried(lines: DataFrame, file: str, pos: str, name: str, own: Column, last: bool) -> DataFrame:
    """Adds a value that runs on through the lines of each file: the last non-null ``own``, or the sum of ``own`` so far."""
    return carried_all(lines, file, pos, {name: (own, last)})


def carried_all(lines: DataFrame, file: str, pos: str, values: dict[str, tuple[Column, bool]]) -> DataFrame:
    """carried() for several values (own, last) by name, in one go.
    A file is cut into stretches of lines; what a stretch gives is carried to the next by a window over stretches."""
    cut = lines.withColumns({f"_own{k}": own for k, (own, _) in enumerate(values.values())} | {"_stretch": F.floor(F.col(pos) / STRETCH)})
    gives, brought = [], []
    before = W.partitionBy("_file").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    for k, (_, last) in enumerate(values.values()):
        of = F.max_by(f"_own{k}", F.when(F.col(f"_own{k}").isNotNull(), F.col(pos))) if last else F.sum(f"_own{k}")
        gives.append(of.alias(f"_gives{k}"))
        brought.append((F.last(f"_gives{k}", ignorenulls=True).over(before) if last else F.sum(f"_gives{k}").over(before)).alias(f"_brought{k}"))
    each = cut.groupBy(F.col(file).alias("_file"), F.col("_stretch").alias("_s")).agg(*gives).select("_file", "_s", *brought)
    joined = cut.join(each, F.col(file).eqNullSafe(F.col("_file")) & (F.col("_stretch") == F.col("_s")))
    inside, found = W.partitionBy(file, "_stretch").orderBy(pos), {}
    for k, (name, (_, last)) in enumerate(values.items()):
        if last:
            found[name] = F.coalesce(F.last(f"_own{k}", ignorenulls=True).over(inside), F.col(f"_brought{k}"))
        else:
            found[name] = F.sum(f"_own{k}").over(inside) + F.coalesce(f"_brought{k}", F.lit(0))
    gone = [f"_{what}{k}" for what in ("own", "brought") for k in range(len(values))]
    return joined.withColumns(found).drop(*gone, "_stretch", "_file", "_s")


def split_sections_by_title(
    lines: DataFrame, titles: DataFrame, file: str = "file", pos: str = "pos", line: str = "line"
) -> DataFrame:
    """Lines of files that hold several tables, each below a title row, with the table of their title.

    ``titles`` is (title, tablename). Repeated commas count as one in titles and rows.
    Lines before a file's first title belong to no table and go; so do the title rows. A title
    that comes again continues its table, and the last section ends with the file. ``pos`` numbers a
    file's lines from 0 or so.
    """
    squeezed = F.regexp_replace(F.regexp_replace(F.col(line), ",+", ","), ",$", "")
    known = small(titles.select(F.col("title").alias("_title"), F.col(ROUTE).alias("_table")))
    marked = lines.withColumn(line, squeezed).join(known, F.col(line) == F.col("_title"), "left")
    routed = carried(marked, file, pos, ROUTE, F.col("_table"), last=True)
    return routed.filter(F.col("_title").isNull() & F.col(ROUTE).isNotNull()).select(*lines.columns, ROUTE)


def union_inputs(*frames: DataFrame) -> DataFrame:
    """The rows of all inputs; columns that one lacks are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def flip_pairs(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    return df.select(F.col(value).alias(key), F.col(key).alias(value))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def limited(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows by an order."""
    return df.orderBy(*order).limit(n)

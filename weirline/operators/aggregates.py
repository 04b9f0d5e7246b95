"""Grouped aggregates in two dialects.

``lenient``: text that is no number counts as 0, an average divides by all rows, and max and min start
from 0. ``sql``: such text is null, and nulls are left out. Both are single aggregates with partial
sums before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.scratch import written
from .columns import chosen
from .sizes import BROADCAST_BYTES, payload

OPERATIONS = ("sum", "avg", "max", "min", "count", "keep")


@dataclass(frozen=True)
class Op:
    """An operation over columns, given by name, list or selector. ``count`` takes none."""

    op: str
    columns: object = ()

    def __post_init__(self):
        if self.op not in OPERATIONS:
            raise ValueError(f"unknown aggregate {self.op!r}")


def number(c: Column, dialect: str) -> Column:
    value = F.trim(c.cast("string")).try_cast("double")
    return F.coalesce(value, F.lit(0.0)) if dialect == "lenient" else value


def _value(op: str, c: Column, dialect: str, clamp: bool) -> Column:
    x = number(c, dialect)
    if op == "sum":
        return F.sum(x)
    if op == "avg":
        return F.sum(x) / F.count(F.lit(1)) if dialect == "lenient" else F.avg(x)
    if op == "max":
        return F.greatest(F.max(x), F.lit(0.0)) if dialect == "lenient" and clamp else F.max(x)
    return F.least(F.min(x), F.lit(0.0)) if dialect == "lenient" and clamp else F.min(x)


def planned(df: DataFrame, ops: list[Op], dialect: str = "lenient", clamp: bool = True) -> list[tuple[str, Column]]:
    """(name, aggregate) of each operation. A column under one operation keeps its name, under several it is op_column; the
    count is ``cnt``."""
    pairs = [(o.op, c) for o in ops if o.op not in ("count", "keep") for c in chosen(df, o.columns)]
    often = [c for _, c in pairs] + [c for o in ops if o.op == "keep" for c in chosen(df, o.columns)]
    out = [
        (c if often.count(c) == 1 else f"{op}_{c}", _value(op, F.col(f"`{c}`"), dialect, clamp)) for op, c in pairs
    ]
    return out + [("cnt", F.count(F.lit(1)))] * any(o.op == "count" for o in ops)


def _keys(df: DataFrame, keys: list, key_exps: dict[str, str] | None) -> tuple[DataFrame, list[str]]:
    """Expression keys come before plain ones."""
    exps = key_exps or {}
    df = df.withColumns({name: F.expr(e) for name, e in exps.items()}) if exps else df
    for name in exps:
        if isinstance(df.schema[name].dataType, T.ArrayType):  # the row counts in every group
            df = df.withColumn(name, F.explode(name))
    return df, [*exps, *keys]


def aggregate(
    df: DataFrame,
    keys: object = (),
    ops: list[Op] = (),
    key_exps: dict[str, str] | None = None,
    dialect: str = "lenient",
    clamp: bool = True,
    hide: tuple[str, ...] = (),
) -> DataFrame:
    """Groups by expression keys and plain keys. An array-valued key puts a row into each of its groups (an empty one into
    none). ``keep`` among the operations gives a row for each input row, aggregates repeated.
    No keys: one row. ``hide`` lists keys left out of the result."""
    df, names = _keys(df, chosen(df, keys), key_exps)
    kept = [c for o in ops if o.op == "keep" for c in chosen(df, o.columns)]
    shown = [k for k in names if k not in hide]
    if any(o.op == "keep" for o in ops):
        values = planned(df, list(ops), dialect, clamp)
        rows = df.select(*shown, *(k for k in kept if k not in shown), *(F.col(k).alias(f"_key{i}") for i, k in enumerate(names)))
        if not values:
            return rows.drop(*(f"_key{i}" for i in range(len(names))))
        totals = df.groupBy(*(F.col(k).alias(f"_of{i}") for i, k in enumerate(names))).agg(
            *(v.alias(f"_value{j}") for j, (_, v) in enumerate(values)), F.count(F.lit(1)).alias("_n")
        )
        if names:
            joined = _joined_back(rows, written(totals, "totals"), len(names)).drop("_n")
        else:
            joined = rows.join(F.broadcast(totals), F.lit(True))
        first = rows.columns[: len(rows.columns) - len(names)]
        return joined.select(*first, *(F.col(f"_value{j}").alias(n) for j, (n, _) in enumerate(values)))
    values = planned(df, list(ops), dialect, clamp)
    grouped = (df.groupBy(*names) if names else df.groupBy()).agg(*(v.alias(n) for n, v in values))
    return grouped.drop(*(k for k in names if k in hide))


#: A group with more than this share of the rows is hot.
HOT_SHARE = 256


def _joined_back(rows: DataFrame, totals: DataFrame, keys: int) -> DataFrame:
    """``rows`` with their groups' ``totals``, written ones. Small totals are broadcast, and rows stay where they are; beyond, the totals of hot
    groups are, of which there are fewer than HOT_SHARE, and only the other rows are shuffled. So no task has a whole hot group."""
    same = [F.col(f"_key{i}").eqNullSafe(F.col(f"_of{i}")) for i in range(keys)]
    if payload(totals) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(totals), same)
    limit = max(1000, (totals.agg(F.sum("_n")).first()[0] or 0) // HOT_SHARE)
    hot = F.broadcast(totals.filter(F.col("_n") > limit))
    cold = rows.join(hot.select(*(f"_of{i}" for i in range(keys))), same, "left_anti").join(totals.filter(F.col("_n") <= limit), same)
    return cold.unionByName(rows.join(hot, same))


def aggregate_tables(tables: dict[str, DataFrame], plans: dict[str, dict]) -> dict[str, DataFrame]:
    """Independent aggregates: for each result its source table (``table``) and aggregate() arguments."""
    return {new: aggregate(tables[p["table"]], **{k: v for k, v in p.items() if k != "table"}) for new, p in plans.items()}


#: Buckets of a slice, in which counts are summed up in one go, and of a step in which a run is spread out.
SLICE_BUCKETS, STEP_BUCKETS = 1 << 16, 1 << 12


def time_bucket_runs(df: DataFrame, start: str, end: str, seconds: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """How many intervals [start, end] (timestamps) touch each fixed bucket, as runs of buckets with one count:
    (keys, first, last, cnt), ``first`` and ``last`` being the starts of a run's outer buckets.

    A sweep line: an interval counts up where it begins and down behind its end, summed per bucket before the shuffle; counts
    are then running sums. They run within slices of time, so that a hot key is spread over tasks, and each slice gets what the
    slices before it carry over. An interval that ends before it starts, or lacks an end, touches none.
    """
    s, e = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    bucket = lambda t: F.floor(F.unix_seconds(t) / seconds).cast("long")
    up, down = F.struct(bucket(s).alias("at"), F.lit(1).alias("d")), F.struct((bucket(e) + 1).alias("at"), F.lit(-1).alias("d"))
    names = [f"_key{k}" for k in range(len(keys))]
    turns = df.filter(s <= e).select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.explode(F.array(up, down)).alias("t"))
    points = turns.groupBy(*names, F.col("t.at").alias("at")).agg(F.sum("t.d").alias("d")).filter("d <> 0")
    points = points.withColumn("slice", F.floor(F.col("at") / SLICE_BUCKETS))
    # a slice has no more points than buckets, and a key no more slices than its time has
    slices = points.groupBy(*names, "slice").agg(F.sum("d").alias("d"), F.min("at").alias("at"))
    along = W.partitionBy(*names).orderBy("slice")
    carried = slices.select(
        *(F.col(n).alias(f"_of{n}") for n in names), F.col("slice").alias("_slice"),
        (F.sum("d").over(along.rowsBetween(W.unboundedPreceding, -1))).alias("_before"), F.lead("at").over(along).alias("_after"),
    )
    same = [F.col(n).eqNullSafe(F.col(f"_of{n}")) for n in names]
    joined = points.join(carried, [*same, F.col("slice") == F.col("_slice")])
    inside = W.partitionBy(*names, "slice").orderBy("at")
    count = F.sum("d").over(inside.rowsBetween(W.unboundedPreceding, 0)) + F.coalesce("_before", F.lit(0))
    runs = joined.select(*names, "at", count.alias("cnt"), F.coalesce(F.lead("at").over(inside), "_after").alias("next")).filter("cnt > 0")
    second = lambda b: F.timestamp_seconds(F.col(b) * seconds)
    return runs.withColumn("last", F.col("next") - 1).select(
        *(F.col(n).alias(k) for k, n in zip(keys, names)), second("at").alias("first"), second("last").alias("last"), "cnt"
    )


def time_buckets(df: DataFrame, start: str, end: str, seconds: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """time_bucket_runs() spread out: a row for each bucket that is touched (bucket, keys, cnt)."""
    runs = time_bucket_runs(df, start, end, seconds, keys)
    first, last = F.unix_seconds("first"), F.unix_seconds("last")
    step = F.lit(seconds * STEP_BUCKETS).cast("long")
    steps = runs.withColumn("_from", F.explode(F.sequence(first, last, step)))  # so that no row has to hold all of a long run
    each = steps.withColumn("_at", F.explode(F.sequence("_from", F.least(last, F.col("_from") + step - seconds), F.lit(seconds).cast("long"))))
    return each.select(F.timestamp_seconds("_at").alias("bucket"), *keys, "cnt")


def derived_schema(df: DataFrame, keys=(), ops: list[Op] = (), key_exps=None, table: str | None = None) -> T.StructType:
    """The schema that an aggregate has; with ``table``, its value columns are prefixed as in a merge."""
    out = aggregate(df, keys, ops, key_exps)
    names = [*(key_exps or {}), *chosen(df, keys)]
    return T.StructType([f if f.name in names or not table else T.StructField(f"{table}_{f.name}", f.dataType, f.nullable) for f in out.schema])


def type_guided(df: DataFrame, keys: list[str], dialect: str = "sql") -> DataFrame:
    """Aggregates each column by the ``aggregation`` in its field metadata (SUM, AVG, MIN, MAX, COUNT); others are left out."""
    ops = []
    for f in df.schema:
        op = str(f.metadata.get("aggregation", "")).lower()
        if f.name not in keys and op in ("sum", "avg", "min", "max"):
            ops.append(Op(op, [f.name]))
        elif f.name not in keys and op == "count" and Op("count") not in ops:
            ops.append(Op("count"))
    return aggregate(df, keys, ops, dialect=dialect)

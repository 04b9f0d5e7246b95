"""Merging tables on shared keys, and lookups."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import Op, aggregate
from .columns import chosen
from ..plans.scratch import written
from .sizes import BROADCAST_BYTES, payload, small


@dataclass
class Part:
    """A table of a merge: its keys (plain and by expression, in the same order in every table) and what to aggregate or keep."""

    df: DataFrame
    keys: object = ()
    ops: list[Op] = field(default_factory=list)
    key_exps: dict[str, str] | None = None


def _prepared(name: str, part: Part, dialect: str) -> tuple[DataFrame, list[str], dict]:
    names = [*(part.key_exps or {}), *chosen(part.df, part.keys)]
    kept = [c for o in part.ops if o.op == "keep" for c in chosen(part.df, o.columns)]
    if any(o.op == "keep" for o in part.ops) and all(o.op == "keep" for o in part.ops):
        df = part.df.withColumns({n: F.expr(e) for n, e in (part.key_exps or {}).items()})
        df = df.select(*names, *(F.col(c).cast("string").alias(f"{name}_{c}") for c in kept))
    else:
        df = aggregate(part.df, part.keys, part.ops, part.key_exps, dialect)
        df = df.withColumnsRenamed({c: f"{name}_{c}" for c in df.columns if c not in names})
    fill = {f.name: "" if isinstance(f.dataType, T.StringType) else 0 for f in df.schema if f.name not in names}
    return df, names, fill


def merge(
    parts: dict[str, Part], how: str = "outer", key_names: list[str] | None = None, dialect: str = "lenient", prepared=_prepared
) -> DataFrame:
    """Joins the parts on their keys, by position. ``how``: outer, left (the first part's rows) or inner.

    Columns come as keys, then each table's values prefixed by its name, tables in alphabetical order.
    Null keys match each other. In the lenient dialect a missing side has 0 for numbers and counts and
    an empty text for kept columns; in the sql dialect it is null. Parts that keep rows are
    joined row by row (all pairs of a key).
    """
    if how not in ("outer", "left", "inner"):
        raise ValueError(f"unknown merge {how!r}")
    out, keys, fills = None, key_names, {}
    for name, part in parts.items():
        df, names, fill = prepared(name, part, dialect)
        keys = keys or names
        fills |= fill
        if out is None:
            out = df.withColumnsRenamed(dict(zip(names, keys)))
            continue
        side = df.withColumnsRenamed({n: f"_k{i}" for i, n in enumerate(names)})
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        joined = out.join(side, on, {"outer": "full_outer"}.get(how, how))
        if how == "outer":
            joined = joined.withColumns({k: F.coalesce(k, f"_k{i}") for i, k in enumerate(keys)})
        out = joined.drop(*(f"_k{i}" for i in range(len(keys))))
    if dialect == "lenient":
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType)) for c, v in fills.items()})
    ordered = [c for name in sorted(parts) for c in out.columns if c in fills and c.startswith(f"{name}_") and not any(
        other != name and len(other) > len(name) and c.startswith(f"{other}_") for other in parts)]
    return out.select(*keys, *ordered)


def merge_multi(plans: dict[str, dict]) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Several merges over the same inputs, each with merge() arguments, and what to unpersist after their use: a part (the same
    Part under the same name) that several of them take is aggregated once and persisted on disk."""
    uses = Counter((name, id(part), p.get("dialect", "lenient")) for p in plans.values() for name, part in p["parts"].items())
    made: dict = {}

    def prepared(name, part, dialect):
        key = name, id(part), dialect
        if key not in made:
            df, names, fill = _prepared(name, part, dialect)
            made[key] = (df.persist(StorageLevel.DISK_ONLY) if uses[key] > 1 else df), names, fill
        return made[key]

    out = {name: merge(**p, prepared=prepared) for name, p in plans.items()}
    return out, [df for key, (df, _, _) in made.items() if uses[key] > 1]


def lookup_join(df: DataFrame, mapping: DataFrame, on: str, key: str, value: str, name: str, default=None) -> DataFrame:
    """Adds what ``mapping`` has for a column; the default where it has nothing. Of repeated keys the smallest value counts."""
    table = mapping.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(value).alias(name))
    out = df.join(small(table), F.col(on) == F.col("_key"), "left").drop("_key")
    return out.withColumn(name, F.coalesce(name, F.lit(default))) if default is not None else out


def prefix_lookup_join(
    df: DataFrame, codes: DataFrame, number: str, code: str = "code", name: str = "cc", longest: int | None = 4, shortest_wins: bool = True
) -> DataFrame:
    """Adds the shortest (or longest) prefix of a number that is in the code table; null if none is. Codes of more than ``longest``
    characters don't count (None: all do). A join for each length that codes have, one pass over the rows while codes are broadcast."""
    text = F.col(code).cast("string")
    known = written(codes.filter(F.char_length(text) > 0).select(text.alias("_code"), F.char_length(text).alias("_n")).distinct(), "codes")
    lengths = sorted(r[0] for r in known.select("_n").distinct().collect() if longest is None or r[0] <= longest)  # few, whatever the table
    whole, out = payload(known) <= BROADCAST_BYTES, df
    for n in lengths:
        mine = known.filter(F.col("_n") == n).select(F.col("_code").alias(f"_p{n}"))
        prefix = F.when(F.char_length(number) >= n, F.substring(number, 1, n))
        out = out.join(F.broadcast(mine) if whole else small(mine), prefix == F.col(f"_p{n}"), "left")
    order = lengths if shortest_wins else lengths[::-1]
    found = F.coalesce(*(F.col(f"_p{n}") for n in order), F.lit(None).cast("string"))
    return out.withColumn(name, found).drop(*(f"_p{n}" for n in lengths))


def composite_prefix_lookup(df: DataFrame, codes: DataFrame, areas: DataFrame, number: str, name: str = "place") -> DataFrame:
    """'cc,NPA-NXX' of a phone number: its country code and, for country 1, the next 3 + 3 digits if ``areas`` (area) has them.
    Unknown parts are blank."""
    out = prefix_lookup_join(df, codes, number, name="_cc")
    npa = F.concat(F.substring(number, 2, 3), F.lit("-"), F.substring(number, 5, 3))
    known = small(areas.select(F.col("area").alias("_area")).distinct())
    out = out.join(known, (F.col("_cc") == "1") & (npa == F.col("_area")), "left")
    return out.withColumn(
        name, F.concat_ws(",", F.coalesce("_cc", F.lit("")), F.coalesce("_area", F.lit("")))
    ).drop("_cc", "_area")

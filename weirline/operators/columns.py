"""Column edits, row validation and column ranges."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_ranges(columns: list[str], ranges: str) -> list[str]:
    """The columns that a selector such as ``0-3;5;7-`` names, in its order; an open end goes to the last column."""
    out = []
    for part in filter(None, (p.strip() for p in ranges.split(";"))):
        m = re.fullmatch(r"(\d+)(?:\s*(-)\s*(\d*))?", part)
        if not m:
            raise ValueError(f"not a range of columns: {part!r}")
        first = int(m[1])
        last = first if not m[2] else int(m[3]) if m[3] else len(columns) - 1
        out += columns[first : last + 1]
    return out


def column_ranges_complement(columns: list[str], ranges: str) -> list[str]:
    """The columns outside a selector."""
    inside = set(column_ranges(columns, ranges))
    return [c for c in columns if c not in inside]


def chosen(df: DataFrame, columns) -> list[str]:
    """Columns given as a selector text, a name, or a list of names."""
    if isinstance(columns, str):
        return column_ranges(df.columns, columns) if re.fullmatch(r"[\d;\s-]+", columns) else [columns]
    return list(columns)


@dataclass(frozen=True)
class Update:
    """Replaces ``target`` by an expression; a null result leaves it. With ``into``, by several columns: the result's
    comma-separated parts."""

    target: str
    exp: str
    into: tuple[str, ...] = ()


@dataclass(frozen=True)
class Remove:
    target: str


@dataclass(frozen=True)
class Split:
    """Splits ``target`` at a literal into named columns; surplus parts go, missing ones are null."""

    target: str
    separator: str
    into: tuple[str, ...]


@dataclass(frozen=True)
class Insert:
    """Inserts a column before ``target``; a null result is an empty text."""

    target: str
    exp: str
    name: str


def edit(df: DataFrame, *edits) -> DataFrame:
    """Applies column edits in order. Expressions always see the columns as they were before the first edit.

    One projection, whatever the number of edits. A value whose expression is null is left or emptied
    as the edit says; other edits of the row go on.
    """
    plan: list[tuple[str, Column]] = [(c, F.col(f"`{c}`")) for c in df.columns]

    def place(target):
        for k, (name, _) in enumerate(plan):
            if name == target:
                return k
        raise ValueError(f"no column {target!r} to edit")

    for e in edits:
        k = place(e.target)
        old = plan[k][1]
        if isinstance(e, Remove):
            del plan[k]
        elif isinstance(e, Insert):
            plan.insert(k, (e.name, F.coalesce(F.expr(e.exp).cast("string"), F.lit(""))))
        elif isinstance(e, Split):
            parts = F.split(old, re.escape(e.separator))
            plan[k : k + 1] = [(n, F.get(parts, F.lit(j))) for j, n in enumerate(e.into)]
        elif e.into:
            parts = F.split(F.coalesce(F.expr(e.exp).cast("string"), old.cast("string")), ",")
            plan[k : k + 1] = [(n, F.get(parts, F.lit(j))) for j, n in enumerate(e.into)]
        else:
            plan[k] = (e.target, F.coalesce(F.expr(e.exp), old))
    return df.select(*(c.alias(n) for n, c in plan))


def row_validation(df: DataFrame, predicate: str) -> DataFrame:
    """Rows for which the predicate holds or says nothing (null)."""
    return df.filter(F.coalesce(F.expr(predicate).cast("boolean"), F.lit(True)))


def drop_trailing_delimiter(fields: Column, when: Column | bool = True) -> Column:
    """An array of fields without the empty last one that a trailing delimiter leaves."""
    last_empty = (F.size(fields) > 0) & (F.coalesce(F.element_at(fields, -1), F.lit("")) == "")
    cut = F.lit(when) if isinstance(when, bool) else F.coalesce(when, F.lit(False))
    return F.when(cut & last_empty, F.slice(fields, 1, F.size(fields) - 1)).otherwise(fields)


def field(df: DataFrame, name: str) -> Column:
    """A field by name as text; a missing column or a null is an empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) if name in df.columns else F.lit("")


def with_globals(df: DataFrame, values: dict) -> DataFrame:
    """Named values as columns, usable in every later expression. A value is a literal, or a one-row DataFrame of one column."""
    for name, value in values.items():
        if isinstance(value, DataFrame):
            one = value.select(F.col(value.columns[0]).alias(name)).limit(1)
            df = df.join(F.broadcast(one), F.lit(True), "left")
        else:
            df = df.withColumn(name, F.lit(value))
    return df


def file_attributes(df: DataFrame, batch_id: str | None = None) -> DataFrame:
    """filename, pathname and batchid of a file scan's rows."""
    return df.withColumns(
        {
            "filename": F.col("_metadata.file_name"),
            "pathname": F.col("_metadata.file_path"),
            "batchid": F.lit(batch_id),
        }
    )


def normalize_width(lines: Column, names: list[str], delimiter: str = ",") -> list[Column]:
    """Fields of delimited text as columns; short rows are filled with nulls, surplus fields go."""
    schema = ", ".join(f"`{n}` string" for n in names)
    row = F.from_csv(lines, schema, {"sep": delimiter, "mode": "PERMISSIVE"})
    return [row[n].alias(n) for n in names]


def add_fields(df: DataFrame, fields: T.StructType | str) -> DataFrame:
    """Declared columns that the table lacks, added as nulls."""
    fields = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns})


def select_expansion(statement: str, groups: dict[str, list[str]]) -> str:
    """SQL text with $name replaced by a list of columns, and f($name) by the function of each of them."""
    def called(m):
        return ", ".join(f"{m[1]}(`{c}`) AS `{c}`" for c in groups[m[2]])

    known = "|".join(sorted(map(re.escape, groups), key=len, reverse=True))
    if not known:
        return statement
    statement = re.sub(rf"(\w+)\(\s*\$({known})\b\s*\)", called, statement)
    return re.sub(rf"\$({known})\b", lambda m: ", ".join(f"`{c}`" for c in groups[m[1]]), statement)

"""Warehouse tables whose schema evolves under readers and writers.

A stored table is a view over layers, which are Parquet tables of the warehouse. Its schema, its layers and every change are
versions of a registry, written by compare-and-swap: of two jobs that change a table at once one starts over from what the
other made, so neither loses a column. New columns go to the newest layer and are null in the others. Where a column's type
changes, the partitions that hold values of it are rewritten to a new layer, and the view, replaced in one step, turns from
the old to the new. Readers see the one or the other; a rewrite that fails leaves the table as it was.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.schema import ADD, RETYPE, Conflict, Registry, changed_schema, evolve_add_columns, evolve_retype, with_schema
from ..operators.sizes import small


#: How long a change of type waits for jobs that append.
WAIT_S = 600


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value, kind: T.DataType) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind.simpleString()})"


class StoredTable:
    """A table of the warehouse with its registry; ``name`` may say a database, too."""

    def __init__(self, spark: SparkSession, registry: Registry, name: str):
        self.spark, self.registry, self.name = spark, registry, name

    def create(self, schema: T.StructType, partition_by: Iterable[str] = ()) -> StoredTable:
        """An empty table; Conflict where there is one of the name."""
        layer = self._new_layer()
        facts = {"partition_by": list(partition_by), "layers": [{"table": layer, "columns": schema.names, "replaced": []}]}
        self._make_layer(layer, schema, facts["partition_by"])
        try:
            self.registry.put(self.name, schema, 0, [], **facts)
        except Conflict:
            self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(layer)}")
            raise
        self.refresh()
        return self

    def read(self) -> DataFrame:
        return self.spark.table(_quoted(self.name))

    @property
    def schema(self) -> T.StructType:
        return self.registry.get(self.name)

    def add_columns(self, seen: T.StructType) -> list[str]:
        """Adds the columns of ``seen`` that the table lacks; their names. Another job's columns stay."""

        def change(schema, facts):
            grown, new = evolve_add_columns(schema, seen)
            facts["layers"][-1]["columns"] += [f.name for f in new]
            return grown, [{"op": ADD, "column": f.name, "type": f.dataType.simpleString()} for f in new]

        return [c["column"] for c in self._change(change)]

    def append(self, rows: DataFrame) -> None:
        """Adds rows. Columns that the table lacks are added to it, number columns in which the rows carry text become text, and columns
        that the rows lack are null."""
        self.add_columns(rows.schema)
        schema = self.schema
        _, odd = evolve_retype(rows, schema)
        if odd:
            self.retype(odd, rows)
            return
        own = uuid.uuid4().hex
        self._mark(lambda writers: [*writers, own])
        try:
            entry = self.registry.entry(self.name)
            layer = entry["facts"]["layers"][-1]["table"]
            schema = T.StructType.fromJson(entry["schema"])
            with_schema(rows, schema).select(*map(_column, self.spark.table(_quoted(layer)).columns)).write.insertInto(_quoted(layer))
        finally:
            self._mark(lambda writers: [w for w in writers if w != own])

    def retype(self, columns: list[str], rows: DataFrame | None = None, rewrite: Callable[[DataFrame, str], None] | None = None) -> list:
        """Number columns become text, and ``rows`` that carry such text come in with the change. Returns the partitions rewritten.

        Only partitions in which one of the columns has a value are rewritten (an unpartitioned table is one partition); in
        the others the column stays null. As many values as there are partitions pass through the driver. A change waits
        for jobs that append, and one that begins meanwhile makes it start over.
        ``rewrite`` writes the new layer and stands in for a failure in tests.
        """
        while True:
            entry = self._without_writers()
            schema, facts = T.StructType.fromJson(entry["schema"]), entry["facts"]
            changes = [{"op": RETYPE, "column": c, "type": "string"} for c in columns if schema[c].dataType != T.StringType()]
            grown, keys = changed_schema(schema, changes), facts["partition_by"]
            old = self._select(schema, facts)
            holds = F.greatest(*(F.count(_column(c)) for c in columns), F.lit(0))
            touched = old.groupBy(*map(_column, keys)).agg(holds.alias("_n")).filter("_n > 0").select(*map(_column, keys))
            found = [tuple(r) for r in touched.collect()] if keys else []
            layer = self._new_layer()
            moved = self._partitions(old, found, keys) if keys else old
            new = with_schema(moved, grown)
            new = new.unionByName(with_schema(rows, grown)) if rows is not None else new
            self._make_layer(layer, grown, keys)
            try:
                new = new.select(*map(_column, self.spark.table(_quoted(layer)).columns))
                if rewrite:
                    rewrite(new, layer)
                else:
                    new.write.insertInto(_quoted(layer))
                text = [[None if v is None else str(v) for v in p] for p in found]
                # every partition is replaced where there are none
                facts["layers"].append({"table": layer, "columns": grown.names, "replaced": text if keys else None})
                self.registry.put(self.name, grown, entry["version"], changes, **facts)
            except Conflict:
                self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(layer)}")
                continue
            except BaseException:
                self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(layer)}")
                raise
            self.refresh()
            return found

    def refresh(self) -> None:
        """Makes the catalog say what the registry says; run it again after a job that ended in between."""
        while True:
            entry = self.registry.entry(self.name)
            schema, facts = T.StructType.fromJson(entry["schema"]), entry["facts"]
            newest = facts["layers"][-1]
            self._widen(newest["table"], [schema[c] for c in newest["columns"]])
            text = self._statement(schema, facts)
            self.spark.sql(f"CREATE VIEW IF NOT EXISTS {_quoted(self.name)} AS {text}")
            self.spark.sql(f"ALTER VIEW {_quoted(self.name)} AS {text}")  # one step; CREATE OR REPLACE drops the view first
            if self.registry.version(self.name) == entry["version"]:
                return

    def drop_replaced(self) -> None:
        """Drops layers of which nothing is read any more."""
        layers = self.registry.entry(self.name)["facts"]["layers"]
        last = max((k for k, x in enumerate(layers) if x["replaced"] is None), default=0)
        for x in layers[:last]:
            self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(x['table'])}")

    def drop(self) -> None:
        """Drops the view and its layers; the registry keeps the history."""
        self.spark.sql(f"DROP VIEW IF EXISTS {_quoted(self.name)}")
        for x in self.registry.entry(self.name)["facts"]["layers"]:
            self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(x['table'])}")

    def _change(self, change) -> list[dict]:
        """A change to schema and layers, made again on what another job has made of them meanwhile."""
        while True:
            entry = self.registry.entry(self.name)
            schema, changes = change(T.StructType.fromJson(entry["schema"]), facts := entry["facts"])
            if not changes:
                return []
            try:
                self.registry.put(self.name, schema, entry["version"], changes, **facts)
            except Conflict:
                continue
            self.refresh()
            return changes

    def _mark(self, change) -> None:
        """Notes which jobs append, by compare-and-swap."""
        while True:
            entry = self.registry.entry(self.name)
            entry["facts"]["writers"] = change(entry["facts"].get("writers", []))
            try:
                self.registry.put(self.name, T.StructType.fromJson(entry["schema"]), entry["version"], [], **entry["facts"])
                return
            except Conflict:
                continue

    def forget_writers(self) -> None:
        """Forgets jobs that were lost while they appended."""
        self._mark(lambda writers: [])

    def _without_writers(self) -> dict:
        since = time.monotonic()
        while True:
            entry = self.registry.entry(self.name)
            if not entry["facts"].get("writers"):
                return entry
            if time.monotonic() - since > WAIT_S:
                raise Conflict(f"jobs append to {self.name!r}; forget_writers() if they are lost")
            time.sleep(0.2)

    def _new_layer(self) -> str:
        return f"{self.name}__{uuid.uuid4().hex[:12]}"

    def _make_layer(self, layer: str, schema: T.StructType, keys: list[str]) -> None:
        columns = ", ".join(f"{_column(f.name)} {f.dataType.simpleString()}" for f in schema)
        parts = f" PARTITIONED BY ({', '.join(map(_column, keys))})" if keys else ""
        self.spark.sql(f"CREATE TABLE {_quoted(layer)} ({columns}) USING parquet{parts}")

    def _widen(self, layer: str, fields: list[T.StructField]) -> None:
        while True:
            there = {c.lower() for c in self.spark.table(_quoted(layer)).columns}
            lacking = [f for f in fields if f.name.lower() not in there]
            if not lacking:
                return
            columns = ", ".join(f"{_column(f.name)} {f.dataType.simpleString()}" for f in lacking)
            try:
                self.spark.sql(f"ALTER TABLE {_quoted(layer)} ADD COLUMNS ({columns})")
            except AnalysisException:  # another job may have added one of them meanwhile
                after = {c.lower() for c in self.spark.table(_quoted(layer)).columns}
                if after == there:
                    raise

    def _statement(self, schema: T.StructType, facts: dict) -> str:
        """The view: each layer without the partitions that a later one replaced. A layer all of which is replaced is not read."""
        keys, out = facts["partition_by"], []
        for k, layer in enumerate(facts["layers"]):
            later = [x["replaced"] for x in facts["layers"][k + 1 :]]
            if any(r is None for r in later):
                continue
            known = {c.lower() for c in layer["columns"]}
            columns = []
            for f in schema:
                value = _column(f.name) if f.name.lower() in known else "NULL"
                columns.append(f"CAST({value} AS {f.dataType.simpleString()}) AS {_column(f.name)}")
            gone = sorted({tuple(p) for r in later for p in r}, key=str)
            where = " AND ".join("NOT (" + " AND ".join(f"{_column(c)} <=> {_literal(v, schema[c].dataType)}" for c, v in zip(keys, p)) + ")" for p in gone)
            out.append(f"SELECT {', '.join(columns)} FROM {_quoted(layer['table'])}" + (f" WHERE {where}" if where else ""))
        return " UNION ALL ".join(out)

    def _select(self, schema: T.StructType, facts: dict) -> DataFrame:
        return self.spark.sql(self._statement(schema, facts))

    def _partitions(self, rows: DataFrame, found: list, keys: list[str]) -> DataFrame:
        kind = T.StructType([T.StructField(f"_p{k}", rows.schema[c].dataType) for k, c in enumerate(keys)])
        some = small(self.spark.createDataFrame(found, kind))
        return rows.join(some, [rows[_column(c)].eqNullSafe(some[f"_p{k}"]) for k, c in enumerate(keys)], "left_semi")


def replay(spark: SparkSession, statements, tables: dict[str, StoredTable]) -> None:
    """Makes the changes of other tables, in order (rows of sort_statements()), on tables by the names that they have there. What has been
    made already is passed over."""
    for s in statements:
        table = tables.get(s["tablename"])
        if table is None:
            continue
        kind = T.StructType.fromDDL(f"c {s['type']}")[0].dataType
        if s["op"] == ADD:
            table.add_columns(T.StructType([T.StructField(s["column"], kind)]))
        elif table.schema[s["column"]].dataType != kind:
            table.retype([s["column"]])

"""Reshaping: transpose, key=value records, key-colon-value text, events, flattened XML."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import flat_names, joined, steps


def transpose(
    df: DataFrame, groups: list[str], name: str, value: str, columns: list[str], order: str, table: str | None = None
) -> DataFrame:
    """(group, name, value) rows to one row for each group with ``columns`` in their order.

    A name that isn't among the columns is left out, and a group of nothing else with it. Of several
    values for one cell the last by ``order`` counts; an absent cell is an empty text. With
    ``table`` a column is added that names the table.
    """
    rows = df.filter(F.col(name).isin(columns))
    last = F.max_by(F.coalesce(F.col(value).cast("string"), F.lit("")), F.col(order))
    wide = rows.groupBy(*groups).pivot(name, columns).agg(last)
    out = wide.select(*groups, *(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns))
    return out.withColumn("tablename", F.lit(table)) if table else out


def transposed_cells(
    df: DataFrame, groups: list[str], table_fields: list[str], name: str, value: str, schemas: dict[str, list[str]], order: str,
    table_exp: str | None = None, name_exp: str | None = None,
) -> DataFrame:
    """(tablename, groups, cells): the groups of all tables of ``schemas`` in one pass, each with a map from name to value.

    A row's table is its ``table_fields`` joined by _, passed through ``table_exp`` (over ``tablename``) if given; names are mapped
    by ``name_exp``. Rows of unknown tables and names go. Whatever the number of tables, the input is read once; of each
    cell the last value is found before the first shuffle and after it, and cells, one of each, are brought together in the second.
    """
    routed = df.withColumn("tablename", F.concat_ws("_", *(F.col(f).cast("string") for f in table_fields)))
    routed = routed.withColumn("tablename", F.expr(table_exp)) if table_exp else routed
    routed = routed.withColumn(name, F.expr(name_exp)) if name_exp else routed
    pairs = [F.struct(F.lit(t).alias("t"), F.array(*map(F.lit, columns)).alias("c")) for t, columns in schemas.items()]
    known = F.map_from_entries(F.array(*pairs)) if pairs else F.expr("cast(map() as map<string, array<string>>)")
    rows = routed.filter(F.array_contains(F.try_element_at(known, F.col("tablename")), F.col(name)))
    last = F.max_by(F.coalesce(F.col(value).cast("string"), F.lit("")), F.col(order)).alias("_value")
    cells = rows.groupBy("tablename", *groups, F.col(name).alias("_name")).agg(last)
    entries = F.map_from_entries(F.collect_list(F.struct("_name", "_value")))  # a cell of each name, so that a group is as large as its row
    return cells.groupBy("tablename", *groups).agg(entries.alias("cells"))


def transpose_split_tables(
    df: DataFrame, groups: list[str], table_fields: list[str], name: str, value: str, schemas: dict[str, list[str]], order: str,
    table_exp: str | None = None, name_exp: str | None = None, folder: str | None = None,
) -> dict[str, DataFrame]:
    """A transpose for each table of ``schemas``, from transposed_cells(). With ``folder`` those are written there, once for all
    tables, each of which is then read from its own part."""
    cells = transposed_cells(df, groups, table_fields, name, value, schemas, order, table_exp, name_exp)
    if folder is not None:
        kind = cells.schema
        cells.write.partitionBy("tablename").parquet(folder)
        cells = df.sparkSession.read.schema(kind).parquet(folder)
    return {
        t: cells.filter(F.col("tablename") == t).select(*groups, *(F.coalesce(F.try_element_at("cells", F.lit(c)), F.lit("")).alias(c) for c in columns))
        for t, columns in schemas.items()
    }


#: Stand for an escaped backslash and escaped separators while a record is split: code points that no text may hold.
_BACKSLASH, _PAIR, _ASSIGN = "\ufdd0", "\ufdd1", "\ufdd2"


def _let(value: Column, of) -> Column:
    """``of`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _entries(c: Column, pair: str, assign: str) -> Column:
    """(key, value) of each entry in order, the last one of each key; null for a malformed record. Linear but for a sort by key."""
    text = c
    for before, after in (("\\\\", _BACKSLASH), (f"\\{pair}", _PAIR), (f"\\{assign}", _ASSIGN)):
        text = F.replace(text, F.lit(before), F.lit(after))
    text = F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def plain(x):
        for before, after in ((_PAIR, pair), (_ASSIGN, assign), (_BACKSLASH, "\\")):
            x = F.replace(x, F.lit(before), F.lit(after))
        return x

    parts = F.filter(F.split(text, re.escape(pair)), lambda p: F.trim(p) != "")
    cut = F.transform(parts, lambda p: F.split(p, re.escape(assign), 2))

    def placed(e, i):
        return F.struct(plain(F.trim(e[0])).alias("key"), i.alias("at"), plain(e[1]).alias("value"))

    def last(s):
        return F.filter(s, lambda x, i: ~F.coalesce(F.get(s, i + 1)["key"] == x["key"], F.lit(False)))

    def ordered(entries):
        by_place = F.array_sort(F.transform(_let(F.array_sort(F.transform(entries, placed)), last), lambda x: F.struct(x["at"], x["key"], x["value"])))
        return F.transform(by_place, lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))

    return _let(cut, lambda entries: F.when(F.forall(entries, lambda e: F.size(e) == 2), ordered(entries)))


def record_map(c: Column, pair: str = ",", assign: str = "=") -> Column:
    """A map from 'k=v,k=v'; a backslash keeps the next character from separating. Of a repeated key the last value counts, an entry
    without ``assign`` makes the record malformed (null)."""
    return F.map_from_entries(_entries(c, pair, assign))


def map_set(m: Column, key: str, value: Column, when_key: str | None = None) -> Column:
    """The map with a key set, always or only where ``when_key`` is present."""
    set_ = F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(F.lit(key), value))
    return set_ if when_key is None else F.when(F.map_contains_key(m, when_key), set_).otherwise(m)


def map_to_table(df: DataFrame, record: str, columns: list[str], table_key: str | None = None, table: str | None = None, default: str = "") -> DataFrame:
    """Records (a map column, or text for record_map) to columns by key; a missing key has the default. With ``table`` only records
    whose ``table_key`` has it. Malformed records go."""
    m = F.col(record) if dict(df.dtypes)[record].startswith("map") else record_map(F.col(record))
    # exploded from an array of one, a map is made once for all columns
    rows = df.select("*", F.explode(F.array(m)).alias("_map")).filter(F.col("_map").isNotNull())
    if table is not None:
        rows = rows.filter(F.try_element_at("_map", F.lit(table_key)) == table)
    out = [F.coalesce(F.try_element_at("_map", F.lit(c)), F.lit(default)).alias(c) for c in columns]
    others = [c for c in df.columns if c != record and c not in columns]
    return rows.select(*others, *out)


def kv_text_parse(c: Column, sort_keys: bool = True) -> Column:
    """Entries (key, value) of 'k=v,k2=v2', by key or in their order."""
    entries = _entries(c, ",", "=")
    return F.array_sort(entries) if sort_keys else entries


def kcv_to_table(records: DataFrame, text: str, names: list[str], pattern: str = r"^\s*(\S*)", keep_last: bool = True) -> DataFrame:
    """Key-colon-value records to columns. A record is split at colons; each part between two colons is a value followed by the next
    key, of which ``pattern`` group 1 is the value. The part behind the last colon is the last value (``keep_last``)."""
    parts = F.split(F.col(text), ":")
    inner = F.slice(parts, 2, F.size(parts) - 1 if keep_last else F.greatest(F.size(parts) - 2, F.lit(0)))
    values = F.transform(inner, lambda x: F.regexp_extract(x, pattern, 1))
    others = [c for c in records.columns if c != text]
    return records.select(*others, *(F.get(values, F.lit(k)).alias(n) for k, n in enumerate(names)))


def event_decode(df: DataFrame, kind: str, message: str, rules: dict[str, tuple[str, list[str]]], fields: list[str], default: tuple[str, list[str]] | None = None) -> DataFrame:
    """Named fields from a message by the pattern of its event type. ``rules``: type -> (pattern, the field of each group).

    The result has every field in its fixed order; a field that an event's pattern doesn't capture, or a message that doesn't match,
    gives an empty text."""
    def value(f):
        out = None
        for k, (pattern, names) in rules.items():
            if f in names:
                got = F.regexp_extract(message, pattern, names.index(f) + 1)
                out = F.when(F.col(kind) == k, got) if out is None else out.when(F.col(kind) == k, got)
        other = F.lit("")
        if default and f in default[1]:
            known = F.col(kind).isin(list(rules))
            other = F.when(~F.coalesce(known, F.lit(False)), F.regexp_extract(message, default[0], default[1].index(f) + 1)).otherwise("")
        return F.coalesce(out.otherwise(other) if out is not None else other, F.lit(""))

    others = [c for c in df.columns if c != message and c not in fields]
    return df.select(*others, *(value(f).alias(f) for f in fields))


def _opened(rows: DataFrame, root: Column, repeated: list[tuple], label: str, zipped: bool = False):
    """``rows`` with each repeated element below ``root`` opened, outer ones first, and a function that gives the value at a path."""
    aliases: dict[tuple, str] = {}

    def value(path: tuple) -> Column:
        known = max((r for r in aliases if path[: len(r)] == r), key=len, default=None)
        out = F.col(aliases[known]) if known is not None else root
        for step in path[len(known or ()) :]:
            out = out.getField(step)
        return out

    named = {r: f"{label}_{k}" for k, r in enumerate(sorted(dict.fromkeys(repeated), key=len))}
    if zipped and named:
        rows = rows.select("*", *(value(r).alias(a) for r, a in named.items()))
        rows = rows.withColumn(f"{label}_each", F.explode_outer(F.arrays_zip(*named.values()))).drop(*named.values())
        rows = rows.select("*", *(F.col(f"{label}_each").getField(a).alias(a) for a in named.values())).drop(f"{label}_each")
        aliases.update(named)
    else:
        for r, a in named.items():
            rows = rows.withColumn(a, F.explode_outer(value(r)))
            aliases[r] = a
    return rows, value


def xml_flatten(
    df: DataFrame, xml: str, schema: str | T.StructType, paths: dict[str, str], repeated: tuple[str, ...] = (), zipped: bool = False,
    keep: str | None = None, set_values: dict[str, str] | None = None,
) -> DataFrame:
    """A table from XML documents: ``schema`` is the row element's, ``paths`` give each column's path in it.

    A path's steps are parted by dots; a name that holds a dot is put in back-quotes. ``repeated`` lists the paths of repeated
    elements, each opened to its own rows: every one against the others, or zipped side by side. A path within another opens its
    elements within that one's rows. Documents without them keep one row. An element that the schema takes for a string
    is its XML text. ``keep`` is a predicate over the flattened columns, applied before ``set_values`` (expressions over them).
    """
    rows = df.withColumn("_row", F.from_xml(F.col(xml), schema))
    rows, value = _opened(rows, F.col("_row"), [steps(r) for r in repeated], "_each", zipped)
    others = [_quoted(c) for c in df.columns if c != xml and c not in paths]
    out = rows.select(*others, *(value(steps(p)).alias(c) for c, p in paths.items()))
    out = xml_insert_filter(out, keep) if keep else out
    return out.withColumns({c: F.expr(e) for c, e in set_values.items()}) if set_values else out


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class XmlTable:
    """A table within XML documents, by paths from their root (attributes begin with _): a row for each element at ``start``.

    Its columns are the values within, named as flat_names() names them, but for the nodes in ``skip``; a node in ``raw`` is
    one column with its XML text. ``associate`` adds values from elsewhere in the document, by column.
    Siblings that repeat give every combination. A name that holds a dot is put in back-quotes in a path.
    """

    start: str
    raw: tuple[str, ...] = ()
    skip: tuple[str, ...] = ()
    associate: dict[str, str] = field(default_factory=dict)
    keep: str | None = None
    set_values: dict[str, str] | None = None

    def read(self, schema: T.StructType) -> tuple[T.StructType, list[tuple], dict[str, tuple]]:
        """The part of the documents' schema that this table reads, its repeated paths, and its columns' paths."""
        start, raw, skip = steps(self.start), set(map(steps, self.raw)), set(map(steps, self.skip))
        wanted = set(map(steps, self.associate.values()))
        arrays: list[tuple] = []
        leaves: list[tuple] = []

        def taken(kind, path):
            if any(path[: len(x)] == x for x in skip):
                return None
            if path and path in raw:
                leaves.append(path)
                if isinstance(kind, T.ArrayType):
                    arrays.append(path)
                    return T.ArrayType(T.StringType())
                return T.StringType()
            if isinstance(kind, T.ArrayType):
                inner = taken(kind.elementType, path)
                if inner is not None:
                    arrays.append(path)
                return inner and T.ArrayType(inner)
            if isinstance(kind, T.StructType):
                fields = [(f.name, taken(f.dataType, (*path, f.name))) for f in kind]
                fields = [T.StructField(n, k) for n, k in fields if k is not None]
                return T.StructType(fields) if fields else None
            own = path[: len(start)] == start
            if own:
                leaves.append(path)
            return kind if own or path in wanted else None

        pruned = taken(schema, ())
        if not leaves:
            raise ValueError(f"nothing at {self.start!r}")
        names = flat_names(pruned)
        return pruned, arrays, {c: steps(p) for c, p in self.associate.items()} | {names[joined(p)]: p for p in leaves}


def _both(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """A type from which both can be read, None where one takes for text what the other opens."""
    if a == b:
        return a
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = _both(a.elementType, b.elementType)
        return inner and T.ArrayType(inner)
    if not (isinstance(a, T.StructType) and isinstance(b, T.StructType)):
        return None
    fields = {f.name: f.dataType for f in a}
    for f in b:
        fields[f.name] = _both(fields[f.name], f.dataType) if f.name in fields else f.dataType
        if fields[f.name] is None:
            return None
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


def xml_records(df: DataFrame, xml: str, schema: T.StructType, tables: dict[str, XmlTable]) -> DataFrame:
    """The records of several tables from the same XML documents, which are read and parsed once: the other columns of ``df``,
    ``tablename``, and for each table a column of its name with the record, null in the others' rows.

    Only what some table reads is parsed. Tables of which one takes for text what another opens can't share a parse; they
    make one more. ``keep`` and ``set_values`` are left to xml_tables(). A null or unreadable document gives no row. A start
    that the schema lacks is an error.
    """
    reads = {name: table.read(schema) for name, table in tables.items()}
    parses: list[T.StructType] = []
    of = {}
    for name, (pruned, _, _) in reads.items():
        for k, parse in enumerate(parses):
            both = _both(parse, pruned)
            if both is not None:
                parses[k], of[name] = both, k
                break
        else:
            of[name] = len(parses)
            parses.append(pruned)
    others = [_quoted(c) for c in df.columns if c != xml]
    docs = df.filter(F.col(xml).isNotNull()).select(*others, *(F.from_xml(F.col(xml), p).alias(f"_doc{k}") for k, p in enumerate(parses)))
    routes = F.explode(F.array(*map(F.lit, tables))).alias("tablename")
    rows = docs.select("*", routes)
    records, there = [], F.lit(False)
    for k, (name, (_, arrays, paths)) in enumerate(reads.items()):
        mine = F.col("tablename") == name
        # null in the rows of other tables, so that opening it leaves those alone
        rows = rows.withColumn(f"_own{k}", F.when(mine, F.col(f"_doc{of[name]}")))
        rows, value = _opened(rows, F.col(f"_own{k}"), arrays, f"_each{k}")
        there = there | (mine & value(steps(tables[name].start)).isNotNull())
        records.append(F.when(mine, F.struct(*(value(p).alias(c) for c, p in paths.items()))).alias(name))
    return rows.filter(there).select(*others, "tablename", *records)


def xml_tables(df: DataFrame, xml: str, schema: T.StructType, tables: dict[str, XmlTable], folder: str | None = None) -> dict[str, DataFrame]:
    """Several tables from the same XML documents, ``schema`` being the documents' (discover_xml_schema()).

    With ``folder`` the records of all tables are written there in one pass, from which the tables are then read, each its own
    part. Without, a table parses the documents when it is used, and only what it reads of them. A null or unreadable document
    gives no row. A start that the schema lacks is an error.
    """
    if folder is not None:
        xml_records(df, xml, schema, tables).write.partitionBy("tablename").parquet(folder)
    out = {}
    for name, table in tables.items():
        if folder is not None:
            records = df.sparkSession.read.parquet(folder)
        else:
            records = xml_records(df, xml, schema, {name: table})
        others = [c for c in df.columns if c != xml]
        columns = [c for c in table.read(schema)[2]]
        flat = records.filter(F.col("tablename") == name)
        flat = flat.select(*(_quoted(c) for c in others if c not in columns), *(F.col(_quoted(name)).getField(c).alias(c) for c in columns))
        flat = xml_insert_filter(flat, table.keep) if table.keep else flat
        out[name] = flat.withColumns({c: F.expr(e) for c, e in table.set_values.items()}) if table.set_values else flat
    return out


def xml_insert_filter(df: DataFrame, predicate: str) -> DataFrame:
    """Flattened records that the predicate holds for."""
    return df.filter(F.expr(predicate))


def xml_measurements(
    df: DataFrame, types: str, values: str, columns: list[str], group: list[str] = (), object_name: str = "measObjLdn", result: str = "r",
    skip: tuple[str, ...] = (), with_value: tuple[str, ...] = (),
) -> DataFrame:
    """Measurement documents to a row for each object: ``types`` is the array of measurement names, ``values`` the array of
    objects, each with its name and its results in the order of the names. Names absent from a document are empty.

    The object's name ('k1=v1,k2=v2') gives the columns ``object_keys`` and ``tablename``: its keys in order, joined by _, but for
    those in ``skip``; a key in ``with_value`` is followed by its value.
    """
    rows = df.select(*group, F.col(types).alias("_types"), F.explode(F.col(values)).alias("_v"))
    entries = F.filter(F.array_sort(_entries(F.col(f"_v.{object_name}"), ",", "=")), lambda e: ~e["key"].isin(*skip))
    parts = F.transform(entries, lambda e: F.when(e["key"].isin(*with_value), F.concat_ws("_", e["key"], e["value"])).otherwise(e["key"]))

    def cell(c):
        at = F.array_position("_types", c)
        return F.when(at > 0, F.get(F.col(f"_v.{result}"), (at - 1).cast("int")))

    return rows.select(
        *group,
        F.col(f"_v.{object_name}").alias("object_keys"),
        F.array_join(parts, "_").alias("tablename"),
        *(F.coalesce(cell(c).cast("string"), F.lit("")).alias(c) for c in columns),
    )

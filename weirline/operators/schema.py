"""Schema discovery and evolution: distributed passes over the data, small results on the driver."""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone
from xml.parsers import expat

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_identifier, identifier
from ..sources.commits import at, publish, read_text


class Conflict(Exception):
    """Another job has changed the table since this one read it."""


class Registry:
    """Table schemas and how they came about: for each table a folder of numbered versions, the last of which holds.

    A version is a JSON text: the schema, the time, the changes from the version before, and what else its writer keeps in
    ``facts``. Versions are never overwritten: a version is published by a rename that fails where it exists already, so
    of two jobs that change one table at once, one gets a Conflict.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def version(self, table: str) -> int:
        """The number of the last version, 0 where there is none."""
        path, fs = at(self.spark, f"{self.folder}/{identifier(table)}")
        if not fs.exists(path):
            return 0
        numbers = [re.fullmatch(r"v(\d+)\.json", s.getPath().getName()) for s in fs.listStatus(path)]
        return max((int(n[1]) for n in numbers if n), default=0)

    def entry(self, table: str, version: int | None = None) -> dict:
        """A version's JSON (the last one's); KeyError where there is none."""
        version = self.version(table) if version is None else version
        if not version:
            raise KeyError(f"no schema of {table!r}")
        return json.loads(read_text(self.spark, self._file(table, version)))

    def _file(self, table: str, version: int) -> str:
        return f"{self.folder}/{identifier(table)}/v{version:012d}.json"

    def put(self, table: str, schema: T.StructType, expected: int | None = None, changes: list[dict] = (), **facts) -> int:
        """A new version after ``expected``, or after whichever is the last; its number. ``changes`` have op, column and type."""
        while True:
            version = (self.version(table) if expected is None else expected) + 1
            now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
            body = {"table": table, "version": version, "at": now, "schema": schema.jsonValue(), "changes": list(changes), "facts": facts}
            if publish(self.spark, self._file(table, version), json.dumps(body)):
                return version
            if expected is not None:
                raise Conflict(f"{table!r} has a version {version} already")

    def get(self, table: str) -> T.StructType:
        return T.StructType.fromJson(self.entry(table)["schema"])

    def find(self, table: str) -> T.StructType | None:
        """The table's schema, or None where there is none yet."""
        version = self.version(table)
        return T.StructType.fromJson(self.entry(table, version)["schema"]) if version else None

    def grow(self, table: str, seen: T.StructType) -> T.StructType:
        """The table's schema with the attributes of ``seen`` that it lacked, also where other jobs add theirs at the same time."""
        while True:
            version = self.version(table)
            known = T.StructType.fromJson(self.entry(table, version)["schema"]) if version else T.StructType([])
            grown, new = evolve_add_columns(known, seen)
            if version and not new:
                return known
            changes = [{"op": ADD, "column": f.name, "type": f.dataType.simpleString()} for f in new] if version else []
            try:
                self.put(table, grown, version, changes)
                return grown
            except Conflict:
                continue

    def statements(self) -> DataFrame:
        """(at, tablename, version, n, op, column, type, statement) of every change of every table, unordered."""
        kind = "table string, version long, at string, changes array<struct<op: string, column: string, type: string>>"
        rows = self.spark.read.text(f"{self.folder}/*/v*.json", wholetext=True).select(F.from_json("value", kind).alias("j")).select("j.*")
        rows = rows.select(F.to_timestamp("at").alias("at"), F.col("table").alias("tablename"), "version", F.posexplode("changes").alias("n", "c"))
        name = lambda c: F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`"))
        table, column = F.concat(F.lit("ALTER TABLE "), name(F.col("tablename"))), name(F.col("column"))
        add = F.concat(table, F.lit(" ADD COLUMNS ("), column, F.lit(" "), "type", F.lit(")"))
        retype = F.concat(table, F.lit(" ALTER COLUMN "), column, F.lit(" TYPE "), "type")
        made = rows.select("at", "tablename", "version", "n", "c.*")
        return made.withColumn("statement", F.when(F.col("op") == ADD, add).otherwise(retype))


ADD, RETYPE = "add", "retype"


def sort_statements(statements: DataFrame) -> DataFrame:
    """Schema changes in the order in which they were made: by time, those of one time by table and version."""
    return statements.orderBy("at", "tablename", "version", "n")


def changed_schema(schema: T.StructType, statements) -> T.StructType:
    """The schema after changes (rows with op, column, type) in order. One that has been made already changes nothing."""
    fields = {f.name.lower(): f for f in schema}
    for s in statements:
        kind = T.StructType.fromDDL(f"c {s['type']}")[0].dataType
        key = s["column"].lower()
        if s["op"] == RETYPE and key in fields:
            fields[key] = T.StructField(fields[key].name, kind)
        elif s["op"] == ADD and key not in fields:
            fields[key] = T.StructField(s["column"], kind)
    return T.StructType(list(fields.values()))


def infer_field_types(df: DataFrame, timestamps: bool = True) -> DataFrame:
    """(name, type) of each text column over all of the data, as one row for each column.

    numeric(15,5) if every non-blank value is a number, else varchar of twice the longest value and 20
    at least; a name that ends in time with values of more than 8 characters is a timestamp.
    """
    text = {c: F.trim(F.col(f"`{c}`").cast("string")) for c in df.columns}
    facts = []
    for k, t in enumerate(text.values()):
        blank = t.isNull() | (t == "")
        facts += [
            F.coalesce(F.bool_and(F.when(~blank, t.try_cast("double").isNotNull())), F.lit(False)).alias(f"n{k}"),
            F.coalesce(F.max(F.char_length(t)), F.lit(0)).alias(f"l{k}"),
        ]
    one = df.agg(*facts)
    rows = F.array(
        *(F.struct(F.lit(c).alias("name"), F.col(f"n{k}").alias("number"), F.col(f"l{k}").alias("longest")) for k, c in enumerate(df.columns))
    )
    timed = F.lower("name").endswith("time") & (F.col("longest") > 8) if timestamps else F.lit(False)
    kind = (
        F.when(timed, "timestamp")
        .when(F.col("number"), "numeric(15,5)")
        .otherwise(F.concat(F.lit("varchar("), F.greatest(F.lit(20), F.col("longest") * 2).cast("string"), F.lit(")")))
    )
    return one.select(F.explode(rows).alias("r")).select("r.*").select("name", kind.alias("type"))


def evolve_add_columns(schema: T.StructType, seen: T.StructType) -> tuple[T.StructType, list[T.StructField]]:
    """The schema with the attributes it lacks appended in the order seen, and those."""
    known = {f.name.lower() for f in schema}
    new = [f for f in seen if f.name.lower() not in known]
    return T.StructType([*schema, *new]), new


def _named(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def evolve_retype(df: DataFrame, schema: T.StructType) -> tuple[T.StructType, list[str]]:
    """Number columns in which the data carries text become text; the schema and their names. One pass over the data."""
    numbers = [f.name for f in schema if isinstance(f.dataType, T.NumericType) and f.name in df.columns and not isinstance(df.schema[f.name].dataType, T.NumericType)]
    if not numbers:
        return schema, []
    texts = {c: F.trim(_named(c).cast("string")) for c in numbers}
    odd = df.agg(*(F.bool_or((v != "") & v.try_cast("double").isNull()).alias(f"c{k}") for k, v in enumerate(texts.values()))).first()
    changed = [c for k, c in enumerate(numbers) if odd[k]]
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in changed else f for f in schema]), changed


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table under an evolved schema: columns in its order, missing ones null, values that don't fit null."""
    return df.select(
        *((_named(f.name).cast("string").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema)
    )


def steps(path: str) -> tuple[str, ...]:
    """The names along a path: parted by dots, a name that holds one in back-quotes (doubled within)."""
    return tuple(quoted.replace("``", "`") or plain for quoted, plain in re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", path))


def joined(names: tuple[str, ...]) -> str:
    """The path of names, as steps() takes it apart."""
    return ".".join("`" + n.replace("`", "``") + "`" if "." in n or "`" in n else n for n in names)


def flat_names(schema: T.StructType) -> dict[str, str]:
    """A column name for each leaf path of a nested schema. A name found under several parents becomes name_4_parent, then
    name_4_parent_4_grandparent and so on until it is the only one; attributes are marked _Attri_."""
    paths: list[list[str]] = []

    def walk(kind, path):
        if isinstance(kind, T.ArrayType):
            walk(kind.elementType, path)
        elif isinstance(kind, T.StructType):
            for f in kind:
                walk(f.dataType, [*path, f.name])
        else:
            paths.append(path)

    walk(schema, [])

    def name(path, depth):
        leaf = path[-1]
        base = f"_Attri_{leaf[1:]}" if leaf.startswith("_") and leaf != "_VALUE" else leaf
        if leaf == "_VALUE" and len(path) > 1:
            base, path = path[-2], path[:-1]
        return identifier("_4_".join([base, *reversed(path[max(0, len(path) - 1 - depth) : -1])]))

    depth = {joined(p): 0 for p in paths}
    while True:
        names = {joined(p): name(p, depth[joined(p)]) for p in paths}
        counts: dict[str, int] = {}
        for n in names.values():
            counts[n] = counts.get(n, 0) + 1
        again = [joined(p) for p in paths if counts[names[joined(p)]] > 1 and depth[joined(p)] < len(p)]
        if not again:
            break
        for k in again:
            depth[k] += 1
    taken: set[str] = set()
    for path, n in names.items():  # names that differ only in signs that no column has
        k, own = 2, n
        while own.lower() in taken:
            k, own = k + 1, f"{n}_{k}"
        names[path] = own
        taken.add(own.lower())
    return names


#: Kinds of a value, each taking in those before it.
_EMPTY, _WHOLE, _NUMBER, _TEXT = range(4)
_WHOLE_LOOK, _NUMBER_LOOK = re.compile(r"\s*-?[0-9]{1,18}\s*"), re.compile(r"\s*-?[0-9]*[.][0-9]+\s*")


def _kind(text: str) -> int:
    if not text.strip():
        return _EMPTY
    return _WHOLE if _WHOLE_LOOK.fullmatch(text) else _NUMBER if _NUMBER_LOOK.fullmatch(text) else _TEXT


def _facts(xml: str, facts: dict) -> None:
    """Adds each path of a document, below its root, with the kind of its value and whether it repeats beside itself.
    Facts of a document that isn't well formed are left out."""
    own: dict = {}
    open_: list[list] = []  # of each open element: path, how often each child came, text, whether it has parts

    def note(path, kind, repeated=False):
        old = own.get(path, (_EMPTY, False))
        own[path] = max(old[0], kind), old[1] or repeated

    def start(name, attributes):
        path = ()
        if open_:
            above = open_[-1]
            above[3], count = True, above[1].get(name, 0) + 1
            above[1][name], path = count, (*above[0], name)
            note(path, _EMPTY, count > 1)
        for key, value in attributes.items():
            note((*path, f"_{key}"), _kind(value))
        open_.append([path, {}, [], bool(attributes)])

    def end(_):
        path, _, text, parts = open_.pop()
        kind = _kind("".join(text))
        if parts and kind != _EMPTY:
            note((*path, "_VALUE"), kind)
        elif not parts and path:
            note(path, kind)

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler = lambda data: open_[-1][2].append(data)
    try:
        parser.Parse(xml, True)
    except expat.ExpatError:
        return
    for path, (kind, repeated) in own.items():
        old = facts.get(path, (_EMPTY, False))
        facts[path] = max(old[0], kind), old[1] or repeated


#: Characters of a text that is plain: allowed in XML, of no meaning in it, and no quote.
_PLAIN = r"[ !#-%(-;=?-~\t\n\r\x{80}-\x{D7FF}]"
#: A start tag up to its end: without attributes, or behind the quote of the last one.
_START = r"""(<[A-Za-z_][^<>"'/&\s]*|<[A-Za-z_][^<>&]*["'])>"""
#: Texts of elements and values of attributes, and what takes their place, of one kind with them. A value has no = in it, so that what is
#: between two quotes is one.
_WHOLE_TEXT, _NUMBER_TEXT, _WORD_TEXT = r"-?[0-9]{1,18}", r"-?[0-9]*[.][0-9]+", r"%s*[A-Za-z]%s*"
_KINDS = [(_WHOLE_TEXT, "0"), (_NUMBER_TEXT, "0.0"), (_WORD_TEXT % (_PLAIN, _PLAIN), "x")]
_VALUES = [*_KINDS[:2], (_WORD_TEXT % ((_PLAIN.replace("=", ""),) * 2), "x")]
_ALIKE = [(f"{_START}{look}</", rf"\1>{short}</") for look, short in _KINDS]
_ALIKE += [(f"={q}{look}{q}", f"={q}{short}{q}") for q in "\"'" for look, short in _VALUES]
#: Shapes of documents that a task remembers, and the length up to which it does.
SHAPES, SHAPE_CHARS = 20_000, 4_000


def _shapes(texts):
    """The distinct documents of an Arrow column with values shortened to one of their kind: what _facts() tells of them stays. Documents
    with declarations, comments or character data are left as they are."""
    texts = pc.unique(texts.cast(pa.large_string()).drop_null())
    marked = pc.or_(pc.match_substring(texts, "<!"), pc.match_substring(texts, "<?"))
    plain = texts.filter(pc.invert(marked))
    for pattern, short in _ALIKE:
        plain = pc.replace_substring_regex(plain, pattern, short)
    return [*texts.filter(marked).to_pylist(), *pc.unique(plain).to_pylist()]


def discover_xml_schema(df: DataFrame, xml: str) -> T.StructType:
    """The nested schema of all XML documents of a column, fields by name.

    Tasks read the documents, those that differ in nothing but values of one kind once (_shapes()), and give each path once with the kind of its values (whole number, number, text) and
    whether it repeats; what reaches the driver is as many rows as the schema has paths. Attributes begin with _,
    text beside attributes or elements is _VALUE. Nulls and documents that aren't well formed say nothing; an
    empty table has an empty schema.
    """
    def run(batches):
        facts: dict = {}
        seen: set = set()
        for b in batches:
            for text in _shapes(b.column(0)):
                if text not in seen:
                    _facts(text, facts)
                    if len(seen) < SHAPES and len(text) <= SHAPE_CHARS:
                        seen.add(text)
        names = ["path", "kind", "repeated"]
        columns = [[list(p) for p in facts], [k for k, _ in facts.values()], [r for _, r in facts.values()]]
        kinds = [pa.list_(pa.string()), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    found = df.select(F.col(xml).cast("string")).mapInArrow(run, "path array<string>, kind int, repeated boolean")
    merged = found.groupBy("path").agg(F.max("kind").alias("kind"), F.max("repeated").alias("repeated"))
    tree: dict = {}
    for path, kind, repeated in merged.collect():  # bounded by the schema
        node = tree
        for name in path:
            node = node.setdefault("parts", {}).setdefault(name, {})
        node["kind"], node["repeated"] = kind, repeated
    kinds = {_EMPTY: T.StringType(), _WHOLE: T.LongType(), _NUMBER: T.DoubleType(), _TEXT: T.StringType()}

    def typed(node):
        if "parts" in node:
            if node.get("kind", _EMPTY) != _EMPTY:  # text alone in some documents, with parts in others
                own = node["parts"].setdefault("_VALUE", {"kind": _EMPTY})
                own["kind"] = max(own["kind"], node["kind"])
            kind = T.StructType([T.StructField(n, typed(p)) for n, p in sorted(node["parts"].items())])
        else:
            kind = kinds[node["kind"]]
        return T.ArrayType(kind) if node.get("repeated") else kind

    return typed(tree) if tree else T.StructType()


def discover_stat_schema(df: DataFrame, group: str, register: str, description: str, order: str) -> DataFrame:
    """(tablename, pos, name, type) from statistics rows: a table for each group, a column for each register.

    The common columns come first; a register's column is its number and its cleaned first description.
    """
    first = df.groupBy(F.col(group).cast("string").alias("tablename"), F.col(register).alias("reg")).agg(
        F.min_by(description, order).alias("d")
    )
    name = F.concat(F.lit("R"), F.col("reg").cast("string"), F.lit("_"), clean_identifier("d"))
    w = W.partitionBy("tablename").orderBy("reg")
    columns = first.select("tablename", (F.row_number().over(w) + 2).alias("pos"), name.alias("name"), F.lit("numeric(30,2)").alias("type"))
    common = F.array(
        *(F.struct(F.lit(k).alias("pos"), F.lit(n).alias("name"), F.lit(t).alias("type")) for k, (n, t) in enumerate(
            (("COLLECT_DATETIME", "timestamp"), ("SITE", "varchar(20)"), ("CPUID", "varchar(20)"))))
    )
    heads = first.select("tablename").distinct().select("tablename", F.explode(common).alias("c")).select("tablename", "c.*")
    return heads.unionByName(columns)


def schema_from_dictionary(
    df: DataFrame, order: str, table: str, name: str, kind: str, size: str, aggregation: str | None = None, separator: str = ";"
) -> DataFrame:
    """(tablename, pos, name, type, aggregation) from a data dictionary, one row for each field.

    Blank tables are filled down from the row above; a cell may list several fields at ``separator``,
    with as many types and sizes or one for all. Names are cleaned, and a name that comes again in its
    table (whatever its case) gets a _ for each earlier one. The dictionary is one document: a bounded table.
    """
    filled = F.last(F.nullif(F.trim(F.col(table)), F.lit("")), ignorenulls=True).over(W.partitionBy(F.lit(0)).orderBy(order))
    rows = df.withColumn("tablename", clean_identifier(filled)).filter(F.col("tablename").isNotNull())

    def part(c, k):
        parts = F.split(F.coalesce(F.col(c).cast("string"), F.lit("")), separator)
        return F.trim(F.coalesce(F.get(parts, k), F.element_at(parts, -1)))

    each = rows.select("*", F.posexplode(F.split(F.col(name), separator)).alias("_k", "_name")).filter(F.trim("_name") != "")
    n = clean_identifier("_name")
    again = F.row_number().over(W.partitionBy("tablename", F.lower(n)).orderBy(order, "_k")) - 1
    k = F.lower(part(kind, F.col("_k")))
    width = part(size, F.col("_k"))
    typed = (
        F.when(k.rlike("time|date"), "timestamp")
        .when(k.rlike("int|num|float|double|counter|gauge"), F.lit("numeric(15,5)"))
        .otherwise(F.concat(F.lit("varchar("), F.coalesce(F.nullif(width, F.lit("")), F.lit("20")), F.lit(")")))
    )
    agg = part(aggregation, F.col("_k")) if aggregation else F.lit("")
    return each.select(
        "tablename",
        (F.row_number().over(W.partitionBy("tablename").orderBy(order, "_k")) - 1).alias("pos"),
        F.concat(F.repeat(F.lit("_"), again), n).alias("name"),
        typed.alias("type"),
        F.when(F.upper(agg).isin("SUM", "AVG", "COUNT", "MIN", "MAX"), F.upper(agg)).otherwise("NONE").alias("aggregation"),
    )


def ddl(columns: DataFrame) -> dict[str, str]:
    """Spark DDL of each table of (tablename, pos, name, type)."""
    kind = F.regexp_replace(F.col("type"), "^numeric", "decimal")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(" ", F.concat(F.lit("`"), "name", F.lit("`")), kind).alias("d")))), lambda x: x["d"]), ", ")
    return {r[0]: r[1] for r in columns.groupBy("tablename").agg(text).collect()}

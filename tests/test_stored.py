"""Stored tables: several jobs at once, failures in between, and what readers see."""

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirline.operators import schema
from weirline.sources.stored import StoredTable, replay


@pytest.fixture
def known(spark, tmp_path):
    return schema.Registry(spark, f"file://{tmp_path}/registry")


@pytest.fixture
def make(spark, known):
    made = []

    def new(kind, *keys):
        made.append(StoredTable(spark, known, f"st_{uuid.uuid4().hex[:10]}").create(T.StructType.fromDDL(kind), keys))
        return made[-1]

    yield new
    for table in made:
        table.drop()


def rows(df, *names):
    return sorted(map(tuple, df.select(*names or df.columns).collect()), key=repr)


def test_versions_are_never_overwritten(spark, known):
    kind = T.StructType.fromDDL("a bigint")
    assert known.put("t", kind) == 1 and known.version("t") == 1 and known.find("none") is None
    with pytest.raises(schema.Conflict):
        known.put("t", kind, 0)
    with ThreadPoolExecutor(6) as jobs:
        list(jobs.map(lambda k: known.grow("t", T.StructType.fromDDL(f"c{k} string")), range(12)))
    assert set(known.get("t").names) == {"a", *(f"c{k}" for k in range(12))} and known.version("t") == 13
    with pytest.raises(KeyError):
        known.get("none")


def test_columns_added_at_once_all_stay(spark, known, make):
    table = make("k bigint, p string", "p")
    table.append(spark.createDataFrame([(1, "x")], "k long, p string"))
    with ThreadPoolExecutor(4) as jobs:
        added = list(jobs.map(lambda c: StoredTable(spark, known, table.name).add_columns(T.StructType.fromDDL(f"`{c}` string, K int")), ["a", "b-c", "d.e", "a"]))
    assert sorted(map(len, added)) == [0, 1, 1, 1]
    table.append(spark.createDataFrame([(2, "y", "v")], "k long, p string, `d.e` string"))
    assert rows(table.read(), "k", "p", "a", "`b-c`", "`d.e`") == [(1, "x", None, None, None), (2, "y", None, None, "v")]


def test_retype_rewrites_only_partitions_with_values(spark, known, make):
    table = make("k bigint, c double, p string", "p")
    table.append(spark.createDataFrame([(1, 1.5, "x"), (2, None, "y"), (3, None, None)], "k long, c double, p string"))
    before = table.read()
    assert before.schema["c"].dataType == T.DoubleType()
    table.append(spark.createDataFrame([(4, "n/a", "y"), (5, "7", "z'\\")], "k long, c string, p string"))
    want = [(1, "1.5", "x"), (2, None, "y"), (3, None, None), (4, "n/a", "y"), (5, "7", "z'\\")]
    assert rows(table.read(), "k", "c", "p") == want and table.schema["c"].dataType == T.StringType()
    layers = known.entry(table.name)["facts"]["layers"]
    assert [x["replaced"] for x in layers] == [[], [["x"]]]
    # a plan made before still reads the old layer, whole
    assert rows(before, "k", "c", "p") == [(1, 1.5, "x"), (2, None, "y"), (3, None, None)]
    table.append(spark.createDataFrame([(6, "q", "x")], "k long, c string, p string"))
    assert rows(table.read(), "k", "c", "p") == [*want, (6, "q", "x")]


def test_a_failed_rewrite_leaves_the_old_table(spark, known, make):
    table = make("k bigint, c bigint")
    table.append(spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("c")))
    version, tables = known.version(table.name), len(spark.catalog.listTables())

    def half(new, layer):
        new.limit(10).write.insertInto(layer)
        assert table.read().count() == 50  # a reader in between
        raise OSError("the disk is full")

    with pytest.raises(OSError):
        table.retype(["c"], rewrite=half)
    assert (known.version(table.name), len(spark.catalog.listTables())) == (version, tables)
    assert table.read().agg(F.sum("c")).first()[0] == sum(range(50))
    table.retype(["c"])
    assert table.read().schema["c"].dataType == T.StringType() and table.read().count() == 50
    table.drop_replaced()
    assert table.read().count() == 50


def test_rows_appended_during_a_rewrite_are_not_lost(spark, known, make):
    table = make("k bigint, c bigint")
    table.append(spark.createDataFrame([(1, 1)], "k long, c long"))
    tries = []

    def rewrite(new, layer):
        new.write.insertInto(layer)
        tries.append(layer)
        if len(tries) == 1:
            other = threading.Thread(target=lambda: StoredTable(spark, known, table.name).append(spark.createDataFrame([(2, 2)], "k long, c long")))
            other.start()
            other.join()

    table.retype(["c"], rewrite=rewrite)
    assert len(tries) == 2 and rows(table.read(), "k", "c") == [(1, "1"), (2, "2")]


def test_statements_are_logged_in_order_and_replayed(spark, known, make):
    first, second = make("a bigint, n bigint"), make("a bigint, n bigint")
    first.add_columns(T.StructType.fromDDL("`x y` string, b decimal(10,2)"))
    first.append(spark.createDataFrame([("z",)], "n string"))
    log = [r for r in schema.sort_statements(known.statements()).collect() if r.tablename == first.name]
    assert [r.statement.split("` ", 1)[1] for r in log] == ["ADD COLUMNS (`x y` string)", "ADD COLUMNS (`b` decimal(10,2))", "ALTER COLUMN `n` TYPE string"]
    assert [(r.op, r.column) for r in log] == [("add", "x y"), ("add", "b"), ("retype", "n")]
    for _ in range(2):
        replay(spark, log, {first.name: second})
    assert second.schema == first.schema and second.read().schema["n"].dataType == T.StringType()
    assert schema.changed_schema(T.StructType.fromDDL("a bigint, n bigint"), log) == first.schema


def test_a_table_is_made_once(spark, known, make):
    table = make("a bigint")
    with pytest.raises(schema.Conflict):
        StoredTable(spark, known, table.name).create(T.StructType.fromDDL("b bigint"))
    assert table.read().columns == ["a"]

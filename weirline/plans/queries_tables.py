"""Registered queries of the column, routing, merging, aggregating and SQL operators, and of the scalar functions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import aggregates, columns, merging, routing, schema
from ..operators.aggregates import Op
from . import registry
from .scratch import written

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return put


def t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timed(spark, sf_dir, name, column):
    """The table with a time column as a timestamp of the session's zone, which is UTC."""
    return t(spark, sf_dir, name).withColumn(column, F.col(column).cast("timestamp"))


def rounded(df, *names, digits=2):
    return df.withColumns({n: F.round(n, digits) for n in names})


def messy_lines(spark, sf_dir):
    """Line items with quantity and price as text, of which some are blank and some no numbers."""
    odd = F.col("l_orderkey") % 7
    return t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus",
        F.when(odd == 0, "").when(odd == 1, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("qty"),
        F.when(odd == 2, " ").otherwise(F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"))).alias("price"),
        (F.lit(0) - F.col("l_quantity")).cast("string").alias("neg"),
    )


MESSY = """(SELECT l_orderkey, l_returnflag, l_linestatus,
  CASE WHEN l_orderkey % 7 IN (0, 1) THEN NULL ELSE l_quantity END AS q,
  CASE WHEN l_orderkey % 7 = 2 THEN NULL ELSE l_extendedprice END AS p, -l_quantity AS neg FROM lineitem)"""


@query(f"""SELECT l_returnflag, l_linestatus, round(sum(coalesce(q, 0)), 2) AS qty, round(sum(coalesce(p, 0)), 2) AS price,
  count(*) AS cnt FROM {MESSY} GROUP BY 1, 2""")
def agg_sum_lenient(spark, d):
    out = aggregates.aggregate(messy_lines(spark, d), "1-2", [Op("sum", "3-4"), Op("count")])
    return rounded(out, "qty", "price")


@query(f"""SELECT l_returnflag, round(sum(coalesce(q, 0)) / count(*), 4) AS qty FROM {MESSY} GROUP BY 1""")
def agg_avg_lenient(spark, d):
    return rounded(aggregates.aggregate(messy_lines(spark, d), ["l_returnflag"], [Op("avg", ["qty"])]), "qty", digits=4)


@query(f"""SELECT l_returnflag, greatest(max(coalesce(q, 0)), 0) AS qty, greatest(max(neg), 0) AS neg FROM {MESSY} GROUP BY 1""")
def agg_max_lenient(spark, d):
    return aggregates.aggregate(messy_lines(spark, d), ["l_returnflag"], [Op("max", ["qty", "neg"])])


@query(f"""SELECT l_returnflag, least(min(coalesce(q, 0)), 0) AS qty, least(min(neg), 0) AS neg FROM {MESSY} GROUP BY 1""")
def agg_min_lenient(spark, d):
    return aggregates.aggregate(messy_lines(spark, d), ["l_returnflag"], [Op("min", ["qty", "neg"])])


@query(f"""SELECT l_returnflag, round(sum(q), 2) AS sum_qty, round(avg(q), 4) AS avg_qty, max(q) AS max_qty, min(q) AS min_qty
  FROM {MESSY} GROUP BY 1""")
def agg_multi_op(spark, d):
    ops = [Op(o, ["qty"]) for o in ("sum", "avg", "max", "min")]
    out = aggregates.aggregate(messy_lines(spark, d), ["l_returnflag"], ops, dialect="sql")
    return rounded(rounded(out, "sum_qty"), "avg_qty", digits=4)


@query("SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem GROUP BY 1, 2")
def agg_count(spark, d):
    return aggregates.aggregate(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], [Op("count")])


@query("""SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey), 2) AS o_totalprice,
  count(*) OVER (PARTITION BY o_custkey) AS cnt FROM orders""")
def agg_keep(spark, d):
    ops = [Op("keep", ["o_orderkey"]), Op("sum", ["o_totalprice"]), Op("count")]
    return rounded(aggregates.aggregate(t(spark, d, "orders"), ["o_custkey"], ops), "o_totalprice")


@query("SELECT round(sum(l_quantity), 2) AS l_quantity, max(l_discount) AS l_discount FROM lineitem")
def agg_no_group(spark, d):
    ops = [Op("sum", ["l_quantity"]), Op("max", ["l_discount"])]
    return rounded(aggregates.aggregate(t(spark, d, "lineitem"), (), ops), "l_quantity")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour, event_type, count(*) AS cnt
  FROM events GROUP BY 1, 2, 3""")
def agg_group_exp(spark, d):
    exps = {"day": "date_format(ts, 'yyyy-MM-dd')", "hour": "date_format(ts, 'HH')"}
    return aggregates.aggregate(t(spark, d, "events"), ["event_type"], [Op("count")], exps)


@query("SELECT w, count(*) AS cnt FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY w")
def agg_group_explode(spark, d):
    return aggregates.aggregate(t(spark, d, "part"), (), [Op("count")], {"w": "split(p_name, ' ')"})


@query("""SELECT strftime(make_timestamp(b * 60000000), '%Y-%m-%d %H:%M:%S') AS bucket, event_type, count(*) AS cnt FROM (
  SELECT event_type, unnest(range(CAST(floor(epoch(ts) / 60) AS BIGINT) * 60,
    CAST(floor(epoch(ts) + floor(abs(value))) AS BIGINT) + 1, 60)) // 60 AS b FROM events) GROUP BY 1, 2""")
def agg_time_buckets(spark, d):
    ts = F.timestamp_seconds(F.floor(F.unix_micros("ts") / 1000000))
    length = F.make_interval(secs=F.floor(F.abs("value")).cast("decimal(18,6)"))
    rows = timed(spark, d, "events", "ts").withColumn("s", ts).withColumn("e", F.col("s") + length)
    out = aggregates.time_buckets(rows, "s", "e", 60, ("event_type",))
    return out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss"))


@query("""WITH ends AS (SELECT o_orderpriority AS prio, CAST(epoch(o_orderdate) AS BIGINT) AS s, CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 9000 * 86400 AS e
  FROM orders), turns AS (SELECT prio, p, sum(d) AS d FROM (SELECT prio, s AS p, 1 AS d FROM ends UNION ALL SELECT prio, e + 1, -1 FROM ends) GROUP BY ALL
  HAVING sum(d) <> 0), runs AS (SELECT prio, p, lead(p) OVER w - 1 AS last, sum(d) OVER w AS cnt FROM turns WINDOW w AS (PARTITION BY prio ORDER BY p))
  SELECT prio, p AS first, last, CAST(cnt AS BIGINT) AS cnt FROM runs WHERE cnt > 0""")
def agg_time_bucket_runs(spark, d):
    """How many orders are open in each second, up to 24 years long, as runs of seconds with one count."""
    rows = timed(spark, d, "orders", "o_orderdate").withColumn("e", F.timestamp_seconds(F.unix_seconds("o_orderdate") + F.col("o_orderkey") % 9000 * 86400))
    out = aggregates.time_bucket_runs(rows, "o_orderdate", "e", 1, ("o_orderpriority",))
    return out.select(F.col("o_orderpriority").alias("prio"), F.unix_seconds("first").alias("first"), F.unix_seconds("last").alias("last"), "cnt")


@query("SELECT l_returnflag, count(*) AS cnt FROM lineitem GROUP BY l_returnflag, l_linestatus")
def groupkey_output_flags(spark, d):
    keys = ["l_returnflag", "l_linestatus"]
    return aggregates.aggregate(t(spark, d, "lineitem"), keys, [Op("count")], hide=("l_linestatus",))


@query("""SELECT 'orders_by_status' AS tablename, o_orderstatus AS k, count(*) AS cnt FROM orders GROUP BY 2
  UNION ALL SELECT 'parts_by_brand', p_brand, count(*) FROM part GROUP BY 2""")
def agg_many_tables(spark, d):
    out = aggregates.aggregate_tables(
        {"orders": t(spark, d, "orders"), "part": t(spark, d, "part")},
        {
            "orders_by_status": {"table": "orders", "key_exps": {"k": "o_orderstatus"}, "ops": [Op("count")]},
            "parts_by_brand": {"table": "part", "key_exps": {"k": "p_brand"}, "ops": [Op("count")]},
        },
    )
    return routing.union_inputs(*(df.select(F.lit(n).alias("tablename"), "k", "cnt") for n, df in out.items()))


@query("""SELECT o_orderstatus AS "day", round(sum(o_totalprice), 2) AS orders_total, count(*) AS orders_cnt FROM orders GROUP BY 1""")
def agg_schema_derive(spark, d):
    orders = t(spark, d, "orders").withColumn("total", F.col("o_totalprice"))
    plan = {"keys": (), "ops": [Op("sum", ["total"]), Op("count")], "key_exps": {"day": "o_orderstatus"}}
    schema = aggregates.derived_schema(orders, table="orders", **plan)
    return rounded(aggregates.aggregate(orders, **plan).toDF(*schema.names), "orders_total")


@query("SELECT c_nationkey, round(sum(c_acctbal), 2) AS c_acctbal, count(*) AS cnt FROM customer GROUP BY 1")
def type_guided_agg(spark, d):
    df = t(spark, d, "customer")
    for name, kind in (("c_acctbal", "SUM"), ("c_mktsegment", "COUNT"), ("c_name", "NONE")):
        df = df.withMetadata(name, {"aggregation": kind})
    return rounded(aggregates.type_guided(df, ["c_nationkey"]), "c_acctbal")


@query("""SELECT l_returnflag, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice
  FROM lineitem GROUP BY 1""")
def sql_group_agg(spark, d):
    out = registry.sql_query(
        spark,
        {"lines": t(spark, d, "lineitem")},
        [("r", "SELECT l_returnflag, sum($v) FROM lines GROUP BY l_returnflag")],
        {"v": ["l_quantity", "l_extendedprice"]},
    )["r"]
    return rounded(out, "l_quantity", "l_extendedprice")


# merges: orders and line items with gaps on either side


def _sides(spark, d):
    orders = t(spark, d, "orders").filter("o_orderkey % 3 <> 0")
    lines = t(spark, d, "lineitem").filter("l_orderkey % 5 <> 0")
    return {
        "orders": merging.Part(orders, ["o_orderkey"], [Op("sum", ["o_totalprice"]), Op("count")]),
        "lines": merging.Part(lines, ["l_orderkey"], [Op("sum", ["l_quantity"]), Op("max", ["l_discount"])]),
    }


SIDES = """o AS (SELECT o_orderkey AS k, sum(o_totalprice) AS tp, count(*) AS c FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1),
l AS (SELECT l_orderkey AS k, sum(l_quantity) AS q, greatest(max(l_discount), 0) AS dm FROM lineitem
  WHERE l_orderkey % 5 <> 0 GROUP BY 1)"""
VALUES = """coalesce(round(q, 2), 0) AS lines_l_quantity, coalesce(dm, 0) AS lines_l_discount,
  coalesce(round(tp, 2), 0) AS orders_o_totalprice, coalesce(c, 0) AS orders_cnt"""


def _merged(spark, d, how):
    return rounded(merging.merge(_sides(spark, d), how), "lines_l_quantity", "orders_o_totalprice")


@query(f"WITH {SIDES} SELECT coalesce(o.k, l.k) AS o_orderkey, {VALUES} FROM o FULL JOIN l ON o.k = l.k")
def merge_outer(spark, d):
    return _merged(spark, d, "outer")


@query(f"WITH {SIDES} SELECT o.k AS o_orderkey, {VALUES} FROM o LEFT JOIN l ON o.k = l.k")
def merge_left(spark, d):
    return _merged(spark, d, "left")


@query(f"WITH {SIDES} SELECT o.k AS o_orderkey, {VALUES} FROM o JOIN l ON o.k = l.k")
def merge_inner(spark, d):
    return _merged(spark, d, "inner")


@query("""SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day, coalesce(l_linestatus, '') AS lines_l_linestatus,
  coalesce(CAST(l_linenumber AS VARCHAR), '') AS lines_l_linenumber, o_orderstatus AS orders_o_orderstatus
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    AND strftime(o_orderdate, '%Y-%m-%d') = strftime(l_shipdate - INTERVAL 1 DAY, '%Y-%m-%d')""")
def merge_keep(spark, d):
    parts = {
        "orders": merging.Part(
            t(spark, d, "orders"), (), [Op("keep", ["o_orderstatus"])],
            {"id": "o_orderkey", "day": "date_format(o_orderdate, 'yyyy-MM-dd')"},
        ),
        "lines": merging.Part(
            t(spark, d, "lineitem"), (), [Op("keep", ["l_linestatus", "l_linenumber"])],
            {"id": "l_orderkey", "day": "date_format(l_shipdate - interval 1 day, 'yyyy-MM-dd')"},
        ),
    }
    return merging.merge(parts, "left")


@query(f"""WITH {SIDES} SELECT 'inner' AS tablename, count(*) AS n FROM o JOIN l ON o.k = l.k
  UNION ALL SELECT 'outer', count(*) FROM o FULL JOIN l ON o.k = l.k""")
def merge_multi(spark, d):
    sides = _sides(spark, d)
    out, _ = merging.merge_multi({h: {"parts": sides, "how": h} for h in ("inner", "outer")})
    return routing.union_inputs(*(df.agg(F.lit(h).alias("tablename"), F.count(F.lit(1)).alias("n")) for h, df in out.items()))


@query("""SELECT o_orderkey, c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON o_custkey = c_custkey""")
def sql_left_join(spark, d):
    tables = {"orders": t(spark, d, "orders"), "customer": t(spark, d, "customer")}
    text_ = ORACLE_SQL["sql_left_join"]
    return registry.sql_query(spark, tables, [("r", text_)])["r"]


@query("""SELECT coalesce(a.k, b.k) AS k, a.n AS suppliers, b.n AS customers FROM
  (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_nationkey % 3 <> 0 GROUP BY 1) a FULL OUTER JOIN
  (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey % 4 <> 0 GROUP BY 1) b ON a.k = b.k""")
def sql_full_join(spark, d):
    tables = {"supplier": t(spark, d, "supplier"), "customer": t(spark, d, "customer")}
    return registry.sql_query(spark, tables, [("r", ORACLE_SQL["sql_full_join"])])["r"]


@query("""SELECT c_custkey, coalesce(n_name, 'none') AS nation FROM customer
  LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 0) ON c_nationkey = n_nationkey""")
def lookup_join(spark, d):
    nations = t(spark, d, "nation").filter("n_nationkey % 4 <> 0")
    out = merging.lookup_join(t(spark, d, "customer"), nations, "c_nationkey", "n_nationkey", "n_name", "nation", "none")
    return out.select("c_custkey", "nation")


def _codes(spark, d):
    """Country codes out of the nations' keys: 0, 1, 2, 31, 42 and so on."""
    return t(spark, d, "nation").select(
        F.when(F.col("n_nationkey") < 3, F.col("n_nationkey")).otherwise(F.col("n_nationkey") * 11 - 2).cast("string").alias("code")
    )


CODES = "(SELECT CAST(CASE WHEN n_nationkey < 3 THEN n_nationkey ELSE n_nationkey * 11 - 2 END AS VARCHAR) AS code FROM nation)"


@query(f"""SELECT c_custkey, (SELECT min(code) FROM {CODES} WHERE code IN (num[1:1], num[1:2], num[1:3], num[1:4])
    AND length(code) = (SELECT min(length(code)) FROM {CODES} WHERE code IN (num[1:1], num[1:2], num[1:3], num[1:4]))) AS cc
  FROM (SELECT c_custkey, CAST(c_custkey * 7 + 13 AS VARCHAR) AS num FROM customer)""")
def prefix_lookup_join(spark, d):
    numbers = t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * 7 + 13).cast("string").alias("num"))
    return merging.prefix_lookup_join(numbers, _codes(spark, d), "num").select("c_custkey", "cc")


@query("""SELECT c_custkey, '1,' || CASE WHEN c_custkey % 2 = 0 THEN substr(num, 2, 3) || '-' || substr(num, 5, 3) ELSE '' END AS place
  FROM (SELECT c_custkey, '1' || lpad(CAST(c_custkey AS VARCHAR), 6, '2') || '5555' AS num FROM customer)""")
def composite_prefix_lookup(spark, d):
    number = F.concat(F.lit("1"), F.lpad(F.col("c_custkey").cast("string"), 6, "2"), F.lit("5555"))
    numbers = t(spark, d, "customer").select("c_custkey", number.alias("num"))
    area = F.concat(F.substring("num", 2, 3), F.lit("-"), F.substring("num", 5, 3))
    areas = numbers.filter("c_custkey % 2 = 0").select(area.alias("area"))
    found = merging.composite_prefix_lookup(numbers, _codes(spark, d).filter("code = '1'"), areas, "num")
    return found.select("c_custkey", "place")


# columns


@query("""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def col_update(spark, d):
    df = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return columns.edit(df, columns.Update("o_orderstatus", "case when o_orderstatus = 'O' then 'open' end"))


@query("""SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS level, split_part(o_orderpriority, '-', 2) AS label FROM orders""")
def col_update_multi(spark, d):
    df = t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return columns.edit(df, columns.Update("o_orderpriority", "replace(o_orderpriority, '-', ',')", ("level", "label")))


@query("SELECT c_custkey, c_nationkey FROM customer")
def col_remove(spark, d):
    return columns.edit(t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), columns.Remove("c_name"))


@query("""SELECT p_partkey, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second FROM part""")
def col_split(spark, d):
    df = t(spark, d, "part").select("p_partkey", "p_name")
    return columns.edit(df, columns.Split("p_name", " ", ("first", "second")))


@query("""SELECT c_custkey, upper(c_name) AS shout, CASE WHEN c_nationkey > 1 THEN 'far' ELSE '' END AS where_, c_nationkey
  FROM customer""")
def col_insert(spark, d):
    df = t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    # both expressions see the original name, though it is removed between them
    return columns.edit(
        df,
        columns.Insert("c_nationkey", "case when c_nationkey > 1 then 'far' end", "where_"),
        columns.Insert("where_", "upper(c_name)", "shout"),
        columns.Remove("c_name"),
    )


@query("SELECT * FROM customer WHERE NOT (c_acctbal < 0 AND c_mktsegment = 'BUILDING')")
def row_validation(spark, d):
    return columns.row_validation(t(spark, d, "customer"), "not (c_acctbal < 0 and c_mktsegment = 'BUILDING')")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 3 END AS n FROM supplier""")
def drop_trailing_delimiter(spark, d):
    line = F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.lit(""))
    fields = columns.drop_trailing_delimiter(F.split(line, ","), F.col("s_suppkey") % 2 == 0)
    return t(spark, d, "supplier").select("s_suppkey", F.size(fields).alias("n"))


@query("SELECT s_suppkey, s_name || '/' || '' AS label FROM supplier")
def field_map_exp(spark, d):
    df = t(spark, d, "supplier")
    return df.select("s_suppkey", F.concat(columns.field(df, "s_name"), F.lit("/"), columns.field(df, "absent")).alias("label"))


@query("SELECT o_orderkey, 'b7' AS run, round(o_totalprice / (SELECT max(o_totalprice) FROM orders), 6) AS share FROM orders")
def global_vars(spark, d):
    orders = t(spark, d, "orders")
    df = columns.with_globals(orders, {"run": "b7", "top": orders.agg(F.max("o_totalprice"))})
    return df.select("o_orderkey", "run", F.round(F.col("o_totalprice") / F.col("top"), 6).alias("share"))


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def column_ranges(spark, d):
    df = t(spark, d, "lineitem")
    return df.select(*columns.column_ranges(df.columns, "0-1;3;8-"))


@query("SELECT l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def column_ranges_complement(spark, d):
    df = t(spark, d, "lineitem")
    return df.select(*columns.column_ranges_complement(df.columns, "0-1;3;8-"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS a, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS b, CAST(NULL AS VARCHAR) AS c
  FROM customer""")
def normalize_width(spark, d):
    even = F.col("c_custkey") % 2 == 0
    line = F.when(even, F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name")).otherwise(F.col("c_custkey").cast("string"))
    return t(spark, d, "customer").select(line.alias("l")).select(*columns.normalize_width(F.col("l"), ["a", "b", "c"]))


@query("SELECT *, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS DOUBLE) AS weight FROM supplier")
def add_fields(spark, d):
    return columns.add_fields(t(spark, d, "supplier"), "s_name string, note string, weight double")


@query("SELECT max(l_tax) AS l_tax, max(l_discount) AS l_discount, count(*) AS n FROM lineitem")
def select_expansion(spark, d):
    statement = columns.select_expansion("SELECT max($r), count(*) AS n FROM lines", {"r": ["l_tax", "l_discount"]})
    t(spark, d, "lineitem").createOrReplaceTempView("lines")
    return spark.sql(statement)


# routing


@query("""SELECT replace(o_orderstatus, '-', '_') || '-' || replace(o_orderpriority, '-', '_') AS tablename, count(*) AS n
  FROM orders GROUP BY 1""")
def split_by_keys(spark, d):
    routed = routing.split_by_keys(t(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], omit_keys=True)
    return routed.groupBy("tablename").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CASE WHEN o_totalprice > 200000 THEN 'large' ELSE 'small' END || '_' || o_orderstatus AS tablename, count(*) AS n
  FROM orders GROUP BY 1""")
def split_by_exp(spark, d):
    exp = "concat(case when o_totalprice > 200000 then 'large' else 'small' end, '_', o_orderstatus)"
    return routing.split_by_exp(t(spark, d, "orders"), exp).groupBy("tablename").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_orderstatus AS tablename FROM orders WHERE o_orderstatus IN ('O', 'F')")
def route_outlets(spark, d):
    routed = routing.split_by_keys(t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], True)
    return routing.union_inputs(*routing.route_outlets(routed, ["O", "F"]).values())


@query("SELECT o_orderkey, o_orderstatus AS tablename FROM orders WHERE o_orderstatus <> 'O'")
def not_key(spark, d):
    routed = routing.split_by_keys(t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderstatus"], True)
    return routing.not_key(routed, "O")


@query("SELECT DISTINCT event_type AS tablename FROM events")
def distinct_tables(spark, d):
    return routing.distinct_tables(routing.split_by_keys(t(spark, d, "events"), ["event_type"]))


@query("""WITH x AS (SELECT conv_id, turn, text, CASE WHEN role = 'user' THEN 'asked' END AS title FROM conversations),
y AS (SELECT conv_id, turn, title, max(CASE WHEN title IS NOT NULL THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS h FROM x)
SELECT conv_id AS file, turn AS pos, 'asked' AS tablename FROM y WHERE title IS NULL AND h IS NOT NULL""")
def split_sections_by_title(spark, d):
    lines = t(spark, d, "conversations").select(
        F.col("conv_id").alias("file"), F.col("turn").alias("pos"),
        F.when(F.col("role") == "user", "#asked,,").otherwise(F.concat(F.lit("- "), "text")).alias("line"),
    )
    titles = spark.createDataFrame([("#asked", "asked")], "title string, tablename string")
    return routing.split_sections_by_title(lines, titles).select("file", "pos", "tablename")


@query("""SELECT s_suppkey AS id, s_name AS name, s_acctbal, NULL AS c_mktsegment FROM supplier
  UNION ALL SELECT c_custkey, c_name, NULL, c_mktsegment FROM customer""")
def union_inputs(spark, d):
    a = t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), "s_acctbal")
    b = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    return routing.union_inputs(a, b)


@query("SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_values(spark, d):
    return routing.distinct_values(t(spark, d, "customer"), "c_mktsegment", "c_nationkey")


@query("SELECT c_name AS key, CAST(c_custkey AS VARCHAR) AS value FROM customer")
def flip_pairs(spark, d):
    pairs = t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"))
    return routing.flip_pairs(pairs)


@query("""SELECT row_number() OVER (ORDER BY ts, event_type, event_id) AS place, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at,
  'ALTER TABLE `' || event_type || '` ADD COLUMNS (`c' || event_id || '` bigint)' AS statement FROM events""")
def sort_statements(spark, d):
    """Every event as a schema change of the table of its type, in the order of their times."""
    changes = t(spark, d, "events").select(
        F.col("ts").alias("at"), F.col("event_type").alias("tablename"), F.col("event_id").alias("version"), F.lit(0).alias("n"),
        F.concat(F.lit("ALTER TABLE `"), "event_type", F.lit("` ADD COLUMNS (`c"), "event_id", F.lit("` bigint)")).alias("statement"),
    )
    # written, as a table sorted twice may be cut into other parts the second time
    ordered = written(schema.sort_statements(changes).withColumn("id", F.monotonically_increasing_id()), "sorted")
    # the number of a row of a sorted table: its place in its part and what the parts before hold
    parts = ordered.withColumn("part", F.shiftright("id", 33)).withColumn("own", F.col("id").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = parts.groupBy("part").count()
    before = sizes.select("part", (F.sum("count").over(W.orderBy("part")) - F.col("count")).alias("before"))
    out = parts.join(F.broadcast(before), "part")
    return out.select((F.col("before") + F.col("own") + 1).alias("place"), F.col("version").alias("event_id"), F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), "statement")


# SQL pass-through: one statement of each kind

STATEMENTS = {
    "filter": "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000",
    "having": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15",
    "top_k": """SELECT o_orderpriority, o_orderkey, rk FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER
      (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rk FROM orders) x WHERE rk <= 3""",
    "frame": """SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s FROM orders""",
    "rollup": """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "cube": """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "union": "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier",
    "intersect": "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier",
    "except": "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0",
    "semi": "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
    "anti": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "distinct": """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem
      GROUP BY l_returnflag""",
    "join": """SELECT r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem
      JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY r_name""",
}
STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _statement(name, sql):
    def run(spark, d):
        used = {n: t(spark, d, n) for n in STAR if n in sql}
        return registry.sql_query(spark, used, [("result", sql)])["result"]

    run.__name__ = f"sql_query_{name}"
    return query(sql)(run)


for _name, _sql in STATEMENTS.items():
    _statement(_name, _sql)


# scalar functions


@query("""SELECT event_id, strftime(ts, '%H') AS h, strftime(ts, '%Y-%m-%d') AS d FROM events""")
def fn_hour_day_epoch(spark, d):
    s = F.unix_seconds("ts")
    return timed(spark, d, "events", "ts").select("event_id", dates.hour_epoch(s).alias("h"), dates.day_epoch(s).alias("d"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'error' ELSE strftime(ts, '%H') END AS h,
  CASE WHEN event_id % 5 = 0 THEN 'error' ELSE strftime(ts, '%Y-%m-%d') END AS d FROM events""")
def fn_hour_day(spark, d):
    x = F.when(F.col("event_id") % 5 == 0, "bad").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t(spark, d, "events").select("event_id", dates.hour(x).alias("h"), dates.day(x).alias("d"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:00.000') END AS s FROM events""")
def fn_dt_standardize(spark, d):
    x = F.when(F.col("event_id") % 5 == 0, " ").otherwise(F.concat(F.lit(" "), F.date_format("ts", "yyyyMMdd.HHmm")))
    return t(spark, d, "events").select("event_id", dates.dt_standardize(x, "yyyyMMdd.HHmm").alias("s"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:00.000') AS s FROM events""")
def fn_dt_english_format(spark, d):
    x = F.date_format("ts", "MMM dd, yyyy hh:mm a")
    return t(spark, d, "events").select("event_id", dates.dt_english_format(x, "MMM dd, yyyy hh:mm a").alias("s"))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 7 = 1 THEN NULL
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS s FROM events""")
def fn_epoch_ms_to_string(spark, d):
    odd = F.col("event_id") % 7
    x = F.when(odd == 0, " ").when(odd == 1, "x1").otherwise(F.unix_millis("ts").cast("string"))
    return timed(spark, d, "events", "ts").select("event_id", dates.epoch_ms_to_string(x).alias("s"))


@query("SELECT o_orderkey, CAST((o_orderkey % 100000) AS BIGINT) AS s FROM orders")
def fn_date_subtract(spark, d):
    start = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    end = F.date_format(F.timestamp_seconds(F.unix_seconds("o_orderdate") + F.col("o_orderkey") % 100000), "yyyy-MM-dd HH:mm:ss")
    return timed(spark, d, "orders", "o_orderdate").select("o_orderkey", dates.date_subtract(end, start).alias("s"))


@query("SELECT o_orderkey, CAST(o_orderkey % 40 // 5 + 1 AS INTEGER) AS n, strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.000,' || strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:04.999' AS first FROM orders")
def fn_split_time_range(spark, d):
    day = F.date_trunc("day", "o_orderdate")
    start = F.date_format(day, "yyyy-MM-dd HH:mm:ss")
    end = F.date_format(F.timestamp_seconds(F.unix_seconds(day) + F.col("o_orderkey") % 40), "yyyy-MM-dd HH:mm:ss")
    parts = dates.split_time_range(start, end, 5)
    return timed(spark, d, "orders", "o_orderdate").select("o_orderkey", F.size(parts).alias("n"), parts[0].alias("first"))


@query("SELECT c_custkey, true AS today, true AS weekday, true AS same_time FROM customer")
def fn_now_and_today(spark, d):
    x = F.col("c_custkey") % 5000 * 86400 * 3 + 3723
    moved = dates.change_date_to_current(x)
    return t(spark, d, "customer").select(
        "c_custkey",
        (F.substring(dates.now_string(), 1, 10) == F.date_format(F.current_date(), "yyyy-MM-dd")).alias("today"),
        (dates.week_day_yesterday() == F.lower(F.date_format(F.date_sub(F.current_date(), 1), "EEEE"))).alias("weekday"),
        (moved % 86400 == 3723).alias("same_time"),
    )


@query("SELECT p_partkey, replace(p_name, ' ', ',') AS s FROM part")
def fn_split_by_single_space(spark, d):
    return t(spark, d, "part").select("p_partkey", text.split_by_single_space(F.concat("p_name", F.lit(" "))).alias("s"))


@query("SELECT o_orderkey, CAST(o_orderkey // 256 % 65536 AS BIGINT) AS s, CAST(-1 AS BIGINT) AS far FROM orders")
def fn_hex_subnumber(spark, d):
    h = F.lpad(F.hex("o_orderkey"), 8, "0")
    return t(spark, d, "orders").select("o_orderkey", text.hex_subnumber(h, 1, 2).alias("s"), text.hex_subnumber(h, 4, 5).alias("far"))


@query("SELECT p_partkey, CASE WHEN regexp_full_match(p_brand, '[A-Za-z]+#?([0-9]+)') THEN regexp_extract(p_brand, '^[A-Za-z]+#?([0-9]+)$', 1) END AS s FROM part")
def fn_regex_group1(spark, d):
    return t(spark, d, "part").select("p_partkey", text.regex_group1("p_brand", "[A-Za-z]+#?([0-9]+)").alias("s"))


@query("SELECT page_id, string_split(url, '/')[-2] AS s FROM pages WHERE len(string_split(url, '/')) > 1")
def fn_parent_folder_name(spark, d):
    rows = t(spark, d, "pages").filter(F.size(F.split("url", "/")) > 1)
    return rows.select("page_id", text.parent_folder_name("url").alias("s"))


@query("""SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS after_dash, split_part(o_orderpriority, '-', 1) AS before_dash,
  o_orderpriority AS missing FROM orders""")
def fn_string_between(spark, d):
    p = F.col("o_orderpriority")
    return t(spark, d, "orders").select(
        "o_orderkey", text.string_between(p, "-", "").alias("after_dash"), text.string_between(p, "", "-").alias("before_dash"),
        text.string_between(p, "<", ">").alias("missing"),
    )


@query("SELECT c_custkey, 'n=' || c_custkey || ' name=' || c_name AS s FROM customer")
def fn_fill_params(spark, d):
    return t(spark, d, "customer").select("c_custkey", text.fill_params("n=$n name=$nm", {"n": F.col("c_custkey"), "nm": F.col("c_name")}).alias("s"))


@query("SELECT p_partkey, replace(p_name, ' ', '') AS s FROM part")
def fn_replace_spaces(spark, d):
    return t(spark, d, "part").select("p_partkey", text.replace_spaces("p_name").alias("s"))


@query("SELECT c_nationkey, '/data/' || c_nationkey || '/' AS s FROM customer GROUP BY 1 HAVING count(*) > 1")
def fn_common_path(spark, d):
    path = F.concat(F.lit("/data/"), "c_nationkey", F.lit("/"), "c_name", F.lit("/f"), "c_custkey")
    rows = t(spark, d, "customer").groupBy("c_nationkey").agg(text.common_path(path).alias("s"), F.count(F.lit(1)).alias("n"))
    return rows.filter("n > 1").select("c_nationkey", "s")


@query("SELECT p_partkey, string_split(p_name, ' ')[2] AS s, CAST(NULL AS VARCHAR) AS beyond FROM part")
def fn_nth_csv_column(spark, d):
    line = F.replace("p_name", F.lit(" "), F.lit(","))
    return t(spark, d, "part").select("p_partkey", text.nth_csv_column(line, 1).alias("s"), text.nth_csv_column(line, 90).alias("beyond"))


@query("SELECT s_suppkey, s_name GLOB '*1?' OR s_name GLOB '*7' AS m FROM supplier")
def fn_glob_match(spark, d):
    return t(spark, d, "supplier").select("s_suppkey", text.glob_match("s_name", "*{1?,7}").alias("m"))


@query("""SELECT p_partkey, '_' || p_size || '_' || regexp_replace(p_brand, '\\W', '_', 'g') AS s FROM part""")
def fn_clean_identifier(spark, d):
    return t(spark, d, "part").select("p_partkey", text.clean_identifier(F.concat_ws("-", F.col("p_size").cast("string"), "p_brand")).alias("s"))


@query("SELECT c_custkey, c_name || '-' || upper(substr(c_name, 1, 2)) AS a, position('A' IN c_name) AS b, c_custkey * 2 + 1 AS c FROM customer")
def fn_expressions(spark, d):
    df = t(spark, d, "customer").select("c_custkey", "c_name")
    out = columns.edit(
        df,
        columns.Insert("c_name", "concat(c_name, '-', upper(substr(c_name, 1, 2)))", "a"),
        columns.Update("c_name", "cast(locate('A', c_name) as string)"),
    )
    return out.select("c_custkey", "a", F.col("c_name").cast("int").alias("b"), (F.col("c_custkey") * 2 + 1).alias("c"))


# user-defined operators


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def custom_operator(spark, d):
    def totals(tables, key):
        rows = tables["events"].groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
        return {"totals": rows}

    registry.register_operator("totals", totals)
    return registry.run_operator("totals", {"events": t(spark, d, "events")}, key="event_type")["totals"]


@query("SELECT p_partkey, w FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)")
def custom_row_function(spark, d):
    def words(frames):
        for f in frames:
            out = f.assign(w=f["p_name"].str.split(" ")).explode("w")
            yield out[["p_partkey", "w"]]

    return registry.map_rows(t(spark, d, "part").select("p_partkey", "p_name"), words, "p_partkey long, w string")


@query("""SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) AS place FROM orders""")
def custom_group_function(spark, d):
    def ranked(frame):
        frame["place"] = frame.groupby("o_custkey", dropna=False)["o_totalprice"].rank(method="min").astype("int64")
        return frame[["o_custkey", "o_orderkey", "place"]]

    rows = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return registry.map_groups(rows, ["o_custkey"], ranked, "o_custkey long, o_orderkey long, place long", together=100_000)

"""Single-operator queries: projection/filter (P*), joins (J*), aggregates
(A*), windows (W*), sort/limit (O*), set operations (U1, U2), inline rows
(S4) and the customer/sales datasets (D13, D14, D17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.time import time_features
from tessera.operators import windows
from tessera.operators.joins import left_lookup, orphan_keys
from tessera.plans import domain
from tessera.plans.catalog import query
from tessera.sources import TABLES, load

EVENT_KINDS = ["signup", "click", "view", "purchase", "error"]


def _ev(spark, sf_dir):
    return load(spark, sf_dir, "events")


@query("project", "P1 S1", sql="SELECT event_id, user_id, event_type FROM events")
def project(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_id", "user_id", "event_type")


@query("computed_columns", "P2 P11 P13",
       sql="""SELECT event_id, value * CAST(1.1 AS DOUBLE) AS value_with_tax, value - CAST(1.0 AS DOUBLE) AS value_net,
       event_id % 7 AS bucket, value / (user_id + 1) AS value_per_user, 'v1' AS schema_tag FROM events""")
def computed_columns(spark, sf_dir):
    return _ev(spark, sf_dir).withColumns({
        "value_with_tax": F.col("value") * F.lit(1.1),
        "value_net": F.col("value") - F.lit(1.0),
        "bucket": F.col("event_id") % 7,
        "value_per_user": F.col("value") / (F.col("user_id") + 1),
        "schema_tag": F.lit("v1"),
    }).select("event_id", "value_with_tax", "value_net", "bucket", "value_per_user", "schema_tag")


@query("filter_eq", "P6", sql="SELECT * FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf_dir):
    return _ev(spark, sf_dir).filter(F.col("event_type") == "purchase")


@query("filter_range_and", "P7",
       sql="SELECT * FROM events WHERE value > 10.0 AND value <= 50.0 AND event_type <> 'error'")
def filter_range_and(spark, sf_dir):
    v = F.col("value")
    return _ev(spark, sf_dir).filter((v > 10.0) & (v <= 50.0) & (F.col("event_type") != "error"))


@query("filter_in", "P9", sql="SELECT * FROM events WHERE event_type IN ('click', 'view')")
def filter_in(spark, sf_dir):
    return _ev(spark, sf_dir).filter(F.col("event_type").isin("click", "view"))


@query("weekend_flag", "P10 F5",
       sql="""SELECT event_id, ts, dayofweek(ts) + 1 AS day_of_week,
       CASE WHEN dayofweek(ts) + 1 IN (1, 7) THEN true ELSE false END AS is_weekend FROM events""")
def weekend_flag(spark, sf_dir):
    f = time_features("ts")
    return _ev(spark, sf_dir).select("event_id", "ts", f["event_day_of_week"].alias("day_of_week"),
                                     f["is_weekend"].alias("is_weekend"))


@query("typed_cast", "P12",
       sql="""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(value AS DECIMAL(10, 2)) AS value_dec, CAST(ts AS DATE) AS event_date,
       CAST(event_id AS VARCHAR) AS event_key, TRY_CAST('x' || CAST(user_id AS VARCHAR) AS INTEGER) AS bad_int
       FROM events""")
def typed_cast(spark, sf_dir):
    e = _ev(spark, sf_dir)
    return e.select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("value").cast("decimal(10,2)").alias("value_dec"),
        F.col("ts").cast("date").alias("event_date"),
        F.col("event_id").cast("string").alias("event_key"),
        F.concat(F.lit("x"), F.col("user_id").cast("string")).try_cast("int").alias("bad_int"),
    )


@query("broadcast_left_join", "J1",
       sql="""SELECT e.event_id, e.user_id, c.c_name, c.c_nationkey
       FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def broadcast_left_join(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    return left_lookup(_ev(spark, sf_dir).select("event_id", "user_id"), c, on="user_id")


_INNER_SQL = """SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""


@query("inner_join", "J3", sql=_INNER_SQL)
def inner_join(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    # shuffled sort-merge join, as both sides grow with the data
    return o.hint("merge").join(c, "o_custkey", "inner").select(
        "o_orderkey", "o_custkey", "c_name", "c_mktsegment", "o_totalprice")


@query("broadcast_inner_join", "J4", sql=_INNER_SQL)
def broadcast_inner_join(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    # no hint: broadcast while the customer side is under the byte threshold
    return o.join(c, "o_custkey", "inner").select(
        "o_orderkey", "o_custkey", "c_name", "c_mktsegment", "o_totalprice")


@query("orphan_keys", "J6 Q8",
       sql="""
SELECT 'lineitem.l_partkey' AS check_name, l_partkey AS key FROM lineitem WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL) GROUP BY ALL
UNION ALL SELECT 'lineitem.l_orderkey', l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL) GROUP BY ALL
UNION ALL SELECT 'orders.o_custkey', o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL) GROUP BY ALL
UNION ALL SELECT 'events.user_id', user_id FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL) GROUP BY ALL
UNION ALL SELECT 'orders.o_orderkey->lineitem', o_orderkey FROM orders WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL) GROUP BY ALL""")
def orphan_keys_q(spark, sf_dir):
    t = lambda n: load(spark, sf_dir, n)
    checks = [
        ("lineitem.l_partkey", t("lineitem"), "l_partkey", t("part"), "p_partkey"),
        ("lineitem.l_orderkey", t("lineitem"), "l_orderkey", t("orders"), "o_orderkey"),
        ("orders.o_custkey", t("orders"), "o_custkey", t("customer"), "c_custkey"),
        ("events.user_id", t("events"), "user_id", t("customer"), "c_custkey"),
        ("orders.o_orderkey->lineitem", t("orders"), "o_orderkey", t("lineitem"), "l_orderkey"),
    ]
    out = None
    for name, fact, fk, dim, dk in checks:
        df = orphan_keys(fact, fk, dim, dk).select(F.lit(name).alias("check_name"), F.col("key").cast("long"))
        out = df if out is None else out.unionByName(df)
    return out


@query("brand_items", "J7 D2 D3",
       sql="""SELECT TRY_CAST(regexp_extract(p_brand, '[^#]*$') AS INTEGER) AS brand_id, p_brand AS brand_name,
       p_partkey AS item_id, p_name AS item_name, p_retailprice AS price, p_type AS category FROM part""")
def brand_items(spark, sf_dir):
    b = domain.brands(spark, sf_dir).select(F.col("id").alias("brand_id"), F.col("name").alias("brand_name"))
    i = domain.items(spark, sf_dir).select(F.col("id").alias("item_id"), "brand_id", F.col("name").alias("item_name"),
                                           "price", "category")
    return b.join(i, "brand_id", "inner")


@query("group_count", "A1 D18",
       sql="SELECT event_type, count(*) AS n_events, count(props) AS n_with_props FROM events GROUP BY event_type")
def group_count(spark, sf_dir):
    return _ev(spark, sf_dir).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.count("props").alias("n_with_props"))


@query("group_sum_avg", "A2 D19",
       sql="""SELECT user_id, count(*) AS n_events, sum(value) AS total_value, avg(value) AS avg_value
       FROM events GROUP BY user_id""")
def group_sum_avg(spark, sf_dir):
    return _ev(spark, sf_dir).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"), F.avg("value").alias("avg_value"))


@query("group_min_max", "A3",
       sql="""SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
       min(o_totalprice) AS min_total, max(o_totalprice) AS max_total FROM orders GROUP BY o_custkey""")
def group_min_max(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
        F.min("o_totalprice").alias("min_total"), F.max("o_totalprice").alias("max_total"))


@query("count_distinct", "A4",
       sql="""SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT props) AS distinct_props
       FROM events GROUP BY event_type""")
def count_distinct(spark, sf_dir):
    return _ev(spark, sf_dir).groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("props").alias("distinct_props"))


@query("percentiles", "A5",
       sql="""SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95
       FROM events GROUP BY event_type""")
def percentiles(spark, sf_dir):
    return _ev(spark, sf_dir).groupBy("event_type").agg(
        F.percentile_approx("value", 0.5).alias("p50"), F.percentile_approx("value", 0.95).alias("p95"))


@query("event_pivot", "A6",
       sql="SELECT user_id, CAST(ts AS DATE) AS event_date, "
           + ", ".join(f"min(ts) FILTER (WHERE event_type = '{k}') AS {k}" for k in EVENT_KINDS)
           + " FROM events GROUP BY ALL")
def event_pivot(spark, sf_dir):
    return (_ev(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("event_date"))
            .pivot("event_type", EVENT_KINDS).agg(F.min("ts")))


@query("global_summary", "A7",
       sql="""SELECT count(*) AS n_orders, sum(o_totalprice) AS revenue, avg(o_totalprice) AS avg_total,
       min(o_orderdate) AS first_order, max(o_orderdate) AS last_order, count(DISTINCT o_custkey) AS customers
       FROM orders""")
def global_summary(spark, sf_dir):
    return load(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("revenue"),
        F.avg("o_totalprice").alias("avg_total"), F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"), F.countDistinct("o_custkey").alias("customers"))


@query("daily_sales", "D17 A8 F6 P12 U3",
       sql="""
WITH s AS (
  SELECT o_orderkey, arg_min(CAST(o_totalprice AS DECIMAL(10, 2)), o_orderdate) AS total, min(o_orderdate) AS created_at
  FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey)
SELECT date_trunc('day', created_at) AS date, count(*) AS order_count,
       CAST(sum(total) AS DOUBLE) AS revenue, CAST(avg(total) AS DOUBLE) AS avg_order_value
FROM s GROUP BY 1""")
def daily_sales(spark, sf_dir):
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderkey").isNotNull())
    # silver: one row per order key (earliest version wins: deterministic
    # dedup by aggregation, partial-aggregated so a repeated key stays cheap)
    silver = o.groupBy("o_orderkey").agg(
        F.min_by(F.col("o_totalprice").cast("decimal(10,2)"), "o_orderdate").alias("total"),
        F.min("o_orderdate").alias("created_at"))
    return silver.groupBy(F.date_trunc("day", "created_at").cast("timestamp_ntz").alias("date")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total").cast("double").alias("revenue"),
        F.avg("total").cast("double").alias("avg_order_value"))


@query("running_total", "W1",
       sql="""SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
       sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS running_total FROM orders""")
def running_total(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return windows.running_total(o, ["o_custkey"], "o_orderdate", "o_totalprice")


@query("order_rank", "W2",
       sql="""SELECT o_orderkey, o_custkey, o_orderdate,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS order_rank
       FROM orders""")
def order_rank(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.row_number(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("sorted_output", "O1",
       sql="SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey ASC")
def sorted_output(spark, sf_dir):
    return load(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), F.asc("o_orderkey"))


@query("head_n", "O3",
       sql="""SELECT least(count(*), 100) AS n_rows, least(count(*), 100) AS n_distinct, true AS all_in_table FROM events""")
def head_n(spark, sf_dir):
    # which rows a limit gives is open; how many, and that they are rows of the table, is not
    head = _ev(spark, sf_dir).limit(100)
    ids = _ev(spark, sf_dir).select(F.col("event_id").alias("known")).distinct()
    return head.join(ids, F.col("event_id") == F.col("known"), "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_distinct"), F.bool_and(F.col("known").isNotNull()).alias("all_in_table"))


@query("table_counts", "U1 A7",
       sql=" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def table_counts(spark, sf_dir):
    out = None
    for t in TABLES:
        df = load(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(t).alias("table_name"), "row_count")
        out = df if out is None else out.unionAll(df)
    return out


@query("distinct_types", "U2 D18", sql="SELECT DISTINCT event_type FROM events")
def distinct_types(spark, sf_dir):
    return _ev(spark, sf_dir).select("event_type").distinct()


_KINDS = [("signup", "account"), ("click", "engagement"), ("view", "engagement"),
          ("purchase", "revenue"), ("error", "operations")]


@query("inline_values", "S4 K6",
       sql="WITH k(event_type, category) AS (VALUES "
           + ", ".join(f"('{a}', '{b}')" for a, b in _KINDS)
           + ") SELECT k.category, count(*) AS n_events, sum(e.value) AS total_value "
             "FROM events e JOIN k ON e.event_type = k.event_type GROUP BY k.category")
def inline_values(spark, sf_dir):
    kinds = spark.createDataFrame(_KINDS, "event_type string, category string")
    return (_ev(spark, sf_dir).join(F.broadcast(kinds), "event_type")  # 5 literal rows
            .groupBy("category").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")))


@query("customer_summary", "D13 P12 A2 A3",
       sql="""SELECT o_custkey AS customer_id, count(*) AS total_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12, 2))) AS DOUBLE) AS total_spent,
       CAST(avg(CAST(o_totalprice AS DECIMAL(12, 2))) AS DOUBLE) AS avg_order_value,
       CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order
       FROM orders GROUP BY o_custkey""")
def customer_summary(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumn("total", F.col("o_totalprice").cast("decimal(12,2)"))
    return o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total").cast("double").alias("total_spent"),
        F.avg("total").cast("double").alias("avg_order_value"),
        F.to_date(F.min("o_orderdate")).alias("first_order"),
        F.to_date(F.max("o_orderdate")).alias("last_order"))


def silver_order_lines(spark, sf_dir):
    """D14 silver: one row per order line with typed timestamp, date, hour."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    return li.join(o, "l_orderkey", "inner").select(
        F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.to_date("o_orderdate").alias("order_date"), F.hour("o_orderdate").alias("order_hour"))


def gold_customer_summary(spark, sf_dir):
    """D14 gold, including the processing-time column (F8)."""
    s = silver_order_lines(spark, sf_dir)
    return s.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("total").alias("total_revenue"),
        F.avg("total").alias("avg_order_value"), F.min("order_timestamp").alias("first_order"),
        F.max("order_timestamp").alias("last_order"), F.countDistinct("product_id").alias("unique_products"),
    ).withColumn("aggregated_at", F.current_timestamp())


@query("customer_summary_full", "D14 J3 A4 F3 F4 F8",
       sql="""SELECT o.o_custkey AS customer_id, count(*) AS total_orders, sum(l.l_extendedprice) AS total_revenue,
       avg(l.l_extendedprice) AS avg_order_value, min(o.o_orderdate) AS first_order, max(o.o_orderdate) AS last_order,
       count(DISTINCT l.l_partkey) AS unique_products
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey""")
def customer_summary_full(spark, sf_dir):
    # the clock column is left out of the checked result
    return gold_customer_summary(spark, sf_dir).drop("aggregated_at")

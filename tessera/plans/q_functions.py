"""Scalar-function queries F1-F18 (JSON, time, string, geo) with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.constants import CREATED
from tessera.functions.geo import distance_km, interpolate
from tessera.functions.json import ITEMS_SCHEMA, is_valid_json, items_total, json_double, parse_body
from tessera.functions.time import minutes_between, parse_iso_ts
from tessera.plans import domain, pipeline
from tessera.plans.catalog import query
from tessera.plans.oracle_sql import ORDER_LOG_CTES
from tessera.sources import load


@query("ts_parse", "F1 F2 F15",
       sql="""
WITH t AS (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
                        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS iso_text FROM events
  UNION ALL SELECT -1, 'not a time')
SELECT event_id, iso_text, TRY_CAST(replace(iso_text, 'T', ' ') AS TIMESTAMP) AS parsed FROM t""")
def ts_parse(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    t = e.select("event_id", text.alias("iso_text"))
    bad = spark.createDataFrame([(-1, "not a time")], "event_id long, iso_text string")
    return t.unionByName(bad).withColumn("parsed", parse_iso_ts("iso_text").cast("timestamp_ntz"))


@query("time_features", "F3 F4 F5 F6",
       sql="""SELECT event_id, CAST(ts AS DATE) AS event_date, hour(ts) AS event_hour,
       dayofweek(ts) + 1 AS day_of_week, date_trunc('hour', ts) AS hour_start, date_trunc('month', ts) AS month_start
       FROM events""")
def time_features(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return e.select("event_id", F.to_date("ts").alias("event_date"), F.hour("ts").alias("event_hour"),
                    F.dayofweek("ts").alias("day_of_week"),
                    F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"),
                    F.date_trunc("month", "ts").cast("timestamp_ntz").alias("month_start"))


@query("json_fields", "F9",
       sql="""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS BOOLEAN) AS k_as_bool, json_valid(props) AS valid FROM events""")
def json_fields(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    p = parse_body("props", "k int")
    wrong = parse_body("props", "k boolean")  # badly typed field -> NULL field only
    return e.select("event_id", p["k"].alias("k"), wrong["k"].alias("k_as_bool"), is_valid_json("props").alias("valid"))


@query("json_path", "F10 D15 A7",
       sql="WITH " + ORDER_LOG_CTES + """
SELECT count(*) AS order_count, sum(TRY_CAST(json_extract_string(body, '$.total') AS DOUBLE)) AS total_revenue,
       count(DISTINCT TRY_CAST(json_extract_string(body, '$.brand_id') AS INTEGER)) AS brands
FROM order_log WHERE event_type = 'order_created'""")
def json_path(spark, sf_dir):
    log = pipeline.event_log(spark, sf_dir, (CREATED,))
    return log.agg(F.count(F.lit(1)).alias("order_count"),
                   F.sum(json_double("body", "$.total")).alias("total_revenue"),
                   F.countDistinct(F.get_json_object("body", "$.brand_id").try_cast("int")).alias("brands"))


@query("duration_minutes", "F7",
       sql="""SELECT user_id, CAST(ts AS DATE) AS event_date,
       (CAST(floor(epoch(max(ts))) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT)) / 60 AS active_minutes
       FROM events GROUP BY ALL""")
def duration_minutes(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    g = e.groupBy("user_id", F.to_date("ts").alias("event_date")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return g.select("user_id", "event_date", minutes_between("first_ts", "last_ts").alias("active_minutes"))


def _round_like_spark(expr: str, n: int) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


@query("items_total", "F16 F11",
       sql=f"""
WITH lines AS (
  SELECT l_orderkey, {_round_like_spark('l_extendedprice / l_quantity', 2)} AS price,
         CAST(trunc(l_quantity) AS INTEGER) AS quantity FROM lineitem),
per_line AS (SELECT l_orderkey, {_round_like_spark('price * quantity', 2)} AS line_total FROM lines)
SELECT l_orderkey AS order_id, count(*) AS n_items, {_round_like_spark('sum(line_total)', 2)} AS items_total
FROM per_line GROUP BY l_orderkey""")
def items_total_q(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    # each line carries its items as a JSON array (F11 encode); F16 parses
    # the array and folds price * quantity; orders sum their lines.
    item = F.struct(F.col("l_partkey").alias("item_id"),
                    F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("price"),
                    F.col("l_quantity").cast("int").alias("quantity"))
    lines = li.select("l_orderkey", F.to_json(F.array(item)).alias("items"))
    per_line = lines.select("l_orderkey", items_total("items").alias("line_total"),
                            F.size(F.from_json("items", ITEMS_SCHEMA)).alias("n"))
    return per_line.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum("n").alias("n_items"), F.round(F.sum("line_total"), 2).alias("items_total"))


@query("string_build", "F12",
       sql="""SELECT c_custkey, 'C-' || CAST(c_custkey AS VARCHAR) || '/' || c_mktsegment AS tag,
       upper(c_name) AS name_upper, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nation_code,
       concat_ws('|', c_name, c_mktsegment) AS joined FROM customer""")
def string_build(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    F.concat(F.lit("C-"), F.col("c_custkey").cast("string"), F.lit("/"), "c_mktsegment").alias("tag"),
                    F.upper("c_name").alias("name_upper"),
                    F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation_code"),
                    F.concat_ws("|", "c_name", "c_mktsegment").alias("joined"))


@query("geo_distance", "F17 F18",
       sql="WITH " + ORDER_LOG_CTES + """,
c AS (
  SELECT o.order_id, CAST(json_extract_string(o.body, '$.customer_lat') AS DOUBLE) AS clat,
         CAST(json_extract_string(o.body, '$.customer_lon') AS DOUBLE) AS clon,
         CAST(10.0 AS DOUBLE) + n.n_nationkey * CAST(2.0 AS DOUBLE) AS klat,
         CAST(-120.0 AS DOUBLE) + n.n_nationkey * CAST(3.0 AS DOUBLE) AS klon
  FROM order_log o LEFT JOIN nation n ON o.location_id = n.n_nationkey WHERE o.event_type = 'order_created')
SELECT order_id, sqrt((clat - klat) * (clat - klat) + (clon - klon) * (clon - klon)) * 111 AS distance_km,
       klat + (clat - klat) * CAST(0.5 AS DOUBLE) AS mid_lat, klon + (clon - klon) * CAST(0.5 AS DOUBLE) AS mid_lon
FROM c""")
def geo_distance(spark, sf_dir):
    log = pipeline.event_log(spark, sf_dir, (CREATED,))
    loc = domain.locations(spark, sf_dir).select(F.col("id").alias("location_id"), F.col("lat").alias("klat"),
                                                 F.col("lon").alias("klon"))
    b = parse_body("body", "customer_lat double, customer_lon double")
    c = log.select("order_id", "location_id", b["customer_lat"].alias("clat"), b["customer_lon"].alias("clon"))
    c = c.join(loc, "location_id", "left")  # orders without a known place keep NULL distances
    half = F.lit(0.5)
    return c.select("order_id",
                    distance_km(F.col("klat"), F.col("klon"), F.col("clat"), F.col("clon")).alias("distance_km"),
                    interpolate(F.col("klat"), F.col("clat"), half).alias("mid_lat"),
                    interpolate(F.col("klon"), F.col("clon"), half).alias("mid_lon"))

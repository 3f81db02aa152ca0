"""Keyed dedup of conflicting copies, and gold measures that roll up: bitmaps,
quantile sketches, grouping sets and loads that add their states."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tessera.functions.hashing import sql_uhash, uhash
from tessera.operators import rollup
from tessera.operators.dedup import latest_by_key
from tessera.plans.catalog import query
from tessera.session import work_path
from tessera.sources import load


def _copies(e):
    """Every tenth event twice more: once a second later, once at the same time with other columns."""
    some = e.where(F.col("event_id") % 10 == 0)
    later = some.where(F.col("event_id") % 20 == 0).withColumns({"ts": F.col("ts") + F.expr("INTERVAL 1 SECOND"), "value": F.col("value") + 1})
    return e.unionByName(later).unionByName(some.withColumn("props", F.concat("props", F.lit(" "))))


@query("dedup_conflicts", "U3 D16",
       sql=f"""
WITH copies AS (
  SELECT event_id, ts, user_id, event_type, value, props FROM events
  UNION ALL SELECT event_id, ts + INTERVAL 1 SECOND, user_id, event_type, value + 1, props FROM events WHERE event_id % 20 = 0
  UNION ALL SELECT event_id, ts, user_id, event_type, value, props || ' ' FROM events WHERE event_id % 10 = 0)
SELECT event_id, ts, user_id, event_type, value, props FROM copies
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, {sql_uhash('props', 'tie')} DESC) = 1""")
def dedup_conflicts(spark, sf_dir):
    """Copies of a key differ in time or payload: the latest whole row stays, of
    equal times the one whose payload has the larger hash."""
    e = _copies(load(spark, sf_dir, "events"))
    return latest_by_key(e, ["event_id"], F.unix_micros(F.col("ts").cast("timestamp")), uhash("props", "tie"))


@query("distinct_rollup", "A4 A9 D9",
       sql="""
SELECT 'hour' AS level, date_trunc('hour', ts)::TIMESTAMP AS start, count(DISTINCT user_id) AS users FROM events GROUP BY ALL
UNION ALL SELECT 'day', date_trunc('day', ts)::TIMESTAMP, count(DISTINCT user_id) FROM events GROUP BY ALL
UNION ALL SELECT 'total', NULL, count(DISTINCT user_id) FROM events""")
def distinct_rollup(spark, sf_dir):
    """Distinct users by hour, day and in all, from one table of hourly bitmaps."""
    path = work_path(spark, "distinct_states")
    e = load(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    rollup.distinct_states(e, ["hour"], "user_id").write.parquet(path)
    states = spark.read.parquet(path)
    levels = {"hour": F.col("hour"), "day": F.date_trunc("day", "hour").cast("timestamp_ntz"), "total": F.lit(None).cast("timestamp_ntz")}
    parts = [rollup.distinct_counts(states, [at], "users").select(F.lit(name).alias("level"), F.col("_level0").alias("start"), "users") for name, at in levels.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


_QUANTILES = """count(*) AS orders, quantile_disc(o_totalprice, 0.5) AS p50, quantile_disc(o_totalprice, 0.95) AS p95,
  min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders WHERE o_totalprice IS NOT NULL GROUP BY ALL"""


@query("quantile_rollup", "A5 A9 D10",
       sql=f"""
SELECT 'day' AS level, o_orderdate::DATE AS start, {_QUANTILES}
UNION ALL SELECT 'month' AS level, date_trunc('month', o_orderdate)::DATE AS start, {_QUANTILES}""")
def quantile_rollup(spark, sf_dir):
    """Median and 95th percentile of order totals by day, and by month from the
    days' sketches. Sketches are exact up to a few thousand values; tests hold
    them to 1 % of ranks beyond."""
    path = work_path(spark, "quantile_states")
    o = load(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    rollup.quantile_states(o, ["day"], "o_totalprice").write.parquet(path)
    days = spark.read.parquet(path)
    months = rollup.merged_quantiles(days.withColumn("month", F.trunc("day", "month")), ["month"])

    def shown(states, level, start):
        return states.select(F.lit(level).alias("level"), F.col(start).alias("start"), F.col("n").alias("orders"),
                             rollup.quantile(0.5).alias("p50"), rollup.quantile(0.95).alias("p95"), "low", "high")

    return shown(days, "day", "day").unionByName(shown(months, "month", "month"))


@query("incremental_gold", "K1 S8 A4 A5 D9",
       sql="""SELECT event_type, count(*) FILTER (WHERE value IS NOT NULL) AS n, min(value) AS low, max(value) AS high,
       count(DISTINCT user_id) AS users FROM events GROUP BY event_type HAVING count(value) > 0""")
def incremental_gold(spark, sf_dir):
    """Two loads, the second delivered twice: each writes the states of its own rows
    under its load's name, so a repeated load replaces itself, and gold merges
    the states of all loads."""
    base = work_path(spark, "incremental_gold")
    e = load(spark, sf_dir, "events")
    half = e.agg(F.percentile_approx("event_id", 0.5)).scalar()
    early = F.coalesce(F.col("event_id") <= half, F.lit(True))
    for name, part in (("1", e.where(early)), ("2", e.where(~early)), ("2", e.where(~early))):
        rollup.quantile_states(part, ["event_type"], "value").write.mode("overwrite").parquet(f"{base}/values/load={name}")
        rollup.distinct_states(part, ["event_type"], "user_id").write.mode("overwrite").parquet(f"{base}/users/load={name}")
    values = rollup.merged_quantiles(spark.read.parquet(f"{base}/values"), ["event_type"])
    users = rollup.distinct_counts(spark.read.parquet(f"{base}/users"), [F.col("event_type")], "users").select(F.col("_level0").alias("_type"), "users")
    both = values.join(users, values["event_type"].eqNullSafe(users["_type"]), "left")
    return both.select("event_type", "n", "low", "high", F.coalesce("users", F.lit(0)).alias("users"))

"""Ingestion queries: CSV files, schema replacement, the raw-to-events job,
timestamps in two layouts and generated keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.time import parse_two_layouts
from tessera.operators.dedup import latest_by_key
from tessera.plans.catalog import query
from tessera.plans.q_files import EVENTS_SCHEMA
from tessera.session import work_path
from tessera.sinks import tables as sink
from tessera.sources import load

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@query("scan_csv", "S2", sql="SELECT * FROM events")
def scan_csv(spark, sf_dir):
    path, options = work_path(spark, "scan_csv"), {"timestampNTZFormat": MICROS, "escape": '"', "header": "true"}
    load(spark, sf_dir, "events").write.options(**options).csv(path)
    return spark.read.options(**options).schema(EVENTS_SCHEMA).csv(path)


@query("replace_schema", "K3 K1", sql="SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18, 2)) AS total FROM orders")
def replace_schema(spark, sf_dir):
    """An overwrite replaces rows and columns: names, number and types."""
    o, path = load(spark, sf_dir, "orders"), work_path(spark, "replace_schema")
    sink.refresh(o, path)
    return sink.refresh(o.select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("total")), path)


@query("raw_to_events", "D16 S10 P8 U3",
       sql="SELECT event_id, ts, user_id, event_type, value, props, true AS has_lineage FROM events WHERE event_id % 7 <> 0")
def raw_to_events(spark, sf_dir):
    """Raw JSON files -> lineage columns -> NOT NULL filter -> one row for each key.
    The raw files hold every tenth event twice, the second a second later and
    with another value, and lack every seventh's type; the earliest row stays."""
    path = work_path(spark, "raw_events")
    e = load(spark, sf_dir, "events").withColumn("event_type", F.when(F.col("event_id") % 7 != 0, F.col("event_type")))
    copies = e.where(F.col("event_id") % 10 == 0).withColumns({"ts": F.col("ts") + F.expr("INTERVAL 1 SECOND"), "value": F.col("value") + 1})
    e.unionByName(copies).write.option("timestampNTZFormat", MICROS).json(path)
    raw = sink.with_lineage(spark.read.option("timestampNTZFormat", MICROS).schema(EVENTS_SCHEMA).json(path))
    known = raw.where(F.col("event_id").isNotNull() & F.col("event_type").isNotNull())
    # chosen on the data, not on where or when it was read
    tie = F.xxhash64(*EVENTS_SCHEMA.names).bitwiseAND(F.lit((1 << 63) - 1))
    lineage = (F.col("_source_file").isNotNull() & F.col("_ingested_at").isNotNull()).alias("has_lineage")
    return latest_by_key(known.select(*EVENTS_SCHEMA.names, lineage), ["event_id"], -F.unix_micros(F.col("ts").cast("timestamp")), tie)


@query("two_timestamp_layouts", "F2 F1 F15",
       sql="SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END AS event_time FROM events")
def two_timestamp_layouts(spark, sf_dir):
    """Text with and without fractions, parsed with two explicit patterns."""
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", MICROS)).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return load(spark, sf_dir, "events").select("event_id", parse_two_layouts(text).cast("timestamp_ntz").alias("event_time"))


@query("generated_keys", "F13", sql="SELECT count(*) AS n_rows, count(*) AS n_keys, true AS well_formed FROM events")
def generated_keys(spark, sf_dir):
    keys = load(spark, sf_dir, "events").select(F.expr("uuid()").alias("key"))
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return keys.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("key").alias("n_keys"), F.bool_and(F.col("key").rlike(form)).alias("well_formed"))

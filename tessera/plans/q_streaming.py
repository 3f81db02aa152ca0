"""Streaming queries: Structured Streaming reads the files of the provided
``events`` table (or an envelope written from it) with ``availableNow``; each
query returns the batch read of its sink, which is compared with the batch
result of the same logic."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.time import parse_iso_ts
from tessera.plans import pipeline
from tessera.plans.catalog import query
from tessera.plans.q_files import EVENTS_SCHEMA
from tessera.plans.q_medallion import _BRONZE
from tessera.sinks.tables import table_name
from tessera.session import work_path
from tessera.sources import load
from tessera.sources.tables import table_path
from tessera.streaming import jobs

ENVELOPE_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                                T.StructField("timestamp", T.TimestampType())])


def _events_stream(spark, sf_dir):
    return jobs.file_stream(spark, table_path(sf_dir, "events"), EVENTS_SCHEMA)


def _bucket_sql(seconds: int) -> str:
    return f"make_timestamp(CAST(floor(epoch_us(ts) / {seconds * 1_000_000}) AS BIGINT) * {seconds * 1_000_000})"


@query("stream_ingest_files", "S8 K10 R7", sql="SELECT * FROM events")
def stream_ingest_files(spark, sf_dir):
    base = work_path(spark, "stream_ingest")
    jobs.run_to_files(_events_stream(spark, sf_dir), f"{base}/out", f"{base}/cp")
    return spark.read.parquet(f"{base}/out")


@query("stream_filter", "R2 D12", sql="SELECT * FROM events WHERE event_type = 'purchase' AND user_id IS NOT NULL")
def stream_filter(spark, sf_dir):
    base = work_path(spark, "stream_filter")
    s = (_events_stream(spark, sf_dir)
         .filter((F.col("event_type") == "purchase") & F.col("user_id").isNotNull())
         .withColumn("processed_at", F.current_timestamp()))
    jobs.run_to_files(s, f"{base}/out", f"{base}/cp")
    return spark.read.parquet(f"{base}/out").drop("processed_at")  # clock column not checked


@query("stream_tumbling_counts", "R3 R6",
       sql=f"""SELECT {_bucket_sql(10)} AS window_start, {_bucket_sql(10)} + INTERVAL 10 SECOND AS window_end,
       event_type, count(*) AS count, sum(value) AS total_value FROM events GROUP BY ALL""")
def stream_tumbling_counts(spark, sf_dir):
    base = work_path(spark, "stream_counts")
    s = _events_stream(spark, sf_dir).withColumn("event_time", jobs.event_time("ts"))
    agg = jobs.tumbling(s, "event_time", 10, ["event_type"], [F.count(F.lit(1)).alias("count"), F.sum("value").alias("total_value")])
    jobs.run_update_mode(agg, f"{base}/out", f"{base}/cp")
    return jobs.latest_state(spark, f"{base}/out", ["window_start", "window_end", "event_type"])


@query("stream_tumbling_revenue", "R4 R6 F10",
       sql=f"""SELECT {_bucket_sql(30)} AS window_start, {_bucket_sql(30)} + INTERVAL 30 SECOND AS window_end,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS product, count(*) AS orders, sum(value) AS revenue
       FROM events WHERE event_type = 'purchase' GROUP BY ALL""")
def stream_tumbling_revenue(spark, sf_dir):
    base = work_path(spark, "stream_revenue")
    s = (_events_stream(spark, sf_dir).filter(F.col("event_type") == "purchase")
         .withColumns({"event_time": jobs.event_time("ts"),
                       "product": F.get_json_object("props", "$.k").try_cast("int")}))
    agg = jobs.tumbling(s, "event_time", 30, ["product"], [F.count(F.lit(1)).alias("orders"), F.sum("value").alias("revenue")])
    jobs.run_update_mode(agg, f"{base}/out", f"{base}/cp")
    return jobs.latest_state(spark, f"{base}/out", ["window_start", "window_end", "product"])


@query("stream_watermark_append", "R5 R6",
       sql=f"""WITH w AS (SELECT {_bucket_sql(300)} AS window_start, event_type, count(*) AS count FROM events WHERE ts IS NOT NULL GROUP BY ALL)
       SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type, count FROM w
       WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_watermark_append(spark, sf_dir):
    # append mode: a window is emitted once the watermark (max event time
    # - 10 min) passes its end; the last open windows are never emitted.
    base = work_path(spark, "stream_append")
    s = _events_stream(spark, sf_dir).withColumn("event_time", jobs.event_time("ts"))
    agg = jobs.tumbling(s, "event_time", 300, ["event_type"], [F.count(F.lit(1)).alias("count")], "10 minutes")
    jobs.run_to_files(agg, f"{base}/out", f"{base}/cp")
    return spark.read.parquet(f"{base}/out")


@query("parse_envelope", "S6 K12 R1 P4", sql="SELECT * FROM events")
def parse_envelope(spark, sf_dir):
    env = jobs.to_envelope(load(spark, sf_dir, "events"), "event_id", "ts")
    return jobs.parse_envelope(env, EVENTS_SCHEMA)


@query("stream_parse_envelope", "S5 R1 K12 D6", sql="SELECT * FROM events")
def stream_parse_envelope(spark, sf_dir):
    base = work_path(spark, "stream_envelope")
    jobs.to_envelope(load(spark, sf_dir, "events"), "event_id", "ts").write.json(f"{base}/in")
    s = jobs.parse_envelope(jobs.file_stream(spark, f"{base}/in", ENVELOPE_SCHEMA, fmt="json"), EVENTS_SCHEMA)
    jobs.run_to_files(s, f"{base}/out", f"{base}/cp")
    return spark.read.parquet(f"{base}/out")


@query("stream_order_log", "D6 S5 R1 F2",
       sql="WITH " + _BRONZE + " SELECT * FROM bronze")
def stream_order_log(spark, sf_dir):
    """The order event log through the envelope, with its event time parsed. The
    log comes in portions, each streamed to the sink before the next is appended; what
    has been read of the envelope is dropped, so that the log is not kept twice."""
    base = work_path(spark, "stream_order_log")
    at = F.timestamp_seconds("ts_seconds")
    for log in pipeline.log_portions(spark, sf_dir):
        envelope = jobs.to_envelope(log.withColumn("_at", at), "order_id", "_at", value_columns=log.columns)
        envelope.write.mode("append").option("compression", "zstd").parquet(f"{base}/in")
        s = jobs.parse_envelope(jobs.file_stream(spark, f"{base}/in", ENVELOPE_SCHEMA, consume=True), log.schema)
        jobs.run_to_files(s.withColumn("event_timestamp", parse_iso_ts("ts").cast("timestamp_ntz")), f"{base}/out", f"{base}/cp", compression="zstd")
    return spark.read.parquet(f"{base}/out")


@query("stream_to_table", "K9 D20",
       sql="SELECT count(*) AS purchases, sum(value) AS purchase_total FROM events WHERE event_type = 'purchase'")
def stream_to_table(spark, sf_dir):
    """Event log -> envelope -> parsed stream -> named table -> filtered total."""
    base, name = work_path(spark, "stream_table"), table_name("events_stream")
    jobs.to_envelope(load(spark, sf_dir, "events"), "event_id", "ts").write.json(f"{base}/in")
    s = jobs.parse_envelope(jobs.file_stream(spark, f"{base}/in", ENVELOPE_SCHEMA, fmt="json"), EVENTS_SCHEMA)
    jobs.run_to_table(s.withColumn("processed_at", F.current_timestamp()), name, f"{base}/table", f"{base}/cp")
    t = spark.table(name).filter(F.col("event_type") == "purchase")
    return t.agg(F.count(F.lit(1)).alias("purchases"), F.sum("value").alias("purchase_total"))


@query("stream_chain", "S9 K9", sql="SELECT * FROM events WHERE value > 10")
def stream_chain(spark, sf_dir):
    """A stream appends to a named table, a second one reads that table."""
    base, name = work_path(spark, "stream_chain"), table_name("events_chain")
    jobs.run_to_table(_events_stream(spark, sf_dir), name, f"{base}/a", f"{base}/cp_a")
    jobs.run_to_files(jobs.table_stream(spark, name).filter(F.col("value") > 10), f"{base}/b", f"{base}/cp_b")
    return spark.read.parquet(f"{base}/b")


@query("stream_restart_no_dups", "R8 U4 R11",
       sql="SELECT count(*) AS total_rows, count(DISTINCT event_id) AS distinct_ids FROM events")
def stream_restart_no_dups(spark, sf_dir):
    base = work_path(spark, "stream_restart")
    e = load(spark, sf_dir, "events")
    half = e.agg(F.percentile_approx("event_id", 0.5)).scalar()
    e.filter(F.coalesce(F.col("event_id") <= half, F.lit(True))).write.parquet(f"{base}/in")
    jobs.run_to_files(jobs.file_stream(spark, f"{base}/in", EVENTS_SCHEMA), f"{base}/out", f"{base}/cp")
    e.filter(~F.coalesce(F.col("event_id") <= half, F.lit(True))).write.mode("append").parquet(f"{base}/in")
    # second run, same checkpoint: only the new files are read
    jobs.run_to_files(jobs.file_stream(spark, f"{base}/in", EVENTS_SCHEMA), f"{base}/out", f"{base}/cp")
    out = spark.read.parquet(f"{base}/out")
    return out.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct("event_id").alias("distinct_ids"))


@query("stream_dedup", "U3 R5 R8", sql="SELECT event_id, ts, event_type, value FROM events")
def stream_dedup(spark, sf_dir):
    """Envelope files in which every third event comes twice, the copy in a later
    file and with another value: the first row of each key goes on."""
    base = work_path(spark, "stream_dedup")
    e = load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_time"), "event_type", "value")
    e.write.parquet(f"{base}/in")
    checkpoint = (f"{base}/out", f"{base}/cp")

    def first_rows():
        s = jobs.file_stream(spark, f"{base}/in", e.schema)
        return jobs.run_to_files(jobs.dedup_within_watermark(s, ["event_id"], "event_time", "40 days"), *checkpoint)

    first_rows()
    e.where(F.col("event_id") % 3 == 0).withColumn("value", F.col("value") + 1).write.mode("append").parquet(f"{base}/in")
    first_rows()  # second run, same checkpoint: only copies are new
    return spark.read.parquet(f"{base}/out").select("event_id", F.col("event_time").cast("timestamp_ntz").alias("ts"), "event_type", "value")


@query("stream_to_files", "K10 K7 R7", sql="SELECT *, CAST(ts AS DATE) AS event_date FROM events")
def stream_to_files(spark, sf_dir):
    """Checkpointed append of a stream into date-partitioned Parquet."""
    base = work_path(spark, "stream_to_files")
    s = _events_stream(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    jobs.run_to_files(s, f"{base}/out", f"{base}/cp", partition_by=["event_date"])
    return spark.read.parquet(f"{base}/out")


@query("to_envelope", "K12 F11",
       sql="""SELECT CAST(event_id AS VARCHAR) AS key,
       CAST(json_object('event_id', event_id, 'ts', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'user_id', user_id,
                        'event_type', event_type, 'value', value, 'props', props) AS VARCHAR) AS value,
       ts AS timestamp FROM events""")
def to_envelope(spark, sf_dir):
    env = jobs.to_envelope(load(spark, sf_dir, "events"), "event_id", "ts")
    return env.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))

"""Streaming behaviour beyond the oracle checks: late data, restart, rate source."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.catalog import QUERIES
from tessera.plans.check import compare, duckdb_frame
from tessera.plans.q_files import EVENTS_SCHEMA
from tessera.session import work_path
from tessera.sources import load
from tessera.streaming import jobs
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])


def test_watermark_drops_only_rows_beyond_delay(spark):
    base = work_path(spark, "t_wm")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    batches = [[(1, t0), (2, t0 + dt.timedelta(minutes=1))],
               [(3, t0 + dt.timedelta(hours=1))],                       # advances the watermark
               [(4, t0 + dt.timedelta(minutes=2)),                      # far too late: dropped
                (5, t0 + dt.timedelta(hours=1, minutes=1))]]
    for b in batches:  # one run per landed file, same checkpoint: one batch each
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        s = jobs.file_stream(spark, f"{base}/in", SCHEMA).withColumn("et", jobs.event_time("ts"))
        agg = jobs.tumbling(s, "et", 300, [], [F.count(F.lit(1)).alias("n")], "10 minutes")
        jobs.run_update_mode(agg, f"{base}/out", f"{base}/cp")
    final = {r.window_start: r.n for r in jobs.latest_state(spark, f"{base}/out", ["window_start"]).collect()}
    assert final[t0] == 2  # the late row 4 was not added to the first window


def test_windows_keep_every_row_of_many_files(spark):
    """Events cut into files that cover the same time span, and rows without a time."""
    base = work_path(spark, "t_files")
    events = load(spark, SF_SMALL, "events").select(*EVENTS_SCHEMA.names)
    no_time = events.limit(3).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    events.unionByName(no_time).repartition(6).write.parquet(f"{base}/events.parquet")
    n = events.count() + 3
    for name, column in (("stream_tumbling_counts", "count"), ("stream_tumbling_revenue", "orders")):
        got = QUERIES[name].fn(spark, base).agg(F.sum(column)).first()[0]
        assert got == (n if name.endswith("counts") else events.unionByName(no_time).filter("event_type = 'purchase'").count())
    want = duckdb_frame(QUERIES["stream_watermark_append"].sql, SF_SMALL)
    assert compare(QUERIES["stream_watermark_append"].fn(spark, base).toPandas(), want) == []
    assert QUERIES["stream_ingest_files"].fn(spark, base).count() == n


def test_restart_resumes_without_duplicates(spark):
    base = work_path(spark, "t_restart")
    t0 = dt.datetime(2024, 1, 1)
    for rows in (range(10), range(10, 15)):
        spark.createDataFrame([(i, t0) for i in rows], SCHEMA).write.mode("append").parquet(f"{base}/in")
        jobs.run_to_files(jobs.file_stream(spark, f"{base}/in", SCHEMA), f"{base}/out", f"{base}/cp")
        assert jobs.rows_written(spark, f"{base}/out") == rows.stop
    assert spark.read.parquet(f"{base}/out").select("id").distinct().count() == 15


def test_rate_source_with_processing_time(spark):
    base = work_path(spark, "t_rate")
    s = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).load()
    s = s.withColumn("event_type", F.when(F.col("value") % 2 == 0, "click").otherwise("view"))
    q = jobs.run_to_files(s, f"{base}/out", f"{base}/cp", every="1 second")
    while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] < 1):
        q.awaitTermination(1)
    q.stop()
    rows = spark.read.parquet(f"{base}/out")
    assert rows.count() >= 20 and rows.select("event_type").distinct().count() == 2

"""Keyed dedup, mergeable states, streaming dedup, folded state, progress."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import rollup
from tessera.operators.dedup import latest_by_key
from tessera.plans.catalog import QUERIES
from tessera.plans.check import compare, duckdb_frame
from tessera.session import work_path
from tessera.sinks import tables as sink
from tessera.streaming import jobs
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["dedup_conflicts", "distinct_rollup", "quantile_rollup", "incremental_gold", "stream_dedup",
                                  "raw_to_events", "partition_stats", "schema_evolution", "stream_restart_no_dups", "stream_tumbling_counts", "event_profile"])
def test_query(spark, name):
    assert compare(QUERIES[name].fn(spark, SF_SMALL).toPandas(), duckdb_frame(QUERIES[name].sql, SF_SMALL)) == []


def test_one_row_for_each_key(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice(["a", None]), rnd.choice([5, -7, None]), rnd.choice("xyz"), [1, 2]) for _ in range(500)]
    df = spark.createDataFrame(rows, "k long, j string, t long, v string, other array<int>").repartition(5)
    got = latest_by_key(df, ["k", "j"], F.col("t"), F.ascii("v")).collect()
    want = {}
    for r in rows:
        key = (r[2] if r[2] is not None else -10 ** 20, r[3])
        want[r[:2]] = max(want.get(r[:2], key), key)
    assert {(r.k, r.j): (r.t if r.t is not None else -10 ** 20, r.v) for r in got} == want and len(got) == len(want) == 8
    assert latest_by_key(df, ["k"], -F.col("t")).count() == 4
    assert latest_by_key(df.limit(0), ["k"], F.col("t")).collect() == []


def test_dedup_has_no_sort_and_two_exchanges(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id", F.col("id").cast("string").alias("v"))
    plan = latest_by_key(df, ["k"], F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan and " Sort " not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_distinct_states_of_any_ids(spark):
    rows = [(g, i) for g in ("a", "b") for i in [0, -1, 1, 32768, 32769, 10 ** 12, -(10 ** 6), 5, 5, None]] + [("b", 77), ("c", None)]
    df = spark.createDataFrame(rows, "g string, id long")
    states = rollup.distinct_states(df, ["g"], "id")
    assert {r["_level0"]: r["n"] for r in rollup.distinct_counts(states, [F.col("g")], "n").collect()} == {"a": 8, "b": 9}
    assert [r["n"] for r in rollup.distinct_counts(states, [F.lit(1)], "n").collect()] == [9]


def test_sketch_ranks_of_many_values(spark):
    df = spark.range(200_000).select((F.col("id") % 50).alias("g"), (F.hash("id") % 100_000).cast("double").alias("x"))
    states = rollup.merged_quantiles(rollup.quantile_states(df, ["g"], "x"), [])
    for share in (0.05, 0.5, 0.95):
        value = states.select(rollup.quantile(share).alias("q")).first()["q"]
        assert abs(df.where(F.col("x") <= value).count() / 200_000 - share) < 0.01
    first = states.first()
    assert first["n"] == 200_000 and [first["low"], first["high"]] == list(df.agg(F.min("x"), F.max("x")).first())


SCHEMA = "id long, event_time timestamp, v string"


def test_stream_dedup_forgets_old_keys(spark):
    base, t0 = work_path(spark, "t_dedup"), dt.datetime(2024, 1, 1)

    def load(rows):
        spark.createDataFrame([(i, t0 + dt.timedelta(hours=h) if h is not None else None, v) for i, h, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        s = jobs.dedup_within_watermark(jobs.file_stream(spark, f"{base}/in", SCHEMA), ["id"], "event_time", "2 hours")
        q = jobs.run_to_files(s, f"{base}/out", f"{base}/cp")
        return q.lastProgress["stateOperators"][0]["numRowsTotal"]

    load([(i, 0, "first") for i in range(100)] + [(5000, None, "no time")])
    load([(i, 1, "again") for i in range(50)])
    assert load([(1000 + i, 24, "next day") for i in range(10)]) <= 110
    assert load([(2000 + i, 48, "day after") for i in range(10)]) <= 20  # keys of the first day are gone
    rows = spark.read.parquet(f"{base}/out").collect()
    assert len(rows) == len({r.id for r in rows}) == 120 and {r.v for r in rows} == {"first", "next day", "day after"}


def test_folded_state_reads_later_batches_only(spark):
    base, t0 = work_path(spark, "t_fold"), dt.datetime(2024, 1, 1)
    out = f"{base}/out"

    def load(rows):
        spark.createDataFrame([(i, t0, "x") for i in rows], SCHEMA).write.mode("append").parquet(f"{base}/in")
        agg = jobs.file_stream(spark, f"{base}/in", SCHEMA).groupBy("id").agg(F.count("*").alias("n"))
        jobs.run_update_mode(agg, out, f"{base}/cp")
        return {r.id: r.n for r in jobs.latest_state(spark, out, ["id"]).collect()}

    assert jobs.fold_state(spark, f"{base}/none", ["id"]) is None
    load(range(10))
    first = jobs.fold_state(spark, out, ["id"])
    assert first and jobs.fold_state(spark, out, ["id"]) == first
    want = {**dict.fromkeys(range(5), 2), **dict.fromkeys(range(5, 10), 1)}
    assert load(range(5)) == want
    second = jobs.fold_state(spark, out, ["id"])
    assert second > first and {r.id: r.n for r in jobs.latest_state(spark, out, ["id"]).collect()} == want
    plan = jobs.latest_state(spark, out, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "_batch" in plan and "PartitionFilters" in plan
    assert load([0, 20])[0] == 3


def test_progress_counts_every_batch(spark):
    base = work_path(spark, "t_progress")
    s = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 3).load()
    with jobs.Progress(spark) as progress:
        q = jobs.run_to_files(s, f"{base}/out", f"{base}/cp", every="0 seconds")
        while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] < 6):
            q.awaitTermination(1)
        q.stop()
    assert progress.total(q) == progress.total() == 3 * len(progress.rows) >= 18
    assert abs(jobs.rows_written(spark, f"{base}/out") - progress.total()) <= 3  # a batch may be stopped between its write and its report


def test_file_counts_are_those_of_the_folder(spark):
    path = work_path(spark, "t_stats")
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    df.repartition(4).write.partitionBy("k").parquet(path)
    got = {r.k: r.files for r in sink.file_stats(spark, path, ["k"]).groupBy("k").agg(F.countDistinct("file_path").alias("files")).collect()}
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    want = {k: sum(x.getPath().getName().endswith(".parquet") for x in files.listStatus(place(f"{path}/k={k}"))) for k in range(3)}
    assert got == want


def test_rows_without_status_or_id_stay(spark):
    base = work_path(spark, "t_nulls")
    orders, events = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "events"))
    orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))).write.parquet(f"{base}/orders.parquet")
    events.withColumn("event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_id"))).write.parquet(f"{base}/events.parquet")
    assert QUERIES["schema_evolution"].fn(spark, base).count() == orders.count()
    assert QUERIES["stream_restart_no_dups"].fn(spark, base).first()["total_rows"] == events.count()


def test_wrong_means_fail_their_rules(spark):
    from tessera.operators import quality
    from tessera.plans.q_quality import RULES

    one = spark.createDataFrame([(250_000.0,), (25_000.0,), (2_500_000.0,)], "mean_total double")
    rules = {"mean_total": RULES["mean_total"]}
    assert sorted(r.passed for r in quality.report(one, rules).collect()) == [False, False, True]


def test_profile_scans_the_log_once(spark):
    plan = QUERIES["event_profile"].fn(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand ") == 1 and plan.count("Aggregate ") == 2 and "Join" not in plan and "Union" not in plan

"""Hand-made edge frames."""

import datetime as dt

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from tessera.functions.json import BODY_SCHEMA, parse_body
from tessera.functions.time import parse_iso_ts
from tessera.operators import changes, joins, quality, windows
from tessera.plans import medallion
from tests.conftest import SF_SMALL


def test_malformed_json_keeps_row_and_nulls_fields(spark):
    bodies = ['{"brand_id": 3, "total": 9.5}', '{"brand_id": 3, "tot', '{"brand_id": 3, "total": 9.5',
              '{brand_id": 3}', '{"brand_id": 3,}', '{"brand_id": "x", "total": 1.0}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    out = df.select(parse_body("body").alias("p")).select("p.brand_id", "p.total").collect()
    assert len(out) == len(bodies)
    assert (out[0].brand_id, out[0].total) == (3, 9.5)
    for r in out[1:5]:
        assert r.brand_id is None and r.total is None
    assert out[5].brand_id is None and out[5].total == 1.0  # one bad field only
    good, bad = quality.split_json(df, "body")
    assert [r.body for r in good.collect()] == [bodies[0], bodies[5]] and bad.count() == 4
    wrong = quality.type_errors(df, "body", BODY_SCHEMA).collect()
    assert [(r.body, r.wrong_fields) for r in wrong] == [(bodies[5], ["brand_id"])]


def test_timestamps_with_and_without_fraction(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00",), ("2024-01-01T10:00:00.123456",), ("garbage",)], "ts string")
    got = [r.t for r in df.select(parse_iso_ts("ts").cast("timestamp_ntz").alias("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 10, 0, 0)
    assert got[1] == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert got[2] is None


def test_null_location_forms_its_own_lifecycle_group(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [("e1", "order_created", t0, "A", 1, "C1"), ("e2", "delivered", t0 + dt.timedelta(minutes=30), "A", None,
                                                         None),
            ("e3", "order_created", t0, "B", 1, "C1")]
    df = spark.createDataFrame(rows, "event_id string, event_type string, event_timestamp timestamp_ntz, "
                                     "order_id string, location_id int, city_name string")
    lc = medallion.lifecycle(df).collect()
    # order A splits: its delivered event (NULL location) is its own group;
    # the group with created_at has no delivered_at and is filtered out
    assert len(lc) == 1 and lc[0].order_id == "A" and lc[0].location_id is None and lc[0].created_at is None


def test_running_total_ties_and_hot_key(spark):
    rows = [Row(k=1, t=dt.datetime(2024, 1, 1), v=1.0), Row(k=1, t=dt.datetime(2024, 1, 1), v=2.0),
            Row(k=1, t=dt.datetime(2024, 6, 1), v=4.0), Row(k=2, t=dt.datetime(2024, 1, 1), v=8.0)]
    # a hot key: many rows across many buckets
    rows += [Row(k=3, t=dt.datetime(2020, 1, 1) + dt.timedelta(days=i), v=1.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v double")
    got = {(r.k, r.t, r.v): r.running_total for r in
           windows.running_total(df, ["k"], "t", "v", rows=100).collect()}
    assert got[(1, dt.datetime(2024, 1, 1), 1.0)] == 3.0 == got[(1, dt.datetime(2024, 1, 1), 2.0)]
    assert got[(1, dt.datetime(2024, 6, 1), 4.0)] == 7.0
    assert got[(3, dt.datetime(2020, 1, 1) + dt.timedelta(days=1999), 1.0)] == 2000.0
    rn = windows.row_number(df, ["k"], ["t", "v"], rows=100)
    r3 = sorted(r.order_rank for r in rn.filter("k = 3").collect())
    assert r3 == list(range(1, 2001))


@pytest.mark.parametrize("cut", [1, 5, 50, 1000])
def test_windows_equal_the_plain_window(spark, cut):
    """NULL keys, NULL order values, NULL values, ties, and a key whose rows all
    fall into an instant of the whole time range."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(None, t0, 1.0, 0), (None, None, 2.0, 1), (1, None, None, 2), (1, t0, None, 3), (1, t0, 3.0, 4),
            (2, t0, None, 5), (2, t0 + dt.timedelta(days=9), None, 6), (2, t0 + dt.timedelta(days=99), 4.0, 7)]
    rows += [(3, t0 + dt.timedelta(microseconds=i // 2), float(i % 7), 100 + i) for i in range(900)]
    rows += [(i % 40 + 10, t0 + dt.timedelta(days=i), 1.0, 2000 + i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v double, i int")
    w = Window.partitionBy("k").orderBy("t")
    want = sorted(map(tuple, df.withColumn("running_total", F.sum("v").over(w)).collect()), key=repr)
    assert sorted(map(tuple, windows.running_total(df, ["k"], "t", "v", rows=cut).collect()), key=repr) == want
    w = Window.partitionBy("k").orderBy("t", "i")
    want = sorted(map(tuple, df.withColumn("order_rank", F.row_number().over(w)).collect()), key=repr)
    assert sorted(map(tuple, windows.row_number(df, ["k"], ["t", "i"], rows=cut).collect()), key=repr) == want
    assert windows.running_total(df.limit(0), ["k"], "t", "v").collect() == []


def test_a_hot_key_fills_its_ranges(spark):
    """A key with a third of all rows, crowded into a day of ten years, is cut into even ranges."""
    hot = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") * 4).alias("s"))
    rest = spark.range(40000).select((F.col("id") + 2).alias("k"), (F.col("id") * 7889).alias("s"))
    df = hot.union(rest).select("k", F.timestamp_seconds("s").cast("timestamp_ntz").alias("t"), F.lit(1).alias("v"))
    large = windows._large_keys(df, ["k"], 1000)
    assert [tuple(r) for r in large.collect()] == [(1, 20000)]
    ranged = windows._ranged(df.where("k = 1"), "t", 40).groupBy("_b").count().collect()
    assert len(ranged) == 40 and max(r["count"] for r in ranged) < 600
    got = windows.running_total(df, ["k"], "t", "v", rows=1000).where("k = 1").select("t", "running_total").sort("t").collect()
    assert [r.running_total for r in got] == list(range(1, 20001))


def _shuffled_bytes(node) -> int:
    """Bytes written by the exchanges of an executed plan."""
    found = node.metrics().get("shuffleBytesWritten")
    own = found.get().value() if found.isDefined() and "Exchange" in node.nodeName() else 0
    children = node.children()
    return own + sum(_shuffled_bytes(children.apply(i)) for i in range(children.size()))


def test_orphans_by_bit_words(spark):
    """Exact on NULL, negative, extreme and repeated keys; far fewer bytes shuffled
    than by an anti join of keys, at 1 % of orphans."""
    edge = [None, 0, 1, 63, 64, -1, -64, -65, 2**63 - 1, -2**63, 5, 5]
    fact = spark.createDataFrame([(k,) for k in edge], "k long")
    dim = spark.createDataFrame([(k,) for k in (None, 1, 1, -64, 2**63 - 1, 700)], "d long")
    want = sorted({k for k in edge if k is not None} - {1, -64, 2**63 - 1})
    assert sorted(r.key for r in joins.orphan_keys(fact, "k", dim, "d").collect()) == want
    small = joins.orphan_keys(fact.where("k BETWEEN -99 AND 99").selectExpr("cast(k as int) as k"), "k", dim, "d")
    assert small.schema["key"].dataType.simpleString() == "int" and sorted(r.key for r in small.collect()) == [-65, -1, 0, 5, 63, 64]
    assert len(joins.orphan_keys(fact, "k", dim.limit(0), "d").collect()) == len(want) + 3
    names = [joins.orphan_keys(fact.selectExpr("string(k) as k"), "k", dim.selectExpr("string(d) as d"), "d")]
    assert sorted(int(r.key) for r in names[0].collect()) == want

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(0, 400000, 1, 4).select((F.col("id") % 200000).alias("k"))
        dims = spark.range(0, 200000, 1, 4).where("id % 100 != 7").withColumnRenamed("id", "d")
        bits = joins.orphan_keys(facts, "k", dims, "d")
        plain = facts.distinct().join(dims, facts.k == dims.d, "left_anti")
        found, expected = ({r[0] for r in df.collect()} for df in (bits, plain))
        assert found == expected == set(range(7, 200000, 100))
        few, many = (_shuffled_bytes(df._jdf.queryExecution().executedPlan()) for df in (bits, plain))
        assert 0 < few * 10 < many
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_change_log_reads(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    log = spark.createDataFrame([
        (1, "a", "I", 1, t(1)), (1, "b", "U", 2, t(2)), (2, "x", "I", 1, t(1)), (2, "x", "D", 3, t(3)),
        (3, "z", "I", 3, t(3))], "k int, c string, _op string, _version int, _committed_at timestamp_ntz")
    v1 = {r.k: r.c for r in changes.as_of_version(log, ["k"], 1).collect()}
    v3 = {r.k: r.c for r in changes.as_of_version(log, ["k"], 3).collect()}
    assert v1 == {1: "a", 2: "x"} and v3 == {1: "b", 3: "z"}
    hist = {r._version: r.live_rows for r in changes.snapshot_log(log).collect()}
    assert hist == {1: 2, 2: 2, 3: 2}
    kept = changes.expire_versions(log, ["k"], t(3), retain_last=1)
    # each key keeps its last change before the oldest retained version
    assert sorted((r.k, r._version) for r in kept.collect()) == [(1, 2), (2, 1), (2, 3), (3, 3)]
    assert {r.k: r.c for r in changes.as_of_version(kept, ["k"], 3).collect()} == v3


def test_update_delete_null_predicate(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "id int, v int")
    up = changes.update_where(df, F.col("v") > 10, {"v": F.lit(0)})
    assert sorted((r.id, r.v) for r in up.collect()) == [(1, None), (2, 5), (3, 0)]
    de = changes.delete_where(df, F.col("v") > 10)
    assert sorted(r.id for r in de.collect()) == [1, 2]


def test_compaction_spreads_a_hot_partition(spark):
    from pyspark.sql import functions as F

    from tessera.session import work_path
    from tessera.sinks import tables as sink

    src, dst = work_path(spark, "t_compact_src"), work_path(spark, "t_compact_dst")
    df = spark.range(0, 20000).select(F.when(F.col("id") < 15000, F.lit("hot")).otherwise(F.lit("cold")).alias("p"),
                                      F.col("id"))
    df.repartition(12).write.partitionBy("p").parquet(src)
    out = sink.compact(spark, src, dst, ["p"], target_bytes=20_000)  # tiny target: several files per partition
    files = out.groupBy("p").agg(F.countDistinct(F.col("_metadata.file_path")).alias("n")).collect()
    by_p = {r.p: r.n for r in files}
    assert by_p["hot"] > 1
    assert out.count() == 20000


def test_measures_observed_while_writing_equal_an_aggregation(spark, monkeypatch):
    from tessera.plans import pipeline

    observed = [df.first().asDict() for df in pipeline.dirty_measures(spark, SF_SMALL)]
    key = (*pipeline._key(spark, SF_SMALL), "dirty_silver")
    assert pipeline._WRITTEN[key].seen["rows_silver"] == observed[1]["rows_silver"] > 0
    monkeypatch.setitem(pipeline._WRITTEN, key, pipeline._WRITTEN[key]._replace(seen={}))
    again = [df.first().asDict() for df in pipeline.dirty_measures(spark, SF_SMALL)]
    for a, b in zip(observed, again):
        assert a.keys() == b.keys()
        assert all(a[n] == b[n] or abs(a[n] - b[n]) < 1e-6 * abs(a[n]) for n in a), (a, b)


def test_layers_of_no_orders(spark):
    """No order: every layer is empty, and the measures come from an aggregation."""
    from tessera.plans import pipeline
    from tessera.session import work_path

    base = work_path(spark, "t_no_orders")
    for name in pipeline.INPUTS:
        rows = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        (rows.limit(0) if name in ("orders", "lineitem") else rows).write.parquet(f"{base}/{name}.parquet")
    assert pipeline.order_cube(spark, base).count() == 0
    bronze, silver = (df.first() for df in pipeline.dirty_measures(spark, base))
    assert (bronze["rows_bronze"], silver["rows_silver"]) == (0, 0)

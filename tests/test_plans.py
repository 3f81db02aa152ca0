"""Plan shape: pushdown, pruning, broadcast choice, single-pass pivot."""

from tessera.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_and_columns_pruned(spark):
    p = plan(QUERIES["filter_range_and"].fn(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(value), IsNotNull(event_type), GreaterThan(value,10.0)" in p
    p2 = plan(QUERIES["project"].fn(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in p2


def test_broadcast_inner_join_is_broadcast(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["broadcast_inner_join"].fn(spark, SF_SMALL))


def test_shuffled_join_is_sort_merge(spark):
    p = plan(QUERIES["inner_join"].fn(spark, SF_SMALL))
    assert "SortMergeJoin" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_brands"].fn(spark, SF_SMALL))


def test_pivot_is_one_aggregate_pass(spark):
    p = plan(QUERIES["event_pivot"].fn(spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1


def test_lookup_broadcasts_by_bytes(spark):
    from tessera.operators.joins import left_lookup

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000b")
    try:
        fact = spark.range(0, 50000).withColumnRenamed("id", "k")
        small, large = (spark.range(0, n).withColumnRenamed("id", "k") for n in (100, 5000))
        assert "BroadcastHashJoin" in plan(left_lookup(fact, small, "k"))
        p = plan(left_lookup(fact, large, "k"))
        assert "BroadcastHashJoin" not in p and "SinglePartition" not in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_per_key_does_not_sort(spark):
    for name in ("as_of_version", "as_of_timestamp", "dedup_events"):
        assert "SortAggregate" not in plan(QUERIES[name].fn(spark, SF_SMALL)), name


def test_gold_reads_prune_silver_partitions(spark):
    from tessera.plans import medallion, pipeline

    silver = pipeline.silver_orders(spark, SF_SMALL)
    for df in (medallion.order_cube(silver), medallion.lifecycle(silver)):
        p = plan(df)
        assert "PartitionFilters: [isnotnull(event_type" in p or "PartitionFilters: [event_type" in p, p
    assert "body" not in plan(medallion.order_cube(silver)).split("ReadSchema")[1].split("\n")[0]


def test_dates_prune_silver_periods(spark):
    from tessera.plans import pipeline

    p = plan(pipeline.silver_orders(spark, SF_SMALL, "1996-03-15", "1996-06-14"))
    assert "event_period" in p.split("PartitionFilters: [")[1].split("]")[0], p


def test_period_follows_the_size(spark, monkeypatch):
    from tessera.plans import pipeline

    found = []
    for size in (10 ** 5, 10 ** 10, 10 ** 12):
        pipeline._GRAIN.clear()
        monkeypatch.setattr(pipeline, "planned_bytes", lambda df: size)
        found.append(pipeline.grain(spark, SF_SMALL))
    pipeline._GRAIN.clear()
    assert found == ["year", "month", "day"]


def test_silver_is_a_narrow_pass_over_bronze(spark):
    from tessera.plans import domain, medallion, pipeline

    p = plan(medallion.silver(pipeline.bronze_orders(spark, SF_SMALL), domain.locations(spark, SF_SMALL)))
    assert "Exchange hashpartitioning" not in p and "BroadcastHashJoin" in p

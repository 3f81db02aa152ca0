"""The layers of the event log: headers shuffled, events only passed on, parts by event type,
none written for a query that goes over the log once."""

from __future__ import annotations

import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import hashing
from tessera.functions.constants import CREATED, PING
from tessera.operators import generate
from tessera.plans import domain, medallion, pipeline
from tessera.plans.catalog import QUERIES
from tessera.session import work_path
from tessera.streaming import jobs

CONCURRENT = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def tables(spark):
    """Few orders: one twice, one without a date, one without customer and items."""
    base = work_path(spark, "t_layers")
    orders = [(1, 1, "1996-01-01", 10.5), (2, 2, "1996-12-31", 20.25), (2, 2, "1996-12-31", 20.25), (3, 1, None, 5.0), (4, None, "1997-05-05", None), (5, 9, "1998-02-28", 7.0)]
    (spark.createDataFrame(orders, "o_orderkey long, o_custkey long, d string, o_totalprice double")
     .select("o_orderkey", "o_custkey", F.col("d").cast("date").alias("o_orderdate"), "o_totalprice").write.parquet(f"{base}/orders.parquet"))
    spark.createDataFrame([(1, 3), (2, None)], "c_custkey long, c_nationkey int").write.parquet(f"{base}/customer.parquet")
    spark.createDataFrame([(1, 7, 1), (1, 8, 2), (2, 8, 1), (3, 9, 1)], "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(f"{base}/lineitem.parquet")
    spark.createDataFrame([(7, "Brand#11"), (8, "Brand#23")], "p_partkey long, p_brand string").write.parquet(f"{base}/part.parquet")
    spark.createDataFrame([(3, "PARIS")], "n_nationkey int, n_name string").write.parquet(f"{base}/nation.parquet")
    return base


def parts(spark, base):
    key = pipeline._key(spark, base)
    return {k[-1] for k in pipeline._WRITTEN if k[:-1] == key}


def test_parts_hold_the_whole_log(spark, tables):
    raw = domain.order_event_log(spark, tables)
    assert raw.where(F.col("event_type") == PING).count() > 0
    for types in (pipeline.ALL, (CREATED,), (PING,), ("delivered", CREATED)):
        stored, wanted = pipeline.event_log(spark, tables, types), raw.where(F.col("event_type").isin(*types))
        assert stored.count() == wanted.count() > 0
        assert stored.select(*raw.columns).exceptAll(wanted).isEmpty() and wanted.exceptAll(stored.select(*raw.columns)).isEmpty()


def test_gold_of_created_orders_writes_no_other_events(spark, tables):
    QUERIES["brand_orders_inner"].fn(spark, tables).collect()
    assert parts(spark, tables) == {"order_headers", "bronze_orders/created"}
    QUERIES["brand_summary"].fn(spark, tables).collect()
    assert parts(spark, tables) == {"order_headers", "bronze_orders/created", "orders_enriched/created", "order_cube"}


def test_top_brands_stores_created_orders_only(spark, tables):
    rows = QUERIES["top_brands"].fn(spark, tables).collect()
    assert parts(spark, tables) == {"order_headers", "bronze_orders/created", "orders_enriched/created", "order_cube"}
    # an order without a date has no event time; one without items or with an unknown part has no brand
    assert [tuple(r) for r in rows] == [(23, "Brand#23", 2, 40.5, 20.25), (11, "Brand#11", 1, 10.5, 10.5), (None, None, 2, 7.0, 7.0)]


def test_events_are_neither_shuffled_nor_sorted(spark, tables, monkeypatch):
    plans = []

    def watched(group):
        def build(own):
            df = group(own)
            assert spark.conf.get(CONCURRENT, None) == before  # set while a layer is written only
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return df

        return build

    before, event_layer = spark.conf.get(CONCURRENT, None), pipeline.event_layer
    monkeypatch.setattr(pipeline, "event_layer", lambda s, d, name, build, types: event_layer(s, d, name, watched(build), types))
    pipeline.bronze_orders(spark, tables)
    assert len(plans) == len(pipeline.GROUPS)
    assert not any("Exchange" in p or "Sort" in p for p in plans)
    assert spark.conf.get(CONCURRENT, None) == before
    with pipeline._many_files(spark):
        assert spark.conf.get(CONCURRENT) == str(pipeline.OPEN_FILES)


def same_rows(a, b):
    found, wanted = ([*map(str, df.select(*sorted(b.columns)).collect())] for df in (a, b))
    assert sorted(found) == sorted(wanted) != []


ONE_PASS = ("bronze_orders", "driver_pings", "duplicate_audit", "event_profile", "filter_not_null", "inject_bad_json", "inject_duplicates", "inject_nulls",
            "late_arrivals", "quarantine_json", "dedup_events", "orders_enriched", "order_lifecycle")


def test_one_pass_over_the_log_stores_no_events(spark, tables):
    for name in ONE_PASS:
        assert QUERIES[name].fn(spark, tables).collect()
        assert parts(spark, tables) == {"order_headers"}, name
    QUERIES["delivery_performance"].fn(spark, tables).collect()
    assert parts(spark, tables) == {"order_headers", "order_lifecycle"}
    QUERIES["quality_report"].fn(spark, tables).collect()
    assert parts(spark, tables) == {"order_headers", "order_lifecycle", "dirty_silver"}
    assert {r.event_type for r in pipeline.dirty_silver(spark, tables).collect()} == {CREATED}


@pytest.mark.parametrize("written", [(), (PING, CREATED)])
def test_rows_are_the_same_whichever_parts_are_written(spark, tables, written):
    if written:
        pipeline.stored_silver(spark, tables, written)
    before = parts(spark, tables)
    raw = domain.order_event_log(spark, tables)
    bronze = medallion.bronze_orders(raw)
    silver = medallion.silver(bronze, domain.locations(spark, tables))
    for types in (pipeline.ALL, ("delivered", CREATED)):
        for rows, wanted in ((pipeline.log_rows, raw), (pipeline.bronze_rows, bronze), (pipeline.silver_rows, silver)):
            found = rows(spark, tables, types)
            assert dict(found.dtypes) == dict(wanted.dtypes)
            same_rows(found, wanted.where(F.col("event_type").isin(*types)))
    assert parts(spark, tables) == before | {"order_headers"}


def test_many_headers_are_dealt_to_many_tasks(spark, tables, monkeypatch):
    pipeline.headers(spark, tables)
    monkeypatch.setattr(pipeline, "DERIVED_BYTES", 10_000)
    tasks = pipeline._ranges(spark, tables, 10_000)
    assert tasks > spark.sparkContext.defaultParallelism
    log = pipeline.log_rows(spark, tables)
    assert "rangepartitioning(o_orderdate" in (plan := log._jdf.queryExecution().executedPlan().toString()) and f", {tasks})" in plan
    same_rows(log, domain.order_event_log(spark, tables))


def test_split_does_not_repeat_the_text(spark, tables):
    """The formula of a body is not pushed into the filters of the split."""
    p = QUERIES["quarantine_json"].fn(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in p.splitlines() if "Filter" in line]
    assert any("_malformed" in f for f in filters) and not any("json_object_keys" in f for f in filters)


def generated_code(spark, df):
    """Size of the largest method that Spark generates for a frame, in bytes."""
    text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(df._jdf.queryExecution().executedPlan())
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


@pytest.mark.parametrize("name", ["inject_nulls", "inject_bad_json", "quarantine_json", "quality_report"])
def test_code_of_a_row_is_compiled(spark, tables, name):
    """The JVM interprets methods above 8000 bytes, several times slower."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    pipeline.headers(spark, tables)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # its plans have no code before they run
    try:
        df = pipeline._dirty_build(spark, tables)[0] if name == "quality_report" else QUERIES[name].fn(spark, tables)
        assert 0 < generated_code(spark, df) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_silver_parses_a_body_once(spark, tables):
    plan = pipeline.silver_rows(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == len({kind for kind, _, _ in medallion.BODY_FIELDS.values()})


def test_chance_compares_the_number_of_the_digest(spark):
    keys = spark.range(3000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("k"))
    for rate in (0.0, 0.01, 0.05, 0.5, 1 - 2 ** -32, 1.0, 1.5, -0.5):
        wrong = keys.where(~hashing.chance("k", "s", rate).eqNullSafe(hashing.uhash("k", "s") < int(rate * hashing.HASH_SPAN)))
        assert wrong.isEmpty(), rate


def test_bad_json_of_each_kind(spark):
    """As before, whichever way the formula is written: each kind of damage, texts it cannot touch, no text."""
    bodies = ['{"a":"x","b":1.5,"c":null}', '{"a":1}', "{}", "plain", "", None, '[1, 2, "three"]']
    rows = spark.createDataFrame([(f"{i}-{j}", b) for i in range(40) for j, b in enumerate(bodies)], "event_id string, body string")
    seen = set()
    for r, before in zip(generate.inject_bad_json(rows, 0.9).orderBy("event_id").collect(), rows.orderBy("event_id").collect()):
        b = before.body
        seen.add((r.corruption, b))
        wanted = b
        if b is not None:
            if r.corruption == "truncate" and len(b) > 10:
                wanted = b[:len(b) // 2]
            elif r.corruption == "missing_brace" and b.endswith("}"):
                wanted = b[:-1]
            elif r.corruption == "missing_quote" and '"' in b:
                wanted = b.replace('"', "", 1)
            elif r.corruption == "extra_comma" and b.endswith("}"):
                wanted = b[:-1] + ",}"
        assert r.body == wanted, (r, b)
    assert len({kind for kind, _ in seen}) == 5


def test_export_shuffles_headers_and_stores_no_log(spark, tables, monkeypatch):
    monkeypatch.setattr(pipeline, "DERIVED_BYTES", 10_000)
    raw = domain.order_event_log(spark, tables)
    assert (timeless := raw.where(F.col("ts_seconds").isNull()).count()) > 0
    ranges = pipeline.log_in_ranges(spark, tables)
    plan = ranges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(sequence(0") < plan.index("RepartitionByExpression [cell")  # what is above comes later
    assert not any("body" in line for line in plan[plan.index("RepartitionByExpression"):].splitlines())
    order = F.struct(F.coalesce("ts_seconds", F.lit(-1)).alias("at"), "sequence")
    same_rows(ranges, raw)
    own = ranges.groupBy(F.spark_partition_id().alias("part")).agg(F.min(order).alias("low"), F.max(order).alias("high"), F.count("*").alias("n")).orderBy("part").collect()
    assert len(own) > 2 and all(tuple(a.high) <= tuple(b.low) for a, b in zip(own, own[1:]))
    assert sum(r.n for r in own) == raw.count() and own[0].n < timeless  # events without a time are dealt out too
    files = QUERIES["export_sorted"].fn(spark, tables)
    same_rows(files, raw)
    assert parts(spark, tables) == {"order_headers"}
    rows = files.select("_metadata.file_path", *raw.columns).toPandas().groupby("file_path", sort=True)
    found = [[(-1 if t != t else int(t), s) for t, s in zip(f.ts_seconds, f.sequence)] for _, f in rows]
    assert all(f == sorted(f) for f in found)
    assert all(a[-1] <= b[0] for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("written", [(), (CREATED,)])
def test_streamed_log_keeps_no_second_copy(spark, tables, monkeypatch, written):
    monkeypatch.setattr(pipeline, "DERIVED_BYTES", 3_000)
    monkeypatch.setattr(pipeline, "PORTION_TASKS", 1)
    if written:
        pipeline.bronze_orders(spark, tables, written)
    wanted = medallion.bronze_orders(domain.order_event_log(spark, tables))
    portions = [*pipeline.log_portions(spark, tables)]
    assert len(portions) > 2
    same_rows(reduce(DataFrame.unionByName, portions), wanted.drop("event_timestamp"))
    places, file_stream = [], jobs.file_stream
    monkeypatch.setattr(jobs, "file_stream", lambda s, path, *a, **b: places.append(path) or file_stream(s, path, *a, **b))
    same_rows(QUERIES["stream_order_log"].fn(spark, tables), wanted)
    assert len(places) == len(portions) and len({*places}) == 1
    left = spark.read.schema("key string").parquet(places[0]).count()
    assert left < wanted.count() / 2  # the last portions at most: what a batch has read goes as the next begins


def test_streams_leave_files_of_others(spark):
    base = work_path(spark, "t_stream")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).write.mode("append").parquet(f"{base}/in")
        jobs.run_to_files(jobs.file_stream(spark, f"{base}/in", spark.range(1).schema), f"{base}/out", f"{base}/cp")
    assert spark.read.parquet(f"{base}/in").count() == spark.read.parquet(f"{base}/out").count() == 30


def test_dedup_deals_events_by_order(spark, tables):
    df = QUERIES["dedup_events"].fn(spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    events = plan[:plan.rindex("Generate explode(sequence(0")]
    assert events.count("Exchange hashpartitioning") == events.count("Exchange hashpartitioning(order_id") == 1
    with_copies = generate.inject_duplicates(domain.order_event_log(spark, tables))
    assert with_copies.count() > df.count()
    same_rows(df, with_copies.groupBy("event_id").agg(F.min("ts_seconds").alias("ts_seconds"), F.min("event_type").alias("event_type"),
                                                      F.min("order_id").alias("order_id"), F.min("sequence").alias("sequence")))

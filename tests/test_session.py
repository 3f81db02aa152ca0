"""Settings, shared folders, layers and partitioned writes."""

import types

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.plans import pipeline
from tessera.session import work_path
from tessera.sinks import tables as sink
from tests.conftest import SF_SMALL


def _context(master: str, folder: str | None):
    unset = types.SimpleNamespace(isDefined=lambda: folder is not None, isEmpty=lambda: folder is None, get=lambda: folder)
    context = types.SimpleNamespace(master=master, getConf=lambda: {}, _jsc=types.SimpleNamespace(sc=lambda: types.SimpleNamespace(getCheckpointDir=lambda: unset)))
    return types.SimpleNamespace(sparkContext=context)


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(_context("spark://host:7077", None))
    with pytest.raises(RuntimeError):
        session.shared_root(_context("local-cluster[2,1,1024]", None))
    assert session.shared_root(_context("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_active_settings_are_kept(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert session.get_spark() is spark and spark.conf.get("spark.sql.shuffle.partitions") == "7"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_changed_input_gets_a_new_layer(spark):
    base = work_path(spark, "t_layer")
    for name in pipeline.INPUTS:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{base}/{name}.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    first = pipeline.order_cube(spark, base).agg(F.sum("orders")).first()[0]
    assert pipeline.order_cube(spark, base).agg(F.sum("orders")).first()[0] == first == orders.count()
    orders.limit(5).withColumn("o_orderkey", F.col("o_orderkey") + 10 ** 9).write.mode("append").parquet(f"{base}/orders.parquet")
    assert pipeline.order_cube(spark, base).agg(F.sum("orders")).first()[0] == first + 5


def test_a_hot_partition_value_is_written_by_several_tasks(spark):
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "64k"), spark.conf.set(keys[1], "8")
    try:
        df = spark.range(0, 80000, 1, 8).select(F.when(F.col("id") % 4 < 3, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 3)).alias("p"), F.xxhash64("id").alias("v"))
        out = sink.partitioned_write(df, work_path(spark, "t_hot_value"), ["p"])
        files = dict(out.groupBy("p").agg(F.countDistinct(F.col("_metadata.file_path"))).collect())
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert files["hot"] > 2 and files["k0"] <= 2 and out.count() == 80000

"""Parquet scans of the provided tables.

Schema comes from the file footer. We never select columns here: Catalyst
prunes the scan to the columns a query uses (``ReadSchema`` in the plan) and
pushes comparisons into the reader (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S1 Parquet scan of one provided table. The plan is made anew each time, so
    it sees the files that are there now."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """K8: one temp view per table so SQL text can use the bare names."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)

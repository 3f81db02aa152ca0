"""Registry of named queries: Spark implementation + optional DuckDB oracle.

``QUERIES[name].fn(spark, sf_dir) -> DataFrame`` runs the Spark job over the
whole provided tables; ``QUERIES[name].sql`` recomputes the same result in
DuckDB for checking, or is ``None`` when the operator is not expressible in
SQL (file-level and streaming jobs), in which case tests check it directly.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str  # SURVEY section-2 operator ids this query exercises


QUERIES: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, ids)
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from tessera.plans import (  # noqa: F401
        q_medallion, q_relational, q_functions, q_changes, q_generate, q_quality, q_files, q_streaming, q_ingest, q_sales, q_rollup,
    )


_load_all()

"""Every registered query with an oracle matches DuckDB on sf0.001."""

import pytest

from tessera.plans.catalog import QUERIES
from tessera.plans.check import compare, duckdb_frame
from tests.conftest import SF_SMALL

WITH_SQL = sorted(n for n, q in QUERIES.items() if q.sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, name):
    q = QUERIES[name]
    got = q.fn(spark, SF_SMALL).toPandas()
    want = duckdb_frame(q.sql, SF_SMALL)
    assert compare(got, want) == []


def test_registry_covers_entry_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(QUERIES) <= set(e.queries())


def test_orphan_files_are_those_of_the_stale_write(spark):
    got = QUERIES["orphan_files"].fn(spark, SF_SMALL).collect()
    assert got and all("/data/stale_write/part-" in r.path for r in got)


def test_every_query_has_an_oracle_or_a_test():
    assert [n for n, q in QUERIES.items() if q.sql is None] == ["orphan_files"]

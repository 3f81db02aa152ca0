"""Result comparison used by tests and ``python -m tessera.plans.check``.

Runs a registered Spark query and its DuckDB oracle on the same Parquet
files and compares: column names, row count, and values (order-insensitive;
floats with a relative tolerance; timestamps/dates normalised).
"""

from __future__ import annotations

import math
import sys

import pandas as pd

from tessera.sources.tables import TABLES, table_path


def duckdb_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con.execute(sql).df()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return float(v)
    except Exception:
        pass
    return v


def _key(v):
    if v is None:
        return (0, 0.0, "")
    if isinstance(v, (int, float)):
        return (1, float(f"{float(v):.9g}"), "")
    return (2, 0.0, str(v))


def rows_of(df: pd.DataFrame, cols: list[str]) -> list[tuple]:
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort(key=lambda r: tuple(_key(x) for x in r))
    return out


def same(a, b, rel=1e-9, abs_=1e-9) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=abs_)
    return str(a) == str(b)


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame, rel: float = 1e-9) -> list[str]:
    problems = []
    sc, oc = sorted(spark_pdf.columns), sorted(oracle_pdf.columns)
    if sc != oc:
        return [f"columns differ: spark={sc} oracle={oc}"]
    if len(spark_pdf) != len(oracle_pdf):
        problems.append(f"row count spark={len(spark_pdf)} oracle={len(oracle_pdf)}")
        return problems
    a, b = rows_of(spark_pdf, sc), rows_of(oracle_pdf, sc)
    bad = 0
    for ra, rb in zip(a, b):
        if not all(same(x, y, rel) for x, y in zip(ra, rb)):
            bad += 1
            if bad <= 3:
                problems.append(f"row differs:\n  spark ={ra}\n  oracle={rb}")
    if bad:
        problems.append(f"{bad} rows differ; columns {sc}")
    return problems


def check(name: str, sf_dir: str, spark=None, rel: float = 1e-9) -> list[str]:
    from tessera.plans.catalog import QUERIES
    from tessera.session import get_spark

    spark = spark or get_spark()
    q = QUERIES[name]
    if q.sql is None:
        return []
    sp = q.fn(spark, sf_dir).toPandas()
    od = duckdb_frame(q.sql, sf_dir)
    return compare(sp, od, rel)


if __name__ == "__main__":
    from tessera.plans.catalog import QUERIES
    from tessera.session import get_spark

    sf = "/root/testdata/sf0.01"
    names = sys.argv[1:] or [n for n, q in QUERIES.items() if q.sql]
    spark = get_spark()
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for n in names:
        try:
            p = check(n, sf, spark)
        except Exception as e:  # report and continue
            p = [f"error: {type(e).__name__}: {str(e)[:800]}"]
        print(("OK  " if not p else "FAIL") + " " + n, flush=True)
        for line in p:
            print("     " + line, flush=True)
        if p:
            failed.append(n)
    print("failed:", failed)

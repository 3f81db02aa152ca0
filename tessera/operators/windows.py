"""W1/W2 window operators that stay parallel under a hot partition key.

A plain ``Window.partitionBy(k).orderBy(t)`` sends every row of key ``k`` to
one task. That is right for keys of up to ``ROWS`` rows; the rows of larger keys
are cut by the ordering column into ranges of about equal rows:

1. rows are counted for each key (a partial aggregation);
2. split points = approximate quantiles of the ordering column over the rows of
   the large keys, as many as these rows need;
3. per (key, range) totals - a partial aggregation, skew-safe;
4. prefix over the ranges of a key - at most ``RANGES`` + 1 rows a key;
5. the window within (key, range) - a hot key is spread over its ranges;
6. result = prefix of earlier ranges + value within the range.

Ties on the ordering column fall in one range, so RANGE semantics (tied rows
share a running total) are kept. NULL keys form a key of their own, rows with a
NULL ordering value come first, as in a plain window. No row is dropped.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key that one task takes.
ROWS = 1_000_000
#: Most ranges the ordering column is cut into; beyond, ranges grow.
RANGES = 1024


def _same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[f"_k_{k}"])
    return cond


def _large_keys(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Keys with more than ``rows`` rows, as ``_k_`` columns, and their rows ``_n``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    return counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n").checkpoint()


def _ranged(df: DataFrame, order_col: str, ranges: int) -> DataFrame:
    """Adds ``_b``, the number of the range (binary search among the split points);
    NULL values in range -1."""
    value = F.col(order_col).cast("timestamp").cast("double")
    points = df.agg(F.percentile_approx(value, [i / ranges for i in range(1, ranges)], 8 * RANGES)).first()[0] or []
    splits = [float("-inf"), *sorted(set(points)), float("inf")]
    found = Bucketizer(splits=splits, inputCol="_v", outputCol="_b", handleInvalid="keep").transform(df.withColumn("_v", value))
    return found.withColumn("_b", F.when(F.col("_v").isNull(), -1).otherwise(F.col("_b").cast("int"))).drop("_v")


def _with_prefix(ranged: DataFrame, keys: list[str], total: Column, within: Column) -> DataFrame:
    """Adds ``_pre`` (total over the key's earlier ranges, NULL if none) and ``_in``."""
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    prefix = ranged.groupBy(*keys, "_b").agg(total.alias("_t")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_b2"), F.sum("_t").over(before).alias("_pre"))
    inside = ranged.withColumn("_in", within)
    return inside.join(prefix, (inside["_b"] == prefix["_b2"]) & _same_keys(inside, prefix, keys)).drop("_b2", *[f"_k_{k}" for k in keys])


def _windowed(df: DataFrame, keys: list[str], order_cols: list[str], out: str, value: Column, total: Column, combine: Column, rows: int) -> DataFrame:
    """``out`` = ``value`` over the window, the rows of large keys by ranges;
    ``combine`` puts ``_pre`` and ``_in`` together."""
    plain = value.over(Window.partitionBy(*keys).orderBy(*order_cols))
    large = _large_keys(df, keys, rows)
    n = large.agg(F.sum("_n")).first()[0]
    if n is None:
        return df.withColumn(out, plain)
    # two ranges for each task's rows, as a key's rows need not lie as all rows do
    ranged = _ranged(df.join(large, _same_keys(df, large, keys), "left_semi"), order_cols[0], min(RANGES, 2 * -(-n // rows)))
    within = value.over(Window.partitionBy(*keys, "_b").orderBy(*order_cols))
    hot = _with_prefix(ranged, keys, total, within).withColumn(out, combine).drop("_b", "_in", "_pre")
    return df.join(large, _same_keys(df, large, keys), "left_anti").withColumn(out, plain).unionByName(hot)


def running_total(df: DataFrame, keys: list[str], order_col: str, value_col: str,
                  out: str = "running_total", rows: int = ROWS) -> DataFrame:
    """sum(value) over (partition by keys order by order_col), default frame
    RANGE UNBOUNDED PRECEDING .. CURRENT ROW. NULL values add nothing; the total
    is NULL only while all values so far are NULL."""
    both = F.coalesce(F.col("_pre") + F.col("_in"), "_in", "_pre")
    return _windowed(df, keys, [order_col], out, F.sum(value_col), F.sum(value_col), both, rows)


def row_number(df: DataFrame, keys: list[str], order_cols: list[str], out: str = "order_rank", rows: int = ROWS) -> DataFrame:
    """row_number() over (partition by keys order by order_cols); the first
    order column is a timestamp/date used for the ranges, the rest must make the
    order unique (row_number is otherwise non-deterministic)."""
    both = (F.coalesce("_pre", F.lit(0)) + F.col("_in")).cast("int")
    return _windowed(df, keys, order_cols, out, F.row_number(), F.count(F.lit(1)), both, rows)

"""One whole row for each key, without a sort.

Copies of a key may differ in any column. The winner is elected on a value of
fixed width, (order, tie) packed into one decimal, so that a hash aggregation
with map-side partials does it however many copies a key has; only that number
travels. The rows are then semi-joined with the winners by hash, and rows that
are equal in all columns are folded where they already lie.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPAN = 1 << 63


def _packed(order: Column, tie: Column) -> Column:
    """Larger order first, then larger tie (0 .. 2**63 - 1); no order loses to any."""
    first = F.coalesce(order.cast("long"), F.lit(-_SPAN)).cast("decimal(19,0)")
    return (first * F.lit(Decimal(_SPAN))).cast("decimal(38,0)") + tie.cast("decimal(19,0)")


def latest_by_key(df: DataFrame, keys: list[str], order: Column, tie: Column | None = None) -> DataFrame:
    """One row of ``df`` for each key: that of the largest ``order`` (a number; for
    the earliest, its negative), of equals the one with the largest ``tie`` (by
    default a hash of the row). NULL keys are one key. All columns are kept."""
    if tie is None:
        tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).bitwiseAND(F.lit(_SPAN - 1))
    # a key is its value and whether it has one, so that plain equality joins NULLs too
    names = [f"_key{i}" for i in range(2 * len(keys))]
    columns = [c for k in keys for c in (F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit("")))]
    rows = df.select("*", *[c.alias(n) for c, n in zip(columns, names)], _packed(order, tie).alias("_rank"))
    winners = rows.groupBy(*names).agg(F.max("_rank").alias("_best")).select(*[F.col(n).alias(f"_of{n}") for n in names], "_best")
    # nothing is above the best, so ">=" finds it; as an equality it would be a part
    # of the join key and shuffle the winners once more
    cond = F.col("_rank") >= F.col("_best")
    for n in names:
        cond = cond & (F.col(n) == F.col(f"_of{n}"))
    return rows.join(winners.hint("shuffle_hash"), cond, "left_semi").dropDuplicates().select(*[F.col(f"`{c}`") for c in df.columns])

"""J1-J7 join helpers.

No side is broadcast by hand: Catalyst broadcasts a side whose size statistics
in bytes are below ``spark.sql.autoBroadcastJoinThreshold``, AQE does so at run
time when the actual bytes are, and splits skewed partitions of the shuffle
joins beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def left_lookup(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Fact LEFT JOIN dim; unmatched fact rows keep NULL attributes."""
    return fact.join(dim, on=on, how="left")


def _key_words(df: DataFrame, key: str) -> DataFrame:
    """(word, bits): the keys 64 * word + i for which bit i is set. Partial
    aggregation makes a row of up to 64 neighbouring keys before the shuffle."""
    k = F.col(key).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    return df.where(k.isNotNull()).groupBy(F.shiftright(k, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def _orphan_bits(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Keys of the fact's words that are not in the dimension's word."""
    kind = fact.select(fact_key).schema[0].dataType
    known = _key_words(dim, dim_key).withColumnRenamed("bits", "known")
    left = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("long"))))
    words = _key_words(fact, fact_key).join(known, "word", "left").select("word", left.alias("bits")).where("bits != 0")
    keys = words.select("word", "bits", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i")).where(F.getbit("bits", F.col("i")) == 1)
    return keys.select((F.col("word") * 64 + F.col("i")).cast(kind).alias("key"))


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct non-NULL fact keys missing from the dimension (left anti).

    Whole-number keys are compared as bit words: both sides shuffle a row for each
    64 neighbouring keys, exact, and a hot key is one bit of a task. Other keys
    go through a distinct and an anti join."""
    if all(isinstance(d.select(k).schema[0].dataType, T.IntegralType) for d, k in ((fact, fact_key), (dim, dim_key))):
        return _orphan_bits(fact, fact_key, dim, dim_key)
    # dedup first: a partial aggregation, so a hot key is one row per task
    # before anything is shuffled for the anti join
    keys = fact.select(F.col(fact_key).alias("key")).where(F.col("key").isNotNull()).distinct()
    return keys.join(dim.select(F.col(dim_key).alias("key")), on="key", how="left_anti")

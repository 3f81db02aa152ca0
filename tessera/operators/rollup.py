"""Gold measures that can be rolled up, kept as mergeable states.

A distinct count or a quantile of a day is not the sum or the mean of those of its
hours. Gold keeps the states instead: exact bitmaps of the ids (one of 4 KB for
each group and 32,768 ids that occur in it, compressed in Parquet) and KLL
sketches of the values. Coarser levels merge the states and never read the
facts again; a new load adds its states to those that are there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Items a quantile sketch keeps at its lowest level: rank error about 0.07 %.
SKETCH_SIZE = 4096


def distinct_states(df: DataFrame, keys: list[str], ids: str) -> DataFrame:
    """(keys, id_bucket, id_bits): the whole-number ids of each group as bitmaps.
    NULL ids are not counted."""
    known = df.where(F.col(ids).isNotNull())
    return known.groupBy(*keys, F.bitmap_bucket_number(ids).alias("id_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(ids)).alias("id_bits"))


def distinct_counts(states: DataFrame, keys: list[Column], out: str) -> DataFrame:
    """Exact distinct counts at any coarser level of the states' keys."""
    names = [f"_level{i}" for i in range(len(keys))]
    merged = states.groupBy(*[k.alias(n) for k, n in zip(keys, names)], "id_bucket").agg(F.bitmap_or_agg("id_bits").alias("id_bits"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("id_bits")).alias(out))


def quantile_states(df: DataFrame, keys: list[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """(keys, n, total, low, high, sketch) of the values that are not NULL."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"),
                                    F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("sketch"))


def merged_quantiles(states: DataFrame, keys: list[str], size: int = SKETCH_SIZE) -> DataFrame:
    """The same states at a coarser level."""
    return states.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
                                     F.kll_merge_agg_double("sketch", size).alias("sketch"))


def quantile(share: float) -> Column:
    """The value at this share of the ranks of a state."""
    return F.kll_sketch_get_quantile_double("sketch", F.lit(share))

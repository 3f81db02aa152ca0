"""Row changes, versions and history over a change log.

There is no table format here: a table's history is a change log with one
row per change ``(key, cols..., _op in {I,U,D}, _version, _committed_at)``.
Reading a version is a hash aggregation per key (latest version at or before
the one asked for: a number, so nothing is sorted and a key with very many
versions is reduced map-side), joined back to the change it names. A key has at
most one change in a version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

META = ("_op", "_version", "_committed_at")


def update_where(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """UPDATE t SET c = v WHERE p. Rows where p is NULL are left alone."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in assignments.items()})


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE FROM t WHERE p (NULL p keeps the row)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def evolve(old: DataFrame, new: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Append rows with added columns (old rows read NULL), then rename."""
    out = old.unionByName(new, allowMissingColumns=True)
    for a, b in (renames or {}).items():
        out = out.withColumnRenamed(a, b)
    return out


def _latest(log: DataFrame, keys: list[str]) -> DataFrame:
    latest = log.groupBy(*keys).agg(F.max("_version").alias("_latest")).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_latest")
    cond = log["_version"] == latest["_latest"]
    for k in keys:
        cond = cond & log[k].eqNullSafe(latest[f"_k_{k}"])
    return log.join(latest.hint("shuffle_hash"), cond, "left_semi")


def as_of_version(log: DataFrame, keys: list[str], version: int | Column) -> DataFrame:
    """T4: table state at ``version``: latest change per key, deletes removed."""
    v = F.lit(version) if not isinstance(version, Column) else version
    state = _latest(log.filter(F.col("_version") <= v), keys)
    return state.filter(F.col("_op") != "D").drop("_op", "_committed_at")


def as_of_timestamp(log: DataFrame, keys: list[str], ts) -> DataFrame:
    """T5: table state as of a commit time."""
    t = F.lit(ts) if not isinstance(ts, Column) else ts
    state = _latest(log.filter(F.col("_committed_at") <= t), keys)
    return state.filter(F.col("_op") != "D").drop("_op", "_committed_at")


def snapshot_log(log: DataFrame) -> DataFrame:
    """One row per version: commit time, inserts/updates/deletes, and the
    live row count after it. The running sum runs over versions only (one
    row per commit), so its single window partition is tiny."""
    per_v = log.groupBy("_version").agg(
        F.max("_committed_at").alias("committed_at"),
        F.count_if(F.col("_op") == "I").alias("inserted"),
        F.count_if(F.col("_op") == "U").alias("updated"),
        F.count_if(F.col("_op") == "D").alias("deleted"))
    w = Window.orderBy("_version").rowsBetween(Window.unboundedPreceding, 0)
    return per_v.withColumn("live_rows", F.sum(F.col("inserted") - F.col("deleted")).over(w))


def expire_versions(log: DataFrame, keys: list[str], older_than, retain_last: int = 5) -> DataFrame:
    """Drop history no retained version needs.

    Retained versions: committed at/after ``older_than``, plus the last
    ``retain_last``. Kept rows: every change at or after the oldest retained
    version, plus, per key, the latest change before it unless that is a
    delete (it carries the key's state into the retained range).
    """
    versions = log.groupBy("_version").agg(F.max("_committed_at").alias("c"))
    w = Window.orderBy(F.desc("_version"))
    ranked = versions.withColumn("_rk", F.row_number().over(w))  # one row per commit: tiny
    floor_v = ranked.filter((F.col("c") >= F.lit(older_than)) | (F.col("_rk") <= retain_last)).agg(
        F.min("_version")).scalar()
    recent = log.filter(F.col("_version") >= floor_v)
    carried = _latest(log.filter(F.col("_version") < floor_v), keys).filter(F.col("_op") != "D")
    return recent.unionByName(carried.select(*log.columns))

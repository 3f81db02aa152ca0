"""Writes and file-level jobs.

All locations live under the shared folder named by ``spark.checkpoint.dir``
(see ``tessera.session.work_path``, which refuses to choose a folder of its own
off a local master). Every job writes to a fresh location and never overwrites the
path it is reading from.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_FILE_BYTES = 134_217_728  # compaction target (128 MiB)
MIN_INPUT_FILES = 5


def refresh(df: DataFrame, path: str) -> DataFrame:
    """K1/K3: full refresh (overwrite data and schema), then read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """K2: append rows to a Parquet location."""
    df.write.mode("append").parquet(path)


def table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def ctas(spark: SparkSession, name: str, path: str, select_sql: str) -> DataFrame:
    """K4: CREATE TABLE ... USING parquet LOCATION ... AS SELECT."""
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {select_sql}")
    return spark.table(name)


def partitioned_write(df: DataFrame, path: str, by: list[str]) -> DataFrame:
    """K7: one directory per partition value (identity / day / hour columns
    derived beforehand); readers prune on them. The rebalance hint lets AQE join
    small values in a task and split a large value over several, each writing a
    file of about the session's advisory partition size."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "static")
       .partitionBy(*by).parquet(path))
    return df.sparkSession.read.parquet(path)


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size statistics of a frame, in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def export_sorted(df: DataFrame, path: str, order: list[str], target_bytes: int = TARGET_FILE_BYTES, ranged: bool = False) -> DataFrame:
    """Time-ordered export: range-partition on the sort keys (sampled
    boundaries, so a hot value does not land in one file), sort inside each
    file, snappy Parquet; as many files as the size statistics ask for. The partitions
    of a ``ranged`` frame are such ranges already and stay as they are."""
    if not ranged:
        df = df.repartitionByRange(max(1, -(-planned_bytes(df) // target_bytes)), *order)
    df.sortWithinPartitions(*order).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.parquet(path)


def with_lineage(df_reader: DataFrame) -> DataFrame:
    """Source file name and ingest time per row (``_metadata``)."""
    return df_reader.select("*", F.col("_metadata.file_name").alias("_source_file"),
                            F.current_timestamp().alias("_ingested_at"))


def file_stats(spark: SparkSession, path: str, partition_cols: list[str]) -> DataFrame:
    """Per data file (path, size, records) and per-partition totals,
    from the ``_metadata`` columns of a scan: no listing on the driver."""
    d = spark.read.parquet(path)
    per_file = d.groupBy(*partition_cols, F.col("_metadata.file_path").alias("file_path"),
                         F.col("_metadata.file_size").alias("file_size")).agg(
        F.count(F.lit(1)).alias("record_count"))
    return per_file


def compaction_plan(spark: SparkSession, path: str, partition_cols: list[str],
                    target_bytes: int = TARGET_FILE_BYTES, min_inputs: int = MIN_INPUT_FILES) -> DataFrame:
    """T8 plan: per partition, how many input files and bytes, and the number
    of output files (ceil(bytes / target)); only partitions with at least
    ``min_inputs`` files are rewritten. Built from file metadata only."""
    st = file_stats(spark, path, partition_cols)
    per_part = st.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("input_files"),
                                              F.sum("file_size").alias("input_bytes"))
    return per_part.withColumns({
        "output_files": F.greatest(F.lit(1), F.ceil(F.col("input_bytes") / F.lit(target_bytes))).cast("int"),
        "rewrite": F.col("input_files") >= min_inputs,
    })


def compact(spark: SparkSession, src: str, dst: str, partition_cols: list[str],
            target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite small files into ~target-size files at a new location,
    then verify row count and an order-free content hash against the input.
    The source is never overwritten."""
    data = spark.read.parquet(src)
    plan = compaction_plan(spark, src, partition_cols, target_bytes)
    n_out = plan.agg(F.sum("output_files")).first()[0] or 1  # one small number to the driver
    # each row goes to bucket hash(row) % output_files of its partition, so a
    # large (hot) partition is written by several tasks into several files
    row_hash = F.abs(F.xxhash64(*[F.col(c) for c in data.columns]))
    if partition_cols:
        sized = data.join(plan.select(*partition_cols, "output_files"), on=partition_cols, how="left")
        bucketed = sized.withColumn("_bucket", row_hash % F.col("output_files")).drop("output_files")
        w = bucketed.repartition(int(n_out), *partition_cols, "_bucket").drop("_bucket").write.partitionBy(
            *partition_cols)
    else:
        w = data.repartition(int(n_out)).write
    w.mode("error").parquet(dst)
    out = spark.read.parquet(dst)
    if content_digest(out).first() != content_digest(data).first():
        raise RuntimeError(f"compaction changed content: {src} -> {dst}")
    return out


def content_digest(df: DataFrame):
    """Order-free digest: row count plus sum of a 64-bit hash of each row."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("h"))


def orphan_files(spark: SparkSession, directory: str, referenced: DataFrame, older_than=None) -> DataFrame:
    """Files under ``directory`` not referenced by the table, optionally
    only those last modified before ``older_than``. The listing is a
    distributed ``binaryFile`` scan of metadata columns only (no content)."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
               .select(F.col("path"), F.col("modificationTime"), F.col("length")))
    if older_than is not None:
        listing = listing.filter(F.col("modificationTime") < F.lit(older_than))
    return listing.join(referenced.select(F.col("file_path").alias("path")).distinct(), "path", "left_anti")


def copy_table(spark: SparkSession, src: DataFrame, dst: str) -> DataFrame:
    """Copy to a new location and check the row counts agree."""
    src.write.mode("error").parquet(dst)
    out = spark.read.parquet(dst)
    if content_digest(out).first() != content_digest(src).first():
        raise RuntimeError("copy does not match its source")
    return out

"""Structured Streaming jobs over file streams.

Kafka is not available here, so an event log is a directory of files with
the same ``key, value, timestamp`` envelope (or the plain event columns);
the parsing and aggregation code takes any streaming DataFrame and is
source-agnostic. Queries stream a table's own files, without staging them. A run
has a trigger (``availableNow`` by default: all there is, then stop) and a
checkpoint under the shared folder, so a restart resumes from the commit log
without duplicates (the file sink's ``_spark_metadata`` is the commit). A run
ends when its stream does; how long that takes is the cluster's business.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

# JSON keeps microseconds (the default text form stops at milliseconds)
JSON_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
           "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


# ----------------------------------------------------------------- envelope
def to_envelope(df: DataFrame, key: str, ts: str, value_columns: list[str] | None = None) -> DataFrame:
    """Keyed JSON events: key = the key column as text, value = JSON of
    the row, timestamp = the event time (the shape a Kafka writer takes)."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in value_columns or df.columns]), JSON_TS).alias("value"),
                     F.col(ts).cast("timestamp").alias("timestamp"))


def parse_envelope(env: DataFrame, schema: T.StructType, keep_log_time: bool = False) -> DataFrame:
    """Value (text or binary) -> JSON struct -> columns; malformed
    values give a row of NULLs rather than failing the stream."""
    parsed = env.select(F.from_json(F.col("value").cast("string"), schema, JSON_TS).alias("event"),
                        F.col("timestamp").alias("log_time"))
    cols = ["event.*"] + (["log_time"] if keep_log_time else [])
    return parsed.select(*cols)


# ------------------------------------------------------------------ sources
def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", consume: bool = False) -> DataFrame:
    """Incremental file ingestion (only new files are picked up). A batch
    takes all files that are there: with a cap, a watermark moved by one file
    would make rows of the next look late. With ``consume`` files are deleted once the batch
    after theirs begins, as a log drops what all have read; only for files of one's own."""
    reader = spark.readStream.schema(schema).format(fmt).option("cleanSource", "delete" if consume else "off")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(place) and files.getFileStatus(place).isFile():  # a file source watches folders
        return reader.option("pathGlobFilter", place.getName()).load(place.getParent().toString())
    return reader.load(path)


def table_stream(spark: SparkSession, table: str) -> DataFrame:
    """Stream of the rows appended to a named table."""
    return spark.readStream.table(table)


# -------------------------------------------------------------------- sinks
def run_to_files(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None, every: str | None = None, compression: str | None = None):
    """K10 (and R6 append, R8 exactly-once). R7: with ``every`` the query starts a
    batch at that interval and is returned running, else it takes what is
    there and ends."""
    w = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).option("path", sink)
    if compression:
        w = w.option("compression", compression)
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    return q if every else _finished(q)


def run_to_table(stream: DataFrame, table: str, path: str, checkpoint: str):
    """K9: checkpointed append into a named Parquet table."""
    return _finished(stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
                     .trigger(availableNow=True).toTable(table))


def run_update_mode(stream: DataFrame, sink: str, checkpoint: str):
    """R6 update mode: each micro-batch's changed rows are written to
    ``sink/_batch=<id>`` with overwrite, so a replayed batch rewrites the
    same folder (idempotent). ``latest_state`` folds them."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/_batch={batch_id}")

    return _finished(stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                     .foreachBatch(write_batch).trigger(availableNow=True).start())


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, sorted; none if it is not there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(place) if x.isDirectory()) if files.exists(place) else []


def _snapshots(spark: SparkSession, sink: str) -> list[str]:
    """Folders of finished snapshots, oldest first; a name ends with the last batch in it."""
    return [f"{sink}.state/{name}" for name in _folders(spark, f"{sink}.state") if name.startswith("upto-")]


def _newest(d: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the row of the last batch. That batch is a hash aggregation over
    numbers; its rows are joined back by key and batch."""
    last = d.groupBy(*keys).agg(F.max("_batch").alias("_last")).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_last")
    cond = d["_batch"] == last["_last"]
    for k in keys:
        cond = cond & d[k].eqNullSafe(last[f"_k_{k}"])
    return d.join(last.hint("shuffle_hash"), cond, "left_semi")


def _state(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """Newest rows with their batch: the last snapshot and the batches after it."""
    batches, snapshots = spark.read.parquet(sink), _snapshots(spark, sink)
    columns = batches.columns
    batches = batches.withColumn("_batch", F.col("_batch").cast("long"))
    if not snapshots:
        return _newest(batches, keys)
    upto = int(snapshots[-1].rsplit("-", 1)[1])
    later = batches.where(F.col("_batch") > upto)  # folders are pruned by their name
    return _newest(spark.read.parquet(snapshots[-1]).select(*columns).unionByName(later), keys)


def latest_state(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """Final table of an update-mode stream: per key the row of the last batch
    that emitted it, from the last snapshot and the batches written since."""
    return _state(spark, sink, keys).drop("_batch")


def fold_state(spark: SparkSession, sink: str, keys: list[str]) -> str | None:
    """Writes a snapshot of the state so far, after which a read opens that and
    later batches only. To be called between runs, as often as reads should stay
    short. A batch that is replayed after it rewrites its own folder with
    the same rows, so the snapshot stays right. Returns the snapshot's path."""
    batches = [int(name.split("=", 1)[1]) for name in _folders(spark, sink) if name.startswith("_batch=")]
    if not batches:
        return None
    path = f"{sink}.state/upto-{max(batches):020d}"
    if path not in _snapshots(spark, sink):
        draft = f"{sink}.state/draft-{max(batches):020d}"
        _state(spark, sink, keys).write.mode("overwrite").parquet(draft)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = place(draft).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.rename(place(draft), place(path)):  # a snapshot is seen whole or not at all
            raise OSError(f"cannot rename {draft}")
    return path


def _finished(q):
    q.awaitTermination()  # raises what ended the stream, if anything did
    return q


def rows_written(spark: SparkSession, sink: str) -> int:
    """Rows committed to a sink, counted from the sink itself."""
    return spark.read.parquet(sink).count()


class Progress(StreamingQueryListener):
    """Rows read by each batch of the streams of a session while it is open
    (``with Progress(spark) as progress``), kept as they end: nothing is
    counted again, and no batch is forgotten after the first hundred. A replayed
    batch replaces its entry."""

    def __init__(self, spark: SparkSession):
        self.spark, self.rows = spark, {}

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *failure):
        # reports come by a queue of Spark's; all sent so far are delivered first
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        report = event.progress
        self.rows[str(report.id), report.batchId] = report.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def total(self, query=None) -> int:
        """Rows of one query, or of all."""
        return sum(n for (of, _), n in self.rows.items() if query is None or of == str(query.id))


# --------------------------------------------------------------- operators
def event_time(col: str) -> Column:
    """Watermarks need TIMESTAMP (not NTZ, not text)."""
    return F.col(col).cast("timestamp")


def dedup_within_watermark(stream: DataFrame, keys: list[str], time_col: str, delay: str) -> DataFrame:
    """U3 on streams: the first row of each key; further ones are dropped if they
    come while the key is kept, which is until the watermark passes its first
    row's time by ``delay``. State so holds the keys of about one delay, not of
    all time. Rows without a time are kept out: no watermark would ever let
    them go."""
    return stream.where(F.col(time_col).isNotNull()).withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, time_col: str, seconds: int, keys: list[str], aggs: list[Column],
             watermark: str | None = None) -> DataFrame:
    """Tumbling-window aggregate with flattened window bounds.

    Without a watermark no row is ever late, and rows without an event time form a
    window without bounds. With one, windows close when it passes them; rows
    without an event time can belong to no such window and are left out.
    """
    if watermark:
        g = stream.withWatermark(time_col, watermark).groupBy(F.window(time_col, f"{seconds} seconds").alias("w"), *keys).agg(*aggs)
        start, end = F.col("w.start"), F.col("w.end")
    else:
        at = F.floor(F.unix_micros(F.col(time_col)) / F.lit(seconds * 1_000_000)).cast("long").alias("w")
        g = stream.groupBy(at, *keys).agg(*aggs)
        start, end = F.timestamp_seconds(F.col("w") * seconds), F.timestamp_seconds((F.col("w") + 1) * seconds)
    return g.select(start.cast("timestamp_ntz").alias("window_start"), end.cast("timestamp_ntz").alias("window_end"),
                    *keys, *[c for c in g.columns if c not in ("w", *keys)])

"""Operator 10: sharding by histogram sort.

Documents are ordered by (hash of the text, number of the row in the table):
equal texts lie together, and a group of copies however large, also of one
repeated row, can be cut anywhere between two shards. Splitters are
found as histogram sort does: every partition counts the exact bytes below a
set of probe keys, the sums narrow each splitter's interval, and probes are
placed anew inside it until the bytes below a boundary meet the tolerance or no
other key is left in the interval. Then rows are exchanged once, by range.

Law ``bytes``: sizes of shards near equal. A boundary between groups of equal
texts is taken if it is within ``TOLERANCE`` of a shard's size of the ideal
one, else the nearest boundary between documents.

Slots count a shard's rows from 0 in key order: the place of a row in its
range partition plus the rows of the shard in earlier partitions.

Defined results: null text -> size 1 and no crc (null counts as an empty text
for the hash); a doc_id, null or repeated, has no part in the order; row numbers
are written with the keys, so that a lost task finds them again; an empty table
gives no rows. With fewer rows than
shards some shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import materialize, partitions, ship

SHARDS = 16
#: Accepted distance of a boundary from its ideal, as a share of a shard's size.
TOLERANCE = 0.005
#: Probe keys for each splitter in a round.
PROBES = 64

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _histogram(probes: np.ndarray):
    """Exact bytes of a partition below each probe key (hash, row number)."""
    hashes, ids = probes["h"], probes["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            h, i, s = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "id", "size"))
            # the first probe above (h, id): by hash, then by id among probes of that hash
            place = np.searchsorted(hashes, h, "left")
            last = np.searchsorted(hashes, h, "right")
            while True:
                open_ = np.flatnonzero(place < last)
                open_ = open_[ids[place[open_]] <= i[open_]]
                if not len(open_):
                    break
                place[open_] += 1
            np.add.at(size, place, s)
        below = np.cumsum(size)[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(probes)), pa.int32()), pa.array(below, pa.int64())], names=["probe", "below"])

    return run


_KEY = np.dtype([("h", np.int64), ("id", np.int64)])


def _between(low: tuple[int, int], high: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """Up to n keys strictly between two keys, evenly spread: over hashes while
    the interval holds several, then over the ids of one hash."""
    width = high[0] - low[0]
    if width > 1:
        return [(h, _LOW) for h in sorted({low[0] + max(1, width * k // (n + 1)) for k in range(1, n + 1)})]
    # neighbouring hashes (the boundary between them is a probe) or one hash
    a = (low[0] << 64) + (low[1] - _LOW)
    b = (high[0] << 64) + (high[1] - _LOW)
    out = {a + max(1, (b - a) * k // (n + 1)) for k in range(1, n + 1)}
    return sorted(((k >> 64), (k & ((1 << 64) - 1)) + _LOW) for k in out if a < k < b)


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Boundary keys: shard k holds the keys from splitter k-1 on, below splitter k."""
    total, = keys.agg(F.sum("size")).first()
    if not total:
        return []
    first, end = (_LOW, _LOW), (_HIGH, _HIGH)
    targets = [total * k / shards for k in range(1, shards)]
    allowed = tolerance * total / shards
    low = {t: (first, 0) for t in targets}
    high = {t: (end, total) for t in targets}
    done: dict[float, tuple[int, int]] = {}
    group: dict[float, tuple[float, tuple[int, int]]] = {}  # nearest boundary between groups
    while len(done) < len(targets):
        wanted = {t: _between(low[t][0], high[t][0], PROBES) for t in targets if t not in done}
        probes = sorted({k for keys_ in wanted.values() for k in keys_})
        counted: dict[tuple[int, int], int] = {}
        if probes:
            rows = keys.mapInArrow(_histogram(np.array(probes, _KEY)), "probe int, below long").groupBy("probe").agg(F.sum("below")).collect()
            counted = {probes[p]: b for p, b in rows}
        for t in wanted:
            for k in probes:
                b = counted[k]
                if k[1] == _LOW and abs(b - t) < group.get(t, (np.inf,))[0]:
                    group[t] = (abs(b - t), k)
                if b <= t and k > low[t][0]:
                    low[t] = (k, b)
                if b >= t and k < high[t][0]:
                    high[t] = (k, b)
            if t in group and group[t][0] <= allowed:
                done[t] = group[t][1]
            elif not wanted[t] or low[t][1] == high[t][1]:
                done[t] = min((abs(low[t][1] - t), low[t][0]), (abs(high[t][1] - t), high[t][0]))[1]
    return sorted(done.values())


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    ship(spark)
    body = F.col(text)
    keys = materialize(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("h"),
        F.monotonically_increasing_id().alias("id")), "shard_keys")
    cuts = splitters(keys.select("h", "id", "size"), shards)
    # the number of splitters at or below a key; at most shards-1 comparisons
    number = F.lit(0)
    for h, i in cuts:
        number = number + F.when((F.col("h") > h) | ((F.col("h") == h) & (F.col("id") >= i)), 1).otherwise(0)
    order = ["shard", "h", "id"]
    placed = materialize(keys.withColumn("shard", number).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                         .select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("at")), "shard_rows")
    part = F.shiftright("at", 33)
    # one row for each range partition and shard: bounded by partitions + shards
    pieces = placed.groupBy("shard", part.alias("part")).agg(F.min("at").alias("begin"), F.count("*").alias("n")).collect()
    starts, at = {}, {}
    for row in sorted(pieces, key=lambda r: (r["shard"], r["part"])):
        starts[row["shard"], row["part"]] = row["begin"] - at.get(row["shard"], 0)
        at[row["shard"]] = at.get(row["shard"], 0) + row["n"]
    offsets = spark.createDataFrame([(s, p, o) for (s, p), o in starts.items()], "shard int, part long, offset long")
    return (placed.withColumn("part", part).join(F.broadcast(offsets), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("at") - F.col("offset")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))

"""Operator 12: importance resampling towards a target distribution.

A text's features are its words and pairs of neighbouring words, each hashed to
one of ``BUCKETS`` buckets by crc32. A bucket's gain is the log ratio of its
smoothed shares in the target texts and in all texts, a text's weight the mean
gain of its features; with Gumbel noise from its id added, the highest scores
are a draw without replacement in proportion to exp(weight).

Buckets come from a head-tail vocabulary. The frequent words' CRC states and the
frequent pairs' buckets are counted once and sent to all tasks in tables of
fixed size, one entry a slot. A feature that is not there (the tail) takes its CRC
directly: a word from its bytes, a pair by carrying the state of its first word
over a space and the second word. Head and tail give the same buckets, so
totals and weights are exact whatever the head holds.

Ranks need no global window: the count of each score gives the least score that
is drawn, only rows from there on are exchanged by range of (score, id), and a
row's rank is its place in its partition plus the rows of those before.

Defined results: null text -> no features, weight 0, never drawn if ``least_words``
is positive. A null doc_id is noised as an empty id and sorts before all others.
Rows that repeat a doc_id are rows of their own; equal ones are ranked in any
order. Head words and pairs are compared by 64-bit hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.blocks import LOWER, materialize, mix, partitions, ship, slice_hashes, text_blocks, word_spans

BUCKETS = 10_000
SEED = 7
#: Slots of the head tables (words, pairs); both reach the driver and every task.
WORD_SLOTS, PAIR_SLOTS = 1 << 16, 1 << 18
#: Occurrences in one block (2 MB) from which a word or pair may be frequent.
LEAST_IN_BLOCK = 6
#: Words longer than this are hashed one by one.
_LONG = 64

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_START = np.uint32(0xFFFFFFFF)


def _crc_table() -> np.ndarray:
    """Table of the reflected polynomial of crc32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_TABLE = _crc_table()


def carry(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC states after ``data[start:end]``, from the given states."""
    state = state.copy()
    long_ = np.flatnonzero(ends - starts > _LONG)
    for i in long_.tolist():
        state[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(state[i] ^ _START)) ^ 0xFFFFFFFF
    open_ = np.flatnonzero((ends > starts) & (ends - starts <= _LONG))
    at, stop = starts[open_], ends[open_]
    while len(open_):
        s = state[open_]
        state[open_] = _TABLE[(s ^ data[at]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
        at = at + 1
        more = at < stop
        open_, at, stop = open_[more], at[more], stop[more]
    return state


def _bucket(state: np.ndarray) -> np.ndarray:
    return ((state ^ _START) % np.uint32(BUCKETS)).astype(np.int64)


@dataclass
class Head:
    """Direct-mapped tables: slot of a hash -> hash and value."""

    word_keys: np.ndarray
    word_states: np.ndarray
    pair_keys: np.ndarray
    pair_buckets: np.ndarray


def _slots(keys: np.ndarray, values: np.ndarray, slots: int, kind) -> tuple[np.ndarray, np.ndarray]:
    """Tables filled in order: of two keys of a slot the earlier one stays."""
    table, held = np.zeros(slots, np.uint64), np.zeros(slots, kind)
    at = (keys % np.uint64(slots)).astype(np.int64)[::-1]
    table[at], held[at] = keys[::-1], values[::-1]
    return table, held


@dataclass
class Words:
    """Words of a block: bytes, spans, hashes, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, block) -> Words:
        data = LOWER[block.data]
        starts, ends, firsts = word_spans(_WORD_BYTE[data], block.offsets)
        return cls(data, starts, ends, firsts, slice_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64))

    def pairs(self) -> np.ndarray:
        """Index of the first word of each pair: all words but the last of a text."""
        inner = np.ones(len(self.starts), bool)
        inner[self.firsts[1:][self.firsts[1:] > self.firsts[:-1]] - 1] = False
        return np.flatnonzero(inner)

    def pair_hashes(self, first: np.ndarray) -> np.ndarray:
        return mix(mix(self.hashes[first]) ^ self.hashes[first + 1])


def _states(words: Words, head: Head | None) -> np.ndarray:
    """CRC state of every word."""
    if head is None:
        return carry(np.full(len(words.starts), _START), words.data, words.starts, words.ends)
    at = (words.hashes % np.uint64(len(head.word_keys))).astype(np.int64)
    state, tail = head.word_states[at], np.flatnonzero(head.word_keys[at] != words.hashes)
    state[tail] = carry(np.full(len(tail), _START), words.data, words.starts[tail], words.ends[tail])
    return state


def _pair_buckets(words: Words, state: np.ndarray, first: np.ndarray, head: Head | None) -> np.ndarray:
    def direct(some: np.ndarray) -> np.ndarray:
        s = state[some]
        spaced = _TABLE[(s ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
        return _bucket(carry(spaced, words.data, words.starts[some + 1], words.ends[some + 1]))

    if head is None:
        return direct(first)
    keys = words.pair_hashes(first)
    at = (keys % np.uint64(len(head.pair_keys))).astype(np.int64)
    out, tail = head.pair_buckets[at].astype(np.int64), np.flatnonzero(head.pair_keys[at] != keys)
    out[tail] = direct(first[tail])
    return out


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, value, n): words (0) with their state, pairs (1) with their
    bucket, that are frequent in a block."""
    for batch in batches:
        for block in text_blocks(batch.column("text")):
            words = Words.of(block)
            first = words.pairs()
            for kind, hashes in ((0, words.hashes), (1, words.pair_hashes(first))):
                keys, example, n = np.unique(hashes, return_index=True, return_counts=True)
                often = n >= LEAST_IN_BLOCK
                keys, example, n = keys[often], example[often], n[often]
                if kind == 0:
                    value = carry(np.full(len(keys), _START), words.data, words.starts[example], words.ends[example]).astype(np.int64)
                else:
                    some = first[example]
                    state = carry(np.full(len(some), _START), words.data, words.starts[some], words.ends[some])
                    pair = Words(words.data, words.starts, words.ends, words.firsts, words.hashes)
                    full = np.zeros(len(words.starts), np.uint32)
                    full[some] = state
                    value = _pair_buckets(pair, full, some, None)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(value), pa.array(n, pa.int64())],
                                                 names=["kind", "key", "value", "n"])


def head_vocabulary(texts: DataFrame, text: str = "text") -> Head:
    """Tables of the most frequent words and pairs of all texts."""
    ship(texts.sparkSession)
    counts = texts.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).mapInArrow(_frequent, "kind int, key long, value long, n long")
    counts = materialize(counts.groupBy("kind", "key", "value").agg(F.sum("n").alias("n")), "head")
    # least count that fits the slots, from a histogram of a few hundred magnitudes
    size = F.floor(F.log2("n") * 8).cast("int")
    least = {0: 0, 1: 0}
    for kind, slots in ((0, WORD_SLOTS), (1, PAIR_SLOTS)):
        room = slots
        for row in counts.where(F.col("kind") == kind).groupBy(size.alias("size")).agg(F.count("*").alias("k")).orderBy(F.desc("size")).collect():
            room -= row["k"]
            if room < 0:
                least[kind] = row["size"] + 1
                break
    chosen = counts.where(size >= F.when(F.col("kind") == 0, least[0]).otherwise(least[1])).select("kind", "key", "value", "n").toArrow()
    kind, key, value, n = (chosen.column(c).to_numpy() for c in ("kind", "key", "value", "n"))
    order = np.lexsort((key, -n))
    kind, key, value = kind[order], key[order].view(np.uint64), value[order]
    return Head(*_slots(key[kind == 0], value[kind == 0], WORD_SLOTS, np.uint32), *_slots(key[kind == 1], value[kind == 1], PAIR_SLOTS, np.uint16))


def _features(block, head: Head | None) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, their buckets, first words of pairs, the pairs' buckets."""
    words = Words.of(block)
    state = _states(words, head)
    first = words.pairs()
    return words, _bucket(state), first, _pair_buckets(words, state, first, head)


def _totals(head: Head | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for block in text_blocks(batch.column("text")):
                _, own, _, pairs = _features(block, head)
                total += np.bincount(own, minlength=BUCKETS) + np.bincount(pairs, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    return run


def bucket_totals(texts: DataFrame, head: Head | None = None, text: str = "text") -> np.ndarray:
    """Exact number of features in each bucket, over all texts."""
    ship(texts.sparkSession)
    rows = texts.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).mapInArrow(_totals(head), "bucket int, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket's smoothed shares."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(head: Head | None, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for block in text_blocks(batch.column("text")):
                words, own, first, pairs = _features(block, head)
                value = gain[own]
                value[first] += gain[pairs]
                sums = np.append(0, np.cumsum(value))
                n_words = np.diff(words.firsts)
                n = n_words + np.maximum(n_words - 1, 0)
                weight = np.where(n > 0, np.diff(sums[words.firsts]) // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays([ids.slice(block.first, block.n), pa.array(n_words, pa.int64()), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                                                 names=["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def weights(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """One row for each input row: doc_id, n_words, n_features, weight, score."""
    ship(docs.sparkSession)
    head = head_vocabulary(docs, text)
    gain = gains(bucket_totals(docs, head, text), bucket_totals(target, head))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _weigh(head, gain), "doc_id long, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def ranked(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` (a written table with score and doc_id) with rank 1 .. ``count``
    by score descending, then doc_id; null beyond."""
    spark = rows.sparkSession
    none = F.lit(None).cast("long").alias("rank")
    least = None
    if count > 0:
        # a score is a floored sum of bounded logarithms, so the histogram is small
        left = count
        for score, n in rows.groupBy("score").agg(F.count("*").alias("n")).orderBy(F.desc("score")).toLocalIterator():
            least, left = score, left - n
            if left <= 0:
                break
    if least is None:
        return rows.select("*", none)
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("at")]
    # rows of one id and score may be many: a number parts them
    top = rows.where(F.col("score") >= least).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(top.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("at", 33)
    offsets, before = [], 0
    for p, begin, n in placed.groupBy(part.alias("part")).agg(F.min("at"), F.count("*")).orderBy("part").collect():  # a row for each partition
        offsets.append((p, before + 1 - begin))
        before += n
    offset = spark.createDataFrame(offsets, "part long, offset long")
    rank = F.col("at") + F.col("offset")
    drawn = placed.withColumn("part", part).join(F.broadcast(offset), "part").select(*rows.columns, F.when(rank <= count, rank).alias("rank"))
    return drawn.unionByName(rows.where(F.col("score") < least).select("*", none))


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """One row for each input row: doc_id, n_features, weight, score, rank."""
    rows = materialize(weights(docs, target, doc_id, text, seed), "weights")
    fit = F.col("n_words") >= least_words
    count = percent * rows.where(fit).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    some = ranked(rows.where(fit).select(*columns), count)
    return some.unionByName(rows.where(~fit).select(*columns, F.lit(None).cast("long").alias("rank")))

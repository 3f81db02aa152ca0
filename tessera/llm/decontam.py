"""Operator 3: benchmark decontamination by suffix arrays of the training data.

Every block of documents is a shard with a suffix array over its words: the
word positions sorted by the word sequence that starts there. Each suffix of
each benchmark item is binary-searched in every shard; the range that shares
its window (``window`` words, or the whole of a shorter item) gives the
occurrences, and the neighbours in suffix order the longest verbatim match.
Words hit by an occurrence are counted and documents with hits removed.

The suffix array of a shard is sparse and exact: a position can only start a
match if a whole shortest window from it consists of benchmark words, so only
such positions are sorted. Words are compared by 64-bit hash.

Benchmark items reach the shards in portions of at most ``PORTION`` bytes.
Equal texts are one item with a list of ids, and a text above ``PART`` bytes is
cut into parts that overlap by a window less one word, so no window is lost. A
larger benchmark makes more passes over the documents, each adding to what the
one before found; a pass is written before the next portion is read, so the
driver holds one portion. The documents are never shuffled.

Defined results: null, empty or wordless documents have no hits and stay;
items without words never occur; equal items are all reported; a null item_id
counts as an item and is left out of the list of ids; an item found by several
of its parts counts once, and its longest match is measured within a part.
Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import LOWER, gather_ranges, lean, materialize, ship, slice_hashes, text_blocks, word_spans

WINDOW = 10
#: Bytes of benchmark text that one pass holds on the driver and in each task.
PORTION = 16 << 20
#: Bytes of text above which an item is cut into parts.
PART = 1 << 20
#: Bytes of text in a shard.
SHARD = 4 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def block_words(block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts of a block; index of each text's first."""
    data = LOWER[block.data]
    starts, ends, firsts = word_spans(_WORD[data], block.offsets)
    return (slice_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)), firsts


@dataclass
class Items:
    """A portion of the benchmark: its words as numbers from 1, texts in a row."""

    vocabulary: np.ndarray
    words: np.ndarray
    starts: np.ndarray  # of the searched suffixes
    lengths: np.ndarray  # words of their windows
    owner: np.ndarray  # index of the item
    kept: list  # (ids, number of rows, key if the item is in parts) of each item
    reach: np.ndarray  # words from a suffix to the end of its item


def make_items(rows: list, window: int) -> Items | None:
    """``rows``: (text, ids, number of rows, key if the item is in parts)."""
    owner, starts, lengths, reach, words, kept = [], [], [], [], [], []
    at = 0
    for block in text_blocks(pa.array([r[0] for r in rows], pa.string()), 1 << 62):
        hashes, firsts = block_words(block)
        for i, (a, b) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist())):
            if b > a:
                width = min(window, b - a)
                n = b - a - width + 1
                starts.append(at + np.arange(n)), lengths.append(np.full(n, width))
                reach.append(b - a - np.arange(n)), owner.append(np.full(n, len(kept)))
                words.append(hashes[a:b]), kept.append(tuple(rows[block.first + i][1:4]))
                at += b - a
    if not kept:
        return None
    vocabulary, numbers = np.unique(np.concatenate(words), return_inverse=True)
    cat = np.concatenate
    return Items(vocabulary, numbers.astype(np.int64) + 1, cat(starts), cat(lengths), cat(owner), kept, cat(reach))


class SuffixArray:
    """Positions of ``words`` (numbers, 0 where no match can go on) sorted by what
    starts there, up to ``depth`` words."""

    def __init__(self, words: np.ndarray, positions: np.ndarray, depth: int):
        self.words = np.append(words, np.zeros(depth + 1, words.dtype))
        n = len(self.words)
        some = np.flatnonzero(self.words)
        rank, done = self.words, 1
        while done < depth and len(some):  # prefix doubling; a 0 ends every suffix
            ahead = np.append(rank[done:], np.zeros(min(done, n), rank.dtype))
            values, number = np.unique(rank[some] * (int(rank.max()) + 1) + ahead[some], return_inverse=True)
            rank = np.zeros(n, np.int64)
            rank[some] = number + 1
            done *= 2
            if len(values) == len(some):
                break
        self.order = positions[np.argsort(rank[positions], kind="stable")]

    def _before(self, at: np.ndarray, query: np.ndarray, starts: np.ndarray, lengths: np.ndarray, equal: bool) -> np.ndarray:
        """Whether the suffix at each place sorts before its query (equal: or starts with it)."""
        sign = np.zeros(len(at), np.int64)
        for j in range(int(lengths.max())):
            open_ = np.flatnonzero((sign == 0) & (j < lengths))
            if not len(open_):
                break
            sign[open_] = np.sign(self.words[at[open_] + j] - query[starts[open_] + j])
        return (sign < 0) | ((sign == 0) & equal)

    def search(self, query: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of places whose suffixes begin with each query, by binary search."""
        bounds = []
        for equal in (False, True):
            low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.order))
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                before = self._before(self.order[middle], query, starts[open_], lengths[open_], equal)
                low[open_[before]], high[open_[~before]] = middle[before] + 1, middle[~before]
            bounds.append(low)
        return bounds[0], bounds[1]


def _find(items: Items, hashes: np.ndarray, firsts: np.ndarray):
    """Occurrences in a shard (first word, words, item) and each text's longest match."""
    place = np.searchsorted(items.vocabulary, hashes)
    place[place == len(items.vocabulary)] = 0
    known = items.vocabulary[place] == hashes
    # a 0 behind each text, so that no match crosses its end
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    words = np.zeros(len(hashes) + len(firsts) - 1, np.int64)
    words[np.arange(len(hashes)) + text] = np.where(known, place + 1, 0)
    shortest = int(items.lengths.min())
    stop = np.where(words == 0, np.arange(len(words)), len(words))
    run = np.minimum.accumulate(stop[::-1])[::-1] - np.arange(len(words)) if len(words) else stop
    positions = np.flatnonzero(run >= shortest)
    # words outside of such runs are never compared
    behind = np.arange(len(words)) - np.maximum.accumulate(np.where(words == 0, np.arange(len(words)), -1))
    words[run + behind - 1 < shortest] = 0
    none = np.zeros(0, np.int64)
    longest = np.zeros(len(firsts) - 1, np.int64)
    if not len(positions):
        return none, none, none, longest
    array = SuffixArray(words, positions, int(items.reach.max()))
    low, high = array.search(items.words, items.starts, items.lengths)
    hit = np.flatnonzero(high > low)
    counts = (high - low)[hit]
    query = np.repeat(hit, counts)
    found = array.order[gather_ranges(low[hit], counts)]
    borders = firsts[:-1] + np.arange(len(firsts) - 1)
    owner_text = np.searchsorted(borders, found, "right") - 1
    # how far the match goes on
    length = items.lengths[query].copy()
    open_ = np.arange(len(found))
    padded = np.append(items.words, 0)
    while len(open_):
        more = (length[open_] < items.reach[query[open_]]) & (array.words[found[open_] + length[open_]] == padded[np.minimum(items.starts[query[open_]] + length[open_], len(items.words))])
        open_ = open_[more]
        length[open_] += 1
    np.maximum.at(longest, owner_text, length)
    return found - owner_text, items.lengths[query], items.owner[query], longest


def _search(items: Items | None, text: str):
    """Adds what a portion of the benchmark finds to the t_ columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column(text), SHARD):
                rows = batch.slice(block.first, block.n)
                hashes, firsts = block_words(block)
                none = np.zeros(0, np.int64)
                start, width, owner, longest = _find(items, hashes, firsts) if items else (none, none, none, np.zeros(block.n, np.int64))
                which = np.searchsorted(firsts, start, "right") - 1
                order = np.argsort(which, kind="stable")
                cuts = np.searchsorted(which[order], np.arange(block.n + 1)).tolist()
                before = {c: rows.column(c).to_pylist() for c in ("t_hits", "t_hit", "t_items", "t_count", "t_longest", "t_parted")}
                hits, hit, names, counts, far, parted = [], [], [], [], [], []
                for i in range(block.n):
                    own = order[cuts[i]:cuts[i + 1]]
                    n = int(firsts[i + 1] - firsts[i])
                    old = before["t_hits"][i]
                    if not len(own):
                        hits.append(old), hit.append(before["t_hit"][i]), names.append(before["t_items"][i]), counts.append(before["t_count"][i])
                        far.append(before["t_longest"][i]), parted.append(before["t_parted"][i])
                        continue
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, start[own] - firsts[i], 1), np.add.at(edge, start[own] - firsts[i] + width[own], -1)
                    covered = np.cumsum(edge)[:n] > 0
                    if old:
                        covered |= np.unpackbits(np.frombuffer(old, np.uint8), count=n).astype(bool)
                    ids, count, keys = list(before["t_items"][i] or []), before["t_count"][i] or 0, set(before["t_parted"][i] or [])
                    for k in np.unique(owner[own]).tolist():
                        item_ids, n_rows, key = items.kept[k]
                        if key is None or key not in keys:
                            ids += item_ids
                            count += n_rows
                        keys |= {key} - {None}
                    hits.append(np.packbits(covered).tobytes()), hit.append(int(covered.sum()))
                    names.append(ids), counts.append(count), parted.append(sorted(keys) or None)
                    far.append(max(before["t_longest"][i] or 0, int(longest[i])))
                new = {"t_words": pa.array(np.diff(firsts), pa.int64()), "t_hits": pa.array(hits, pa.binary()), "t_hit": pa.array(hit, pa.int64()),
                       "t_items": pa.array(names, pa.list_(pa.string())), "t_count": pa.array(counts, pa.int64()), "t_longest": pa.array(far, pa.int64()),
                       "t_parted": pa.array(parted, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([new.get(name, rows.column(k)) for k, name in enumerate(rows.schema.names)], names=rows.schema.names)

    return run


def _cut(window: int, size: int):
    """Texts above ``size`` bytes in parts of at least ``window`` words, the rest as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column(0), size):
                rows = batch.slice(block.first, block.n)
                if len(block.data) <= size:
                    yield rows
                    continue
                starts, ends, _ = word_spans(_WORD[LOWER[block.data]], block.offsets)
                n, a, last = len(starts), 0, 0
                while last < n:  # words have ASCII borders, so each slice is valid UTF-8
                    last = int(np.searchsorted(ends, starts[a] + size, "right"))
                    last = min(max(last, a + window), n)
                    part = pa.array([block.data[starts[a]:ends[last - 1]].tobytes().decode()], rows.schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([part, *rows.columns[1:]], schema=rows.schema)
                    a = last - window + 1

    return run


def _parts(benchmark: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """(text, ids, rows, key): a row for each different text of the benchmark or
    part of one; ``key`` is set if the text is in parts."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    key = F.when(F.octet_length("text") > PART, F.sha2("text", 256))
    grouped = items.groupBy("text").agg(F.collect_list("item_id").alias("ids"), F.count(F.lit(1)).alias("rows")).withColumn("key", key)
    return materialize(grouped.mapInArrow(lean(_cut(window, PART)), grouped.schema), "benchmark_parts")


def _portions(parts: DataFrame) -> Iterator[tuple[list, bool]]:
    """The parts in portions of at most ``PORTION`` bytes, each read to the driver
    when it is its turn, and whether it is the last. Parts are dealt over fine
    buckets, whose sizes are known before they are packed."""
    size = F.octet_length("text") + F.octet_length(F.array_join("ids", ",")) + 64
    total = parts.agg(F.sum(size)).first()[0] or 0
    bucket = F.pmod(F.xxhash64("text", "key"), F.lit(16 * -(-total // PORTION) or 1))
    packed, room = [[]], PORTION
    for number, n_bytes in parts.groupBy(bucket.alias("b")).agg(F.sum(size)).sort("b").collect():
        if n_bytes > room and packed[-1]:
            packed.append([])
            room = PORTION
        packed[-1].append(number)
        room -= n_bytes
    for i, buckets in enumerate(packed):
        yield parts.where(bucket.isin(buckets)).collect(), i == len(packed) - 1


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The input rows with ``t_`` columns: words, a bit for each word that is hit,
    their number, ids and number of the items found, words of the longest verbatim
    match, keys of the items found by a part."""
    ship(docs.sparkSession)
    nothing = {"t_words": "long", "t_hits": "binary", "t_hit": "long", "t_items": "array<string>", "t_count": "long", "t_longest": "long",
               "t_parted": "array<string>"}
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in nothing], *[F.lit(None).cast(k).alias(c) for c, k in nothing.items()])
    for rows, last in _portions(_parts(benchmark, window, item_id, item_text)):
        out = out.mapInArrow(lean(_search(make_items(rows, window), text)), out.schema)
        if not last:
            out = materialize(out, "contamination")
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: n_words, n_hit, n_items, items_sha256 (ids sorted
    as strings, comma-joined), contaminated, longest_match."""
    found = find_contamination(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), benchmark, window)
    return found.select(
        "doc_id", F.col("t_words").alias("n_words"), F.coalesce("t_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("t_count", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.coalesce("t_items", F.array().cast("array<string>"))), ","), 256).alias("items_sha256"),
        F.col("t_hits").isNotNull().alias("contaminated"), F.coalesce("t_longest", F.lit(0)).alias("longest_match"))


def without_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The input rows in which no benchmark window occurs."""
    found = find_contamination(docs, benchmark, window, text)
    return found.where("t_hits IS NULL").select(*[F.col(f"`{c}`") for c in docs.columns])

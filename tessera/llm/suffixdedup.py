"""Operator 6: exact substring deduplication by longest-previous-factor arrays.

A byte is removed when it lies in a string of ``min_len`` bytes that also
starts in a document with a smaller doc_id. All strings are judged on the
input, matches never cross documents.

Distribution. A suffix array over all texts cannot live on one machine, so
suffixes are dealt out such that equal ones meet: every window of ``min_len``
bytes is assigned to its *anchor*, the smallest k-mer hash inside it. Equal
windows have equal anchors at equal offsets. Windows in a row with the same
anchor form one context string.

1. Rows are packed into compressed blocks, written once, bucketed by block.
2. Each block sends the hashes of its anchors, six bytes each and once a block,
   to the buckets of anchors; back come bit masks of those seen elsewhere.
3. Only contexts of shared anchors are sent, by anchor. Contexts that repeat
   inside a block are settled there (map-side combine), which also spreads the
   copies of a hot passage over the map tasks.
4. In a bucket of anchors, identical contexts are settled by their smallest
   document; the windows of the other contexts, if they can match at all, are
   put in suffix order, and previous/next smaller values over the documents in
   that order give each suffix its longest previous factor. Windows whose
   factor reaches ``min_len`` are removed.
5. Removed windows go back to their block, where the texts are cut.

The blocks meet what comes back by the table's bucketing: texts are never
shuffled.

Defined results: null or empty text -> no bytes; texts shorter than
``min_len`` lose nothing; a null doc_id counts as larger than all others and
such rows do not remove from each other; rows that repeat a doc_id never
remove from each other.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tessera.llm.blocks import gather_ranges, lean, lean_group, mix, partitions, ship, slice_hashes, text_blocks
from tessera.session import work_path

MIN_LEN = 50
#: Bytes of an anchor, a multiple of 8. Anchors this long are seldom shared without a match around them, at any corpus size.
KMER = 24
#: Buckets of anchors for each shuffle partition: a bucket is what a task holds at once.
BUCKETS = 4
#: Bytes of text in a block, and in a piece of it whose k-mers are hashed at once.
BLOCK = 4 << 20
PIECE = 1 << 20
#: Bits of a minimizer key that hold the position inside a piece.
_POS_BITS = 24
_LAST_ID = (1 << 63) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- longest previous factors -------------------------------------------------

def window_words(data: np.ndarray, starts: np.ndarray, length: int) -> list[np.ndarray]:
    """The ``length`` bytes from each start as big-endian 64-bit words, so that
    comparing the words in turn compares the strings bytewise."""
    words = []
    for at in range(0, length, 8):
        take = min(8, length - at)
        word = np.zeros(len(starts), np.uint64)
        for j in range(take):
            word |= data[starts + (at + j)].astype(np.uint64) << np.uint64(56 - 8 * j)
        words.append(word)
    return words


def suffix_order(words: list[np.ndarray], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of strings given as words, ties by document, and for each
    place whether its string equals the one before it in that order."""
    order = np.lexsort((docs, *words[::-1]))
    same = np.ones(len(order), bool)
    same[:1] = False
    for w in words:
        sorted_w = w[order]
        same[1:] &= sorted_w[1:] == sorted_w[:-1]
    return order, same


def previous_smaller(values: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Index of the nearest earlier place with a smaller value, -1 if none
    before a place where ``stop`` is set. Pointer doubling over whole arrays."""
    n = len(values)
    first = np.maximum.accumulate(np.where(stop, np.arange(n), 0))
    at = np.arange(n) - 1
    at[at < first] = -1
    open_ = np.flatnonzero((at >= 0) & (values[np.maximum(at, 0)] >= values))
    while len(open_):
        at[open_] = at[at[open_]]
        at[open_[at[open_] < first[open_]]] = -1
        seen = at[open_]
        open_ = open_[(seen >= 0) & (values[np.maximum(seen, 0)] >= values[open_])]
    return at


def has_previous_factor(words: list[np.ndarray], docs: np.ndarray) -> np.ndarray:
    """True for each string that also starts in a smaller document: its longest
    previous factor, cut at the string's length, is the whole string. Previous
    and next smaller documents are sought inside runs of equal strings, outside
    of which the factor is shorter than the string."""
    order, same = suffix_order(words, docs)
    in_order = docs[order]
    before = previous_smaller(in_order, ~same)
    last = np.append(~same[1:], True)[::-1]
    after = previous_smaller(in_order[::-1], last)[::-1]
    found = np.zeros(len(docs), bool)
    found[order] = (before >= 0) | (after >= 0)
    return found


# --- anchors and contexts ------------------------------------------------------

def kmer_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the KMER bytes from each position."""
    n = len(data) - KMER + 1
    words = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64).ravel()
    out = words[:n] * _ODD
    for at in range(8, KMER, 8):
        out = (out ^ (out >> np.uint64(29)) ^ words[at:at + n]) * _ODD
    return mix(out)


def contexts(data: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of every run of windows
    with the same anchor (the leftmost smallest k-mer hash)."""
    hashes = kmer_hashes(data)
    mask = np.uint64((1 << _POS_BITS) - 1)
    keys = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    span, width = min_len - KMER + 1, 1
    while 2 * width <= span:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < span:
        keys = np.minimum(keys[:width - span], keys[span - width:])
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return hashes[(keys[first] & mask).astype(np.int64)], first, np.diff(np.append(first, len(keys)))


def _piece_contexts(data: np.ndarray, offsets: np.ndarray, min_len: int):
    """Contexts of the texts of one piece; runs of windows are cut at text borders."""
    anchor, first, count = contexts(data, min_len)
    ends = offsets[1:]
    row = np.minimum(np.searchsorted(ends, first, "right"), len(ends) - 1)
    crossing = np.flatnonzero(first + count + (min_len - 1) > ends[row])
    ok = np.ones(len(first), bool)
    ok[crossing] = False
    cut = []
    for k in crossing.tolist():  # few: one or two runs for each border
        p, q, i = int(first[k]), int(first[k] + count[k]), int(row[k])
        while p < q and i < len(ends):
            stop = min(q, int(ends[i]) - min_len + 1)
            if stop > p:
                cut.append((i, k, p, stop - p))
            p, i = max(p, int(ends[i])), i + 1
    i, k, p, n = (np.array([c[j] for c in cut], np.int64) for j in range(4))
    return np.append(row[ok], i), np.append(anchor[ok], anchor[k]), np.append(first[ok], p), np.append(count[ok], n)


def block_contexts(block, min_len: int):
    """row, anchor, first window (position in the block), number of windows,
    for all texts of a block. Longer texts are hashed in overlapping pieces, so
    that each window lies in exactly one."""
    found, at = [], 0
    while at < block.n:
        a = int(block.offsets[at])
        end = max(int(np.searchsorted(block.offsets, a + PIECE, "right")) - 1, at + 1)
        b = int(block.offsets[end])
        if b - a <= PIECE:
            spans = [(a, b)]
        else:
            spans = [(s, min(b, s + PIECE + min_len - 1)) for s in range(a, max(b - min_len + 1, a + 1), PIECE)]
        for s, e in spans:
            if e - s >= min_len:
                offsets = np.clip(block.offsets[at:end + 1] - s, 0, e - s)
                row, anchor, first, count = _piece_contexts(block.data[s:e], offsets, min_len)
                found.append((row + at, anchor, first + s, count))
        at = end
    if not found:
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z
    return tuple(np.concatenate(x) for x in zip(*found))


def _pack(*arrays: np.ndarray) -> tuple[int, bytes]:
    raw = b"".join([struct.pack("<i", len(arrays)), *(struct.pack("<ci", a.dtype.char.encode(), len(a)) + a.tobytes() for a in arrays)])
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(blob: bytes, size: int) -> list[np.ndarray]:
    raw = pa.decompress(blob, size, codec="zstd", asbytes=True)
    (n,), at, out = struct.unpack_from("<i", raw), 4, []
    for _ in range(n):
        char, length = struct.unpack_from("<ci", raw, at)
        kind = np.dtype(char.decode())
        out.append(np.frombuffer(raw, kind, length, at + 5))
        at += 5 + length * kind.itemsize
    return out


_ROWS = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("blob", pa.binary())])
_ROWS_DDL = "kind int, key long, block long, size long, blob binary"
_SENT, _REMOVED = 0, 1


def _rows(kind: int, keys: list[int], blocks: list[int], packed: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([kind] * len(keys), pa.int32()), pa.array(keys, pa.int64()), pa.array(blocks, pa.int64()),
        pa.array([s for s, _ in packed], pa.int64()), pa.array([b for _, b in packed], pa.binary())], schema=_ROWS)


def _groups(sorted_values: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal values."""
    if not len(sorted_values):
        return []
    cuts = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1])).tolist()
    return list(zip(cuts, [*cuts[1:], len(sorted_values)]))


def _pack_blocks(size: int):
    """Rows as blocks of about ``size`` bytes of text: compressed Arrow streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            for part in text_blocks(batch.column(0), size):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(part.first, part.n))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])
                block += 1

    return run


def _read_block(blob) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def _texts(rows: pa.RecordBatch):
    return next(text_blocks(rows.column(0), 1 << 62))


def _sent_anchors(anchor: np.ndarray, n_buckets: int):
    """The distinct anchors of a block by bucket, and for each context its place there."""
    order = np.lexsort((anchor, anchor % np.uint64(n_buckets)))
    new = np.append(True, anchor[order][1:] != anchor[order][:-1])
    place = np.empty(len(anchor), np.int64)
    place[order] = np.cumsum(new) - 1
    return anchor[order][new], place


def _emit_anchors(min_len: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("rows")):
                row, anchor, _, _ = block_contexts(_texts(_read_block(blob.as_buffer())), min_len)
                if not len(row):
                    continue
                sent, place = _sent_anchors(anchor, n_buckets)
                # seen in two texts of this block already: shared wherever else it is
                low = np.full(len(sent), len(row) + 1, np.int64)
                high = np.full(len(sent), -1, np.int64)
                np.minimum.at(low, place, row), np.maximum.at(high, place, row)
                bucket = (sent % np.uint64(n_buckets)).astype(np.int64)
                cuts = _groups(bucket)
                top = (sent >> np.uint64(16)).astype(np.uint64)
                yield _rows(_SENT, [int(bucket[a]) for a, _ in cuts], [block] * len(cuts), [
                    _pack((top[a:b] >> np.uint64(16)).astype(np.uint32), (top[a:b] & np.uint64(0xFFFF)).astype(np.uint16), low[a:b] < high[a:b]) for a, b in cuts])

    return run


def _by_key(finish: Callable[[int, list, list], Iterator[pa.RecordBatch]]):
    """Runs ``finish(key, blocks, arrays)`` on the rows of each key; rows arrive
    sorted by (kind, key). Removed windows pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, held, current = [], [], None
        for batch in batches:
            kinds, keys, owners, sizes = (batch.column(c).to_pylist() for c in ("kind", "key", "block", "size"))
            blobs = batch.column("blob")
            for i, key in enumerate(keys):
                if kinds[i] == _REMOVED:
                    yield batch.slice(i, 1)
                    continue
                if key != current:
                    if held:
                        yield from finish(current, blocks, held)
                    blocks, held, current = [], [], key
                blocks.append(owners[i])
                held.append(_unpack(blobs[i].as_buffer(), sizes[i]))
        if held:
            yield from finish(current, blocks, held)

    return run


def _shared_anchors(key: int, blocks: list[int], held: list) -> Iterator[pa.RecordBatch]:
    hashes = [(h.astype(np.uint64) << np.uint64(16)) | l for h, l, _ in held]
    every = np.concatenate(hashes)
    multi = np.concatenate([m for _, _, m in held])
    order = np.argsort(every, kind="stable")
    v = every[order]
    new = np.append(True, v[1:] != v[:-1])
    group = np.cumsum(new) - 1
    shared = np.bincount(group) > 1
    shared |= np.bincount(group, weights=multi[order]) > 0
    mask = np.empty(len(v), bool)
    mask[order] = shared[group]
    at, packed = 0, []
    for h in hashes:
        packed.append(_pack(np.packbits(mask[at:at + len(h)])))
        at += len(h)
    yield _rows(_SENT, [key] * len(blocks), blocks, packed)


def _emit_contexts(min_len: int, n_buckets: int):
    """A block with the masks of its anchors, one for each bucket."""

    def run(_, blocks: pa.Table, masks: pa.Table) -> pa.Table:
        out = []
        found = {k: _unpack(blob, size)[0] for k, blob, size in zip(*(masks.column(c).to_pylist() for c in ("key", "blob", "size")))}
        for block, blob in zip(blocks.column("block").to_pylist(), blocks.column("rows").to_pylist()):
            rows = _read_block(blob)
            texts = _texts(rows)
            row, anchor, first, count = block_contexts(texts, min_len)
            if not len(row):
                continue
            sent, place = _sent_anchors(anchor, n_buckets)
            bucket = (sent % np.uint64(n_buckets)).astype(np.int64)
            shared = np.concatenate([np.unpackbits(found[int(bucket[a])], count=b - a) for a, b in _groups(bucket)]).astype(bool)
            keep = shared[place]
            row, anchor, first, count = row[keep], anchor[keep], first[keep], count[keep]
            docs = _doc_ids(rows)[row]
            # identical contexts: the smallest document of the block sends it
            settled = _settled(slice_hashes(texts.data, first, first + count + (min_len - 1)) ^ anchor, docs)
            if settled.any():
                out.append(_removed(block, first[settled], count[settled]))
            first, count, docs = first[~settled], count[~settled], docs[~settled]
            target = (anchor[~settled] % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            cuts = _groups(target[order])
            packed = []
            for a, b in cuts:
                s = order[a:b]
                packed.append(_pack(np.diff(docs[s], prepend=0), np.diff(first[s], prepend=0).astype(np.int32), count[s].astype(np.uint8),
                                    texts.data[gather_ranges(first[s], count[s] + (min_len - 1))]))
            if cuts:
                out.append(_rows(_SENT, [int(target[order[a]]) for a, _ in cuts], [block] * len(cuts), packed))
        return pa.Table.from_batches(out, _ROWS)

    return run


def _doc_ids(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column(1).cast(pa.int64()).fill_null(_LAST_ID).to_numpy(zero_copy_only=False)


def _settled(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True where a smaller document has the same key."""
    out = np.zeros(len(keys), bool)
    if len(keys):
        order = np.lexsort((docs, keys))
        new = np.append(True, keys[order][1:] != keys[order][:-1])
        out[order] = docs[order] > docs[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return out


def _removed(block: int, first: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(first)
    return _rows(_REMOVED, [block], [block], [_pack(np.diff(first[order], prepend=0).astype(np.int32), count[order].astype(np.uint8))])


def _in_two(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True where another document has the same key."""
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    new = np.append(True, k[1:] != k[:-1])
    start = np.flatnonzero(new)
    out = np.zeros(len(keys), bool)
    out[order] = (d[start] != d[np.append(start[1:], len(k)) - 1])[np.cumsum(new) - 1]
    return out


def _factors(min_len: int):
    """Removed windows of one bucket of anchors."""

    def run(key: int, blocks: list[int], held: list) -> Iterator[pa.RecordBatch]:
        docs = np.concatenate([np.cumsum(h[0]) for h in held])
        first = np.concatenate([np.cumsum(h[1].astype(np.int64)) for h in held])
        count = np.concatenate([h[2] for h in held]).astype(np.int64)
        data = np.concatenate([h[3] for h in held])
        owner = np.repeat(np.array(blocks, np.int64), [len(h[0]) for h in held])
        lengths = count + (min_len - 1)
        begins = np.cumsum(lengths) - lengths
        place = begins + _anchor_offsets(data, begins, count, min_len)
        anchor = slice_hashes(data, place, place + KMER)
        whole = slice_hashes(data, begins, begins + lengths) ^ anchor
        settled = _settled(whole, docs)
        out = [(owner[settled], first[settled], count[settled])]
        rest = _may_match(data, anchor, place, docs, begins, lengths, np.flatnonzero(~settled), min_len)
        if len(rest):
            entry = np.repeat(rest, count[rest])
            offset = gather_ranges(np.zeros(len(rest), np.int64), count[rest])
            hit = has_previous_factor([anchor[entry], *window_words(data, begins[entry] + offset, min_len)], docs[entry])
            out.append((owner[entry[hit]], first[entry[hit]] + offset[hit], np.ones(int(hit.sum()), np.int64)))
        owner, first, count = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(owner, kind="stable")
        for a, b in _groups(owner[order]):
            yield _removed(int(owner[order[a]]), first[order[a:b]], count[order[a:b]])

    return run


def _anchor_offsets(data: np.ndarray, begins: np.ndarray, count: np.ndarray, min_len: int) -> np.ndarray:
    """Where a context's anchor lies: the leftmost smallest k-mer hash among the
    k-mers that all its windows hold, offsets count-1 .. min_len-KMER."""
    hashes = kmer_hashes(data) & ~np.uint64((1 << _POS_BITS) - 1)
    best = np.full(len(begins), ~np.uint64(0))
    offset = count - 1
    for j in range(min_len - KMER + 1):
        h = hashes[begins + j]
        lower = (h < best) & (j >= count - 1)
        best[lower], offset[lower] = h[lower], j
    return offset


def _may_match(data, anchor, place, docs, begins, lengths, rest: np.ndarray, min_len: int) -> np.ndarray:
    """Those contexts of ``rest`` that can share a window with another document's
    different context. A shared window holds the anchor and ``min_len - KMER``
    bytes more, so it shares at least half of these on one side."""
    half = (min_len - KMER) // 2
    alive = np.zeros(len(docs), bool)
    for b in (place[rest] - half, place[rest] + KMER):
        inside = (b >= begins[rest]) & (b + half <= begins[rest] + lengths[rest])
        some = rest[inside]
        if len(some):
            alive[some[_in_two(slice_hashes(data, b[inside], b[inside] + half) ^ mix(anchor[some]), docs[some])]] = True
    return np.flatnonzero(alive)


def _union_spans(first: np.ndarray, count: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered byte ranges of windows given as sorted runs."""
    end = np.maximum.accumulate(first + count + (min_len - 1))
    new = np.append(True, first[1:] > end[:-1])
    s = np.flatnonzero(new)
    return first[s], end[np.append(s[1:], len(first)) - 1]


def _cut(min_len: int, finish: Callable[[pa.RecordBatch, list], pa.Table]):
    """A block with its removed windows; ``finish(rows, spans)`` makes the result."""

    def run(_, blocks: pa.Table, removed: pa.Table) -> pa.Table:
        parts = [_unpack(blob, size) for blob, size in zip(removed.column("blob").to_pylist(), removed.column("size").to_pylist())]
        first = np.concatenate([np.cumsum(p[0].astype(np.int64)) for p in parts]) if parts else np.zeros(0, np.int64)
        count = np.concatenate([p[1] for p in parts]).astype(np.int64) if parts else first
        order = np.argsort(first)
        first, count = first[order], count[order]
        out = []
        for blob in blocks.column("rows").to_pylist():  # one block has one row
            rows = _read_block(blob)
            texts = _texts(rows)
            cuts = np.searchsorted(first, texts.offsets).tolist()
            spans = [None if a == b else _union_spans(first[a:b] - o, count[a:b], min_len) for a, b, o in zip(cuts, cuts[1:], texts.offsets.tolist())]
            out.append(finish(rows, texts, spans))
        return pa.concat_tables(out) if out else None

    return run


def _kept(raw: bytes, span) -> bytes:
    if span is None:
        return raw
    starts, ends = span[0].tolist(), span[1].tolist()
    return b"".join([raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)])])


def _digest(rows: pa.RecordBatch, texts, spans: list) -> pa.Table:
    kept = [_kept(texts.text(i), span) for i, span in enumerate(spans)]
    sizes = np.diff(texts.offsets)
    return pa.table({
        "doc_id": rows.column(1).cast(pa.int64()), "n_bytes": pa.array(sizes, pa.int64()),
        "n_removed": pa.array(sizes - np.array([len(k) for k in kept], np.int64), pa.int64()),
        "n_spans": pa.array([0 if s is None else len(s[0]) for s in spans], pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())})


def whole_characters(raw: bytes, span) -> str:
    """The text without the covered bytes; a character that a range cuts stays."""
    data = np.frombuffer(raw, np.uint8)
    edge = np.zeros(len(raw) + 1, np.int64)
    edge[span[0]], edge[span[1]] = 1, -1
    covered = np.cumsum(edge)[:-1] > 0
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    gone = np.ones(int(char[-1]) + 1, bool)
    gone[char[~covered]] = False
    return data[~gone[char]].tobytes().decode()


def _rewrite(names: list[str]):
    def run(rows: pa.RecordBatch, texts, spans: list) -> pa.Table:
        valid = texts.valid.tolist()
        kept = [None if not valid[i] else texts.text(i).decode() if span is None else whole_characters(texts.text(i), span) for i, span in enumerate(spans)]
        return pa.table([pa.array(kept, pa.string()), *rows.columns[2:]], names=names)

    return run


def _removed_windows(rows: DataFrame, min_len: int) -> tuple[DataFrame, DataFrame]:
    """The blocks of ``rows`` (text first, doc_id second) and their removed windows."""
    spark = rows.sparkSession
    ship(spark)
    n = partitions(spark)
    n_buckets = n * BUCKETS
    name = f"tessera_blocks_{uuid.uuid4().hex}"
    (rows.mapInArrow(lean(_pack_blocks(BLOCK)), "block long, rows binary").write.bucketBy(n, "block").format("parquet")
     .option("path", work_path(spark, "llm_blocks")).saveAsTable(name))
    blocks = spark.table(name)

    def dealt(df: DataFrame, finish) -> DataFrame:
        return df.repartition(n, "kind", "key").sortWithinPartitions("kind", "key").mapInArrow(lean(_by_key(finish)), _ROWS_DDL)

    masks = dealt(blocks.mapInArrow(lean(_emit_anchors(min_len, n_buckets)), _ROWS_DDL), _shared_anchors)
    sent = blocks.groupBy("block").cogroup(masks.groupBy("block")).applyInArrow(lean_group(_emit_contexts(min_len, n_buckets)), _ROWS_DDL)
    return blocks, dealt(sent, _factors(min_len))


def repeated_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_len: int = MIN_LEN) -> DataFrame:
    """One row for each input row: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept_sha256 (digest of the remaining bytes)."""
    rows = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"))
    blocks, removed = _removed_windows(rows, min_len)
    return blocks.groupBy("block").cogroup(removed.groupBy("block")).applyInArrow(
        lean_group(_cut(min_len, _digest)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_len: int = MIN_LEN) -> DataFrame:
    """The input rows with repeated passages cut out of their text; a character
    that a cut would split stays whole. All columns are kept."""
    at = docs.columns.index(text)
    plain = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*plain)
    rest = [c for i, c in enumerate(plain) if i != at]
    rows = rows.select(F.col(plain[at]), F.col(plain[docs.columns.index(doc_id)]).cast("long").alias("id"), *rest)
    blocks, removed = _removed_windows(rows, min_len)
    kind = StructType([f for f in rows.schema if f.name != "id"])
    out = blocks.groupBy("block").cogroup(removed.groupBy("block")).applyInArrow(lean_group(_cut(min_len, _rewrite(kind.names))), kind)
    return out.select(*plain).toDF(*docs.columns)

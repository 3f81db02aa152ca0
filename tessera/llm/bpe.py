"""Operator 5: byte-level BPE encoding and decoding without regular expressions.

A block of texts becomes one array of code points. Each code point's class and
the class of its successor give a symbol; each symbol is a function from the
state of an eight-state transducer to its next state. Composition of such
functions is associative, so the states at all places come from a scan:
functions are composed inside fixed-width columns of the array (vectorised over
the columns), the column functions are scanned in turn, and the columns are
replayed from their true first state. Where the transducer starts a token, a
slice starts. Slices are grouped by hash; each distinct one is merged once by
rank and kept in a cache of bounded bytes that ends with the task. Byte offsets of the tokens are kept.

Every encoded text is decoded again and compared with its bytes; were two
slices of a block ever to share a hash, the text is encoded slice by slice.

Defined results: null and empty texts have no tokens. All other columns are
kept. The rank file travels with the tasks (under 1 MB), executors need no copy.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tessera.llm.blocks import SMALL_BLOCK_BYTES, lean, ship, slice_hashes, text_blocks

#: Bytes of merged slices a task keeps: half for those used since the last turn,
#: half for those of the turn before.
CACHE = 32 << 20
#: Bytes a slice takes beside its own, its ids' and its decimals' (objects, table).
_ENTRY = 400
#: Places that remember which slices came before.
_SEEN = 1 << 20
#: Bytes up to which the pairs of a slice are kept in a list, beyond it in a heap.
_SHORT = 64
#: White space as the pattern's \\s has it (fixed values).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Contractions the pattern splits off (fixed values): letters after the apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

# code point classes
_LETTER, _NUMBER, _OTHER, _BLANK, _SPACE = range(5)
# symbols: class with what follows; +8 where a text begins
_BLANK_JOINS, _SPACE_LAST, _SPACE_RUN, _APOSTROPHE1, _APOSTROPHE2 = 3, 4, 5, 6, 7
# states: what the open token is
_IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _IN_SPACE, _AFTER_BLANK, _ONE_LEFT, _TWO_LEFT, _CLOSED = range(8)

_WIDTH = 64


def _transducer() -> tuple[np.ndarray, np.ndarray]:
    """next state and "a token starts here", by symbol * 8 + state."""
    step, start = np.zeros((16, 8), np.uint8), np.ones((16, 8), bool)
    step[_LETTER], step[_NUMBER], step[_OTHER] = _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS
    step[_BLANK_JOINS], step[_SPACE_LAST], step[_SPACE_RUN] = _AFTER_BLANK, _IN_SPACE, _IN_SPACE
    step[_APOSTROPHE1], step[_APOSTROPHE2] = _ONE_LEFT, _TWO_LEFT
    for symbol, inside in ((_LETTER, _IN_LETTERS), (_NUMBER, _IN_NUMBERS), (_OTHER, _IN_OTHERS)):
        start[symbol, [inside, _AFTER_BLANK]] = False
    start[_SPACE_RUN, _IN_SPACE] = False
    for symbol in (_APOSTROPHE1, _APOSTROPHE2):  # inside a run of others it is one of them
        start[symbol, [_IN_OTHERS, _AFTER_BLANK]] = False
        step[symbol, [_IN_OTHERS, _AFTER_BLANK]] = _IN_OTHERS
    start[_LETTER, [_ONE_LEFT, _TWO_LEFT]] = False
    step[_LETTER, _ONE_LEFT], step[_LETTER, _TWO_LEFT] = _CLOSED, _ONE_LEFT
    step[8:], start[8:] = step[:8, _CLOSED, None], True
    return step.ravel(), start.ravel()


_STEP, _START = _transducer()
_TABLE: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """Class of every code point by Arrow's Unicode tables, made once in a process."""
    if not _TABLE:
        table = np.full(0x110000, _OTHER, np.uint8)
        for first in range(0, 0x110000, 0x800):  # a few at a time: freed objects stay in a worker's heap
            if 0xD800 <= first < 0xE000:
                continue
            chars, part = pa.array(map(chr, range(first, first + 0x800))), table[first:first + 0x800]
            part[pc.utf8_is_alpha(chars).to_numpy(zero_copy_only=False)] = _LETTER
            part[pc.utf8_is_numeric(chars).to_numpy(zero_copy_only=False)] = _NUMBER
        table[WHITE_SPACE] = _SPACE
        table[0x20] = _BLANK
        _TABLE.append(table)
    return _TABLE[0]


def _symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Symbol of each code point; ``firsts``: where texts begin."""
    kind = class_table()[points]
    begins = np.zeros(len(points) + 1, bool)
    begins[firsts] = True
    begins[-1] = True
    following = np.append(kind[1:], _SPACE)
    joins = (following < _BLANK) & ~begins[1:]
    symbol = kind.copy()
    space = kind >= _BLANK
    symbol[space] = np.where(joins[space], np.where(kind[space] == _BLANK, _BLANK_JOINS, _SPACE_LAST), _SPACE_RUN)
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        padded = np.append(points, [0, 0])
        broken = np.append(begins, True)
        one, two = padded[quotes + 1], padded[quotes + 2]
        near, far = ~broken[quotes + 1], ~broken[quotes + 1] & ~broken[np.minimum(quotes + 2, len(points))]
        for ending in ENDINGS:
            if len(ending) == 1:
                symbol[quotes[near & (one == ord(ending))]] = _APOSTROPHE1
            else:
                symbol[quotes[far & (one == ord(ending[0])) & (two == ord(ending[1]))]] = _APOSTROPHE2
    symbol[firsts[firsts < len(points)]] += 8
    return symbol


def _scan(functions: np.ndarray) -> np.ndarray:
    """State before each of a row of functions (n, 8), starting closed."""
    n = len(functions)
    if n <= _WIDTH:
        out, state = np.empty(n, np.uint8), _CLOSED
        for i in range(n):
            out[i], state = state, functions[i, state]
        return out
    width = -(-n // _WIDTH)
    padded = np.concatenate([functions, np.tile(np.arange(8, dtype=np.uint8), (width * _WIDTH - n, 1))]).reshape(width, _WIDTH, 8)
    whole = padded[:, 0]
    for j in range(1, _WIDTH):
        whole = np.take_along_axis(padded[:, j], whole.astype(np.int64), 1)
    state, rows = _scan(whole), np.arange(width)
    out = np.empty((width, _WIDTH), np.uint8)
    for j in range(_WIDTH):
        out[:, j] = state
        state = padded[rows, j, state]
    return out.ravel()[:n]


def token_starts(symbols: np.ndarray) -> np.ndarray:
    """True where the pattern's next match starts."""
    n = len(symbols)
    width = max(1, -(-n // _WIDTH))
    columns = np.full(width * _WIDTH, _SPACE_RUN, np.intp)
    columns[:n] = symbols
    columns = np.ascontiguousarray((columns * 8).reshape(width, _WIDTH).T)
    composed = np.broadcast_to(np.arange(8, dtype=np.uint8), (width, 8))
    for column in columns:
        composed = _STEP[column[:, None] + composed]
    state = _scan(composed)
    starts = np.empty((_WIDTH, width), bool)
    for j, column in enumerate(columns):
        at = column + state
        starts[j], state = _START[at], _STEP[at]
    return starts.T.ravel()[:n]


def slices(block) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the slices of a block (with the end), and the index of
    each text's first slice."""
    points = np.frombuffer(block.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((block.data & 0xC0) != 0x80)
    firsts = np.searchsorted(lead, block.offsets)
    starts = lead[token_starts(_symbols(points, firsts))] if len(points) else lead
    return np.append(starts, len(block.data)), np.searchsorted(starts, block.offsets)


class Codec:
    """Ranks of one vocabulary with a bounded cache of merged slices."""

    def __init__(self, rank_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.decimals = {rank: b"%d," % rank for rank in self.tokens}
        self.none = max(self.tokens, default=0) + 1  # above every rank
        self.release()

    def release(self) -> None:
        """Forget the merged slices; the vocabulary stays."""
        self.cache: dict[bytes, tuple[tuple[int, ...], bytes, bytes]] = {}
        self.before: dict[bytes, tuple[tuple[int, ...], bytes, bytes]] = {}
        self.held = 0
        self.seen = bytearray(_SEEN)

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of a slice: the pair of least rank is merged first, the leftmost of equals."""
        ranks = self.ranks
        if word in ranks:
            return (ranks[word],)
        n = len(word)
        if n <= _SHORT:
            parts, none = [word[i:i + 1] for i in range(n)], self.none
            pairs = [ranks.get(word[i:i + 2], none) for i in range(n - 1)]
            while pairs and (least := min(pairs)) < none:
                i = pairs.index(least)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del pairs[i]
                if i:
                    pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
                if i < len(pairs):
                    pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
            return tuple([ranks[part] for part in parts])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue  # one of the two was merged meanwhile
            end[i], after[i], alive[j] = stop, after[j], False
            k, p = after[i], before[i]
            if k < n:
                before[k] = i
                if (r := ranks.get(word[i:end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if p >= 0 and (r := ranks.get(word[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return tuple(ranks[word[i:end[i]]] for i in range(n) if alive[i])

    def entry(self, word: bytes) -> tuple[tuple[int, ...], bytes, bytes]:
        """Ids, ids as decimals each with a comma, and the ids decoded."""
        found = self.cache.get(word)
        if found is None:
            found = self.before.get(word)
            if found is None:
                ids = self.merge(word)
                decoded = self.decode(ids)
                found = (ids, b"".join([self.decimals[i] for i in ids]), word if decoded == word else decoded)
                place = hash(word) % _SEEN
                if not self.seen[place]:  # kept from the second time on: most slices come once
                    self.seen[place] = 1
                    return found
            size = _ENTRY + 8 * len(found[0]) + len(found[1]) + 2 * len(word)
            if size > CACHE // 8:
                return found
            if self.held + size > CACHE // 2:
                self.before, self.cache, self.held, self.seen = self.cache, {}, 0, bytearray(_SEEN)
            self.cache[word] = found
            self.held += size
        return found

    def decode(self, ids) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def encode_block(self, block) -> Iterator[tuple[list, int]]:
        """For each text its entries, slice by slice, and where its first slice starts."""
        offsets, firsts = slices(block)
        hashes = slice_hashes(block.data, offsets[:-1], offsets[1:])
        _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        raw = block.data.tobytes()
        words = [raw[a:b] for a, b in zip(offsets[example].tolist(), offsets[example + 1].tolist())]
        table = [self.cache.get(w) or self.entry(w) for w in words]
        entries = [table[i] for i in which.tolist()]
        bounds, at = firsts.tolist(), block.offsets.tolist()
        for i in range(block.n):
            own = entries[bounds[i]:bounds[i + 1]]
            if b"".join([e[2] for e in own]) != raw[at[i]:at[i + 1]]:
                cuts = offsets[bounds[i]:bounds[i + 1] + 1].tolist()
                own = [self.entry(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield own


_CODECS: dict[bytes, Codec] = {}


def codec(rank_file: bytes) -> Codec:
    key = hashlib.sha256(rank_file).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(rank_file)
    return _CODECS[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _each_block(rank_file: bytes, text: str, finish: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(rank_file)
        try:
            for batch in batches:
                for block in text_blocks(batch.column(text), SMALL_BLOCK_BYTES):
                    yield finish(batch.slice(block.first, block.n), list(known.encode_block(block)))
        finally:
            known.release()

    return run


def encode(docs: DataFrame, text: str = "text", ranks: str | None = None) -> DataFrame:
    """The input rows with token_ids and token_offsets (the byte in the text where
    each token starts). Columns of these names are replaced."""
    ship(docs.sparkSession)
    rank_file = _read(ranks or default_ranks())
    own = {"token_ids", "token_offsets"}
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own])
    schema = StructType([*docs.schema.fields, StructField("token_ids", ArrayType(IntegerType())), StructField("token_offsets", ArrayType(LongType()))])

    def finish(rows: pa.RecordBatch, texts: list[list]) -> pa.RecordBatch:
        tokens = codec(rank_file).tokens
        ids = [[i for e in own for i in e[0]] for own in texts]
        offsets = []
        for x in ids:
            lengths = np.array([len(tokens[i]) for i in x], np.int64)
            offsets.append(np.cumsum(lengths) - lengths)
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(offsets, pa.list_(pa.int64()))],
                                          names=[*rows.schema.names, "token_ids", "token_offsets"])

    return docs.mapInArrow(lean(_each_block(rank_file, text, finish)), schema)


def decode(tokens: DataFrame, ids: str = "token_ids", ranks: str | None = None) -> DataFrame:
    """The input rows with the bytes of their ids as ``decoded``."""
    ship(tokens.sparkSession)
    rank_file = _read(ranks or default_ranks())
    tokens = tokens.select(*[F.col(f"`{c}`") for c in tokens.columns if c != "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            decoded = [codec(rank_file).decode(x or ()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields]).add("decoded", "binary"))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """doc_id, n_tokens, digest of the ids and digest of the decoded ids."""
    ship(docs.sparkSession)
    rank_file = _read(ranks or default_ranks())

    def finish(rows: pa.RecordBatch, texts: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            rows.column(0), pa.array([sum([len(e[0]) for e in own]) for own in texts], pa.int64()),
            pa.array([hashlib.sha256(b"".join([e[1] for e in own])[:-1]).hexdigest() for own in texts], pa.string()),
            pa.array([hashlib.sha256(b"".join([e[2] for e in own])).hexdigest() for own in texts], pa.string()),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        lean(_each_block(rank_file, "text", finish)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

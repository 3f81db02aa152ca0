"""Operator 9: language identification by rank-order profiles.

A text is lower-cased and cut into words of letters; its n-grams of one to
three characters, word borders included, are counted. The ``TOP`` most
frequent n-grams in order are a profile. A language's profile comes from the
counts over all documents it may learn from, a document's from its own counts.
The distance is the sum, over the document's n-grams, of how far out of place
each is in the language's profile (``TOP`` if it is not there); the language
with the least distance wins, the first by name of equals.

Counts are made inside each partition, summed by (language, n-gram), and only
``TOP`` rows for each language reach the driver. N-grams are compared by a 42-bit hash.

Defined results: null text, or text without a letter -> ``und`` with score 0;
so has every text if nothing can be learned. Rows without a doc_id are
predicted but neither learned from nor held out. The score is 1 - distance /
greatest possible distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tessera.llm.blocks import mix, ship, text_blocks
from tessera.llm.bpe import _LETTER, class_table

TOP = 400
UNKNOWN = "und"
_GRAM_BITS = 42
_GRAM = np.uint64((1 << _GRAM_BITS) - 1)
#: Characters whose n-grams are sorted at once; texts handled at once.
_PIECE, _TEXTS = 1 << 20, 1 << 20
#: (owner, n-gram) counts a task gathers before it sends them on.
_HELD = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Every fourth document by crc32 of its id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _letters(texts: list[str], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points + 2 of the words of all texts with a 1 at each word border
    (0 is left for "no character"), and the owner of each place."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 2 for t in lowered])  # each text between two borders of its own
    points = np.frombuffer("".join([f"\n{t}\n" for t in lowered]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letter = class_table()[points] == _LETTER
    owner = np.repeat(owners, sizes)
    # a border stays if a letter is beside it
    keep = letter | np.append(letter[1:], False) | np.append(False, letter[:-1])
    return np.where(letter, points + np.uint64(2), np.uint64(1))[keep], owner[keep]


def gram_counts(texts: list[str], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, n-gram hash, count), sorted by owner and hash; owners below 2**22."""
    chars, owner = _letters(texts, owners)
    keys = np.zeros(0, np.uint64)
    counts = np.zeros(0, np.int64)
    for at in range(0, len(chars), _PIECE):
        c = chars[at:at + _PIECE + 2]
        o = owner[at:at + _PIECE + 2].astype(np.uint64) << np.uint64(_GRAM_BITS)
        n = min(_PIECE, len(chars) - at)
        parts = []
        for size in (1, 2, 3):
            m = min(n, len(c) - size + 1)
            if m <= 0:
                continue
            gram = c[:m].copy()
            for j in range(1, size):
                gram = (gram << np.uint64(21)) | c[j:j + m]
            # inside a word: a border may only be at an end, and one letter must be there
            middle = c[size // 2:size // 2 + m] if size != 2 else c[:m] * c[1:1 + m]
            inside = (middle > 1) & (o[:m] == o[size - 1:size - 1 + m])
            parts.append((mix(gram[inside]) & _GRAM) | o[:m][inside])
        found = np.sort(np.concatenate(parts))
        new = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
        keys, counts = _merge(keys, counts, found[new], np.diff(np.append(new, len(found))))
    return (keys >> np.uint64(_GRAM_BITS)).astype(np.int64), (keys & _GRAM).astype(np.int64), counts


def _merge(keys, counts, more_keys, more_counts):
    if not len(keys):
        return more_keys, more_counts
    every, number = np.unique(np.concatenate([keys, more_keys]), return_inverse=True)
    return every, np.bincount(number, np.concatenate([counts, more_counts])).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) -> (lang, gram, n) of the partition."""
    names: dict[str, int] = {}
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def send():
        by = np.array(list(names), object)
        return pa.RecordBatch.from_arrays([pa.array(by[(keys >> np.uint64(_GRAM_BITS)).astype(np.int64)] if len(keys) else [], pa.string()),
                                           pa.array((keys & _GRAM).astype(np.int64)), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        column = batch.column("text")
        for block in text_blocks(column, _TEXTS):
            own = np.array([names.setdefault(x, len(names)) for x in langs[block.first:block.first + block.n]], np.int64)
            order = np.argsort(own, kind="stable")
            texts = [block.text(i).decode() for i in order.tolist()]
            owner, gram, n = gram_counts(texts, own[order])
            keys, counts = _merge(keys, counts, (owner.astype(np.uint64) << np.uint64(_GRAM_BITS)) | gram.astype(np.uint64), n)
            if len(keys) > _HELD:
                yield send()
                keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    yield send()


def profiles(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP) -> dict[str, list[int]]:
    """Each language's most frequent n-grams in order, from all rows given."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    out: dict[str, list[int]] = {}
    for row in counts.withColumn("place", place).where(F.col("place") <= top).orderBy("lang", "place").collect():
        out.setdefault(row["lang"], []).append(row["gram"])
    return out


def _predict(known: dict[str, list[int]], top: int):
    names = sorted(known)
    grams = np.unique(np.array([g for x in known.values() for g in x], np.int64))
    places = np.full((len(grams) + 1, max(len(names), 1)), -1, np.int32)  # the last row: in no profile
    for k, name in enumerate(names):
        places[np.searchsorted(grams, known[name]), k] = np.arange(len(known[name]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column("text"), _TEXTS):
                texts = [block.text(i).decode() for i in range(block.n)]
                owner, gram, n = gram_counts(texts, np.arange(block.n)) if names else (np.zeros(0, np.int64),) * 3
                at = np.searchsorted(grams, gram)
                at[at == len(grams)] = 0
                row = np.where(grams[at] == gram, at, len(grams)) if len(grams) else at
                cuts = np.searchsorted(owner, np.arange(block.n + 1)).tolist()
                languages, scores = [], []
                for a, b in zip(cuts, cuts[1:]):
                    if a == b:
                        languages.append(UNKNOWN), scores.append(0.0)
                        continue
                    own = places[row[a:b][np.argsort(-n[a:b], kind="stable")[:top]]]
                    distance = np.where(own < 0, top, np.abs(own - np.arange(len(own), dtype=np.int32)[:, None])).sum(axis=0)
                    best = int(distance.argmin())
                    languages.append(names[best]), scores.append(1.0 - float(distance[best]) / (top * len(own)))
                yield pa.RecordBatch.from_arrays([*batch.slice(block.first, block.n).select(["doc_id", "held_out"]).columns,
                                                  pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, known: dict[str, list[int]], doc_id: str = "doc_id", text: str = "text", top: int = TOP) -> DataFrame:
    """One row for each input row: doc_id, held_out, lang_pred, score."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(_predict(known, top), "doc_id long, held_out boolean, lang_pred string, score double")


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Profiles from the documents that are not held out, then all documents."""
    return identify(docs, profiles(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))))

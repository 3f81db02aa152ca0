"""Operator 8: toxicity by a counterfactual-regularised classifier.

A text's features are its distinct words and the first four, five and six bytes
of longer words, by 64-bit hash. From a bounded sample of labelled rows the
features that go with the label are selected by likelihood ratio, and a
logistic regression is fitted to them. Sentences with an identity term get a
counterfactual twin in which each such term is swapped for another one of its
list; the squared difference of the two scores is a penalty, so that a neutral
mention of a group does not raise a score.

The sample is bounded by ``TOXIC_ROWS`` and ``CLEAN_ROWS`` (the least by hash of
the id, one text for each id). Features are counted and selected on Spark; of the
sample only the numbers of the selected ones reach the driver. All texts are scored whole, with
the model sent to the tasks (at most ``FEATURES`` weights). The intercept is set
for the share of toxic rows among all labelled rows.

Defined results: null or empty text scores like a text without known features;
without labels of both kinds nothing can be learned and every score is 0. Rows
that repeat a doc_id are scored alike if their texts are. Null labels and
labelled ids without a document are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import LOWER, lean, materialize, ship, slice_hashes, text_blocks, word_spans
from tessera.llm.langid import held_out

TOXIC_ROWS = 3000
CLEAN_ROWS = 6000
FEATURES = 2000
#: Least likelihood ratio (2 log) of a selected feature, and rows it must be in.
LEAST_RATIO, LEAST_ROWS = 16.0, 4
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)
#: Weight of the squared difference between a score and its counterfactual's.
COUNTERFACTUAL = 5.0
RIDGE = 1e-4
STEPS = 400
#: Identity terms (English, French, German, Spanish), in lists within which they are swapped (fixed values).
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino"), ("africans", "europeans", "asians", "americans"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "citizens", "refugees"),
    ("old", "young"), ("deaf", "blind", "disabled"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("musulmans", "chrétiens", "juifs"), ("musulman", "chrétien", "juif"),
    ("noirs", "blancs"), ("immigrés", "citoyens", "réfugiés"), ("sourds", "aveugles"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("muslime", "christen", "juden"),
    ("schwarze", "weiße"), ("einwanderer", "bürger", "flüchtlinge"), ("gehörlose", "blinde"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("chicas", "chicos"), ("musulmanes", "cristianos", "judíos"), ("musulmán", "cristiano", "judío"),
    ("negros", "blancos"), ("inmigrantes", "ciudadanos", "refugiados"), ("sordos", "ciegos"),
)

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SWAP = {term: terms[(i + 1) % len(terms)] for terms in IDENTITY_TERMS for i, term in enumerate(terms)}
_MENTION = re.compile(r"\b(" + "|".join(sorted(_SWAP, key=len, reverse=True)) + r")\b", re.IGNORECASE)


def counterfactual(text: str) -> str | None:
    """The text with identity terms swapped; None if it has none."""
    swapped, n = _MENTION.subn(lambda m: _SWAP[m[0].lower()], text)
    return swapped if n else None


def block_features(block) -> tuple[np.ndarray, np.ndarray]:
    """(text index, feature hash) of all words and prefixes of a block."""
    data = LOWER[block.data]
    starts, ends, firsts = word_spans(_WORD[data], block.offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text = np.repeat(np.arange(block.n), np.diff(firsts))
    owners, hashes = [text], [slice_hashes(data, starts, ends)]
    for size in PREFIXES:
        long = ends - starts > size
        owners.append(text[long])
        hashes.append(slice_hashes(data, starts[long], starts[long] + size) ^ np.uint64(size))
    return np.concatenate(owners), np.concatenate(hashes)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each text and of its counterfactual (null if none)."""
    for batch in batches:
        for block in text_blocks(batch.column("text")):
            twins = [counterfactual(block.text(i).decode()) for i in range(block.n)]
            out = []
            for part in (block, next(text_blocks(pa.array(twins, pa.string()), 1 << 62))):
                owner, feature = block_features(part)
                out.append([np.unique(feature[owner == i]).view(np.int64) if part.valid[i] and len(owner) else None for i in range(part.n)])
            yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(block.first, block.n), pa.array(out[0], pa.list_(pa.int64())), pa.array(out[1], pa.list_(pa.int64()))],
                                             names=["toxic", "features", "twin"])


def _select(sample: DataFrame, toxic: int, clean: int) -> np.ndarray:
    """Features whose presence goes with the label, the strongest by likelihood
    ratio: counted on Spark, at most FEATURES of them reach the driver."""
    counts = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where(F.col("a") + F.col("b") >= LEAST_ROWS)
    share = (F.col("a") + F.col("b")) / F.lit(float(toxic + clean))

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("a"), share * toxic) + part(F.col("b"), share * clean) + part(toxic - F.col("a"), (1 - share) * toxic) + part(clean - F.col("b"), (1 - share) * clean))
    best = counts.select("feature", ratio.alias("ratio")).where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(FEATURES).collect()
    return np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))


def _known_features(features: np.ndarray):
    """Rows (toxic, features, twin) with the indices of the selected features only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for name in ("features", "twin"):
                kept = []
                for x in batch.column(name):
                    if not x.is_valid:
                        kept.append(None)
                        continue
                    own = x.values.to_numpy(zero_copy_only=False).view(np.uint64)
                    at = np.minimum(np.searchsorted(features, own), max(len(features) - 1, 0))
                    kept.append(at[features[at] == own].astype(np.int32) if len(features) else np.zeros(0, np.int32))
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *columns], names=["toxic", "features", "twin"])

    return run


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    intercept: float


class _Rows:
    """Which selected features each row has, as pairs."""

    def __init__(self, rows: list[list[int]], width: int):
        self.column = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.n, self.width = len(rows), width

    def scores(self, w: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.bincount(self.row, w[self.column], self.n) + w[-1])))

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        """Of the weights and the intercept, from the slope at each row."""
        return np.append(np.bincount(self.column, slope[self.row], self.width), slope.sum())


def fit_rows(features: np.ndarray, rows: list[list[int]], toxic: np.ndarray, twins: list[tuple[int, list[int]]], share: float, penalty: float = COUNTERFACTUAL) -> Model:
    """Logistic regression with ridge and counterfactual penalty, by Adam steps.
    ``rows``: indices of the features each row has; ``twins``: (row, those of its
    counterfactual); ``share``: of toxic rows."""
    own, swapped = _Rows(rows, len(features)), _Rows([t for _, t in twins], len(features))
    pair = np.array([i for i, _ in twins], np.int64)
    w, m, v = (np.zeros(len(features) + 1) for _ in range(3))
    for step in range(1, STEPS + 1):
        p = own.scores(w)
        slope = (p - toxic) / own.n
        g = np.zeros(len(w))
        if len(pair):
            q = swapped.scores(w)
            gap = 2 * penalty * (p[pair] - q) / len(pair)
            np.add.at(slope, pair, gap * p[pair] * (1 - p[pair]))
            g += swapped.gradient(-gap * q * (1 - q))
        g += own.gradient(slope)
        g[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    shift = np.log(share / (1 - share)) - np.log(toxic.sum() / (len(toxic) - toxic.sum()))
    return Model(features, w[:-1], float(w[-1] + shift))


def sampled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(toxic, text) of the labelled rows to learn from: of each chosen id one
    text, the least by hash, so that repeated ids add no rows."""
    known = labels.select(F.col("doc_id").alias("label_id"), "toxic").where("label_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("label_id"))).distinct()
    order = F.xxhash64("label_id")
    chosen = known.where("toxic = 1").orderBy(order, "label_id").limit(TOXIC_ROWS).unionByName(known.where("toxic = 0").orderBy(order, "label_id").limit(CLEAN_ROWS))
    rows = docs.select(F.col(doc_id).cast("long").alias("label_id"), F.col(text).alias("text")).where(F.col(text).isNotNull()).join(F.broadcast(chosen), "label_id")
    return rows.groupBy("label_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")).select(F.col("toxic").cast("int").alias("toxic"), "text")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", penalty: float = COUNTERFACTUAL) -> Model | None:
    """The model of a bounded sample of the labelled rows that are not held out."""
    ship(docs.sparkSession)
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct()
    totals = dict(known.groupBy("toxic").count().collect())
    if not (totals.get(0) and totals.get(1)):
        return None
    sample = sampled(docs, labels, doc_id, text).mapInArrow(lean(_sample_features), "toxic int, features array<long>, twin array<long>").where("features IS NOT NULL")
    sample = materialize(sample, "toxic_sample")
    found = dict(sample.groupBy("toxic").count().collect())
    if not (found.get(0) and found.get(1)):
        return None
    features = _select(sample, found[1], found[0])
    rows = sample.mapInArrow(_known_features(features), "toxic int, features array<int>, twin array<int>").collect()  # TOXIC_ROWS + CLEAN_ROWS rows of at most FEATURES numbers
    twins = [(i, r["twin"]) for i, r in enumerate(rows) if r["twin"] is not None]
    return fit_rows(features, [r["features"] for r in rows], np.array([r["toxic"] for r in rows], np.int64), twins, totals[1] / (totals[0] + totals[1]), penalty)


def _scores(model: Model | None, block) -> np.ndarray:
    if model is None:
        return np.zeros(block.n)
    z = np.full(block.n, model.intercept)
    if len(model.features):
        owner, feature = block_features(block)
        at = np.searchsorted(model.features, feature)
        at[at == len(model.features)] = 0
        hit = model.features[at] == feature
        pairs = np.unique(owner[hit] * len(model.features) + at[hit])
        np.add.at(z, pairs // len(model.features), model.weights[pairs % len(model.features)])
    return 1 / (1 + np.exp(-z))


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The input rows with ``toxicity_score`` (a column of this name is replaced)."""
    ship(docs.sparkSession)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "toxicity_score"])
    schema = docs.withColumn("toxicity_score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch.column(text)):
                rows = batch.slice(block.first, block.n)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(_scores(model, block), pa.float64())], names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity_score").alias("score"),
                         F.when(F.col("toxicity_score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The input rows that score below the threshold, with their own columns."""
    return score(docs, fit(docs, labels)).where(F.col("toxicity_score") < THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])

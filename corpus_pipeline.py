"""The training-corpus pipeline: STAGES in order, each on the whole output of
the one before.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return
the columns of ``documents`` and keep every clean document. ``run`` applies
them to the documents table, writing and rereading between stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import bpe, decontam, neardup, suffixdedup, toxicity
from tessera.llm.blocks import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; learned from this stage's own
    labelled documents that are not held out."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group (five-word shingles, 0.8)."""
    return neardup.without_near_duplicates(docs, width=5)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has are cut; n_chars follows."""
    out = suffixdedup.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontam.without_contamination(docs, _table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids and offsets, and the number of tokens."""
    out = bpe.encode(docs)
    return out.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: Classifier, cuts and tokenizer are not expressible in SQL; tests/llm compare
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The pipeline's stages on their own inputs, against plain versions."""

import pytest

import corpus_pipeline
from tessera.llm import bpe, toxicity
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.frames import edge_documents, empty_documents


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_whole_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    predicted = {r.doc_id: r.predicted for r in toxicity.judge(docs, labels).collect()}
    left = [(d, t) for d, t in rows(docs) if not predicted[d]]
    groups = brute.near_duplicates(left, 5)
    left = [(d, t) for d, t in left if groups[d][1] == d]
    kept = []
    for (d, t), (_, _, removed, _, _) in zip(left, brute.repeated_bytes(left)):
        kept.append((d, t, removed))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    by_id = {d: (t, removed) for d, t, removed in kept}
    assert set(out) <= set(by_id)
    for d, r in out.items():
        text, removed = by_id[d]
        # a cut never splits a character, so at most a few bytes more stay
        assert 0 <= len(r.text.encode()) - (len(text.encode()) - removed) <= 8 and r.n_chars == len(r.text)
        assert r.n_tokens == len(r.token_ids) == len(r.token_offsets)
    gone = [(d, by_id[d][0]) for d in set(by_id) - set(out)]
    assert all(hit for *_, hit in brute.contamination(gone, items))
    assert not any(hit for *_, hit in brute.contamination([(d, r.text) for d, r in out.items()], items))
    with open(bpe.default_ranks(), "rb") as f:
        codec = bpe.Codec(f.read())
    assert all(codec.decode(r.token_ids).decode() == r.text for r in out.values())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_keeps_columns_and_survives_edges(spark, name, stage):
    docs = edge_documents(spark)
    out = stage(spark, docs, SF_SMALL)
    assert out.columns[:len(docs.columns)] == docs.columns
    assert name == "byte_bpe" or out.schema == docs.schema
    ids = [r.doc_id for r in out.collect()]
    assert set(ids) <= {r.doc_id for r in docs.collect()}
    if name in ("toxicity", "suffix_dedup", "decontaminate", "byte_bpe"):
        assert sorted(ids) == sorted(r.doc_id for r in docs.collect())  # nothing here is toxic or contaminated
    assert stage(spark, empty_documents(spark), SF_SMALL).collect() == []


def test_stages_are_the_agreed_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "decontaminate", "byte_bpe"]

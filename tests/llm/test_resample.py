"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import resample
from tessera.llm.blocks import text_blocks
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.frames import edge_documents, empty_documents

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    words = _WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    grams = words + [b" ".join(p) for p in zip(words, words[1:])]
    return len(words), [zlib.crc32(g) % 10000 for g in grams]


def plain(rows, target, percent=25, least=20):
    s, t = [0] * 10000, [0] * 10000
    for _, x in rows:
        for b in buckets(x)[1]:
            s[b] += 1
    for x in target:
        for b in buckets(x)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    out = []
    for d, x in rows:
        n, own = buckets(x)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append((d, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], -math.inf if r[0] is None else r[0]))
    rank = {}
    for k, r in enumerate(fit[:percent * len(fit) // 100], 1):
        rank.setdefault(r, []).append(k)
    return sorted([(r[0], *r[2:], rank[r].pop() if rank.get(r) else None) for r in out], key=repr)


def check(spark, docs, target):
    got = sorted((tuple(r) for r in resample.resample(docs, target).collect()), key=repr)
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert got == want
    return got


def test_documents(spark):
    docs, target = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "benchmark"))
    check(spark, docs, target)


def test_head_holds_frequent_features(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    monkeypatch.setattr(resample, "LEAST_IN_BLOCK", 2)
    head = resample.head_vocabulary(docs)
    assert (head.word_keys != 0).sum() > 100 and (head.pair_keys != 0).sum() > 100
    assert (resample.bucket_totals(docs, head) == resample.bucket_totals(docs)).all()
    monkeypatch.setattr(resample, "WORD_SLOTS", 64)
    monkeypatch.setattr(resample, "PAIR_SLOTS", 64)
    small = resample.head_vocabulary(docs)
    assert len(small.word_keys) == len(small.pair_keys) == 64 and (small.word_keys != 0).any()
    assert (resample.bucket_totals(docs, small) == resample.bucket_totals(docs)).all()


def test_edge_rows_and_no_target(spark):
    check(spark, edge_documents(spark), spark.createDataFrame([(1, None), (2, "")], "item_id int, text string"))
    check(spark, empty_documents(spark), spark.createDataFrame([("a b",)], "text string"))


def test_ties_repeats_and_nulls(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text)] * 300 + [(d, text) for d in range(100)] + [(None, text)] * 3 + [(7, "short"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("rank", F.lit("x")).withColumn("score", F.lit(1))
    got = check(spark, docs, spark.createDataFrame([(text,)], "text string"))
    assert sorted(r[-1] for r in got if r[-1]) == list(range(1, 25 * 403 // 100 + 1))


def test_draw_follows_the_target(spark):
    rnd = random.Random(1)
    near, far = [f"n{i}" for i in range(50)], [f"f{i}" for i in range(50)]
    rows = [(d, " ".join(rnd.choices(near if d % 4 == 0 else far, k=40))) for d in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = resample.resample(docs, spark.createDataFrame([(" ".join(rnd.choices(near, k=400)),)], "text string")).where("rank IS NOT NULL").collect()
    assert len(out) == 200 and np.mean([r.doc_id % 4 == 0 for r in out]) > 0.5  # a quarter of the rows


def test_crc_of_any_bytes():
    import pyarrow as pa

    texts = ["a" * 200, "ñandú 中文", "x", "", "b" * 64 + " " + "c" * 65]
    block = next(text_blocks(pa.array(texts)))
    words = resample.Words.of(block)
    states = resample._states(words, None)
    raw = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends)]
    assert [int(s ^ np.uint32(0xFFFFFFFF)) for s in states] == [zlib.crc32(w) for w in raw]

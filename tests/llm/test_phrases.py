"""Phrase collocations against a plain version."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import phrases
from tests.conftest import SF_CHECK
from tests.llm.frames import PASSAGE, edge_documents, empty_documents


def walks(rows):
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            if words := re.findall(r"[^\x20\x09]+", piece):
                yield lang if lang is not None else "und", words


def plain_counts(rows):
    f = defaultdict(Counter)
    for lang, words in walks(rows):
        f[lang][()] += len(words)
        for k in (1, 2, 3):
            f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return f


def plain(rows, least=10, covered=50, top=2000):
    out = []
    for lang, f in plain_counts(rows).items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) == 3 and b >= least and p in (q[:2], q[1:]) and 100 * b >= covered * a for q, b in f.items() if len(p) == 2 and (q[:2] == p or q[1:] == p)):
                continue
            score, _, le, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), le, r))
        for rank, (score, a, p, le, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, f[()], -score))
    return sorted(out)


def check(docs, **how):
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = sorted(tuple(r) for r in phrases.collocations(docs, **how).collect())
    assert got == plain(rows, least=how.get("min_count", 10), top=how.get("top", 2000))
    return got


def invented(spark, n=150, words=25, seed=4):
    """Texts over a small vocabulary with frequent pairs and passages, null langs, odd blanks and pieces."""
    rnd = random.Random(seed)
    vocabulary = [f"W{i}" if i % 5 else f"ñ{i} " for i in range(words)]
    rows = []
    for d in range(n):
        parts = [rnd.choice(vocabulary) for _ in range(rnd.randrange(60))]
        parts.insert(len(parts) // 2, "New York  City\tHall" if d % 2 else "new york")
        parts.insert(len(parts) // 3, PASSAGE)
        rows.append((d, "".join(x + rnd.choice([" ", " ", " ", "\t ", ". ", "\n", ",,"]) for x in parts), rnd.choice(["en", "fr", None])))
    return spark.createDataFrame(rows + [(1, None, "en"), (2, "", "de"), (3, ".,;", "de"), (4, "one", "es")], "doc_id long, text string, lang string").repartition(4)


def test_invented(spark):
    assert len(check(invented(spark))) > 50
    assert len(check(invented(spark), top=7, min_count=3)) == 21


def test_edge_rows(spark):
    check(edge_documents(spark).withColumn("phrase", F.lit(1)).withColumn("k", F.lit("x")))
    assert phrases.collocations(empty_documents(spark)).collect() == []


@pytest.mark.parametrize("how", [{"hot_from": 2}, {"held": 5}, {}])
def test_counts_with_spread_nodes_and_small_merges(spark, how):
    docs = invented(spark)
    got = {(r.lang, r.phrase): r.n for r in phrases.phrase_counts(docs, 4, **how).collect()}
    want = {(lang, " ".join(p)): n for lang, f in plain_counts([(r.lang, r.text) for r in docs.collect()]).items() for p, n in f.items() if n >= 4 or not p}
    assert got == want


def test_paths_hold_every_edge_once(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    f = plain_counts(rows)
    edges = Counter()
    found = phrases.paths(docs).collect()
    for r in found:
        words = r.phrase.split(" ")
        assert r.n_words == len(words)
        edges.update((r.lang, *words[i:i + 3]) for i in range(len(words) - 2))
        assert {f[r.lang][tuple(words[i:i + 3])] for i in range(len(words) - 2)} == {r.n}
    assert set(edges.values()) == {1} and set(edges) == {(lang, *p) for lang, c in f.items() for p, n in c.items() if len(p) == 3 and n >= 10}
    text = defaultdict(str)
    for lang, words in walks(rows):
        text[lang] += " " + " ".join(words) + " |"
    longest = max(found, key=lambda r: r.n_words)
    assert longest.n_words > 5 and text[longest.lang].count(f" {longest.phrase} ") == longest.n


def test_score_is_exact_beyond_64_bits(spark):
    big = 10 ** 15 - 7
    row = spark.createDataFrame([(big - 3, big, big - 1)], "a long, l long, r long").select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).first()
    assert row[0] == 1000000 * (big - 3) ** 2 // (big * (big - 1))

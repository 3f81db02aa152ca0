"""Quality rules against a plain version, on edge rows and on boilerplate."""

import random
import re

from pyspark.sql import functions as F

from tessera.llm import quality
from tests.conftest import SF_SMALL
from tests.llm.frames import PASSAGE, edge_documents, empty_documents


def plain(rows):
    """(doc_id, text, host) rows -> sorted result tuples."""
    blank = r"[\x20\x09-\x0D]"

    def norm(line):
        line = re.sub("[A-Z]", lambda m: m[0].lower(), line)
        return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", re.sub("[0-9]+", "0", line)).strip(" ")

    hosts = {}
    for _, t, h in rows:
        hosts.setdefault(h, set()).add(t or "")
    often = {}
    for h, texts in hosts.items():
        n = {}
        for t in texts:
            for x in {norm(x) for x in t.split("\n")} - {""}:
                n[x] = n.get(x, 0) + 1
        often[h] = {x for x, k in n.items() if k >= quality.LEAST_DOCS and 100 * k >= quality.HOST_SHARE * len(texts)}
    out = []
    for d, t, h in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = {}
        for i in range(len(words) - 2):
            seen.setdefault(tuple(words[i:i + 3]), []).append(i)
        hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
        lines = [x for x in t.split("\n") if re.sub(blank, "", x)]
        lost = sum(len(norm(x).split(" ")) for x in lines if norm(x) in often[h])
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        kept = not failed and len(words) - lost >= 50 and 100 * lost <= 50 * len(words)
        out.append((d, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), failed, kept, lost))
    return sorted(out, key=repr)


def check(docs):
    got = sorted((tuple(r) for r in quality.judge(docs).collect()), key=repr)
    assert got == plain([(r.doc_id, r.text, r.source) for r in docs.collect()])
    return got


def test_documents(spark):
    check(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def test_edge_rows(spark):
    check(edge_documents(spark))
    assert quality.judge(empty_documents(spark)).collect() == []
    assert quality.without_poor(empty_documents(spark)).collect() == []


def boilerplate(spark):
    """Thirty documents of one host share a line; some are little else; null host and id, repeated rows."""
    rnd = random.Random(3)
    def prose(n):
        return " ".join("".join(rnd.choices("abcdefgh", k=9)) for _ in range(n))

    shared = "Accept   ALL cookies, read our terms of 2024 " + PASSAGE
    rows = [(d, f"{prose(80)}\n{shared.replace('2024', str(d))}", "hot") for d in range(30)]
    rows += [(100 + d, f"{prose(51)}\n{shared}\n{shared.lower()}\n{shared.upper()}", "hot") for d in range(5)]
    rows += [(200 + d, f"{prose(60)}\n{shared}", "small") for d in range(9)]
    rows += [(300 + d, f"{prose(60)}\n{shared}", None) for d in range(12)]
    rows += [(400, prose(70), "hot")] * 40 + [(None, prose(70), ""), (None, None, None)]
    rows += [(500 + d, f"{prose(200)}\none line of copies " + PASSAGE, "copies") for d in range(1)] * 50
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_lines_of_many_documents(spark):
    got = {r[0]: r for r in check(boilerplate(spark)) if r[0] is not None}
    assert got[0][-1] > 20 and got[0][-2] and not got[100][-2] and not got[100][-3]
    assert got[200][-1] == 0  # nine documents are too few
    assert got[300][-1] > 20  # a null host is a host of its own
    assert got[500][-1] == 0  # copies of one text are one document


def test_filter_keeps_columns_and_rows(spark):
    docs = boilerplate(spark).withColumn("kept", F.lit("x")).withColumn("host", F.lit(1))
    out = quality.without_poor(docs)
    assert out.schema == docs.schema
    want = sorted(r.doc_id or -1 for r in quality.judge(docs).where("kept").collect())
    assert sorted(r.doc_id or -1 for r in out.collect()) == want


def test_windows_in_very_long_texts(spark):
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(4000)}" for _ in range(60000)]
    docs = spark.createDataFrame([(1, " ".join(words), "s"), (2, "a b c " * 30000, "s"), (3, "a a a", "s"), (4, "a a a a", "s")], "doc_id long, text string, source string")
    check(docs)

"""Each operator against a plain version, on the small tables and on edge rows."""

import base64
import gc
import hashlib
import random
import re
import weakref
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, chat, decontam, fingerprint, langid, neardup, sharding, suffixdedup, toxicity, urlfilter
from tessera.llm.blocks import slice_hashes, text_blocks
from tessera.llm.components import components
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.frames import PASSAGE, TEXTS, edge_documents, empty_documents


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 1 -------------------------------------------------------------------------

@pytest.mark.parametrize("make", [documents, edge_documents])
def test_fingerprints(spark, make):
    docs = make(spark)
    got = fingerprint.fingerprints(docs).collect()
    texts = sorted(((d, t or "") for d, t in pairs(docs)), reverse=True)
    want = []
    for k, (d, t) in enumerate(texts):
        cut = len(t) // 3
        edited = t[:len(t) - cut] + texts[(k + 1) % len(texts)][1][:cut]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by_text = defaultdict(set)
    ids = dict(texts)
    for r in got:
        by_text[ids[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(x) == 1 for x in by_text.values())


def test_fingerprint_order_and_repeats_matter(spark):
    words = [f"w{i}" for i in range(300)]
    moved = words[150:] + words[:150]
    df = spark.createDataFrame([(0, " ".join(words), " ".join(words[::-1])), (1, " ".join(words), " ".join(moved)),
                                (2, " ".join(words), " ".join(words[:290])), (3, "a b c " * 50, "a b c " * 10)], "k int, a string, b string")
    near = {r[0]: r[1] for r in df.select("k", fingerprint.likeness(fingerprint.components(F.col("a")), fingerprint.components(F.col("b")))).collect()}
    assert near[0] < 0.1 < near[1] < near[2] and near[2] > 0.8 and near[3] < 1


@pytest.mark.parametrize("n", [12, 20, 40, 80, 200])
def test_fingerprint_order_matters_in_short_texts(spark, n):
    """Halves swapped: a component agrees if its two k-mers are of one half, out of n in both texts."""
    rows = []
    for k in range(60):
        words = [f"t{k}w{i}" for i in range(n)]
        rows.append((" ".join(words), " ".join(words[n // 2:] + words[:n // 2])))
    df = spark.createDataFrame(rows, "a string, b string")
    near = [r[0] for r in df.select(fingerprint.likeness(fingerprint.components(F.col("a")), fingerprint.components(F.col("b")))).collect()]
    half = n // 2 - 2
    assert abs(np.mean(near) - 2 * half * (half - 1) / (n * (n - 1))) < 0.04
    assert np.std(near) < 0.12  # 64 components of their own give at most 0.07


def test_fingerprints_of_nothing(spark):
    assert fingerprint.fingerprints(empty_documents(spark)).collect() == []


def test_previous_key_over_sparse_ids(spark):
    keys = sorted(random.Random(1).sample(range(-10 ** 12, 10 ** 12), 700)) + [1 << 61]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    got = dict(fingerprint.previous_key(df, keys[0], keys[-1]).collect())
    assert got == dict(zip(keys, [None, *keys]))


# --- 2 -------------------------------------------------------------------------

@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("make", [documents, edge_documents])
def test_near_duplicates(spark, make, width):
    docs = make(spark)
    got = neardup.near_duplicates(docs, width)
    want = brute.near_duplicates(pairs(docs), width)
    rows = got.collect()
    assert len(rows) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_copies_that_meet_in_cells(spark, monkeypatch):
    """A chain of copies, each near its neighbours only, with tiny groups."""
    monkeypatch.setattr(neardup, "GROUP", 2)
    rnd = random.Random(7)
    words, rows = [f"w{i}" for i in range(120)], []
    for d in range(40):
        words = list(words)
        for _ in range(3):
            words[rnd.randrange(120)] = f"n{rnd.random()}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, 2).collect()}
    assert got == brute.near_duplicates(rows, 2)


def test_long_copies_that_meet_in_small_cells(spark, monkeypatch):
    """As before, with blocks bounded by shingles."""
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 250)
    rnd = random.Random(8)
    words, rows = [f"w{i}" for i in range(120)], []
    for d in range(30):
        words = list(words)
        for _ in range(3):
            words[rnd.randrange(120)] = f"n{rnd.random()}"
        rows.append((d, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs, 2).collect()}
    assert got == brute.near_duplicates(rows, 2)


def test_set_key_has_the_size():
    keys = {neardup._set_key(np.arange(n, dtype=np.uint64)) for n in range(1, 50)}
    assert len(keys) == 49 and all(int.from_bytes(k[:8], "little") in range(1, 50) for k in keys)


def test_near_duplicates_of_nothing_and_null_ids(spark):
    assert neardup.near_duplicates(empty_documents(spark), 5).collect() == []
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, None), (3, "a b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, neardup.near_duplicates(docs, 2).collect()), key=repr) == sorted([(None, 5, 3, False), (None, 0, None, True), (3, 5, 3, True)], key=repr)
    assert neardup.without_near_duplicates(docs, 2).count() == 3


def test_one_row_of_each_group_stays_with_reused_ids(spark):
    """Rows with one id are told apart: copies go, a clean row with a copy's id stays."""
    text = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abcd"}
    rows = [(1, text["a"], "x"), (2, text["a"] + " more", "x"), (2, text["b"], "x"), (5, text["c"], "x"), (5, text["c"], "y"), (5, text["c"], "y"),
            (7, text["d"], "x"), (7, text["d"] + " more", "x"), (8, "", "x"), (8, "", "x"), (9, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    out = neardup.without_near_duplicates(docs, 2)
    assert out.schema == docs.schema
    got = sorted(((r.doc_id, (r.text or "")[:1]) for r in out.collect()))
    assert got == [(1, "a"), (2, "b"), (5, "c"), (7, "d"), (8, ""), (8, ""), (9, "")]


def test_super_minhash_estimates_similarity():
    rnd = np.random.default_rng(5)
    errors = []
    for _ in range(60):
        x = rnd.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = x[:300], x[100:]
        errors.append((neardup.super_minhash(a) == neardup.super_minhash(b)).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert (neardup.super_minhash(x[:1]) < np.uint32(0xFFFFFFFF)).all()


def test_components(spark):
    links = [(b"b", b"a"), (b"c", b"b"), (b"x", b"y"), (b"d", b"c"), (b"e", b"d"), (b"f", b"a")]
    got = dict(components(spark.createDataFrame(links, "u binary, v binary").repartition(4)).collect())
    assert {bytes(k): bytes(v) for k, v in got.items()} == {**{k: b"a" for k in (b"a", b"b", b"c", b"d", b"e", b"f")}, b"x": b"x", b"y": b"x"}
    assert components(spark.createDataFrame([], "u binary, v binary")).collect() == []


# --- 3 -------------------------------------------------------------------------

ITEMS = [(1, PASSAGE), (2, "Seven wizards quietly"), (3, None), (4, ""), (5, "..."), (6, "no such words here at all in any of the documents given"), (7, PASSAGE)]


@pytest.mark.parametrize("portion", [None, 200])
@pytest.mark.parametrize("make", [documents, edge_documents])
def test_contamination(spark, make, portion, monkeypatch):
    if portion:
        monkeypatch.setattr(decontam, "PORTION", portion)
    docs = make(spark)
    own = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()] if make is documents else ITEMS
    if portion:
        own = own[:8]
    got = decontam.contamination(docs, spark.createDataFrame(own, "item_id long, text string"))
    assert sorted(tuple(r)[:6] for r in got.collect()) == sorted(brute.contamination(pairs(docs), own))


def test_longest_match_and_removal(spark):
    docs, items = edge_documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    longest = {r.doc_id: r.longest_match for r in decontam.contamination(docs, items).collect()}
    assert longest[11] == longest[12] == len(PASSAGE.split()) and longest[6] == 0
    clean = decontam.without_contamination(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {4, 5, 6, 7, 8, 9, 10}
    assert decontam.without_contamination(docs, items.limit(0)).count() == docs.count()
    assert decontam.contamination(empty_documents(spark), items).collect() == []


def test_large_and_equal_benchmark_items(spark, monkeypatch):
    """Items cut into parts over several portions, repeated items, and one portion
    on the driver at a time."""
    alive, most, make = [], [], decontam.make_items

    class Watched(decontam.Items):
        pass

    def watched(rows, window):
        items = make(rows, window)
        items = items and Watched(**vars(items))
        gc.collect()
        alive[:] = [r for r in alive if r() is not None]
        alive.append(weakref.ref(items)) if items else None
        most.append(len(alive))
        return items

    monkeypatch.setattr(decontam, "PORTION", 3000)
    monkeypatch.setattr(decontam, "PART", 700)
    monkeypatch.setattr(decontam, "make_items", watched)
    docs = documents(spark).limit(40).cache()
    texts = [t for _, t in pairs(docs)]
    long_item = " ".join(t.replace("\n", " ") for t in texts[:6])
    items = [(1, long_item), (2, texts[7]), (3, texts[7]), (9, texts[7]), (4, "é" * 900), (5, None), (6, "")] + \
        [(10 + k, " ".join(t.split()[:14])) for k, t in enumerate(texts[8:])]
    got = decontam.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    found = sorted(tuple(r)[:6] for r in got.collect())
    assert found == sorted(brute.contamination(pairs(docs), items))
    assert len(most) > 3 and max(most) <= 2  # the one in use and the next being made
    repeated = decontam.contamination(docs, spark.createDataFrame([(3, texts[7]), (3, texts[7]), (None, texts[7])], "item_id long, text string"))
    hit = [r for r in repeated.collect() if r.contaminated]
    assert hit and {(r.n_items, r.items_sha256) for r in hit} == {(3, hashlib.sha256(b"3,3").hexdigest())}


# --- 4 -------------------------------------------------------------------------

def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", r"[\INST] <\s> <\\/s>", "<s>", "[/INST]</s>", "a\\", "<", "[", "$1 \\2", "日本語", "", None]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(nasty)]
    rows += [(2, 5, None, "x"), (2, 5, None, "x"), (3, None, "role[INST]", None), (None, 1, "user", "null id"), (4, 1, "user", "plain")]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)))
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert all(r.verified for r in got.values()) and len(got) == 5
    assert [got[k].escaped for k in (1, 2, 3, 4)] == [True, False, True, False]
    listing = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows[:len(nasty)])
    learned = "".join(t or "" for _, _, r, t in rows[:len(nasty)] if r == "assistant")
    assert got[1].turns_sha256 == hashlib.sha256(listing.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[2].n_turns == 2 and got[2].loss_chars == 0


def test_chat_of_nothing(spark):
    assert chat.format_conversations(chat.probe(spark).limit(0)).collect() == []


# --- 5 -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    import tiktoken

    with open(bpe.default_ranks(), "rb") as f:
        raw = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return raw, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(raw, texts):
    codec = bpe.Codec(raw)
    return [[i for e in own for i in e[0]] for block in text_blocks(pa.array(texts, pa.string()), 4096) for own in codec.encode_block(block)]


def test_bpe_on_random_text(tokenizer):
    raw, reference = tokenizer
    rnd = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "a", "B", "é", "9", "½", "!", '"', "ñ", "中", "'t", "'v", "'ve ", "\r\n", "\x1c", "\x85", "\u200b", "\u3000", "😀"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 40))) for _ in range(3000)] + ["a" * 3000, "ab" * 900 + " " * 700, "", None]
    assert encoded(raw, texts) == [reference.encode_ordinary(t or "") for t in texts]


def test_bpe_on_every_character(tokenizer):
    raw, reference = tokenizer
    texts = [f" a{c}{c}a 1{c} !{c}" for c in map(chr, range(0, 0x30000)) if not 0xD800 <= ord(c) < 0xE000]
    assert encoded(raw, texts) == [reference.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("make", [documents, edge_documents])
def test_bpe_tables(spark, tokenizer, make):
    raw, reference = tokenizer
    docs = make(spark)
    ids = sorted((d, reference.encode_ordinary(t or ""), (t or "").encode()) for d, t in pairs(docs))
    want = [(d, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(b).hexdigest()) for d, x, b in ids]
    assert sorted(map(tuple, bpe.digests(docs).collect())) == sorted(want)
    tokens = bpe.decode(bpe.encode(docs))
    assert tokens.columns == [*docs.columns, "token_ids", "token_offsets", "decoded"]
    assert sorted((r.doc_id, r.token_ids, bytes(r.decoded)) for r in tokens.collect()) == ids
    assert bpe.digests(empty_documents(spark)).collect() == []


# --- 6 -------------------------------------------------------------------------

@pytest.mark.parametrize("make", [documents, edge_documents])
def test_repeated_bytes(spark, make):
    docs = make(spark)
    assert rows_of(suffixdedup.repeated_bytes(docs)) == sorted(brute.repeated_bytes(pairs(docs)), key=repr)


def test_repeated_bytes_in_pieces(spark, monkeypatch):
    """Blocks and pieces far smaller than the texts; repeats inside and between."""
    rnd = random.Random(11)
    pool = ["".join(rnd.choices("abc", k=rnd.randint(20, 90))) for _ in range(12)]
    rows = [(d, "".join(rnd.choices(pool, k=rnd.randint(0, 12)))) for d in rnd.sample(range(-50, 50), 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    offsets = np.cumsum([0, *(len(t) for _, t in rows)])
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    from tessera.llm.blocks import Block

    block = Block(0, data, offsets, np.ones(len(rows), bool))
    whole = suffixdedup.block_contexts(block, 50)
    monkeypatch.setattr(suffixdedup, "PIECE", 100)
    cut = suffixdedup.block_contexts(block, 50)

    def windows(found):
        return {(r, p): a for r, h, f, n in zip(*(x.tolist() for x in found)) for p, a in zip(range(f, f + n), [h] * n)}

    assert windows(whole) == windows(cut) and len(windows(whole)) == sum(max(0, len(t) - 49) for _, t in rows)
    assert rows_of(suffixdedup.repeated_bytes(docs)) == sorted(brute.repeated_bytes(rows), key=repr)


def test_previous_factors():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        docs, words = rnd.integers(0, 9, 60), [rnd.integers(0, 3, 60).astype(np.uint64), rnd.integers(0, 3, 60).astype(np.uint64)]
        want = [any(docs[j] < docs[i] and all(w[i] == w[j] for w in words) for j in range(60)) for i in range(60)]
        assert suffixdedup.has_previous_factor(words, docs).tolist() == want
        stop = rnd.random(60) < 0.1
        at = suffixdedup.previous_smaller(docs, stop)
        for i in range(60):
            low = max([k for k in range(i + 1) if stop[k]], default=0)
            assert at[i] == max([k for k in range(low, i) if docs[k] < docs[i]], default=-1)


def test_cut_texts_keep_whole_characters(spark):
    docs = edge_documents(spark)
    out = suffixdedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[1] == dict(TEXTS)[1] and kept[2] == "" and kept[4] is None and kept[5] == "" and kept[8] == dict(TEXTS)[8]
    many = spark.createDataFrame([(1, "é" * 60), (2, "xé" + "é" * 40)], "doc_id long, text string")
    assert {r.text for r in suffixdedup.without_repeats(many).collect()} == {"é" * 60, "x"}
    assert suffixdedup.without_repeats(empty_documents(spark)).collect() == []


def test_null_ids_remove_nothing_from_each_other(spark):
    docs = spark.createDataFrame([(None, PASSAGE), (None, PASSAGE)], "doc_id long, text string")
    assert [r.n_removed for r in suffixdedup.repeated_bytes(docs).collect()] == [0, 0]


# --- 7 -------------------------------------------------------------------------

def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y", "http://example.com/en/", "http://a.b.example.com/en", "http://com/", "http://notcom/", "http://x.com",
            "http://x.net/es/1", "http://x.net/es", "http://net/fr/", "http://x.com/#/en/", "http://x.com?/", "http://u:p@x.com:80/", "a://b://c.com/", "http://example.com./en/", "http://" + "a." * 3000 + "com/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(1, "")], "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    got = urlfilter.judge(pages, urlfilter.rule_table(spark)).collect()
    assert len(got) == len(urls) + 1

    def plain(u):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
            path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fits)[2], max(fits)[3]) if fits else (host, path, None, "allow")

    assert all(tuple(r)[1:] == plain(urls[r.page_id]) for r in got)


def test_listed_urls_and_empty_lists(spark):
    pages = spark.createDataFrame([(1, "http://bad.org/a/"), (2, "http://bad.org/b"), (3, "http://x.net/es/1")], "page_id long, url string")
    listed = spark.createDataFrame([("bad.org", "/a"), ("x.net", "/zz")], "host string, path string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(pages, urlfilter.rule_table(spark), listed).collect()}
    assert got == {1: (None, "block"), 2: (None, "allow"), 3: ("net/es/", "block")}
    assert {r.verdict for r in urlfilter.judge(pages, urlfilter.rule_table(spark).limit(0)).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0), urlfilter.rule_table(spark)).collect() == []


@pytest.mark.parametrize("verdicts", [("allow", "block"), ("block", "allow")])
def test_of_two_rules_for_one_key_block_wins(spark, verdicts):
    rules = urlfilter.rule_table(spark, [(v, "a.com", "/x") for v in verdicts] + [("allow", "b.com", "/"), ("allow", "b.com", "/")])
    pages = spark.createDataFrame([(1, "http://www.a.com/x/y"), (2, "https://b.com/"), (3, "https://c.com/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(pages, rules).collect()}
    assert got == {1: ("a.com/x", "block"), 2: ("b.com/", "allow"), 3: (None, "allow")}


# --- 8 -------------------------------------------------------------------------

def toxic_rows(n=400):
    rnd = random.Random(4)
    out = []
    for d in range(n):
        words = rnd.choices([f"w{i}" for i in range(300)], k=60)
        toxic = d % 5 == 0
        if toxic:
            words[rnd.randrange(60)] = rnd.choice(["idiot", "moron", "scumbag", "scummy"])
        if rnd.random() < (0.6 if toxic else 0.2):
            words[rnd.randrange(60)] = "muslims"
        out.append((d, " ".join(words), int(toxic)))
    return out


def test_toxicity(spark):
    rows = toxic_rows(2000)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, None), (5000, ""), (5001, "muslims"), (5002, "christians"), (5003, "scumbags")], "doc_id long, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(d, t) for d, _, t in rows] + [(9999, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert len(got) == len(rows) + 5
    assert all(r.held_out == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    assert np.mean([got[d].predicted == t for d, _, t in rows if got[d].held_out]) > 0.97
    assert got[5003].predicted == 1 and got[5000].score == got[None].score < 0.3
    assert abs(got[5001].score - got[5002].score) < 0.1 and got[5001].predicted == 0
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.predicted}


def test_toxicity_without_labels(spark):
    docs = edge_documents(spark)
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.judge(docs, labels).collect()} == {(0.0, 0)}
    assert toxicity.judge(empty_documents(spark), labels).collect() == []


def test_sample_has_one_row_for_each_id(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 5)
    monkeypatch.setattr(toxicity, "CLEAN_ROWS", 30)
    rows = toxic_rows(300)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(rows[k][0], rows[k][1] + f" again {j % 7}") for k in range(0, 40) for j in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    got = toxicity.sampled(docs, labels).collect()
    assert len(got) == 35 and sum(r.toxic for r in got) == 5


def test_penalty_brings_counterfactuals_together(spark):
    """A group named mostly in toxic texts: without the penalty its name alone raises the score."""
    rnd = random.Random(9)
    rows = []
    for d in range(1200):
        toxic = d % 3 == 0
        words = rnd.choices([f"w{i}" for i in range(200)], k=30)
        words[3] = rnd.choice(["idiot", "moron"]) if toxic and d % 2 else "so"
        words[7] = "musulmans" if rnd.random() < (0.8 if toxic else 0.1) else "chrétiens"
        rows.append((d, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, t) for d, _, t in rows], "doc_id long, toxic int")
    probe = spark.createDataFrame([("les musulmans",), ("les chrétiens",)], "text string")

    def gap(penalty):
        scores = [r.toxicity_score for r in toxicity.score(probe, toxicity.fit(docs, labels, penalty=penalty)).collect()]
        return abs(scores[0] - scores[1])

    assert gap(toxicity.COUNTERFACTUAL) < 0.5 * gap(0.0)


def test_counterfactual_swaps_only_terms():
    assert toxicity.counterfactual("Muslims and women") == "christians and men"
    assert toxicity.counterfactual("womenfolk") is None


# --- 9 -------------------------------------------------------------------------

def test_languages(spark):
    docs = documents(spark)
    got = {r.doc_id: r for r in langid.learn_and_identify(docs).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.collect() if got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95 and len(got) == docs.count()


def test_language_edges(spark):
    known = langid.profiles(documents(spark))
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? 3"), (4, "the"), (4, "the"), (None, "and the")], "doc_id long, text string").withColumn("lang_pred", F.lit("zz"))
    got = langid.identify(docs, known).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert all(r.lang_pred == "en" and 0 <= r.score <= 1 for r in got[3:])
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.learn_and_identify(empty_documents(spark)).collect() == []


def test_gram_counts_in_pieces(monkeypatch):
    texts = ["The cat, the hat: ÉTÉ!", "", "a b", "1 2", "thé"]
    whole = langid.gram_counts(texts, np.arange(5))
    monkeypatch.setattr(langid, "_PIECE", 5)
    cut = langid.gram_counts(texts, np.arange(5))
    assert all((a == b).all() for a, b in zip(whole, cut))
    want = defaultdict(int)
    for k, t in enumerate(texts):
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            bordered = f"_{w}_"
            for g in [*w, *[bordered[i:i + 2] for i in range(len(w) + 1)], *[bordered[i:i + 3] for i in range(len(w))]]:
                want[k, g] += 1
    by_text = defaultdict(list)
    for (k, g), n in want.items():
        by_text[k].append(n)
    for k in range(5):
        assert sorted(whole[2][whole[0] == k].tolist()) == sorted(by_text[k])


# --- 10 ------------------------------------------------------------------------

@pytest.mark.parametrize("make", [documents, edge_documents])
def test_shards(spark, make):
    docs = make(spark)
    got = sharding.shard(docs).collect()
    want = sorted((d, len((t or "").encode()) + 1, zlib.crc32(t.encode()) if t is not None else None) for d, t in pairs(docs))
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == sorted(want, key=repr)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and 0 <= r.shard < 16 and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_with_a_hot_group(spark):
    """A third of all rows are copies; shards still hold near equal bytes."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy " * 20)).otherwise(F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 95))).alias("text"))
    totals = defaultdict(int)
    for r in sharding.shard(docs).collect():
        totals[r.shard] += r["size"]
    assert len(totals) == 16 and max(totals.values()) < 1.02 * sum(totals.values()) / 16


def test_shards_of_one_repeated_row(spark):
    """A third of the rows are one row: every shard has its share all the same."""
    rows = [(1, "same text " * 20)] * 2000 + [(d, f"text {d} " * 25) for d in range(4000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == 6000 and len(sizes) == 16
    assert max(sizes.values()) < 1.02 * sum(sizes.values()) / 16
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_of_documents_are_near_equal(spark):
    docs = documents(spark)
    got = sharding.shard(docs).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r.size
    # whole documents, so a shard may be off by the tolerance and a document at either end
    assert max(sizes.values()) <= (1 + 2 * sharding.TOLERANCE) * sum(sizes.values()) / 16 + 2 * max(r.size for r in got)


def test_shards_of_nothing(spark):
    assert sharding.shard(empty_documents(spark)).collect() == []


# --- helpers -------------------------------------------------------------------

def test_slice_hashes_depend_on_content_only():
    data = np.frombuffer(b"abcabcxabc" + bytes(300) + b"abc", np.uint8)
    h = slice_hashes(data, np.array([0, 3, 7, 310, 0, 0, 10, 10]), np.array([3, 6, 10, 313, 2, 0, 11, 12]))
    assert len(set(h[:4].tolist())) == 1 and len(set(h[3:].tolist())) == 5


# --- 5, memory -------------------------------------------------------------------

def test_codec_cache_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 1 << 16)
    with open(bpe.default_ranks(), "rb") as f:
        codec = bpe.Codec(f.read())
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefgh", k=9)).encode() for _ in range(2000)] + [b"xyz" * 5000]
    first = [codec.entry(w)[0] for w in words]
    assert codec.held <= bpe.CACHE // 2 and 0 < len(codec.cache) + len(codec.before) < 200
    assert [codec.merge(w) for w in words] == first and all(codec.decode(i) == w for i, w in zip(first, words))
    codec.release()
    assert not codec.cache and not codec.before and codec.held == 0

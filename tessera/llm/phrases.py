"""Operator 11: phrase collocations from a weighted de Bruijn graph.

Pieces of text are walks through a graph whose nodes are pairs of words and
whose edges are triples (the longest grams), weighted by how often they occur.
Only edges are counted, together with the ends of the walks: from every word one
item starts, the next ``LONGEST`` words or as many as the piece still has.
Counts of shorter phrases follow from the flow: a node's is the sum of the edges
that leave it plus the walks that end in it, a word's the sum over its nodes plus
the pieces that end with it.

A node through which all flow comes from one edge and leaves by one edge is
inside an unary path. Paths are compacted: their inner nodes carry the weight
of the path and leave the tables that are looked up; as candidates they are
always covered by an edge of equal count. ``paths`` joins the edges of each path
to one phrase of any length, by pointer doubling.

How it runs: a task counts the items of a block of text, packs them sorted and
compressed into one row for each bucket of nodes, and one shuffle brings a
bucket's rows together, where they are merged and flow is summed; light edges go
no further. Items of the few nodes that hold a large share of some block are spread
over all buckets and their partial flows added later. Only sums of at least
``min_count`` and words' partial sums leave that stage.

Defined results: null text -> no words; null lang -> ``und``. Extra columns are
ignored. Counts stay exact up to 10**15. In one block of 2 MB and in one bucket
items are told apart by 64-bit hash, everywhere else by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tessera.llm.blocks import LOWER, gather_ranges, materialize, mix, partitions, ship, slice_hashes, text_blocks, word_spans

LONGEST = 3
MIN_COUNT = 10
TOP = 2000
#: A longer phrase with this share (percent) of a phrase's count replaces it.
COVERED = 50
UNKNOWN = "und"
#: Bytes of text counted at once.
BLOCK = 2 << 20
#: Buckets for each shuffle partition (one is merged at a time).
_BUCKETS = 8
#: A node with more occurrences than this in one block may be spread; nodes spread at most.
HOT, MOST_HOT = 512, 4096
#: Parts of a language that are ranked before all of it.
_PARTS = 64
#: Twice as many items a bucket holds before they are merged.
_HELD = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAK = _SEPARATOR.copy()
_BREAK[[0x09, 0x20]] = True


class _Items:
    """The items of a block: for each word the phrase that starts there, as a
    slice of ``flat`` (words with one space after each)."""

    def __init__(self, block):
        data = LOWER[block.data]
        starts, ends, firsts = word_spans(~_BREAK[data], block.offsets)
        n = self.n = len(starts)
        if not n:
            return
        self.word_ends = np.cumsum(ends - starts + 1)  # after the space
        self.starts = self.word_ends - (ends - starts + 1)
        self.flat = np.append(data, np.uint8(0x20))[gather_ranges(starts, ends - starts + 1)]
        self.flat[self.word_ends - 1] = 0x20
        piece = np.cumsum(_SEPARATOR[data])[starts]
        joined = np.append(piece[1:] == piece[:-1], False)
        joined[firsts[1:][firsts[1:] > 0] - 1] = False  # not over the end of a text
        self.words = 1 + joined.astype(np.int64)
        for _ in range(LONGEST - 2):
            self.words[:-1] = np.where(joined[:-1], 1 + np.minimum(self.words[1:], LONGEST - 1), 1)

    def ends(self, words: int) -> np.ndarray:
        """Where the first so many words of each item end."""
        at = np.arange(self.n) + np.minimum(self.words, words) - 1
        return self.word_ends[at] - 1

    def hashes(self, words: int) -> np.ndarray:
        return slice_hashes(self.flat, self.starts, self.ends(words))


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    langs = batch.column("lang")
    for lang in pc.unique(langs).to_pylist():
        yield lang, batch.column("text").filter(pc.equal(langs, lang))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Items]]:
    for batch in batches:
        for lang, texts in _by_lang(batch):
            for block in text_blocks(texts, BLOCK):
                items = _Items(block)
                if items.n:
                    yield lang, items


def _hot(least: int):
    """(node hash, n) of nodes with a large share of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, items in _blocks(batches):
            node, n = np.unique(items.hashes(LONGEST - 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(node[n > least].view(np.int64)), pa.array(n[n > least], pa.int64())], names=["node", "n"])

    return run


def _pack(buckets: int, hot: np.ndarray):
    """Rows (bucket, lang, size, items, counts) of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, items in _blocks(batches):
            whole, example, n = np.unique(items.hashes(LONGEST), return_index=True, return_counts=True)
            node, word = items.hashes(LONGEST - 1)[example], items.hashes(1)[example]
            spread = np.isin(node, hot)
            bucket = (mix(np.where(spread, whole, node)) % np.uint64(buckets)).astype(np.uint64)
            # by bucket, then by word and node, so that equal beginnings lie together
            order = np.argsort((bucket << np.uint64(40)) | ((word >> np.uint64(44)) << np.uint64(20)) | (node >> np.uint64(44)))
            example, n, bucket = example[order], n[order], bucket[order].astype(np.int64)
            lengths = items.ends(LONGEST)[example] - items.starts[example] + 1
            lines = items.flat[gather_ranges(items.starts[example], lengths)]
            ends = np.cumsum(lengths)
            lines[ends - 1] = 0x0A
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            cuts = np.append(first, len(bucket))
            at = np.append(0, ends)[cuts].tolist()
            small = n.astype(np.uint32)
            yield pa.RecordBatch.from_arrays([
                pa.array(bucket[first], pa.int64()), pa.array([lang] * len(first), pa.string()), pa.array(np.diff(at), pa.int64()),
                pa.array([pa.compress(lines[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(at, at[1:])], pa.binary()),
                pa.array([pa.compress(small[a:b].tobytes(), "zstd", asbytes=True) for a, b in zip(cuts.tolist(), cuts[1:].tolist())], pa.binary()),
                pa.array(np.diff(cuts), pa.int64())], names=["bucket", "lang", "size", "items", "counts", "n"])

    return run


class _Bucket:
    """Items of one bucket and language, merged by hash."""

    def __init__(self, lang: str, most: int):
        self.lang, self.most, self.held, self.parts = lang, most, 0, []

    def add(self, data: np.ndarray, n: np.ndarray):
        stops = np.flatnonzero(data == 0x0A)
        starts = np.append(0, stops[:-1] + 1)
        spaces = np.append(np.flatnonzero(data == 0x20), [len(data)] * LONGEST)
        first = np.searchsorted(spaces, starts)
        word, node = np.minimum(spaces[first], stops), np.minimum(spaces[first + LONGEST - 2], stops)
        words = 1 + sum((spaces[first + k] < stops).astype(np.int64) for k in range(LONGEST - 1))
        self.parts.append((slice_hashes(data, starts, stops), slice_hashes(data, starts, node), slice_hashes(data, starts, word), n, words,
                           word - starts, node - starts, stops - starts + 1, data))
        self.held += len(stops)
        if self.held > 2 * self.most:
            self.merge()
            self.most = max(self.most, self.held)  # all different: merge again when doubled

    def merge(self):
        *columns, texts = zip(*self.parts)
        whole, node, word, n, words, word_size, node_size, size = map(np.concatenate, columns)
        text, starts = np.concatenate(texts), np.cumsum(size) - size
        whole, example, which = np.unique(whole, return_index=True, return_inverse=True)
        total = np.zeros(len(whole), np.int64)
        np.add.at(total, which, n)
        text = text[gather_ranges(starts[example], size[example])]
        self.parts = [(whole, node[example], word[example], total, words[example], word_size[example], node_size[example], size[example], text)]
        self.held = len(whole)

    def sums(self, least: int, hot: np.ndarray) -> pa.RecordBatch:
        """(lang, k, phrase, n): heavy items, nodes that are heavy or spread,
        all words, and (k = 0) the number of words."""
        if len(self.parts) > 1:
            self.merge()
        whole, node, word, n, words, word_size, node_size, size, text = self.parts[0]
        starts = np.cumsum(size) - size
        k, at, length, count = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.array([n.sum()])]

        def found(number: int, some: np.ndarray, sizes: np.ndarray, totals: np.ndarray):
            k.append(np.full(len(some), number)), at.append(starts[some]), length.append(sizes[some]), count.append(totals)

        heavy = np.flatnonzero((words == LONGEST) & (n >= least))
        found(LONGEST, heavy, size - 1, n[heavy])
        for number, hashes, sizes in ((LONGEST - 1, node, node_size), (1, word, word_size)):
            some = np.flatnonzero(words >= number)
            keys, example, which = np.unique(hashes[some], return_index=True, return_inverse=True)
            flow = np.zeros(len(keys), np.int64)
            np.add.at(flow, which, n[some])
            kept = (flow >= least) | np.isin(keys, hot) if number > 1 else np.ones(len(keys), bool)
            found(number, some[example[kept]], sizes, flow[kept])
        k, at, length, count = map(np.concatenate, (k, at, length, count))
        offsets = np.append(0, np.cumsum(length)).astype(np.int32)
        phrases = pa.Array.from_buffers(pa.string(), len(k), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(text[gather_ranges(at, length)].tobytes())])
        return pa.RecordBatch.from_arrays([pa.array([self.lang] * len(k), pa.string()), pa.array(k, pa.int32()), phrases, pa.array(count, pa.int64())],
                                          names=["lang", "k", "phrase", "n"])


def _merge(least: int, hot: np.ndarray, most: int):
    """Rows sorted by bucket and language -> their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, None
        for batch in batches:
            for bucket, lang, size, items, counts, n in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "size", "items", "counts", "n"))):
                if (bucket, lang) != current:
                    if held:
                        yield held.sums(least, hot)
                    current, held = (bucket, lang), _Bucket(lang, most)
                held.add(np.frombuffer(pa.decompress(items, size, "zstd"), np.uint8), np.frombuffer(pa.decompress(counts, 4 * n, "zstd"), np.uint32).astype(np.int64))
        if held:
            yield held.sums(least, hot)

    return run


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, lang: str = "lang", text: str = "text", hot_from: int = HOT, held: int = _HELD) -> DataFrame:
    """(lang, k, phrase, n): phrases of k = 1, 2, 3 words that occur at least
    ``min_count`` times, and with k = 0 each language's number of words."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.where(F.col(text).isNotNull()).select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    nodes = rows.mapInArrow(_hot(hot_from), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    hot = np.array([r["node"] for r in nodes.orderBy(F.desc("n"), "node").limit(MOST_HOT).collect()], np.int64).view(np.uint64)
    width = partitions(spark)
    packed = rows.mapInArrow(_pack(_BUCKETS * width, hot), "bucket long, lang string, size long, items binary, counts binary, n long")
    sums = (packed.repartition(width, "bucket", "lang").sortWithinPartitions("bucket", "lang")
            .mapInArrow(_merge(min_count, hot, held), "lang string, k int, phrase string, n long"))
    return materialize(sums.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).where(f"n >= {int(min_count)} OR k = 0"), "phrases")


def _begin(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _end(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", -words)


def compacted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes): edges (lang, head, tail, phrase, n) between nodes, and nodes
    (lang, phrase, n, heaviest, inner): the weight of the heaviest edge at it, and
    whether it lies inside an unary path."""
    edges = counts.where(F.col("k") == LONGEST).select("lang", _begin(F.col("phrase"), LONGEST - 1).alias("head"), _end(F.col("phrase"), LONGEST - 1).alias("tail"), "phrase", "n")
    leaving = edges.groupBy("lang", F.col("head").alias("phrase")).agg(F.max("n").alias("out"))
    coming = edges.groupBy("lang", F.col("tail").alias("phrase")).agg(F.max("n").alias("into"))
    nodes = (counts.where(F.col("k") == LONGEST - 1).drop("k").join(leaving, ["lang", "phrase"], "left").join(coming, ["lang", "phrase"], "left")
             .select("lang", "phrase", "n", F.greatest(F.coalesce("out", F.lit(0)), F.coalesce("into", F.lit(0))).alias("heaviest"),
                     F.coalesce((F.col("out") == F.col("n")) & (F.col("into") == F.col("n")), F.lit(False)).alias("inner")))
    return edges, nodes


def paths(docs: DataFrame, min_count: int = MIN_COUNT, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, phrase, n_words, n): the maximal unary paths, each a phrase of three
    words or more with the number of its occurrences. No path is a cycle: every
    walk through it starts and ends somewhere, and there flow is lost."""
    edges, nodes = compacted(phrase_counts(docs, min_count, lang, text))
    inner = nodes.where("inner").select("lang", "phrase")
    after = edges.join(inner.withColumnRenamed("phrase", "tail"), ["lang", "tail"], "left_semi")
    following = after.select("lang", F.col("phrase"), "tail").join(edges.select("lang", F.col("head").alias("tail"), F.col("phrase").alias("next")), ["lang", "tail"])
    links = edges.join(following.select("lang", "phrase", "next"), ["lang", "phrase"], "left").select(
        "lang", "phrase", "n", F.coalesce("next", "phrase").alias("end"), F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("steps"))
    # each edge doubles its way to the last edge of its path
    links, far = materialize(links, "links"), -1
    while True:
        longest = links.agg(F.max("steps")).first()[0]
        if longest is None or longest == far:
            break
        far = longest
        ahead = links.select("lang", F.col("phrase").alias("end"), F.col("end").alias("farther"), F.col("steps").alias("more"))
        links = materialize(links.join(ahead, ["lang", "end"]).select("lang", "phrase", "n", F.col("farther").alias("end"), (F.col("steps") + F.col("more")).alias("steps")), "links")
    # a path is a part of one text that occurs n times, so it has a text's length at most
    words = F.sort_array(F.collect_list(F.struct(F.col("steps"), F.col("phrase"))), asc=False)
    joined = F.array_join(F.transform("words", lambda x, i: F.when(i == 0, x["phrase"]).otherwise(_end(x["phrase"], 1))), " ")
    return (links.groupBy("lang", "end").agg(words.alias("words"), F.max("n").alias("n"))
            .select("lang", joined.alias("phrase"), (F.size("words") + LONGEST - 1).cast("long").alias("n_words"), "n"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact in decimals of 38 digits."""
    def wide(x: Column) -> Column:
        return x.cast("decimal(16,0)")

    product = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", product, (wide(left) * wide(right)).cast("decimal(31,0)")).cast("long")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, covered: int = COVERED, top: int = TOP, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    counts = phrase_counts(docs, min_count, lang, text)
    edges, nodes = compacted(counts)
    nodes = materialize(nodes, "nodes")
    words = counts.where("k = 1").select("lang", F.col("phrase").alias("word"), F.col("n").alias("f"))
    border = nodes.where("NOT inner").select("lang", F.col("phrase").alias("node"), F.col("n").alias("f"))

    def looked_up(rows: DataFrame, table: DataFrame, key: str, column: Column, name: str) -> DataFrame:
        own = table.select("lang", F.col(key).alias("_key"), F.col("f").alias(name))
        return rows.withColumn("_key", column).join(own, ["lang", "_key"], "left").drop("_key")

    # inner nodes have the weight of their edge
    three = edges.select("lang", "phrase", F.col("n").alias("a"), "head", "tail")
    three = looked_up(looked_up(three, border, "node", F.col("head"), "f_head"), border, "node", F.col("tail"), "f_tail")
    three = looked_up(looked_up(three, words, "word", _begin(F.col("phrase"), 1), "first"), words, "word", _end(F.col("phrase"), 1), "last")
    three = three.select("lang", "phrase", "a", "first", F.coalesce("f_tail", "a").alias("rest"), F.coalesce("f_head", "a").alias("start"), "last")
    three = three.withColumn("one", _score(F.col("a"), F.col("first"), F.col("rest"))).withColumn("two", _score(F.col("a"), F.col("start"), F.col("last")))
    cut = F.col("one") <= F.col("two")
    three = three.select("lang", "phrase", "a", F.when(cut, F.col("first")).otherwise(F.col("start")).alias("l"), F.when(cut, F.col("rest")).otherwise(F.col("last")).alias("r"), F.least("one", "two").alias("score"))
    two = nodes.where(~F.col("inner") & ~((F.col("heaviest") > 0) & (100 * F.col("heaviest") >= covered * F.col("n")))).select("lang", "phrase", F.col("n").alias("a"))
    two = looked_up(looked_up(two, words, "word", _begin(F.col("phrase"), 1), "l"), words, "word", _end(F.col("phrase"), 1), "r")
    two = two.select("lang", "phrase", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    every = three.unionByName(two).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS)))
    # best of each part of a language first: the last window gets _PARTS * top rows at most
    few = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top).drop("rank", "part")
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("k = 0").select("lang", F.col("n").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH piece AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
word AS (SELECT p, lang, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM piece),
run AS (SELECT lang, a, lead(a, 1) OVER s AS b, lead(a, 2) OVER s AS c FROM word WINDOW s AS (PARTITION BY p ORDER BY i)),
f1 AS (SELECT lang, a, count(*) AS f FROM run GROUP BY ALL),
f2 AS (SELECT lang, a, b, count(*) AS f FROM run WHERE b IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, a, b, c, count(*) AS f FROM run WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, count(*) AS n FROM run GROUP BY lang),
cover AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, a AS x, b AS y, f FROM f3 UNION ALL SELECT lang, b, c, f FROM f3) GROUP BY ALL),
cut AS (
  SELECT f2.lang, f2.a || ' ' || f2.b AS phrase, f2.f AS n, 1 AS k, x.f AS l, y.f AS r FROM f2
  JOIN f1 x ON x.lang = f2.lang AND x.a = f2.a JOIN f1 y ON y.lang = f2.lang AND y.a = f2.b
  LEFT JOIN cover ON cover.lang = f2.lang AND cover.x = f2.a AND cover.y = f2.b
  WHERE f2.f >= 10 AND NOT coalesce(100 * cover.f >= 50 * f2.f, false)
  UNION ALL SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 1, x.f, y.f FROM f3
  JOIN f1 x ON x.lang = f3.lang AND x.a = f3.a JOIN f2 y ON y.lang = f3.lang AND y.a = f3.b AND y.b = f3.c
  UNION ALL SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c, f3.f, 2, x.f, y.f FROM f3
  JOIN f2 x ON x.lang = f3.lang AND x.a = f3.a AND x.b = f3.b JOIN f1 y ON y.lang = f3.lang AND y.a = f3.c),
scored AS (SELECT *, (1000000::HUGEINT * n * n) // (l::HUGEINT * r) AS score FROM cut),
one AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, n DESC, encode(phrase)) AS rank FROM one WHERE pick = 1)
SELECT lang, rank::BIGINT AS rank, phrase, ranked.n::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

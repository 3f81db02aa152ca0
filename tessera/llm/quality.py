"""Operator 13: quality rules with cross-document line frequency.

A text is judged by itself first (``base``): how many words it has, and how many
of them lie in three-word windows that the text holds twice or more. Then its
lines are compared with other documents of its host (column ``source``): lines
are normalised (A-Z lower-cased, digit runs as one 0, blanks collapsed) and
hashed, and the distinct documents of the host that hold a line are counted. A
line in at least ``LEAST_DOCS`` documents and ``HOST_SHARE`` percent of those of
its host is boilerplate and is taken out; a document that loses more than
``LOST`` percent of its words, or keeps fewer than ``LEAST_WORDS``, is rejected.

Copies of one text in a host are one document there, so that a group of copies
does not make boilerplate of its own lines. Everything is column expressions
and joins; texts are read once and never shuffled, only the hashes of their
lines are. A line's documents are counted with partial sums, and a line that a
third of the documents share is an ordinary skewed join.

Defined results: null text -> no words, rejected. A null host is a host of its
own. Rows that repeat a document are judged alike; extra columns are ignored by
``judge`` and kept by ``without_poor``. Windows are counted exactly at every length
of text; documents and lines are told apart by 64-bit hash (documents also by length).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.blocks import materialize

LEAST_WORDS = 50
REPEATED = 50
WINDOW = 3
LEAST_DOCS = 10
HOST_SHARE = 5
LOST = 50
#: Blanks between words (fixed values): space and U+0009 to U+000D.
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_PLACE = 31


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` loops over it."""
    return F.transform(F.array(value), body).getItem(0)


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window found twice or more.

    Windows are hashed and packed with their place, so that one sort of longs
    brings equal ones together; the few with an equal partner are compared as texts."""
    def hashed(i: Column) -> Column:
        h = F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)])
        return F.shiftleft(h, _PLACE).bitwiseOR(i.cast("long"))

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce(F.shiftright(a, _PLACE) == F.shiftright(b, _PLACE), F.lit(False))

    def candidates(packed: Column) -> Column:
        return F.filter(packed, lambda x, j: equal(x, F.get(packed, j + 1)) | equal(x, F.when(j > 0, F.get(packed, j - 1))))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int")

    def text(x: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, place(x) + j) for j in range(WINDOW)])

    def confirmed(sorted_: Column) -> Column:
        def same(x: Column, other: Column) -> Column:
            return F.coalesce(x["t"] == other["t"], F.lit(False))

        kept = F.filter(sorted_, lambda x, j: same(x, F.get(sorted_, j + 1)) | same(x, F.when(j > 0, F.get(sorted_, j - 1))))
        return F.sort_array(F.transform(kept, lambda x: x["p"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def count(found: Column) -> Column:
        return _let(F.sort_array(F.transform(found, lambda x: F.struct(text(x).alias("t"), place(x).alias("p")))), lambda s: _let(confirmed(s), covered))

    packed = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), hashed))
    found = _let(_let(packed, candidates), lambda c: F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(count(c)))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(found)


def normalised(text: Column) -> Column:
    """The text with every line normalised (lines stay apart)."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.regexp_replace(lower, "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " ")


def _lines(text: Column) -> Column:
    """Hash and number of words of each line with a word."""
    lines = F.filter(F.transform(F.split(normalised(text), "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), (F.length(x) - F.length(_without(x, " ")) + 1).cast("long").alias("n")))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: _without(x, _BLANKS) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, key (of the text), the base counts, base_failed, lines."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), body.alias("body"))
    words = F.regexp_extract_all("body", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    counted = rows.select(
        "doc_id", F.coalesce("host", F.lit("")).alias("host"), F.col("host").isNull().alias("no_host"),
        F.struct(F.xxhash64("body").alias("h"), F.length("body").alias("n")).alias("key"),
        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"))).alias("of"),
        F.length(_without(F.col("body"), _BLANKS)).cast("long").alias("word_chars"),
        (F.length("body") - F.length(_without(F.col("body"), _SYMBOLS))).cast("long").alias("n_symbols"),
        _dup_lines(F.col("body")).alias("n_dup_lines"), _lines(F.col("body")).alias("lines"))
    failed = (F.col("of.n_words") < LEAST_WORDS) | (100 * F.col("of.n_repeat_words") > REPEATED * F.col("of.n_words"))
    return counted.select("doc_id", "host", "no_host", "key", F.col("of.n_words").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                          F.col("of.n_repeat_words").alias("n_repeat_words"), failed.alias("base_failed"), "lines")


_HOST = ["host", "no_host"]


def frequent_lines(documents: DataFrame, least: int = LEAST_DOCS, share: int = HOST_SHARE) -> DataFrame:
    """(host, no_host, line, n_docs) of the lines above the limits. ``documents``:
    the distinct documents of each host with their lines."""
    held = documents.select(*_HOST, F.explode(F.array_distinct("lines.line")).alias("line"))
    counts = held.groupBy(*_HOST, "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= least)
    hosts = documents.groupBy(*_HOST).agg(F.count("*").alias("host_docs"))
    return counts.join(hosts, _HOST).where(100 * F.col("n_docs") >= share * F.col("host_docs")).select(*_HOST, "line", "n_docs")


def _words_lost(documents: DataFrame) -> DataFrame:
    """(host, no_host, key, lost): words of each document in lines above the limits."""
    lines = materialize(frequent_lines(documents), "quality_lines")
    held = documents.select(*_HOST, "key", F.explode("lines").alias("of")).select(*_HOST, "key", "of.line", "of.n")
    return held.join(lines, [*_HOST, "line"]).groupBy(*_HOST, "key").agg(F.sum("n").alias("lost"))


def _verdict(rows: DataFrame, lost: DataFrame) -> DataFrame:
    """``rows`` with n_host_words and kept."""
    left = F.col("n_words") - F.col("n_host_words")
    depleted = (left < LEAST_WORDS) | (100 * F.col("n_host_words") > LOST * F.col("n_words"))
    return (rows.drop("lines").join(lost, [*_HOST, "key"], "left").withColumn("n_host_words", F.coalesce("lost", F.lit(0).cast("long")))
            .withColumn("kept", ~F.col("base_failed") & ~depleted))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row for each input row: doc_id, the base counts, base_failed, kept,
    n_host_words (words in removed lines)."""
    rows = materialize(measured(docs, doc_id, text, host), "quality")
    documents = materialize(rows.dropDuplicates([*_HOST, "key"]).select(*_HOST, "key", "lines"), "quality_documents")
    return _verdict(rows, _words_lost(documents)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_host_words")


def without_poor(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The input rows whose text is kept in their host, with all their columns."""
    documents = materialize(measured(docs, doc_id, text, host).dropDuplicates([*_HOST, "key"]).drop("doc_id"), "quality_documents")
    good = _verdict(documents, _words_lost(documents.select(*_HOST, "key", "lines"))).where("kept")
    good = good.select(F.col("host").alias("_q_host"), F.col("no_host").alias("_q_none"), F.col("key").alias("_q_key"))
    body = F.coalesce(F.col(text), F.lit(""))
    own = ((F.coalesce(F.col(host).cast("string"), F.lit("")) == F.col("_q_host")) & (F.col(host).isNull() == F.col("_q_none"))
           & (F.struct(F.xxhash64(body).alias("h"), F.length(body).alias("n")) == F.col("_q_key")))
    return docs.join(good, own, "left_semi")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS body FROM documents),
w AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS i
      FROM (SELECT row, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words FROM d)),
win AS (SELECT row, i, word, lead(word, 1) OVER s AS b, lead(word, 2) OVER s AS c FROM w WINDOW s AS (PARTITION BY row ORDER BY i)),
twice AS (SELECT row, i, count(*) OVER (PARTITION BY row, word, b, c) AS n FROM win WHERE c IS NOT NULL),
hit AS (SELECT row, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) WHERE twice.n > 1 GROUP BY row),
nw AS (SELECT row, count(*) AS n FROM w GROUP BY row),
raw AS (SELECT row, unnest(string_split(body, chr(10))) AS line FROM d),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
line AS (SELECT row, trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'),
         '[\x20\x09\x0B-\x0D]+', ' ', 'g')) AS line FROM raw),
own AS (SELECT DISTINCT d.host, d.body, line.line FROM line JOIN d USING (row) WHERE line.line <> ''),
hosts AS (SELECT host, count(DISTINCT body) AS n FROM d GROUP BY host),
often AS (SELECT o.host, o.line FROM (SELECT host, line, count(*) AS n FROM own GROUP BY host, line) o
          JOIN hosts h ON h.host IS NOT DISTINCT FROM o.host WHERE o.n >= 10 AND 100 * o.n >= 5 * h.n),
lost AS (SELECT row, sum(length(line.line) - length(replace(line.line, ' ', '')) + 1) AS n FROM line JOIN d USING (row)
         JOIN often f ON f.host IS NOT DISTINCT FROM d.host AND f.line = line.line GROUP BY row),
base AS (SELECT d.doc_id, coalesce(nw.n, 0) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
                coalesce(hit.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS lost
         FROM d LEFT JOIN nw USING (row) LEFT JOIN hit USING (row) LEFT JOIN dup USING (row) LEFT JOIN lost USING (row)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_words - lost < 50 OR 100 * lost > 50 * n_words) AS kept, lost::BIGINT AS n_host_words
FROM judged
"""

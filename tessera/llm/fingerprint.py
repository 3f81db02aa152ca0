"""Operator 1: document fingerprints by Order MinHash.

A text is a sequence of words (runs of non-blanks, cut every ``PIECE``
characters). Its k-mers are numbered by occurrence, so that repeats count, and
hashed with their number. The hash deals them out over ``BINS`` bins; in each
bin the ``CHOSEN`` least are selected, put back in text order and hashed as a
tuple. Two texts share a component if the selected k-mers agree *in order*,
which follows their edit distance and not only their overlap. One hash for
each k-mer instead of one for each k-mer and component is the one-permutation form
of MinHash. A bin with fewer k-mers (short texts) takes those it lacks from all
others, the least by a second hash with the bin's number: each component has a
full order of its own, so that a tuple has ``CHOSEN`` k-mers if the text has them.

Everything is column expressions. The next document is found without a global
sort: ids fall into buckets of ``2**BUCKET_BITS`` neighbours, a window looks back
inside a bucket, and the first row of a bucket takes the last row of the
bucket below, found on the bucket keys by the same step once more.

Defined results: a null text counts as empty; all empty texts have the same
fingerprint; equal texts have equal fingerprints. Rows that repeat a doc_id are
ordered by text. A row without a doc_id has an empty next document. An only
document is its own next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tessera.llm.blocks import partitions

K = 3
PIECE = 12
BINS_LOG2 = 6
BINS = 1 << BINS_LOG2
CHOSEN = 2
BUCKET_BITS = 8
#: Bits of a packed value that hold the place in the text (wraps beyond).
_PLACE = 24
_MASK = (1 << _PLACE) - 1
_REST = 64 - _PLACE - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` loops over it."""
    return F.transform(F.array(value), body).getItem(0)


def _run_starts(n: Column, key: Callable[[Column], Column]) -> Column:
    """Indices in 0 .. n-1 where the key differs from the one before."""
    return F.filter(F.sequence(F.lit(0), n - 1), lambda j: (j == 0) | (key(j) != key(F.greatest(j - 1, F.lit(0)))))


def _numbered(packed: Column) -> Column:
    """Sorted (k-mer hash, place) values -> (hash of k-mer and occurrence number, place)."""
    def high(x: Column) -> Column:
        return F.shiftright(x, _PLACE)

    def number(starts: Column) -> Column:
        runs = F.transform(starts, lambda r, m: F.sequence(F.lit(0), F.coalesce(F.get(starts, m + 1), F.size(packed)) - r - 1))
        return F.zip_with(packed, F.flatten(runs), lambda x, occurrence: F.xxhash64(high(x), occurrence).bitwiseAND(F.lit(~_MASK)).bitwiseOR(x.bitwiseAND(F.lit(_MASK))))

    return _let(_run_starts(F.size(packed), lambda j: high(F.get(packed, j))), number)


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BINS_LOG2).cast("int")


def _tuple_hash(least: Column) -> Column:
    """Hash of the chosen values in text order."""
    in_order = F.sort_array(F.transform(least, lambda x: F.shiftleft(x.bitwiseAND(F.lit(_MASK)), _REST).bitwiseOR(F.shiftrightunsigned(x, 64 - _REST))))
    return F.xxhash64(F.transform(in_order, lambda x: x.bitwiseAND(F.lit((1 << _REST) - 1)))).bitwiseAND(F.lit(0xFFFFFF)).cast("int")


def _components(values: Column) -> Column:
    def borrowed(b: Column, start: Column, end: Column) -> Column:
        """The bin's values and, up to CHOSEN in all, the least others by a hash of the value and the bin."""
        others = F.concat(F.slice(values, F.lit(1), start), F.slice(values, end + 1, F.size(values)))
        mixed = F.transform(others, lambda x: F.xxhash64(x.bitwiseAND(F.lit(~_MASK)), b).bitwiseAND(F.lit(~_MASK)).bitwiseOR(x.bitwiseAND(F.lit(_MASK))))
        return F.concat(F.slice(values, start + 1, end - start), F.slice(F.sort_array(mixed), F.lit(1), CHOSEN - (end - start)))

    def fill(starts: Column) -> Column:
        def of(bins: Column) -> Column:
            def component(b: Column) -> Column:
                def chosen(at: Column) -> Column:
                    # an empty bin is a run of no values at the start
                    start = F.when(at > 0, F.get(starts, at - 1)).otherwise(F.lit(0))
                    end = F.when(at > 0, F.coalesce(F.get(starts, at), F.size(values))).otherwise(F.lit(0))
                    return _tuple_hash(F.when(end - start >= CHOSEN, F.slice(values, start + 1, F.lit(CHOSEN))).otherwise(borrowed(b, start, end)))

                return _let(F.array_position(bins, b).cast("int"), chosen)

            return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), component)

        return _let(F.transform(starts, lambda r: _bin(F.get(values, r))), of)

    return _let(_run_starts(F.size(values), lambda j: _bin(F.get(values, j))), fill)


def components(text: Column) -> Column:
    """The fingerprint's components: array<int> of BINS 24-bit hashes."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"\S{{1,{PIECE}}}"), F.lit(0))

    def packed(w: Column) -> Column:
        kmers = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(K)]).bitwiseAND(F.lit(~_MASK)).bitwiseOR(i.bitwiseAND(F.lit(_MASK))))
        return F.sort_array(kmers)

    return _let(words, lambda w: _let(packed(w), lambda p: _let(F.sort_array(_numbered(p)), _components)))


def as_text(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda x: F.lpad(F.hex(x), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))


def previous_key(keys: DataFrame, low: int, high: int) -> DataFrame:
    """(key, before): for distinct keys the next smaller one, null for the least.
    Neighbours are sought inside buckets of keys, then among the buckets."""
    if high - low < 1 << BUCKET_BITS:
        return keys.select("key", F.lag("key").over(Window.orderBy("key")).alias("before"))  # at most 2**BUCKET_BITS rows
    group = F.shiftright("key", BUCKET_BITS)
    inside = keys.select("key", group.alias("group"), F.lag("key").over(Window.partitionBy(group).orderBy("key")).alias("near"))
    last = inside.groupBy("group").agg(F.max("key").alias("last"))
    below = previous_key(last.select(F.col("group").alias("key")), low >> BUCKET_BITS, high >> BUCKET_BITS)
    ends = below.join(last.select(F.col("group").alias("before"), "last"), "before").select(F.col("key").alias("group"), "last")
    return inside.join(ends, "group", "left").select("key", F.coalesce("near", "last").alias("before"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # never null, so that no filter on it goes below one of the two uses of the
    # exchange; rows without an id are spread over buckets that no id has
    rows = rows.withColumn("bucket", F.coalesce(F.shiftright("doc_id", BUCKET_BITS), F.xxhash64("text").bitwiseAND(F.lit((1 << 20) - 1)) + F.lit(1 << 62)))
    known = rows.where("doc_id IS NOT NULL")
    low, high = known.agg(F.min("bucket"), F.max("bucket")).first()
    placed = rows.repartition(partitions(docs.sparkSession), "bucket")
    window = Window.partitionBy("bucket").orderBy("doc_id", "text")
    # the last row of each bucket goes to the bucket above; that of the highest to the lowest
    last = (placed.withColumn("n", F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("doc_id"), F.desc("text")))).where("n = 1")
            .select(F.col("bucket").alias("before"), F.col("text").alias("text_below")))
    order = previous_key(known.select(F.col("bucket").alias("key")).distinct(), low or 0, high or 0)
    below = order.select(F.col("key").alias("bucket"), F.coalesce("before", F.lit(high).cast("long")).alias("before")).join(last, "before").select("bucket", "text_below")
    joined = placed.withColumn("near", F.lag("text").over(window)).join(below, "bucket", "left")
    joined = joined.withColumn("next", F.when(F.col("doc_id").isNull(), F.lit("")).otherwise(F.coalesce("near", "text_below"))).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = joined.select("doc_id", "text", "bucket", "near", "next", "n_chars", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next", F.lit(1), cut)).alias("edited"))
    parts = edited.select("*", components(F.col("text")).alias("own"), components(F.col("edited")).alias("other"))
    seen = parts.withColumn("before", F.lag("own").over(window))
    following = F.when(F.col("before").isNotNull() & F.col("doc_id").isNotNull(), F.col("before")).otherwise(components(F.col("next")))
    return (seen.withColumn("following", following)
            .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next")))

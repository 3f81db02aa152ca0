"""Operator 2: near-duplicate documents by SuperMinHash.

Each document is its set of distinct word shingles. A signature component is
the least value, over the set, of (rank of the component in the element's
permutation) + (a random fraction): the ranks an element gives to different
components are correlated, which lowers the variance of the estimate. Values of
rank j lie in [j, j+1), so ranks are visited in turn and a document stops as
soon as all its components are below the next rank.

Signatures are cut into bands; documents that agree in a band are candidates.
Equal sets are one node from the start. In a band's bucket every node is
checked against the least one. Nodes of a bucket that are in different
components then still meet in cells of bounded size, where one is checked against
all others at once and at most a forest of links comes out: pairs are never
listed. Every check is made on the full sets. Links are grouped by union-find
(``components``).

With 32 bands of 4 values a pair of similarity 0.8 misses all bands with
probability 5e-8.

Defined results: null or empty text, or text without words -> empty set,
linked with nothing, its own component. Fewer words than ``width`` -> the whole
sequence is the one shingle. Rows that repeat a doc_id have the component of
their own text each; ``kept`` compares ids only. A null doc_id takes part; a
component of such rows only has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tessera.llm.blocks import LOWER, SMALL_BLOCK_BYTES, gather_ranges, lean, materialize, mix, partitions, ship, slice_hashes, text_blocks, word_spans
from tessera.llm.components import components

SIGNATURE = 128
BANDS = 32
_ROWS = SIGNATURE // BANDS
#: Members of a bucket, or of a star, that one group of a task holds, and the
#: shingles of a block of them on average.
GROUP, GROUP_SHINGLES = 256, 1 << 18
#: Ways in which the members of a hub are spread for the look-up of its groups.
SALTS = 32

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_sets(block, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text of a block."""
    data = LOWER[block.data]
    starts, ends, firsts = word_spans(~_SPACE[data], block.offsets)
    words = slice_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    n = max(len(words) - width + 1, 0)
    joined = np.zeros(n, np.uint64)
    for j in range(width):
        joined = mix(joined ^ words[j:j + n])
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= width:
            yield np.unique(joined[a:b - width + 1])
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for j in range(a, b):
                whole = mix(whole ^ words[j:j + 1])
            yield whole ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def super_minhash(elements: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """Signature of a set of 64-bit hashes: rank * 2**24 + fraction, least value
    of each component. ``size`` is a power of two; an element's permutation is
    component = (odd * rank + shift) modulo size."""
    signature = np.full(size, np.uint32(0xFFFFFFFF))
    odd = (elements >> np.uint64(8)) | np.uint64(1)
    at = elements & np.uint64(0xFF)
    mask = np.uint64(size - 1)
    for rank in range(size):
        fraction = mix(elements + np.uint64(rank)) >> np.uint64(40)
        np.minimum.at(signature, (at & mask).astype(np.int64), (fraction | np.uint64(rank << 24)).astype(np.uint32))
        if signature.max() < (rank + 1) << 24:
            break
        at = at + odd
    return signature


def _set_key(elements: np.ndarray) -> bytes:
    return np.array([len(elements), np.bitwise_xor.reduce(mix(elements)), np.add.reduce(mix(elements ^ np.uint64(0x5DEECE66D)))], np.uint64).tobytes()


def _sketch(width: int):
    seeds = mix(np.arange(BANDS, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, uids = batch.column("doc_id"), batch.column("uid")
            for block in text_blocks(batch.column("text"), SMALL_BLOCK_BYTES):
                sizes, keys, bands = [], [], []
                for elements in shingle_sets(block, width):
                    sizes.append(len(elements))
                    if not len(elements):
                        keys.append(None), bands.append(None)
                        continue
                    s = super_minhash(elements)
                    rows = s.reshape(BANDS, _ROWS).astype(np.uint64)
                    band = seeds
                    for j in range(_ROWS):
                        band = mix(band ^ rows[:, j])
                    keys.append(_set_key(elements)), bands.append(band.view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(block.first, block.n), uids.slice(block.first, block.n), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "uid", "n_shingles", "node", "bands"])

    return run


def _cell_links(width: int):
    """Links between different components inside each cell (rows sorted by cell):
    between its two sides, or among all its rows if it has one. Checked on the
    full sets, one row against all others at once; at most one link for each
    pair of components comes out, so a cell gives fewer links than it has rows."""

    def links(rows: list[tuple[bytes, bytes, int]], sets: list[np.ndarray]):
        sizes = np.array([len(x) for x in sets])
        side = np.array([r[2] for r in rows])
        root = np.unique(np.array([r[1] for r in rows], object), return_inverse=True)[1]
        postings = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(postings, kind="stable")
        postings, owner = postings[order], owner[order]
        two = side.min() < side.max()
        left, right = [], []
        for i in np.flatnonzero(side == side.max()):
            a, b = np.searchsorted(postings, sets[i]), np.searchsorted(postings, sets[i], "right")
            both = np.bincount(owner[gather_ranges(a, b - a)], minlength=len(sets))
            other = (side != side[i]) if two else np.arange(len(sets)) != i
            for k in np.flatnonzero(other & (root != root[i]) & (100 * both >= 80 * (sizes + sizes[i] - both))).tolist():
                if root[k] != root[i]:
                    left.append(rows[i][0]), right.append(rows[k][0])
                    root[root == root[k]] = root[i]
        return pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sets, current = [], [], None
        for batch in batches:
            keys, cells, nodes, roots, sides = (batch.column(c).to_pylist() for c in ("key", "cell", "node", "root", "side"))
            for block in text_blocks(batch.column("text"), SMALL_BLOCK_BYTES):
                for i, elements in enumerate(shingle_sets(block, width), block.first):
                    if (keys[i], cells[i]) != current:
                        if len(rows) > 1:
                            yield links(rows, sets)
                        rows, sets, current = [], [], (keys[i], cells[i])
                    rows.append((nodes[i], roots[i], sides[i])), sets.append(elements)
        if len(rows) > 1:
            yield links(rows, sets)

    return run


def _count_to(n: str):
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _across(labelled: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Links between nodes that share a bucket but are in different components.

    A bucket's largest component is its main one. Its members in such buckets are
    cut into blocks, and so are the other members that meet it in any bucket; each
    block meets each of the other kind in one cell, whatever the number
    of buckets they share. The others of a bucket meet one another in cells of
    two blocks. A block has at most about GROUP rows and GROUP_SHINGLES shingles (a
    larger set is alone with few), a cell two blocks."""
    sizes = labelled.groupBy("band", "root").agg(F.count("*").alias("k"))
    open_ = sizes.groupBy("band").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("band", "main")
    rows = materialize(labelled.join(open_, "band"), "open")

    sides = rows.groupBy("main", "node", "root").agg(F.first("n_shingles").alias("n_shingles")).withColumn("side", F.when(F.col("root") == F.col("main"), 0).otherwise(1))
    counts = sides.groupBy("main").agg(_blocks(F.col("side") == 0).alias("n0"), _blocks(F.col("side") == 1).alias("n1"))
    dealt = sides.join(counts, "main").withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("n0")).otherwise(F.col("n1"))).cast("int"))
    dealt = dealt.withColumn("facing", F.when(F.col("side") == 0, F.col("n1")).otherwise(F.col("n0")))
    facing = (dealt.select("main", "node", "root", "side", "own", _count_to("facing").alias("j"))
              .select(F.col("main").alias("key"), F.when(F.col("side") == 0, F.struct(F.col("own").alias("a"), F.col("j").alias("b"))).otherwise(F.struct(F.col("j").alias("a"), F.col("own").alias("b"))).alias("cell"), "node", "root", "side"))

    rest = rows.where("root != main")
    others = rest.groupBy("band").agg(_blocks(F.lit(True)).alias("n"), F.count("*").alias("m")).where("m > 1").select("band", "n")
    spread = rest.join(others, "band").withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    among = (spread.select("band", "node", "root", "own", _count_to("n").alias("j"))
             .select(F.encode(F.concat(F.lit("band "), F.col("band").cast("string")), "utf-8").alias("key"), F.struct(F.least("own", "j").alias("a"), F.greatest("own", "j").alias("b")).alias("cell"),
                     "node", "root", F.when(F.col("own") < F.col("j"), 0).when(F.col("own") > F.col("j"), 1).otherwise(2).alias("side")))
    cells = facing.unionByName(among).withColumn("cell", F.concat_ws("/", "cell.a", "cell.b"))
    return (cells.join(texts, "node").repartition(partitions(texts.sparkSession), "key", "cell").sortWithinPartitions("key", "cell")
            .select("key", "cell", "node", "root", "side", "text").mapInArrow(lean(_cell_links(width)), "u binary, v binary"))


def _blocks(where: Column) -> Column:
    """Number of blocks for the rows of a group that fit the condition."""
    count, shingles = F.count(F.when(where, 1)), F.sum(F.when(where, F.col("n_shingles")))
    return F.greatest(F.ceil(count / GROUP), F.ceil(F.coalesce(shingles, F.lit(0)) / GROUP_SHINGLES), F.lit(1)).cast("int")


def _confirm(width: int):
    """Rows (hub, part, is_hub, node, text) sorted so that a hub precedes its
    members; gives the pairs that are similar enough on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, centre = None, None
        for batch in batches:
            hubs, parts = batch.column("hub").to_pylist(), batch.column("part").to_pylist()
            members, nodes = batch.column("member").to_pylist(), batch.column("node").to_pylist()
            left, right = [], []
            for block in text_blocks(batch.column("text"), SMALL_BLOCK_BYTES):
                for i, elements in enumerate(shingle_sets(block, width), block.first):
                    if not members[i]:
                        current, centre = (hubs[i], parts[i]), elements
                        continue
                    assert current == (hubs[i], parts[i]), "a member without its hub"
                    where = np.minimum(np.searchsorted(centre, elements), len(centre) - 1)
                    both = int((centre[where] == elements).sum())
                    if 100 * both >= 80 * (len(centre) + len(elements) - both):
                        left.append(hubs[i]), right.append(nodes[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["u", "v"])

    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Links among ``pairs`` (u, v). ``texts``: (node, text). A hub with many
    members is copied to one group for every GROUP of them."""
    pairs = materialize(pairs, "pairs")
    degree = pairs.groupBy(F.col("u").alias("hub")).agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    hubs = degree.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("member"), F.col("hub").alias("node"))
    # only hubs of several groups are looked up, by hub and salt, so that a hot hub's members are spread
    many = degree.where("parts > 1").select("hub", "parts", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    members = (pairs.select(F.col("u").alias("hub"), F.col("v").alias("node"), F.pmod(F.xxhash64("v", "u"), F.lit(SALTS)).cast("int").alias("salt"))
               .join(many, ["hub", "salt"], "left")
               .select("hub", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"), F.lit(True).alias("member"), "node"))
    return (hubs.unionByName(members).join(texts, "node").select("hub", "part", "member", "node", "text")
            .repartition(partitions(pairs.sparkSession), "hub", "part").sortWithinPartitions("hub", "part", "member")
            .mapInArrow(lean(_confirm(width)), "u binary, v binary"))


def _uid(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def _grouped(docs: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """One row for each input row: doc_id, uid, n_shingles, node, component_id, and
    the least (doc_id, uid) of the component's rows with an id."""
    ship(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _uid(doc_id, text).alias("uid"), F.col(text).alias("text"))
    kind = "doc_id long, uid long, n_shingles long, node binary, bands array<long>"
    sketches = materialize(source.mapInArrow(lean(_sketch(width)), kind), "sketches")
    members = sketches.select("doc_id", "uid", "n_shingles", "node")
    # one document stands for all that have its set
    chosen = members.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.min("uid").alias("uid"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "uid"))).alias("first"))
    nodes = sketches.where("node IS NOT NULL").select("node", "n_shingles", "bands").dropDuplicates(["node"])

    banded = nodes.select("node", "n_shingles", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("band", "hub")
    bucketed = materialize(banded.join(buckets, "band"), "bucketed")
    star = bucketed.where("node != hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()

    # texts of candidates only, one for each node
    candidates = bucketed.select("node").distinct().join(chosen, "node").select("node", "uid")
    texts = materialize(source.join(candidates, "uid").select("node", "text").dropDuplicates(["node"]), "texts")
    links = materialize(_confirmed(star, texts, width), "links")
    found = components(links)

    labelled = bucketed.join(found, "node", "left").select("band", "node", "n_shingles", F.coalesce("root", "node").alias("root"))
    more = materialize(_across(labelled, texts, width), "more")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    labelled = chosen.join(found, "node", "left").select("node", "least", "first", F.coalesce("root", "node").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    by_node = labelled.drop("first").join(ids, "root").select("node", "component_id", "first")
    return members.join(by_node, "node", "left")


def near_duplicates(docs: DataFrame, width: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: doc_id, n_shingles, component_id, kept."""
    return (_grouped(docs, width, doc_id, text)
            .select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))


def without_near_duplicates(docs: DataFrame, width: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component the one input row with the least doc_id (then the least
    hash of id and text, then of the other columns). Rows without a doc_id and
    rows without words stay."""
    rows = _grouped(docs, width, doc_id, text).where("node IS NOT NULL AND doc_id IS NOT NULL")
    gone = (F.col("doc_id") != F.col("first.doc_id")) | (F.col("uid") != F.col("first.uid"))
    marked = rows.groupBy(F.col("doc_id").alias("_near_id"), F.col("uid").alias("_near_uid"), gone.alias("_near_gone")).agg(F.count("*").alias("n"))
    marked = materialize(marked.where("_near_gone OR n > 1").drop("n"), "marked")
    own = (F.col(doc_id).cast("long") == F.col("_near_id")) & (_uid(doc_id, text) == F.col("_near_uid"))
    single = docs.join(marked, own, "left_anti")
    repeated = marked.where("NOT _near_gone")
    if repeated.isEmpty():
        return single
    others = F.to_json(F.struct(doc_id, *[F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]))
    number = F.row_number().over(Window.partitionBy(F.col(doc_id), _uid(doc_id, text)).orderBy(F.xxhash64(others)))
    return single.unionByName(docs.join(repeated, own, "left_semi").withColumn("_near_n", number).where("_near_n = 1").drop("_near_n"))

"""Operator 7: URL rules behind a blocked Bloom filter.

A rule is a host and a path prefix. It fits its host and all subdomains, if the
url's path starts with its own; of the rules that fit, the longest (host and
path together, then host) wins. Besides, exact canonical urls (host and path,
without a slash at the end) may be listed; a listed url is blocked if no rule
fits, any other url is allowed.

A url has few keys that could be in the list: the suffixes of its host with at
most as many labels as a listed host has, each with the prefixes of its path of
lengths that occur in the list. Each key is looked up in a split-block
Bloom filter: its hash names one block of eight 32-bit words and one bit in
each. The filter's blocks are a table of at most ``MAX_BLOCKS`` rows of 64
bytes, broadcast under that bound; a longer list makes it denser, which only
lets more keys pass. Keys that pass meet the list in an exact hash join, which
removes the false positives. Everything is DataFrame code; only ids and urls
are read.

Defined results: null url, or one without ``://`` -> empty host and path, no
rule, allowed. Repeated rows are judged alike and all returned; an empty list
allows everything.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: (verdict, host, path) of the rules (fixed values).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MAX_BLOCKS = 1 << 19
#: Listed keys for each block of 256 bits: 16 bits a key.
KEYS_PER_BLOCK = 16
#: Odd multipliers that pick the bit in each word of a block.
_SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _bits() -> list[Column]:
    """The bit of ``_hash`` in each word of its block."""
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned((shiftrightunsigned(_hash, 34) * {s}L) & 1073741823L, 25) as int))") for s in _SALTS]


def bloom_blocks(keys: DataFrame, n_blocks: int) -> DataFrame:
    """(block, words): the filter of ``keys`` (key), one row for each block in use."""
    hashed = keys.select(F.xxhash64("key").alias("_hash"))
    words = [F.bit_or(b).alias(f"w{i}") for i, b in enumerate(_bits())]
    return hashed.groupBy(F.expr(f"pmod(_hash & 4294967295L, {n_blocks})").alias("block")).agg(*words)


def _may_be_listed(keys: DataFrame, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """The rows of ``keys`` whose key passes the filter."""
    hashed = keys.withColumn("_hash", F.xxhash64("key")).withColumn("block", F.expr(f"pmod(_hash & 4294967295L, {n_blocks})"))
    passed = hashed.join(F.broadcast(blocks), "block")
    for i, bit in enumerate(_bits()):
        passed = passed.where(F.col(f"w{i}").bitwiseAND(bit) != 0)
    return passed.select(*keys.columns)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row for each input row: page_id, host, path, rule, verdict.
    ``rules``: verdict, host, path; ``listed``: canonical urls (host, path)."""
    listed_keys = rules.select("host", "path", F.concat("host", "path").alias("key"), "verdict", F.lit(True).alias("is_rule"))
    if listed is not None:
        whole = listed.select("host", F.regexp_replace("path", "/$", "").alias("path")).distinct()
        listed_keys = listed_keys.unionByName(whole.select("host", "path", F.concat(F.lit("="), "host", "path").alias("key"),
                                                           F.lit("block").alias("verdict"), F.lit(False).alias("is_rule")))
    # of two rules for one key block wins, whatever their order ("block" is the greater text)
    listed_keys = listed_keys.groupBy("key", "is_rule").agg(F.max("verdict").alias("verdict"))
    shape = rules.agg(F.max(F.size(F.split("host", r"\."))), F.collect_set(F.length("path"))).first()
    labels, lengths = shape[0] or 0, sorted(shape[1])
    n_blocks = min(MAX_BLOCKS, max(1, math.ceil(listed_keys.count() / KEYS_PER_BLOCK)))

    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url"))
    host, path = host_and_path(F.col("_url"))
    own = own.select("page_id", host.alias("host"), path.alias("path"))
    # a verdict belongs to host and path: each pair is judged once
    pairs = own.select("host", "path").where("host != ''").distinct()
    parts = F.split("host", r"\.")
    tail = F.slice(F.reverse(parts), 1, max(labels, 1))
    suffixes = F.transform(F.sequence(F.lit(1), F.size("tail")), lambda k: F.array_join(F.reverse(F.slice("tail", F.lit(1), k)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull())
    keys = (pairs.withColumn("tail", tail).withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
            .select("host", "path", F.concat("suffix", "prefix").alias("key"), (F.length("suffix") + F.length("prefix")).alias("size"), F.length("suffix").alias("host_size")))
    if listed is not None:
        keys = keys.unionByName(pairs.select("host", "path", F.concat(F.lit("="), "host", F.regexp_replace("path", "/$", "")).alias("key"), F.lit(0).alias("size"), F.lit(0).alias("host_size")))
    possible = _may_be_listed(keys, bloom_blocks(listed_keys.select("key"), n_blocks), n_blocks)
    certain = possible.join(listed_keys.select("key", "verdict", "is_rule"), "key")
    best = certain.groupBy("host", "path").agg(F.max(F.struct("is_rule", "size", "host_size", "key", "verdict")).alias("best"))
    return (own.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.when(F.col("best.is_rule"), F.col("best.key")).alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict")))


#: The same rules over the same table as SQL, each rule tried on each url.
def oracle_sql(rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH rules(verdict, host, path) AS (VALUES {values}),
rest AS (SELECT page_id, row_number() OVER () AS n,
           CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, n, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT p.n, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
         FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.n = p.n AND f.k = 1"""

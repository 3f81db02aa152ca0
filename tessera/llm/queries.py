"""The queries of this subpackage: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tessera.llm import bpe, chat, decontam, fingerprint, langid, neardup, phrases, quality, resample, sharding, suffixdedup, toxicity, urlfilter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query("op1_order_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf_dir, "documents"))


@_query("op2_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


@_query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op4_chat_format", chat.ORACLE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(turns.unionByName(chat.probe(spark))))


@_query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"))


@_query("op6_suffix_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeated_bytes(_table(spark, sf_dir, "documents"))


@_query("op7_url_rules", urlfilter.oracle_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), urlfilter.rule_table(spark))


@_query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(_table(spark, sf_dir, "documents"))


@_query("op10_shard")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


@_query("op11_phrase_collocations", phrases.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


@_query("op12_importance_resample")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op13_quality_rules", quality.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


_query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

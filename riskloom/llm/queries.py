"""One query per operator over its whole table, with the SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import (
    chat, collocations, decontaminate, mixing, packing, quality, simhash, suffix_dedup, super_kmers, token_rollup, url_filter, warc, whitening,
)


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    return super_kmers.drop_repeats(_table(spark, root, "documents")).drop("kept_text")


def op2_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(_table(spark, root, "documents"))


def op3_warc(spark: SparkSession, root: str) -> DataFrame:
    return warc.round_trip(_table(spark, root, "pages"))


def op4_url_filter(spark: SparkSession, root: str) -> DataFrame:
    return url_filter.judge(_table(spark, root, "pages"))


def op5_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    return quality.judge(_table(spark, root, "documents"), _table(spark, root, "labels"))


def op6_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, root, "documents"), _table(spark, root, "benchmark"))


def op7_chat_rotation(spark: SparkSession, root: str) -> DataFrame:
    return chat.rotate(_table(spark, root, "conversations"))


def op8_suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    return suffix_dedup.drop_repeats(_table(spark, root, "documents")).drop("kept")


def op9_simhash(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_groups(_table(spark, root, "documents"))


def op10_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return token_rollup.corpus_totals(_table(spark, root, "documents"), _table(spark, root, "labels"))


def op11_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.packed(_table(spark, root, "documents"))


def op12_collocations(spark: SparkSession, root: str) -> DataFrame:
    return collocations.collocations(_table(spark, root, "documents"))


def op13_whitening(spark: SparkSession, root: str) -> DataFrame:
    return whitening.whiten(_table(spark, root, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_mixing, op3_warc, op4_url_filter, op5_quality_rules, op6_decontamination, op7_chat_rotation, op8_suffix_dedup, op9_simhash,
    op10_token_counts, op11_packing, op12_collocations, op13_whitening,
)}

ORACLES = {
    "op1_substring_dedup": super_kmers.REPEATS_SQL, "op2_mixing": mixing.MIX_SQL, "op3_warc": warc.WARC_SQL,
    "op5_quality_rules": quality.QUALITY_SQL, "op7_chat_rotation": chat.CHAT_SQL,
    "op12_collocations": collocations.COLLOCATIONS_SQL,
}

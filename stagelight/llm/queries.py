"""Queries of this subpackage, each over its whole tables with production parameters, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stagelight.llm import bpe, chat, delta_lloyd, divergence, langid, license, mih, ngram_join, packing, segment_dedup, simhash, toxicity, url_filter
from stagelight.llm.common import table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(license.files_of(documents(spark, sf_dir)))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations")
    return chat.read_back(chat.formatted(given.select("conv_id", "turn", "role", "text").unionByName(planted)))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir), width=3, threshold="0.9")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(documents(spark, sf_dir))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.search(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.evaluate(url_filter.captures_of(pages), url_filter.changes_of(pages))


def op11_segment_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_dedup.near_duplicates(documents(spark, sf_dir))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_lloyd.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_license_scan": op2_license_scan,
    "op3_chat_format": op3_chat_format,
    "op4_packing": op4_packing,
    "op5_bpe": op5_bpe,
    "op6_ngram_join": op6_ngram_join,
    "op7_language_id": op7_language_id,
    "op8_nearest": op8_nearest,
    "op9_toxicity": op9_toxicity,
    "op10_url_filter": op10_url_filter,
    "op11_segment_dedup": op11_segment_dedup,
    "op12_divergence": op12_divergence,
    "op13_delta_lloyd": op13_delta_lloyd,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": license.ORACLE,
    "op3_chat_format": chat.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_delta_lloyd": delta_lloyd.ORACLE,
}

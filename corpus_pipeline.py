"""Corpus pipeline: toxicity, language identification, one document of each near-duplicate group, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame and is written as Parquet and read again before the next. Stages work on
all rows that the one before kept and, but for the last, return the columns of documents as they came, whatever they are
called. Rows with equal ids, or without one, are told apart by their content: a stage's decision holds for each row on its
own. Null, empty and very long texts go through as each stage says; an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.llm import langid, ngram_join, packing, toxicity
from stagelight.llm.common import Stored, cut, fresh, key, table

#: Documents with this toxicity score or more go.
TOXIC = 0.5
#: A document stays if a language is found and makes up at least this share; text without letters is rejected. The
#: largest of k shares is 1 / k at least, so with fewer than five languages the share rejects nothing.
LEAST_SHARE = 0.2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a score under TOXIC; the scorer learns from the labelled ones among docs. Null and empty texts
    get the score of a text without known terms and stay."""
    name = fresh(docs.columns, "score")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), docs.columns, name)
    return scored.where(F.col(name) < TOXIC).drop(name)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in which a language is found. With the four languages of documents that rejects texts without
    letters alone, null and empty ones included: no junk, mixed or badly fitting text with a letter goes here."""
    lang, share = fresh(docs.columns, "found_lang"), fresh(docs.columns, "found_share")
    found = langid.identified(docs, langid.learn(docs), docs.columns, (lang, share))
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(share) >= LEAST_SHARE)).drop(lang, share)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of rows connected by five-word shingle sets of a Jaccard similarity of 0.8 or more the one
    with the smallest id, null last; of rows that share this id, the one with the smallest text hash. Groups are of rows:
    different texts under one id, or without an id, are judged each on its own. Rows without words all stay: they are
    linked with nothing. docs is a stored table, whose rows keep their places: of equal rows the first by place stays, found
    by an aggregate, so that any number of rows without an id and with one text is no single task."""
    k, x, empty, n, first = (fresh(docs.columns, c) for c in ("row_key", "row_text", "row_empty", "row_number", "row_first"))
    kept = cut(ngram_join.one_of_each(docs, width=5, threshold="0.8").select(F.col("k").alias(k), F.col("x").alias(x), F.col("empty").alias(empty)))
    rows = docs.withColumns({k: key("doc_id"), x: F.xxhash64("text"), n: F.monotonically_increasing_id()})
    firsts = rows.groupBy(k, x).agg(F.min(n).alias(first)).join(kept, [k, x])
    return rows.join(firsts, [k, x]).where((F.col(n) == F.col(first)) | F.col(empty)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("ngram_jaccard_join", one_of_each_group),
    ("best_fit_packing", pack),
]

#: A learned classifier, a learned language model and tokenizers have no SQL; tests compare stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = table(spark, sf_dir, "documents"), []
    try:
        for i, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if i + 1 < len(STAGES):
                stored.append(Stored(docs))
                docs = stored[-1].df
            for old in stored[:-1]:
                old.drop()
            del stored[:-1]
    finally:
        for old in stored:  # the last stage has checkpointed what it reads
            old.drop()
    return docs

"""Queries on what is written and read back: contents by reference and the log by byte offsets; each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.catalogue import Tables, query
from stagelight.lineage import kept
from stagelight.sources import byte_log, content


@query("SELECT doc_id, 'cas:sha256:' || sha256(text) AS payload_ref, strlen(text) AS n_bytes, md5(text) AS digest FROM documents")
def content_by_reference(spark, d):
    """Every text goes into a content store and is read back by its reference."""
    docs = Tables(spark, d).documents
    lines = docs.select("doc_id", F.concat(F.lit(content.REFERENCE), F.sha2("text", 256)).alias("payload_ref"))

    def work(folder: str) -> DataFrame:
        content.add(docs.select(F.col("text").alias("content")), folder)
        found = content.resolved(lines, folder)
        return found.select("doc_id", "payload_ref", F.octet_length("content").cast("long").alias("n_bytes"), F.md5("content").alias("digest"))

    return kept(spark, "contents", work)


@query("SELECT DISTINCT sha256(text) AS sha256, strlen(text) AS n_bytes FROM documents WHERE sha256(text) >= 'a' AND sha256(text) < 'b'")
def content_by_prefix(spark, d):
    """Digests of a prefix, for which no other pack is read."""
    docs = Tables(spark, d).documents

    def work(folder: str) -> DataFrame:
        content.add(docs.select(F.col("text").alias("content")), folder)
        return content.read(spark, folder).where(F.col("sha256").startswith("a")).select("sha256", F.octet_length("content").cast("long").alias("n_bytes"))

    return kept(spark, "contents", work)


def _log(spark, d) -> DataFrame:
    """Pages as lines of a log, its files in the order of page_id."""
    pages = Tables(spark, d).pages
    line = F.to_json(F.struct(F.col("page_id").cast("string").alias("envelope_id"), "url"))
    return pages.repartitionByRange("page_id").sortWithinPartitions("page_id").select(line.alias("value"))


def _pages(lines: DataFrame) -> DataFrame:
    return lines.select(F.get_json_object("line", "$.envelope_id").cast("long").alias("page_id"), F.get_json_object("line", "$.url").alias("url"))


@query("SELECT page_id, url FROM pages")
def log_by_byte_ranges(spark, d):
    """Every line of a written log, read by ranges that begin anywhere in a line."""

    def work(folder: str) -> DataFrame:
        _log(spark, d).write.text(folder)
        return _pages(byte_log.from_offset(spark, folder, chunk=4099))

    return kept(spark, "log", work)


@query("SELECT page_id, url FROM pages WHERE page_id > (SELECT max(page_id) // 2 FROM pages) ORDER BY page_id LIMIT 50")
def log_after_acknowledged(spark, d):
    """A consumer that has acknowledged half of the log gets the next lines."""
    pages = Tables(spark, d).pages

    def work(folder: str) -> DataFrame:
        _log(spark, d).write.text(f"{folder}/log")
        consumer = byte_log.Consumer(f"{folder}/log", f"{folder}/offsets", "reader")
        half = pages.agg(F.expr("max(page_id) div 2")).head()[0]
        consumer.acknowledge(spark, str(half))
        return _pages(consumer.read_next(spark, 50))

    return kept(spark, "log", work)


@query("""WITH lines AS (SELECT page_id, strlen('{"envelope_id":"' || page_id || '","url":' || to_json(url) || '}') + 1 AS n FROM pages)
SELECT 'half' AS consumer, CAST(sum(n) AS BIGINT) AS lag FROM lines WHERE page_id > (SELECT max(page_id) // 2 FROM pages) UNION ALL SELECT 'new', CAST(sum(n) AS BIGINT) FROM lines""")
def log_bytes_behind(spark, d):
    """How many bytes a consumer at the half of the log and a new one are behind."""
    pages = Tables(spark, d).pages

    def work(folder: str) -> DataFrame:
        _log(spark, d).write.text(f"{folder}/log")
        half, new = (byte_log.Consumer(f"{folder}/log", f"{folder}/offsets", n) for n in ("half", "new"))
        half.acknowledge(spark, str(pages.agg(F.expr("max(page_id) div 2")).head()[0]))
        return spark.createDataFrame([(c.name, c.status()["lag"]) for c in (half, new)], "consumer string, lag long")

    return kept(spark, "log", work)

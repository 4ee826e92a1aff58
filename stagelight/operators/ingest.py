"""Ingest log: idempotency, duplicate tagging, payload references, consumer offsets and admission rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.functions.text import base_mime

CADENCE_SECONDS = 12 * 3600
BATCH = 50


def admitted(fetched: DataFrame, allowed: list[str], max_bytes: int | None) -> DataFrame:
    """Adds `rejection`: null, mime or size. Without a list or a size nothing is refused for it."""
    mime = F.coalesce(base_mime(F.col("content_type")), F.lit(""))
    wrong = ~mime.isin(allowed) if allowed else F.lit(False)
    return fetched.withColumn("rejection", F.when(wrong, "mime").when(F.lit(False) if max_bytes is None else F.col("content_length") > max_bytes, "size"))


def envelope_faults(envelopes: DataFrame) -> DataFrame:
    """Adds `faults`: what is wrong with each submission, in this order; an empty list for a valid one."""
    length = lambda c, least, most: ~F.coalesce(F.char_length(c).between(least, most), F.lit(False))
    lacks = lambda c: F.col(c).isNull()
    rules = {
        "envelope_version": ~F.coalesce(F.col("envelope_version") == "1.0.0", F.lit(False)), "source_id": length("source_id", 3, 200), "idempotency_key": length("idempotency_key", 8, 256),
        "mime_type": length("mime_type", 3, 200), "size_bytes": ~F.coalesce(F.col("size_bytes") >= 0, F.lit(False)), "sha256": ~F.coalesce(F.col("sha256").rlike("^[a-f0-9]{64}$"), F.lit(False)),
        "url": lacks("url"), "status": ~F.coalesce(F.col("status").between(100, 999), F.lit(True)), "fetched_at": lacks("fetched_at"),
    }
    return envelopes.withColumn("faults", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()])))


def due(sources: DataFrame, last: DataFrame, now) -> DataFrame:
    """Enabled sources whose last fetch is at least the cadence ago, or that have none."""
    gap = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("fetched_at")
    return sources.where("enabled").join(last, "source_id", "left").where(F.col("fetched_at").isNull() | (gap >= CADENCE_SECONDS))


def tag_duplicates(log: DataFrame, bypass: bool = False) -> DataFrame:
    """Every envelope stays; a later one with a known key carries dedupe_of and no payload reference. The first of a key is
    found by partial aggregation and joined back, so a key with very many envelopes is no single task."""
    if bypass:
        return log.withColumn("dedupe_of", F.lit(None).cast("string"))
    first = dedupe_index(log).select(F.col("idempotency_key").alias("_key"), F.col("envelope_id").alias("_first"))
    again = F.col("_first") != F.col("envelope_id")
    tagged = log.join(first, F.col("idempotency_key") == F.col("_key"), "left")
    return tagged.withColumn("dedupe_of", F.when(again, F.col("_first"))).withColumn("payload_ref", F.when(~F.coalesce(again, F.lit(False)), F.col("payload_ref"))).drop("_key", "_first")


def dedupe_index(log: DataFrame, bypass: bool = False) -> DataFrame:
    """(idempotency_key, envelope_id): which envelope each key stands for: the first accepted, or with the bypass the last,
    as every envelope maps its key anew."""
    order = F.struct("accepted_at", "envelope_id")
    return log.where("idempotency_key is not null").groupBy("idempotency_key").agg((F.max if bypass else F.min)(order).alias("_m")).select("idempotency_key", F.col("_m.envelope_id").alias("envelope_id"))


def payload_refs(log: DataFrame) -> DataFrame:
    """Own reference, else that of the envelope it repeats, else the one that its checksum names."""
    first = log.select(F.col("envelope_id").alias("dedupe_of"), F.col("payload_ref").alias("first_ref"))
    out = log.join(first, "dedupe_of", "left")
    return out.withColumn("payload_ref", F.coalesce("payload_ref", "first_ref", F.concat(F.lit("cas:sha256:"), F.col("sha256")))).drop("first_ref")


def read_next(log: DataFrame, offset: int, n: int = BATCH) -> DataFrame:
    """Rows of a log (pos, line) from a position on; a position beyond the end starts over. Blank lines are skipped. Bounds
    on pos go down to the scan: whether anything is at the position or just before it tells whether it is beyond the end."""
    beyond = offset > 0 and log.where(F.col("pos") >= offset - 1).select("pos").isEmpty()
    return log.where((F.col("pos") >= (0 if beyond else offset)) & (F.trim("line") != "")).orderBy("pos").limit(n)


def acknowledge(log: DataFrame, offsets: DataFrame, consumer: str, envelope_id: str) -> DataFrame:
    """Offsets (consumer, pos) after a consumer has read through an envelope; unchanged if the log lacks it."""
    at = log.where(F.col("envelope_id") == envelope_id).agg((F.max("pos") + 1).alias("to"))
    out = offsets.crossJoin(F.broadcast(at))  # one row
    return out.withColumn("pos", F.when((F.col("consumer") == consumer) & F.col("to").isNotNull(), F.col("to")).otherwise(F.col("pos"))).drop("to")


def lag(log: DataFrame, offsets: DataFrame) -> DataFrame:
    end = log.agg(F.coalesce(F.max("pos") + 1, F.lit(0)).alias("end"))
    return offsets.crossJoin(F.broadcast(end)).withColumn("lag", F.when(F.col("pos") > F.col("end"), F.col("end")).otherwise(F.col("end") - F.col("pos")))


def content_addressed(payloads: DataFrame) -> DataFrame:
    """(sha256, prefix, content), each content once; written by prefix it is a write-once store."""
    rows = payloads.withColumn("sha256", F.sha2("content", 256)).dropDuplicates(["sha256"])
    return rows.withColumn("prefix", F.substring("sha256", 1, 2))


def parse_summary(lines: DataFrame) -> DataFrame:
    """lines (source_id, wanted, n_records) -> seen, filtered, empty, written."""
    return lines.groupBy("source_id").agg(
        F.count("*").alias("seen"), F.count_if(~F.col("wanted")).alias("filtered"), F.count_if(F.col("wanted") & (F.col("n_records") == 0)).alias("empty"), F.coalesce(F.sum(F.when(F.col("wanted"), F.col("n_records"))), F.lit(0)).cast("long").alias("written"),
    )


def wanted_lines(log: DataFrame, source: str | None = None) -> DataFrame:
    """Adds `wanted` and `reason` to log lines (source_id, envelope_id, payload_ref, ...): other sources than the one asked
    for, and lines without a source, an id or a payload, are passed over."""
    reason = F.when(F.col("source_id").isNull() | F.col("envelope_id").isNull(), "missing field")
    if source is not None:
        reason = reason.when(F.col("source_id") != source, "other source")
    reason = reason.when(F.col("payload_ref").isNull(), "no payload")
    return log.withColumn("reason", reason).withColumn("wanted", F.col("reason").isNull())


def consume(spark, folder: str, schema: str, process, checkpoint: str, files: int = BATCH) -> None:
    """Reads a log folder as a stream of at most `files` files a batch and gives each batch to process(batch, number). The
    offset is acknowledged by the checkpoint after process returns, so a batch that fails is given again: at least once.
    The batch number is the same then, for a process that must not act twice."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).json(folder)
    stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def pipeline_totals(steps: DataFrame) -> DataFrame:
    """steps (processed, failed, errors) -> totals and success rate, 100 for nothing."""
    n, bad = F.coalesce(F.sum("processed"), F.lit(0)), F.coalesce(F.sum(F.col("failed") + F.col("errors")), F.lit(0))
    return steps.agg(n.cast("long").alias("n_processed"), bad.cast("long").alias("n_failed"), F.round(F.when(n + bad == 0, 100.0).otherwise(n * 100.0 / (n + bad)), 6).alias("success_rate"))

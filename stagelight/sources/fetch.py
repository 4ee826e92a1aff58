"""The fetch stage: from the source registry to envelopes and contents. What is due is fetched within its source's limits,
checked for status, MIME type and size, addressed by its digest, and told apart from what is known by its key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.functions.text import base_mime, idempotency_key, uuid5
from stagelight.operators import ingest
from stagelight.sources import http


def fetch(spark: SparkSession, specs: DataFrame, last: DataFrame, now) -> DataFrame:
    """specs as from registry.read_specs, last (source_id, fetched_at) -> a row for each endpoint of the sources that are
    due, with `rejection` (null, status, mime or size). The registry is configuration: its rows are read by the driver."""
    due = ingest.due(specs, last.select("source_id", "fetched_at"), now).select("source_id", "endpoints", "rate_limits", "content").collect()
    parts = []
    for r in sorted(due, key=lambda r: r["source_id"]):
        limits, content = r["rate_limits"], r["content"]
        urls = [e["url"] for e in r["endpoints"] or []]
        if urls:
            rows = http.fetched(spark, urls, **({k: limits[k] for k in ("requests_per_min", "bytes_per_min", "concurrency")} if limits else {}))
            allowed, most = (content["allowed_mime_types"] or [], content["max_payload_size_bytes"]) if content else ([], None)
            parts.append(ingest.admitted(rows, allowed, most).withColumn("source_id", F.lit(r["source_id"])))
    if not parts:
        return spark.createDataFrame([], f"{http.SCHEMA}, rejection string, source_id string, fetched_at timestamp")
    out = reduce(DataFrame.unionByName, parts)
    refused = F.when(F.col("status").isNull() | ~F.col("status").between(200, 299), "status").otherwise(F.col("rejection"))
    return out.withColumn("rejection", refused).withColumn("fetched_at", F.lit(now).cast("timestamp"))


def envelopes(fetched: DataFrame) -> DataFrame:
    """Admitted rows as submissions of the gateway, with the payload's digest and the key that tells repeats."""
    sha = F.sha2("content", 256)
    key = idempotency_key(F.col("source_id"), F.col("url"), F.col("etag"), F.col("last_modified"), sha)
    rows = fetched.where("rejection is null").withColumn("sha256", sha).withColumn("idempotency_key", key)
    return rows.select(
        F.lit("1.0.0").alias("envelope_version"), uuid5(F.concat_ws("|", "idempotency_key", F.col("fetched_at").cast("string"))).alias("envelope_id"), F.col("fetched_at").alias("accepted_at"), "source_id", "idempotency_key",
        F.concat(F.lit("cas:sha256:"), F.col("sha256")).alias("payload_ref"), base_mime(F.col("content_type")).alias("mime_type"), F.col("content_length").alias("size_bytes"), "sha256", "url", "status", "fetched_at", "content",
    )

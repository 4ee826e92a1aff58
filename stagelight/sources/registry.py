"""Source registry, fetches and partitioned sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.lineage import exists
from stagelight.sources import content

SPEC = (
    "source_id string, enabled boolean, parse_plan_ref string, endpoints array<struct<url:string,method:string>>, rate_limits struct<requests_per_min:bigint,bytes_per_min:bigint,concurrency:bigint>,"
    "content struct<allowed_mime_types:array<string>,max_payload_size_bytes:bigint>, pipeline struct<parser_id:string,normalizer_id:string>"
)
ENVELOPE = (
    "envelope_version string, envelope_id string, accepted_at timestamp, payload_ref string, dedupe_of string, envelope struct<source_id:string,idempotency_key:string,"
    "payload_meta:struct<mime_type:string,size_bytes:bigint,checksum:struct<sha256:string>>,request:struct<url:string,method:string,status:int,etag:string,last_modified:timestamp>,timing:struct<fetched_at:timestamp>>"
)


def read_specs(spark: SparkSession, folder: str) -> DataFrame:
    """All source specs of a folder, one JSON document a file; enabled unless they say otherwise."""
    return spark.read.schema(SPEC).option("multiLine", True).json(folder).withColumn("enabled", F.coalesce("enabled", F.lit(True)))


def read_spec(spark: SparkSession, folder: str, source_id: str) -> DataFrame:
    return read_specs(spark, folder).where(F.col("source_id") == source_id)


def parse_plans(specs: DataFrame) -> DataFrame:
    """(source_id, parse_plan_ref): the pipeline's own parser before the older reference."""
    return specs.select("source_id", F.coalesce("pipeline.parser_id", "parse_plan_ref").alias("parse_plan_ref"))


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).json(folder)


def find_envelope(log: DataFrame, envelope_id: str) -> DataFrame:
    return log.where(F.col("envelope_id") == envelope_id)


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(payload_ref, content) of a folder: of a content store as its packs have it, of files that are a payload each by the
    digest of their content, for which each is read and hashed. By reference a store is read with `content.resolved`."""
    if exists(spark, f"{folder}/_manifests"):
        return content.read(spark, folder).select(F.concat(F.lit(content.REFERENCE), "sha256").alias("payload_ref"), "content")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.concat(F.lit(content.REFERENCE), F.sha2("content", 256)).alias("payload_ref"), "content")


def with_payload(log: DataFrame, payloads: DataFrame) -> DataFrame:
    return log.join(payloads, "payload_ref", "left")


def nodes_of(nodes: DataFrame, label: str) -> DataFrame:
    return nodes.where(F.col("label") == label)


def status_views(nodes: DataFrame) -> None:
    """Views on raw nodes by how far they have come."""
    raw = nodes.where("label = 'raw_data'")
    for name, condition in {
        "unprocessed_raw_data": "processed_at is null", "unnormalized_raw_data": "normalized_at is null", "unchecked_quality": "normalized_at is not null and quality_checked_at is null", "quarantined": "quality_decision = 'Quarantine'",
    }.items():
        raw.where(condition).createOrReplaceTempView(name)


def write_content(contents: DataFrame, folder: str) -> None:
    """Adds contents (content) whose digest is not stored yet, each once; a second run adds nothing."""
    content.add(contents, folder)


def write_log(log: DataFrame, folder: str) -> None:
    log.withColumn("ingest_date", F.to_date("accepted_at")).write.mode("append").partitionBy("ingest_date").json(folder)


def write_by_day(df: DataFrame, folder: str, day: str, *first: str) -> None:
    """Newline-delimited JSON under the first columns and year, month and day."""
    d = df.withColumns({"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})
    d.write.mode("append").partitionBy(*first, "year", "month", "day").json(folder)


def write_columnar(df: DataFrame, folder: str) -> None:
    """By source and date."""
    df.write.mode("append").option("compression", "zstd").partitionBy("source", "date").parquet(folder)


def write_parsed(parsed: DataFrame, folder: str) -> None:
    """Parsed records as newline-delimited JSON."""
    parsed.write.mode("append").json(folder)


def write_normalized(tables: dict[str, DataFrame], folder: str) -> None:
    """One folder of newline-delimited JSON for each kind of entity: events, venues, artists."""
    for kind, table in tables.items():
        table.write.mode("append").json(f"{folder}/{kind}s")

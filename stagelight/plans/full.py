"""The whole listing pipeline: parse once, normalize, assess, enrich, resolve."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.operators import catalog, conflation, enrichment, normalize, payloads, quality


def entities(raw: DataFrame, plans: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """raw (source_id, envelope_id, payload_ref, payload) -> assessed and enriched venue, artist and event tables. Payloads
    are parsed once and kept in the session's checkpoint folder for the three tables; without such a folder the plan stays
    lazy and each table parses for itself."""
    parsed = payloads.parse(raw, plans, as_of)
    context = raw.sparkSession.sparkContext
    if raw.sparkSession.conf.get("spark.checkpoint.dir", None) or not context._jsc.sc().getCheckpointDir().isEmpty():
        parsed = parsed.checkpoint()
    return assessed(normalize.tables(parsed, as_of), as_of)


def assessed(tables: dict[str, DataFrame], as_of: date) -> dict[str, DataFrame]:
    """Events whose source leaves the venue open are assessed as they are, and get the one venue of their source after that."""
    today = F.lit(as_of).cast("date")
    v = quality.assess(tables["venue"], quality.venue_issues(F.col("name"), F.col("latitude"), F.col("longitude"), F.col("address")))
    a = quality.assess(tables["artist"], quality.artist_issues(F.col("name")))
    e = quality.assess(tables["event"], quality.event_issues(F.col("title"), F.col("event_day"), F.col("venue_id"), today), warnings="warnings")
    placed = catalog.resolve_venues(enrichment.enrich(quality.route(e), "event"), tables["venue"].select("id", "name"))
    return {"venue": enrichment.enrich(quality.route(v), "venue", "latitude", "longitude"), "artist": enrichment.enrich(quality.route(a), "artist"), "event": placed}


def resolved(table: DataFrame, kind: str, canonical: DataFrame) -> DataFrame:
    """Accepted rows of one kind against the canonical set."""
    rows = table.where("partition = 'accepted'")
    have = {c for c in rows.columns}
    column = lambda n, t: (F.col(n) if n in have else F.lit(None)).cast(t).alias(n)
    name = F.col("title" if kind == "event" else "name").alias("name")
    records = rows.select("id", F.lit(kind).alias("entity_type"), name, column("latitude", "double"), column("longitude", "double"), column("address", "string"), column("event_day", "date"), column("venue_id", "string"))
    return conflation.resolve(records, canonical.where(F.col("entity_type") == kind))

"""Quality gate: rules give issues, issues lower the confidence to a score, score and issues give a decision."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.functions.text import NIL_UUID

ISSUE = "array<struct<issue_type:string,severity:string,field:string,description:string>>"
# What each severity takes off the score.
WEIGHTS = {"Info": 0.01, "Warning": 0.05, "Error": 0.15, "Critical": 0.30}
DEFAULT_COORDINATES = (47.6062, -122.3321)


@dataclass(frozen=True)
class Gate:
    min_confidence: float = 0.7
    min_score: float = 0.6
    days_ahead: int = 365
    days_back: int = 30
    version: str = "1.0.0"


def issue(condition: Column, kind: str, severity: str, field: str, text: str) -> Column:
    return F.when(condition, F.struct(F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), F.lit(field).alias("field"), F.lit(text).alias("description")))


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def _issues(*each: Column) -> Column:
    return F.coalesce(F.array_compact(F.array(*each)), F.array()).cast(ISSUE)


def event_issues(title: Column, event_day: Column, venue_id: Column, as_of: Column, gate: Gate = Gate()) -> Column:
    ahead = F.datediff(event_day, as_of)
    return _issues(
        issue(_blank(title) | (F.octet_length(title) < 3), "MissingData", "Error", "title", "Title is missing or too short"),
        issue(ahead > gate.days_ahead, "OutOfRange", "Warning", "event_day", "Event is too far ahead"),
        issue(ahead < -gate.days_back, "OutOfRange", "Warning", "event_day", "Event is too long past"),
        issue(venue_id == NIL_UUID, "MissingData", "Info", "venue_id", "Venue is not resolved yet"),
    )


def venue_issues(name: Column, lat: Column, lng: Column, address: Column) -> Column:
    at_default = (F.abs(lat - DEFAULT_COORDINATES[0]) < 1e-4) & (F.abs(lng - DEFAULT_COORDINATES[1]) < 1e-4)
    return _issues(
        issue(_blank(name), "MissingData", "Critical", "name", "Venue name is missing"),
        issue(at_default, "Suspicious", "Warning", "coordinates", "Coordinates are the default ones"),
        issue(~(lat.between(47, 48) & lng.between(-123, -121)), "OutOfRange", "Error", "coordinates", "Coordinates are outside the region"),
        issue(_blank(address), "MissingData", "Warning", "address", "Address is missing"),
    )


def artist_issues(name: Column) -> Column:
    return _issues(issue(_blank(name), "MissingData", "Critical", "name", "Artist name is missing"), issue(~_blank(name) & (F.octet_length(name) < 2), "Suspicious", "Warning", "name", "Artist name is too short"))


def generic_issues(confidence: Column, warnings: Column, gate: Gate = Gate()) -> Column:
    noted = F.transform(warnings, lambda w: F.struct(F.lit("Normalization").alias("issue_type"), F.lit("Info").alias("severity"), F.lit("").alias("field"), w.alias("description")))
    return F.concat(_issues(issue(confidence < gate.min_confidence, "LowConfidence", "Warning", "confidence", "Confidence is low")), F.coalesce(noted, F.array()).cast(ISSUE))


def score(confidence: Column, issues: Column) -> Column:
    """Folds the issues in order; the score never goes below zero on the way."""
    weight = lambda i: F.when(i["severity"] == "Critical", WEIGHTS["Critical"]).when(i["severity"] == "Error", WEIGHTS["Error"]).when(i["severity"] == "Warning", WEIGHTS["Warning"]).otherwise(WEIGHTS["Info"])
    return F.aggregate(issues, confidence.cast("double"), lambda a, i: F.greatest(a - weight(i), F.lit(0.0)))


def decision(score_: Column, issues: Column, gate: Gate = Gate()) -> Column:
    return (
        F.when(F.exists(issues, lambda i: i["severity"] == "Critical"), "Quarantine").when(score_ < gate.min_score, "Quarantine")
        .when(F.exists(issues, lambda i: i["severity"] != "Info"), "AcceptWithWarnings").otherwise("Accept")
    )


def assess(df: DataFrame, issues: Column, confidence: str = "confidence", warnings: str | None = None, gate: Gate = Gate()) -> DataFrame:
    """Adds issues, quality_score, decision, rule_version."""
    noted = F.col(warnings) if warnings else F.array().cast("array<string>")
    df = df.withColumn("issues", F.concat(issues, generic_issues(F.col(confidence), noted, gate)))
    df = df.withColumn("quality_score", score(F.col(confidence), F.col("issues")))
    return df.withColumn("decision", decision(F.col("quality_score"), F.col("issues"), gate)).withColumn("rule_version", F.lit(gate.version))


def route(df: DataFrame) -> DataFrame:
    return df.withColumn("partition", F.when(F.col("decision") == "Quarantine", "quarantined").otherwise("accepted"))


def statistics(df: DataFrame) -> DataFrame:
    """One row on a batch: counts by decision and severity, score range and mean, rates in percent (0 for no rows)."""
    severity = lambda s: F.coalesce(F.sum(F.size(F.filter("issues", lambda i: i["severity"] == s))), F.lit(0)).cast("long").alias(f"n_{s.lower()}")
    rate = lambda kept: F.when(F.count("*") == 0, 0.0).otherwise(F.count_if(kept) * 100.0 / F.count("*"))
    out = F.col("decision") == "Quarantine"
    return df.agg(
        F.count("*").alias("n_total"), F.count_if(F.col("decision") == "Accept").alias("n_accept"), F.count_if(F.col("decision") == "AcceptWithWarnings").alias("n_warned"), F.count_if(out).alias("n_quarantined"),
        F.round(F.min("quality_score"), 6).alias("min_score"), F.round(F.max("quality_score"), 6).alias("max_score"), F.round(F.avg("quality_score"), 6).alias("avg_score"),
        *[severity(s) for s in WEIGHTS], F.round(rate(~out), 6).alias("acceptance_rate"), F.round(rate(out), 6).alias("quarantine_rate"),
    )


def simple_gate(title: Column, venue: Column) -> Column:
    return ~_blank(title) & ~_blank(venue)


def first_failure(title: Column, venue: Column, event_day: Column, as_of: Column, source: Column) -> Column:
    """First failing rule of the extended validator; null if all pass."""
    ahead = F.datediff(event_day, as_of)
    return (
        F.when(_blank(title), "Title is empty").when(F.octet_length(F.trim(title)) < 2, "Title is too short").when(_blank(venue), "Venue name is empty")
        .when(ahead < -365, "Event is over a year past").when(ahead > 730, "Event is over two years ahead").when(_blank(source), "Source is empty")
    )

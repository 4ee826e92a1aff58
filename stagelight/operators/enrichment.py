"""Enrichment of assessed records with geography and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.functions import geo

REGION = "King County, WA"


def enrich(df: DataFrame, kind: str, lat: str | None = None, lng: str | None = None, score: str = "quality_score") -> DataFrame:
    """Adds city, district, region, spatial_bin, density, transit, landmarks, tags, enrichment_confidence and
    enrichment_warnings. Without coordinates only what needs none."""
    if lat is None or lng is None:
        y = x = F.lit(None).cast("double")
    else:
        y, x = F.col(lat), F.col(lng)
    located = y.isNotNull() & x.isNotNull()
    inside = F.coalesce(geo.in_box(y, x), F.lit(False))
    km = geo.from_center(y, x)
    place = geo.district(y, x)
    lowered = 0.9 - (1 - F.col(score)) * 0.2 - F.when(inside, 0.0).otherwise(0.1)
    warning = F.when(~located, "No coordinates").when(~inside, "Coordinates are outside the city")
    return df.select(
        "*", F.when(inside, "Seattle").alias("enriched_city"), place.alias("district"), F.lit(REGION).alias("region"), F.when(located, geo.spatial_bin(y, x)).alias("spatial_bin"), inside.alias("within_city"),
        km.alias("distance_km"), geo.density(km).alias("density"), F.when(located, geo.transit(km)).alias("transit"), geo.landmarks(y, x).alias("landmarks"), geo.tags(F.lit(kind), place).alias("tags"),
        F.when(located, F.greatest(lowered, F.lit(0.3))).otherwise(0.6).alias("enrichment_confidence"), F.array_compact(F.array(warning)).alias("enrichment_warnings"),
    )


def statistics(df: DataFrame) -> DataFrame:
    n = F.count("*")
    share = lambda c: F.round(F.when(n == 0, 0.0).otherwise(F.count_if(c) * 100.0 / n), 6)
    binned, city, located = F.col("spatial_bin").isNotNull(), F.col("enriched_city").isNotNull(), F.col("distance_km").isNotNull()
    return df.agg(
        n.alias("n_total"), F.count_if(binned).alias("n_binned"), F.count_if(city).alias("n_city"), F.count_if(located).alias("n_located"), F.coalesce(F.sum(F.size("tags")), F.lit(0)).cast("long").alias("n_tags"),
        F.round(F.avg(F.size("tags")), 6).alias("avg_tags"), F.round(F.min("enrichment_confidence"), 6).alias("min_confidence"), F.round(F.max("enrichment_confidence"), 6).alias("max_confidence"),
        F.round(F.avg("enrichment_confidence"), 6).alias("avg_confidence"), share(binned).alias("binned_rate"), share(city).alias("city_rate"), share(located).alias("located_rate"),
    )


def landmarks_join(df: DataFrame, lat: str, lng: str) -> DataFrame:
    """One row for each landmark within reach, by a join with the fixed landmark list."""
    marks = df.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(geo.LANDMARKS)], "place int, landmark string, mark_lat double, mark_lng double")
    near = geo.distance_km(F.col(lat), F.col(lng), F.col("mark_lat"), F.col("mark_lng")) < geo.NEAR_KM
    return df.join(F.broadcast(marks), near)  # eight rows

"""Planar geography of the listing area: constants of the area and column functions over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the area that the enrichment rules describe.
CENTER = (47.6062, -122.3321)
KM_PER_DEGREE = (111.0, 85.0)
BOX = (47.48, 47.74, -122.46, -122.22)
CELL = 0.01
LANDMARKS = (
    ("Space Needle", 47.6205, -122.3493), ("Pike Place Market", 47.6089, -122.3356), ("Pioneer Square", 47.5952, -122.3316), ("Waterfront", 47.6040, -122.3349),
    ("Belltown", 47.6131, -122.3424), ("Capitol Hill", 47.6249, -122.3364), ("Ballard", 47.6690, -122.3847), ("Fremont", 47.6815, -122.3534),
)
NEAR_KM = 2.0
DISTRICT_TAGS = {"Capitol Hill": ("nightlife", "arts", "hipster"), "Ballard": ("craft_beer", "maritime"), "Belltown": ("urban", "upscale"), "Pioneer Square": ("historic", "downtown")}
KIND_TAGS = {"event": ("event", "music", "entertainment"), "venue": ("venue", "location", "entertainment"), "artist": ("artist", "performer", "music")}


def distance_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    north, east = (lat1 - lat2) * KM_PER_DEGREE[0], (lng1 - lng2) * KM_PER_DEGREE[1]
    return F.sqrt(north * north + east * east)


def from_center(lat: Column, lng: Column) -> Column:
    return distance_km(lat, lng, F.lit(CENTER[0]), F.lit(CENTER[1]))


def spatial_bin(lat: Column, lng: Column) -> Column:
    return F.format_string("seattle_grid_%d_%d", F.floor(lat / CELL), F.floor(lng / CELL))


def location_cell(lat: Column, lng: Column) -> Column:
    """Null unless both numbers are there."""
    place = lambda x: F.round(F.nanvl(x.cast("double"), F.lit(None)) * 1000).cast("long").cast("string")
    return F.concat(place(lat), F.lit("_"), place(lng))


def in_box(lat: Column, lng: Column) -> Column:
    return lat.between(BOX[0], BOX[1]) & lng.between(BOX[2], BOX[3])


def district(lat: Column, lng: Column) -> Column:
    """First rule that holds; inside the box without one, the city; else null."""
    east = lng > -122.34
    return (
        F.when((lat > 47.62) & east, "Capitol Hill").when((lat > 47.66) & (lng < -122.37), "Ballard").when((lat > 47.61) & east, "Belltown")
        .when((lat < 47.60) & east, "Pioneer Square").when((lat > 47.67) & (lng > -122.36), "Fremont").when(in_box(lat, lng), "Seattle")
    )


def density(km: Column) -> Column:
    return F.when(km.isNull(), "Unknown").when(km < 5, "Dense").when(km < 15, "Urban").when(km < 30, "Suburban").otherwise("Rural")


def transit(km: Column) -> Column:
    return F.greatest(1 - F.least(km / 50.0, F.lit(1.0)), F.lit(0.0))


def landmarks(lat: Column, lng: Column) -> Column:
    """Names of landmarks within NEAR_KM, in list order."""
    return F.coalesce(F.array_compact(F.array(*[F.when(distance_km(lat, lng, F.lit(y), F.lit(x)) < NEAR_KM, F.lit(n)) for n, y, x in LANDMARKS])), F.array().cast("array<string>"))


def tags(kind: Column, place: Column) -> Column:
    by_kind = F.when(kind == "event", F.array(*map(F.lit, KIND_TAGS["event"]))).when(kind == "venue", F.array(*map(F.lit, KIND_TAGS["venue"]))).otherwise(F.array(*map(F.lit, KIND_TAGS["artist"])))
    own = F.when(place.isNotNull(), F.array(F.replace(F.lower(place), F.lit(" "), F.lit("_")))).otherwise(F.array().cast("array<string>"))
    extra = F.array().cast("array<string>")
    for name, more in DISTRICT_TAGS.items():
        extra = F.when(place == name, F.array(*map(F.lit, more))).otherwise(extra)
    return F.concat(by_kind, own, extra, F.array(F.lit("seattle"), F.lit("pacific_northwest")))

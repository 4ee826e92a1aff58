"""Normalization: parsed records of each source become venue, artist and event tables, one of each kind.

Every source is described by a Source; one set of column expressions serves all of them. Ids are name-based, so the same
name gives the same id on any executor and in any run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.functions import text as T
from stagelight.operators.catalog import first_of


@dataclass(frozen=True)
class Source:
    venue: str
    slug: str
    latitude: float
    longitude: float
    address: str
    postal_code: str
    neighborhood: str
    city: str = "Seattle"
    event_confidence: float = 0.85
    artist_confidence: float = 0.9
    support_confidence: float = 0.85
    venue_confidence: float = 1.0
    #: how the title names artists: whole, feat or with
    split: str = "whole"
    support: str | None = None
    #: fields that the start time, the image and the link come from; a link of "events" is the list of events
    times: tuple[str, ...] = ("scheduling.startTimeFormatted", "start_time", "event_time", "time")
    images: tuple[str, ...] = ("image_url", "mainImage.url")
    link: str = "ticket"
    #: what makes the description: one field, the first of several, or labelled parts joined together
    described: str = "field"
    #: whether events carry the venue's id; else the nil id, which `catalog.resolve_venues` replaces
    own_venue: bool = True


# Each source's venue, how sure its fields are, and which fields it has.
SOURCES = {
    "blue_moon": Source("Blue Moon Tavern", "blue-moon-tavern", 47.6608, -122.3126, "712 NE 45th St", "98105", "University District", event_confidence=0.9, artist_confidence=0.85, times=(), images=(), link="events", own_venue=False),
    "sea_monster": Source("Sea Monster Lounge", "sea-monster-lounge", 47.6615064, -122.3323427, "2202 N 45th St, Seattle, WA 98103", "98103", "Wallingford", event_confidence=0.95, artist_confidence=0.85, venue_confidence=0.95, times=("scheduling.startTimeFormatted",), images=("mainImage.url",), link="slug", own_venue=False),
    "darrells_tavern": Source("Darrell's Tavern", "darrells-tavern", 47.6780, -122.3460, "18041 Aurora Ave N", "98133", "Shoreline", city="Shoreline", event_confidence=0.9, artist_confidence=0.85, times=(), images=(), link="events", described="none", own_venue=False),
    "kexp": Source("KEXP Events", "kexp-events", 47.6205, -122.3493, "472 1st Ave N", "98109", "Lower Queen Anne", event_confidence=0.9, artist_confidence=0.85, times=("time",), images=(), link="events", described="field or place", own_venue=False),
    "barboza": Source("The Barboza", "the-barboza", 47.6133, -122.3185, "925 E Pike St", "98122", "Capitol Hill", event_confidence=0.95, split="feat", support="[,&]", times=("event_time",), images=("image_url",), described="with promoter age", own_venue=False),
    "neumos": Source("Neumos", "neumos", 47.614746, -122.319532, "925 E Pike St", "98122", "Capitol Hill", event_confidence=0.9, venue_confidence=0.95, split="with", support="[,&+]", times=("event_time",), images=("image_url",), described="tour with promoter age"),
    "conor_byrne": Source("Conor Byrne Pub", "conor-byrne-pub", 47.6686, -122.3842, "5140 Ballard Ave NW", "98107", "Ballard", event_confidence=0.95, support="[,&]", times=("event_time", "start_time"), images=("image_url",), link="event_url", described="with age"),
}
ORIGIN = "https://listings.example"


#: Fields that any of the sources has; a location that is plain text is read beside them
_FIELDS = (
    "title string, description string, supporting_acts string, tour_name string, promoter string, age_restriction string, event_url string, ticket_url string, detail_url string, slug string, image_url string, mainImage struct<url:string>, "
    "scheduling struct<startDate:string,startDateFormatted:string,startTimeFormatted:string>, startDate string, event_day string, date string, start_time string, event_time string, time string, "
    "location struct<name:string,coordinates:struct<lat:string,lng:string>,fullAddress:struct<formattedAddress:string,postalCode:string,city:string,subdivisions:string>>"
)


def _get(path: str) -> Column:
    """A field of the record, which is read once a row."""
    return F.col(f"_r.{path}")


def _first(*paths: str) -> Column:
    return F.coalesce(*[F.nullif(F.trim(_get(p)), F.lit("")) for p in paths])


def _by_source(pick) -> Column:
    """A value for each source as one column."""
    return reduce(lambda c, kv: F.when(F.col("source_id") == kv[0], pick(kv[1])).otherwise(c), SOURCES.items(), F.lit(None))


def _names(s: Source) -> Column:
    """Artist names of a record in order, with how sure each is."""
    title = F.col("title")
    sure = lambda names, c: F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(c).alias("confidence")))
    if s.split == "feat":
        own = F.concat(sure(F.array(T.headliner(title)), s.artist_confidence), sure(F.when(F.lower(title).contains("feat"), T.featured(title)).otherwise(F.array().cast("array<string>")), s.support_confidence))
    elif s.split == "with":
        acts = T.with_acts(title)
        own = F.concat(sure(F.slice(acts, 1, 1), s.artist_confidence), sure(F.slice(acts, F.lit(2), F.size(acts)), s.support_confidence))
    else:
        own = sure(F.array(title), s.artist_confidence)
    if s.support:
        more = F.filter(F.transform(F.split(F.coalesce(_get("supporting_acts"), F.lit("")), s.support), lambda x: F.trim(x)), lambda t: t != "")
        own = F.concat(own, sure(more, s.support_confidence))
    return F.filter(own, lambda a: (a["name"] != "") & ~T.is_non_artist(a["name"]))


def _known(parsed: DataFrame, as_of) -> DataFrame:
    """Rows of known sources with the fields that all entities need; without a date the day is as_of."""
    today = F.lit(as_of).cast("date")
    days = [T.parse_day(_get(p)) for p in ("scheduling.startDateFormatted", "scheduling.startDate", "startDate", "event_day", "date")]
    rows = parsed.where(F.col("source_id").isin(*SOURCES)).select("*", F.explode(F.array(F.from_json("record", _FIELDS))).alias("_r")).withColumn("title", T.title_or_null(_get("title"))).where("title is not null")
    rows = rows.withColumn("_day", F.coalesce(*days)).withColumn("event_day", F.coalesce("_day", today)).withColumn("dated", F.col("_day").isNotNull()).drop("_day")
    named = reduce(lambda c, kv: F.when((F.col("source_id") == kv[0]) & ~(F.lit(kv[0] == "sea_monster") & F.lower("title").contains("la luz")), _names(kv[1])).otherwise(c), SOURCES.items(), F.array().cast("array<struct<name:string,confidence:double>>"))
    return rows.withColumn("named", named)


def unknown(parsed: DataFrame) -> DataFrame:
    """Rows whose source has no normalizer."""
    return parsed.where(~F.coalesce(F.col("source_id").isin(*SOURCES), F.lit(False))).withColumn("error", F.lit("no normalizer"))


_PROVENANCE = ("source_id", "envelope_id", "payload_ref", "record_path")


def _described(s: Source) -> Column:
    """The description of a source's event: a field, or labelled parts in the order that the source gives them."""
    if s.described == "none":
        return F.lit(None).cast("string")
    if s.described == "field":
        return _first("description")
    if s.described == "field or place":  # a place that is an object is no description
        place = F.nullif(F.trim(F.get_json_object("record", "$.location")), F.lit(""))
        return F.coalesce(_first("description"), F.when(~place.startswith("{") & ~place.startswith("["), place))
    parts = {"tour": F.concat(F.lit("Tour: "), _first("tour_name")), "with": F.concat(F.lit("With "), _first("supporting_acts")), "promoter": _first("promoter"), "age": F.concat(F.lit("Age: "), _first("age_restriction"))}
    return F.nullif(F.concat_ws(" | ", *[parts[p] for p in s.described.split()]), F.lit(""))


def _link(s: Source) -> Column:
    """Where an event is shown: links without a site go to ORIGIN."""
    listed = F.lit(f"{ORIGIN}/events")
    if s.link == "events":
        return listed
    if s.link == "slug":
        return F.concat(F.lit(f"{ORIGIN}/event-info/"), _first("slug"))
    return F.coalesce(T.absolute_url(_first("event_url") if s.link == "event_url" else _first("ticket_url", "detail_url"), ORIGIN), listed)


def events(parsed: DataFrame, as_of) -> DataFrame:
    """Events of all sources, each field as its source has it. Sources with a single venue give the nil id, which
    `catalog.resolve_venues` replaces; an event's own id is made of its title, its source's venue and its day."""
    rows = _known(parsed, as_of)
    ids = F.transform("named", lambda a: T.slug_keep_runs(a["name"]))
    nothing = F.lit(None).cast("string")
    one = lambda paths: _first(*paths) if paths else nothing
    out = rows.select(
        "title", "event_day", T.parse_time(_by_source(lambda s: one(s.times))).alias("start_time"), _by_source(_link).alias("event_url"), _by_source(_described).alias("description"),
        _by_source(lambda s: one(s.images)).alias("event_image_url"), T.uuid5(_by_source(lambda s: F.lit(s.slug))).alias("_venue"), _by_source(lambda s: F.lit(s.own_venue)).alias("_own"), ids.alias("_slugs"),
        _by_source(lambda s: F.lit(s.event_confidence)).alias("confidence"), F.array_compact(F.array(F.when(~F.col("dated"), "No usable date"))).alias("warnings"), *_PROVENANCE,
    )
    out = out.withColumn("venue_id", F.when(F.col("_own"), F.col("_venue")).otherwise(T.NIL_UUID)).withColumn("artist_ids", F.transform("_slugs", lambda s: T.uuid5(s)))
    natural = F.concat_ws("|", F.lower("title"), "_venue", F.col("event_day").cast("string"))
    return out.withColumn("id", T.uuid5(natural)).withColumn("show_event", F.lit(True)).withColumn("finalized", F.lit(False)).drop("_slugs", "_venue", "_own")


def artists(parsed: DataFrame, as_of) -> DataFrame:
    """Each artist once a source, from the first record that names it."""
    each = _known(parsed, as_of).select(F.posexplode("named").alias("pos", "a"), *_PROVENANCE).select("pos", "a.name", "a.confidence", *_PROVENANCE)
    each = each.withColumn("name_slug", T.slug_keep_runs(F.col("name"))).withColumn("id", T.uuid5(F.col("name_slug")))
    return first_of(each, ["source_id", "name_slug"], "envelope_id", "record_path", "pos").drop("pos")


def venues(parsed: DataFrame, as_of) -> DataFrame:
    """Each source's venue once; sources that carry a location override the fixed values."""
    rows = first_of(_known(parsed, as_of), ["source_id"], "envelope_id", "record_path")
    part = F.from_json(_get("location.fullAddress.subdivisions"), "array<struct<type:int,name:string>>")
    quarter = F.get(F.filter(part, lambda p: p["type"] == 4), 0)["name"]
    fixed = lambda f: _by_source(lambda s: F.lit(getattr(s, f)))
    return rows.select(
        T.uuid5(fixed("slug")).alias("id"), F.coalesce(_first("location.name"), fixed("venue")).alias("name"), fixed("slug").alias("slug"), F.coalesce(_get("location.coordinates.lat").try_cast("double"), fixed("latitude")).alias("latitude"),
        F.coalesce(_get("location.coordinates.lng").try_cast("double"), fixed("longitude")).alias("longitude"), F.coalesce(_first("location.fullAddress.formattedAddress"), fixed("address")).alias("address"),
        F.coalesce(_first("location.fullAddress.postalCode"), fixed("postal_code")).alias("postal_code"), F.coalesce(_first("location.fullAddress.city"), fixed("city")).alias("city"), F.coalesce(quarter, fixed("neighborhood")).alias("neighborhood"),
        F.lit(True).alias("show_venue"), fixed("venue_confidence").alias("confidence"), *_PROVENANCE,
    )


def tables(parsed: DataFrame, as_of) -> dict[str, DataFrame]:
    """The fan-out: one table for each kind of entity."""
    return {"venue": venues(parsed, as_of), "artist": artists(parsed, as_of), "event": events(parsed, as_of)}


def records(parsed: DataFrame, as_of) -> DataFrame:
    """All entities as one table of (entity_type, id, name, confidence, warnings, strategy, geocoded, provenance)."""
    none = F.array().cast("array<string>")
    where = F.struct(*_PROVENANCE).alias("provenance")
    row = lambda d, kind, name, noted, placed: d.select(F.lit(kind).alias("entity_type"), "id", F.col(name).alias("name"), "confidence", noted.alias("warnings"), F.col("source_id").alias("strategy"), F.lit(placed).alias("geocoded"), where)
    t = tables(parsed, as_of)
    return row(t["venue"], "venue", "name", none, True).unionByName(row(t["artist"], "artist", "name", none, False)).unionByName(row(t["event"], "event", "title", F.col("warnings"), False))


def register(source_id: str, source: Source) -> None:
    """Adds a source, or puts another description in its place."""
    SOURCES[source_id] = source

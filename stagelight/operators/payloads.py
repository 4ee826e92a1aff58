"""Records out of JSON payloads, by Spark's own JSON functions, and dispatch by parse plan."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.functions.text import iso_start_time
from stagelight.operators import pages

_CARRIED = ("source_id", "envelope_id", "payload_ref")
# How callers and sources name each other.
API_NAMES = {
    "blue_moon": "crawler_blue_moon", "sea_monster": "crawler_sea_monster", "darrells_tavern": "crawler_darrells_tavern", "kexp": "crawler_kexp",
    "barboza": "crawler_barboza", "neumos": "crawler_neumos", "conor_byrne": "crawler_conor_byrne", "sunset_tavern": "crawler_sunset_tavern",
}


def api_name(source: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in API_NAMES.items() for x in kv]), source), source)


def source_of(api: Column) -> Column:
    """The source that an internal API name stands for; other names stand for themselves."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in API_NAMES.items() if k != "sunset_tavern" for x in (v, k)]), api), api)


def from_raw(raw: DataFrame) -> DataFrame:
    """Raw rows (id, api_name, event_api_id, data) as parsed records."""
    return raw.select(source_of(F.col("api_name")).alias("source_id"), F.col("id").cast("string").alias("envelope_id"), F.col("api_name").alias("payload_ref"), F.concat(F.lit("/events/"), F.col("event_api_id")).alias("record_path"), F.col("data").alias("record"))


def _rows(df: DataFrame, *columns: Column) -> DataFrame:
    return df.select(*_CARRIED, *columns)


def _text(record: Column) -> Column:
    """A VARIANT as text: a string as it is, all else as JSON."""
    return F.try_variant_get(record, "$", "string")


def _with_day(record: Column, day: Column) -> Column:
    """A VARIANT as text: an object with event_day set to the day; what is no object stays as it is."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    others = F.map_filter(fields, lambda k, v: k != "event_day")
    whole = F.to_json(F.map_concat(F.create_map(F.lit("event_day"), day.cast("variant")), others))
    return F.when(fields.isNotNull(), whole).otherwise(_text(record))


def calendar(payloads: DataFrame) -> DataFrame:
    """`events` array, else days of `eventsByDates` with the day added to each record, else the document itself, text that is
    no JSON included. Each payload is parsed once, to a VARIANT, and gives an array of (path, record) that is exploded once."""
    row = lambda path, record: F.struct(path.alias("record_path"), record.alias("record"))
    parsed = payloads.withColumn("_v", F.try_parse_json(F.col("payload").cast("string")))
    parsed = parsed.withColumn("_e", F.try_variant_get("_v", "$.events", "array<variant>")).withColumn("_d", F.try_variant_get("_v", "$.eventsByDates", "map<string,array<variant>>"))
    listed = F.transform("_e", lambda r, i: row(F.concat(F.lit("$.events["), i.cast("string"), F.lit("]")), _text(r)))
    of_day = lambda e: F.transform(e["value"], lambda r, i: row(F.concat(F.lit("$.eventsByDates."), e["key"], F.lit("["), i.cast("string"), F.lit("]")), _with_day(r, e["key"])))
    days = F.flatten(F.transform(F.filter(F.map_entries("_d"), lambda e: e["value"].isNotNull()), of_day))
    found = F.when(F.col("_e").isNotNull(), listed).when(F.col("_d").isNotNull(), days).otherwise(F.array(row(F.lit("$"), F.col("payload").cast("string"))))
    return parsed.select(*_CARRIED, F.explode(found).alias("_r")).select(*_CARRIED, "_r.record_path", "_r.record")


# Names of fields in the answers.
_EVENT = (
    "struct<name:string,date:string,startTime:string,doorTime:string,minimumAge:string,promoter:string,support:string,description:string,ticketsUrl:string,status:string,"
    "artists:array<struct<name:string,bio:string>>,announceArtists:array<struct<name:string,website:string,facebook:string,twitter:string,instagram:string,spotify:string,bandcamp:string>>,venue:struct<name:string>>"
)


def paginated(payloads: DataFrame) -> DataFrame:
    """Collection of a paginated GraphQL answer; a payload without one gives a row with an error."""
    parsed = payloads.withColumn("_c", F.from_json(F.get_json_object("payload", "$.data.paginatedEvents.collection"), f"array<{_EVENT}>"))
    e = lambda n: F.col(f"e.{n}")
    plain = F.transform(F.filter(e("artists"), lambda a: a["name"].isNotNull()), lambda a: F.struct(a["name"].alias("name"), a["bio"].alias("bio"), F.lit(None).cast("map<string,string>").alias("social_links")))
    sites = ("website", "facebook", "twitter", "instagram", "spotify", "bandcamp")
    links = lambda a: F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(s).alias("k"), a[s].alias("v")) for s in sites]), lambda p: p["v"].isNotNull()))
    announced = F.transform(F.filter(e("announceArtists"), lambda a: a["name"].isNotNull()), lambda a: F.struct(a["name"].alias("name"), F.lit(None).cast("string").alias("bio"), links(a).alias("social_links")))
    kind = "array<struct<name:string,bio:string,social_links:map<string,string>>>"
    artists = F.concat(F.coalesce(plain, F.array().cast(kind)), F.coalesce(announced, F.array().cast(kind)))
    record = F.to_json(F.struct(
        e("name").alias("title"), e("date").alias("event_day"), F.coalesce(e("startTime"), e("doorTime")).alias("start_time"), F.concat(e("minimumAge"), F.lit("+")).alias("age_restriction"), e("promoter").alias("promoter"),
        F.nullif(e("support"), F.lit("")).alias("supporting_acts"), e("description").alias("description"), e("ticketsUrl").alias("ticket_url"), e("status").alias("ticket_status"), F.when(F.size(artists) > 0, artists).alias("artists"),
        F.struct(F.coalesce(e("venue.name"), F.lit("Conor Byrne Pub")).alias("name")).alias("venue"),
    ))
    # a payload without a collection is one row of an error; an empty collection gives nothing
    each = parsed.select(*_CARRIED, F.col("_c").isNull().alias("_none"), F.posexplode(F.coalesce("_c", F.array(F.lit(None).cast(_EVENT)))).alias("i", "e"))
    path = F.when(F.col("_none"), "error").otherwise(F.concat(F.lit("$.data.paginatedEvents.collection["), F.col("i"), F.lit("]")))
    return each.select(*_CARRIED, path.alias("record_path"), F.when(F.col("_none"), F.lit('{"error":"no collection"}')).otherwise(record).alias("record"))


def structured(payloads: DataFrame) -> DataFrame:
    """Records that need no parser, by VARIANT: each element of an array, or the object itself. A JSON string is what a source
    sent as text and is parsed once more. Text that is no JSON, and what is neither array nor object, is one row of an error;
    so is a missing payload. Each payload is parsed once and gives an array that is exploded once."""
    v = F.try_parse_json(F.col("payload").cast("string"))
    again = F.when(F.schema_of_variant("_v") == "STRING", F.try_parse_json(F.try_variant_get("_v", "$", "string"))).otherwise(F.col("_v"))
    kind = F.schema_of_variant("_v")
    row = lambda path, record: F.struct(path.alias("record_path"), record.alias("record"))
    many = F.transform(F.try_variant_get("_v", "$", "array<variant>"), lambda r, i: row(F.concat(F.lit("$["), i.cast("string"), F.lit("]")), F.to_json(r)))
    one = F.array(row(F.lit("$"), F.to_json("_v")))
    broken = F.array(row(F.lit("error"), F.lit('{"error":"neither records nor a record"}')))
    found = F.when(kind.startswith("ARRAY"), many).when(kind.startswith("OBJECT"), one).otherwise(broken)
    parsed = payloads.withColumn("_v", v).withColumn("_v", again)
    return parsed.select(*_CARRIED, F.explode(found).alias("_r")).select(*_CARRIED, "_r.record_path", "_r.record")


def data_array(payloads: DataFrame) -> DataFrame:
    """REST answers with `data[]`."""
    rows = payloads.withColumn("_a", F.from_json(F.get_json_object("payload", "$.data"), "array<string>"))
    return _rows(rows, F.posexplode("_a").alias("i", "record")).select(*_CARRIED, F.concat(F.lit("$.data["), F.col("i"), F.lit("]")).alias("record_path"), "record")


def blue_moon_times(records: DataFrame) -> DataFrame:
    start = F.coalesce(F.get_json_object("record", "$.scheduling.startDate"), F.get_json_object("record", "$.startDate"))
    return records.withColumn("start_time", iso_start_time(start))


JSON_PLANS = {"wix_calendar_v1": calendar, "venuepilot_graphql_v1": paginated}
DEFAULT_PLAN = "wix_calendar_v1"


def parse(payloads: DataFrame, plans: DataFrame, as_of: date) -> DataFrame:
    """payloads (source_id, envelope_id, payload_ref, payload) by the plan of their source in plans (source_id,
    parse_plan_ref); sources without one take the default, unknown plans give no rows. JSON plans are a pass each, all page
    plans are one. Plans go to the payloads: dealt by source, all of one source would be one task's."""
    listed = plans.select("source_id", F.regexp_replace("parse_plan_ref", "^parse_plan:", "").alias("plan"))
    named = payloads.join(F.broadcast(listed), "source_id", "left").withColumn("plan", F.coalesce("plan", F.lit(DEFAULT_PLAN)))
    parts = [read(named.where(F.col("plan") == plan)) for plan, read in JSON_PLANS.items()]
    parts.append(pages.parse_by_plan(named.where(F.col("plan").isin(*pages.PLANS)).withColumn("html", F.col("payload").cast("string")), as_of))
    return reduce(DataFrame.unionByName, parts)

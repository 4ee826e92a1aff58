"""What each source's parser says about a raw record before it is normalized: the row for raw storage and the arguments of
an event. A record that lacks what its source must give has an error instead of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.functions import text as T
from stagelight.operators.normalize import ORIGIN, SOURCES

# Sources whose records carry a month and a day without a year, and the one whose months roll over.
TICKETED, ROLLING = ("barboza", "neumos"), "neumos"


def _get(path: str) -> Column:
    return F.get_json_object("record", f"$.{path}")


def _when(source: str | tuple[str, ...], value: Column, other: Column) -> Column:
    names = (source,) if isinstance(source, str) else source
    return F.when(F.col("source_id").isin(*names), value).otherwise(other)


def _day(as_of: Column) -> tuple[Column, Column]:
    """The text that a source gives its day as, and the day."""
    text = _when("sea_monster", _get("scheduling.startDateFormatted"), _when(TICKETED, _get("date_text"), _get("event_day")))
    month, number = T.month_number(F.split_part(text, F.lit(" "), F.lit(1))), F.split_part(text, F.lit(" "), F.lit(2)).try_cast("int")
    this = T.try_date(F.year(as_of), month, number)
    ticketed = _when(ROLLING, T.day_of_year_roll(month, number, as_of), this)
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))
    return text, _when("sea_monster", F.try_to_date(text, "MMMM d, yyyy"), _when(TICKETED, ticketed, iso))


def _known(records: DataFrame, as_of, needs: dict[str, Column]) -> DataFrame:
    """records of known sources with day and error: the first thing that is missing, or a day that is none."""
    text, day = _day(F.lit(as_of).cast("date"))
    rows = records.where(F.col("source_id").isin(*SOURCES)).withColumn("_text", text).withColumn("event_day", day)
    error = F.lit(None).cast("string")
    faults = [F.when(c, F.lit(f"{n} not found")) for n, c in needs.items()]
    faults += [F.when(F.col("_text").isNull(), "day not found"), F.when(F.col("event_day").isNull(), "day not understood")]
    return rows.withColumn("error", F.coalesce(*faults, error)).drop("_text")


def _lacks(path: str, *sources: str, but: tuple[str, ...] = ()) -> Column:
    of = F.col("source_id").isin(*sources) if sources else ~F.col("source_id").isin(*but)
    return of & _get(path).isNull()


def raw_data_info(records: DataFrame, as_of) -> DataFrame:
    """records (source_id, envelope_id, record) -> (source_id, envelope_id, event_api_id, event_name, venue_name, event_day,
    error)."""
    others = ("sea_monster", *TICKETED)
    rows = _known(records, as_of, {"title": _lacks("title", but=TICKETED), "id": _lacks("id", but=others), "slug": _lacks("slug", "sea_monster")})
    dated = F.concat_ws("_", "source_id", F.date_format("event_day", "yyyyMMdd"))
    name = _when(TICKETED, F.trim(F.coalesce(_get("title"), _get("id"), F.lit("Unknown Event"))), _get("title"))
    id_ = _when("sea_monster", _get("slug"), _when(TICKETED, F.coalesce(_get("id"), dated), _get("id")))
    venue = F.try_element_at(F.create_map(*[F.lit(x) for k, s in SOURCES.items() for x in (k, s.venue)]), F.col("source_id"))
    fine = lambda c: F.when(F.col("error").isNull(), c)
    return rows.select("source_id", "envelope_id", fine(id_).alias("event_api_id"), fine(name).alias("event_name"), fine(venue).alias("venue_name"), fine(F.col("event_day")).alias("event_day"), "error")


def event_args(records: DataFrame, as_of) -> DataFrame:
    """records (source_id, envelope_id, record) -> (source_id, envelope_id, title, event_day, start_time, event_url,
    description, event_image_url, error)."""
    rows = _known(records, as_of, {"title": _lacks("title", but=TICKETED), "startTimeFormatted": _lacks("scheduling.startTimeFormatted", "sea_monster"), "slug": _lacks("slug", "sea_monster")})
    main = F.trim(F.coalesce(_get("title"), _get("id"), F.lit("TBA")))
    full = F.concat(main, F.coalesce(F.concat(F.lit(" with "), _get("supporting_acts")), F.lit("")))
    title = _when(TICKETED, full, _when("sea_monster", F.trim(_get("title")), _get("title")))
    doors = F.trim(F.regexp_replace(_get("time_text"), r"(?i)^\s*doors:\s*", ""))
    time = _when(
        "sea_monster", T.parse_time(_get("scheduling.startTimeFormatted")),
        _when(TICKETED, T.parse_time(doors), _when("kexp", T.parse_time(_get("start_time")), _when("blue_moon", T.iso_start_time(_get("startDate")), F.lit(None).cast("string")))),
    )
    none = F.lit(None).cast("string")
    link = T.absolute_url(F.coalesce(_get("ticket_url"), _get("detail_url"), F.lit("/events")), ORIGIN)
    url = _when("sea_monster", F.concat(F.lit(f"{ORIGIN}/event-info/"), _get("slug")), _when(TICKETED, link, _when("kexp", _get("event_url"), none)))
    tour = _when(ROLLING, F.concat(F.lit("Tour: "), _get("tour_name")), none)
    elsewhere = F.when((F.col("source_id") == "barboza") & (_get("venue") != SOURCES["barboza"].venue), F.concat(F.lit("Venue: "), _get("venue")))
    told = F.coalesce(F.nullif(F.concat_ws(" | ", tour, _get("promoter"), F.concat(F.lit("Age: "), _get("age_restriction")), elsewhere), F.lit("")), _get("description"))
    description = _when(TICKETED, told, _when("kexp", _get("description"), none))
    image = _when("sea_monster", _get("mainImage.url"), _when(TICKETED, _get("image_url"), _when("kexp", _get("event_image_url"), none)))
    fine = lambda c: F.when(F.col("error").isNull(), c)
    each = {"title": title, "event_day": F.col("event_day"), "start_time": time, "event_url": url, "description": description, "event_image_url": image}
    return rows.select("source_id", "envelope_id", *[fine(c).alias(n) for n, c in each.items()], "error")


# Fixed value: the venue of the archived crawler's listings.
CRAWLED_VENUE = "KEXP"


def crawled_listings(records: DataFrame) -> DataFrame:
    """What the archived crawler of radio listings reads of its own records (source_id, envelope_id, record), which have date
    and url: the row for raw storage and the event's arguments, why a listing is passed over, and what is missing."""
    day = F.try_to_date(_get("date"), "yyyy-MM-dd")
    faults = [F.when(_get(n).isNull(), F.lit(f"{n} not found")) for n in ("id", "title", "date")]
    error = F.coalesce(*faults, F.when(day.isNull(), F.lit("day not understood")))
    fine = lambda c: F.when(error.isNull(), c)
    return records.select(
        "source_id", "envelope_id", fine(_get("id")).alias("event_api_id"), fine(_get("title")).alias("title"), fine(F.lit(CRAWLED_VENUE)).alias("venue_name"), fine(day).alias("event_day"), fine(T.parse_time(_get("start_time"))).alias("start_time"),
        fine(_get("url")).alias("event_url"), fine(_get("description")).alias("description"), fine(T.skip_reason(_get("title"))).alias("skipped"), error.alias("error"),
    )

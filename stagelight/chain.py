"""Queries over the chain from payloads to stored tables, each with the SQL that must give the same rows. Pages, JSON answers
and records are written out of the harness tables, read back by the library, and compared with the tables.

Roles as in the catalogue: orders are events, customers venues, parts artists.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.catalogue import DAY, Tables, query, today
from stagelight.functions import text as T
from stagelight.operators import normalize, pages, payloads, venue_parsers
from stagelight.lineage import ROWS, kept, written
from stagelight.plans import full
from stagelight.shipping import ship

AS_OF = date(1999, 6, 1)
LATE = date(1999, 11, 1)  # months before it belong to the next year where a page rolls over


def _fields(parsed: DataFrame, *names: str) -> DataFrame:
    return parsed.select("source_id", "envelope_id", "record_path", F.json_tuple("record", *names).alias(*names))  # a record is read once


class Kind(NamedTuple):
    """Documents of a source: items by key and day, what is before and after them, and between."""

    source: str
    item: Callable[[Column, Column], Column]
    before: str
    after: str
    between: str = ""


def _documents(rows: DataFrame, *kinds: Kind) -> DataFrame:
    """One document of each kind a customer: its items in the order of their keys. Keys and days are brought together, once for all
    kinds, and a customer's texts are made where they are: in two tasks a core, or as many as the rows need, since what is
    brought together is small next to what is made of it."""
    tasks = max(2 * rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS))
    brought = rows.select("o_custkey", "o_orderkey", "o_orderdate").repartition(tasks, "o_custkey")
    listed = brought.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderdate"))).alias("s"))
    text = lambda k: F.concat(F.lit(k.before), F.array_join(F.transform("s", lambda x: k.item(x["o_orderkey"], x["o_orderdate"])), k.between), F.lit(k.after))
    each = listed.select("o_custkey", F.explode(F.array(*[F.struct(F.lit(k.source).alias("source_id"), text(k).alias("payload")) for k in kinds])).alias("d"))
    return each.select("d.source_id", F.col("o_custkey").cast("string").alias("envelope_id"), F.lit("r").alias("payload_ref"), "d.payload")


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _key() -> Column:
    return F.col("o_orderkey")


def _date() -> Column:
    return F.col("o_orderdate")


# Page plans


def _radio_item(key: Column, day: Column) -> Column:
    title = F.when(key % 7 == 0, "Unknown Event").when(key % 7 == 1, "").otherwise(_cat("Show &amp; ", key))
    return _cat("<h2>", F.date_format(day, "MMMM d, yyyy"), '</h2><article class="EventItem x"><div class="EventItem-body"><h3><a> ', title, " </a></h3></div>", F.when(key % 2 == 0, '<div class="EventItem-DateTime"><h5>1 p.m.</h5></div>').otherwise(""), "</article>")


RADIO = Kind("kexp", _radio_item, "<html><body>", "</body></html>")


@query("""WITH kept AS (SELECT o_custkey, strftime(o_orderdate, '%B %-d, %Y') AS event_day, CASE WHEN o_orderkey % 2 = 0 THEN '1 p.m.' ELSE '' END AS event_time, 'Show & ' || o_orderkey AS title FROM orders WHERE o_orderkey % 7 > 1)
SELECT 'kexp' AS source_id, CAST(o_custkey AS VARCHAR) AS envelope_id, 'article.EventItem' AS record_path, title, event_day, event_time, 'KEXP Studio' AS location, 'true' AS public FROM kept
UNION ALL SELECT DISTINCT 'kexp', CAST(o_custkey AS VARCHAR), 'html', NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM kept)""")
def radio_pages_parsed(spark, d):
    ship(spark)
    raw = _documents(Tables(spark, d).orders, RADIO).withColumnRenamed("payload", "html")
    return _fields(pages.parse_pages(raw, "kexp_html_v1", AS_OF), "title", "event_day", "event_time", "location", "public")


def _ticket_item(key: Column, day: Column) -> Column:
    url = _cat("/events/detail/", key)
    some = lambda n, x: F.when(key % n != 0, x).otherwise("")
    return _cat(
        '<div class="eventItem"><div class="thumb"><img src="i', key, '.png"></div><h3 class="title"><a href="', url, '"> Main ', key, "</a></h3>", some(2, _cat('<h4 class="tagline">Guest ', key, " &amp; Other</h4>")),
        some(3, '<div class="promotion-text tour">Tour</div>'), some(5, '<div class="promotion-text">House</div>'), '<span class="m-date__month">', F.date_format(day, "MMM"), '</span> <span class="m-date__day">', F.date_format(day, "d"), "</span>",
        '<div class="meta"><span class="time">Doors: 7:30 PM</span>', some(4, '<span class="age">21+</span>'), some(6, '<span class="location">Hall</span>'), "</div>", some(7, _cat('<a class="tickets ', F.when(key % 2 == 0, "onsalenow").otherwise("soldout"), '" href="https://t.example/', key, '">x</a>')), "</div>",
    )


BARBOZA, NEUMOS = (Kind(source, _ticket_item, "<main>", "</main>") for source in ("barboza", "neumos"))


def _tickets(spark, d, kind: Kind) -> DataFrame:
    return _documents(Tables(spark, d).orders, kind).withColumnRenamed("payload", "html")


_TICKETED = """SELECT '{source}' AS source_id, CAST(o_custkey AS VARCHAR) AS envelope_id, 'div.eventItem' AS record_path, 'Main ' || o_orderkey AS title, CAST(o_orderkey AS VARCHAR) AS id, '/events/detail/' || o_orderkey AS detail_url,
CASE WHEN o_orderkey % 2 <> 0 THEN 'Guest ' || o_orderkey || ' & Other' END AS supporting_acts, {promoter} AS promoter, {tour} AS tour_name, CAST(CAST(try_strptime({year} || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d') AS DATE) AS VARCHAR) AS event_day, '7:30 PM' AS event_time,
CASE WHEN o_orderkey % 4 <> 0 THEN '21+' END AS age_restriction, {venue} AS venue, CASE WHEN o_orderkey % 7 <> 0 THEN 'https://t.example/' || o_orderkey END AS ticket_url, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 2 = 0 AS VARCHAR) END AS tickets_on_sale, 'i' || o_orderkey || '.png' AS image_url FROM orders"""
_TICKET_FIELDS = ("title", "id", "detail_url", "supporting_acts", "promoter", "tour_name", "event_day", "event_time", "age_restriction", "venue", "ticket_url", "tickets_on_sale", "image_url")


@query(_TICKETED.format(source="barboza", promoter="CASE WHEN o_orderkey % 3 <> 0 THEN 'Tour' WHEN o_orderkey % 5 <> 0 THEN 'House' END", tour="NULL::VARCHAR", year="'1999'", venue="CASE WHEN o_orderkey % 6 <> 0 THEN 'Hall' ELSE 'The Barboza' END"))
def ticket_pages_parsed(spark, d):
    ship(spark)
    return _fields(pages.parse_pages(_tickets(spark, d, BARBOZA), "barboza_html_v1", LATE), *_TICKET_FIELDS)


@query(_TICKETED.format(source="neumos", promoter="CASE WHEN o_orderkey % 5 <> 0 THEN 'House' END", tour="CASE WHEN o_orderkey % 3 <> 0 THEN 'Tour' END", year="CASE WHEN month(o_orderdate) < 11 THEN '2000' ELSE '1999' END", venue="'Neumos'"))
def tour_pages_parsed(spark, d):
    ship(spark)
    return _fields(pages.parse_pages(_tickets(spark, d, NEUMOS), "neumos_html_v1", LATE), *_TICKET_FIELDS)


def _headed_item(key: Column, day: Column) -> Column:
    return _cat("<h1>MUSIC ", F.date_format(day, "M.d"), "</h1><p><a>Act ", key, "</a>\nGuest ", key, "\nwith Act ", key, "\nDOORS 8\nSHOW 9\n$", key, "</p>")


HEADED = Kind("darrells_tavern", _headed_item, '<div class="entry-content">', "</div>")


_HEADED_DAY = "CAST(try_strptime('1999' || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d') AS DATE)"


@query(f"""WITH o AS (SELECT *, {_HEADED_DAY} AS day FROM orders), kept AS (SELECT o_custkey, t || o_orderkey AS title, CAST(day AS VARCHAR) AS event_day FROM o, (VALUES ('Act '), ('Guest ')) v(t) WHERE day IS NOT NULL)
SELECT 'darrells_tavern' AS source_id, CAST(o_custkey AS VARCHAR) AS envelope_id, 'entry-content' AS record_path, title, event_day FROM kept
UNION ALL SELECT DISTINCT 'darrells_tavern', CAST(o_custkey AS VARCHAR), 'html', NULL, NULL FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM kept)""")
def headed_pages_parsed(spark, d):
    ship(spark)
    return _fields(pages.parse_pages(_documents(Tables(spark, d).orders, HEADED).withColumnRenamed("payload", "html"), "darrells_html_v1", AS_OF), "title", "event_day")


def _titled_item(key: Column, day: Column) -> Column:
    return F.to_json(F.struct(_cat("T", key).alias("title")))


WARMUP = Kind("sea_monster", lambda key, day: F.to_json(F.struct(_cat("T", key).alias("title"), key.alias("k"))), '<p></p><script id="wix-warmup-data">{"appsWarmupData":{"app":{"other":{},"widget1":{"events":{"events":[', "]}}}}}</script>", ",")
CALENDAR = Kind("blue_moon", _titled_item, '{"events":[', "]}", ",")


@query("SELECT 'sea_monster' AS source_id, CAST(o_custkey AS VARCHAR) AS envelope_id, '$.widget1.events[' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) || ']' AS record_path, 'T' || o_orderkey AS title, CAST(o_orderkey AS VARCHAR) AS k FROM orders")
def warmup_pages_parsed(spark, d):
    ship(spark)
    return _fields(pages.parse_pages(_documents(Tables(spark, d).orders, WARMUP).withColumnRenamed("payload", "html"), "wix_warmup_v1", AS_OF), "title", "k")


# JSON plans


@query("SELECT CAST(user_id AS VARCHAR) AS envelope_id, CAST(ts AS DATE)::VARCHAR AS event_day, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL")
def exploded_events_by_dates(spark, d):
    """A document of days for each user, over all events."""
    e = Tables(spark, d).events.withColumn("day", F.to_date("ts").cast("string"))
    days = e.groupBy("user_id", "day").agg(F.concat(F.lit('"'), F.first("day"), F.lit('":['), F.array_join(F.collect_list("props"), ","), F.lit("]")).alias("part"))
    docs = days.groupBy("user_id").agg(F.concat(F.lit('{"eventsByDates":{'), F.array_join(F.collect_list("part"), ","), F.lit("}}")).alias("payload"))
    rows = payloads.calendar(docs.select(F.lit("cal").alias("source_id"), F.col("user_id").cast("string").alias("envelope_id"), F.lit("r").alias("payload_ref"), "payload"))
    found = rows.select("envelope_id", F.get_json_object("record", "$.event_day").alias("event_day"), F.get_json_object("record", "$.k").cast("bigint").alias("k"))
    return found.groupBy("envelope_id", "event_day", "k").agg(F.count("*").alias("n"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS envelope_id, CASE WHEN o_custkey % 3 = 0 THEN '$' ELSE '$.events[' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) || ']' END AS record_path, CASE WHEN o_custkey % 3 > 0 THEN 'T' || o_orderkey END AS title FROM orders QUALIFY o_custkey % 3 > 0 OR row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1")
def calendar_lists(spark, d):
    """Lists of events, and documents that are neither a list nor days."""
    docs = _documents(Tables(spark, d).orders, CALENDAR)
    docs = docs.withColumn("payload", F.when(F.col("envelope_id").cast("int") % 3 == 0, '{"nothing":1}').otherwise(F.col("payload")))
    return _fields(payloads.calendar(docs), "title").drop("source_id")


def _graph_item(key: Column, day: Column) -> Column:
    null = F.lit(None).cast("string")
    artist = F.struct(_cat("A", key).alias("name"), F.when(key % 2 == 0, "bio").alias("bio"))
    announced = F.struct(F.when(key % 3 != 0, _cat("B", key)).alias("name"), F.lit("https://w.example").alias("website"), F.when(key % 2 == 0, "https://s.example").alias("spotify"))
    return F.to_json(F.struct(
        _cat("N", key).alias("name"), F.date_format(day, "yyyy-MM-dd").alias("date"), F.when(key % 2 == 0, "20:00:00").otherwise(null).alias("startTime"), F.lit("19:00:00").alias("doorTime"), F.when(key % 5 != 0, F.lit(21)).alias("minimumAge"),
        F.when(key % 4 == 0, "").otherwise("Guest & Other").alias("support"), F.array(artist).alias("artists"), F.array(announced).alias("announceArtists"), F.when(key % 7 == 0, F.struct(F.lit("Hall").alias("name"))).alias("venue"),
    ))


GRAPH = Kind("conor_byrne", _graph_item, '{"data":{"paginatedEvents":{"collection":[', "]}}}", ",")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS envelope_id, '$.data.paginatedEvents.collection[' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) || ']' AS record_path, 'N' || o_orderkey AS title, strftime(o_orderdate, '%Y-%m-%d') AS event_day,
CASE WHEN o_orderkey % 2 = 0 THEN '20:00:00' ELSE '19:00:00' END AS start_time, CASE WHEN o_orderkey % 5 <> 0 THEN '21+' END AS age_restriction, CASE WHEN o_orderkey % 4 <> 0 THEN 'Guest & Other' END AS supporting_acts, CASE WHEN o_orderkey % 7 = 0 THEN 'Hall' ELSE 'Conor Byrne Pub' END AS venue,
concat_ws('|', 'A' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN ':bio' ELSE ':' END, CASE WHEN o_orderkey % 3 <> 0 THEN 'B' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN ':2' ELSE ':1' END END) AS artists FROM orders
UNION ALL SELECT '-1', 'error', NULL, NULL, NULL, NULL, NULL, NULL, NULL""")
def paginated_answers(spark, d):
    broken = spark.createDataFrame([("conor_byrne", "-1", "r", '{"data":{}}')], "source_id string, envelope_id string, payload_ref string, payload string")
    rows = payloads.paginated(_documents(Tables(spark, d).orders, GRAPH).unionByName(broken))
    artists = F.from_json(F.get_json_object("record", "$.artists"), "array<struct<name:string,bio:string,social_links:map<string,string>>>")
    named = F.array_join(F.transform(artists, lambda a: F.concat(a["name"], F.lit(":"), F.when(a["social_links"].isNotNull(), F.size(a["social_links"]).cast("string")).otherwise(F.coalesce(a["bio"], F.lit(""))))), "|")
    out = rows.select("envelope_id", "record_path", *[F.get_json_object("record", f"$.{n}").alias(n) for n in ("title", "event_day", "start_time", "age_restriction", "supporting_acts")], F.get_json_object("record", "$.venue.name").alias("venue"), named.alias("artists"))
    return out.withColumn("artists", F.when(F.col("title").isNotNull(), F.col("artists")))


_LISTED = "SELECT CAST(user_id AS VARCHAR) AS envelope_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL"


def _user_lists(spark, d, before: str, after: str) -> DataFrame:
    e = Tables(spark, d).events
    docs = e.groupBy("user_id").agg(F.concat(F.lit(before), F.array_join(F.collect_list("props"), ","), F.lit(after)).alias("payload"))
    return docs.select(F.lit("s").alias("source_id"), F.col("user_id").cast("string").alias("envelope_id"), F.lit("r").alias("payload_ref"), "payload")


def _counted(parsed: DataFrame) -> DataFrame:
    return parsed.select("envelope_id", F.get_json_object("record", "$.k").cast("bigint").alias("k")).groupBy("envelope_id", "k").agg(F.count("*").alias("n"))


@query(_LISTED)
def structured_payloads(spark, d):
    """Arrays of records, and single records of users with one event alone."""
    docs = _user_lists(spark, d, "[", "]")
    return _counted(payloads.structured(docs))


@query(_LISTED)
def rest_answers(spark, d):
    return _counted(payloads.data_array(_user_lists(spark, d, '{"total":1,"data":[', "]}")))


@query(_LISTED.replace("FROM events", "FROM events WHERE user_id % 2 = 0"))
def events_found_in_documents(spark, d):
    """Event-like objects somewhere in documents; those of odd users lack what tells an event."""
    ship(spark)
    docs = _user_lists(spark, d, '{"app":{"x":[{"eventList":[', "]}]}}")
    docs = docs.withColumn("payload", F.when(F.col("envelope_id").cast("long") % 2 == 0, F.replace(F.col("payload"), F.lit('{"k"'), F.lit('{"title":"t","k"'))).otherwise(F.col("payload")))
    return _counted(pages.events_in(docs))


@query("""SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 4 THEN DATE '1999-06-01' ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def inferred_days(spark, d):
    k, iso = _key() % 5, F.date_format(_date(), "yyyy-MM-dd")
    s = lambda name, v: F.to_json(F.struct(v.alias(name)))
    record = (
        F.when(k == 0, F.to_json(F.struct(F.struct(iso.alias("date")).alias("start"), F.lit("2001-01-01").alias("date")))).when(k == 1, F.to_json(F.struct(F.lit("soon").alias("startDate"), F.concat(iso, F.lit("T20:00:00Z")).alias("date"))))
        .when(k == 2, F.to_json(F.struct(F.unix_timestamp(_date().cast("timestamp")).alias("date"), F.lit("2001-01-01").alias("event_day")))).when(k == 3, s("event_day", iso)).otherwise(s("other", iso))
    )
    return Tables(spark, d).orders.select(_key().alias("id"), T.infer_day(record, today()).alias("day"))


@query("""WITH o AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS c FROM orders), radio AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 7 > 1), none AS (SELECT count(*) AS n FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING max(CAST(o_orderkey % 7 > 1 AS INT)) = 0))
SELECT 'kexp' AS source_id, radio.n + none.n AS n FROM radio, none UNION ALL SELECT 'sea_monster', n FROM o UNION ALL SELECT 'conor_byrne', n FROM o UNION ALL SELECT 'blue_moon', n FROM o""")
def parse_by_plan(spark, d):
    """Payloads of six sources by the plans of their sources: the default for one without, none for an unknown plan."""
    ship(spark)
    raw = _documents(Tables(spark, d).orders, RADIO, WARMUP, GRAPH, CALENDAR, CALENDAR._replace(source="sunset_tavern"))
    plans = spark.createDataFrame([("kexp", "parse_plan:kexp_html_v1"), ("sea_monster", "wix_warmup_v1"), ("conor_byrne", "venuepilot_graphql_v1"), ("sunset_tavern", "parse_plan:dice_api_v1")], "source_id string, parse_plan_ref string")

    def work(folder: str) -> DataFrame:
        stored = written(raw, f"{folder}/payloads")  # each plan reads payloads, none makes them anew
        return payloads.parse(stored, plans, AS_OF).groupBy("source_id").agg(F.count("*").alias("n"))

    return kept(spark, "payloads", work)


# Normalization: one record an order, of seven sources and one without a normalizer

_NAMES = [*normalize.SOURCES, "sunset_tavern"]


def _records(spark, d) -> DataFrame:
    k, c = _key(), F.col("o_custkey")
    source = F.get(F.array(*map(F.lit, _NAMES)), (k % 8).cast("int"))
    plain = _cat("Act ", c)
    title = (
        F.when(k % 11 == 0, " ").when(k % 13 == 0, "Open Mic").when((source == "sea_monster") & (k % 5 == 1), _cat("La Luz ", c)).when(source == "barboza", _cat("Main ", c, "! feat. Guest ", c, " & Friend + Fellow"))
        .when(source == "neumos", _cat("Main ", c, " with Guest ", c, ", Pal + Chum")).otherwise(plain)
    )
    dated = lambda form: F.when(k % 17 != 0, F.date_format(_date(), form))
    time = _cat((k % 12 + 1).cast("string"), ":", F.lpad((k % 60).cast("string"), 2, "0"), " PM")
    wix = F.struct(F.when(source == "blue_moon", dated("yyyy-MM-dd'T'19:30:00'Z'")).alias("startDate"), F.when(source == "sea_monster", dated("MMMM dd, yyyy")).alias("startDateFormatted"), F.when(source == "sea_monster", time).alias("startTimeFormatted"))
    day = F.when(source == "kexp", dated("MMMM d, yyyy")).when(~source.isin("blue_moon", "sea_monster"), dated("yyyy-MM-dd"))
    place = F.struct(F.lit("Lounge").alias("name"), F.struct(F.lit("1 Road").alias("formattedAddress"), F.lit("98000").alias("postalCode"), F.array(F.struct(F.lit(1).alias("type"), F.lit("no").alias("name")), F.struct(F.lit(4).alias("type"), F.lit("Quarter").alias("name"))).alias("subdivisions")).alias("fullAddress"), F.struct(F.lit(47.5).alias("lat"), F.lit(-122.25).alias("lng")).alias("coordinates"))
    record = F.to_json(F.struct(
        title.alias("title"), F.when(source.isin("blue_moon", "sea_monster"), wix).alias("scheduling"), day.alias("event_day"), F.when(~source.isin("sea_monster", "kexp"), time).alias("event_time"), F.when(source == "kexp", time).alias("time"), F.when(k % 5 == 0, "21+").alias("age_restriction"), F.when(k % 7 == 0, "Tour").alias("tour_name"), F.when(k % 10 < 2, "/own").alias("event_url"), F.when(source == "sea_monster", place).alias("location"), F.when(k % 3 == 0, "/t/1").alias("ticket_url"),
        F.when(k % 3 == 1, _cat("https://x.example/", k)).alias("detail_url"), F.when(k % 2 == 0, _cat("slug", k)).alias("slug"), F.when(k % 4 == 0, "words").alias("description"), F.when(k % 4 == 1, "Sup & Other").alias("supporting_acts"), F.when(k % 6 == 1, "House").alias("promoter"),
    ))
    return Tables(spark, d).orders.select(source.alias("source_id"), F.lpad(k.cast("string"), 9, "0").alias("envelope_id"), F.lit("r").alias("payload_ref"), F.lit("p").alias("record_path"), record.alias("record"))


def _u5(x: str) -> str:
    h = f"sha1(unhex('{T.DNS_NAMESPACE}') || encode({x}))"
    return f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"


def _slug(x: str) -> str:
    return rf"regexp_replace(regexp_replace(translate(replace(lower({x}), ' ', '-'), '''\".,!?&', ''), '[^a-z0-9-]', '', 'g'), '^-+|-+$', '', 'g')".replace('\\"', '"')


_S = normalize.SOURCES
_SOURCE_ROWS = ", ".join(f"({i}, '{n}', '{s.venue.replace(chr(39), chr(39) * 2)}', '{s.slug}', {s.event_confidence!r}e0, {s.artist_confidence!r}e0, {s.support_confidence!r}e0, {s.venue_confidence!r}e0, {s.latitude!r}e0, '{s.address}', '{s.neighborhood}')" for i, (n, s) in enumerate(_S.items()))
RECORDS = f"""WITH src(i, source_id, venue, slug, ec, ac, sc, vc, lat, address, quarter) AS (VALUES {_SOURCE_ROWS}),
r AS (SELECT o_orderkey AS k, o_custkey AS c, src.*, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS envelope_id, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
  CASE WHEN o_orderkey % 13 = 0 THEN 'Open Mic' WHEN source_id = 'sea_monster' AND o_orderkey % 5 = 1 THEN 'La Luz ' || o_custkey WHEN source_id = 'barboza' THEN 'Main ' || o_custkey || '! feat. Guest ' || o_custkey || ' & Friend + Fellow'
  WHEN source_id = 'neumos' THEN 'Main ' || o_custkey || ' with Guest ' || o_custkey || ', Pal + Chum' ELSE 'Act ' || o_custkey END AS title FROM orders JOIN src ON o_orderkey % 8 = i WHERE o_orderkey % 11 <> 0),
own AS (SELECT k, source_id, envelope_id, title, c, ac, sc, CASE WHEN title = 'Open Mic' OR title LIKE 'La Luz%' THEN [] WHEN source_id IN ('barboza', 'neumos') THEN ['Main ' || c] ELSE [title] END AS mains,
  CASE WHEN title = 'Open Mic' THEN [] WHEN source_id = 'barboza' THEN ['Guest ' || c, 'Friend', 'Fellow'] WHEN source_id = 'neumos' THEN ['Guest ' || c, 'Pal', 'Chum'] ELSE [] END AS guests,
  CASE WHEN source_id IN ('barboza', 'neumos', 'conor_byrne') AND k % 4 = 1 THEN ['Sup', 'Other'] ELSE [] END AS more FROM r),
named AS (SELECT k, source_id, envelope_id, unnest(list_concat(mains, guests, more)) AS name, generate_subscripts(list_concat(mains, guests, more), 1) AS pos, CASE WHEN generate_subscripts(list_concat(mains, guests, more), 1) <= len(mains) THEN ac ELSE sc END AS confidence FROM own)"""


@query(RECORDS + f""", ids AS (SELECT k, string_agg({_u5(_slug("name"))}, ',' ORDER BY pos) AS artist_ids FROM named GROUP BY 1),
e AS (SELECT r.*, {_u5("slug")} AS own_id, coalesce(day, {DAY}) AS event_day, CASE WHEN k % 4 = 1 THEN 'With Sup & Other' END AS sup, CASE WHEN k % 6 = 1 THEN 'House' END AS house, CASE WHEN k % 5 = 0 THEN 'Age: 21+' END AS age, CASE WHEN k % 7 = 0 THEN 'Tour: Tour' END AS tour FROM r)
SELECT source_id, envelope_id, title, event_day, CASE WHEN source_id NOT IN ('blue_moon', 'darrells_tavern') THEN printf('%02d:%02d:00', CAST((k % 12 + 1) % 12 + 12 AS INT), CAST(k % 60 AS INT)) END AS start_time,
CASE WHEN source_id IN ('blue_moon', 'darrells_tavern', 'kexp') THEN '{normalize.ORIGIN}/events' WHEN source_id = 'sea_monster' THEN CASE WHEN k % 2 = 0 THEN '{normalize.ORIGIN}/event-info/slug' || k END
  WHEN source_id = 'conor_byrne' THEN CASE WHEN k % 10 < 2 THEN '{normalize.ORIGIN}/own' ELSE '{normalize.ORIGIN}/events' END ELSE CASE k % 3 WHEN 0 THEN '{normalize.ORIGIN}/t/1' WHEN 1 THEN 'https://x.example/' || k ELSE '{normalize.ORIGIN}/events' END END AS event_url,
CASE WHEN source_id IN ('blue_moon', 'sea_monster', 'kexp') THEN CASE WHEN k % 4 = 0 THEN 'words' END WHEN source_id = 'barboza' THEN nullif(concat_ws(' | ', sup, house, age), '') WHEN source_id = 'neumos' THEN nullif(concat_ws(' | ', tour, sup, house, age), '') WHEN source_id = 'conor_byrne' THEN nullif(concat_ws(' | ', sup, age), '') END AS description,
CASE WHEN source_id IN ('neumos', 'conor_byrne') THEN own_id ELSE '{T.NIL_UUID}' END AS venue_id, coalesce(artist_ids, '') AS artist_ids, round(ec, 6) AS confidence, CAST(day IS NULL AS INT) AS n_warnings,
{_u5("lower(title) || '|' || own_id || '|' || CAST(event_day AS VARCHAR)")} AS id FROM e LEFT JOIN ids USING (k)""")
def normalized_events(spark, d):
    e = normalize.events(_records(spark, d), AS_OF)
    return e.select("source_id", "envelope_id", "title", "event_day", "start_time", "event_url", "description", "venue_id", F.array_join("artist_ids", ",").alias("artist_ids"), F.round("confidence", 6).alias("confidence"), F.size("warnings").alias("n_warnings"), "id")


@query(RECORDS + f" SELECT source_id, name, {_slug('name')} AS name_slug, {_u5(_slug('name'))} AS id, round(confidence, 6) AS confidence, envelope_id FROM named QUALIFY row_number() OVER (PARTITION BY source_id, {_slug('name')} ORDER BY envelope_id, pos) = 1")
def normalized_artists(spark, d):
    return normalize.artists(_records(spark, d), AS_OF).select("source_id", "name", "name_slug", "id", F.round("confidence", 6).alias("confidence"), "envelope_id")


@query(RECORDS + f""" SELECT source_id, {_u5("slug")} AS id, CASE WHEN source_id = 'sea_monster' THEN 'Lounge' ELSE venue END AS name, slug, CASE WHEN source_id = 'sea_monster' THEN 475e-1 ELSE lat END AS latitude, CASE WHEN source_id = 'sea_monster' THEN '1 Road' ELSE address END AS address,
CASE WHEN source_id = 'sea_monster' THEN 'Quarter' ELSE quarter END AS neighborhood, round(vc, 6) AS confidence FROM src WHERE source_id IN (SELECT source_id FROM r)""")
def normalized_venues(spark, d):
    return normalize.venues(_records(spark, d), AS_OF).select("source_id", "id", "name", "slug", "latitude", "address", "neighborhood", F.round("confidence", 6).alias("confidence"))


@query(RECORDS + """, v AS (SELECT 'venue' AS entity_type, source_id, count(*) AS n, 0 AS n_warned FROM (SELECT DISTINCT source_id FROM r) GROUP BY ALL), a AS (SELECT 'artist', source_id, count(DISTINCT name), 0 FROM named GROUP BY 2), e AS (SELECT 'event', source_id, count(*), count_if(day IS NULL) FROM r GROUP BY 2)
SELECT * FROM v UNION ALL SELECT * FROM a UNION ALL SELECT * FROM e""")
def normalized_records(spark, d):
    """All entities as one table, with their provenance."""
    found = normalize.records(_records(spark, d), AS_OF)
    return found.groupBy("entity_type", F.col("provenance.source_id").alias("source_id")).agg(F.count("*").alias("n"), F.count_if(F.size("warnings") > 0).cast("int").alias("n_warned"))


@query("SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS envelope_id, 'no normalizer' AS error FROM orders WHERE o_orderkey % 8 = 7")
def unknown_sources(spark, d):
    return normalize.unknown(_records(spark, d)).select("envelope_id", "error")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN '19:30:00' END AS start_time FROM orders")
def calendar_start_times(spark, d):
    start = F.when(_key() % 4 == 0, F.to_json(F.struct(F.struct(F.date_format(_date(), "yyyy-MM-dd'T'19:30:00-08:00").alias("startDate")).alias("scheduling")))).when(_key() % 2 == 0, F.to_json(F.struct(F.date_format(_date(), "yyyy-MM-dd'T'19:30:00-08:00").alias("startDate")))).otherwise("{}")
    return payloads.blue_moon_times(Tables(spark, d).orders.select(_key().alias("id"), start.alias("record"))).select("id", "start_time")


@query(RECORDS + f""" SELECT r.source_id, envelope_id, CASE WHEN source_id IN ('neumos', 'conor_byrne', 'blue_moon', 'darrells_tavern', 'kexp', 'barboza') THEN {_u5("slug")} ELSE '{T.NIL_UUID}' END AS venue_id, source_id NOT IN ('neumos', 'conor_byrne') AS was_open FROM r""")
def chained_venues(spark, d):
    """Events through assessment and enrichment: those whose source leaves the venue open are noted, and get the one venue of
    their source; one source's venue goes by another name in its records, and stays open."""
    out = full.assessed(normalize.tables(_records(spark, d), AS_OF), AS_OF)["event"]
    return out.select("source_id", "envelope_id", "venue_id", F.exists("issues", lambda i: i["field"] == "venue_id").alias("was_open"))


@query("""WITH p AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
SELECT CAST(k AS VARCHAR) AS envelope_id, CASE WHEN k % 6 IN (0, 2) THEN '$[' || i || ']' WHEN k % 6 IN (1, 3) THEN '$' ELSE 'error' END AS record_path, CASE WHEN k % 6 < 4 THEN k * 10 + i END AS n, CASE WHEN k % 6 < 4 AND i % 2 = 0 THEN 'é "q" ' || c END AS t
FROM p, generate_series(0, CASE WHEN k % 6 IN (0, 2) THEN 2 ELSE 0 END) s(i)""")
def mixed_structured_payloads(spark, d):
    """Arrays and objects, the same as JSON strings, broken text, and what is no record."""
    k = _key()
    one = lambda i: F.struct((k * 10 + i).alias("n"), F.when(F.lit(i % 2 == 0), _cat('é "q" ', F.col("o_custkey"))).alias("t"))
    many, single = F.to_json(F.array(*[one(i) for i in range(3)])), F.to_json(one(0))
    quoted = lambda x: F.substr(F.to_json(F.struct(x.alias("s"))), F.lit(6), F.length(F.to_json(F.struct(x.alias("s")))) - 6)
    text = F.when(k % 6 == 0, many).when(k % 6 == 1, single).when(k % 6 == 2, quoted(many)).when(k % 6 == 3, quoted(single)).when(k % 6 == 4, F.lit('{"broken')).otherwise(F.lit("17"))
    docs = Tables(spark, d).orders.select(F.lit("s").alias("source_id"), k.cast("string").alias("envelope_id"), F.lit("r").alias("payload_ref"), text.alias("payload"))
    found = payloads.structured(docs)
    field = lambda n, t: F.try_variant_get(F.parse_json("record"), f"$.{n}", t).alias(n)
    return found.select("envelope_id", "record_path", field("n", "bigint"), field("t", "string"))


# What parsers say of raw records


def _raw_records(spark, d) -> DataFrame:
    k, c = _key(), F.col("o_custkey")
    source = F.get(F.array(*map(F.lit, _NAMES)), (k % 8).cast("int"))
    has = lambda n, x: F.when(k % n != 0, x)
    iso, ticketed = F.date_format(_date(), "yyyy-MM-dd"), source.isin("barboza", "neumos")
    record = F.to_json(F.struct(
        has(11, _cat(" T", c)).alias("title"), has(13, _cat("id", k)).alias("id"), has(7, _cat("slug", k)).alias("slug"), has(17, F.when(k % 19 == 0, "soon").otherwise(iso)).alias("event_day"), F.when(ticketed, has(17, F.date_format(_date(), "MMM d"))).alias("date_text"),
        F.struct(has(17, F.date_format(_date(), "MMMM d, yyyy")).alias("startDateFormatted"), has(23, F.lit("7:05 PM")).alias("startTimeFormatted")).alias("scheduling"), F.concat(iso, F.lit("T19:30:00-08:00")).alias("startDate"), F.lit("noon").alias("start_time"), F.lit("Doors: 8:15 PM").alias("time_text"),
        F.when(k % 3 == 0, "A & B").alias("supporting_acts"), F.when(k % 3 == 0, "/t").when(k % 3 == 1, "https://x.example").alias("ticket_url"), F.when(k % 4 == 0, "Big").alias("tour_name"), F.when(k % 5 == 0, "House").alias("promoter"), F.when(k % 2 == 0, "Hall").otherwise("The Barboza").alias("venue"), F.lit("words").alias("description"),
        F.lit("/e").alias("event_url"), F.struct(F.lit("m.png").alias("url")).alias("mainImage"), F.lit("i.png").alias("image_url"),
    ))
    return Tables(spark, d).orders.select(source.alias("source_id"), k.cast("string").alias("envelope_id"), record.alias("record"))


_RAW = f"""WITH src(i, source_id, venue) AS (VALUES {", ".join(f"({i}, '{n}', '{s.venue.replace(chr(39), chr(39) * 2)}')" for i, (n, s) in enumerate(_S.items()))}),
o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS day, src.*, source_id IN ('barboza', 'neumos') AS t, source_id = 'sea_monster' AS sea FROM orders JOIN src ON o_orderkey % 8 = i),
p AS (SELECT *, CASE WHEN t THEN CAST(try_strptime(CASE WHEN source_id = 'neumos' AND month(day) < 11 THEN '2000' ELSE '1999' END || strftime(day, '-%m-%d'), '%Y-%m-%d') AS DATE) WHEN NOT sea AND k % 19 = 0 THEN NULL ELSE CAST(day AS DATE) END AS d FROM o),
e AS (SELECT *, CASE WHEN k % 17 = 0 THEN 'day not found' WHEN d IS NULL THEN 'day not understood' END AS day_error FROM p)"""


@query(_RAW + """, r AS (SELECT *, coalesce(CASE WHEN k % 11 = 0 AND NOT t THEN 'title not found' WHEN k % 13 = 0 AND NOT t AND NOT sea THEN 'id not found' WHEN k % 7 = 0 AND sea THEN 'slug not found' END, day_error) AS error FROM e)
SELECT source_id, CAST(k AS VARCHAR) AS envelope_id, CASE WHEN error IS NULL THEN CASE WHEN sea THEN 'slug' || k WHEN k % 13 <> 0 THEN 'id' || k ELSE source_id || '_' || strftime(d, '%Y%m%d') END END AS event_api_id,
CASE WHEN error IS NULL THEN CASE WHEN t AND k % 11 <> 0 THEN 'T' || c WHEN t AND k % 13 <> 0 THEN 'id' || k WHEN t THEN 'Unknown Event' ELSE ' T' || c END END AS event_name, CASE WHEN error IS NULL THEN venue END AS venue_name, CASE WHEN error IS NULL THEN d END AS event_day, error FROM r""")
def raw_data_infos(spark, d):
    return venue_parsers.raw_data_info(_raw_records(spark, d), LATE)


@query(_RAW + f""", r AS (SELECT *, coalesce(CASE WHEN k % 11 = 0 AND NOT t THEN 'title not found' WHEN k % 23 = 0 AND sea THEN 'startTimeFormatted not found' WHEN k % 7 = 0 AND sea THEN 'slug not found' END, day_error) AS error FROM e)
SELECT source_id, CAST(k AS VARCHAR) AS envelope_id, error, CASE WHEN error IS NULL THEN CASE WHEN t THEN CASE WHEN k % 11 <> 0 THEN 'T' || c WHEN k % 13 <> 0 THEN 'id' || k ELSE 'TBA' END || CASE WHEN k % 3 = 0 THEN ' with A & B' ELSE '' END WHEN sea THEN 'T' || c ELSE ' T' || c END END AS title, CASE WHEN error IS NULL THEN d END AS event_day,
CASE WHEN error IS NULL THEN CASE WHEN t THEN '20:15:00' WHEN sea THEN '19:05:00' WHEN source_id = 'kexp' THEN '12:00:00' WHEN source_id = 'blue_moon' THEN '19:30:00' END END AS start_time,
CASE WHEN error IS NULL THEN CASE WHEN sea THEN '{normalize.ORIGIN}/event-info/slug' || k WHEN t THEN CASE k % 3 WHEN 0 THEN '{normalize.ORIGIN}/t' WHEN 1 THEN 'https://x.example' ELSE '{normalize.ORIGIN}/events' END WHEN source_id = 'kexp' THEN '/e' END END AS event_url,
CASE WHEN error IS NULL THEN CASE WHEN t THEN coalesce(nullif(concat_ws(' | ', CASE WHEN source_id = 'neumos' AND k % 4 = 0 THEN 'Tour: Big' END, CASE WHEN k % 5 = 0 THEN 'House' END, CASE WHEN source_id = 'barboza' AND k % 2 = 0 THEN 'Venue: Hall' END), ''), 'words') WHEN source_id = 'kexp' THEN 'words' END END AS description,
CASE WHEN error IS NULL THEN CASE WHEN sea THEN 'm.png' WHEN t THEN 'i.png' END END AS event_image_url FROM r""")
def event_arguments(spark, d):
    return venue_parsers.event_args(_raw_records(spark, d), LATE)

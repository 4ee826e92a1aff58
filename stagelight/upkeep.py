"""Queries over stored tables, the ingest log, functions on text and assessments that the catalogue does not cover, each with
the SQL that must give the same rows. Roles as in the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.catalogue import ARTISTS, BASE, DISTRICT, INSIDE, SHOWS, VENUES, Tables, query, today
from stagelight.functions import text as T
from stagelight.lineage import dealt
from stagelight.operators import catalog, conflation, enrichment, ingest, listings, metrics, quality
from stagelight.sources import registry
from stagelight.streaming.dedupe import windowed_rate

NOW = "1999-06-01 12:00:00"
_AT = f"TIMESTAMP '{NOW}'"

# Storage


def _stored_events(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored events, their edges, and what is proposed: every third event moves to another venue and keeps only its first
    artist. Acts are dealt by event in tasks of a bounded number of rows; no event's list of artists is put together only to be
    taken apart."""
    t = Tables(spark, d)
    events = t.shows.select("id", "title", "event_day", "venue_id")
    acts = dealt(t.lineitem.select(F.col("l_orderkey").alias("target_id"), F.col("l_partkey").alias("source_id")), "target_id").where("source_id is not null")
    plays = acts.distinct().join(events.select(F.col("id").alias("target_id")).hint("shuffle_hash"), "target_id", "left_semi")
    hosts = events.where("venue_id is not null").select(F.col("venue_id").alias("source_id"), F.col("id").alias("target_id"), F.lit("hosts").alias("relation"))
    firsts = acts.groupBy(F.col("target_id").alias("id")).agg(F.min("source_id").alias("first"))
    ids = F.when(F.col("first").isNotNull(), F.array("first")).otherwise(F.array().cast("array<bigint>"))
    proposed = events.where("id % 3 = 0").join(firsts, "id", "left").select("id", "title", "event_day", (F.col("venue_id") + 1000000).alias("venue_id"), ids.alias("artist_ids"))
    return events, hosts.unionByName(plays.select("source_id", "target_id", F.lit("performs_at").alias("relation"))), proposed


@query(BASE + """SELECT CASE WHEN event_id % 3 = 0 THEN venue_id + 1000000 ELSE venue_id END AS source_id, event_id AS target_id, 'hosts' AS relation FROM hosts
UNION ALL SELECT artist_id, event_id, 'performs_at' FROM acts WHERE event_id IN (SELECT id FROM shows) AND event_id % 3 <> 0 UNION ALL SELECT min(artist_id), event_id, 'performs_at' FROM acts WHERE event_id IN (SELECT id FROM shows) AND event_id % 3 = 0 GROUP BY 2""")
def update_events_edges(spark, d):
    """Edges after an update: what an event no longer names is gone."""
    return catalog.update_events(*_stored_events(spark, d))[1]


@query(BASE + "SELECT id, CASE WHEN id % 3 = 0 THEN venue_id + 1000000 ELSE venue_id END AS venue_id FROM shows")
def update_events_rows(spark, d):
    return catalog.update_events(*_stored_events(spark, d))[0].select("id", "venue_id")


@query(BASE + "SELECT artist_id AS source_id, event_id AS target_id, 'performs_at' AS relation FROM acts WHERE event_id <> 7 AND artist_id <> 7 UNION ALL SELECT venue_id, event_id, 'hosts' FROM hosts WHERE event_id <> 7 AND venue_id <> 7")
def delete_event_edges(spark, d):
    return Tables(spark, d).listings(True).delete_event(7)[1]


@query(f"WITH {VENUES} SELECT lower(name) AS name_lower, count(*) AS n, min(city) AS city, CAST(min(created_at) AS VARCHAR) AS created_at FROM (SELECT name, city, NULL::TIMESTAMP AS created_at FROM venues WHERE id % 4 > 0 UNION ALL SELECT upper(name), 'Seattle', {_AT} FROM venues WHERE id % 4 = 0) GROUP BY 1")
def create_venues(spark, d):
    """Venues known by name alone get defaults; names that are there in another case are not made again."""
    v = Tables(spark, d).venues
    known = v.where("id % 4 > 0").select("id", "name", "city")
    made = catalog.create(known, catalog.default_venues(v.select("id", F.upper("name").alias("name"))), "name", NOW)
    return made.groupBy(F.lower("name").alias("name_lower")).agg(F.count("*").alias("n"), F.min("city").alias("city"), F.min(F.col("created_at").cast("string")).alias("created_at"))


@query(f"WITH {ARTISTS} SELECT min(id) AS id, replace(lower(name), ' ', '-') AS name_slug FROM artists GROUP BY 2")
def create_artists(spark, d):
    """Each slug once, those that are stored as they are."""
    a = Tables(spark, d).artists.withColumn("name_slug", T.slug(F.col("name")))
    firsts = catalog.first_of(a, ["name_slug"], "id").where("id % 2 = 0")
    return catalog.create(firsts, a, "name_slug", NOW).select("id", "name_slug")


@query("SELECT event_id AS id, event_id % 3 = 0 AS processed FROM events")
def create_raw_data(spark, d):
    raw = Tables(spark, d).events.select(F.col("event_id").alias("id"), F.col("event_type").alias("api_name"), (F.col("event_id") % 3 == 0).alias("processed"))
    return catalog.create_raw_data(raw.where("id % 3 = 0"), raw.drop("processed"), NOW).select("id", "processed")


@query("SELECT event_id AS id FROM events WHERE event_type = 'click' AND event_id % 3 = 0")
def processed_raw(spark, d):
    raw = Tables(spark, d).events.select(F.col("event_id").alias("id"), F.col("event_type").alias("api_name"), F.to_date("ts").alias("event_day"), (F.col("event_id") % 3 == 0).alias("processed"))
    return listings.unprocessed(raw, "click", processed=True).select("id")


@query(f"WITH {VENUES} SELECT id, CASE WHEN id % 5 = 0 THEN 'Elsewhere' ELSE name END AS name, TIMESTAMP '1998-01-01' AS created_at, CASE WHEN id % 5 = 0 THEN {_AT} ELSE TIMESTAMP '1998-02-02' END AS updated_at FROM venues WHERE id % 2 = 0 UNION ALL SELECT id, name, {_AT}, {_AT} FROM venues WHERE id % 2 = 1")
def timestamps_of_merge(spark, d):
    v = Tables(spark, d).venues.select("id", "name")
    stored = v.where("id % 2 = 0").withColumn("created_at", F.lit("1998-01-01").cast("timestamp")).withColumn("updated_at", F.lit("1998-02-02").cast("timestamp"))
    merged = v.withColumn("name", F.when((F.col("id") % 5 == 0) & (F.col("id") % 2 == 0), "Elsewhere").otherwise(F.col("name")))
    return catalog.stamped(merged, stored, ["id"], NOW, ("name",))


@query(f"WITH {VENUES} SELECT id, CASE WHEN id % 2 = 0 THEN 'venue' ELSE 'artist' END AS label, CASE WHEN id % 3 = 0 THEN 'new' ELSE name END AS data FROM venues")
def upsert_nodes(spark, d):
    """A conflicting label in the proposal is not taken over."""
    v = Tables(spark, d).venues
    nodes = v.select("id", F.when(F.col("id") % 2 == 0, "venue").otherwise("artist").alias("label"), F.col("name").alias("data"))
    return catalog.upsert_nodes(nodes, nodes.where("id % 3 = 0").withColumn("label", F.lit("event")).withColumn("data", F.lit("new")))


@query("SELECT CAST(count(*) AS BIGINT) AS nodes, CAST(0 AS BIGINT) AS after FROM customer")
def clear_all(spark, d):
    v = Tables(spark, d).venues
    (after,) = catalog.clear(v)
    return v.agg(F.count("*").alias("nodes")).crossJoin(after.agg(F.count("*").alias("after")))  # one row each


_RUNS = "SELECT 'run-' || (o_custkey % 3) AS process_run_id, CASE o_orderstatus WHEN 'F' THEN 'CREATE' ELSE 'UPDATE' END AS change_type, o_orderkey AS id FROM orders"


@query(f"SELECT process_run_id, 'catalog' AS name, change_type, count(*) AS n FROM ({_RUNS}) WHERE process_run_id <> 'run-2' GROUP BY ALL")
def run_rollup(spark, d):
    """Records of the runs there are, by change type."""
    records = Tables(spark, d).orders.select(F.concat(F.lit("run-"), F.col("o_custkey") % 3).alias("process_run_id"), F.when(F.col("o_orderstatus") == "F", "CREATE").otherwise("UPDATE").alias("change_type"), F.col("o_orderkey").alias("id"))
    runs = catalog.finish_run(catalog.process_run(spark, "run-0", "catalog", None).unionByName(catalog.process_run(spark, "run-1", "catalog", None)), NOW)
    return catalog.run_records(runs, records)


@query("SELECT 'run-1' AS source_id, o_orderkey AS target_id, 'has_record' AS relation FROM orders")
def process_record_edges(spark, d):
    new = Tables(spark, d).orders.select(F.col("o_orderkey").alias("id"), F.lit("run-1").alias("process_run_id"), F.lit("CREATE").alias("change_type"))
    stored = new.where("id % 4 = 0").withColumn("created_at", F.lit(NOW).cast("timestamp"))
    edges = stored.select(F.col("process_run_id").alias("source_id"), F.col("id").alias("target_id"), F.lit("has_record").alias("relation"))
    return catalog.create_process_records(stored, edges, new, NOW)[1]


@query(f"SELECT {_AT} AS finished_at, 'nightly' AS name, 'r' AS id, TIMESTAMP '1999-06-01 11:00:00' AS created_at")
def run_lifecycle(spark, d):
    from datetime import datetime

    return catalog.finish_run(catalog.process_run(spark, "r", "nightly", datetime(1999, 6, 1, 11)), NOW)


@query("""SELECT 'venue' AS entity, CAST(c_custkey AS VARCHAR) AS id, 'Created' AS change_type, NULL AS error FROM customer UNION ALL SELECT 'artist', CAST(p_partkey AS VARCHAR), 'NoChange', NULL FROM part
UNION ALL SELECT 'raw_data', CAST(event_id AS VARCHAR), 'ERROR', 'no day' FROM events WHERE event_type = 'click'""")
def legacy_audit(spark, d):
    t = Tables(spark, d)
    outcomes = {"venue": t.venues.select("id", F.lit("Created").alias("change_type")), "artist": t.artists.select("id", F.lit("NoChange").alias("change_type"))}
    return catalog.legacy_audit(outcomes, t.events.where("event_type = 'click'").select(F.col("event_id").alias("id"), F.lit("no day").alias("error")))


@query(f"WITH {VENUES}, e AS (SELECT *, CASE WHEN {INSIDE} THEN 'Seattle' END AS in_city, {DISTRICT} AS district FROM venues) SELECT id, coalesce(in_city, city) AS city, coalesce(district, 'none') AS neighborhood FROM e")
def enriched_venue_fields(spark, d):
    v = Tables(spark, d).venues.withColumn("neighborhood", F.lit("none")).withColumn("quality_score", F.lit(0.9))
    return catalog.with_enrichment(enrichment.enrich(v, "venue", "lat", "lng")).select("id", "city", "neighborhood")


_CHANGED = f"{SHOWS}, n AS (SELECT id, CASE WHEN id % 4 = 0 THEN title || '!' ELSE title END AS title, CASE WHEN id % 6 = 0 THEN '20:00:00' END AS start_time FROM shows)"


@query(f"WITH {_CHANGED} SELECT n.id, CASE WHEN n.id % 5 = 0 THEN 'CREATE' WHEN n.id % 4 = 0 OR n.id % 6 = 0 THEN 'UPDATE' ELSE 'NO_CHANGE' END AS change_type, CASE WHEN n.id % 5 = 0 THEN '' ELSE concat_ws(',', CASE WHEN n.id % 4 = 0 THEN 'title' END, CASE WHEN n.id % 6 = 0 THEN 'start_time' END) END AS fields FROM n")
def handler_candidates(spark, d):
    """The event handler's comparison of resolved events with the stored ones, by its six fields."""
    null = F.lit(None).cast("string")
    events = Tables(spark, d).shows.select("id", "title", "event_day", null.alias("start_time"), null.alias("event_url"), null.alias("description"), null.alias("event_image_url"))
    new = events.withColumn("title", F.when(F.col("id") % 4 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title"))).withColumn("start_time", F.when(F.col("id") % 6 == 0, "20:00:00"))
    found = catalog.HANDLERS["event"].candidates(events.where("id % 5 <> 0"), new)
    return found.select("id", "change_type", F.coalesce(F.array_join(F.transform("changes", lambda c: c["field"]), ","), F.lit("")).alias("fields"))


@query(f"WITH {_CHANGED} SELECT id, title, start_time FROM n")
def handler_persists(spark, d):
    null = F.lit(None).cast("string")
    events = Tables(spark, d).shows.select("id", "title", null.alias("start_time"))
    new = events.withColumn("title", F.when(F.col("id") % 4 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title"))).withColumn("start_time", F.when(F.col("id") % 6 == 0, "20:00:00"))
    return catalog.HANDLERS["event"].persist(events.where("id % 5 <> 0"), new)


@query("SELECT o_orderkey AS id, o_orderkey % 3 = 0 OR o_orderkey % 7 = 0 AS changed FROM orders")
def legacy_event_update(spark, d):
    """The archived test of an event update looks at five fields; a changed title alone is none."""
    null = F.lit(None).cast("string")
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("id"), F.lit("t").alias("title"), null.alias("start_time"), F.lit("u").alias("event_url"), null.alias("description"), null.alias("event_image_url"), F.array(F.col("o_custkey")).alias("artist_ids"))
    k = F.col("id")
    new = o.withColumn("title", F.lit("other")).withColumn("event_url", F.when(k % 3 == 0, "v").otherwise(F.col("event_url"))).withColumn("artist_ids", F.when(k % 7 == 0, F.array()).otherwise(F.col("artist_ids")))
    return catalog.prepare(o, new, "id", catalog.LEGACY_EVENT_FIELDS).select("id", (F.col("change_type") == "UPDATE").alias("changed"))


# Lookups


@query(BASE + "SELECT min(id) AS id, 'red bolt' AS name FROM artists WHERE lower(name) = 'red bolt' HAVING count(*) > 0")
def artist_lookup_ci(spark, d):
    return Tables(spark, d).listings().artist_by_name("RED Bolt").select("id", F.lower("name").alias("name"))


@query(BASE + "SELECT id, name FROM artists WHERE replace(lower(name), ' ', '-') = 'red-bolt'")
def artists_by_slug(spark, d):
    t = Tables(spark, d)
    return listings.Listings(t.venues, t.artists.withColumn("name_slug", T.slug(F.col("name"))), t.shows).artist_by_slug("red-bolt").select("id", "name")


@query(BASE + "SELECT id, name FROM venues WHERE id IN (4, 8, 15)")
def venues_by_ids(spark, d):
    return Tables(spark, d).listings().venues_by_ids([15, 4, -1, 8]).select("id", "name")


@query(BASE + "SELECT id, name FROM venues WHERE name = 'Customer#000000012'")
def venue_page_by_slug(spark, d):
    return Tables(spark, d).listings().venue_by_slug("customer-000000012").select("id", "name")


@query(BASE + "SELECT id, title, event_day FROM shows ORDER BY event_day, id LIMIT 20 OFFSET 40")
def events_web_page(spark, d):
    return listings.web_page(Tables(spark, d).listings().all_events(), 2).select("id", "title", "event_day")


@query("SELECT event_id AS id FROM events WHERE event_type = 'view'")
def nodes_by_label(spark, d):
    return registry.nodes_of(Tables(spark, d).events.select(F.col("event_id").alias("id"), F.col("event_type").alias("label")), "view").select("id")


@query("SELECT CAST(event_id AS VARCHAR) AS envelope_id, user_id FROM events WHERE event_id = 77")
def log_point_lookup(spark, d):
    return registry.find_envelope(Tables(spark, d).events.select(F.col("event_id").cast("string").alias("envelope_id"), "user_id"), "77")


@query("""WITH n AS (SELECT event_id AS id, event_id % 2 = 0 AS p, event_id % 3 = 0 AS m, event_id % 5 = 0 AS q, event_id % 7 = 0 AS out FROM events WHERE event_type = 'click')
SELECT 'unprocessed_raw_data' AS view, count_if(NOT p) AS n FROM n UNION ALL SELECT 'unnormalized_raw_data', count_if(NOT m) FROM n UNION ALL SELECT 'unchecked_quality', count_if(m AND NOT q) FROM n UNION ALL SELECT 'quarantined', count_if(out) FROM n""")
def status_views(spark, d):
    k, at = F.col("event_id"), F.lit(NOW).cast("timestamp")
    some = lambda n: F.when(k % n == 0, at)
    nodes = Tables(spark, d).events.select(k.alias("id"), F.when(F.col("event_type") == "click", "raw_data").otherwise("venue").alias("label"), some(2).alias("processed_at"), some(3).alias("normalized_at"), some(5).alias("quality_checked_at"), F.when(k % 7 == 0, "Quarantine").alias("quality_decision"))
    registry.status_views(nodes)
    return spark.sql(" UNION ALL ".join(f"SELECT '{v}' AS view, count(*) AS n FROM {v}" for v in ("unprocessed_raw_data", "unnormalized_raw_data", "unchecked_quality", "quarantined")))


# Ingest log


@query("""SELECT page_id, concat_ws(',', CASE WHEN page_id % 2 = 0 THEN 'envelope_version' END, CASE WHEN page_id % 3 = 0 THEN 'source_id' END, CASE WHEN page_id % 5 = 0 THEN 'idempotency_key' END, CASE WHEN page_id % 7 = 0 THEN 'size_bytes' END, CASE WHEN page_id % 11 = 0 THEN 'sha256' END,
CASE WHEN page_id % 13 = 0 THEN 'url' END, CASE WHEN page_id % 17 = 0 THEN 'status' END, CASE WHEN page_id % 19 = 0 THEN 'fetched_at' END) AS faults FROM pages""")
def envelope_validation(spark, d):
    k = F.col("page_id")
    e = Tables(spark, d).pages.select(
        "page_id", F.when(k % 2 != 0, "1.0.0").otherwise("2").alias("envelope_version"), F.when(k % 3 != 0, "kexp").otherwise("x").alias("source_id"), F.when(k % 5 != 0, F.sha2("url", 256)).alias("idempotency_key"), F.lit("text/html").alias("mime_type"), F.when(k % 7 != 0, F.octet_length("html")).otherwise(-1).alias("size_bytes"),
        F.when(k % 11 != 0, F.sha2("html", 256)).otherwise("NOTAHEX").alias("sha256"), F.when(k % 13 != 0, F.col("url")).alias("url"), F.when(k % 17 == 0, 99).when(k % 4 == 0, 200).alias("status"), F.when(k % 19 != 0, F.lit(NOW).cast("timestamp")).alias("fetched_at"),
    )
    return ingest.envelope_faults(e).select("page_id", F.array_join("faults", ",").alias("faults"))


@query("SELECT event_id AS id, CASE WHEN user_id % 5 = 0 THEN 'missing field' WHEN event_type <> 'click' THEN 'other source' WHEN user_id % 3 = 0 THEN 'no payload' END AS reason FROM events")
def wanted_log_lines(spark, d):
    u = F.col("user_id")
    log = Tables(spark, d).events.select(F.col("event_id").alias("id"), F.col("event_type").alias("source_id"), F.when(u % 5 != 0, F.col("event_id")).alias("envelope_id"), F.when(u % 3 != 0, "r").alias("payload_ref"))
    return ingest.wanted_lines(log, "click").select("id", "reason")


_FIRST = "SELECT regexp_extract(url, '//([^/]+)', 1) AS idempotency_key, CAST({0}(page_id) AS VARCHAR) AS envelope_id FROM pages GROUP BY 1"


def _index(spark, d, bypass: bool) -> DataFrame:
    log = Tables(spark, d).pages.select(F.col("page_id").cast("string").alias("envelope_id"), F.timestamp_seconds("page_id").alias("accepted_at"), F.regexp_extract("url", "//([^/]+)", 1).alias("idempotency_key"))
    return ingest.dedupe_index(log, bypass)


@query(_FIRST.format("min"))
def dedupe_index(spark, d):
    return _index(spark, d, False)


@query(_FIRST.format("max"))
def dedupe_index_bypassed(spark, d):
    return _index(spark, d, True)


@query("SELECT * FROM (VALUES ('a', CAST(34 AS BIGINT)), ('b', CAST(0 AS BIGINT))) t(consumer, pos)")
def acknowledged_offset(spark, d):
    log = Tables(spark, d).pages.select(F.col("page_id").alias("pos"), F.col("page_id").cast("string").alias("envelope_id"))
    offsets = spark.createDataFrame([("a", 5), ("b", 0)], "consumer string, pos long")
    return ingest.acknowledge(log, ingest.acknowledge(log, offsets, "a", "33"), "b", "no such envelope")


@query("""SELECT CAST(w AS TIMESTAMP) AS window_start, event_type AS name, count(*) AS n, round(sum(value), 6) AS total FROM (SELECT *, unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS w FROM events) GROUP BY 1, 2""")
def windowed_totals(spark, d):
    e = Tables(spark, d).events.select(F.col("event_type").alias("name"), "ts", "value")
    return windowed_rate(e).select(F.col("w.start").alias("window_start"), "name", "n", F.round("total", 6).alias("total"))


@query("SELECT count(*) AS n FROM events")
def observed_phase(spark, d):
    return metrics.observed(Tables(spark, d).events, "parse").agg(F.count("*").alias("n"))


# Functions on text


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'Act ' || o_orderkey WHEN o_orderkey % 4 = 1 THEN '' WHEN o_orderkey % 4 = 2 THEN 'One|Two' ELSE 'Solo' END AS artists,
CASE WHEN o_orderkey % 8 = 4 THEN 'broadcast only' WHEN o_orderkey % 4 = 3 AND o_orderkey % 3 = 0 THEN 'book reading' END AS skipped FROM orders""")
def title_artists(spark, d):
    k = F.col("o_orderkey")
    x = F.concat(F.lit("Act "), k, F.lit(" LIVE on KEXP"), F.when(k % 8 == 0, " (OPEN TO THE PUBLIC)").otherwise(""))
    t = F.when(k % 4 == 0, x).when(k % 4 == 1, "X LIVE on KEXP (open to the public)").when(k % 4 == 2, "One / Two, The Show & Y").otherwise(F.when(k % 3 == 0, F.lit("Solo + Book Reading concert")).otherwise("Solo"))
    return Tables(spark, d).orders.select(k.alias("id"), F.array_join(T.title_artists(t), "|").alias("artists"), T.skip_reason(t).alias("skipped"))


@query(r"""SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN p_name || '|Guest' WHEN 2 THEN p_name || '|Guest' WHEN 3 THEN '' ELSE p_name END AS artists, CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE p_name END AS title, CASE p_partkey % 3 WHEN 0 THEN 'https://o.example/x' ELSE 'http://y.example' END AS url,
'a & b <c> "d" ''e'' f’g–h' AS html, 'say "x" a/b' || chr(10) || 'c' AS json, sha256(lower(p_name) || '||' || CAST(p_partkey * 1000 AS VARCHAR)) AS signature FROM part""")
def odd_text_functions(spark, d):
    n, k = F.col("p_name"), F.col("p_partkey") % 5
    legacy = F.when(k == 0, F.lit("Open Mic with Friends")).when(k == 1, F.concat(n, F.lit(" With Guest"))).when(k == 2, F.concat(n, F.lit(" & Guest"))).when(k == 3, F.lit("Dance Party")).otherwise(F.concat(n, F.lit(" ")))
    return Tables(spark, d).part.select(
        F.col("p_partkey").alias("id"), F.array_join(T.legacy_title_artists(legacy), "|").alias("artists"), T.title_or_null(F.when(k == 3, F.lit("  ")).otherwise(F.concat(F.lit(" "), n))).alias("title"),
        T.absolute_url(F.when(F.col("p_partkey") % 3 == 0, "/x").otherwise("http://y.example"), "https://o.example").alias("url"), T.unescape_html(F.lit("a &amp; b &lt;c&gt; &quot;d&quot; &#39;e&#39; f&#8217;g&#8211;h")).alias("html"),
        T.unescape_json(F.lit('say \\"x\\" a\\/b\\nc')).alias("json"), T.dedup_signature(F.upper("p_name"), F.lit(None).cast("string"), lat=F.col("p_partkey") / 10.0).alias("signature"),
    )


@query(f"""SELECT o_orderkey AS id, CAST(try_strptime(CASE WHEN month(o_orderdate) < 11 THEN '2000' ELSE '1999' END || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d') AS DATE) AS rolled,
CAST(CASE WHEN strftime(o_orderdate, '%m-%d') < '06-01' THEN try_strptime('2000' || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d') ELSE try_strptime('1999' || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d') END AS DATE) AS ordinal,
CAST(try_strptime('1999' || strftime(o_orderdate, '-%m-%d'), '%Y-%m-%d') AS DATE) AS weekday, CAST(month(o_orderdate) AS INT) AS month FROM orders WHERE strftime(o_orderdate, '%m-%d') <> '02-29'""")
def listing_dates(spark, d):
    day = F.col("o_orderdate")
    late = F.lit("1999-11-05").cast("date")
    some = F.concat(F.date_format(day, "MMM d"), F.when(F.dayofmonth(day) == 1, "st").when(F.dayofmonth(day) == 2, "nd").otherwise("th"))
    orders = Tables(spark, d).orders.where(F.date_format(day, "MM-dd") != "02-29")  # a day that these years lack
    return orders.select(F.col("o_orderkey").alias("id"), T.day_of_year_roll(F.month(day), F.dayofmonth(day), late).alias("rolled"), T.ordinal_day(some, today()).alias("ordinal"), T.weekday_day(F.concat(F.lit("friday "), F.date_format(day, "MM.dd")), today()).alias("weekday"), T.month_number(F.date_format(day, "MMMM")).alias("month"))


# Assessments and resolution


@query("""SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'Quarantine' WHEN 1 THEN 'AcceptWithWarnings' ELSE 'Accept' END AS decision, round(CASE p_partkey % 4 WHEN 0 THEN 6e-1 WHEN 1 THEN 85e-2 ELSE 9e-1 END, 6) AS score, 6e-1 AS confidence, 'Unknown' AS density, CAST(1 AS INT) AS n_warnings FROM part""")
def quality_and_enrichment_of_artists(spark, d):
    k = F.col("p_partkey") % 4
    a = Tables(spark, d).part.select(F.col("p_partkey").alias("id"), F.when(k == 0, " ").when(k == 1, "X").otherwise(F.col("p_name")).alias("name"), F.lit(0.9).alias("confidence"))
    e = enrichment.enrich(quality.assess(a, quality.artist_issues(F.col("name"))), "artist")
    return e.select("id", "decision", F.round("quality_score", 6).alias("score"), F.col("enrichment_confidence").alias("confidence"), "density", F.size("enrichment_warnings").alias("n_warnings"))


def _places(spark, d) -> tuple[DataFrame, DataFrame]:
    """Customers as venues that were read, suppliers as known ones: every second supplier has the name and the place of a
    customer, every third the place alone."""
    t = Tables(spark, d)
    null = lambda kind: F.lit(None).cast(kind)
    lat = lambda k: (F.lit(40.0) + k * 0.0021).alias("latitude")
    row = lambda df, k, name, shift, street: df.select(k.alias("id"), F.lit("venue").alias("entity_type"), name.alias("name"), (F.lit(40.0) + k * 0.0021 + shift).alias("latitude"), F.lit(-100.0).alias("longitude"), street.alias("address"), null("date").alias("event_day"), null("bigint").alias("venue_id"))
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    read = row(t.customer, c, F.concat(F.lit("Hall-No "), c), F.lit(0.0), F.concat(c, F.lit(" Main Street")))
    known = row(t.supplier, s, F.when(s % 2 == 0, F.concat(F.lit("hall_no "), s)).otherwise(F.concat(F.lit("Bar "), s)), F.when(s % 3 == 0, 0.0002).otherwise(0.5), F.when(s % 5 != 0, F.concat(s, F.lit(" main street"))))
    return read, known


_PLACES = """WITH r AS (SELECT c_custkey AS id, 4e1 + c_custkey * 21e-4 AS lat, c_custkey || ' main street' AS street FROM customer),
k AS (SELECT s_suppkey AS id, s_suppkey % 2 = 0 AS named, 4e1 + s_suppkey * 21e-4 + CASE WHEN s_suppkey % 3 = 0 THEN 2e-4 ELSE 5e-1 END AS lat, CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey || ' main street' END AS street FROM supplier),
pairs AS (SELECT r.id, k.id AS known_id, k.named, sqrt((r.lat - k.lat) * 111 * ((r.lat - k.lat) * 111)) AS km, round(r.lat * 1000) = round(k.lat * 1000) AS near,
  CASE WHEN k.street IS NULL THEN 0e0 ELSE len(list_intersect(string_split(r.street, ' '), string_split(k.street, ' '))) / CAST(len(list_distinct(list_concat(string_split(r.street, ' '), string_split(k.street, ' ')))) AS DOUBLE) END AS street FROM r JOIN k ON (k.named AND r.id = k.id) OR round(r.lat * 1000) = round(k.lat * 1000)),
scored AS (SELECT id, known_id, named AND id = known_id AS by_name, CASE WHEN named AND id = known_id THEN 4e-1 WHEN named THEN 2e-1 WHEN id = known_id THEN 1e-1 ELSE 0 END + CASE WHEN km <= 1e-1 THEN 4e-1 * (1 - km / 1e-1) ELSE 0 END + 2e-1 * street AS score FROM pairs)
SELECT id, known_id, round(score, 6) AS score FROM scored WHERE score > CASE WHEN by_name THEN 3e-1 ELSE 5e-1 END"""


@query(_PLACES)
def venue_candidates(spark, d):
    """Candidates by equal name or location cell, with the venue similarity of name, place and address."""
    found = conflation.candidates(*_places(spark, d))
    return found.select(F.col("r_id").alias("id"), F.col("c_id").alias("known_id"), F.round("score", 6).alias("score"))


@query("""WITH r AS (SELECT p_partkey AS id, p_partkey // 40 AS g, p_name FROM part), k AS (SELECT * FROM r WHERE id IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49))
SELECT r.id, count(k.id) AS n_matches, min(k.id) AS canonical_id FROM r LEFT JOIN k ON lower(r.p_name) = lower(k.p_name) AND r.g = k.g GROUP BY 1""")
def artist_resolution(spark, d):
    """Artists by equal compared names, which is a similarity of 1; other kinds never match."""
    t = Tables(spark, d)
    null = lambda kind: F.lit(None).cast(kind)
    a = t.part.select(F.col("p_partkey").alias("id"), F.lit("artist").alias("entity_type"), F.concat("p_name", F.lit("_"), F.expr("p_partkey div 40")).alias("name"), null("double").alias("latitude"), null("double").alias("longitude"), null("string").alias("address"), null("date").alias("event_day"), null("bigint").alias("venue_id"))
    large = t.lineitem.where("l_quantity >= 49").select(F.col("l_partkey").alias("id"))
    known = a.join(large, "id", "left_semi").withColumn("name", F.replace(F.upper("name"), F.lit("_"), F.lit("-")))
    found = conflation.resolve(a, known.unionByName(known.withColumn("entity_type", F.lit("event"))))
    return found.select("id", F.col("n_matches").alias("n_matches"), F.when(F.col("resolution") == "MatchedExisting", F.col("canonical_id")).alias("canonical_id"))

"""Queries over the harness tables, one for each operator, each with the SQL that must give the same rows.

Roles: orders are events, customer and supplier venues, part artists, lineitem who performs where, documents and labels
records to assess, pages payloads, events metric samples, conversations ordered rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagelight.functions import geo
from stagelight.functions import text as T
from stagelight.operators import catalog, conflation, enrichment, ingest, listings, metrics, quality
from stagelight.shipping import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
AS_OF = date(1999, 6, 1)


def today() -> Column:
    return F.lit(AS_OF.isoformat()).cast("date")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


class Tables:
    """Harness tables in their roles."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def shows(self) -> DataFrame:
        return self.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), F.to_date("o_orderdate").alias("event_day"), F.col("o_custkey").alias("venue_id"))

    @property
    def venues(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.customer.select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"), (F.lit(47.4) + k % 40 * F.lit(0.01)).alias("lat"), (F.lit(-122.5) + k % 37 * F.lit(0.01)).alias("lng"))

    @property
    def artists(self) -> DataFrame:
        return self.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))

    @property
    def acts(self) -> DataFrame:
        return self.lineitem.select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("artist_id")).distinct()

    @property
    def hosts(self) -> DataFrame:
        return self.orders.select(F.col("o_custkey").alias("venue_id"), F.col("o_orderkey").alias("event_id"))

    @property
    def edges(self) -> DataFrame:
        hosts = self.hosts.select(F.col("venue_id").alias("source_id"), F.col("event_id").alias("target_id"), F.lit("hosts").alias("relation"))
        return hosts.unionByName(self.acts.select(F.col("artist_id").alias("source_id"), F.col("event_id").alias("target_id"), F.lit("performs_at").alias("relation")))

    def listings(self, edges: bool = False) -> listings.Listings:
        return listings.Listings(self.venues, self.artists, self.shows, self.edges if edges else None, AS_OF)


SHOWS = "shows AS (SELECT o_orderkey AS id, o_orderpriority AS title, CAST(o_orderdate AS DATE) AS event_day, o_custkey AS venue_id FROM orders)"
VENUES = "venues AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS city, 4.74e1 + c_custkey % 40 * 1e-2 AS lat, -1.225e2 + c_custkey % 37 * 1e-2 AS lng FROM customer)"
ARTISTS = "artists AS (SELECT p_partkey AS id, p_name AS name FROM part)"
ACTS = "acts AS (SELECT DISTINCT l_orderkey AS event_id, l_partkey AS artist_id FROM lineitem)"
HOSTS = "hosts AS (SELECT o_custkey AS venue_id, o_orderkey AS event_id FROM orders)"
BASE = f"WITH {SHOWS}, {VENUES}, {ARTISTS}, {ACTS}, {HOSTS} "
DAY = "DATE '1999-06-01'"

# Questions about listings


@query(BASE + f"SELECT * FROM shows WHERE event_day >= {DAY} ORDER BY event_day, id LIMIT 50 OFFSET 20")
def events_future_page(spark, d):
    return Tables(spark, d).listings().events(50, 20)


@query(BASE + "SELECT * FROM shows ORDER BY event_day, id LIMIT 40 OFFSET 10")
def events_all_page(spark, d):
    return Tables(spark, d).listings().all_events(40, 10)


@query(BASE + f"SELECT * FROM shows WHERE event_day BETWEEN {DAY} AND {DAY} + 30")
def events_upcoming(spark, d):
    return Tables(spark, d).listings().upcoming_events(30)


@query(BASE + "SELECT * FROM shows WHERE event_day BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'")
def events_date_range(spark, d):
    return Tables(spark, d).listings().events_by_date_range(date(1998, 1, 1), date(1998, 3, 31))


@query(BASE + f"SELECT * FROM shows WHERE event_day >= {DAY} AND contains(lower(title), 'high') AND venue_id IN (SELECT id FROM venues WHERE contains(lower(name), '00001')) ORDER BY event_day, id LIMIT 100 OFFSET 5")
def search_events_by_venue(spark, d):
    return Tables(spark, d).listings().search_events("High", "00001", 100, 5).select("id", "title", "event_day", "venue_id")


@query(BASE + f"SELECT * FROM shows WHERE venue_id = 11 AND event_day >= {DAY}")
def events_by_venue(spark, d):
    return Tables(spark, d).listings().events_by_venue(11)


@query(BASE + "SELECT * FROM shows WHERE id = 42")
def event_by_id(spark, d):
    return Tables(spark, d).listings().event(42)


@query(BASE + "SELECT id, name, city FROM venues WHERE id = 7")
def venue_by_id(spark, d):
    return Tables(spark, d).listings().venue(7).select("id", "name", "city")


@query(BASE + "SELECT * FROM artists WHERE id = 7")
def artist_by_id(spark, d):
    return Tables(spark, d).listings().artist(7)


@query(BASE + "SELECT id, name, city FROM venues ORDER BY name, id LIMIT 20 OFFSET 10")
def venues_page(spark, d):
    return Tables(spark, d).listings().venues(20, 10).select("id", "name", "city")


@query(BASE + "SELECT * FROM artists ORDER BY name, id LIMIT 20 OFFSET 30")
def artists_page(spark, d):
    return Tables(spark, d).listings().artists(20, 30)


@query(BASE + "SELECT id, name, city FROM venues WHERE lower(city) = 'building'")
def venues_by_city(spark, d):
    return Tables(spark, d).listings().venues_by_city("Building").select("id", "name", "city")


@query(BASE + "SELECT id, name, city FROM venues WHERE lower(name) = 'customer#000000012' ORDER BY id LIMIT 1")
def venue_lookup_ci(spark, d):
    return Tables(spark, d).listings().venue_by_name("CUSTOMER#000000012").select("id", "name", "city")


@query(BASE + "SELECT * FROM artists WHERE contains(lower(name), 'red')")
def search_artists(spark, d):
    return Tables(spark, d).listings().search_artists("Red")


@query(BASE + "SELECT * FROM artists WHERE id IN (9, 3, 27)")
def artists_by_ids(spark, d):
    return Tables(spark, d).listings().artists_by_ids([9, 3, 27, -5])


@query(BASE + "SELECT * FROM shows WHERE venue_id = 11 AND lower(title) = '5-low' AND event_day = (SELECT min(event_day) FROM shows WHERE venue_id = 11 AND lower(title) = '5-low') ORDER BY id LIMIT 1")
def event_composite_key(spark, d):
    t = Tables(spark, d)
    first = t.shows.where("venue_id = 11 and lower(title) = '5-low'").agg(F.min("event_day").alias("day"))
    return t.listings().event_by_venue_day_title(11, first.head()["day"], "5-Low")


@query(BASE + "SELECT s.*, v.name AS venue_name FROM shows s LEFT JOIN venues v ON v.id = s.venue_id")
def event_with_venue(spark, d):
    t = Tables(spark, d)
    return listings.event_with_venue(t.shows, t.venues)


@query("SELECT l_orderkey AS id, string_agg(p_name, '|' ORDER BY l_linenumber, l_partkey) AS artists FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey GROUP BY 1")
def event_with_artists(spark, d):
    t = Tables(spark, d)
    listed = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").distinct().groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda s: s["l_partkey"]).alias("artist_ids"))
    return listings.event_artists(listed, t.artists).select("id", F.array_join("artists", "|").alias("artists"))


@query(BASE + "SELECT s.* FROM shows s JOIN hosts h ON h.event_id = s.id WHERE h.venue_id = 25")
def events_by_venue_via_edges(spark, d):
    return Tables(spark, d).listings(True).venue_events(25)


@query(BASE + "SELECT s.* FROM shows s JOIN acts a ON a.event_id = s.id WHERE a.artist_id = 25")
def events_by_artist(spark, d):
    return Tables(spark, d).listings(True).artist_events(25)


@query(BASE + "SELECT venue_id AS source_id, event_id AS target_id, 'hosts' AS relation FROM hosts WHERE venue_id = 30 OR event_id = 30 UNION ALL SELECT artist_id, event_id, 'performs_at' FROM acts WHERE artist_id = 30 OR event_id = 30")
def incident_edges(spark, d):
    return Tables(spark, d).listings(True).incident_edges(30)


@query(BASE + "SELECT venue_id AS source_id, event_id AS target_id, 'hosts' AS relation FROM hosts UNION ALL SELECT artist_id, event_id, 'performs_at' FROM acts")
def event_edges(spark, d):
    t = Tables(spark, d)
    lists = t.acts.groupBy("event_id").agg(F.collect_list("artist_id").alias("artist_ids"))
    with_lists = t.shows.join(lists, F.col("id") == F.col("event_id"), "left").drop("event_id")
    loose = t.acts.join(t.shows, F.col("event_id") == F.col("id"), "left_anti").select(F.col("artist_id").alias("source_id"), F.col("event_id").alias("target_id"), F.lit("performs_at").alias("relation"))
    return catalog.event_edges(with_lists).unionByName(loose)


@query(BASE + "SELECT count(*) AS n_deleted FROM shows WHERE venue_id IN (SELECT id FROM venues WHERE lower(name) = 'customer#000000025')")
def delete_by_venue_count(spark, d):
    return Tables(spark, d).listings().delete_events_by_venue_name("customer#000000025")[1]


@query(BASE + "SELECT * FROM shows WHERE venue_id NOT IN (SELECT id FROM venues WHERE lower(name) = 'customer#000000025')")
def delete_by_venue(spark, d):
    return Tables(spark, d).listings().delete_events_by_venue_name("customer#000000025")[0].select("id", "title", "event_day", "venue_id")


@query(BASE + "SELECT * FROM shows WHERE id <> 42")
def delete_event(spark, d):
    return Tables(spark, d).listings().delete_event(42)[0]


# Graph


PLACED = "placed AS (SELECT DISTINCT artist_id, venue_id FROM acts JOIN hosts USING (event_id))"


@query(BASE.rstrip() + f", {PLACED} SELECT DISTINCT artist_id FROM placed WHERE venue_id = 25 AND artist_id IN (SELECT artist_id FROM placed WHERE venue_id <> 25)")
def shared_artists_two_hop(spark, d):
    t = Tables(spark, d)
    return catalog.shared_artists(t.hosts, t.acts, 25)


@query(BASE + "SELECT 'v' || venue_id AS source_id, 'e' || event_id AS target_id, 'hosts' AS relation FROM hosts WHERE venue_id % 10 = 3 OR event_id % 10 = 4")
def orphan_edges(spark, d):
    t = Tables(spark, d)
    edges = t.hosts.select(F.concat(F.lit("v"), "venue_id").alias("source_id"), F.concat(F.lit("e"), "event_id").alias("target_id"), F.lit("hosts").alias("relation"))
    nodes = t.venues.where("id % 10 <> 3").select(F.concat(F.lit("v"), "id").alias("id")).unionByName(t.shows.where("id % 10 <> 4").select(F.concat(F.lit("e"), "id").alias("id")))
    return catalog.orphan_edges(edges, nodes)


@query("SELECT s_suppkey AS source_id, n AS target_id, 'near' AS relation FROM (SELECT s_suppkey, s_suppkey + 7 AS n FROM supplier) WHERE n NOT IN (SELECT s_suppkey FROM supplier)")
def orphan_edges_one_label(spark, d):
    s = Tables(spark, d).supplier.select(F.col("s_suppkey").alias("id"))
    return catalog.orphan_edges(s.select(F.col("id").alias("source_id"), (F.col("id") + 7).alias("target_id"), F.lit("near").alias("relation")), s)


@query(BASE.rstrip() + ", here AS (SELECT event_id FROM hosts WHERE venue_id % 97 <> 0) SELECT DISTINCT artist_id FROM acts WHERE event_id IN (SELECT event_id FROM here) AND artist_id NOT IN (SELECT artist_id FROM acts WHERE event_id NOT IN (SELECT event_id FROM here))")
def exclusive_artist_cascade(spark, d):
    t = Tables(spark, d)
    return catalog.exclusive_artists(t.hosts, t.acts, t.venues.where("id % 97 <> 0"))


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 4 <> 0")
def drop_nodes(spark, d):
    t = Tables(spark, d)
    nodes = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return catalog.drop_nodes(nodes, t.edges, nodes.where("id % 4 = 0"))[0]


@query(BASE + "SELECT relation, count(*) AS n FROM (SELECT 'hosts' AS relation FROM hosts UNION ALL SELECT 'performs_at' FROM acts) GROUP BY 1")
def label_counts(spark, d):
    return catalog.label_counts(Tables(spark, d).edges, "relation")


@query("SELECT DISTINCT l_partkey AS artist_id FROM lineitem")
def distinct_artists(spark, d):
    return catalog.distinct_ends(Tables(spark, d).acts, "artist_id")


# Change detection and merges


def _versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 7 != 0, F.concat(F.lit("Street "), F.col("s_suppkey"))).alias("address"), F.col("s_acctbal").alias("latitude"))
    old = s.where("id % 5 <> 0")
    new = s.where("id % 2 = 0").withColumn("name", F.when(F.col("id") % 3 == 0, F.upper("name")).otherwise(F.col("name"))).withColumn("address", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("address")))
    return old, new


VERSIONS = """WITH s AS (SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 7 <> 0 THEN 'Street ' || s_suppkey END AS address, s_acctbal AS latitude FROM supplier),
old AS (SELECT * FROM s WHERE id % 5 <> 0),
new AS (SELECT id, CASE WHEN id % 3 = 0 THEN upper(name) ELSE name END AS name, CASE WHEN id % 4 = 0 THEN NULL ELSE address END AS address, latitude FROM s WHERE id % 2 = 0),
prepared AS (SELECT n.id, CASE WHEN o.id IS NULL THEN 'CREATE' WHEN o.name IS DISTINCT FROM n.name OR o.address IS DISTINCT FROM n.address OR o.latitude IS DISTINCT FROM n.latitude THEN 'UPDATE' ELSE 'NO_CHANGE' END AS change_type,
  CASE WHEN o.id IS NULL THEN '' ELSE concat_ws(', ', CASE WHEN o.name IS DISTINCT FROM n.name THEN 'name' END, CASE WHEN o.address IS DISTINCT FROM n.address THEN 'address' END, CASE WHEN o.latitude IS DISTINCT FROM n.latitude THEN 'latitude' END) END AS field_changed
  FROM new n LEFT JOIN old o USING (id)) """
_FIELDS = ("name", "address", "latitude")


@query(VERSIONS + "SELECT id, change_type FROM prepared")
def change_detection(spark, d):
    return catalog.prepare(*_versions(Tables(spark, d)), "id", _FIELDS).select("id", "change_type")


@query(VERSIONS + "SELECT id, change_type, field_changed FROM prepared WHERE change_type <> 'NO_CHANGE'")
def audit_log(spark, d):
    return catalog.audit(catalog.prepare(*_versions(Tables(spark, d)), "id", _FIELDS), "id")


@query(VERSIONS + "SELECT change_type, count(*) AS n FROM prepared GROUP BY 1")
def catalog_run_stats(spark, d):
    return catalog.run_statistics(catalog.prepare(*_versions(Tables(spark, d)), "id", _FIELDS))


@query(VERSIONS + "SELECT coalesce(n.id, o.id) AS id, CASE WHEN n.id IS NULL THEN o.name ELSE n.name END AS name, CASE WHEN n.id IS NULL THEN o.address ELSE n.address END AS address, coalesce(n.latitude, o.latitude) AS latitude FROM old o FULL JOIN new n ON o.id = n.id")
def upsert_merge(spark, d):
    old, new = _versions(Tables(spark, d))
    return catalog.upsert(old, new, ["id"])


@query("SELECT DISTINCT o_custkey AS source_id, o_orderstatus AS target_id, 'is' AS relation FROM orders")
def upsert_edges(spark, d):
    e = Tables(spark, d).orders.select(F.col("o_custkey").alias("source_id"), F.col("o_orderstatus").alias("target_id"), F.lit("is").alias("relation")).distinct()
    return catalog.upsert_edges(e.where("source_id % 2 = 0"), e.where("source_id % 3 <> 0 or source_id % 2 <> 0"))


@query("SELECT event_id AS id, event_id % 3 = 0 OR event_id % 10 = 0 AS processed FROM events")
def mark_processed(spark, d):
    raw = Tables(spark, d).events.select(F.col("event_id").alias("id"), (F.col("event_id") % 3 == 0).alias("processed"))
    return catalog.mark_processed(raw, raw.where("id % 10 = 0"))


@query("SELECT event_id AS id, event_type AS api_name, CAST(ts AS DATE) AS event_day FROM events WHERE event_type = 'click' AND event_id % 3 <> 0 AND CAST(ts AS DATE) >= DATE '2024-01-10'")
def unprocessed_raw(spark, d):
    raw = Tables(spark, d).events.select(F.col("event_id").alias("id"), F.col("event_type").alias("api_name"), F.to_date("ts").alias("event_day"), (F.col("event_id") % 3 == 0).alias("processed"))
    return listings.unprocessed(raw, "click", since=date(2024, 1, 10)).drop("processed")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def most_recent_raw(spark, d):
    return listings.most_recent(Tables(spark, d).events, ["user_id"], "ts", "event_id").select("user_id", "event_id")


@query("SELECT l_suppkey AS source_id, l_partkey AS name_slug, min(l_orderkey) AS first_seen FROM lineitem GROUP BY 1, 2")
def first_only_artist(spark, d):
    rows = Tables(spark, d).lineitem.select(F.col("l_suppkey").alias("source_id"), F.col("l_partkey").alias("name_slug"), F.col("l_orderkey").alias("first_seen"), "l_linenumber")
    return catalog.first_of(rows, ["source_id", "name_slug"], "first_seen", "l_linenumber").drop("l_linenumber")


@query("SELECT event_type AS source_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) = 1")
def first_only_venue(spark, d):
    return catalog.first_of(Tables(spark, d).events.select(F.col("event_type").alias("source_id"), "event_id", "ts"), ["source_id"], "ts", "event_id").drop("ts")


@query(BASE + f"""SELECT (SELECT count(*) FROM shows) AS n_events, (SELECT count(DISTINCT venue_id) FROM shows) AS n_venues, (SELECT count(*) FROM shows WHERE event_day - {DAY} > 365) AS n_future,
(SELECT count(*) FROM shows WHERE event_day - {DAY} < -30) AS n_past, (SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM shows GROUP BY venue_id, event_day)) AS n_repeated, (SELECT count(DISTINCT artist_id) FROM acts WHERE event_id IN (SELECT id FROM shows)) AS n_artists""")
def catalog_validation(spark, d):
    t = Tables(spark, d)
    lists = t.acts.groupBy("event_id").agg(F.collect_list("artist_id").alias("artist_ids"))
    return catalog.validation(t.shows.join(lists, F.col("id") == F.col("event_id"), "left"), today())


@query("SELECT p_type AS name, min(p_partkey) AS id FROM part WHERE p_type NOT IN (SELECT p_type FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_quantity >= 50) GROUP BY 1")
def find_or_create(spark, d):
    """Types of parts against those of parts in large positions."""
    t = Tables(spark, d)
    large = t.lineitem.where("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey"))
    wanted = t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("name"))
    return conflation.find_or_create(wanted, t.part.join(large, "p_partkey", "left_semi").select(F.col("p_type").alias("name")), "name").select("name", "id")


# Functions on text


@query(r"""SELECT p_partkey AS id, regexp_replace(regexp_replace(translate(replace(lower(x), ' ', '-'), '''".,!?&', ''), '[^a-z0-9-]', '', 'g'), '^-+|-+$', '', 'g') AS slug_a,
regexp_replace(regexp_replace(lower(x), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug_b, regexp_replace(regexp_replace(lower(x), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug_c, replace(lower(x), ' ', '-') AS slug_d
FROM (SELECT p_partkey, p_name || ' & ' || p_brand || ' "' || p_type || '"!' AS x FROM part)""")
def slugs(spark, d):
    x = F.concat(F.col("p_name"), F.lit(" & "), F.col("p_brand"), F.lit(' "'), F.col("p_type"), F.lit('"!'))
    return Tables(spark, d).part.select(F.col("p_partkey").alias("id"), T.slug_keep_runs(x).alias("slug_a"), T.slug(x).alias("slug_b"), T.slug_ascii(x).alias("slug_c"), T.slug_simple(x).alias("slug_d"))


@query("""SELECT p_partkey AS id, replace(translate(replace(trim(lower(x)), '&', 'and'), '-_', '  '), '  ', ' ') AS matched, trim(replace(replace(replace(replace(replace(lower(y), 'the ', ''), ' tavern', ''), ' bar', ''), ' club', ''), ' lounge', '')) AS venue_core,
trim(replace(replace(replace(replace(lower(z), 'the ', ''), ' band', ''), ' trio', ''), ' quartet', '')) AS artist_core FROM (SELECT p_partkey, p_name || '_' || p_type || ' & -x' AS x, 'The ' || p_name || ' Tavern' AS y, 'The ' || p_name || ' Trio' AS z FROM part)""")
def name_forms(spark, d):
    n = F.col("p_name")
    return Tables(spark, d).part.select(
        F.col("p_partkey").alias("id"), T.match_name(F.concat(n, F.lit("_"), F.col("p_type"), F.lit(" & -x"))).alias("matched"), T.venue_core_name(F.concat(F.lit("The "), n, F.lit(" Tavern"))).alias("venue_core"), T.artist_core_name(F.concat(F.lit("The "), n, F.lit(" Trio"))).alias("artist_core")
    )


@query("""WITH t AS (SELECT a.p_partkey AS id, a.p_name AS a, b.p_name AS b, list_distinct(string_split(a.p_name, ' ')) AS x, list_distinct(string_split(b.p_name, ' ')) AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)
SELECT id, a, b, round(CASE WHEN a = b THEN 1 ELSE len(list_intersect(x, y)) / CAST(len(list_distinct(list_concat(x, y))) AS DOUBLE) END, 6) AS jaccard, round(CASE WHEN a = b THEN 1 ELSE 1 - levenshtein(a, b) / CAST(greatest(length(a), length(b)) AS DOUBLE) END, 6) AS similarity FROM t""")
def name_similarity(spark, d):
    """Each part's name with that of the next part."""
    p = Tables(spark, d).artists
    both = p.select("id", F.col("name").alias("a")).join(p.select((F.col("id") - 1).alias("id"), F.col("name").alias("b")), "id")
    return both.select("id", "a", "b", F.round(T.token_jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"), F.round(T.levenshtein_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


_TITLES = "(SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN p_name || ' Open Mic' WHEN 1 THEN p_name || ', ' || p_type || ' & ' || p_brand WHEN 2 THEN 'DJ ' || p_name || ' / x' WHEN 3 THEN p_name || ' feat. ' || p_type || ' & ' || p_brand WHEN 4 THEN p_name || ' with ' || p_type || ' + ' || p_brand ELSE 'Art and Craft ' || p_name || '!!' END AS t FROM part)"


def _titles(spark, d) -> DataFrame:
    n, k, b = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    kind = F.col("p_partkey") % 6
    title = (
        F.when(kind == 0, F.concat(n, F.lit(" Open Mic"))).when(kind == 1, F.concat(n, F.lit(", "), k, F.lit(" & "), b)).when(kind == 2, F.concat(F.lit("DJ "), n, F.lit(" / x")))
        .when(kind == 3, F.concat(n, F.lit(" feat. "), k, F.lit(" & "), b)).when(kind == 4, F.concat(n, F.lit(" with "), k, F.lit(" + "), b)).otherwise(F.concat(F.lit("Art and Craft "), n, F.lit("!!")))
    )
    return Tables(spark, d).part.select(F.col("p_partkey").alias("id"), title.alias("t"))


@query(rf"""SELECT id, t, array_to_string(list_filter(list_transform(regexp_split_to_array(t, '[,&+/|]'), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts,
CASE WHEN regexp_matches(lower(t), 'open mic|karaoke|bingo') OR contains(lower(t), 'art') AND contains(lower(t), 'craft') OR contains(lower(t), 'dj') AND NOT contains(lower(t), 'dj ') THEN t
ELSE array_to_string(list_filter(list_transform(regexp_split_to_array(t, '[,&+/|]'), lambda x: trim(x)), lambda x: strlen(x) > 1), '|') END AS performers,
regexp_matches(lower(t), 'open mic|karaoke|trivia|comedy|open jam|dj night|bingo') AS non_artist FROM {_TITLES}""")
def title_split(spark, d):
    t = F.col("t")
    return _titles(spark, d).select("id", "t", F.array_join(T.split_artists(t), "|").alias("parts"), F.array_join(T.performers(t), "|").alias("performers"), T.is_non_artist(t).alias("non_artist"))


@query(rf"""SELECT id, regexp_replace(trim(CASE WHEN contains(lower(t), 'feat') THEN left(t, strpos(lower(t), 'feat') - 1) ELSE t END), '!+$', '') AS headliner,
CASE WHEN contains(t, ' with ') THEN trim(split_part(t, ' with ', 1)) || '|' || array_to_string(list_filter(list_transform(regexp_split_to_array(split_part(t, ' with ', 2), '[,&+]'), lambda x: trim(x)), lambda x: x <> ''), '|') ELSE trim(t) END AS acts,
array_to_string(list_filter(['Music', CASE WHEN contains(lower(t), 'karaoke') THEN 'Karaoke' END, CASE WHEN regexp_matches(lower(t), 'open mic|open-mic') THEN 'Open Mic' END, CASE WHEN regexp_matches(lower(t), 'art|craft') THEN 'Arts & Crafts' END,
CASE WHEN contains(lower(t), 'bingo') THEN 'Games' END, CASE WHEN contains(lower(t), 'dj') THEN 'DJ' END, CASE WHEN contains(lower(t), 'festival') THEN 'Festival' END], lambda x: x IS NOT NULL), '|') AS categories FROM {_TITLES}""")
def title_acts_and_categories(spark, d):
    t = F.col("t")
    return _titles(spark, d).select("id", T.headliner(t).alias("headliner"), F.array_join(T.with_acts(t), "|").alias("acts"), F.array_join(T.categories(t), "|").alias("categories"))


_H = "sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(p_name))"


@query(f"SELECT p_partkey AS id, substr({_H}, 1, 8) || '-' || substr({_H}, 9, 4) || '-5' || substr({_H}, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr({_H}, 17, 1)) - 1) % 4 + 1, 1) || substr({_H}, 18, 3) || '-' || substr({_H}, 21, 12) AS uuid FROM part")
def uuid5_ids(spark, d):
    return Tables(spark, d).part.select(F.col("p_partkey").alias("id"), T.uuid5(F.col("p_name")).alias("uuid"))


@query("SELECT doc_id, sha256(source || '|' || coalesce(lang, '') || '|' || '' || '|' || CAST(n_chars AS VARCHAR) || '|' || sha256(text)) AS key FROM documents")
def idempotency_key(spark, d):
    return Tables(spark, d).documents.select("doc_id", T.idempotency_key(F.col("source"), F.col("lang"), F.lit(None).cast("string"), F.col("n_chars").cast("string"), F.sha2("text", 256)).alias("key"))


@query("""SELECT o_orderkey AS id, CAST(try_strptime(strftime(o_orderdate, '%B %d, %Y'), '%B %d, %Y') AS DATE) AS long_form, CAST(o_orderdate AS DATE) AS slashed, CAST(o_orderdate AS DATE) AS iso, CAST(NULL AS DATE) AS bad FROM orders""")
def parse_days(spark, d):
    day = F.col("o_orderdate")
    forms = {"long_form": F.date_format(day, "MMMM dd, yyyy"), "slashed": F.date_format(day, "MM/dd/yyyy"), "iso": F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "bad": F.lit("soon")}
    return Tables(spark, d).orders.select(F.col("o_orderkey").alias("id"), *[T.parse_day(c).alias(n) for n, c in forms.items()])


@query("""SELECT event_id AS id, strftime(date_trunc('minute', ts), '%H:%M:%S') AS clock, strftime(date_trunc('minute', ts), '%H:%M:%S') AS clock12, printf('%02d:00:00', CAST(hour(ts) AS INTEGER)) AS hours FROM events""")
def parse_times(spark, d):
    ts = F.col("ts")
    return Tables(spark, d).events.select(F.col("event_id").alias("id"), T.parse_time(F.date_format(ts, "HH:mm")).alias("clock"), T.parse_time(F.date_format(ts, "h:mm a")).alias("clock12"), T.parse_time(F.concat(F.date_format(ts, "h "), F.when(F.hour(ts) < 12, "a.m.").otherwise("p.m."))).alias("hours"))


# Geography


KM = "sqrt(((lat - 4.76062e1) * 111) * ((lat - 4.76062e1) * 111) + ((lng + 1.223321e2) * 85) * ((lng + 1.223321e2) * 85))"
INSIDE = "(lat BETWEEN 4.748e1 AND 4.774e1 AND lng BETWEEN -1.2246e2 AND -1.2222e2)"
DISTRICT = f"CASE WHEN lat > 4.762e1 AND lng > -1.2234e2 THEN 'Capitol Hill' WHEN lat > 4.766e1 AND lng < -1.2237e2 THEN 'Ballard' WHEN lat > 4.761e1 AND lng > -1.2234e2 THEN 'Belltown' WHEN lat < 4.76e1 AND lng > -1.2234e2 THEN 'Pioneer Square' WHEN lat > 4.767e1 AND lng > -1.2236e2 THEN 'Fremont' WHEN {INSIDE} THEN 'Seattle' END"
DENSITY = f"CASE WHEN {KM} < 5 THEN 'Dense' WHEN {KM} < 15 THEN 'Urban' WHEN {KM} < 30 THEN 'Suburban' ELSE 'Rural' END"


@query(BASE + f"""SELECT id, round({KM}, 6) AS km, 'seattle_grid_' || CAST(floor(lat / 1e-2) AS INTEGER) || '_' || CAST(floor(lng / 1e-2) AS INTEGER) AS bin, CAST(round(lat * 1000) AS BIGINT) || '_' || CAST(round(lng * 1000) AS BIGINT) AS cell, {INSIDE} AS inside, {DISTRICT} AS district,
{DENSITY} AS density, round(greatest(1 - least({KM} / 50, 1), 0), 6) AS transit FROM venues""")
def geography(spark, d):
    y, x = F.col("lat"), F.col("lng")
    km = geo.from_center(y, x)
    return Tables(spark, d).venues.select("id", F.round(km, 6).alias("km"), geo.spatial_bin(y, x).alias("bin"), geo.location_cell(y, x).alias("cell"), geo.in_box(y, x).alias("inside"), geo.district(y, x).alias("district"), geo.density(km).alias("density"), F.round(geo.transit(km), 6).alias("transit"))


_MARKS = ", ".join(f"({i}, '{n}', {y!r}e0, {x!r}e0)" for i, (n, y, x) in enumerate(geo.LANDMARKS))
NEAR = f"marks(place, landmark, y, x) AS (VALUES {_MARKS}), near AS (SELECT id, place, landmark FROM venues JOIN marks ON sqrt((lat - y) * 111 * ((lat - y) * 111) + (lng - x) * 85 * ((lng - x) * 85)) < 2)"


@query(BASE.rstrip() + f", {NEAR} SELECT id, landmark FROM near")
def landmarks_near(spark, d):
    return enrichment.landmarks_join(Tables(spark, d).venues, "lat", "lng").select("id", "landmark")


TAGGED = f"""SELECT *, {DISTRICT} AS district, {KM} AS km, {INSIDE} AS inside, 5e-1 + id % 6 * 1e-1 AS quality FROM venues"""
TAGS = "concat_ws('|', 'venue|location|entertainment', replace(lower(district), ' ', '_'), CASE district WHEN 'Capitol Hill' THEN 'nightlife|arts|hipster' WHEN 'Ballard' THEN 'craft_beer|maritime' WHEN 'Belltown' THEN 'urban|upscale' WHEN 'Pioneer Square' THEN 'historic|downtown' END, 'seattle|pacific_northwest')"
CONFIDENCE = "greatest(9e-1 - (1 - quality) * 2e-1 - CASE WHEN inside THEN 0 ELSE 1e-1 END, 3e-1)"


def _enriched(spark, d) -> DataFrame:
    return enrichment.enrich(Tables(spark, d).venues.withColumn("quality_score", 0.5 + F.col("id") % 6 * F.lit(0.1)), "venue", "lat", "lng")


@query(BASE.rstrip() + f", {NEAR}, t AS ({TAGGED}) SELECT t.id, {TAGS} AS tags, round({CONFIDENCE}, 6) AS confidence, coalesce((SELECT string_agg(landmark, '|' ORDER BY place) FROM near n WHERE n.id = t.id), '') AS landmarks, CASE WHEN inside THEN '' ELSE 'Coordinates are outside the city' END AS warnings FROM t")
def enrich_venues(spark, d):
    return _enriched(spark, d).select("id", F.array_join("tags", "|").alias("tags"), F.round("enrichment_confidence", 6).alias("confidence"), F.array_join("landmarks", "|").alias("landmarks"), F.array_join("enrichment_warnings", "|").alias("warnings"))


@query(BASE.rstrip() + f""", t AS ({TAGGED}), e AS (SELECT inside, len(string_split({TAGS}, '|')) AS n, {CONFIDENCE} AS c FROM t) SELECT count(*) AS n_total, count(*) AS n_binned, count_if(inside) AS n_city, count(*) AS n_located, CAST(sum(n) AS BIGINT) AS n_tags, round(avg(n), 6) AS avg_tags,
round(min(c), 6) AS min_confidence, round(max(c), 6) AS max_confidence, round(avg(c), 6) AS avg_confidence, 100e0 AS binned_rate, round(count_if(inside) * 1e2 / count(*), 6) AS city_rate, 100e0 AS located_rate FROM e""")
def enrich_stats(spark, d):
    return enrichment.statistics(_enriched(spark, d))


# Quality gate


def _records(spark, d) -> DataFrame:
    t = Tables(spark, d)
    docs = t.documents.join(t.labels.select("doc_id", "quality").dropDuplicates(["doc_id"]), "doc_id", "left")
    return docs.select(
        "doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("text")).otherwise("").alias("title"), F.date_add(today(), (F.col("doc_id") % 900 - 100).cast("int")).alias("event_day"),
        F.when(F.col("doc_id") % 4 == 0, T.NIL_UUID).otherwise("v").alias("venue_id"), (F.lit(0.9) - F.coalesce(1 - F.col("quality"), F.lit(0)) * F.lit(0.3)).alias("confidence"), F.col("lang").alias("source"),
    )


RECORDS = f"""records AS (SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN text ELSE '' END AS title, doc_id % 900 - 100 AS ahead, doc_id % 4 = 0 AS nil, 9e-1 - coalesce(1 - quality, 0) * 3e-1 AS confidence FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) USING (doc_id)),
flags AS (SELECT *, trim(title) = '' OR strlen(title) < 3 AS short, ahead > 365 OR ahead < -30 AS off, confidence < 7e-1 AS unsure FROM records),
scored AS (SELECT *, greatest(confidence - CASE WHEN short THEN 15e-2 ELSE 0 END - CASE WHEN off THEN 5e-2 ELSE 0 END - CASE WHEN nil THEN 1e-2 ELSE 0 END - CASE WHEN unsure THEN 5e-2 ELSE 0 END, 0) AS score FROM flags),
decided AS (SELECT *, CASE WHEN score < 6e-1 THEN 'Quarantine' WHEN short OR off OR unsure THEN 'AcceptWithWarnings' ELSE 'Accept' END AS decision FROM scored)"""


def _assessed(spark, d) -> DataFrame:
    return quality.assess(_records(spark, d), quality.event_issues(F.col("title"), F.col("event_day"), F.col("venue_id"), today()))


@query(f"WITH {RECORDS} SELECT doc_id, round(score, 6) AS score, decision, CASE WHEN decision = 'Quarantine' THEN 'quarantined' ELSE 'accepted' END AS partition, concat_ws('|', CASE WHEN short THEN 'title' END, CASE WHEN off THEN 'event_day' END, CASE WHEN nil THEN 'venue_id' END, CASE WHEN unsure THEN 'confidence' END) AS issues FROM decided")
def quality_gate(spark, d):
    a = quality.route(_assessed(spark, d))
    return a.select("doc_id", F.round("quality_score", 6).alias("score"), "decision", "partition", F.array_join(F.transform("issues", lambda i: i["field"]), "|").alias("issues"))


@query(f"""WITH {RECORDS} SELECT count(*) AS n_total, count_if(decision = 'Accept') AS n_accept, count_if(decision = 'AcceptWithWarnings') AS n_warned, count_if(decision = 'Quarantine') AS n_quarantined, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score, round(avg(score), 6) AS avg_score,
count_if(nil) AS n_info, count_if(off) + count_if(unsure) AS n_warning, count_if(short) AS n_error, CAST(0 AS BIGINT) AS n_critical, round(count_if(decision <> 'Quarantine') * 1e2 / count(*), 6) AS acceptance_rate, round(count_if(decision = 'Quarantine') * 1e2 / count(*), 6) AS quarantine_rate FROM decided""")
def quality_stats(spark, d):
    return quality.statistics(_assessed(spark, d))


@query(BASE + f"""SELECT id, round(greatest(9e-1 - CASE WHEN id % 9 = 0 THEN 3e-1 ELSE 0 END - CASE WHEN abs(lat - 4.76062e1) < 1e-4 AND abs(lng + 1.223321e2) < 1e-4 THEN 5e-2 ELSE 0 END - CASE WHEN lat BETWEEN 47 AND 48 AND lng BETWEEN -123 AND -121 THEN 0 ELSE 15e-2 END - CASE WHEN id % 5 = 0 THEN 5e-2 ELSE 0 END, 0), 6) AS score,
CASE WHEN id % 9 = 0 THEN 'Quarantine' WHEN id % 5 = 0 THEN 'AcceptWithWarnings' ELSE 'Accept' END AS decision FROM venues""")
def quality_venues(spark, d):
    v = Tables(spark, d).venues.withColumn("confidence", F.lit(0.9)).withColumn("name", F.when(F.col("id") % 9 == 0, " ").otherwise(F.col("name"))).withColumn("address", F.when(F.col("id") % 5 != 0, "street"))
    return quality.assess(v, quality.venue_issues(F.col("name"), F.col("lat"), F.col("lng"), F.col("address"))).select("id", F.round("quality_score", 6).alias("score"), "decision")


@query(f"""WITH {RECORDS} SELECT doc_id, CASE WHEN trim(title) = '' THEN 'Title is empty' WHEN strlen(trim(title)) < 2 THEN 'Title is too short' WHEN ahead < -365 THEN 'Event is over a year past' WHEN ahead > 730 THEN 'Event is over two years ahead' END AS reason, trim(title) <> '' AS simple FROM records""")
def first_failures(spark, d):
    r = _records(spark, d)
    return r.select("doc_id", quality.first_failure(F.col("title"), F.lit("v"), F.col("event_day"), today(), F.lit("s")).alias("reason"), quality.simple_gate(F.col("title"), F.lit("v")).alias("simple"))


# Entity resolution


# A name is shared by a few parts, as a title is by a few events, so pairs grow with the table
_SHOWN = "p_name || ' ' || (p_partkey // 60)"


def _entities(spark, d) -> tuple[DataFrame, DataFrame]:
    """Every part as an event that was read, and every part as a known event."""
    null = lambda t: F.lit(None).cast(t)
    day = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("p_partkey") % 3).cast("int"))
    name = F.concat("p_name", F.lit(" "), F.expr("p_partkey div 60"))
    rows = Tables(spark, d).part.select(F.col("p_partkey").alias("id"), F.lit("event").alias("entity_type"), name.alias("name"), null("double").alias("latitude"), null("double").alias("longitude"), null("string").alias("address"), day.alias("event_day"), (F.col("p_partkey") % 2).alias("venue_id"))
    return rows, rows.select("*")


RESOLVED = f"""WITH r AS (SELECT p_partkey AS id, {_SHOWN} AS name, p_partkey % 3 AS d, p_partkey % 2 AS v FROM part), c AS (SELECT * FROM r),
pairs AS (SELECT r.id AS r, c.id AS c, 5e-1 + CASE WHEN r.d = c.d THEN 3e-1 ELSE 0 END + CASE WHEN r.v = c.v THEN 2e-1 ELSE 0 END AS s FROM r JOIN c ON lower(r.name) = lower(c.name)),
best AS (SELECT r, max(s) AS s, count(*) AS n, count_if(s > 9e-1) AS dup FROM pairs GROUP BY 1), pick AS (SELECT r, min(c) AS c FROM pairs JOIN best USING (r) WHERE pairs.s = best.s GROUP BY 1)"""


@query(RESOLVED + " SELECT r.id, CASE WHEN b.s >= 8e-1 THEN 'MatchedExisting' ELSE 'NewEntity' END AS resolution, CASE WHEN b.s >= 8e-1 THEN p.c ELSE r.id END AS canonical_id, round(CASE WHEN b.s >= 8e-1 THEN b.s WHEN b.s IS NOT NULL THEN 6e-1 ELSE 1 END, 6) AS confidence, coalesce(b.n, 0) AS n_matches, coalesce(b.dup, 0) AS n_duplicates, coalesce(b.n, 0) > 1 AS is_potential_duplicate FROM r LEFT JOIN best b ON b.r = r.id LEFT JOIN pick p ON p.r = r.id")
def conflation_best_match(spark, d):
    return conflation.resolve(*_entities(spark, d)).select("id", "resolution", "canonical_id", F.round("confidence", 6).alias("confidence"), "n_matches", "n_duplicates", "is_potential_duplicate")


@query(RESOLVED + " SELECT r AS id, c AS entity_id, round(s, 6) AS score, CASE WHEN s < 8e-1 THEN 'Similarity score below threshold' ELSE 'Lower similarity than selected match' END AS reason FROM pairs WHERE NOT EXISTS (SELECT 1 FROM pick JOIN best USING (r) WHERE pick.r = pairs.r AND pick.c = pairs.c AND best.s >= 8e-1)")
def conflation_alternatives(spark, d):
    r = conflation.resolve(*_entities(spark, d)).select("id", F.explode("alternatives").alias("a"))
    return r.select("id", F.col("a.entity_id").alias("entity_id"), F.round("a.similarity_score", 6).alias("score"), F.col("a.rejection_reason").alias("reason"))


@query("""WITH k AS (SELECT min(p_partkey) AS id, p_name AS name FROM part GROUP BY 2), n AS (SELECT min(p_partkey) AS id, substr(p_name, 2) AS name FROM part GROUP BY 2),
m AS (SELECT n.id, k.id AS kid, CASE WHEN n.name = k.name THEN 1 ELSE 1 - levenshtein(n.name, k.name) / CAST(greatest(length(n.name), length(k.name)) AS DOUBLE) END AS s, n.name <> k.name AS fuzzy FROM n JOIN k ON true)
SELECT n.id, n.name, x.kid AS matched_id, round(x.s, 6) AS similarity FROM n LEFT JOIN (SELECT * FROM m WHERE s >= 8e-1 QUALIFY row_number() OVER (PARTITION BY id ORDER BY fuzzy, kid) = 1) x ON x.id = n.id""")
def fuzzy_name_match(spark, d):
    """Names without their first letter against all names."""
    p = Tables(spark, d).artists
    known = p.groupBy("name").agg(F.min("id").alias("id"))
    names = p.select("id", F.substr("name", F.lit(2)).alias("name")).groupBy("name").agg(F.min("id").alias("id"))
    return conflation.fuzzy_match(names, known, 0.8).withColumn("similarity", F.round("similarity", 6))


# Ingest log


def _log(spark, d) -> DataFrame:
    p = Tables(spark, d).pages
    return p.select(F.col("page_id").cast("string").alias("envelope_id"), F.timestamp_seconds(F.col("page_id") * 3).alias("accepted_at"), F.regexp_extract("url", "//([^/]+)", 1).alias("idempotency_key"), F.concat(F.lit("ref:"), F.col("page_id")).alias("payload_ref"), F.sha2("url", 256).alias("sha256"))


LOG = "log AS (SELECT page_id, CAST(page_id AS VARCHAR) AS envelope_id, regexp_extract(url, '//([^/]+)', 1) AS key, sha256(url) AS sha FROM pages), tagged AS (SELECT *, first_value(envelope_id) OVER (PARTITION BY key ORDER BY page_id) AS f FROM log)"


@query(f"WITH {LOG} SELECT envelope_id, CASE WHEN f <> envelope_id THEN f END AS dedupe_of, CASE WHEN f = envelope_id THEN 'ref:' || envelope_id END AS payload_ref FROM tagged")
def envelope_dedupe(spark, d):
    return ingest.tag_duplicates(_log(spark, d)).select("envelope_id", "dedupe_of", "payload_ref")


@query(f"WITH {LOG} SELECT envelope_id, 'ref:' || f AS payload_ref FROM tagged")
def payload_resolution(spark, d):
    return ingest.payload_refs(ingest.tag_duplicates(_log(spark, d))).select("envelope_id", "payload_ref")


@query("SELECT page_id AS pos, url AS line FROM pages WHERE page_id >= 10 ORDER BY 1 LIMIT 50")
def log_read_next(spark, d):
    return ingest.read_next(Tables(spark, d).pages.select(F.col("page_id").alias("pos"), F.col("url").alias("line")), 10)


@query("SELECT c AS consumer, p AS pos, CASE WHEN p > e THEN e ELSE e - p END AS lag FROM (VALUES ('a', 5), ('b', 0)) t(c, p), (SELECT max(page_id) + 1 AS e FROM pages)")
def consumer_lag(spark, d):
    offsets = spark.createDataFrame([("a", 5), ("b", 0)], "consumer string, pos int")
    return ingest.lag(Tables(spark, d).pages.select(F.col("page_id").alias("pos")), offsets).select("consumer", "pos", "lag")


@query("SELECT page_id, CASE WHEN page_id % 3 = 2 THEN 'mime' WHEN strlen(html) > 2000 THEN 'size' END AS rejection FROM pages")
def admission(spark, d):
    mime = F.when(F.col("page_id") % 3 == 2, "image/png").when(F.col("page_id") % 3 == 1, "text/html; charset=utf-8").otherwise("application/json")
    p = Tables(spark, d).pages.select("page_id", mime.alias("content_type"), F.octet_length("html").alias("content_length"))
    return ingest.admitted(p, ["text/html", "application/json"], 2000).select("page_id", "rejection")


@query("SELECT user_id AS source_id FROM (SELECT user_id, max(ts) AS t FROM events GROUP BY 1) WHERE user_id % 5 <> 0 AND (user_id % 7 = 0 OR epoch(TIMESTAMP '2024-01-31') - floor(epoch(t)) >= 43200)")
def cadence_due(spark, d):
    e = Tables(spark, d).events
    last = e.groupBy(F.col("user_id").alias("source_id")).agg(F.max("ts").alias("fetched_at"))
    sources = last.select("source_id", (F.col("source_id") % 5 != 0).alias("enabled"))
    return ingest.due(sources, last.where("source_id % 7 <> 0"), "2024-01-31 00:00:00").select("source_id")


@query("SELECT DISTINCT sha256(text) AS sha256, left(sha256(text), 2) AS prefix FROM documents")
def content_addressed(spark, d):
    return ingest.content_addressed(Tables(spark, d).documents.select(F.col("text").alias("content"))).select("sha256", "prefix")


@query("SELECT event_type AS source_id, count(*) AS seen, count_if(user_id % 2 = 1) AS filtered, count_if(user_id % 2 = 0 AND event_id % 4 = 0) AS empty, CAST(sum(CASE WHEN user_id % 2 = 0 THEN event_id % 4 ELSE 0 END) AS BIGINT) AS written FROM events GROUP BY 1")
def parse_summary(spark, d):
    return ingest.parse_summary(Tables(spark, d).events.select(F.col("event_type").alias("source_id"), (F.col("user_id") % 2 == 0).alias("wanted"), (F.col("event_id") % 4).alias("n_records")))


@query("SELECT CAST(sum(event_id % 9) AS BIGINT) AS n_processed, CAST(sum(user_id % 2 + event_id % 2) AS BIGINT) AS n_failed, round(sum(event_id % 9) * 1e2 / (sum(event_id % 9) + sum(user_id % 2 + event_id % 2)), 6) AS success_rate FROM events")
def pipeline_totals(spark, d):
    return ingest.pipeline_totals(Tables(spark, d).events.select((F.col("event_id") % 9).alias("processed"), (F.col("user_id") % 2).alias("failed"), (F.col("event_id") % 2).alias("errors")))


# Payloads and pages


@query("SELECT CASE event_type WHEN 'click' THEN 'kexp' WHEN 'view' THEN 'neumos' ELSE event_type END AS source_id, CAST(event_id AS VARCHAR) AS envelope_id, '/events/' || user_id AS record_path, props AS record FROM events")
def raw_to_parsed(spark, d):
    from stagelight.operators import payloads

    api = F.when(F.col("event_type") == "click", "crawler_kexp").when(F.col("event_type") == "view", "crawler_neumos").otherwise(F.col("event_type"))
    return payloads.from_raw(Tables(spark, d).events.select(F.col("event_id").alias("id"), api.alias("api_name"), F.col("user_id").alias("event_api_id"), F.col("props").alias("data"))).drop("payload_ref")


@query("""SELECT event_id AS id, CASE WHEN event_id % 3 <> 0 THEN 'own' WHEN event_type = 'click' THEN 'v1' ELSE '00000000-0000-0000-0000-000000000000' END AS venue_id FROM events""")
def nil_venue_resolution(spark, d):
    venues = spark.createDataFrame([("v1", "the barboza"), ("v2", "Elsewhere")], "id string, name string")
    e = Tables(spark, d).events.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 3 != 0, "own").otherwise(T.NIL_UUID).alias("venue_id"), F.when(F.col("event_type") == "click", "barboza").otherwise("x").alias("source_id"))
    return catalog.resolve_venues(e, venues).select("id", "venue_id")


@query("""SELECT doc_id, pos, trim(t) <> '' AND NOT contains(t, 'OPEN 4PM') AND NOT contains(t, 'HOSTED BY') AND (contains(t, 'http') OR regexp_matches(t, '\\p{Lu}')) AS band FROM (SELECT doc_id, pos, CASE doc_id % 4 WHEN 0 THEN 'HOSTED BY ' || line WHEN 1 THEN lower(line) ELSE line END AS t
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents))""")
def band_paragraphs(spark, d):
    lines = Tables(spark, d).documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    k, line = F.col("doc_id") % 4, F.col("line")
    t = F.when(k == 0, F.concat(F.lit("HOSTED BY "), line)).when(k == 1, F.lower(line)).otherwise(line)
    return lines.select("doc_id", "pos", T.is_band_paragraph(t).alias("band"))


@query("SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_partkey = 25")
def events_with_nested_artist(spark, d):
    e = Tables(spark, d).acts.groupBy(F.col("event_id").alias("id")).agg(F.collect_list(F.struct(F.col("artist_id").alias("id"))).alias("artists"))
    return listings.events_with_artist(e, 25).select("id")


@query("SELECT event_id AS id, value, user_id FROM events WHERE event_type = 'click'")
def node_label_decode(spark, d):
    nodes = Tables(spark, d).events.select(F.col("event_id").alias("id"), F.col("event_type").alias("label"), F.to_json(F.struct(F.lit(-1).alias("id"), "value", "user_id")).alias("data"))
    return listings.decode(nodes, "click", "id bigint, value double, user_id bigint")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def parse_json_props(spark, d):
    return Tables(spark, d).events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<script>(.*?)</script>', 1) AS script FROM pages")
def html_title_and_script(spark, d):
    return Tables(spark, d).pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", "<script>(.*?)</script>", 1).alias("script"))


@query("SELECT page_id, list_last(string_split(url, '/')) AS segment, split_part(url, '?', 1) AS base FROM pages")
def url_segments(spark, d):
    return Tables(spark, d).pages.select("page_id", T.last_segment(F.col("url")).alias("segment"), F.split_part("url", F.lit("?"), F.lit(1)).alias("base"))


@query("SELECT CAST(page_id AS VARCHAR) AS envelope_id, 'html' AS record_path, CAST(strlen(html) AS BIGINT) AS html_len FROM pages WHERE html NOT LIKE '%EventItem%'")
def html_pages_parsed(spark, d):
    """Pages that are no listings: each gives its length."""
    from stagelight.operators import pages

    ship(spark)
    p = Tables(spark, d).pages.select(F.lit("kexp").alias("source_id"), F.col("page_id").cast("string").alias("envelope_id"), F.col("url").alias("payload_ref"), "html")
    return pages.parse_pages(p, "kexp_html_v1", AS_OF).select("envelope_id", "record_path", F.get_json_object("record", "$.html_len").cast("bigint").alias("html_len"))


# Metrics


def _samples(spark, d) -> DataFrame:
    return Tables(spark, d).events.select(F.col("event_type").alias("name"), "ts", "event_id", "value")


@query("""WITH s AS (SELECT event_type AS name, ts, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts) AS b FROM events), g AS (SELECT name, ts, CASE WHEN b IS NULL THEN 0 WHEN value < b THEN value ELSE value - b END AS gain FROM s),
w AS (SELECT name, gain, unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS window_start FROM g) SELECT name, window_start, round(sum(gain) * 60 / 300, 6) AS rate FROM w GROUP BY 1, 2""")
def counter_rate_5m(spark, d):
    return metrics.counter_rate(_samples(spark, d), ["name"]).select("name", "window_start", F.round("rate", 6).alias("rate"))


_HIST = "SELECT event_type AS name, le, count_if(value <= le) AS n FROM events, (VALUES (1e-1), (5e-1), (1e0), (25e-1), (5e0), (1e1), (CAST('inf' AS DOUBLE))) t(le) GROUP BY 1, 2"


@query(f"SELECT name, CAST(le AS VARCHAR) AS le, n FROM ({_HIST})")
def histogram_buckets(spark, d):
    b = metrics.buckets(_samples(spark, d), ["name"])
    return b.select("name", F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("string")).alias("le"), "n")


@query(f"""WITH h AS ({_HIST}), x AS (SELECT name, le, n, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(n) OVER w, 0) AS under, 95e-2 * max(n) OVER (PARTITION BY name) AS r FROM h WINDOW w AS (PARTITION BY name ORDER BY le))
SELECT name, round(CASE WHEN le = CAST('inf' AS DOUBLE) THEN low ELSE low + (le - low) * (r - under) / nullif(n - under, 0) END, 6) AS quantile FROM x WHERE n >= r AND n > 0 QUALIFY row_number() OVER (PARTITION BY name ORDER BY le) = 1""")
def histogram_quantile(spark, d):
    return metrics.quantile(metrics.buckets(_samples(spark, d), ["name"]), ["name"], 0.95).select("name", F.round("quantile", 6).alias("quantile"))


@query("SELECT event_type AS name, CAST(epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts))) AS BIGINT) AS age_seconds FROM events GROUP BY 1")
def freshness(spark, d):
    return metrics.freshness(_samples(spark, d), ["name"], "2024-02-01 00:00:00")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM conversations")
def carry_forward_header(spark, d):
    c = Tables(spark, d).conversations.withColumn("header", F.when(F.col("role") == "user", F.col("text")))
    return metrics.carry_forward(c, ["conv_id"], "turn", "header").select("conv_id", "turn", "carried")

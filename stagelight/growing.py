"""Queries on what grows batch by batch: names resolved within a batch, and the store of entities; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.catalogue import Tables, query
from stagelight.lineage import remove, scratch
from stagelight.operators import conflation, resolution
from stagelight.operators.entity_store import EntityStore

# Names: groups of five rows have one word of ten digits, or that with one digit replaced, so that variants are similar to
# the word and not to each other. Every third word is a known name.


def _word(key: Column) -> Column:
    base, v = F.substring(F.md5((key - key % 5).cast("string").cast("binary")), 1, 10), key * 3 % 5
    return F.when(v == 0, base).otherwise(F.concat(F.substring(base, F.lit(1), (v * 2 - 1).cast("int")), F.lit("x"), F.substring(base, (v * 2 + 1).cast("int"), F.lit(10))))


def _word_sql(key: str) -> str:
    base, v = f"substr(md5(CAST({key} - {key} % 5 AS VARCHAR)), 1, 10)", f"({key} * 3 % 5)"
    return f"CASE WHEN {v} = 0 THEN {base} ELSE substr({base}, 1, {v} * 2 - 1) || 'x' || substr({base}, {v} * 2 + 1) END"


def _greedy_sql(names: str, known: str, threshold: str) -> str:
    """Names one after the other, each against all that were created before."""
    near = lambda a, b: f"CASE WHEN {a} = {b} THEN 1 ELSE 1 - levenshtein({a}, {b}) / CAST(greatest(length({a}), length({b})) AS DOUBLE) END"
    return f"""WITH RECURSIVE every AS ({names}), known AS ({known}), n AS (SELECT name, min(id) AS id FROM every GROUP BY name),
old AS (SELECT n.name, k.id AS known_id, {near("n.name", "k.name")} AS s FROM n JOIN known k ON {near("n.name", "k.name")} >= {threshold} QUALIFY row_number() OVER (PARTITION BY n.name ORDER BY n.name <> k.name, k.id) = 1),
f AS (SELECT id, name, row_number() OVER (ORDER BY id) AS i FROM n ANTI JOIN old USING (name)),
r AS (
  SELECT 0::BIGINT AS i, CAST([] AS STRUCT(id BIGINT, name VARCHAR)[]) AS made, NULL::VARCHAR AS name, NULL::BIGINT AS creator_id, NULL::DOUBLE AS s
  UNION ALL
  SELECT i, CASE WHEN len(hit) = 0 THEN list_append(made, struct_pack(id := id, name := name)) ELSE made END, name, coalesce(hit[1].id, id), CASE WHEN len(hit) = 0 THEN 1 ELSE {near("hit[1].name", "name")} END
  FROM (SELECT f.i, f.id, f.name, r.made, list_filter(r.made, lambda x: {near("x.name", "f.name")} >= {threshold}) AS hit FROM r JOIN f ON f.i = r.i + 1)
)
"""


_KNOWN = f"SELECT s_suppkey AS id, {_word_sql('s_suppkey * 15')} AS name FROM supplier"


def _known(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("The "), _word(F.col("s_suppkey") * 15)).alias("name"))


@query(_greedy_sql(f"SELECT c_custkey AS id, {_word_sql('c_custkey')} AS name FROM customer", _KNOWN, "85e-2") + """
SELECT every.id, every.name, old.known_id, r.creator_id, round(coalesce(old.s, r.s), 6) AS similarity FROM every LEFT JOIN old USING (name) LEFT JOIN r USING (name)""")
def venue_names_in_batch(spark, d):
    """Customers' venue names, read in order: known ones, and what the batch itself creates."""
    t = Tables(spark, d)
    read = t.customer.select(F.col("c_custkey").alias("id"), F.concat(F.lit("The "), _word(F.col("c_custkey")), F.lit(" Tavern")).alias("name"))
    return resolution.resolve_venues(read, _known(t), 0.85).withColumn("similarity", F.round("similarity", 6))


@query(_greedy_sql(f"SELECT p_partkey AS id, {_word_sql('p_partkey')} AS name FROM part", _KNOWN, "85e-2") + """
SELECT every.id // 3 AS id, CAST(every.id % 3 AS INTEGER) AS pos, old.known_id, r.creator_id // 3 AS creator_id, CAST(r.creator_id % 3 AS INTEGER) AS creator_pos, round(coalesce(old.s, r.s), 6) AS similarity FROM every LEFT JOIN old USING (name) LEFT JOIN r USING (name)""")
def artist_lists_in_batch(spark, d):
    """Lists of three artists each, read by row and place."""
    t = Tables(spark, d)
    key = F.col("p_partkey")
    each = t.part.select(F.expr("p_partkey div 3").alias("id"), F.struct((key % 3).alias("pos"), F.concat(_word(key), F.lit(" Trio")).alias("name")).alias("a"))
    lists = each.groupBy("id").agg(F.transform(F.sort_array(F.collect_list("a")), lambda a: a["name"]).alias("names"))  # three each
    found = resolution.resolve_artists(lists, _known(t), 0.85)
    return found.select("id", F.posexplode("artists").alias("pos", "a")).select("id", "pos", "a.known_id", "a.creator_id", "a.creator_pos", F.round("a.similarity", 6).alias("similarity"))


# A third of all parts share one title; the others' are shared by a few


def _shows(spark, d) -> DataFrame:
    key, null = F.col("p_partkey"), lambda t: F.lit(None).cast(t)
    name = F.when(key % 3 == 0, F.lit("Open-Mic")).otherwise(F.concat("p_name", F.lit(" "), F.expr("p_partkey div 60")))
    day = F.when(key % 11 != 0, F.date_add(F.lit("1998-01-01").cast("date"), (key % 5).cast("int")))
    return Tables(spark, d).part.select(key.alias("id"), F.lit("event").alias("entity_type"), name.alias("name"), null("double").alias("latitude"), null("double").alias("longitude"), null("string").alias("address"), day.alias("event_day"), (key % 4).alias("venue_id"))


def _second_batch(spark, d) -> DataFrame:
    """Even parts, in an empty store, and odd ones after them."""
    folder = scratch(spark, "entities")
    store = EntityStore(spark, folder, buckets=16)
    shows = _shows(spark, d)
    try:
        store.resolve(shows.where("id % 2 = 0"), 0)
        return store.resolve(shows.where("id % 2 = 1"), 1)
    finally:
        remove(spark, folder)


_STORED = """WITH r AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'Open-Mic' ELSE p_name || ' ' || (p_partkey // 60) END AS name, CASE WHEN p_partkey % 11 <> 0 THEN p_partkey % 5 END AS d, p_partkey % 4 AS v FROM part),
pairs AS (SELECT r.id AS r, k.id AS k, round(5e-1 + CASE WHEN r.d = k.d THEN 3e-1 ELSE 0 END + CASE WHEN r.v = k.v THEN 2e-1 ELSE 0 END, 9) AS s FROM r JOIN r k ON r.name = k.name AND r.id % 2 = 1 AND k.id % 2 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY s DESC, CAST(k AS VARCHAR)) AS n FROM pairs)"""


@query(_STORED + """ SELECT CAST(r.id AS VARCHAR) AS id, CASE WHEN max(s) >= 8e-1 THEN 'MatchedExisting' ELSE 'NewEntity' END AS resolution, CASE WHEN max(s) >= 8e-1 THEN CAST(any_value(k) FILTER (n = 1) AS VARCHAR) ELSE CAST(r.id AS VARCHAR) END AS canonical_id,
round(CASE WHEN max(s) >= 8e-1 THEN max(s) WHEN max(s) IS NOT NULL THEN 6e-1 ELSE 1 END, 6) AS confidence, count(k) AS n_matches, count(k) FILTER (s > 9e-1) AS n_duplicates FROM r LEFT JOIN ranked ON ranked.r = r.id WHERE r.id % 2 = 1 GROUP BY r.id""")
def entity_store_second_batch(spark, d):
    """What a batch finds in the store that the batch before it filled."""
    return _second_batch(spark, d).select("id", "resolution", "canonical_id", F.round("confidence", 6).alias("confidence"), "n_matches", "n_duplicates")


@query(_STORED + """, best AS (SELECT r, max(s) >= 8e-1 AS hit FROM pairs GROUP BY 1)
SELECT CAST(r AS VARCHAR) AS id, CAST(n - CASE WHEN hit THEN 1 ELSE 0 END AS INTEGER) AS place, CAST(k AS VARCHAR) AS entity_id, round(s, 6) AS score FROM ranked JOIN best USING (r) WHERE n - CASE WHEN hit THEN 1 ELSE 0 END BETWEEN 1 AND 10""")
def entity_store_alternatives(spark, d):
    """The ten best others of each record, whatever number there is."""
    each = _second_batch(spark, d).select("id", F.posexplode("alternatives").alias("place", "a"))
    return each.select("id", (F.col("place") + 1).alias("place"), F.col("a.entity_id").alias("entity_id"), F.round("a.similarity_score", 6).alias("score"))


@query("""WITH r AS (SELECT c_custkey AS id, 'hall ' || (c_custkey // 8) AS name, CASE WHEN c_custkey % 3 = 0 THEN 4e1 + (c_custkey // 8) * 21e-4 END AS lat, c_custkey % 5 <> 0 AS placed FROM customer),
pairs AS (SELECT r.id, k.id AS known_id, r.name = k.name AS named, CASE WHEN r.name = k.name THEN 4e-1 ELSE 2e-1 * (1 / 3e0) * 2 END + CASE WHEN r.placed AND k.placed AND abs(r.lat - k.lat) * 111 <= 1e-1 THEN 4e-1 * (1 - abs(r.lat - k.lat) * 111 / 1e-1) ELSE 0 END AS score
  FROM r JOIN r k ON r.name = k.name AND r.id % 2 = 0 AND k.id % 2 = 1)
SELECT id, known_id, round(score, 6) AS score FROM pairs""")
def venue_candidates_without_places(spark, d):
    """Venues with equal names in bulk, most of them without coordinates or with only one: found by name alone."""
    key, group = F.col("c_custkey"), F.expr("c_custkey div 8")
    null = lambda t: F.lit(None).cast(t)
    rows = Tables(spark, d).customer.select(
        key.alias("id"), F.lit("venue").alias("entity_type"), F.concat(F.lit("Hall-"), group).alias("name"), F.when(key % 3 == 0, F.lit(40.0) + group * 0.0021).alias("latitude"),
        F.when(key % 5 != 0, F.lit(-100.0)).alias("longitude"), null("string").alias("address"), null("date").alias("event_day"), null("bigint").alias("venue_id"),
    )
    found = conflation.candidates(rows.where("id % 2 = 0"), rows.where("id % 2 = 1"))
    return found.select(F.col("r_id").alias("id"), F.col("c_id").alias("known_id"), F.round("score", 6).alias("score"))


@query("""WITH k AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'Hall No ' || s_suppkey ELSE 'Bar--' || s_suppkey || '!' END AS name FROM supplier),
w AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'HALL NO ' || (c_custkey // 4 * 2) ELSE 'bar ' || (c_custkey // 4 * 2 + 1) END AS name FROM customer),
s AS (SELECT *, lower(name) AS l, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS g FROM w), ks AS (SELECT min(id) AS id, lower(name) AS l, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS g FROM k GROUP BY name),
f AS (SELECT s.id, s.name, s.g, n.id AS by_name, m.id AS by_slug FROM s LEFT JOIN ks n ON n.l = s.l LEFT JOIN ks m ON m.g = s.g)
SELECT id, name, coalesce(by_name, by_slug, CASE WHEN name IS NOT NULL THEN min(id) FILTER (by_name IS NULL AND by_slug IS NULL) OVER (PARTITION BY g) END) AS entity_id,
CASE WHEN name IS NULL THEN NULL WHEN by_name IS NOT NULL THEN 'name' WHEN by_slug IS NOT NULL THEN 'slug' ELSE 'created' END AS how FROM f""")
def entities_found_or_created(spark, d):
    """Customers' venues among suppliers': by name, then by slug, else created once for all that share the slug."""
    t = Tables(spark, d)
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    existing = t.supplier.select(s.alias("id"), F.when(s % 2 == 0, F.concat(F.lit("Hall No "), s)).otherwise(F.concat(F.lit("Bar--"), s, F.lit("!"))).alias("name"))
    half = F.expr("c_custkey div 4 * 2")
    wanted = t.customer.select(c.alias("id"), F.when(c % 3 == 0, None).when(c % 2 == 0, F.concat(F.lit("HALL NO "), half)).otherwise(F.concat(F.lit("bar "), half + 1)).alias("name"))
    return conflation.found_or_created(wanted, existing)

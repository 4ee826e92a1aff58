"""Entity resolution against a canonical set: blocked candidates, similarity, decision and its record.

records and canonical: (id, entity_type, name, latitude?, longitude?, address?, event_day?, venue_id?).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagelight.functions import geo
from stagelight.functions import text as T

MATCH, BY_NAME, BY_PLACE, DUPLICATE = 0.8, 0.3, 0.5, 0.9


def candidates(records: DataFrame, canonical: DataFrame) -> DataFrame:
    """Pairs that share the compared name or, for venues, the location cell, each once, with their score."""
    names = ["entity_type", "name", "latitude", "longitude", "address", "event_day", "venue_id"]
    keyed = lambda d, p: d.select(F.col("id").alias(f"{p}_id"), *[F.col(n).alias(f"{p}_{n}") for n in names], T.match_name(F.col("name")).alias(f"{p}_key"), F.when(F.col("entity_type") == "venue", geo.location_cell(F.col("latitude"), F.col("longitude"))).alias(f"{p}_cell"))
    r, c = keyed(records, "r"), keyed(canonical, "c")
    same_kind = F.col("r_entity_type") == F.col("c_entity_type")
    by_name = r.join(c, (F.col("r_key") == F.col("c_key")) & same_kind).withColumn("least", F.lit(BY_NAME)).withColumn("how", F.lit(0))
    by_place = r.join(c, (F.col("r_cell") == F.col("c_cell")) & same_kind).where("r_key <> c_key").withColumn("least", F.lit(BY_PLACE)).withColumn("how", F.lit(1))
    return by_name.unionByName(by_place).withColumn("score", similarity()).where("score > least").drop("least", "how")


def similarity():
    """Score of a candidate pair by its kind."""
    name = T.token_jaccard(F.col("r_key"), F.col("c_key"))
    km = geo.distance_km(F.col("r_latitude"), F.col("r_longitude"), F.col("c_latitude"), F.col("c_longitude"))
    place = F.when(km <= 0.1, 1 - km / 0.1).otherwise(0.0)
    address = F.coalesce(T.token_jaccard(T.match_name(F.col("r_address")), T.match_name(F.col("c_address"))), F.lit(0.0))
    venue = name * 0.4 + place * 0.4 + address * 0.2
    day = F.when(F.col("r_event_day") == F.col("c_event_day"), 1.0).otherwise(0.0)
    at = F.when(F.col("r_venue_id") == F.col("c_venue_id"), 1.0).otherwise(0.0)
    event = name * 0.5 + day * 0.3 + at * 0.2
    return F.when(F.col("r_entity_type") == "venue", venue).when(F.col("r_entity_type") == "event", event).otherwise(name)


def resolve(records: DataFrame, canonical: DataFrame) -> DataFrame:
    """Per record: decision, matched or new id, confidence, alternatives, scores, duplicates. Ties go to the smaller id."""
    pairs = candidates(records, canonical)
    order = Window.partitionBy("r_id").orderBy(F.desc("score"), "c_id")
    ranked = pairs.withColumn("n", F.row_number().over(order))
    rejected = F.when(F.col("score") < MATCH, "Similarity score below threshold").otherwise("Lower similarity than selected match")
    chosen = (F.col("n") == 1) & (F.col("score") >= MATCH)
    found = ranked.groupBy("r_id").agg(
        F.max("score").alias("best"), F.min(F.when(chosen, F.col("c_id"))).alias("matched"), F.count("*").alias("n_matches"), F.count_if(F.col("score") > DUPLICATE).alias("n_duplicates"),
        F.sort_array(F.collect_list(F.when(~chosen, F.struct(F.col("c_id").alias("entity_id"), F.col("score").alias("similarity_score"), rejected.alias("rejection_reason"))))).alias("alternatives"),
        F.map_from_entries(F.collect_list(F.struct(F.col("c_id").cast("string"), "score"))).alias("similarity_scores"),
    )
    out = records.join(found, records["id"] == found["r_id"], "left")
    return out.select(
        records["id"], F.when(F.col("matched").isNotNull(), "MatchedExisting").otherwise("NewEntity").alias("resolution"), F.coalesce("matched", records["id"]).alias("canonical_id"),
        F.when(F.col("matched").isNotNull(), F.col("best")).when(F.col("best").isNotNull(), 0.6).otherwise(1.0).alias("confidence"), F.col("best").alias("best_score"), F.coalesce("n_matches", F.lit(0)).alias("n_matches"),
        F.coalesce("n_duplicates", F.lit(0)).alias("n_duplicates"), (F.coalesce("n_matches", F.lit(0)) > 1).alias("is_potential_duplicate"), "alternatives", "similarity_scores",
    )


#: The least threshold for which names are cut into segments
SEGMENTED = 0.6


def similar_names(names: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """names (id, name), known (id, name), both already in compared form -> (id, name, known_id, known_name, s): every pair
    with a Levenshtein similarity of at least the threshold, which is over 0. Blocking without loss: a known name of length
    m differs from a similar one in at most d = m * (1 - threshold) / threshold places, so one of its d + 1 segments is in
    the other, at most d places away. Names meet on (length, segment, text); below SEGMENTED there may be more segments than
    letters, and names meet on lengths that the threshold allows."""
    k = known.select(F.col("id").alias("known_id"), F.col("name").alias("known_name"), F.char_length("name").alias("m"))
    n = F.char_length("name")
    tiny = 1e-9
    least = F.ceil(n * threshold - tiny).cast("int")
    lengths = F.sequence(least, F.greatest(F.floor(n / threshold + tiny).cast("int"), least))
    if threshold >= SEGMENTED:
        allowed = lambda m: F.floor(m * ((1 - threshold) / threshold) + tiny).cast("int")
        start = lambda m, i: F.floor(i * m / (allowed(m) + 1)).cast("int")
        segment = lambda name, m, i, at: F.struct(m.alias("m"), i.alias("i"), F.substr(name, at + 1, start(m, i + 1) - start(m, i)).alias("t"))
        count = lambda m: F.sequence(F.lit(0), allowed(m))
        own = F.transform(count(F.col("m")), lambda i: segment(F.col("known_name"), F.col("m"), i, start(F.col("m"), i)))
        last = lambda m, i: n - (start(m, i + 1) - start(m, i))
        near = lambda m, i: F.sequence(F.greatest(start(m, i) - allowed(m), F.lit(0)), F.greatest(start(m, i) + allowed(m), F.lit(0)))
        spots = lambda m, i: F.filter(near(m, i), lambda at: at <= last(m, i))
        keys = F.transform(lengths, lambda m: F.flatten(F.transform(count(m), lambda i: F.transform(spots(m, i), lambda at: segment(F.col("name"), m, i, at)))))
        met = names.select("id", "name", F.explode(F.array_distinct(F.flatten(keys))).alias("key")).join(k.withColumn("key", F.explode(own)), "key")
        met = met.select("id", "name", "known_id", "known_name").distinct()
    else:
        met = names.select("id", "name", F.explode(lengths).alias("m")).join(k, "m").select("id", "name", "known_id", "known_name")
    return met.withColumn("s", T.levenshtein_similarity(F.col("name"), F.col("known_name"))).where(F.col("s") >= threshold)


def fuzzy_match(names: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """names (id, name), known (id, name), both already in compared form -> matched id for each name: an equal name,
    else the smallest id with a Levenshtein similarity of at least the threshold; null for a new one. A threshold of 0 or
    less is met by every known name: the smallest id counts."""
    if threshold > 0:
        met = similar_names(names, known, threshold)
    else:
        k = known.select(F.col("id").alias("known_id"), F.col("name").alias("known_name"))
        least = known.groupBy().agg(F.min_by("name", "id").alias("known_name"), F.min("id").alias("known_id")).where("known_id is not null")
        exact = names.join(k, F.col("name") == F.col("known_name")).select("id", "name", "known_id", "known_name")
        met = names.join(F.broadcast(least), F.lit(True)).select("id", "name", "known_id", "known_name").unionByName(exact)  # one row
        met = met.withColumn("s", T.levenshtein_similarity(F.col("name"), F.col("known_name"))).where(F.col("s") >= threshold)
    best = met.groupBy("id").agg(F.min(F.struct((F.col("name") != F.col("known_name")).alias("fuzzy"), "known_id", "s")).alias("b"))
    return names.join(best, "id", "left").select("id", "name", F.col("b.known_id").alias("matched_id"), F.col("b.s").alias("similarity"))


def find_or_create(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of wanted whose key does not exist yet, one for each key (the smallest id): what is to be created."""
    new = wanted.join(existing.select(key), key, "left_anti")
    order = Window.partitionBy(key).orderBy("id")
    return new.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def found_or_created(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """wanted and existing (id, name) -> each wanted row with entity_id and `how`: the entity of the same name without regard
    to case, else the one with the same slug, else a new one, which stands for all wanted rows of its slug and has the
    smallest id among them. Names of a slug without any character stand for themselves. Among several the smallest id counts;
    null names find and create nothing. Keys are aggregated on both sides before they are joined, so that a name that very
    many rows have is one row there."""
    slugged = lambda: F.when(T.slug(F.col("name")) != "", T.slug(F.col("name"))).otherwise(F.concat(F.lit("="), F.lower("name")))
    forms = lambda df: df.where("name is not null").select("id", F.lower("name").alias("lower"), slugged().alias("slug"))
    known = forms(existing)
    by_name, by_slug = (known.groupBy(k).agg(F.min("id").alias(f"{k}_id")) for k in ("lower", "slug"))
    keys = forms(wanted).groupBy("lower", "slug").agg(F.min("id").alias("first"))
    keys = keys.join(by_name, "lower", "left").join(by_slug, "slug", "left")
    found = F.coalesce("lower_id", "slug_id")
    new = keys.where(found.isNull()).groupBy("slug").agg(F.min("first").alias("new_id"))
    how = F.when(F.col("lower_id").isNotNull(), "name").when(F.col("slug_id").isNotNull(), "slug").otherwise("created")
    keys = keys.join(new, "slug", "left").select("lower", F.coalesce(found, "new_id").alias("entity_id"), how.alias("how"))
    rows = wanted.withColumn("_lower", F.lower("name"))
    return rows.join(keys, F.col("_lower") == F.col("lower"), "left").drop("_lower", "lower")

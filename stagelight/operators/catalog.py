"""Catalog maintenance over plain tables: change detection, upserts, audit records, property graph, cascades."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagelight.functions.text import NIL_UUID
from stagelight.lineage import written

VENUE_FIELDS = ("name", "address", "city", "latitude", "longitude")
ARTIST_FIELDS = ("name", "name_slug", "bio", "artist_image_url")
EVENT_FIELDS = ("title", "event_day", "start_time", "event_url", "description", "event_image_url")


def field_changes(old: str, new: str, fields: tuple[str, ...]) -> Column:
    """array<struct<field, old, new>> of fields that differ, nulls being equal to nulls."""
    each = [F.when(~F.col(f"{old}.{f}").eqNullSafe(F.col(f"{new}.{f}")), F.struct(F.lit(f).alias("field"), F.col(f"{old}.{f}").cast("string").alias("old"), F.col(f"{new}.{f}").cast("string").alias("new"))) for f in fields]
    return F.array_compact(F.array(*each))


def prepare(current: DataFrame, proposed: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """Each proposed row against the current one of its key: change_type CREATE, UPDATE or NO_CHANGE, and changes."""
    o, n = current.alias("o"), proposed.alias("n")
    both = n.join(o, F.col(f"n.{key}") == F.col(f"o.{key}"), "left")
    exists = F.col(f"o.{key}").isNotNull()
    changes = F.when(exists, field_changes("o", "n", fields))
    kind = F.when(~exists, "CREATE").when(F.size(changes) > 0, "UPDATE").otherwise("NO_CHANGE")
    return both.select(F.col(f"n.{key}").alias(key), kind.alias("change_type"), changes.alias("changes"))


def audit(prepared: DataFrame, key: str) -> DataFrame:
    """Audit rows of creations and updates; fields joined by ", "."""
    rows = prepared.where("change_type <> 'NO_CHANGE'")
    return rows.select(key, "change_type", F.coalesce(F.array_join(F.transform("changes", lambda c: c["field"]), ", "), F.lit("")).alias("field_changed"))


def run_statistics(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy("change_type").agg(F.count("*").alias("n"))


def upsert(current: DataFrame, proposed: DataFrame, keys: list[str], keep: tuple[str, ...] = ("created_at",)) -> DataFrame:
    """current with proposed written over it; `keep` columns stay as stored."""
    o, n = current.alias("o"), proposed.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    both = o.join(n, on, "full")
    there = F.col(f"n.{keys[0]}").isNotNull()
    value = lambda c: F.coalesce(f"o.{c}", f"n.{c}") if c in keep else F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(*[value(c).alias(c) for c in current.columns])


def upsert_nodes(current: DataFrame, proposed: DataFrame) -> DataFrame:
    """An upsert that leaves label and created_at of stored nodes alone."""
    return upsert(current, proposed, ["id"], ("created_at", "label"))


def upsert_edges(current: DataFrame, proposed: DataFrame) -> DataFrame:
    return upsert(current, proposed, ["source_id", "target_id", "relation"])


def event_edges(events: DataFrame) -> DataFrame:
    """(source_id, target_id, relation) that events imply, each once: hosts from the venue, performs_at from each artist.
    Events have different ids, so nothing needs a shuffle."""
    hosts = events.where(F.col("venue_id").isNotNull() & (F.col("venue_id").cast("string") != NIL_UUID)).select(F.col("venue_id").alias("source_id"), F.col("id").alias("target_id"), F.lit("hosts").alias("relation"))
    acts = events.select(F.explode(F.array_distinct("artist_ids")).alias("source_id"), F.col("id").alias("target_id"), F.lit("performs_at").alias("relation")).where(F.col("source_id").cast("string") != NIL_UUID)
    return hosts.unionByName(acts)


def orphan_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an end that is no node."""
    ids = nodes.select("id")
    both = edges.join(ids.withColumnRenamed("id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("id", "target_id"), "target_id", "left_semi")
    return edges.join(both, ["source_id", "target_id", "relation"], "left_anti")


def drop_nodes(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges without those in gone (id) and what is incident to them."""
    g = gone.select("id")
    left = edges.join(g.withColumnRenamed("id", "source_id"), "source_id", "left_anti").join(g.withColumnRenamed("id", "target_id"), "target_id", "left_anti")
    return nodes.join(g, "id", "left_anti"), left


def exclusive_artists(hosts: DataFrame, acts: DataFrame, venues: DataFrame) -> DataFrame:
    """Artists who play at the given venues (id) and nowhere else: hosts (venue_id, event_id), acts (artist_id, event_id)."""
    here = hosts.join(venues.select(F.col("id").alias("venue_id")), "venue_id", "left_semi").select("event_id")
    at_here = acts.join(here, "event_id", "left_semi").select("artist_id").distinct()
    elsewhere = acts.join(here, "event_id", "left_anti").select("artist_id")
    return at_here.join(elsewhere, "artist_id", "left_anti")


def venues_by_slug(nodes: DataFrame, slugs: list[str]) -> DataFrame:
    """(id) of venue nodes (id, label, data) whose data name one of the slugs."""
    return nodes.where((F.col("label") == "venue") & F.get_json_object("data", "$.slug").isin(slugs)).select("id")


def cascade(nodes: DataFrame, edges: DataFrame, venues: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """nodes (id, ...) and edges (source_id, target_id, relation, ...) without the venues (id), the events that they host, and
    the artists of these events whom no other venue holds: who performs at an event that stays and that a venue hosts which
    stays is kept. All that is incident to what goes goes with it. Venues may be given in bulk: an artist goes with the last
    one. Null ids among them delete nothing. One plan of joins, no step for each venue.

    Edges meet the events at their ends once, for the artists and for what stays. With a folder in the shared storage they are
    kept there until the results are made; without one, they meet anew for whatever asks."""
    gone = venues.select(F.col("id").alias("venue_id")).where("venue_id is not null").distinct()
    hosts = edges.where("relation = 'hosts'").select(F.col("source_id").alias("venue_id"), F.col("target_id").alias("event_id"))
    # ids that occur once are dealt evenly and looked up by hashing; they are not broadcast, since files of many look small to the planner
    hosted = hosts.join(gone.withColumn("_gone", F.lit(True)).hint("shuffle_hash"), "venue_id", "left").groupBy("event_id").agg(F.max(F.coalesce("_gone", F.lit(False))).alias("_gone"))
    met = edges.join(hosted.withColumnRenamed("event_id", "target_id").hint("shuffle_hash"), "target_id", "left")
    events = hosted.where("_gone").select(F.col("event_id").alias("id"))
    if folder:
        met = written(met, folder)
        events = met.where("relation = 'hosts' and _gone").select(F.col("target_id").alias("id"))
    acts = met.where("relation = 'performs_at' and _gone is not null")  # at events that a venue hosts
    artists = acts.groupBy("source_id").agg(F.every("_gone").alias("_gone")).where("_gone").select(F.col("source_id").alias("id"))
    all_gone = gone.select(F.col("venue_id").alias("id")).unionByName(events).unionByName(artists)
    return drop_nodes(nodes, met.where("_gone is null or not _gone").select(*edges.columns), all_gone)


def shared_artists(hosts: DataFrame, acts: DataFrame, venue) -> DataFrame:
    """Artists of a venue who also play at another one: only acts of the venue's artists are looked up."""
    here = acts.join(hosts.where(F.col("venue_id") == venue).select("event_id"), "event_id", "left_semi").select("artist_id").distinct()
    theirs = acts.join(here, "artist_id", "left_semi")
    return theirs.join(hosts.where(F.col("venue_id") != venue).select("event_id"), "event_id", "left_semi").select("artist_id").distinct()


def mark_processed(raw: DataFrame, done: DataFrame) -> DataFrame:
    flagged = done.select("id").distinct().withColumn("_done", F.lit(True))
    return raw.join(flagged, "id", "left").withColumn("processed", F.coalesce("_done", "processed")).drop("_done")


def with_enrichment(venues: DataFrame) -> DataFrame:
    """Enrichment's city and district, where there are any, over those of the venue."""
    return venues.withColumn("city", F.coalesce("enriched_city", "city")).withColumn("neighborhood", F.coalesce("district", "neighborhood"))


# The one venue of each of these sources.
SINGLE_VENUES = {"barboza": "The Barboza", "kexp": "KEXP Events", "blue_moon": "Blue Moon Tavern", "darrells_tavern": "Darrell's Tavern", "sea_monster": "Sea Monster Lounge"}


def resolve_venues(events: DataFrame, venues: DataFrame) -> DataFrame:
    """Events whose venue is the nil id get the venue of their source, if that is a known one in venues (id, name)."""
    names = F.create_map(*[F.lit(x) for kv in SINGLE_VENUES.items() for x in kv])
    known = venues.where(F.lower("name").isin(*[n.lower() for n in SINGLE_VENUES.values()])).groupBy(F.lower("name").alias("_name")).agg(F.min("id").alias("_id"))
    wanted = events.withColumn("_wanted", F.when(F.col("venue_id") == NIL_UUID, F.lower(F.try_element_at(names, F.col("source_id")))))
    return wanted.join(known, F.col("_wanted") == F.col("_name"), "left").withColumn("venue_id", F.coalesce("_id", "venue_id")).drop("_wanted", "_name", "_id")


def first_of(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def validation(events: DataFrame, as_of: Column) -> DataFrame:
    """One row: events, repeated (venue, day) pairs, venues, artists, events over a year ahead and over 30 days past."""
    pairs = events.groupBy("venue_id", "event_day").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_repeated"))
    ahead = F.datediff("event_day", as_of)
    base = events.agg(F.count("*").alias("n_events"), F.count_distinct("venue_id").alias("n_venues"), F.count_if(ahead > 365).alias("n_future"), F.count_if(ahead < -30).alias("n_past"))
    artists = events.select(F.explode("artist_ids").alias("a")).agg(F.count_distinct("a").alias("n_artists"))
    return base.crossJoin(pairs).crossJoin(artists)  # one row each


def repeated_signatures(events: DataFrame) -> DataFrame:
    """(signature, n): venue and day that more than one event has. Without a day or a venue there is no signature."""
    signature = F.concat(F.col("venue_id").cast("string"), F.lit("_"), F.col("event_day").cast("string"))
    return events.select(signature.alias("signature")).where("signature is not null").groupBy("signature").agg(F.count("*").alias("n")).where("n > 1")


def label_counts(table: DataFrame, label: str) -> DataFrame:
    return table.groupBy(label).agg(F.count("*").alias("n"))


def distinct_ends(edges: DataFrame, end: str) -> DataFrame:
    """Each id at one end of edges once."""
    return edges.select(end).distinct()


# Writes to storage: each gives the table as it is afterwards.


def stamped(merged: DataFrame, current: DataFrame, keys: list[str], now, fields: tuple[str, ...]) -> DataFrame:
    """merged with created_at and updated_at: rows that were there keep created_at, and updated_at where no field differs."""
    o, n, at = current.alias("o"), merged.drop("created_at", "updated_at").alias("n"), F.lit(now).cast("timestamp")
    both = n.join(o, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys], "left")
    there, same = F.col("o.created_at").isNotNull(), F.size(field_changes("o", "n", fields)) == 0
    return both.select("n.*", F.coalesce("o.created_at", at).alias("created_at"), F.when(there & same, F.col("o.updated_at")).otherwise(at).alias("updated_at"))


# What a venue without further knowledge gets.
VENUE_DEFAULTS = {"latitude": 47.6062, "longitude": -122.3321, "address": "Address TBD", "postal_code": "98101", "city": "Seattle"}


def default_venues(names: DataFrame) -> DataFrame:
    """Venue rows for bare names (id, name)."""
    from stagelight.functions.text import slug

    return names.select("id", "name", F.lower("name").alias("name_lower"), slug(F.col("name")).alias("slug"), *[F.lit(v).alias(k) for k, v in VENUE_DEFAULTS.items()], F.lit(True).alias("show_venue"))


def create(current: DataFrame, new: DataFrame, key: str | list[str], now) -> DataFrame:
    """Appends rows whose key is not there yet, one for each key (the smallest id), with created_at; a key without regard
    to case, as storage has it."""
    keys = [key] if isinstance(key, str) else key
    form = F.concat_ws("|", *[F.coalesce(F.lower(F.col(k).cast("string")), F.lit("")) for k in keys])
    fresh = new.withColumn("_key", form).join(current.select(form.alias("_key")), "_key", "left_anti")
    once = first_of(fresh, ["_key"], "id").drop("_key").withColumn("created_at", F.lit(now).cast("timestamp"))
    return current.unionByName(once, allowMissingColumns=True)


def create_raw_data(raw: DataFrame, new: DataFrame, now) -> DataFrame:
    """Appends raw rows that are not there yet, unprocessed."""
    return create(raw, new.withColumn("processed", F.lit(False)), "id", now)


def update_events(events: DataFrame, edges: DataFrame, proposed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events with proposed ones written over them, and the edges that follow: those of a proposed event are made anew, so
    what it no longer names goes."""
    others = edges.join(proposed.select(F.col("id").alias("target_id")).hint("shuffle_hash"), "target_id", "left_anti").select(*edges.columns)
    return upsert(events, proposed, ["id"]), others.unionByName(event_edges(proposed))


def clear(*tables: DataFrame) -> tuple[DataFrame, ...]:
    """The tables without rows."""
    return tuple(t.limit(0) for t in tables)


def create_process_records(records: DataFrame, edges: DataFrame, new: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """Appends audit records (id, process_run_id, ...) and a has_record edge from the run to each."""
    fresh = new.join(records.select("id"), "id", "left_anti").withColumn("created_at", F.lit(now).cast("timestamp"))
    has = fresh.select(F.col("process_run_id").alias("source_id"), F.col("id").alias("target_id"), F.lit("has_record").alias("relation"))
    return records.unionByName(fresh, allowMissingColumns=True), upsert_edges(edges, has)


# Entity kinds


@dataclass(frozen=True)
class Handler:
    """How one kind of entity is compared, keyed and mapped from resolved records."""

    kind: str
    fields: tuple[str, ...]
    key: tuple[str, ...]
    mapper: Callable[[DataFrame], DataFrame] = lambda df: df

    def candidates(self, current: DataFrame, resolved: DataFrame) -> DataFrame:
        """What the resolved records would change in the stored table, by stored id."""
        return prepare(current, self.mapper(resolved), "id", self.fields)

    def persist(self, current: DataFrame, resolved: DataFrame) -> DataFrame:
        return upsert(current, self.mapper(resolved).select(*current.columns), ["id"])


# The archived pipeline's test of an event update looks at these alone.
LEGACY_EVENT_FIELDS = ("start_time", "event_url", "description", "event_image_url", "artist_ids")
HANDLERS: dict[str, Handler] = {}


def register(handler: Handler) -> None:
    HANDLERS[handler.kind] = handler


def process_run(spark, run_id: str, name: str, started) -> DataFrame:
    return spark.createDataFrame([(run_id, name, started, None)], "id string, name string, created_at timestamp, finished_at timestamp")


def finish_run(run: DataFrame, finished) -> DataFrame:
    """Sets the end; name and start stay."""
    return run.withColumn("finished_at", F.lit(finished).cast("timestamp"))


def run_records(runs: DataFrame, records: DataFrame) -> DataFrame:
    """Records of each run by change type."""
    return runs.select(F.col("id").alias("process_run_id"), "name").join(records, "process_run_id").groupBy("process_run_id", "name", "change_type").agg(F.count("*").alias("n"))


def legacy_audit(outcomes: dict[str, DataFrame], errors: DataFrame) -> DataFrame:
    """The archived audit: one row for each outcome of each entity, and one for each raw record that failed.
    outcomes: entity -> (id, change_type); errors: (id, error)."""
    parts = [d.select(F.lit(e).alias("entity"), F.col("id").cast("string").alias("id"), "change_type", F.lit(None).cast("string").alias("error")) for e, d in outcomes.items()]
    parts.append(errors.select(F.lit("raw_data").alias("entity"), F.col("id").cast("string").alias("id"), F.lit("ERROR").alias("change_type"), "error"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


register(Handler("venue", VENUE_FIELDS, ("slug",), with_enrichment))
register(Handler("artist", ARTIST_FIELDS, ("name_slug",)))
register(Handler("event", EVENT_FIELDS, ("title", "venue_id", "event_day")))

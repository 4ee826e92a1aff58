"""Questions about venues, artists and events: each is a function from tables to a table; Catalyst pushes filters down."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagelight.lineage import cut

PAGE = 20


def page(df: DataFrame, limit: int | None = None, offset: int | None = None, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows of an ordered table from an offset on, no more than the limit. With a limit no more than offset + limit rows leave
    a task; an offset alone is found by ranks within ranges of the order's columns."""
    if offset and limit is None and order:
        return skipped(df, order, offset)
    df = df.offset(offset) if offset else df
    return df if limit is None else df.limit(limit)


def skipped(df: DataFrame, order: tuple[str, ...], offset: int) -> DataFrame:
    """All but the first `offset` rows in an order. Ranges are ranked by themselves; one number for each goes to the others."""
    dealt = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    begins = dealt.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy(*order))).join(begins, "_range")
    return ranked.where(F.col("_before") + F.col("_rank") > offset).select(*df.columns).orderBy(*order)


def web_page(df: DataFrame, number: int = 0, size: int = PAGE) -> DataFrame:
    """A numbered page, from 0, of the size that web pages have."""
    return page(df, size, number * size)


def same(column: str, text: str) -> Column:
    return F.lower(column) == F.lower(F.lit(text))


def holds(column: str, text: str) -> Column:
    """Contains, whatever the case; % and _ are plain characters."""
    return F.contains(F.lower(column), F.lower(F.lit(text)))


def event_with_venue(events: DataFrame, venues: DataFrame) -> DataFrame:
    v = venues.select(F.col("id").alias("venue_id"), F.col("name").alias("venue_name"))
    return events.join(v, "venue_id", "left")


def event_artists(events: DataFrame, artists: DataFrame) -> DataFrame:
    """(id, artists): names in the event's order; unknown artists are left out."""
    listed = events.select("id", F.posexplode("artist_ids").alias("pos", "artist_id"))
    named = listed.join(artists.select(F.col("id").alias("artist_id"), "name"), "artist_id")
    return named.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "name"))), lambda s: s["name"]).alias("artists"))


@dataclass
class Listings:
    """The query surface over three tables and, for traversals, the edges."""

    venues_table: DataFrame
    artists_table: DataFrame
    events_table: DataFrame
    edges: DataFrame | None = None
    as_of: date | None = None

    def _today(self) -> Column:
        return F.lit(self.as_of).cast("date")

    def _future(self, df: DataFrame, include_past: bool) -> DataFrame:
        return df if include_past else df.where(F.col("event_day") >= self._today())

    def venue(self, id_) -> DataFrame:
        return self.venues_table.where(F.col("id") == id_)

    def venues(self, limit: int | None = None, offset: int | None = None) -> DataFrame:
        return page(self.venues_table.orderBy("name", "id"), limit, offset, ("name", "id"))

    def venues_by_city(self, city: str) -> DataFrame:
        return self.venues_table.where(same("city", city)).orderBy("name", "id")

    def venue_by_name(self, name: str) -> DataFrame:
        return self.venues_table.where(same("name", name)).orderBy("id").limit(1)

    def venue_by_slug(self, slug: str) -> DataFrame:
        from stagelight.functions.text import slug_ascii

        return self.venues_table.where(slug_ascii(F.col("name")) == slug)

    def venues_by_ids(self, ids: list) -> DataFrame:
        return self._by_ids(self.venues_table, ids)

    def artist(self, id_) -> DataFrame:
        return self.artists_table.where(F.col("id") == id_)

    def artists(self, limit: int | None = None, offset: int | None = None) -> DataFrame:
        return page(self.artists_table.orderBy("name", "id"), limit, offset, ("name", "id"))

    def artist_by_name(self, name: str) -> DataFrame:
        return self.artists_table.where(same("name", name)).orderBy("id").limit(1)

    def artist_by_slug(self, slug: str) -> DataFrame:
        return self.artists_table.where(F.col("name_slug") == slug)

    def artists_by_ids(self, ids: list) -> DataFrame:
        return self._by_ids(self.artists_table, ids)

    def search_artists(self, text: str) -> DataFrame:
        return self.artists_table.where(holds("name", text)).orderBy("name", "id")

    def event(self, id_) -> DataFrame:
        return self.events_table.where(F.col("id") == id_)

    def events(self, limit: int | None = None, offset: int | None = None, include_past: bool = False) -> DataFrame:
        return page(self._future(self.events_table, include_past).orderBy("event_day", "id"), limit, offset, ("event_day", "id"))

    def all_events(self, limit: int | None = None, offset: int | None = None) -> DataFrame:
        return self.events(limit, offset, True)

    def events_by_venue(self, venue_id, include_past: bool = False) -> DataFrame:
        return self._future(self.events_table.where(F.col("venue_id") == venue_id), include_past).orderBy("event_day", "id")

    def events_by_date_range(self, start: date, end: date) -> DataFrame:
        return self.events_table.where(F.col("event_day").between(F.lit(start), F.lit(end))).orderBy("event_day", "id")

    def upcoming_events(self, days: int = 30) -> DataFrame:
        return self.events_table.where(F.col("event_day").between(self._today(), F.date_add(self._today(), days))).orderBy("event_day", "id")

    def search_events(self, search: str | None = None, venue: str | None = None, limit: int | None = None, offset: int | None = None) -> DataFrame:
        found = self._future(self.events_table, False)
        if search:
            found = found.where(holds("title", search))
        if venue:
            found = found.join(self.venues_table.where(holds("name", venue)).select(F.col("id").alias("venue_id")), "venue_id", "left_semi")
        return page(found.orderBy("event_day", "id"), limit, offset, ("event_day", "id"))

    def event_by_venue_day_title(self, venue_id, day: date, title: str) -> DataFrame:
        return self.events_table.where((F.col("venue_id") == venue_id) & (F.col("event_day") == F.lit(day)) & same("title", title)).orderBy("id").limit(1)

    def _linked(self, id_, relation: str) -> DataFrame:
        mine = self.edges.where((F.col("source_id") == id_) & (F.col("relation") == relation)).select(F.col("target_id").alias("id"))
        return self.events_table.join(mine, "id", "left_semi").orderBy("event_day", "id")

    def venue_events(self, id_) -> DataFrame:
        return self._linked(id_, "hosts")

    def artist_events(self, id_) -> DataFrame:
        return self._linked(id_, "performs_at") if self.edges is not None else self.events_table.where(F.array_contains("artist_ids", id_)).orderBy("event_day", "id")

    def incident_edges(self, id_) -> DataFrame:
        return self.edges.where((F.col("source_id") == id_) | (F.col("target_id") == id_))

    def delete_events_by_venue_name(self, name: str) -> tuple[DataFrame, DataFrame]:
        """What stays, and how many rows went (one row)."""
        at = self.venues_table.where(same("name", name)).select(F.col("id").alias("venue_id"))
        return self.events_table.join(at, "venue_id", "left_anti"), self.events_table.join(at, "venue_id", "left_semi").agg(F.count("*").alias("n_deleted"))

    def delete_event(self, id_) -> tuple[DataFrame, DataFrame | None]:
        """The events without one, and the edges without those that touch it."""
        kept = None if self.edges is None else self.edges.where((F.col("source_id") != id_) & (F.col("target_id") != id_))
        return self.events_table.where(F.col("id") != id_), kept

    @staticmethod
    def _by_ids(df: DataFrame, ids: list) -> DataFrame:
        """In the order of ids; unknown ones are left out."""
        wanted = df.sparkSession.createDataFrame(list(enumerate(ids)), "pos int, id " + dict(df.dtypes)["id"])
        return df.join(wanted, "id").orderBy("pos").drop("pos")  # the caller's list may be long: Spark picks the join by its size


def events_with_artist(events: DataFrame, artist_id) -> DataFrame:
    """Events (…, artists array<struct<id, …>>) that list an artist."""
    return events.where(F.exists("artists", lambda a: a["id"] == artist_id))


def unprocessed(raw: DataFrame, source: str, processed: bool = False, since: date | None = None) -> DataFrame:
    rows = raw.where((F.col("api_name") == source) & (F.col("processed") == processed))
    return (rows if since is None else rows.where(F.col("event_day") >= F.lit(since))).orderBy("event_day", "id")


def most_recent(raw: DataFrame, keys: list[str], order: str = "created_at", tie: str = "id") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order), F.desc(tie))
    return raw.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def decode(nodes: DataFrame, label: str, schema: str) -> DataFrame:
    """Entities of a label from their JSON; the id column wins over an id in the JSON."""
    rows = nodes.where(F.col("label") == label)
    return rows.select(F.from_json("data", schema).withField("id", F.col("id")).alias("e")).select("e.*")

"""Entity resolution against a store that grows: what a batch creates, the next one finds.

The store is two index tables of known entities, by compared name and by location cell, in hash partitions of their key.
A batch reads only partitions that its own keys fall into, and its new entities are appended after it, under the batch's
number: a batch that is run again first finds its own rows as they were not, and then replaces them, so it gives the same.

Decision, score and thresholds are those of `conflation.resolve`. The work grows with distinct attributes instead of pairs
of rows: rows that are equal in all that is compared are one class on either side, with their number and smallest ids. An
event's score depends only on whether day and venue agree, so its matches are counted, and the best ones listed, from four
aggregates of the known events of its name, and no two events are paired. Artists of one name all score 1. Venues are paired
by class: distinct places and addresses of one name, and of one cell.

Scores are rounded to nine digits, so that equal distances tie. Counts of matches and duplicates are exact. Alternatives are the `keep` best by score and id, whatever their number: a name
that a third of all records share gives short lists.

Null names match nothing by name; venues without both coordinates have no cell. Rows with equal ids are one entity of the
store if they are equal, and several otherwise. Empty batches and an empty store are no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagelight.functions import geo
from stagelight.functions import text as T
from stagelight.lineage import cut, exists, remove
from stagelight.operators.conflation import BY_NAME, BY_PLACE, DUPLICATE, MATCH, similarity

BUCKETS, KEEP = 64, 10
_COMPARED = ("latitude", "longitude", "address", "event_day", "venue_id")
_TYPES = {"id": "string", "entity_type": "string", "key": "string", "cell": "string", "latitude": "double", "longitude": "double", "address": "string", "event_day": "date", "venue_id": "string"}
SCHEMA = ", ".join(f"{n} {t}" for n, t in _TYPES.items()) + ", bucket int, batch long"


def compared(records: DataFrame) -> DataFrame:
    """Records as the indexes hold them; ids are text."""
    key = T.match_name(F.col("name"))
    cell = F.when(F.col("entity_type") == "venue", geo.location_cell(F.col("latitude"), F.col("longitude")))
    return records.select(F.col("id").cast("string").alias("id"), "entity_type", key.alias("key"), cell.alias("cell"), *[F.col(c).cast(_TYPES[c]).alias(c) for c in _COMPARED])


def _bucket(*keys: str, n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def smallest(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    """For each group its number of rows and its n smallest ids, in order. The group limit keeps n a task before the shuffle."""
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("_n") <= n)
    lists = ranked.groupBy(*by).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    counts = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.count("*").alias("n"))
    return lists.join(counts, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).select(*by, "ids", "n")


def _scored(ids: Column, score: float) -> Column:
    return F.transform(ids, lambda i: F.struct(i.alias("id"), F.lit(score).alias("score")))


class EntityStore:
    """Known entities in a folder that Spark reads and writes."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS, keep: int = KEEP):
        self.spark, self.folder, self.buckets, self.keep = spark, folder, buckets, keep

    def _index(self, name: str, before: int) -> DataFrame:
        """Entities of batches before this one."""
        path = f"{self.folder}/{name}"
        read = self.spark.read.schema(SCHEMA)
        return (read.parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], SCHEMA)).where(F.col("batch") < before)

    def _near(self, name: str, before: int, keys: DataFrame, *by: str) -> DataFrame:
        """Rows of an index with keys of this batch; only partitions that these fall into are read."""
        buckets = [r[0] for r in keys.select("bucket").distinct().collect()]  # no more than the store has
        rows = self._index(name, before).where(F.col("bucket").isin(buckets))
        return rows.join(keys.select(*by).distinct(), list(by), "left_semi")

    def add(self, entities: DataFrame, batch: int) -> None:
        """Appends entities under the batch's number, in place of those that it had appended before."""
        rows = compared(entities)
        self._append(rows.where("key is not null"), "by_name", batch, "entity_type", "key")
        self._append(rows.where("cell is not null"), "by_cell", batch, "cell")

    def _append(self, rows: DataFrame, name: str, batch: int, *by: str) -> None:
        rows = rows.withColumn("bucket", _bucket(*by, n=self.buckets)).withColumn("batch", F.lit(batch).cast("long"))
        path = f"{self.folder}/{name}"
        remove(self.spark, f"{path}/batch={batch}")  # what a run that failed may have left
        rows.repartition("bucket").sortWithinPartitions("bucket", *by).write.mode("append").partitionBy("batch", "bucket").parquet(path)

    def resolve(self, records: DataFrame, batch: int) -> DataFrame:
        """records (id, entity_type, name, latitude, longitude, address, event_day, venue_id) of one batch, numbered upwards:
        resolution, canonical_id, confidence, best_score, n_matches, n_duplicates, alternatives (the `keep` best). New
        entities go into the store."""
        rows = records.withColumn("_key", T.match_name(F.col("name")))
        matches = self._matches(compared(records), batch)
        same = [F.col(c).cast(_TYPES[c]).eqNullSafe(F.col(f"c_{c}")) for c in ("entity_type", *_COMPARED)]
        out = rows.join(matches, [F.col("_key").eqNullSafe(F.col("c_key")), *same], "left")
        matched = F.when(F.col("best_score") >= MATCH, F.get("top", F.lit(0))["id"])
        rest = F.when(matched.isNull(), F.slice("top", 1, self.keep)).otherwise(F.slice("top", 2, self.keep))
        reason = lambda m: F.when(m["score"] < MATCH, "Similarity score below threshold").otherwise("Lower similarity than selected match")
        alternatives = F.transform(rest, lambda m: F.struct(m["id"].alias("entity_id"), m["score"].alias("similarity_score"), reason(m).alias("rejection_reason")))
        result = cut(out.select(
            F.col("id").cast("string").alias("id"), F.when(matched.isNull(), "NewEntity").otherwise("MatchedExisting").alias("resolution"), F.coalesce(matched, F.col("id").cast("string")).alias("canonical_id"),
            F.when(matched.isNotNull(), F.col("best_score")).when(F.col("best_score").isNotNull(), 0.6).otherwise(1.0).alias("confidence"), "best_score", F.coalesce("n_matches", F.lit(0).cast("long")).alias("n_matches"),
            F.coalesce("n_duplicates", F.lit(0).cast("long")).alias("n_duplicates"), alternatives.alias("alternatives"),
        ))
        new = result.where("resolution = 'NewEntity'").select(F.col("id").alias("_id")).distinct()
        self.add(records.join(new, F.col("id").cast("string") == F.col("_id"), "left_semi"), batch)
        return result

    def _matches(self, rows: DataFrame, batch: int) -> DataFrame:
        """For each class of records (c_...): best_score, n_matches, n_duplicates and top, the keep + 1 best as (id, score)."""
        names = [n for n in _TYPES if n != "id"]
        classes = cut(rows.select(*names).distinct())
        by_name = classes.where("key is not null").withColumn("bucket", _bucket("entity_type", "key", n=self.buckets))
        by_cell = classes.where("cell is not null").withColumn("bucket", _bucket("cell", n=self.buckets))
        known = cut(self._near("by_name", batch, by_name, "entity_type", "key"))
        placed = self._near("by_cell", batch, by_cell, "cell")
        parts = [self._events(classes, known), self._artists(classes, known), self._venues(classes, known, placed)]
        found = parts[0].unionByName(parts[1]).unionByName(parts[2])
        return found.select(*[F.col(n).alias(f"c_{n}") for n in names], "n_matches", "n_duplicates", "top", F.get("top", F.lit(0))["score"].alias("best_score"))

    def _best(self, lists: Column) -> Column:
        """The best of array<(id, score)>: by score, then by id, each id at its best score."""
        ordered = F.sort_array(F.transform(lists, lambda m: F.struct((-m["score"]).alias("s"), m["id"].alias("id"))))
        seen = F.transform(ordered, lambda m: m["id"])
        once = F.filter(ordered, lambda m, i: F.array_position(seen, m["id"]) == i + 1)
        return F.transform(F.slice(once, 1, self.keep + 1), lambda m: F.struct(m["id"].alias("id"), (-m["s"]).alias("score")))

    def _events(self, classes: DataFrame, known: DataFrame) -> DataFrame:
        """By name, name and day, name and venue, and all three. Each level lists so many that what the better ones already
        have cannot crowd out the rest."""
        out = classes.where("entity_type = 'event' and key is not null")
        events, want = known.where("entity_type = 'event'"), self.keep + 1
        levels = {"all": (["key", "event_day", "venue_id"], 1.0, 1), "day": (["key", "event_day"], 0.8, 2), "venue": (["key", "venue_id"], 0.7, 2), "name": (["key"], 0.5, 4)}
        for level, (by, _, more) in levels.items():
            found = smallest(events.dropna(subset=by), by, more * want)
            out = out.join(found.select(*by, F.col("ids").alias(f"ids_{level}"), F.col("n").alias(f"n_{level}")), by, "left")
        scored = [_scored(F.coalesce(f"ids_{level}", F.array().cast("array<string>")), score) for level, (_, score, _) in levels.items()]
        out = out.where("n_name is not null").withColumn("top", self._best(F.concat(*scored)))
        return out.select(*classes.columns, F.col("n_name").alias("n_matches"), F.coalesce("n_all", F.lit(0).cast("long")).alias("n_duplicates"), "top")

    def _artists(self, classes: DataFrame, known: DataFrame) -> DataFrame:
        """Equal names, which is a score of 1."""
        found = smallest(known.where("entity_type = 'artist'"), ["key"], self.keep + 1)
        out = classes.where("entity_type = 'artist'").join(found, "key")
        return out.select(*classes.columns, F.col("n").alias("n_matches"), F.col("n").alias("n_duplicates"), _scored(F.col("ids"), 1.0).alias("top"))

    def _venues(self, classes: DataFrame, known: DataFrame, placed: DataFrame) -> DataFrame:
        """Classes of one name, and those of one cell with another name."""
        side = lambda df, p, *more: df.select(*[F.col(c).alias(f"{p}_{c}") for c in (*_TYPES, "name")[1:-1]], F.col("key").alias(f"{p}_name"), *more)
        mine = side(classes.where("entity_type = 'venue'"), "r")
        group = [n for n in _TYPES if n != "id"]
        theirs = lambda df: side(smallest(df.where("entity_type = 'venue'"), group, self.keep + 1), "c", "ids", "n")
        named = mine.join(theirs(known), F.col("r_key") == F.col("c_key")).withColumn("least", F.lit(BY_NAME))
        near = mine.join(theirs(placed), F.col("r_cell") == F.col("c_cell")).where(~F.col("r_key").eqNullSafe(F.col("c_key"))).withColumn("least", F.lit(BY_PLACE))
        pairs = named.unionByName(near).withColumn("score", F.round(similarity(), 9)).where("score > least")
        mine_of = [f"r_{n}" for n in group]
        counts = pairs.groupBy(*mine_of).agg(F.sum("n").alias("n_matches"), F.coalesce(F.sum(F.when(F.col("score") > DUPLICATE, F.col("n"))), F.lit(0)).alias("n_duplicates"))
        each = pairs.select(*mine_of, F.explode("ids").alias("id"), "score")
        order = Window.partitionBy(*mine_of).orderBy(F.desc("score"), "id")
        best = each.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= self.keep + 1)
        best = best.groupBy(*[F.col(c).alias(f"b{c}") for c in mine_of]).agg(self._best(F.collect_list(F.struct("id", "score"))).alias("top"))  # keep + 1 of them
        both = counts.join(best, [F.col(c).eqNullSafe(F.col(f"b{c}")) for c in mine_of])
        return both.select(*[F.col(f"r_{n}").alias(n) for n in group], "n_matches", "n_duplicates", "top")

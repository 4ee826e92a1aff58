"""Resolution of names within a batch: a name that a batch creates is known to the names that follow.

Names are read in the order of their ids. A name stands for the known entity of the same name, else for the first known one
that is similar, else for the first created one that is similar, else it creates an entity. Known ones come before created
ones, and both go by id. Created names are the lexicographically first maximal independent set of the similarity graph over
names that match nothing known: a name is created if no created one before it is similar.

That set is found in rounds. A name without an earlier similar one is created; every name similar to a created one is out,
and takes its edges with it. Each round is two joins over the edges that are left, kept in the shared folder; only their
number reaches the driver. LOCAL edges or fewer are settled in one task, in order.

Equal names are one, so a name that very many rows have is one node. Rows without a name get nothing. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.functions import text as T
from stagelight.lineage import cut
from stagelight.operators.conflation import fuzzy_match, similar_names

#: Edges that one task settles, in some 200 MB
LOCAL = 1_000_000
#: List places that a row's id is followed by in the order of reading
PLACES = 2**31


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(later, earlier) of all edges, by later -> names that are out."""
    out: set = set()
    for b in batches:
        for later, earlier in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if earlier not in out:
                out.add(later)
    yield pa.RecordBatch.from_arrays([pa.array(sorted(out), b.column(0).type if out else pa.decimal128(38, 0))], names=["id"])


def similar_to_created(edges: DataFrame) -> DataFrame:
    """edges (later, earlier), decimals -> (id): nodes that are not in the lexicographically first maximal independent set."""
    live, out = cut(edges.select("later", "earlier").distinct()), None
    while n := live.count():
        if n <= LOCAL:
            gone = cut(live.coalesce(1).sortWithinPartitions("later", "earlier").mapInArrow(_settled, "id decimal(38,0)"))
            return gone if out is None else out.unionByName(gone)
        first = live.select("earlier").distinct().join(live.select(F.col("later").alias("earlier")), "earlier", "left_anti")
        gone = cut(live.join(first, "earlier", "left_semi").select(F.col("later").alias("id")).distinct())
        live = live.join(gone.withColumnRenamed("id", "later"), "later", "left_anti")
        live = cut(live.join(gone.withColumnRenamed("id", "earlier"), "earlier", "left_anti").select("later", "earlier"))
        out = gone if out is None else out.unionByName(gone)
    return edges.select(F.col("later").alias("id")).limit(0) if out is None else out


def resolve_names(names: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """names (id, name), known (id, name), in compared form -> names with known_id, creator_id (the smallest id with the name
    that was created) and similarity, 1 for equal and for created names. The threshold is over 0."""
    named = names.where("name is not null")
    first = named.groupBy("name").agg(F.min("id").cast("decimal(38,0)").alias("id"))
    against = cut(fuzzy_match(first, known, threshold))
    fresh = against.where("matched_id is null").select("id", "name")
    pairs = similar_names(fresh, fresh, threshold).where("known_id < id")
    edges = cut(pairs.select(F.col("id").alias("later"), F.col("known_id").alias("earlier"), "s"))
    out = cut(similar_to_created(edges))
    to = edges.join(out.withColumnRenamed("id", "earlier"), "earlier", "left_anti").groupBy(F.col("later").alias("id")).agg(F.min(F.struct("earlier", "s")).alias("to"))
    made = fresh.join(to, "id", "left").select("name", F.coalesce("to.earlier", "id").alias("creator_id"), F.coalesce("to.s", F.lit(1.0)).alias("near"))
    found = against.join(made, "name", "left").select("name", F.col("matched_id").alias("known_id"), "creator_id", F.coalesce("similarity", "near").alias("similarity"))
    return names.join(found, "name", "left").select("id", "name", "known_id", F.col("creator_id").cast("long").alias("creator_id") if _whole(names) else "creator_id", "similarity")


def _whole(names: DataFrame) -> bool:
    return dict(names.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint")


def resolve_venues(venues: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Venue names as they were read, against known venues (id, name); names are compared without common venue words."""
    form = lambda df: df.select("id", T.venue_core_name(F.col("name")).alias("name"))
    return resolve_names(form(venues), form(known), threshold)


def resolve_artists(lists: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """lists (id, names) and known artists (id, name) -> (id, artists): for each name of a row, in its order, a struct of
    known_id, creator_id and creator_pos (row and place that created it) and similarity. Names are read by row and place."""
    order = (F.col("id").cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + F.col("pos")).cast("decimal(38,0)")
    each = lists.select("id", F.posexplode("names").alias("pos", "name")).select("id", "pos", order.alias("at"), T.artist_core_name(F.col("name")).alias("name"))
    found = resolve_names(each.select(F.col("at").alias("id"), "name"), known.select("id", T.artist_core_name(F.col("name")).alias("name")), threshold)
    row = F.floor(F.col("creator_id") / F.lit(PLACES).cast("decimal(10,0)")).cast("long")
    place = F.pmod("creator_id", F.lit(PLACES).cast("decimal(10,0)")).cast("int")
    found = found.select(F.col("id").alias("at"), F.struct("known_id", row.alias("creator_id"), place.alias("creator_pos"), "similarity").alias("a"))
    rows = each.join(found, "at").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "a"))).alias("l"))
    return lists.select("id").join(rows, "id", "left").select("id", F.coalesce(F.transform("l", lambda x: x["a"]), F.array().cast(rows.select(F.transform("l", lambda x: x["a"]).alias("l")).schema["l"].dataType)).alias("artists"))


def new_entities(resolved: DataFrame, kind: str) -> DataFrame:
    """(id, name, entity_id) of the entities that a batch created, with name-based ids."""
    own = resolved.where(F.col("creator_id") == F.col("id"))
    return own.select("id", "name", T.uuid5(F.concat(F.lit(f"{kind}:"), F.col("name"))).alias("entity_id"))

"""Centroid clustering by Delta Lloyd, in whole numbers.

Vectors with exactly `size` components, none null or non-finite, become whole numbers floor(scale * x). Centroids start as
the k vectors whose ids have the smallest hashes. A round assigns each vector to its nearest centroid and then moves each
centroid that has any to the floor of its vectors' mean; after the last round vectors are assigned once more.

Deltas. The table of vectors with their owner and its distance is stored after each round, and the centroids' sums and
counts are carried on. A later round compares a vector only with the centroids that moved, if its own one did not, as the
others were no nearer before; a vector whose owner moved is compared with all. Sums change by signed transfers: vectors that
changed owner are taken from the old one and added to the new one, summed up in each task before they meet. A round in
which no centroid moved leaves all as it is and is passed over.

What goes through the driver is of k * size numbers. A cluster with most of the vectors is no group anywhere: sums are made
per task. All sums and distances are exact: in doubles while they are below 2^53, else in 64-bit whole numbers.

Ties go to the smaller centroid; equal hashes, as of repeated ids, go by the vectors' numbers. A null id hashes as the empty
text and stays in the result. Rows each stay. With fewer than k vectors there are as many centroids. Components beyond
LARGEST count as that, so that distances fit their type; vectors of another length take no part. Extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import Stored, cut, only

K, ROUNDS, SIZE, SCALE, SEED = 16, 3, 64, 64, 1
#: Of a component in whole numbers: 64 squares of twice that fit 63 bits
LARGEST = 2**27
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(n, k) squared distances of whole numbers, exact."""
    most = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if 4 * x.shape[1] * int(most) ** 2 < 2**53:  # every product and sum is a whole number that a double holds
        a, b = x.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def reassigned(x: np.ndarray, owner: np.ndarray, far: np.ndarray, centroids: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners and distances after the centroids at `moved` moved. A vector whose owner stayed looks at those alone."""
    owner, far = owner.copy(), far.copy()
    again = np.isin(owner, moved) | (owner < 0)
    if again.any():
        d = distances(x[again], centroids)
        owner[again] = d.argmin(1)  # the first of equal ones
        far[again] = d.min(1)
    if not again.all() and len(moved):
        d = distances(x[~again], centroids[moved])
        best, near = moved[d.argmin(1)], d.min(1)
        old, was = owner[~again], far[~again]
        better = (near < was) | ((near == was) & (best < old))
        owner[~again], far[~again] = np.where(better, best, old), np.where(better, near, was)
    return owner, far


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64)


def _assign(shared, size: int):
    """(vec_id, v, owner, far) -> the same and was: the owner before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, moved = shared.value
        for b in batches:
            was, far = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            owner, far = reassigned(_matrix(b.column(1), size), was.astype(np.int64), far, centroids, moved)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(owner.astype(np.int32)), pa.array(far), pa.array(was.astype(np.int32)), pa.array(owner != was)], names=["vec_id", "v", "owner", "far", "was", "changed"])

    return run


def _transfers(size: int, k: int):
    """(v, owner, was) -> (centroid, place, amount): what a task's vectors add and take; place -1 is the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 1), np.int64)
        for b in batches:
            x = _matrix(b.column(0), size)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], 1)
            owner, was = b.column(1).to_numpy(), b.column(2).to_numpy()
            np.add.at(total, owner, x)
            np.subtract.at(total, was[was >= 0], x[was >= 0])
        centroid, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(centroid.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total[centroid, place])], names=["centroid", "place", "amount"])

    return run


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Each vector's cluster and distance, with the sums of distances and a digest of the centroid's numbers."""
    spark = vectors.sparkSession
    sound = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = only(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).where((F.size("x") == size) & sound)
    bound = float(LARGEST)
    whole = F.transform("x", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(bound)), F.lit(-bound))).cast("int"))
    rows = rows.select("vec_id", whole.alias("v"))
    state = Stored(rows.select("vec_id", "v", F.lit(-1).alias("owner"), F.lit(0).cast("long").alias("far")))
    try:
        named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
        first = state.df.select("v", named.alias("h")).orderBy("h", "v").limit(k).collect()  # k rows
        if not first:
            return spark.createDataFrame([], RESULT)
        centroids = np.array([r["v"] for r in first], np.int64)
        k, moved = len(centroids), np.arange(len(centroids))
        total = np.zeros((k, size + 1), np.int64)
        for _ in range(rounds):
            if not len(moved):
                break
            shared = spark.sparkContext.broadcast((centroids, moved))  # k vectors
            after = Stored(state.df.select("vec_id", "v", "owner", "far").mapInArrow(_assign(shared, size), "vec_id long, v array<int>, owner int, far long, was int, changed boolean"))
            state.drop()
            state = after
            partial = state.df.where("changed").select("v", "owner", "was").mapInArrow(_transfers(size, k), "centroid int, place int, amount long")
            for r in partial.groupBy("centroid", "place").agg(F.sum("amount").alias("amount")).collect():  # k * (size + 1) numbers at most
                total[r["centroid"], r["place"]] += r["amount"]
            shared.destroy()
            some = total[:, size] > 0
            new = centroids.copy()
            new[some] = total[some, :size] // total[some, size:]
            moved = np.flatnonzero((new != centroids).any(1))
            centroids = new
        shared = spark.sparkContext.broadcast((centroids, moved))
        last = state.df.select("vec_id", "v", "owner", "far").mapInArrow(_assign(shared, size), "vec_id long, v array<int>, owner int, far long, was int, changed boolean")
        last = cut(last.select("vec_id", F.col("owner").alias("cluster"), F.col("far").alias("distance")))
        sums = {r["cluster"]: r["s"] for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k numbers
        digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
        of = lambda values: F.array(*[F.lit(x) for x in values])[F.col("cluster")]
        return last.select("vec_id", "cluster", "distance", of([sums.get(i, 0) for i in range(k)]).cast("long").alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), of(digests).alias("centroid_sha256"))
    finally:
        state.drop()


def _oracle(k: int = K, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED) -> str:
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS c FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"m0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, c) - 1)::INTEGER AS cluster, c FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, c FROM v) ORDER BY h, c LIMIT {k})",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT v.rid, v.vec_id, v.c, min(struct_pack(distance := list_sum(list_transform(list_zip(v.c, m.c), lambda z: ((z[1] - z[2]) * (z[1] - z[2]))::BIGINT))::BIGINT, cluster := m.cluster)) AS b
  FROM v CROSS JOIN m{i} m GROUP BY ALL)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT b.cluster AS cluster, unnest(c) AS x, generate_subscripts(c, 1) AS place FROM a{i}),
f{i} AS (SELECT cluster, place, sum(x)::BIGINT AS s, count(*) AS n FROM s{i} GROUP BY ALL),
n{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM f{i} GROUP BY cluster),
m{i + 1} AS MATERIALIZED (SELECT m.cluster, coalesce(n.c, m.c) AS c FROM m{i} m LEFT JOIN n{i} n USING (cluster))""")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, m.cluster, b.distance AS distance, sum(b.distance) OVER (PARTITION BY m.cluster)::BIGINT AS cluster_inertia, sum(b.distance) OVER ()::BIGINT AS inertia, sha256(list_aggregate(m.c, 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN m{rounds} m ON b.cluster = m.cluster"""


ORACLE = _oracle()

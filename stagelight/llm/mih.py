"""Nearest neighbours by largest inner product, with multi-index hashing.

Codes. Vectors are scaled by the largest norm and get one more component that makes all norms 1, so that the largest inner
product is the smallest angle. Rotations learned on at most SAMPLE vectors (principal directions, then iterative
quantisation from several starts) give each vector a binary code of up to BITS bits.

Index. Codes are cut into substrings of 16 bits, and each shard of a task's vectors holds a table of every substring:
value -> codes. By the pigeonhole principle a code within radius r = m * a + b of a query's (m substrings, b < m) is within
a in one of the first b + 1 substrings, or within a - 1 in one of the others; all these buckets are probed. Where that is
more entries than the shard has codes, its codes are compared one after the other, which finds the same.

Radius. Each query's own: the one that holds `enough` codes, as told by the sample's codes. `enough` is doubled until on
PROBED queries, searched by brute force over all rows, LEAST_RECALL of the true neighbours are within their radius; the
last step is the whole code length, which leaves nothing out. A radius depends neither on shards nor on partitions.
Codes within it are ranked by exact inner products of the original vectors, k a shard go on, and these are merged.

Work. Codes and radii of queries are made in tasks and written to the shared folder. A task encodes and indexes each of its
shards once, and reads the queries for it from there, batch by batch, by Arrow's file systems; what it holds is bounded by a
shard and a batch. No query goes through the driver but the PROBED ones. Of equal vectors only the k + 1 smallest ids are kept, as no others can be returned, so a vector
that many rows share is one of few rows.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id or with
another number of components than most (the smaller number in a tie). Of rows with one id, the smallest vector counts.
With fewer candidates than k all are returned; ties go to the smaller id, repeated vectors at the last place too. Very long
vectors are defined likewise: sample, shards and batches are bounded by numbers held, not by rows. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagelight.llm.common import Stored, cut, only
from stagelight.sources.files import listed, opened

#: Vectors that rotations are learned on and radii told from
SAMPLE = 20_000
#: Numbers that the sample, a shard of vectors, a batch of queries or vectors that are encoded at a time hold at most
SAMPLE_NUMBERS, SHARD_NUMBERS, BLOCK_NUMBERS, CODED_NUMBERS = 1 << 24, 1 << 24, 1 << 22, 1 << 20
#: Code bits for each component, and in all
BITS_EACH, BITS = 4, 512
WIDTH = 16
#: Codes that a query's first radius holds in the whole table, or this share of the sample
ENOUGH, ENOUGH_SAMPLED = 64, 4
#: Queries searched by brute force, and the share of their neighbours that must be within the radius
PROBED, LEAST_RECALL = 64, 0.95
STEPS = 11


class Codes:
    def __init__(self, sample: np.ndarray, most: float, every: int):
        """sample: rows of original vectors; most: the largest norm of all; every: the number of all rows."""
        self.most = most
        x = self.lift(sample)
        self.mean = x.mean(0)
        x = x - self.mean
        _, directions = np.linalg.eigh(x.T @ x)
        each = min(x.shape[1], sample.shape[1], BITS)
        v = x @ directions[:, ::-1][:, :each]
        rotations = []
        for start in range(max(1, min(BITS, BITS_EACH * each) // each)):
            r = np.linalg.qr(np.random.default_rng(5 + start).normal(size=(each, each)))[0]
            for _ in range(20):
                u, _, w = np.linalg.svd(v.T @ np.where(v @ r >= 0, 1.0, -1.0))
                r = u @ w
            rotations.append(directions[:, ::-1][:, :each] @ r)
        self.project = np.concatenate(rotations, 1)
        self.bits = self.project.shape[1]
        self.known = self.words(self.lift(sample))
        #: places in the sample's order of distances, one a step
        self.places = [max(ENOUGH_SAMPLED, -(-ENOUGH * 2**i * len(sample) // every)) for i in range(STEPS)]

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.most
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))], 1)

    def words(self, lifted: np.ndarray) -> np.ndarray:
        """(substrings x vectors) 16-bit words of the codes."""
        on = (lifted - self.mean) @ self.project >= 0
        pad = -self.bits % 64
        packed = np.packbits(np.pad(on, ((0, 0), (0, pad))), axis=1, bitorder="little")
        return np.ascontiguousarray(packed.view("<u2").T)

    def of(self, x: np.ndarray) -> np.ndarray:
        """Words of any number of vectors, a few at a time."""
        rows = max(1, CODED_NUMBERS // self.bits)
        return np.concatenate([self.words(self.lift(x[a : a + rows].astype(float))) for a in range(0, max(1, len(x)), rows)], 1)

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        return self.words(np.concatenate([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))], 1))

    def radii(self, code: np.ndarray) -> np.ndarray:
        """A query's radius for each step; the last one leaves nothing out."""
        held = np.cumsum(np.bincount(distances(wide(self.known), wide(code[:, None])[:, 0]), minlength=self.bits + 1))
        return np.minimum(np.append(np.searchsorted(held, self.places), self.bits), self.bits)


def wide(words: np.ndarray) -> np.ndarray:
    """16-bit words as 64-bit ones, which are compared faster."""
    return np.ascontiguousarray(np.ascontiguousarray(words.T).view(np.uint64).T)


def distances(codes: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Hamming distances of (64-bit words x codes) to one code."""
    out = np.zeros(codes.shape[1], np.uint16)
    for row, word in zip(codes, query, strict=True):
        out += np.bitwise_count(row ^ word)
    return out


def masks(most: int) -> np.ndarray:
    """All 16-bit numbers with up to `most` bits set."""
    return _BY_WEIGHT[: sum(comb(WIDTH, i) for i in range(most + 1))]


_BY_WEIGHT = np.argsort(np.bitwise_count(np.arange(1 << WIDTH)), kind="stable").astype(np.uint16)


class Index:
    """Substring tables over the codes of one shard."""

    def __init__(self, words: np.ndarray):
        self.words, self.wide = words, wide(words)
        self.order: dict[int, np.ndarray] = {}
        self.start: dict[int, np.ndarray] = {}

    def bucket(self, j: int, values: np.ndarray) -> np.ndarray:
        """Codes whose substring j has one of the values."""
        if j not in self.order:
            self.order[j] = np.argsort(self.words[j], kind="stable").astype(np.int32)
            self.start[j] = np.searchsorted(self.words[j][self.order[j]], np.arange((1 << WIDTH) + 1)).astype(np.int32)
        a = self.start[j][values]
        n = self.start[j][values.astype(np.int32) + 1] - a
        some = n > 0
        a, n = a[some], n[some]
        return self.order[j][np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())] if len(n) else self.order[j][:0]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Every code within the radius, in order."""
        m, n = self.words.shape
        a, b = divmod(int(radius), m)
        reach = [a if j <= b else a - 1 for j in range(m)]
        q = wide(query[:, None])[:, 0]
        buckets = [sum(comb(WIDTH, i) for i in range(r + 1)) for r in reach]
        if sum(buckets) * (1 + n / (1 << WIDTH)) >= n:
            return np.flatnonzero(distances(self.wide, q) <= radius)
        found = np.unique(np.concatenate([self.bucket(j, masks(r) ^ query[j]) for j, r in enumerate(reach) if r >= 0]))
        return found[distances(self.wide[:, found], q) <= radius]


def best(base: np.ndarray, ids: np.ndarray, at: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k nearest of the rows at `at`, the query's own left out."""
    score = (base[at].astype(float) * query).sum(1)
    other = ids[at] != own
    at, score = at[other], score[other]
    if len(at) > k:
        keep = score >= np.partition(score, len(score) - k)[len(score) - k]
        at, score = at[keep], score[keep]
    order = np.lexsort((ids[at], -score))[:k]
    return ids[at][order], score[order]


def _matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _shards(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of a task's rows (id, v), in shards of bounded size."""
    ids: list[np.ndarray] = []
    vectors: list[np.ndarray] = []
    for batch in batches:
        ids.append(batch.column(0).to_numpy())
        vectors.append(_matrix(batch.column(1), d))
        if sum(x.size for x in vectors) >= SHARD_NUMBERS:
            yield np.concatenate(ids), np.concatenate(vectors)
            ids, vectors = [], []
    if ids:
        yield np.concatenate(ids), np.concatenate(vectors)


RESULT = "query_id long, vec_id long, score double"


def _rows(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    ids = [np.zeros(0, np.int64), *[i for _, i, _ in found]]
    own = np.repeat(np.array([q for q, _, _ in found], np.int64), [len(i) for _, i, _ in found])
    return pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.concatenate(ids)), pa.array(np.concatenate([np.zeros(0), *[s for _, _, s in found]]))], names=["query_id", "vec_id", "score"])


def _exact(shared, d: int, k: int):
    """The k nearest of each shard for a few queries, by brute force."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, queries = shared.value
        for ids, base in _shards(batches, d):
            every = np.arange(len(ids))
            yield _rows([(own, *best(base, ids, every, q, own, k)) for own, q in zip(asked.tolist(), queries, strict=True)])

    return run


CODED = "id long, v array<double>, code binary, radius int"


def _coded(model, d: int, step: int):
    """Queries (id, v) with their codes and their radii at a step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = model.value
        for batch in batches:
            x = _matrix(batch.column(1), d).astype(float)
            if not len(x):
                continue
            words = codes.of_queries(x)
            radii = [int(codes.radii(words[:, i])[step]) for i in range(len(x))]
            v = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, d), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array([words[:, i].tobytes() for i in range(len(x))], pa.binary()), pa.array(radii, pa.int32())], names=["id", "v", "code", "radius"])

    return run


def _asked(path: str, d: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, codes and radii of the stored queries, a batch at a time."""
    files, folder = opened(path)
    for f in listed(files, folder):
        with pq.ParquetFile(f.path, filesystem=files) as queries:
            for batch in queries.iter_batches(max(1, BLOCK_NUMBERS // d)):
                code = np.stack([np.frombuffer(c, np.uint16) for c in batch.column(2).to_pylist()], 1)
                yield batch.column(0).to_numpy(), _matrix(batch.column(1), d), np.ascontiguousarray(code), batch.column(3).to_numpy()


def _near(model, path: str, d: int, k: int):
    """The k nearest of each shard for every stored query, among the codes within its radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, base in _shards(batches, d):
            index = Index(model.value.of(base))
            for asked, queries, codes, radii in _asked(path, d):
                found = []
                for i, own in enumerate(asked.tolist()):
                    found.append((own, *best(base, ids, index.within(codes[:, i], radii[i]), queries[i], own, k)))
                    if len(found) == 4096:
                        yield _rows(found)
                        found = []
                yield _rows(found)

    return run


def search(vectors: DataFrame, every: int = 20, k: int = 20, sample: int = SAMPLE) -> DataFrame:
    """Queries are the rows whose id is divisible by `every`, candidates all others' rows."""
    spark = vectors.sparkSession
    v = F.col("v")
    numbers = "array<float>" if dict(vectors.dtypes).get("embedding") == "array<float>" else "array<double>"
    rows = only(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast(numbers).alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size("v") > 0)).where(sound & F.exists("v", lambda x: x != 0))
    store = Stored(rows.groupBy("id").agg(F.min("v").alias("v")))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    sizes = store.df.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(square).alias("m"))
    most = sizes.orderBy(F.desc("n"), "d").head(1)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not most:
        store.drop()
        return empty
    d, n = most[0]["d"], most[0]["n"]
    rows = store.df.where(F.size("v") == d)
    copies = Window.partitionBy("v").orderBy("id")  # the group limit keeps k + 1 a task before the shuffle
    tasks = max(spark.sparkContext.defaultParallelism, -(-n * d // SHARD_NUMBERS))
    base = Stored(rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select("id", "v").repartition(tasks, "id"))
    # the sample is the first rows in hash order, at most SAMPLE_NUMBERS numbers
    fitted = rows.orderBy(F.xxhash64("id"), "id").limit(max(1, min(sample, SAMPLE_NUMBERS // d))).select("v").toArrow()
    codes = Codes(_matrix(fitted.column("v"), d).astype(float), float(np.sqrt(most[0]["m"])), n)
    model = spark.sparkContext.broadcast(codes)  # bounded by the sample
    queries = rows.where(F.col("id") % every == 0)

    probed = queries.orderBy(F.xxhash64("id"), "id").limit(PROBED).select("id", "v").orderBy("id").toArrow()
    ids = probed.column("id").to_numpy()
    if not len(ids):
        store.drop(), base.drop()
        return empty
    x = _matrix(probed.column("v"), d).astype(float)
    words = codes.of_queries(x)
    radii = np.array([codes.radii(words[:, i]) for i in range(len(ids))], np.int32)
    shared = spark.sparkContext.broadcast((ids, x))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    true = merged(base.df.mapInArrow(_exact(shared, d, k), RESULT)).join(base.df, F.col("vec_id") == F.col("id")).select("query_id", "v").toArrow()  # PROBED * k rows
    step = 0
    if true.num_rows:
        place = np.searchsorted(ids, true.column("query_id").to_numpy())
        other = wide(codes.of(_matrix(true.column("v"), d).astype(float)))
        apart = np.bitwise_count(wide(words)[:, place] ^ other).sum(0)
        step = next(i for i in range(STEPS + 1) if (apart <= radii[place, i]).mean() >= LEAST_RECALL)

    asked = Stored(queries.select("id", "v").mapInArrow(_coded(model, d, step), CODED))
    try:
        return cut(merged(base.df.mapInArrow(_near(model, asked.path, d, k), RESULT)).select("query_id", "rank", "vec_id", "score"))
    finally:
        store.drop(), base.drop(), asked.drop()

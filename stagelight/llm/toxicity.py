"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text are its words (runs of letters and digits, A-Z lower-cased) and word beginnings of several lengths, each
hashed to a slot. Slots are chosen by how far their share of toxic and other documents differs, and, among the FREQUENT
most frequent ones, by how far the share of documents with both of a pair differs, so that terms whose pair tells what
neither tells alone are known too. Then the machine learns a weight for each and, through a short vector for each, a weight
for every pair that occurs together, such as an insult and a group's name, which a sum of single weights misses.

It is fitted on at most SAMPLE labelled documents, the first in hash order of their id, so the fit takes the same time at
any corpus size; scores are given for every whole text. Only text goes into a score.

Nulls: a null or empty text gets the score of a text without known terms. Labels that are null or name no document are
left out; of several labels for an id, the largest counts. Of several texts for a labelled id, the one with the smallest
hash is learned from; repeated rows each get their score. If no label of either kind is left, every score is the share of
toxic labels (0 without labels). An empty table gives an empty result. Very long texts are cut up in bounded steps and
count whole. Extra columns, whatever their names, are passed on or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import Words, cut, fold, only, steps, text_steps, tidy, with_fields

SAMPLE = 20_000
#: Features that there is room for; more telling ones get more
FEATURES = 5_120
#: Terms whose pairs are looked at: their table of pairs is counted in 16 MB
FREQUENT = 2_048
#: Least difference, in standard errors, of a term's and of a pair's share; a pair must exceed its terms' by the last
TELLS, PAIR_TELLS, BEYOND = 3.5, 6.0, 2.0
SLOTS = 1 << 20
BEGINNINGS = (4, 5, 6, 7, 8, 9, 10, 12)
FOLDS, HELD_OUT = 5, 0


def term_slots(texts: list[str | None], table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, slot) pairs in order; with a table, slots are mapped by it and those below 0 left out."""
    words = Words(texts, BEGINNINGS, letters=True)
    doc = np.repeat(np.arange(len(words)), np.diff(words.bounds))
    keys = []
    for h in (words.hashes, *words.prefix):
        slot = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        slot = np.where(h == 0, -1, slot) if table is None else np.where(h == 0, -1, table[slot])
        keep = slot >= 0
        keys.append(doc[keep] * SLOTS + slot[keep])
    both = np.unique(np.concatenate(keys))
    return both // SLOTS, both % SLOTS


@dataclass
class Machine:
    table: np.ndarray  # slot -> feature or -1
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def margins(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        out = self.bias + np.bincount(doc, self.weight[feature], n)
        for f in range(self.factor.shape[1]):
            v = self.factor[feature, f]
            out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        doc, feature = term_slots(texts, self.table)
        return 1 / (1 + np.exp(-np.clip(self.margins(doc, feature, len(texts)), -30, 30)))


def train(rows: list[np.ndarray], labels: np.ndarray, features: int, rank: int = 4, epochs: int = 30, rate: float = 0.1, decay: float = 2e-4) -> tuple[float, np.ndarray, np.ndarray]:
    """Stochastic gradient steps with per-weight rates over mini-batches; rows hold each document's features."""
    rng = np.random.default_rng(7)
    share = float(np.clip(labels.mean(), 1e-6, 1 - 1e-6)) if len(labels) else 1e-6
    bias, w, v = float(np.log(share / (1 - share))), np.zeros(features), rng.normal(0, 0.02, (features, rank))
    if not len(labels) or labels.min() == labels.max():
        return bias, w, np.zeros((features, rank))
    gb, gw, gv = 1.0, np.ones(features), np.ones((features, rank))
    sizes = np.array([len(r) for r in rows])
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), 128):
            at = order[a : a + 128]
            doc, x = np.repeat(np.arange(len(at)), sizes[at]), np.concatenate([rows[i] for i in at])
            sums = np.stack([np.bincount(doc, v[x, f], len(at)) for f in range(rank)], 1)
            margin = bias + np.bincount(doc, w[x], len(at)) + 0.5 * ((sums**2).sum(1) - np.bincount(doc, (v[x] ** 2).sum(1), len(at)))
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[at]) / len(at) * 16
            db = slope.sum()
            gb += db * db
            bias -= rate * db / np.sqrt(gb)
            used, where = np.unique(x, return_inverse=True)
            dw = np.bincount(where, slope[doc], len(used)) + decay * w[used]
            gw[used] += dw * dw
            w[used] -= rate * dw / np.sqrt(gw[used])
            for f in range(rank):
                dv = np.bincount(where, slope[doc] * (sums[doc, f] - v[x, f]), len(used)) + decay * v[used, f]
                gv[used, f] += dv * dv
                v[used, f] -= rate * dv / np.sqrt(gv[used, f])
    return bias, w, v


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of either label have each slot."""
    for batch in batches:
        texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(np.int64)
        for a, b in steps(texts):
            doc, slot = term_slots(texts[a:b])
            keys, n = np.unique(slot * 2 + toxic[a:b][doc], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys // 2), pa.array(np.where(keys % 2 == 0, n, 0)), pa.array(np.where(keys % 2 == 1, n, 0))], names=["slot", "clean", "toxic"])


def differences(clean: np.ndarray, toxic: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """How far shares of toxic and other documents are apart, in standard errors."""
    p = (clean + toxic) / (n0 + n1)
    return (toxic / n1 - clean / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n0 + 1 / n1))


def telling_pairs(rows: list[np.ndarray], toxic: np.ndarray, features: int) -> np.ndarray:
    """Features of pairs whose joint difference exceeds that of either: rows hold documents' features below `features`."""
    both = [np.zeros((features, features), np.float32) for _ in range(2)]
    for label in (0, 1):
        some = [r for r, y in zip(rows, toxic, strict=True) if y == label]
        for a in range(0, len(some), 2048):
            x = np.zeros((len(some[a : a + 2048]), features), np.float32)
            for i, r in enumerate(some[a : a + 2048]):
                x[i, r] = 1
            both[label] += x.T @ x
    z = np.abs(differences(both[0].astype(float), both[1].astype(float), int((toxic == 0).sum()), int((toxic == 1).sum())))
    alone = np.diag(z)
    z[(z < PAIR_TELLS) | (z < np.maximum(alone[:, None], alone) + BEYOND)] = 0
    return np.unique(np.concatenate(np.nonzero(np.triu(z, 1))))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    spark = documents.sparkSession
    given = only(labels, "doc_id", "toxic").where("toxic is not null and doc_id is not null").where(fold("doc_id", FOLDS) != HELD_OUT)
    given = given.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    docs = only(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # at most `sample` rows of two numbers go out, and one row an id comes back
    met = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "toxic")).alias("m"))
    rows = cut(met.select("m.text", "m.toxic"))
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    table = np.full(SLOTS, -1, np.int32)
    frequent: list[int] = []
    telling: list[int] = []
    if n0 and n1:
        counts = cut(rows.mapInArrow(_count, "slot long, clean long, toxic long").groupBy("slot").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).where("c + t >= 4"))
        p = (F.col("c") + F.col("t")) / F.lit(n0 + n1)
        z = (F.col("t") / n1 - F.col("c") / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n0 + 1 / n1))
        telling = [r["slot"] for r in counts.withColumn("z", z).where(F.abs("z") >= TELLS).select("slot").collect()]  # no more than SLOTS
        frequent = [r["slot"] for r in counts.orderBy((F.col("c") + F.col("t")).desc(), "slot").limit(FREQUENT).collect()]
    # first the frequent slots, then the other telling ones
    slots = frequent + sorted(set(telling) - set(frequent))
    table[slots] = np.arange(len(slots))
    shared = spark.sparkContext.broadcast(table)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in steps(texts):
                doc, feature = term_slots(texts[a:b], shared.value)
                offsets = np.searchsorted(doc, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), pa.array(feature.astype(np.int32)))], names=["toxic", "x"])

    seen = rows.mapInArrow(known, "toxic int, x array<int>").toArrow()  # at most `sample` rows of chosen features
    lists = seen.column("x").combine_chunks()
    flat = lists.flatten().to_numpy().astype(np.int64) if len(seen) else np.zeros(0, np.int64)
    xs = np.split(flat, np.cumsum(lists.value_lengths().to_numpy())[:-1]) if len(seen) else []
    ys = seen.column("toxic").to_numpy().astype(float)
    # features that go into the machine: telling slots, and those of telling pairs
    keep = set(table[telling].tolist())
    if n0 and n1:
        keep |= set(telling_pairs([x[x < len(frequent)] for x in xs], ys, len(frequent)).tolist())
    place = np.full(max(1, len(slots)), -1, np.int32)
    place[sorted(keep)] = np.arange(len(keep))
    table[slots] = place[: len(slots)]
    xs = [y[y >= 0] for x in xs for y in [place[x].astype(np.int64)]]
    order = sorted(range(len(xs)), key=lambda i: (ys[i], len(xs[i]), xs[i].tolist()))  # whatever order tasks end in
    return Machine(table, *train([xs[i] for i in order], ys[order], max(FEATURES, len(keep))))


def score(documents: DataFrame, machine: Machine, columns: list[str], name: str = "_score") -> DataFrame:
    """documents' columns and their score under a name that none of them has."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(machine)  # 4 MB for any corpus
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.scores(texts) for _, _, texts in text_steps(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*scores, np.zeros(0)]))], names=[*columns, name])

    docs = only(documents, *columns)
    return docs.mapInArrow(tidy(run), with_fields(docs, **{name: "double"}))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    docs = only(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    scored = score(docs, fit(documents, labels), ["doc_id", "text"])
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))

"""N-gram join, components and nearest neighbours, against brute force."""

import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from stagelight.llm import mih, ngram_join
from stagelight.llm.common import Words
from stagelight.llm.components import components

from .conftest import prose


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width, t):
    sets = [shingles(x, width) for _, x in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def got(df, **how):
    return sorted((tuple(r) for r in ngram_join.jaccard_components(df, **how).collect()), key=repr)


def test_odd_documents(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert got(odd_documents, width=3, threshold="0.9") == brute(rows, 3, Fraction(9, 10))
    assert got(no_documents, width=3, threshold="0.9") == []


@pytest.fixture(scope="module")
def near_copies():
    """Groups of near copies, edits of every size, one long common passage and short texts that are mostly passage."""
    rng = random.Random(8)
    passage, rows = prose(rng, 60), []
    for _ in range(12):
        base = prose(rng, rng.randint(8, 150)).split()
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5, 12])):
                words[rng.randrange(len(words))] = prose(rng, 1)
            rows.append(" ".join(words))
    rows += [f"{passage} {prose(rng, rng.randint(1, 60))}" for _ in range(25)] + [f"{prose(rng, 1)} the same short line of words {prose(rng, 1)}" for _ in range(10)]
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [ngram_join.BLOCK, 400])
def test_near_copies(spark, near_copies, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    df = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(5)
    for width, t in ((3, "0.9"), (5, "0.8")):
        assert got(df, width=width, threshold=t) == brute(near_copies, width, Fraction(t))


def test_ids_never_merge_texts(spark):
    """Null and repeated ids over near copies, copies and unlike texts; blocks of one and of many tasks."""
    rng = random.Random(21)
    base = prose(rng, 90).split()
    rows = []
    for i in range(60):
        words = list(base) if i % 3 else prose(rng, 40).split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            words[rng.randrange(len(words))] = prose(rng, 1)
        rows.append((rng.choice([None, None, 5, 6, 100 + i]), " ".join(words)))
    rows += rows[:10] + [(None, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block in (ngram_join.BLOCK, 500):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(ngram_join, "BLOCK", block)
            assert got(df, width=3, threshold="0.9") == brute(rows, 3, Fraction(9, 10))


def test_large_group_of_near_copies(spark, monkeypatch):
    """4,000 copies with up to 12 edits in parts of a tenth of the group: as one block gives it."""
    rng = random.Random(22)
    base = [prose(rng, 1) + str(i) for i in range(100)]
    rows = []
    for i in range(4000):
        words = list(base)
        for j in rng.sample(range(100), rng.choice([0, 1, 1, 1, 2, 12])):
            words[j] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = got(df, width=3, threshold="0.9")
    assert len({c for _, _, c in whole}) > 300 and max(np.unique([c for _, _, c in whole], return_counts=True)[1]) > 2000
    monkeypatch.setattr(ngram_join, "BLOCK", 80_000)
    assert got(df, width=3, threshold="0.9") == whole


def test_merge_skip_counts():
    rng = np.random.default_rng(5)
    for _ in range(200):
        lists = [np.flatnonzero(rng.random(40) < rng.random()).tolist() for _ in range(rng.integers(1, 9))]
        lists = [x for x in lists if x]
        least = int(rng.integers(1, 6))
        times = np.bincount([i for x in lists for i in x], minlength=40) if lists else np.zeros(40, int)
        found, held = ngram_join.merge_skip(lists, least)
        assert found == np.flatnonzero(times >= least).tolist() and held == times[times >= least].tolist()


def test_block_search_is_brute_force():
    rng = np.random.default_rng(2)
    for round_ in range(60):
        pool = np.arange(1, 60 if round_ < 40 else 2000, dtype=np.uint64)
        sets = [np.sort(rng.choice(pool, rng.integers(1, 50), replace=False)) for _ in range(rng.integers(2, 40))]
        t = Fraction(7, 10)
        roots = ngram_join.Block(sets, t).run()
        parent = list(range(len(sets)))

        def root(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if n >= t * (len(sets[i]) + len(sets[j]) - n):
                    parent[max(root(i), root(j))] = min(root(i), root(j))
        assert roots == [root(i) for i in range(len(sets))]


def test_frequent_signatures(spark, near_copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "OFTEN", 3)
    df = spark.createDataFrame(near_copies, "doc_id long, text string")
    assert got(df, width=3, threshold="0.9") == brute(near_copies, 3, Fraction(9, 10))


def test_words_are_the_same_in_segments(monkeypatch):
    import stagelight.llm.common as c

    text = prose(random.Random(1), 5000) + " " + "y" * 3000 + " end"
    whole = Words([text, None, "A a"]).hashes
    monkeypatch.setattr(c, "SEGMENT", 1000)
    again = Words([text, None, "A a"])
    assert (again.hashes == whole).all() and again.hashes[-1] == again.hashes[-2] and list(np.diff(again.bounds)) == [5002, 0, 2]


@pytest.mark.parametrize("local", [1_000_000, 4])
def test_components(spark, monkeypatch, local):
    import stagelight.llm.components as c

    monkeypatch.setattr(c, "LOCAL", local)
    chain = [(i, i + 1) for i in range(30)] + [(50, 51), (51, 51), (None, 3), (60, 50), (50, 60)]
    df = spark.createDataFrame(chain, "u long, v long")
    want = {i: 0 for i in range(31)} | {50: 50, 51: 50, 60: 50}
    assert {r["node"]: r["root"] for r in components(df).collect()} == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 24))
    x = centers[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 24))
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(x)]
    odd = [(9000, None, 1, 2), (9020, [0.0] * 24, 1, 2), (9040, [float("nan")] * 24, 1, 2), (9060, [1.0], 1, 2), (None, [1.0] * 24, 1, 2), (20, x[20].tolist(), 1, 2), (9080, [None] * 24, 1, 2)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, id long, v long")
    got_ = {}
    for r in mih.search(df).orderBy("query_id", "rank").collect():
        got_.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got_) == list(range(0, 3000, 20))
    hit = 0
    for q, found in got_.items():
        s = x @ x[q]
        s[q] = -np.inf
        best = set(np.argsort(-s)[:20].tolist())
        hit += len(best & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(score - float(s[v])) < 1e-9 for _, v, score in found)
    assert hit / (20 * len(got_)) >= 0.9


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in mih.search(df).orderBy("rank").collect()] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0)]
    assert mih.search(df.where("vec_id < 0")).count() == 0


def test_radius_is_complete(monkeypatch):
    """Probed buckets and codes compared one after the other give every code within a radius, and nothing else."""
    rng = np.random.default_rng(0)
    centers = rng.integers(0, 1 << 16, (40, 8))
    near = centers[rng.integers(0, 40, 90_000)] ^ (1 << rng.integers(0, 16, (90_000, 8))) * (rng.random((90_000, 8)) < 0.4)
    words = np.ascontiguousarray(near.astype(np.uint16).T)
    index = mih.Index(words)
    probed = []
    bucket = mih.Index.bucket
    monkeypatch.setattr(mih.Index, "bucket", lambda self, j, v: probed.append(j) or bucket(self, j, v))
    for q in words.T[:10]:
        apart = np.bitwise_count(words.T ^ q).sum(1)
        for radius in (0, 1, 7, 8, 11, 15, 16, 20, 70, 128):
            before = len(probed)
            assert index.within(q, radius).tolist() == np.flatnonzero(apart <= radius).tolist()
            assert (len(probed) > before) == (radius <= 20)


def nearest_recall(spark, x):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    x = x.astype(np.float32).astype(float)
    found = {}
    for r in mih.search(df, every=500).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert sorted(found) == list(range(0, len(x), 500))
    hit = 0
    for q, ids in found.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(ids & set(np.argsort(-s)[:20].tolist()))
    return hit / 20 / len(found)


@pytest.mark.parametrize("kind", ["isotropic", "clustered", "norms"])
def test_recall_of_50000(spark, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50_000, 32))
    if kind == "clustered":
        x = rng.normal(size=(300, 32))[rng.integers(0, 300, 50_000)] + 0.3 * x
    if kind == "norms":
        x *= np.exp(0.5 * rng.normal(size=(50_000, 1)))
    assert nearest_recall(spark, x) >= 0.9


def test_blocks_and_shards_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 6)))], "vec_id long, embedding array<double>").repartition(3)
    whole = sorted(tuple(r) for r in mih.search(df).collect())
    monkeypatch.setattr(mih, "BLOCK_NUMBERS", 60)
    assert sorted(tuple(r) for r in mih.search(df).collect()) == whole
    ids = np.arange(4)
    batches = [pa.RecordBatch.from_arrays([pa.array(ids), pa.array([[1.0, 2.0]] * 4)], names=["id", "v"])] * 3
    monkeypatch.setattr(mih, "SHARD_NUMBERS", 16)
    assert [len(i) for i, _ in mih._shards(iter(batches), 2)] == [8, 4]


def test_repeated_vectors(spark):
    """A vector that many rows share: the smaller ids count, at the last place too, for queries with that vector and others."""
    rows = [(i, [1.0, 0.0] if i >= 5 else [0.5, float(i)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got_ = {}
    for r in mih.search(df).orderBy("query_id", "rank").collect():
        got_.setdefault(r["query_id"], []).append(r["vec_id"])
    x = np.array([v for _, v in rows])
    for q in range(0, 200, 20):
        s = x @ x[q]
        assert got_[q] == [i for _, i in sorted((-s[i], i) for i in range(200) if i != q)[:20]]

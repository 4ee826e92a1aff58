"""Segment near-dedup, source divergence and Delta Lloyd, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from stagelight.llm import delta_lloyd, divergence, segment_dedup

from .conftest import prose

LOWER = {i: i + 32 for i in range(65, 91)}


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def joined(points, radius=3):
    """For each point, the place of the first one that it is connected with."""
    x = np.array(points, np.uint64)
    root = list(range(len(x)))

    def of(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[:i] ^ x[i]) <= radius):
            a, b = of(i), of(int(j))
            root[max(a, b)] = min(a, b)
    return [of(i) for i in range(len(x))]


def components_of(rows):
    prints = [simhash(t) for _, t in rows]
    roots = joined(prints)
    least = {}
    for (d, _), r in zip(rows, roots, strict=True):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, _), p, r in zip(rows, prints, roots, strict=True)), key=repr)


def test_near_duplicates(spark, odd_documents, no_documents):
    got = lambda df, **how: sorted((tuple(r) for r in segment_dedup.near_duplicates(df, **how).collect()), key=repr)
    assert got(odd_documents) == components_of([(r["doc_id"], r["text"]) for r in odd_documents.collect()])
    assert got(no_documents) == []
    rng = random.Random(31)
    rows = []
    for i in range(120):
        words = prose(rng, rng.choice([0, 1, 2, 3, 40, 400])).split()
        for _ in range(rng.choice([1, 1, 4])):
            if words and rng.random() < 0.6:
                words[rng.randrange(len(words))] = prose(rng, 1).upper()
            rows.append((len(rows) * 3 - 40, " ".join(words)))
    want = components_of(rows)
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some near ones are linked
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == want == got(df, tile=4)


def test_fingerprints_by_pieces(monkeypatch):
    text = prose(random.Random(32), 3000) + "\v\t" + "É" * 500 + " Z"
    whole = segment_dedup.fingerprint(text.encode())
    assert whole & (1 << 64) - 1 == simhash(text)
    for piece in (1, 7, 1000):
        monkeypatch.setattr(segment_dedup, "PIECE", piece)
        assert segment_dedup.fingerprint(text.encode()) == whole
        assert segment_dedup.fingerprint(b" a  b ") & (1 << 64) - 1 == simhash("a b")


@pytest.mark.parametrize("tile", [segment_dedup.TILE, 16])
@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_links(spark, radius, tile):
    """Points around a few centres, in dense groups and chains, with and without cut cells: connected as by brute force,
    by true links, and no more of them in a large cell than it has members."""
    rng = np.random.default_rng(33 + radius)
    points = {int(p) for p in rng.integers(0, 2**64, 300, dtype=np.uint64)} | {0, 2**64 - 1}
    for _ in range(3):
        centre = int(rng.integers(0, 2**64, dtype=np.uint64))
        bits = [int(b) for b in rng.permutation(64)[:9]]
        points |= {centre ^ sum(1 << b for b in bits if rng.random() < 0.5) for _ in range(200)}
        for b in range(0, 64, 2):  # a chain, two bits a step
            points.add(centre := centre ^ 3 << b)
    points = sorted(points)
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(4)
    found = [(r["u"], r["v"]) for r in segment_dedup.links(df, radius, tile).collect()]
    assert all(((u ^ v) & (1 << 64) - 1).bit_count() <= radius for u, v in found)
    place = {p: i for i, p in enumerate(signed)}
    root = list(range(len(points)))
    for _ in range(len(points)):
        before = list(root)
        for u, v in found:
            a, b = place[u], place[v]
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert root == joined(points, radius)
    if tile == 16 and radius:
        assert segment_dedup.members(df, radius, tile).select("tile").distinct().count() > 1


def test_a_hot_cell_gives_a_forest():
    rng = np.random.default_rng(34)
    points = np.unique(rng.integers(0, 2**12, 3000)).astype(np.uint64) + np.uint64(2**63)
    u, v = segment_dedup.forest(points, 3)
    assert len(u) == len(points) - 1 and set(u.tolist()) | set(v.tolist()) == set(points.tolist())


def audited(rows, least, top=50):
    """rows (text, lang, source); everything dense."""
    rows = [tuple(x or "" for x in r) for r in rows]
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER))
    out = []
    for lang in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == lang]
        docs = Counter(w for t, _, _ in mine for w in set(words(t)))
        keep = {w for w, n in docs.items() if n >= least}
        count = {s: Counter(w for t, _, z in mine if z == s for w in words(t) if w in keep) for s in {r[2] for r in mine}}
        total = sum(count.values(), Counter())
        v = len(keep)
        p = lambda c: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * v) for w in keep}
        ps, q = {s: p(c) for s, c in count.items()}, p(total)
        for s in count:
            pairs = [(-sum(abs(ps[s][w] - ps[o][w]) for w in keep), o.encode()) for o in count if o != s]
            terms = [(q[w] - ps[s][w], w.encode()) for w in keep if count[s][w] and ps[s][w] > q[w]]
            out += [(lang, s, "pair", i.decode(), -x, n + 1) for n, (x, i) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", i.decode(), -x, n + 1) for n, (x, i) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def test_divergence(spark, odd_documents, no_documents, monkeypatch):
    got = lambda df, **how: sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.audit(df, **how).collect())
    given = lambda df: [(r["text"], r["lang"], r["source"]) for r in df.collect()]
    assert got(odd_documents, least=1) == audited(given(odd_documents), 1)
    assert got(no_documents) == []
    rng = random.Random(35)
    rows = [(None, "xx", "empty"), ("", "xx", None), ("only here", None, "a"), (None, None, None), ("Ärger 漢字 ÄRGER naïve a1b2 A", "xx", "a")]
    for i in range(300):  # a third in one source, words of one source, words in all
        source = rng.choice(["hot"] * 10 + [f"s{j}" for j in range(20)])
        rows.append((f"{prose(rng, rng.randint(0, 30))} The {source * rng.randint(0, 2)} {rng.choice(['ÉÉ', 'éé', '漢'])}", rng.choice(["xx", "yy"]), source))
    rows += rows[:20]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", divergence.F.lit(1)).repartition(6)
    want = audited(rows, 5, 8)
    assert got(df, least=5, top=8) == want and any(part == "term" and n == 8 for _, _, part, _, _, n in want)
    assert {x[4] for x in got(df, least=1000)} == {0}  # no kept terms
    monkeypatch.setattr(divergence, "HELD", 40)
    assert got(df, least=5, top=8) == want


def clustered(rows, k, rounds, size, scale=64):
    """rows (vec_id, vector), plainly, in Python's own numbers."""
    kept = [(i, [min(max(math.floor(scale * x), -(2**27)), 2**27) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    centres = [v for _, v in sorted((sha(f"1:{'' if i is None else i}"), v) for i, v in kept)[:k]]
    for n in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres)) for _, v in kept]
        if n < rounds:
            for j in range(len(centres)):
                mine = [v for (_, v), (_, o) in zip(kept, near, strict=True) if o == j]
                centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)] if mine else centres[j]
    inertia = Counter()
    for d, j in near:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha(",".join(map(str, centres[j])))) for (i, _), (d, j) in zip(kept, near, strict=True)), key=repr)


def test_delta_lloyd(spark):
    got = lambda df, **how: sorted((tuple(r) for r in delta_lloyd.cluster(df, **how).collect()), key=repr)
    rng = np.random.default_rng(36)
    x = np.concatenate([rng.normal(size=(6, 5))[rng.integers(0, 6, 300)] + 0.2 * rng.normal(size=(300, 5)), np.tile(rng.normal(size=5), (150, 1))])  # a third are copies
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [1.0]), (902, [None] * 5), (903, [float("nan")] * 5), (904, [float("inf")] * 5), (None, [0.5] * 5), (None, [0.25] * 5), (3, x[7].tolist()), (905, [-0.0] * 5), (906, []), (907, [0.0] * 90_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + odd], "vec_id long, embedding array<double>, v long, far long").repartition(5)
    for k, rounds in ((16, 3), (4, 12), (3, 1), (1000, 2)):
        assert got(df, k=k, rounds=rounds, size=5) == clustered(rows + odd, k, rounds, 5)
    assert got(df.where("vec_id < 0")) == [] and got(df) == []  # none of 64 components
    huge = [(1, [1e300, -1e300]), (2, [1e6, 2.0]), (3, [-1e6, 0.1])] + [(i, [float(i), 1.0]) for i in range(4, 30)]
    df = spark.createDataFrame(huge, "vec_id long, embedding array<double>")
    assert got(df, k=5, size=2) == clustered(huge, 5, 3, 2)


def test_later_rounds_look_at_what_moved(monkeypatch):
    """Vectors whose owner stayed are compared with moved centroids alone, with the same result as with all."""
    rng = np.random.default_rng(37)
    x, centroids = rng.integers(-50, 50, (400, 4)), rng.integers(-50, 50, (9, 4))
    owner, far = delta_lloyd.reassigned(x, np.full(400, -1), np.zeros(400, np.int64), centroids, np.arange(9))
    moved = np.array([2, 5])
    centroids[moved] += rng.integers(-9, 9, (2, 4))
    asked = []
    plain = delta_lloyd.distances
    monkeypatch.setattr(delta_lloyd, "distances", lambda a, c: asked.append(len(a) * len(c)) or plain(a, c))
    again = delta_lloyd.reassigned(x, owner, far, centroids, moved)
    all_ = plain(x, centroids)
    assert (again[0] == all_.argmin(1)).all() and (again[1] == all_.min(1)).all()
    held = int(np.isin(owner, moved).sum())
    assert sum(asked) == held * 9 + (400 - held) * 2


def test_steps_of_texts():
    import pyarrow as pa

    from stagelight.llm.common import text_steps, tidy

    texts = ["a" * 5, None, "", "é" * 4, "b" * 50, "c", "d" * 9]
    for most in (1, 7, 12, 1000):
        parts = list(text_steps(pa.array(texts), most))
        assert [x for _, _, p in parts for x in p] == texts and [a for a, _, _ in parts] == [0, *[b for _, b, _ in parts]][:-1]
        assert all(len(p) == 1 or sum(len((x or "").encode()) + 1 for x in p) <= most for _, _, p in parts)
    assert list(text_steps(pa.array([], pa.string()))) == []
    assert list(tidy(lambda batches: (x * 2 for x in batches))(iter([1, 2]))) == [2, 4]


def test_postings_are_not_broadcast(spark, tmp_path):
    """Files of many postings are small, and the size of sizes unknown: still postings are not sent to all tasks."""
    spark.range(20_000).selectExpr("'en' lang", "'s' source", "concat('t', id) term", "5L count", "9L total").write.parquet(str(tmp_path / "counts"))
    groups = spark.range(100_000_000).selectExpr("'en' lang", "'s' source", "id").where("id = 0")
    sizes = divergence.cut(groups.selectExpr("lang", "source", "9L n", "2L v", "18L n_lang", "7L p0"))
    found = divergence.valued(spark.read.parquet(str(tmp_path / "counts")), sizes)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert found.count() == 20_000

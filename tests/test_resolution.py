"""Names within a batch, a store of entities that grows, and what is found or created, against plain loops."""

import random

import pytest

from stagelight.functions import geo
from stagelight.operators import conflation, resolution


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def similarity(a, b):
    return 1.0 if a == b else 0.0 if not a or not b else 1 - levenshtein(a, b) / max(len(a), len(b))


def greedy(names, known, threshold):
    """(id, name) in order of id -> id: (known id, creator id, similarity), one name after the other."""
    made, out = [], {}
    for i, name in sorted(names, key=lambda r: r[0]):
        if name is None:
            out[i] = (None, None, None)
            continue
        exact = [k for k, n in sorted(known) if n == name] or [("made", m) for m, n in made if n == name]
        near = [(k, similarity(name, n)) for k, n in sorted(known)] if not exact else []
        near = [x for x in near if x[1] >= threshold] or [(("made", m), similarity(name, n)) for m, n in made if not exact and similarity(name, n) >= threshold]
        if exact or near:
            to, s = (exact[0], 1.0) if exact else near[0]
        else:
            made.append((i, name))
            to, s = ("made", i), 1.0
        out[i] = (None, to[1], round(s, 9)) if isinstance(to, tuple) else (to, None, round(s, 9))
    return out


def some_names(rng, n):
    words = ["".join(rng.choices("abcd", k=rng.randint(3, 9))) for _ in range(n // 4)]
    out = []
    for _ in range(n):
        w = list(rng.choice(words))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice("abcde")
        out.append("".join(w))
    return out


@pytest.mark.parametrize("local", [resolution.LOCAL, 0])
@pytest.mark.parametrize("threshold", [0.8, 0.65, 0.5])
def test_names_in_a_batch(spark, monkeypatch, local, threshold):
    monkeypatch.setattr(resolution, "LOCAL", local)
    rng = random.Random(int(threshold * 100))
    names = [(i * 7 - 50, w) for i, w in enumerate(some_names(rng, 160))] + [(5000, None), (5001, ""), (5002, "")]
    known = list(enumerate(some_names(rng, 12)))
    df = spark.createDataFrame(names, "id long, name string").repartition(3)
    got = resolution.resolve_names(df, spark.createDataFrame(known, "id long, name string"), threshold)
    want = greedy(names, known, threshold)
    assert {r["id"]: (r["known_id"], r["creator_id"], r["similarity"] and round(r["similarity"], 9)) for r in got.collect()} == want
    made = [i for i, (_, c, _) in want.items() if c == i]
    assert len(made) > 3 and sorted(r["id"] for r in resolution.new_entities(got, "venue").collect()) == sorted(made)
    assert resolution.resolve_names(df.limit(0), spark.createDataFrame(known, "id long, name string"), threshold).count() == 0


def test_long_chains(spark, monkeypatch):
    """Every name is similar to the one before it alone: one in two creates, after as many rounds."""
    chain = [(i, "b" * i + "a" * (12 - i)) for i in range(13)]
    df = spark.createDataFrame(chain, "id long, name string")
    none = spark.createDataFrame([], "id long, name string")
    for local in (resolution.LOCAL, 0):
        monkeypatch.setattr(resolution, "LOCAL", local)
        got = {r["id"]: r["creator_id"] for r in resolution.resolve_names(df, none, 0.9).collect()}
        assert got == {i: c for i, (_, c, _) in greedy(chain, [], 0.9).items()} and len(set(got.values())) == 7


def test_one_name_in_very_many_rows(spark):
    df = spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 'The Hall', concat('Hall ', id % 50, ' of ', id % 50)) as name")
    got = resolution.resolve_venues(df, spark.createDataFrame([], "id long, name string"), 0.8)
    assert got.where("name = 'hall' and creator_id = 0 and similarity = 1").count() == 20_000


def test_artist_lists(spark):
    rng = random.Random(9)
    rows = [(i, [None if rng.random() < 0.05 else f"The {w} Band" if rng.random() < 0.2 else w for w in some_names(rng, rng.choice([4, 8]))[: rng.randint(0, 5)]]) for i in range(40)] + [(40, None), (41, [])]
    known = list(enumerate(some_names(rng, 8)))
    plain = lambda w: w if w is None else w.lower().replace("the ", "").replace(" band", "").strip()
    places = [(i, p) for i, names in rows for p in range(len(names or []))]
    want = greedy([(at, plain(dict(rows)[at[0]][at[1]])) for at in places], known, 0.75)
    got = resolution.resolve_artists(spark.createDataFrame(rows, "id long, names array<string>").repartition(3), spark.createDataFrame(known, "id long, name string"), 0.75)
    got = {r["id"]: r["artists"] for r in got.collect()}
    assert sorted(got) == list(range(42)) and got[40] == [] == got[41]
    for (i, p), (k, c, s) in want.items():
        a = got[i][p]
        assert (a["known_id"], None if a["creator_id"] is None else (a["creator_id"], a["creator_pos"]), a["similarity"] and round(a["similarity"], 9)) == (k, c, s)


def test_found_or_created(spark):
    existing = [(10, "The Hall"), (11, "the hall"), (12, "Blue-Bar!"), (13, None), (14, "!!")]
    wanted = [(1, "THE HALL"), (2, "blue bar"), (3, "New Place"), (4, "new  place!"), (5, None), (6, "!!"), (7, "??"), (8, "new place"), (9, "??")]
    got = conflation.found_or_created(*[spark.createDataFrame(x, "id long, name string") for x in (wanted, existing)])
    assert {r["id"]: (r["entity_id"], r["how"]) for r in got.collect()} == {
        1: (10, "name"), 2: (12, "slug"), 3: (3, "created"), 4: (3, "created"), 5: (None, None), 6: (14, "name"), 7: (7, "created"), 8: (3, "created"), 9: (7, "created"),
    }


def test_no_place_is_no_cell(spark):
    rows = [(47.6, -122.3), (None, -122.3), (47.6, None), (None, None), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "lat double, lng double")
    assert [r[0] for r in df.select(geo.location_cell(df.lat, df.lng)).collect()] == ["47600_-122300", None, None, None, None]
    venues = [(i, "venue", f"Hall number {i % 3}", None, None, None, None, None) for i in range(30)]
    schema = "id long, entity_type string, name string, latitude double, longitude double, address string, event_day date, venue_id long"
    df = spark.createDataFrame(venues, schema)
    found = conflation.candidates(df, df.select("*")).collect()
    assert len(found) == 300 and all(r["r_key"] == r["c_key"] for r in found)


RECORD = "id long, entity_type string, name string, latitude double, longitude double, address string, event_day date, venue_id long"


def plainly(batches, keep):
    """Batches of records, resolved one by one against what earlier batches created."""
    clean = lambda n: n if n is None else n.lower().strip().replace("&", "and").replace("-", " ").replace("_", " ").replace("  ", " ")
    words = lambda a, b: 1.0 if a == b else len(set(a.split()) & set(b.split())) / max(1, len(set(a.split()) | set(b.split())))
    cell = lambda r: None if r[3] is None or r[4] is None else (round(r[3] * 1000), round(r[4] * 1000))
    out, known = {}, []
    for batch in batches:
        new = []
        for r in batch:
            found = []
            for k in known:
                if r[1] != k[1] or None in (r[2], k[2]) and not (cell(r) and cell(r) == cell(k)):
                    continue
                a, b = clean(r[2]), clean(k[2])
                by_name = a is not None and a == b
                if not by_name and not (r[1] == "venue" and cell(r) and cell(r) == cell(k)):
                    continue
                name = None if None in (a, b) else words(a, b)
                if r[1] == "venue":
                    km = None if None in (*r[3:5], *k[3:5]) else (((r[3] - k[3]) * 111) ** 2 + ((r[4] - k[4]) * 85) ** 2) ** 0.5
                    street = 0.0 if None in (r[5], k[5]) else words(clean(r[5]), clean(k[5]))
                    s = None if name is None else name * 0.4 + (1 - km / 0.1 if km is not None and km <= 0.1 else 0.0) * 0.4 + street * 0.2
                elif r[1] == "event":
                    s = name * 0.5 + 0.3 * (r[6] is not None and r[6] == k[6]) + 0.2 * (r[7] is not None and r[7] == k[7])
                else:
                    s = name
                if s is not None and s > (0.3 if by_name else 0.5):
                    found.append((-round(s, 6), str(k[0])))
            found.sort()
            to = found[0] if found and -found[0][0] >= 0.8 else None
            if to is None:
                new.append(r)
            others = [f for f in found if f is not to][:keep]
            out[r[0]] = ("MatchedExisting" if to else "NewEntity", to[1] if to else str(r[0]), len(found), sum(-s > 0.9 for s, _ in found), [(i, -s) for s, i in others])
        known += new
    return out


def some_records(rng, first, n):
    from datetime import date

    out = []
    for i in range(first, first + n):
        kind = rng.choice(["event", "event", "venue", "artist"])
        name = rng.choice(["Open Mic"] * 4 + [f"Big-Night {rng.randrange(6)}", f"big_night {rng.randrange(6)}", None])
        place = (47.6 + rng.randrange(3) * 0.0005, -122.3) if rng.random() < 0.7 else (None, -122.3)
        more = (place[0], place[1], rng.choice([None, "1 Main St", "2 main st"]), None, None) if kind == "venue" else (None, None, None, None if rng.random() < 0.1 else date(2024, 1, rng.randint(1, 6)), rng.choice([None, 1, 2, 3])) if kind == "event" else (None,) * 5
        out.append((i, kind, name, *more))
    return out


@pytest.mark.parametrize("keep", [3, 50])
def test_a_store_that_grows(spark, tmp_path, keep):
    from stagelight.operators.entity_store import EntityStore

    rng = random.Random(11)
    batches = [some_records(rng, 1000 * b, n) for b, n in enumerate((25, 80, 80))]
    want = plainly(batches, keep)
    store = EntityStore(spark, str(tmp_path / "store"), buckets=8, keep=keep)
    got = {}
    for b, rows in enumerate(batches):
        df = spark.createDataFrame(rows, RECORD).repartition(3)
        once = store.resolve(df, b).collect()
        assert sorted(map(repr, store.resolve(df, b).collect())) == sorted(map(repr, once))  # run again, as after a fault
        got |= {int(r["id"]): (r["resolution"], r["canonical_id"], r["n_matches"], r["n_duplicates"], [(a["entity_id"], round(a["similarity_score"], 6)) for a in r["alternatives"] or []]) for r in once}
    assert got == want
    assert any(v[0] == "MatchedExisting" for k, v in want.items() if k >= 1000) and max(len(v[4]) for v in want.values()) > 2
    assert store.resolve(spark.createDataFrame([], RECORD), 9).count() == 0


def test_a_name_that_a_third_has(spark, tmp_path):
    """20,000 events of one name on many days against 20,000 known ones: lists stay short, counts exact."""
    from stagelight.operators.entity_store import EntityStore

    store = EntityStore(spark, str(tmp_path / "store"), keep=5)
    row = lambda first: spark.range(first, first + 60_000).selectExpr("id", "'event' as entity_type", "if(id % 3 = 0, 'Open Mic', concat('Show ', id)) as name", "cast(null as double) latitude", "cast(null as double) longitude", "cast(null as string) address", "date_add(date'2020-01-01', cast(id % 2000 as int)) as event_day", "id % 7 as venue_id")
    assert store.resolve(row(0), 0).where("resolution = 'NewEntity'").count() == 60_000
    second = store.resolve(row(60_000), 1)
    shared = second.where("n_matches > 0")
    assert shared.count() == shared.where("n_matches = 20000 and size(alternatives) = 5").count() == 20_000

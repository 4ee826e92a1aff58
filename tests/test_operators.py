import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stagelight import catalogue, lineage, upkeep
from stagelight.functions import text as T
from stagelight.operators import catalog, conflation, enrichment, ingest, listings, metrics, normalize, pages, payloads, quality
from stagelight.plans.full import entities, resolved
from stagelight.plans.steps import Plan, Step, parse_only
from tests.conftest import DATA

AS_OF = date(2025, 8, 1)
NIL = "00000000-0000-0000-0000-000000000000"


def assess(spark, title, confidence, day="2025-08-20"):
    df = spark.createDataFrame([(title, day, NIL, confidence)], "title string, day string, venue_id string, confidence double").withColumn("event_day", F.to_date("day"))
    return quality.assess(df, quality.event_issues(F.col("title"), F.col("event_day"), F.col("venue_id"), F.lit(AS_OF.isoformat()).cast("date"))).head()


@pytest.mark.parametrize(
    ("title", "confidence", "day", "score", "decision"),
    [("Test Concert", 0.8, "2025-08-20", 0.79, "Accept"), ("Test Concert", 0.5, "2025-08-20", 0.44, "Quarantine"), ("", 0.8, "2025-08-20", 0.64, "AcceptWithWarnings"), ("", 0.8, "2024-08-20", 0.59, "Quarantine"), (None, 0.8, "2025-08-20", 0.64, "AcceptWithWarnings")],
)
def test_quality(spark, title, confidence, day, score, decision):
    r = assess(spark, title, confidence, day)
    assert (round(r["quality_score"], 6), r["decision"]) == (score, decision)


def test_quality_statistics_of_nothing(spark):
    empty = spark.createDataFrame([], "decision string, quality_score double, issues " + quality.ISSUE)
    r = quality.statistics(empty).head()
    assert (r["n_total"], r["acceptance_rate"], r["n_critical"]) == (0, 0.0, 0)


def test_enrich_without_coordinates(spark):
    r = enrichment.enrich(spark.createDataFrame([(1.0,)], "quality_score double"), "event").head()
    assert (r["density"], r["enrichment_confidence"], r["region"], r["landmarks"], len(r["enrichment_warnings"])) == ("Unknown", 0.6, enrichment.REGION, [], 1)


ENTITY = "id string, entity_type string, name string, latitude double, longitude double, address string, event_day date, venue_id string"


def test_resolution(spark):
    known = spark.createDataFrame([("v1", "venue", "Blue Moon", 47.66, -122.31, "712 NE 45th St", None, None), ("e1", "event", "Show", None, None, None, date(2025, 1, 1), "v1")], ENTITY)
    new = spark.createDataFrame([("r1", "venue", "Blue-Moon", 47.66, -122.31, "712 NE 45th St", None, None), ("r2", "event", "show", None, None, None, date(2025, 1, 2), "v1"), ("r3", "artist", "Nobody", None, None, None, None, None)], ENTITY)
    got = {r["id"]: (r["resolution"], r["canonical_id"], round(r["confidence"], 6)) for r in conflation.resolve(new, known).collect()}
    assert got == {"r1": ("MatchedExisting", "v1", 1.0), "r2": ("NewEntity", "r2", 0.6), "r3": ("NewEntity", "r3", 1.0)}


def test_change_detection_and_upsert(spark):
    schema = "id string, name string, city string, created_at string"
    old = spark.createDataFrame([("a", "A", None, "t0"), ("b", "B", "x", "t0")], schema)
    new = spark.createDataFrame([("a", "A", None, "t1"), ("b", "B2", "x", "t1"), ("c", "C", None, "t1")], schema)
    kinds = {r["id"]: r["change_type"] for r in catalog.prepare(old, new, "id", ("name", "city")).collect()}
    assert kinds == {"a": "NO_CHANGE", "b": "UPDATE", "c": "CREATE"}
    merged = {r["id"]: (r["name"], r["created_at"]) for r in catalog.upsert(old, new, ["id"]).collect()}
    assert merged == {"a": ("A", "t0"), "b": ("B2", "t0"), "c": ("C", "t1")}
    again = catalog.upsert(catalog.upsert(old, new, ["id"]), new, ["id"])
    assert sorted(again.collect()) == sorted(catalog.upsert(old, new, ["id"]).collect())


def test_edges_and_cascade(spark):
    events = spark.createDataFrame([("e1", "v1", ["a1", NIL]), ("e2", NIL, ["a2"]), ("e3", "v2", ["a1"])], "id string, venue_id string, artist_ids array<string>")
    edges = sorted(tuple(r) for r in catalog.event_edges(events).collect())
    assert edges == [("a1", "e1", "performs_at"), ("a1", "e3", "performs_at"), ("a2", "e2", "performs_at"), ("v1", "e1", "hosts"), ("v2", "e3", "hosts")]
    hosts = spark.createDataFrame([("v1", "e1"), ("v2", "e3"), ("v1", "e4")], "venue_id string, event_id string")
    acts = spark.createDataFrame([("a1", "e1"), ("a1", "e3"), ("a3", "e4")], "artist_id string, event_id string")
    assert [r[0] for r in catalog.exclusive_artists(hosts, acts, spark.createDataFrame([("v1",)], "id string")).collect()] == ["a3"]


def test_dedupe_log(spark):
    log = spark.createDataFrame([("1", "k", 1, "r1"), ("2", "k", 2, "r2"), ("3", "j", 3, "r3")], "envelope_id string, idempotency_key string, accepted_at int, payload_ref string")
    got = {r["envelope_id"]: (r["dedupe_of"], r["payload_ref"]) for r in ingest.tag_duplicates(log).collect()}
    assert got == {"1": (None, "r1"), "2": ("1", None), "3": (None, "r3")}


def test_read_next_and_acknowledge(spark):
    log = spark.createDataFrame([(0, "a", "e0"), (1, " ", "e1"), (2, "c", "e2")], "pos int, line string, envelope_id string")
    assert [r["pos"] for r in ingest.read_next(log, 1).collect()] == [2]
    assert [r["pos"] for r in ingest.read_next(log, 99).collect()] == [0, 2]
    offsets = spark.createDataFrame([("x", 0)], "consumer string, pos int")
    assert ingest.acknowledge(log, offsets, "x", "e2").head()["pos"] == 3
    assert ingest.acknowledge(log, offsets, "x", "none").head()["pos"] == 0


def test_pages(spark):
    ticketed = '<div class="eventItem"><h3 class="title"><a href="/events/detail/77">Main with Two</a></h3><h4 class="tagline">Sup &amp; Other</h4><div class="promotion-text tour">Big Tour</div><div class="promotion-text">P</div><span class="m-date__month">Feb</span><span class="m-date__day">3</span><div class="meta"><span class="time">Doors: 7:00 PM</span><span class="age">21+</span></div><a class="tickets onsalenow" href="https://t.example/1">x</a><div class="thumb"><img src="i.png"></div></div>'
    page = pages.tree(ticketed)
    (path, r), = pages.PLANS["neumos_html_v1"](page, date(2025, 11, 1))
    assert path == "div.eventItem" and (r["id"], r["tour_name"], r["promoter"], r["event_day"], r["event_time"], r["tickets_on_sale"], r["supporting_acts"]) == ("77", "Big Tour", "P", "2026-02-03", "7:00 PM", True, "Sup & Other")
    (_, r), = pages.PLANS["barboza_html_v1"](page, date(2025, 11, 1))
    assert (r["event_day"], r["venue"], r["promoter"]) == ("2025-02-03", "The Barboza", "Big Tour")
    headed = '<div class="entry-content"><h1>MUSIC 7.12</h1><p><a>Band One</a>\nBand Two\nDOORS 8</p><h1>bad</h1><p>lost</p></div>'
    assert [r["title"] for _, r in pages.PLANS["darrells_html_v1"](pages.tree(headed), AS_OF)] == ["Band One", "Band Two"]
    dated = '<h2>August 3, 2025</h2><article class="EventItem"><div class="EventItem-body"><h3><a>Live</a></h3></div></article><article class="EventItem"></article>'
    (_, r), = pages.PLANS["kexp_html_v1"](pages.tree(dated), AS_OF)
    assert (r["title"], r["event_day"], r["location"]) == ("Live", "August 3, 2025", "KEXP Studio")
    warm = '<script id="wix-warmup-data">' + json.dumps({"appsWarmupData": {"a": {"widget1": {"events": {"events": [{"title": "W"}]}}}}}) + "</script>"
    assert [r for _, r in pages.PLANS["wix_warmup_v1"](pages.tree(warm), AS_OF)] == [{"title": "W"}]
    df = spark.createDataFrame([("kexp", "e", "r", "<p>nothing</p>"), ("kexp", "f", "r", None)], "source_id string, envelope_id string, payload_ref string, html string")
    assert [json.loads(r["record"]) for r in pages.parse_pages(df, "kexp_html_v1", AS_OF).collect()] == [{"html_len": 14}, {"html_len": 0}]
    assert pages.find_events({"x": {"eventList": [{"title": "t"}, 3]}}) == [{"title": "t"}]


RAW = "source_id string, envelope_id string, payload_ref string, payload string"


def test_json_payloads_and_normalization(spark):
    calendar = json.dumps({"events": [{"title": "The Band", "scheduling": {"startDateFormatted": "January 15, 2025", "startTimeFormatted": "7:30 PM"}, "location": {"name": "Sea Monster Lounge"}, "slug": "s"}, {"title": "The Band", "date": "2025-02-01"}]})
    graph = json.dumps({"data": {"paginatedEvents": {"collection": [{"name": "N", "date": "2025-03-01", "doorTime": "19:00:00", "minimumAge": 21, "support": "", "artists": [{"name": "A"}], "announceArtists": [{"name": "B", "spotify": "u"}]}]}}})
    raw = spark.createDataFrame([("sea_monster", "e1", "r", calendar), ("conor_byrne", "e2", "r", graph), ("conor_byrne", "e3", "r", "{}")], RAW)
    plans = spark.createDataFrame([("sea_monster", "parse_plan:wix_calendar_v1"), ("conor_byrne", "venuepilot_graphql_v1")], "source_id string, parse_plan_ref string")
    parsed = payloads.parse(raw, plans, AS_OF)
    rows = {(r["envelope_id"], r["record_path"]): json.loads(r["record"]) for r in parsed.collect()}
    assert rows["e2", "$.data.paginatedEvents.collection[0]"]["artists"] == [{"name": "A"}, {"name": "B", "social_links": {"spotify": "u"}}]
    assert rows["e2", "$.data.paginatedEvents.collection[0]"]["start_time"] == "19:00:00" and "supporting_acts" not in rows["e2", "$.data.paginatedEvents.collection[0]"]
    assert "error" in rows["e3", "error"]
    events = normalize.events(parsed, AS_OF).collect()
    assert sorted((r["title"], str(r["event_day"]), r["start_time"]) for r in events) == [("N", "2025-03-01", "19:00:00"), ("The Band", "2025-01-15", "19:30:00"), ("The Band", "2025-02-01", None)]
    assert [r["name"] for r in normalize.artists(parsed, AS_OF).where("source_id = 'sea_monster'").collect()] == ["The Band"]
    assert sorted(r["name"] for r in normalize.venues(parsed, AS_OF).collect()) == ["Conor Byrne Pub", "Sea Monster Lounge"]
    out = entities(raw, plans, AS_OF)
    assert {k: v.count() for k, v in out.items()} == {"venue": 2, "artist": 2, "event": 3}
    assert normalize.unknown(spark.createDataFrame([("nowhere", "e")], "source_id string, envelope_id string")).count() == 1
    whole = payloads.structured(spark.createDataFrame([("s", "e", "r", '[{"a":1},{"a":2}]'), ("s", "f", "r", '{"a":3}')], RAW))
    assert sorted(json.loads(r["record"])["a"] for r in whole.collect()) == [1, 2, 3]


def test_listings(spark):
    venues = spark.createDataFrame([(1, "Hall", "Seattle"), (2, "100% Bar_", "Tacoma")], "id int, name string, city string")
    artists = spark.createDataFrame([(1, "Zed", "zed"), (2, "abe", "abe")], "id int, name string, name_slug string")
    events = spark.createDataFrame([(1, "Jazz", date(2025, 8, 1), 1, [2, 1, 9]), (2, "Rock", date(2025, 7, 1), 2, [1]), (3, "jazz too", date(2025, 8, 9), 2, [])], "id int, title string, event_day date, venue_id int, artist_ids array<int>")
    q = listings.Listings(venues, artists, events, None, AS_OF)
    assert [r["id"] for r in q.search_events("JAZZ", "100%").collect()] == [3]
    assert [r["id"] for r in q.events(10, 50).collect()] == []
    assert [r["id"] for r in q.artist_events(1).collect()] == [2, 1]
    assert [r["id"] for r in q.artists_by_ids([2, 7, 1]).collect()] == [2, 1]
    assert {r["id"]: r["artists"] for r in listings.event_artists(events, artists).collect()} == {1: ["abe", "Zed"], 2: ["Zed"]}
    assert q.venue_by_slug("hall").head()["id"] == 1
    kept, n = q.delete_events_by_venue_name("HALL")
    assert (kept.count(), n.head()["n_deleted"]) == (2, 1)
    nodes = spark.createDataFrame([("n1", "venue", '{"id":"other","name":"V"}')], "id string, label string, data string")
    assert [tuple(r) for r in listings.decode(nodes, "venue", "id string, name string").collect()] == [("n1", "V")]


def test_metrics(spark):
    t = lambda m: datetime(2025, 1, 1, 0, m)
    s = spark.createDataFrame([("c", t(0), 1.0), ("c", t(1), 4.0), ("c", t(2), 2.0)], "name string, ts timestamp, value double")
    rates = {r["window_start"]: r["rate"] for r in metrics.counter_rate(s, ["name"]).collect()}
    assert rates[t(0)] == pytest.approx(5.0 * 60 / 300)
    h = metrics.buckets(s, ["name"])
    assert {r["le"]: r["n"] for r in h.collect()}[2.5] == 2
    assert metrics.quantile(h, ["name"], 0.5).head()["quantile"] == pytest.approx(1.0 + 1.5 * 0.5)


def test_plan_policies():
    boom = Step("b", lambda r: 1 / 0, ("a",))
    steps = lambda: [Step("c", lambda r: r["b"], ("b",)), boom, Step("a", lambda r: 5)]
    assert [s.name for s in Plan(steps()).validate()] == ["a", "b", "c"]
    with pytest.raises(ZeroDivisionError):
        Plan(steps()).run()
    assert Plan(steps(), "continue").run() == {"a": 5}
    assert Plan(steps(), "skip").run() == {"a": 5, "b": 5, "c": 5}
    with pytest.raises(ValueError, match="needs"):
        Plan([boom]).validate()
    with pytest.raises(ValueError, match="cycle"):
        Plan([Step("x", None, ("y",)), Step("y", None, ("x",))]).validate()
    assert parse_only(lambda r: 1).run() == {"parse": 1}


def test_calendar_keeps_what_elements_hold(spark):
    """Empty objects, own days, nested values, strings, arrays and nulls under a day."""
    doc = '{"eventsByDates":{"2025-01-02":[{},{"event_day":"old","n":{"a":[1,null,"x"]},"t":true},"text",[1,2]],"2025-01-03":[],"2025-01-04":null}}'
    raw = spark.createDataFrame([("s", "e", "r", doc), ("s", "f", "r", '{"events":[]}'), ("s", "g", "r", "no json")], RAW)
    got = {(r["envelope_id"], r["record_path"]): r["record"] for r in payloads.calendar(raw).collect()}
    assert got.pop(("g", "$")) == "no json"
    day = "$.eventsByDates.2025-01-02"
    assert json.loads(got["e", f"{day}[0]"]) == {"event_day": "2025-01-02"} and json.loads(got["e", f"{day}[1]"]) == {"event_day": "2025-01-02", "n": {"a": [1, None, "x"]}, "t": True}
    assert got["e", f"{day}[2]"] == "text" and json.loads(got["e", f"{day}[3]"]) == [1, 2] and len(got) == 4


def test_inferred_days(spark):
    records = {'{"start":{"date":"2025-01-02T10:00:00Z"},"date":1735689600}': "2025-01-02", '{"startDate":1735689600,"date":"2020-01-01"}': "2025-01-01", '{"date":"soon","event_day":"2025-03-04"}': "2025-03-04", '{"date":"not a date at all","event_day":"2025-03-04"}': "2025-08-01", "{}": "2025-08-01", "x": "2025-08-01"}
    df = spark.createDataFrame([(r,) for r in records], "record string")
    assert {r["record"]: str(r["d"]) for r in df.select("record", T.infer_day(F.col("record"), F.lit(AS_OF).cast("date")).alias("d")).collect()} == records


def test_artists_of_radio_titles(spark):
    titles = {"Indigo De Souza LIVE on KEXP (OPEN TO THE PUBLIC)": ["Indigo De Souza"], "AB LIVE on KEXP": [], " LIVE on KEXP": [], "A One / B Two, C+D": ["A One", "B Two"], "KEXP Presents X": [], "Trio & The Show": ["Trio"]}
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert {r["t"]: r["a"] for r in df.select("t", T.title_artists(F.col("t")).alias("a")).collect()} == titles


def test_update_and_delete_remove_edges(spark):
    events = spark.createDataFrame([(1, "a", 10, [5, 6]), (2, "b", 11, [5])], "id int, title string, venue_id int, artist_ids array<int>")
    edges = catalog.event_edges(events)
    kept, after = catalog.update_events(events, edges, events.where("id = 1").withColumn("artist_ids", F.array(F.lit(6), F.lit(6), F.lit(7))))
    assert sorted(tuple(r) for r in after.collect()) == [(5, 2, "performs_at"), (6, 1, "performs_at"), (7, 1, "performs_at"), (10, 1, "hosts"), (11, 2, "hosts")] and kept.count() == 2
    q = listings.Listings(events.limit(0), events.limit(0), events, edges, AS_OF)
    left, touched = q.delete_event(2)
    assert [r["id"] for r in left.collect()] == [1] and {r["target_id"] for r in touched.collect()} == {1}
    assert listings.Listings(events, events, events, None, AS_OF).delete_event(2)[1] is None


def test_update_of_edges_is_dealt_by_rows(spark, duck, tmp_path, monkeypatch):
    """Tasks are as many as rows need, whatever the session's number; no lists are put together for edges. Lines that repeat,
    lines of no order and orders without lines."""
    monkeypatch.setattr(lineage, "ROWS", 500)
    assert [lineage.dealt(spark.range(n), "id").rdd.getNumPartitions() for n in (5001, 5000)] == [11, 10]
    few = spark.range(100).repartition(3)
    assert lineage.dealt(few, "id") is few
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").where("l_orderkey % 7 <> 0")
    lines.unionByName(lines.limit(99)).unionByName(lines.limit(9).withColumn("l_orderkey", F.lit(-3).cast("long"))).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(f"{DATA}/orders.parquet").write.parquet(str(tmp_path / "orders.parquet"))
    for t in ("customer", "part"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    duck.execute(f"CREATE TEMP VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    try:
        want = duck.sql(catalogue.ORACLE_SQL["update_events_edges"])
        got = upkeep.update_events_edges(spark, str(tmp_path))
        assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())
    finally:
        duck.execute("DROP VIEW temp.lineitem")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("threshold", [0.0, 0.4, 0.6, 0.75, 0.8, 0.95, 1.0])
def test_fuzzy_match_is_brute_force(spark, threshold):
    rng = random.Random(3)
    base = ["".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(40)] + ["", "x"]
    names = list(enumerate(base))
    known = [(100 + i, "".join(c if rng.random() > 0.15 else rng.choice(["", "b", "cc"]) for c in n)) for i, n in names if rng.random() < 0.8]

    def similarity(a, b):
        if a == b:
            return 1.0
        if not a or not b:
            return 0.0
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return 1 - row[-1] / max(len(a), len(b))

    want = {}
    for i, n in names:
        near = [(n != k, j, s) for j, k in known if (s := similarity(n, k)) >= threshold]
        want[i] = min(near)[1] if near else None
    schema = "id int, name string"
    got = conflation.fuzzy_match(spark.createDataFrame(names, schema), spark.createDataFrame(known, schema), threshold)
    assert {r["id"]: r["matched_id"] for r in got.collect()} == want
    assert conflation.fuzzy_match(spark.createDataFrame(names, schema), spark.createDataFrame([], schema), threshold).where("matched_id is not null").count() == 0


def test_counter_over_hours_and_resets(spark):
    """Gains across hour borders, gaps of many hours and resets, for two keys, against a plain walk over samples."""
    rng = random.Random(8)
    rows, value = [], {"a": 0.0, "b": 5.0}
    for name in value:
        at = datetime(2025, 1, 1, 0, 0)
        for _ in range(120):
            at += timedelta(minutes=rng.choice([1, 7, 59, 60, 400]), seconds=rng.randint(0, 50))
            value[name] = rng.random() if rng.random() < 0.1 else value[name] + rng.random()
            rows.append((name, at, value[name]))
    want = {}
    before = {}
    for name, at, v in rows:
        b = before.get(name)
        gain = 0.0 if b is None else v if v < b else v - b
        before[name] = v
        start = at.replace(second=0)
        for m in range(5):
            k = (name, start - timedelta(minutes=m))
            want[k] = want.get(k, 0.0) + gain
    got = metrics.counter_rate(spark.createDataFrame(rows, "name string, ts timestamp, value double").repartition(5), ["name"])
    assert {(r["name"], r["window_start"]): round(r["rate"], 9) for r in got.collect()} == {k: round(v * 60 / 300, 9) for k, v in want.items()}


def test_entities_parse_once(spark):
    """With a checkpoint folder the three tables share one parse."""
    raw = spark.createDataFrame([("sea_monster", "e1", "r", json.dumps({"events": [{"title": "T", "date": "2025-02-01"}]}))], RAW)
    plans = spark.createDataFrame([("sea_monster", "wix_calendar_v1")], "source_id string, parse_plan_ref string")
    out = entities(raw, plans, AS_OF)
    assert all("Scan ExistingRDD" in v._jdf.queryExecution().executedPlan().toString() for v in out.values())
    accepted = resolved(out["venue"], "venue", spark.createDataFrame([], ENTITY))
    assert [r["resolution"] for r in accepted.collect()] == ["NewEntity"]


def test_registered_plans_sources_and_handlers(spark):
    pages.register("plain_v1", lambda page, as_of: iter([("$", {"title": page.text()})]))
    normalize.register("kiosk", normalize.Source("Kiosk", "kiosk", 1.0, 2.0, "1 St", "1", "N"))
    catalog.register(catalog.Handler("kiosk", ("name",), ("name",)))
    try:
        raw = spark.createDataFrame([("kiosk", "e", "r", "<b>Act</b>")], RAW)
        plans = spark.createDataFrame([("kiosk", "plain_v1")], "source_id string, parse_plan_ref string")
        parsed = payloads.parse(raw, plans, AS_OF)
        assert [r["title"] for r in normalize.events(parsed, AS_OF).collect()] == ["Act"]
        now = spark.createDataFrame([(1, "A")], "id int, name string")
        assert [r["change_type"] for r in catalog.HANDLERS["kiosk"].candidates(now, now.withColumn("name", F.lit("B"))).collect()] == ["UPDATE"]
    finally:
        del pages.PLANS["plain_v1"], normalize.SOURCES["kiosk"], catalog.HANDLERS["kiosk"]


def test_plain_pages_have_the_same_tree(monkeypatch):
    """Pages of plain tags are read without the parser, any other page by it, and the tree is the same."""

    def form(x):
        kids: list = []
        for c in x.children:
            if isinstance(c, str) and kids and isinstance(kids[-1], str):
                kids[-1] += c
            else:
                kids.append(c if isinstance(c, str) else form(c))
        return x.tag, x.attrs, x.classes, x.place, x.end, kids

    def parsed(html):
        with monkeypatch.context() as m:
            m.setattr(pages, "_plain", lambda html: None)
            return form(pages.tree(html))

    bits = ["<p>", "</p>", '<div class="a b">', "</div>", '<a href="x?y">', "</a>", '<img src="i">', "<br>", "<br/>", "t &amp; u", "&lt", "& ", "<script>", "</script>", '{"a":1}', "<!-- c -->", "<", '<h3 CLASS="x">', "<span data-x>", "</ div>", " ", "é", '<p id="1" id="2">', "<title>", "</title>", '<a b="&amp;">', "<textarea>", '<a\x0bb="c">', "</script >"]
    rng, plain = random.Random(5), 0
    for _ in range(20_000):
        html = "".join(rng.choices(bits, k=rng.randint(0, 6)))
        assert form(pages.tree(html)) == parsed(html), html
        plain += pages._plain(html) is not None
    assert plain > 1000


def test_payloads_are_made_once(spark):
    """Plans read what was stored of the payloads; none aggregates orders anew."""
    from stagelight import chain

    got = []
    parse = payloads.parse

    def seen(raw, *rest):
        got.append(raw._jdf.queryExecution().optimizedPlan().toString())
        return parse(raw, *rest)

    payloads.parse = seen
    try:
        chain.parse_by_plan(spark, "/root/testdata/sf0.001")
    finally:
        payloads.parse = parse
    assert got and "Aggregate" not in got[0]


def test_payloads_stay_where_they_are(spark):
    """Plans go to the payloads, however large Spark takes them for: by source, a task would get all payloads of one."""
    raw = spark.createDataFrame([("kexp", "1", "r", "<p>none</p>"), ("blue_moon", "2", "r", '{"events":[{"a":1}]}')], "source_id string, envelope_id string, payload_ref string, payload string")
    plans = spark.createDataFrame([("kexp", "parse_plan:kexp_html_v1")], "source_id string, parse_plan_ref string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = payloads.parse(raw, plans, AS_OF)
        assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["source_id"], r["record"]) for r in found.collect()) == [("blue_moon", '{"a":1}'), ("kexp", '{"html_len": 11}')]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_documents_of_all_kinds_are_grouped_once(spark):
    """Orders are brought together by customer once, as keys and days, not as texts for each kind."""
    from stagelight import chain
    from stagelight.catalogue import Tables

    found = chain._documents(Tables(spark, "/root/testdata/sf0.001").orders, chain.RADIO, chain.WARMUP, chain.BARBOZA)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "partial_collect_list(struct(o_orderkey, o_orderkey" in plan
    assert found.select("payload").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism  # however small keys and days are
    assert {r["source_id"]: r["n"] for r in found.groupBy("source_id").agg(F.countDistinct("envelope_id").alias("n")).collect()} == dict.fromkeys(("kexp", "sea_monster", "barboza"), Tables(spark, "/root/testdata/sf0.001").orders.select("o_custkey").distinct().count())


_SNIPPETS = {
    "barboza_html_v1": ["<main>", "<div class='eventItem'>", '<div class="eventItem"><h3 class="title"><a href="/e/7"> M </a></h3></div>', '<div class="eventItem"><h3 class="title"><a href="/e/8"><b>Two</b> parts</a></h3><div class="promotion-text tour">To</div><div class="promotion-text">By</div></div>', '<div id="a" class="x eventItem"><span class="m-date__month">Feb</span><span class="m-date__day">3</span><div class="meta"><span class="time">8:00</span><span class="location">H &amp; L</span></div></div>', "</main>", "</div>", '<div class="eventItem">', "<p>", "</p>", "<br>", "<!-- c -->", "a > b", '="', "\0", "<script>", "</script>"],
    "kexp_html_v1": ["<body>", "<h2>Day 1</h2>", '<h2 id="x">Day <b>2</b></h2>', '<article class="EventItem"><div class="EventItem-body"><h3><a>One &amp; a</a></h3><div class="u-h3"><a> Hall </a></div></div></article>', '<article class="EventItem x"><div class="EventItem-body"><h3><a>Two</a></h3></div><div class="EventItem-DateTime"><h5>1 p.m.</h5></div></article>', "</body>", "<p>", "</article>", "<h2>", "</h2>", "<", "&lt"],
    "darrells_html_v1": ['<div class="entry-content">', "<h1>MUSIC 3.5</h1>", "<h1>MUSIC 2.30</h1>", "<h1>MUSIC 99999999999.1</h1>", "<p><a>Act 5</a>\nGuest 5\nwith Act 5\nDOORS 8\n$5</p>", "<p>x &amp; y</p>", "</div>", "<p>", "<section>", "</section>", "<b>z</b>"],
}


@pytest.mark.parametrize("name", ["barboza_html_v1", "neumos_html_v1", "kexp_html_v1", "darrells_html_v1"])
def test_pages_are_the_same_by_layout(name):
    """Items put into what was found in another of their layout are those found in the whole tree, in regular and broken pages."""
    plan, bits, rng, by_layout = pages.PLANS[name], _SNIPPETS[name.replace("neumos", "barboza")], random.Random(7), 0
    for _ in range(8000):
        html = (bits[0] if rng.random() < 0.7 else "") + "".join(rng.choices(bits[1:], k=rng.randint(0, 5)))
        finds = plan.finds(html)
        want = list(plan(pages.tree(html), AS_OF))
        assert finds is None or list(plan.say(finds, AS_OF)) == want, html
        by_layout += finds is not None and len(want) > 0
    assert by_layout > 50


def test_items_of_one_layout_are_looked_at_once(monkeypatch):
    """What a page's items cost does not grow by the elements in them, but for the first of each layout."""
    looks, fed = [], []
    plan = pages.PLANS["barboza_html_v1"]

    def look(page):
        looks.append(page)
        return pages._look_ticketed(page)

    monkeypatch.setattr(pages, "tree", fed.append)
    items = "".join(f'<div class="eventItem"><h3 class="title"><a href="/e/{k}"> Main {k} &amp; all</a></h3>{"<p>x</p>" * (k % 3)}</div>' for k in range(300))
    found = pages._records_of(f"<main>{items}</main>", pages.Listed(plan.mark, look, plan.say), AS_OF)
    assert [r for _, r in found][7].startswith('{"title": "Main 7 & all", "detail_url": "/e/7"') and len(found) == 300
    assert len(looks) <= 5 and not fed  # the page's opening, three layouts, and the one that closes it


def test_records_are_read_once(spark):
    """Neither the condition on titles nor any field reads a record's JSON anew."""
    from stagelight import chain

    found = normalize.events(chain._records(spark, "/root/testdata/sf0.001"), AS_OF).select("title", "event_day", "venue_id", "warnings")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1

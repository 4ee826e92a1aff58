"""Cascades, merged tables by their files, quantiles of rates and of sketches, phases, and page plans in SQL."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stagelight import kept
from stagelight.catalogue import ORACLE_SQL, QUERIES
from stagelight.operators import catalog, metrics, pages, phases
from stagelight.sources.merged import MergedTable, upsert_graph
from tests.conftest import DATA

NODES, EDGES = "id string, label string, data string", "source_id string, target_id string, relation string"


def test_cascade(spark):
    """Artists of one venue, of two that both go, of one that stays, and of an event that two venues host."""
    nodes = [(v, "venue", f'{{"slug":"{v}"}}') for v in ("v1", "v2", "v3")] + [(e, "event", "{}") for e in ("e1", "e2", "e3", "both", "alone")] + [(a, "artist", "{}") for a in ("one", "two", "stays", "shared", "free", "idle")]
    hosts = [("v1", "e1"), ("v2", "e2"), ("v3", "e3"), ("v1", "both"), ("v3", "both")]
    acts = [("one", "e1"), ("two", "e1"), ("two", "e2"), ("stays", "e1"), ("stays", "e3"), ("shared", "both"), ("free", "alone"), ("free", "e1")]
    edges = [(*x, "hosts") for x in hosts] + [(*x, "performs_at") for x in acts] + [("two", "one", "knows"), ("stays", "idle", "knows")]
    n, e = spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES)

    def left(*slugs):
        a, b = catalog.cascade(n, e, catalog.venues_by_slug(n, list(slugs)))
        return {r["id"] for r in a.collect()}, {(r["source_id"], r["target_id"]) for r in b.collect()}

    every = {x[0] for x in nodes}
    gone = {"v1", "e1", "both", "one", "shared", "free"}
    assert left("v1") == (every - gone, {("v2", "e2"), ("v3", "e3"), ("two", "e2"), ("stays", "e3"), ("stays", "idle")})
    assert left("v1", "v2")[0] == every - gone - {"v2", "e2", "two"}  # goes with the last venue
    assert left("none") == (every, {x[:2] for x in edges})


def test_cascade_meets_edges_once(spark, tmp_path):
    """Random graphs with repeated edges, null ends and events without a venue, against plain loops. What stays is read from the
    kept edges, not from the given ones anew, and no ids are broadcast."""
    rng = random.Random(5)
    pick = lambda kind, n: rng.choice([None, *[f"{kind}{i}" for i in range(n)]])
    edges = [(pick("v", 9), pick("e", 40), "hosts") for _ in range(30)] + [(pick("a", 40), pick("e", 40), "performs_at") for _ in range(90)]
    edges += rng.choices(edges, k=20) + [("a1", "a2", "knows"), ("e3", "a4", "knows"), ("a5", "v0", "likes"), (None, None, "knows")]
    nodes = [(f"{k}{i}", k, "{}") for k, n in (("v", 9), ("e", 40), ("a", 40)) for i in range(n)]
    gone = {"v0", "v1", "v2", "v3", "v4", "v5"}
    events = {e for v, e, r in edges if r == "hosts" and v in gone and e is not None}
    held = {e for _, e, r in edges if r == "hosts" and e is not None} - events
    plays = lambda at: {a for a, e, r in edges if r == "performs_at" and e in at and a is not None}
    every = gone | events | plays(events) - plays(held)
    want = sorted((x for x in edges if not {x[0], x[1]} & every), key=str)
    spark.createDataFrame(edges, EDGES).write.parquet(str(tmp_path / "edges"))
    n, e, v = spark.createDataFrame(nodes, NODES), spark.read.parquet(str(tmp_path / "edges")), spark.createDataFrame([(x,) for x in [*sorted(gone), "v0", None]], "id string")
    for folder in (None, str(tmp_path / "kept")):
        stay, left = catalog.cascade(n, e, v, folder)
        assert sorted((tuple(r) for r in left.select(*e.columns).collect()), key=str) == want and plays(events) & plays(held) and plays(events) - plays(held)
        assert {r["id"] for r in stay.collect()} == {x[0] for x in nodes} - every
    assert not set(left.inputFiles()) & set(e.inputFiles())


def test_cascade_of_repeated_rows(spark, duck, tmp_path):
    """Orders that are there twice host twice; who has two lines in an order performs once."""
    for t in ("customer", "part", "orders", "lineitem"):
        rows = spark.read.parquet(f"{DATA}/{t}.parquet")
        (rows.unionByName(rows.limit(50)) if t == "orders" else rows.unionByName(rows) if t == "lineitem" else rows).write.parquet(str(tmp_path / f"{t}.parquet"))
        duck.execute(f"CREATE OR REPLACE TEMP VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    try:
        for q in ("cascade_edges", "cascade_nodes"):
            want = duck.sql(ORACLE_SQL[q])
            got = QUERIES[q](spark, str(tmp_path)).select(*want.columns).collect()
            assert sorted(tuple(r) for r in got) == sorted(want.fetchall())
    finally:
        for t in ("customer", "part", "orders", "lineitem"):
            duck.execute(f"DROP VIEW temp.{t}")


def files(folder):
    return {str(p.relative_to(folder)) for p in folder.glob("bucket=*/*.parquet")}


def test_merges_rewrite_only_what_changes(spark, tmp_path):
    folder = tmp_path / "t"
    table = MergedTable(spark, str(folder), "id long, name string, at string", ["id"], buckets=8, keep=("at",))
    row = lambda ids, name, at: spark.createDataFrame([(i, f"{name}{i}", at) for i in ids], "id long, name string, at string")
    assert table.read().count() == 0
    assert table.upsert(row(range(100), "a", "1")) == {"new": 100, "changed": 0, "same": 0, "partitions": 8}
    before = files(folder)
    assert table.upsert(row(range(100), "a", "2")) == {"new": 0, "changed": 0, "same": 100, "partitions": 0} and files(folder) == before
    assert table.upsert(row([5], "b", "3"))["partitions"] == 1
    after = files(folder)
    assert len({f.split("/")[0] for f in before - after}) == 1 and {f.split("/")[0] for f in before - after} == {f.split("/")[0] for f in after - before}
    stored = {r["id"]: (r["name"], r["at"]) for r in table.read().collect()}
    assert stored == {i: (f"{'b' if i == 5 else 'a'}{i}", "1") for i in range(100)}  # what is kept stays
    assert table.delete(spark.createDataFrame([(5,), (5,), (1000,)], "id long")) == 1 and len({f.split("/")[0] for f in after - files(folder)}) == 1
    assert table.delete(table.read().select("id")) == 99 and files(folder) == set() and table.read().count() == 0
    twice = row([1], "x", "4").unionByName(row([1], "y", "5")).unionByName(spark.createDataFrame([(None, "n", "6")], "id long, name string, at string"))
    assert table.upsert(twice, order="at")["new"] == 2 and {(r["id"], r["name"]) for r in table.read().collect()} == {(1, "y1"), (None, "n")}
    assert table.upsert(twice.where("id is null"))["same"] == 1


def test_graph_tables(spark, tmp_path):
    nodes = MergedTable(spark, str(tmp_path / "n"), NODES, ["id"], buckets=4)
    edges = MergedTable(spark, str(tmp_path / "e"), EDGES + ", data string", ["source_id", "target_id", "relation"], buckets=4)
    n, e = spark.createDataFrame([("a", "venue", "{}")], NODES), spark.createDataFrame([("a", "b", "hosts", "1")], EDGES + ", data string")
    assert upsert_graph(nodes, edges, n, e)["edges"]["new"] == 1
    assert upsert_graph(nodes, edges, n, e.withColumn("data", F.lit("2")))["edges"] == {"new": 0, "changed": 1, "same": 0, "partitions": 1}


def test_rate_quantiles_see_resets_and_only_the_window(spark):
    start = datetime(2025, 1, 1, 10)
    at = lambda m: start + timedelta(minutes=m)
    inf = float("inf")
    # bound 1 counts 10 a minute, bound 2 another 10; the server starts again after the third minute
    rows = [(1.0, at(0), 100.0), (1.0, at(1), 110.0), (1.0, at(2), 120.0), (1.0, at(3), 10.0), (2.0, at(0), 200.0), (2.0, at(1), 220.0), (2.0, at(2), 240.0), (2.0, at(3), 20.0), (inf, at(0), 200.0), (inf, at(1), 220.0), (inf, at(2), 240.0), (inf, at(3), 20.0)]
    got = metrics.rate_quantiles(spark.createDataFrame(rows, "le double, ts timestamp, value double"), [], (0.25, 0.75, 1.0), "5 minutes", "5 minutes").collect()
    assert {(r["share"], round(r["quantile"], 9)) for r in got} == {(0.25, 0.5), (0.75, 1.5), (1.0, 2.0)}


def test_sketches_are_within_their_bound(spark):
    rng = random.Random(6)
    values = [rng.lognormvariate(0, 2) for _ in range(40_000)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)] + [(0, None), (0, float("nan")), (9, None)], "part int, value double").repartition(8)
    sketches = metrics.value_sketches(df, ["part"])
    found = metrics.sketch_quantiles(metrics.merged_sketches(sketches.withColumn("all", F.lit(1)), ["all"]), ["all"], (0.01, 0.5, 0.95, 0.99)).collect()
    values.sort()
    for r in found:
        rank = sum(v <= r["quantile"] for v in values) / len(values)
        assert abs(rank - r["share"]) <= 3 * 1.7 / metrics.SKETCH
    assert len(found) == 4 and metrics.sketch_quantiles(sketches.where("part = 9"), ["part"]).count() == 0


def test_phases(spark, tmp_path):
    run = phases.Phases("r1", bounds=(1.0, 5.0))
    df = spark.range(100).selectExpr("id", "cast(id as double) / 10 as seconds")
    seen = run.watch(df, "parser", {"odd": F.col("id") % 2 == 1}, {"largest": F.max("id")}, {"seconds": F.col("seconds")})
    assert seen.where("id >= 0").collect() and run.watch(seen.where("id < 10"), "quality_gate").count() == 10
    with pytest.raises(ValueError, match="no phase"):
        run.watch(df, "elsewhere")
    at = datetime(2025, 1, 1)
    run.write(spark, str(tmp_path / "m"), at)
    stored = spark.read.schema(phases.SAMPLES).parquet(str(tmp_path / "m"))
    got = {(r["phase"], r["name"], r["kind"], r["le"]): r["value"] for r in phases.totals(stored).collect()}
    inf = float("inf")
    assert got == {
        ("parser", "rows", "counter", None): 100.0, ("parser", "odd", "counter", None): 50.0, ("parser", "largest", "gauge", None): 99.0, ("parser", "seconds", "bucket", 1.0): 11.0, ("parser", "seconds", "bucket", 5.0): 51.0,
        ("parser", "seconds", "bucket", inf): 100.0, ("parser", "seconds", "sum", None): 495.0, ("quality_gate", "rows", "counter", None): 10.0,
    }


def test_phases_of_a_stream(spark, tmp_path):
    for i in range(3):
        spark.range(10 * (i + 1)).write.parquet(str(tmp_path / "in" / str(i)))
    noted = phases.StreamSamples()
    spark.streams.addListener(noted)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 4).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        watched = phases.Phases("s").watch_stream(stream, "gateway", {"small": F.col("id") < 5})
        watched.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for _ in range(50):
            if len(noted._rows) >= 6:
                break
            import time

            time.sleep(0.1)
        got = {r["name"]: r["value"] for r in phases.totals(noted.samples(spark)).collect()}
    finally:
        spark.streams.removeListener(noted)
    assert got == {"rows": 60.0, "small": 15.0}


def test_page_plans_in_sql_are_those_of_the_operator(spark):
    pages.register_sql(spark)
    item = '<h2>March 5, 2025</h2><article class="EventItem"><div class="EventItem-body"><h3><a>Show</a></h3></div></article>'
    given = [("kexp_html_v1", item), ("kexp_html_v1", "<p>none</p>"), ("kexp_html_v1", None), ("darrells_html_v1", '<div class="entry-content"><h1>MUSIC 3.5</h1><p><a>Act</a></p></div>')]
    df = spark.createDataFrame([("s", str(i), "r", p, h) for i, (p, h) in enumerate(given)], "source_id string, envelope_id string, payload_ref string, plan string, html string")
    want = {(r["envelope_id"], r["record_path"], r["record"]) for r in pages.parse_by_plan(df, date(2025, 1, 1)).collect()}
    df.unionByName(df.limit(1).withColumn("plan", F.lit("unknown"))).createOrReplaceTempView("given_pages")
    got = spark.sql("SELECT p.envelope_id, t.* FROM given_pages p, LATERAL parse_page(html, plan, date'2025-01-01') t").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) == 4


def test_pages_go_to_sql_functions_in_batches(spark):
    """A page is no batch of its own, nothing is shuffled for parse_page, and rows that are the same stay apart."""
    pages.register_sql(spark)
    spark.createDataFrame([("a", "<p>x</p>"), ("a", "<p>x</p>"), ("b", None)], "id string, html string").createOrReplaceTempView("same_pages")
    found = spark.sql("SELECT p.id, t.* FROM same_pages p, LATERAL parse_page(html, 'kexp_html_v1', date'2025-01-01') t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "UDTF" not in plan and "Exchange" not in plan and "Join" not in plan
    assert sorted(map(tuple, found.collect())) == [("a", "html", '{"html_len": 8}')] * 2 + [("b", "html", '{"html_len": 0}')]


def test_events_at_any_depth():
    deep: object = {"events": [{"title": "t"}]}
    for _ in range(200):
        deep = {"x": [deep]}
    assert pages.find_events({"a": deep, "items": [{"name": "n"}, 1], "b": [{"event_list": [{"startDate": 1}, {"other": 2}]}]}) == [{"title": "t"}, {"name": "n"}, {"startDate": 1}]


def test_phases_keep_no_wide_rows_in_the_tasks_that_made_them(spark, monkeypatch):
    """What a phase leaves is read in splits of its own: rows of records are never checkpointed."""
    cut, seen = type(spark.range(1)).checkpoint, []
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda df, *a, **k: (seen.append(df.columns), cut(df, *a, **k))[1])
    assert kept.phases_observed(spark, "/root/testdata/sf0.001").count() == 7
    assert not [c for c in seen if "record" in c or "artist_ids" in c]

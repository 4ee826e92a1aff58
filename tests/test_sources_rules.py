"""Each source's own fields, text rules, and structured payloads, by planted records."""

import json
from datetime import date

from pyspark.sql import functions as F

from stagelight.functions import text as T
from stagelight.operators import normalize, payloads
from stagelight.plans import full

AS_OF = date(2025, 1, 1)
FIELDS = {
    "title": "Main feat. A + B & C", "description": "words", "supporting_acts": "S", "tour_name": "T", "promoter": "P", "age_restriction": "21+", "event_time": "8:00 PM", "time": "9:00 PM", "start_time": "7:00 PM", "event_day": "2025-02-03",
    "slug": "s", "image_url": "i", "mainImage": {"url": "m"}, "ticket_url": "/t", "event_url": "/e", "scheduling": {"startTimeFormatted": "6:00 PM"}, "location": "Room",
}


def test_each_source_has_its_fields(spark):
    rows = [(s, s, "r", "p", json.dumps(FIELDS)) for s in normalize.SOURCES] + [("kexp", "place", "r", "p", json.dumps({"title": "x", "location": "Room"})), ("kexp", "object", "r", "p", json.dumps({"title": "x", "location": {"name": "Room"}}))]
    parsed = spark.createDataFrame(rows, "source_id string, envelope_id string, payload_ref string, record_path string, record string")
    got = {r["envelope_id"]: (r["start_time"], r["description"], r["event_url"].removeprefix(normalize.ORIGIN), r["event_image_url"], r["venue_id"] != T.NIL_UUID) for r in normalize.events(parsed, AS_OF).where("event_url is not null").collect()}
    assert got == {
        "blue_moon": (None, "words", "/events", None, False), "sea_monster": ("18:00:00", "words", "/event-info/s", "m", False), "darrells_tavern": (None, None, "/events", None, False), "kexp": ("21:00:00", "words", "/events", None, False),
        "barboza": ("20:00:00", "With S | P | Age: 21+", "/t", "i", False), "neumos": ("20:00:00", "Tour: T | With S | P | Age: 21+", "/t", "i", True), "conor_byrne": ("20:00:00", "With S | Age: 21+", "/e", "i", True),
        "place": (None, "Room", "/events", None, False), "object": (None, None, "/events", None, False),
    }
    names = sorted(r["name"] for r in normalize.artists(parsed, AS_OF).where("source_id = 'barboza'").collect())
    assert names == ["A", "B", "C", "Main", "S"]
    out = full.assessed(normalize.tables(parsed, AS_OF), AS_OF)["event"].collect()
    assert all(r["venue_id"] != T.NIL_UUID for r in out if r["envelope_id"] in normalize.SOURCES)
    assert {r["source_id"] for r in out if any(i["field"] == "venue_id" for i in r["issues"])} == {"blue_moon", "sea_monster", "darrells_tavern", "kexp", "barboza"}


def test_featured_and_signs(spark):
    titles = {"A feat. B + C, D & E": ["B", "C", "D", "E"], "Main Feature Film": ["Film"], "X featuring Y": ["Y"], "X FEAT": [], "plain": [], None: None, "X (feat. Y)": ["Y)"]}
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert {r["t"]: r["f"] for r in df.select("t", T.featured(F.col("t")).alias("f")).collect()} == titles
    signs = {"&#039;a&#39;": "'a'", "&amp;lt;b&gt;": "&lt;b>", "&amp;amp;": "&amp;", "&quot;&nbsp;": '" '}
    df = spark.createDataFrame([(t,) for t in signs], "t string")
    assert {r["t"]: r["f"] for r in df.select("t", T.unescape_html(F.col("t")).alias("f")).collect()} == signs


def test_structured(spark):
    given = {"array": '[{"a":1},2,[3]]', "object": '{"a":{"b":"é"}}', "text": json.dumps('[{"a":1}]'), "text object": json.dumps('{"a":2}'), "broken": '{"a"', "broken text": json.dumps('{"a"'), "number": "5", "null": "null", "none": None, "empty": "[]", "twice": json.dumps(json.dumps("[1]"))}
    df = spark.createDataFrame([("s", k, "r", v) for k, v in given.items()], "source_id string, envelope_id string, payload_ref string, payload string")
    got: dict = {}
    for r in payloads.structured(df).collect():
        got.setdefault(r["envelope_id"], []).append((r["record_path"], json.loads(r["record"]) if r["record_path"] != "error" else None))
    error = [("error", None)]
    assert got == {
        "array": [("$[0]", {"a": 1}), ("$[1]", 2), ("$[2]", [3])], "object": [("$", {"a": {"b": "é"}})], "text": [("$[0]", {"a": 1})], "text object": [("$", {"a": 2})], "broken": error, "broken text": error, "number": error, "null": error, "none": error, "twice": error,
    }

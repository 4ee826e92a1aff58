import http.server
import json
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stagelight.operators import ingest
from stagelight.sources import fetch, registry
from stagelight.sources import http as http_source
from stagelight.sources.limits import Bucket, Limits
from stagelight.streaming.dedupe import OUT, tag_stream


def test_specs(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"source_id": "a", "parse_plan_ref": "parse_plan:x", "pipeline": {"parser_id": "y"}}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"source_id": "b", "enabled": False, "parse_plan_ref": "parse_plan:x"}))
    specs = registry.read_specs(spark, str(tmp_path))
    assert {r["source_id"]: r["enabled"] for r in specs.collect()} == {"a": True, "b": False}
    assert {r["source_id"]: r["parse_plan_ref"] for r in registry.parse_plans(specs).collect()} == {"a": "y", "b": "parse_plan:x"}
    assert registry.read_spec(spark, str(tmp_path), "b").count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "2025-01-02", 1)], "source string, date string, x int")
    registry.write_columnar(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p" / "source=s" / "date=2025-01-02")).count() == 1
    registry.write_by_day(df.withColumn("day_", F.to_date("date")).withColumn("partition", F.lit("accepted")), str(tmp_path / "j"), "day_", "partition")
    assert spark.read.json(str(tmp_path / "j" / "partition=accepted" / "year=2025" / "month=1" / "day=2")).count() == 1
    (tmp_path / "cas").mkdir()
    (tmp_path / "cas" / "x").write_bytes(b"body")
    assert registry.read_payloads(spark, str(tmp_path / "cas")).head()["payload_ref"].startswith("cas:sha256:230d8358dc8e8890b4c58deeb62912ee2f20357ae92a5cc861b98e68fe31acb5")


def test_http_source(spark):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.send_header("ETag", "e1")
            self.end_headers()
            self.wfile.write(b"hello")

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    http_source.register(spark)
    url = f"http://127.0.0.1:{server.server_port}/x"
    r = spark.read.format("http_payloads").option("urls", json.dumps([url])).load().head()
    server.shutdown()
    assert (r["status"], bytes(r["content"]), r["content_length"], r["etag"]) == (200, b"hello", 5, "e1")


def test_stream_dedupe(spark, tmp_path):
    schema = "envelope_id string, idempotency_key string, accepted_at timestamp, payload_ref string"
    rows = [("1", "k", datetime(2025, 1, 1), "r1"), ("2", "k", datetime(2025, 1, 2), "r2"), ("3", "j", datetime(2025, 1, 3), "r3")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = tag_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["envelope_id"]: (r["dedupe_of"], r["payload_ref"]) for r in spark.read.schema(OUT).parquet(str(tmp_path / "out")).collect()}
    first, again = (got["1"], got["2"]) if got["1"][0] is None else (got["2"], got["1"])  # files come in either order
    assert got["3"] == (None, "r3") and first[0] is None and first[1] in ("r1", "r2") and again == ("1" if first is got["1"] else "2", None)


def test_limits():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    clocks = {"clock": lambda: now[0], "sleep": sleep}
    bucket = Bucket(6, **clocks)
    assert [bucket.take(1) for _ in range(6)] == [0.0] * 6
    assert abs(bucket.take(1) - 10) < 0.01  # six a minute: ten seconds for the next
    now[0] += 600
    assert bucket.take(6) == 0.0 and abs(bucket.take(3) - 30) < 0.01
    large = Bucket(10, **clocks)
    assert large.take(25) == 0.0 and abs(large.take(10) - 150) < 0.01  # more than the bucket holds: paid for afterwards
    limits = Limits(60, 1000, share=0.5, **clocks)
    slept.clear()
    for _ in range(31):
        limits.acquire()
    assert len(slept) == 1 and abs(sum(slept) - 2) < 0.01
    Limits().acquire(10**9)


@pytest.fixture
def site():
    class Handler(http.server.BaseHTTPRequestHandler):
        def answer(self, code, body, kind="text/html; charset=utf-8", **headers):
            self.send_response(code)
            for k, v in ({"Content-Type": kind, "Content-Length": str(len(body))} | headers).items():
                self.send_header(k.replace("_", "-"), v)
            self.end_headers()
            self.wfile.write(body)

        def do_GET(self):
            pages = {"/a": (200, b"page a"), "/b": (200, b"{}", "application/json"), "/png": (200, b"x", "image/png"), "/big": (200, b"y" * 5000), "/gone": (404, b"no such page"), "/broken": (503, b"later")}
            self.answer(*pages[self.path])

        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.answer(200, json.dumps({"data": {"paginatedEvents": {"collection": [{"name": body["variables"]["n"] + self.headers.get("X-Key", "")}]}}}).encode(), "application/json")

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_answers_of_every_kind_are_rows(spark, site):
    urls = [f"{site}/a", f"{site}/gone", f"{site}/broken", "http://127.0.0.1:1/refused", "no url"]
    got = {r["url"]: r for r in http_source.fetched(spark, urls, timeout=5).collect()}
    assert [got[u]["status"] for u in urls] == [200, 404, 503, None, None]
    assert bytes(got[urls[1]]["content"]) == b"no such page" and got[urls[0]]["error"] is None and got[urls[3]]["error"] and got[urls[4]]["error"].startswith("ValueError")


def test_graphql(spark, site):
    page = "<script>window.cfg = {apiKey: 'k1', other: 2}</script>"
    r = http_source.graphql(spark, f"{site}/graphql", "query Q { x }", {"n": "Name "}, {"X-Key": http_source.named_value(page, "apiKey")}).head()
    assert json.loads(bytes(r["content"]))["data"]["paginatedEvents"]["collection"] == [{"name": "Name k1"}]
    assert http_source.named_value(page, "absent") is None


def test_fetch_stage(spark, site, tmp_path):
    """Cadence, limits, status, MIME type and size, digests and keys; what is stored already is not stored again."""
    base = {"content": {"allowed_mime_types": ["text/html", "application/json"], "max_payload_size_bytes": 1000}, "rate_limits": {"requests_per_min": 6000, "concurrency": 2}}
    specs = {"all": ["a", "b", "png", "big", "gone"], "fresh": ["a"], "off": ["a"], "open": ["png"]}
    for name, paths in specs.items():
        spec = {"source_id": name, "enabled": name != "off", "endpoints": [{"url": f"{site}/{x}", "method": "GET"} for x in paths]} | ({} if name == "open" else base)
        (tmp_path / "specs").mkdir(exist_ok=True)
        (tmp_path / "specs" / f"{name}.json").write_text(json.dumps(spec))
    last = spark.createDataFrame([("fresh", datetime(2025, 1, 1, 6)), ("all", datetime(2024, 12, 31))], "source_id string, fetched_at timestamp")
    rows = fetch.fetch(spark, registry.read_specs(spark, str(tmp_path / "specs")), last, "2025-01-01 12:00:00")
    assert {(r["source_id"], r["url"].rsplit("/")[-1]): r["rejection"] for r in rows.collect()} == {("all", "a"): None, ("all", "b"): None, ("all", "png"): "mime", ("all", "big"): "size", ("all", "gone"): "status", ("open", "png"): None}
    envelopes = fetch.envelopes(rows)
    assert {tuple(r["faults"]) for r in ingest.envelope_faults(envelopes).collect()} == {()} and envelopes.count() == 3
    store = str(tmp_path / "cas")
    contents = ingest.content_addressed(envelopes.select("content"))
    for _ in range(2):
        registry.write_content(contents, store)
        assert spark.read.parquet(store).count() == 3
    nothing = fetch.fetch(spark, registry.read_specs(spark, str(tmp_path / "specs")), spark.createDataFrame([(n, datetime(2025, 1, 1, 11)) for n in specs], "source_id string, fetched_at timestamp"), "2025-01-01 12:00:00")
    assert nothing.count() == 0


def test_envelope_examples(spark):
    """The published examples are valid, a digest that is no hexadecimal number is refused."""
    schema = "envelope_version string, source_id string, idempotency_key string, mime_type string, size_bytes bigint, sha256 string, url string, status int, fetched_at timestamp, payload_ref string"
    row = ("1.0.0", "sea_monster", "k" * 16, "application/json", 10, "a" * 64, "https://x.example", 200, datetime(2025, 1, 1), None)
    changed = {5: "NOTAHEX", 1: "ab", 2: "short", 4: None, 8: None, 0: "0.9", 7: 1000}
    rows = [row, (*row[:9], "cas:sha256:x"), *[tuple(v if i == j else x for j, x in enumerate(row)) for i, v in changed.items()]]
    got = [r["faults"] for r in ingest.envelope_faults(spark.createDataFrame(rows, schema).coalesce(1)).collect()]
    assert got == [[], [], ["sha256"], ["source_id"], ["idempotency_key"], ["size_bytes"], ["fetched_at"], ["envelope_version"], ["status"]]


def test_consumer_reads_again_after_a_failure(spark, tmp_path):
    for i in range(4):
        spark.createDataFrame([(f"e{i}", i)], "envelope_id string, pos int").coalesce(1).write.json(str(tmp_path / "log" / str(i)))
    seen, fail = [], [True]

    def process(batch, number):
        rows = sorted(r["envelope_id"] for r in batch.collect())
        if number == 1 and fail.pop() if fail else False:
            raise ValueError("down")
        seen.append((number, rows))

    def run():
        ingest.consume(spark, str(tmp_path / "log"), "envelope_id string, pos int", process, str(tmp_path / "ck"), 2)

    with pytest.raises(Exception, match="down"):
        run()
    run()
    run()
    assert [n for n, _ in seen] == [0, 1] and sorted(x for _, r in seen for x in r) == ["e0", "e1", "e2", "e3"]


def test_parsed_and_normalized_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "e")], "source_id string, name string")
    registry.write_parsed(df, str(tmp_path / "parsed"))
    registry.write_normalized({"event": df, "venue": df.limit(0), "artist": df}, str(tmp_path / "n"))
    assert spark.read.json(str(tmp_path / "parsed")).count() == spark.read.json(str(tmp_path / "n" / "events")).count() == 1
    log = spark.createDataFrame([("e", datetime(2025, 1, 2))], "envelope_id string, accepted_at timestamp")
    registry.write_log(log, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log" / "ingest_date=2025-01-02")).count() == 1

"""The content store and the log by byte offsets: round trips, faults, restarts and rotation."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from stagelight.sources import byte_log, content, registry


def digest(x):
    return hashlib.sha256(x).hexdigest()


def packs_of(folder):
    return sorted(folder.glob("write=*/*.parquet"))


def test_content_round_trip(spark, tmp_path):
    rng = random.Random(1)
    given = [rng.randbytes(rng.randint(0, 300)) for _ in range(300)] + [b"", b"", "é".encode(), rng.randbytes(200_000)]
    store = tmp_path / "cas"
    contents = spark.createDataFrame([(x,) for x in given] + [(None,)], "content binary").repartition(4)
    content.add(contents, str(store), pack=20_000, group=3_000)
    assert {(r["sha256"], bytes(r["content"])) for r in content.read(spark, str(store), read=5_000).collect()} == {(digest(x), x) for x in given}
    before = packs_of(store)
    assert len(before) > 2
    content.add(contents, str(store))  # nothing is new
    assert packs_of(store) == before and len(list((store / "_manifests").iterdir())) == 1
    content.add(contents.unionByName(spark.createDataFrame([(b"new",)], contents.schema)), str(store))
    assert set(before) < set(packs_of(store)) and content.read(spark, str(store)).count() == len(set(given)) + 1
    refs = [content.REFERENCE + digest(x) for x in given[:20]] + [content.REFERENCE + "0" * 64, "bad", None, content.REFERENCE + digest(b"new")]
    lines = spark.createDataFrame(list(enumerate(refs)), "id long, payload_ref string")
    got = {r["id"]: r["content"] and bytes(r["content"]) for r in content.resolved(lines, str(store)).collect()}
    assert got == {i: x or (None if x is None else bytearray()) for i, x in enumerate([*given[:20], None, None, None, b"new"])}
    assert {r["payload_ref"] for r in registry.read_payloads(spark, str(store)).collect()} == {content.REFERENCE + digest(x) for x in [*given, b"new"]}


def test_content_is_pruned_by_digest(spark, tmp_path):
    store = str(tmp_path / "cas")
    content.add(spark.range(4000).select(F.col("id").cast("string").cast("binary").alias("content")), store, pack=20_000, group=2_000)
    wanted = digest(b"77")
    whole = content.ContentReader({"path": store, "read": 1})
    some = content.ContentReader({"path": store, "prefixes": wanted[:3], "read": 1})
    groups = lambda r: sum(len(p.groups) for p in r.partitions())
    assert groups(some) <= 2 < 40 < groups(whole)
    exact = content.ContentReader({"path": store, "read": 1})
    assert list(exact.pushFilters([content.EqualTo(("sha256",), wanted), content.EqualTo(("content",), b"x")])) == [content.EqualTo(("content",), b"x")]
    assert groups(exact) == 1 and [len(b) for p in exact.partitions() for b in exact.read(p)] == [1]
    found = content.read(spark, store).where(F.col("sha256").isin(wanted, digest(b"78"), "none"))
    assert {bytes(r["content"]) for r in found.collect()} == {b"77", b"78"}
    assert content.read(spark, store).where(F.col("sha256").startswith(wanted[:6])).count() == 1
    assert content.read(spark, store).where("sha256 = 'a' and sha256 = 'b'").count() == 0
    assert content.read(spark, str(tmp_path / "none")).count() == 0


def test_an_aborted_write_leaves_nothing(spark, tmp_path):
    store = tmp_path / "cas"
    content.add(spark.createDataFrame([(b"a",)], "content binary"), str(store))
    rows = spark.range(0, 400, numPartitions=4).select(F.when(F.col("id") < 399, F.col("id").cast("string").cast("binary")).otherwise(F.raise_error(F.lit("down"))).alias("content"))
    before = packs_of(store)
    fresh = rows.select(F.sha2("content", 256).alias("sha256"), "content")
    with pytest.raises(Exception, match="down"):
        fresh.write.format("content_store").option("path", str(store)).mode("append").save()
    assert packs_of(store) == before and len(list(store.glob("write=*"))) == 1 and content.read(spark, str(store)).count() == 1
    with pytest.raises(Exception, match="written once"):
        fresh.limit(1).write.format("content_store").option("path", str(store)).mode("overwrite").save()


def test_a_repeated_attempt_counts_once(tmp_path):
    """Two attempts of a task write; the commit keeps the one that is named."""
    import pyarrow as pa

    writer = content.ContentWriter({"path": str(tmp_path)})
    rows = pa.RecordBatch.from_pydict({"sha256": [digest(b"a"), digest(b"b")], "content": [b"a", b"b"]})
    writer.write(iter([rows]))
    kept = writer.write(iter([rows]))
    writer.commit([kept, writer.write(iter([]))])
    assert len(packs_of(tmp_path)) == 1
    reader = content.ContentReader({"path": str(tmp_path)})
    assert [len(b) for p in reader.partitions() for b in reader.read(p)] == [2]


def test_a_writer_holds_a_group_between_batches(tmp_path, monkeypatch):
    """When the next batch comes, no more than a row group is left of those before; at the end memory goes back."""
    import pyarrow as pa

    left, backs = [], []
    monkeypatch.setattr(content, "given_back", lambda: backs.append(1))

    def batches():
        before = pa.total_allocated_bytes()
        for i in range(6):
            yield pa.RecordBatch.from_pydict({"sha256": [f"{i}{j:063d}" for j in range(1000)], "content": [bytes(4000)] * 1000})
            left.append(pa.total_allocated_bytes() - before)

    writer = content.ContentWriter({"path": str(tmp_path), "pack": 100_000_000, "group": 1_500_000})
    done = writer.write(batches())
    assert max(left) < 2_500_000 and len(left) == 6 and backs
    writer.commit([done])
    reader = content.ContentReader({"path": str(tmp_path)})
    assert sum(len(b) for p in reader.partitions() for b in reader.read(p)) == 6000 and len(backs) > 1


def lines_of(df):
    return [(r["file"], r["pos"], r["next"], r["line"]) for r in df.orderBy("file", "pos").collect()]


def test_log_by_ranges(spark, tmp_path):
    rng = random.Random(2)
    log = tmp_path / "log"
    log.mkdir()
    want = []
    for name in ("a.ndjson", "b.ndjson"):
        at, raw = 0, b""
        for i in range(60):
            line = rng.choice([b"", b"  ", json.dumps({"n": i, "t": "é" * rng.randint(0, 30)}, ensure_ascii=False).encode()])
            if line.strip():
                want.append((name, at, at + len(line) + 1, line.decode()))
            raw += line + b"\n"
            at += len(line) + 1
        (log / name).write_bytes(raw)
    (log / "a.ndjson").write_bytes((log / "a.ndjson").read_bytes() + b"{}")  # a closed file may lack its last newline
    at = (log / "a.ndjson").stat().st_size
    want = sorted([*want, ("a.ndjson", at - 2, at, "{}")])
    with (log / "b.ndjson").open("ab") as f:
        f.write(b'{"half')
    (log / "_hidden").write_bytes(b"x\n")
    for chunk in (1, 7, 100, 10**6):
        assert lines_of(byte_log.from_offset(spark, str(log), chunk=chunk)) == want
    later = want[len(want) // 2]
    assert lines_of(byte_log.from_offset(spark, str(log), {"file": later[0], "byte": later[1]}, chunk=9)) == want[len(want) // 2 :]
    assert lines_of(byte_log.from_offset(spark, str(log), lines=5)) == want[:5]
    assert lines_of(byte_log.from_offset(spark, str(log), {"file": "b.ndjson", "byte": 0}, lines=1000)) == [w for w in want if w[0] == "b.ndjson"]
    assert lines_of(byte_log.from_offset(spark, str(tmp_path / "none"))) == [] == lines_of(byte_log.from_offset(spark, str(tmp_path / "none"), lines=3))


def test_consumers(spark, tmp_path):
    log = tmp_path / "ingest.ndjson"
    row = lambda i: json.dumps({"envelope_id": f"e{i}"}) + "\n"
    log.write_text("".join(map(row, range(20))) + "\n")
    a, b = (byte_log.Consumer(str(log), str(tmp_path / "offsets"), n) for n in "ab")
    assert a.status()["lag"] == log.stat().st_size and [json.loads(x[3])["envelope_id"] for x in lines_of(a.read_next(spark, 3))] == ["e0", "e1", "e2"]
    assert a.acknowledge(spark, "e2") and not a.acknowledge(spark, "e1")  # e1 is behind the offset
    assert json.loads(lines_of(a.read_next(spark, 1))[0][3])["envelope_id"] == "e3" and json.loads(lines_of(b.read_next(spark, 1))[0][3])["envelope_id"] == "e0"
    assert a.status()["lag"] == log.stat().st_size - 3 * len(row(1))
    assert not a.acknowledge(spark, "none") and a.offset()["byte"] == 3 * len(row(1))
    log.write_text(row(100))  # rotated: shorter than the offset
    assert a.offset()["byte"] == 0 and a.status()["lag"] == len(row(100)) and len(lines_of(a.read_next(spark, 5))) == 1
    assert a.acknowledge(spark, "e100") and a.status()["lag"] == 0


def test_stream_goes_on_after_restarts_and_rotation(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    seen, fail = [], []

    def process(batch, number):
        rows = [r["line"] for r in batch.orderBy("file", "pos").collect()]
        if fail:
            fail.pop()
            raise ValueError("down")
        seen.append((number, rows))

    def run():
        source = byte_log.stream(spark, str(log), chunk=11, consumer="c", offsets=str(tmp_path / "offsets"))
        source.writeStream.foreachBatch(process).option("checkpointLocation", str(tmp_path / "ck")).trigger(once=True).start().awaitTermination()

    (log / "1.ndjson").write_text("a\nbb\n\nccc\nha")
    run()
    assert seen == [(0, ["a", "bb", "ccc"])]
    with (log / "1.ndjson").open("a") as f:
        f.write("lf\n")
    (log / "2.ndjson").write_text("d" * 30 + "\n")
    fail.append(1)
    with pytest.raises(Exception, match="down"):
        run()
    run()
    assert seen[1:] == [(1, ["half", "d" * 30])]  # the batch that failed is given again
    (log / "2.ndjson").write_text("new\n")  # replaced by a shorter one
    run()
    assert [x for _, rows in seen[2:] for x in rows] == ["new"]
    (log / "2.ndjson").write_text("new\nmore\n")
    run()
    assert [x for _, rows in seen[2:] for x in rows] == ["new", "more"]
    assert byte_log.Consumer(str(log), str(tmp_path / "offsets"), "c").offset()["file"] in ("2.ndjson",)

"""Streams with state against batch operators, with rows out of order, restarts, resets and a bypass."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stagelight.operators import ingest, metrics
from stagelight.streaming import state

START = datetime(2025, 1, 1)
LOG = "envelope_id string, idempotency_key string, accepted_at timestamp, payload_ref string"
SAMPLES = "name string, ts timestamp, value double"


def drip(spark, folder, parts, schema):
    """A folder with a file for each part, in order of time."""
    import time

    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{folder}/{i:03d}")
        time.sleep(0.01)


def run(stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def source(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(folder)


@pytest.mark.parametrize("bypass", [False, True])
def test_tags_are_those_of_the_batch(spark, tmp_path, bypass):
    rng = random.Random(3)
    rows = [(f"e{i:03d}", rng.choice(["a", "b", "c", None]), START + timedelta(seconds=10 * i), f"ref{i}") for i in range(60)]
    mixed = sorted(rows, key=lambda r: r[2] + timedelta(seconds=rng.uniform(0, 100)))  # at most 100 seconds late
    ends = [[(f"z{i}", "end", START + timedelta(hours=1 + i), None)] for i in range(2)]
    folder, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "ck"))
    drip(spark, folder, [mixed[:20], mixed[20:40]], LOG)
    tagged = lambda: state.tag_in_order(source(spark, folder, LOG), "2 minutes", bypass)
    run(tagged(), out, checkpoint)
    drip(spark, f"{folder}/more", [mixed[40:], *ends], LOG)
    run(tagged(), out, checkpoint)  # goes on with its state
    got = {tuple(r) for r in spark.read.parquet(out).where("idempotency_key <> 'end' or idempotency_key is null").collect()}
    want = ingest.tag_duplicates(spark.createDataFrame(rows, LOG), bypass).select("envelope_id", "idempotency_key", "accepted_at", "payload_ref", "dedupe_of")
    assert got == {tuple(r) for r in want.collect()} and len(got) == 60
    if not bypass:
        held = {r["key"][0]: r["value"][0] for r in state.state_of(spark, checkpoint).collect()}
        assert {k: held[k] for k in "abc"} == {r["idempotency_key"]: r["envelope_id"] for r in ingest.dedupe_index(spark.createDataFrame(rows, LOG)).collect()}


def test_gains_are_those_of_the_batch(spark, tmp_path):
    rng = random.Random(4)
    rows, value = [], {"x": 0.0, "y": 5.0}
    for i in range(60):
        name = rng.choice("xy")
        value[name] = 0.5 if rng.random() < 0.15 else value[name] + rng.randint(0, 4)  # now and then a reset
        rows.append((name, START + timedelta(seconds=20 * i), value[name]))
    mixed = sorted(rows, key=lambda r: r[1] + timedelta(seconds=rng.uniform(0, 60)))
    folder, out = str(tmp_path / "log"), str(tmp_path / "out")
    drip(spark, folder, [mixed[:15], mixed[15:30], mixed[30:], [("end", START + timedelta(hours=2), 0.0)], [("end", START + timedelta(hours=3), 0.0)]], SAMPLES)
    run(state.gains_in_order(source(spark, folder, SAMPLES), ["name"], "1 minute"), out, str(tmp_path / "ck"))
    got = spark.read.parquet(out).where("name <> 'end'")
    want = metrics.counter_gains(spark.createDataFrame(rows, SAMPLES), ["name"])
    key = lambda df: sorted(tuple(r) for r in df.select("name", "ts", "value", F.round("gain", 9)).collect())
    assert key(got) == key(want) and len(key(got)) == 60
    rates = lambda g: sorted(tuple(r) for r in metrics.rate_of(g, ["name"]).select("name", "window_start", F.round("rate", 9)).collect())
    assert rates(got) == rates(want)

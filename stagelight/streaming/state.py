"""Streams with keyed state that give what the batch operators give, also when rows come out of order.

Rows of a key are held in its state until the watermark has passed them, and then go out in order of time: a timer for the
key's earliest row fires, gives all rows that are due, and is set for the next. So within `late` of the newest row, arrival does not matter. What is later than that is left out by the
watermark, as in every stream; so is what bears a time of 1970 or before, where watermarks begin. The state of a key is its last word: the first envelope of an idempotency key, the last value
of a counter. It is kept for ever unless `forget_ms` is given; then a key that has not been written for so long is new again.

State lies in RocksDB, so keys and held rows need not fit in memory. `state_of` reads it from a query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stagelight.shipping import ship

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """Holds rows (at, ...) of a key until the watermark is beyond `at`, and gives them to `ready` in order."""

    held_schema: str
    held_columns: list[str]
    state_schema: str

    def __init__(self, forget_ms: int | None = None):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.held_schema)
        self.last = handle.getValueState("last", self.state_schema, self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        least: list[int] = []
        for part in rows:
            part = part[self.held_columns].astype(object).where(part[self.held_columns].notna(), None)
            self.held.appendList(list(part.itertuples(index=False, name=None)))
            least.append(int(part["at"].min()))
        self._wake(min(least))
        return iter(())

    def _wake(self, at: int) -> None:
        """A timer for the earliest row: one a batch, however many rows a key has."""
        self.handle.registerTimer((at // 1_000_000 + 1) * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = timerValues.getCurrentWatermarkInMs() * 1000
        due, rest = [], []
        for r in self.held.get():
            (due if r[0] < until else rest).append(tuple(r))
        if not due:  # another timer has given them
            return
        if rest:
            self.held.put(rest)
            self._wake(min(r[0] for r in rest))
        else:
            self.held.clear()
        yield self.ready(key, sorted(due, key=lambda r: (r[0], str(r[1]))))

    def ready(self, key, due: list[tuple]) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None: ...


class FirstOfKey(InOrder):
    held_schema, held_columns, state_schema = "at long, envelope_id string, payload_ref string", ["at", "envelope_id", "payload_ref"], "envelope_id string"

    def ready(self, key, due: list[tuple]) -> pd.DataFrame:
        first = self.last.get()[0] if self.last.exists() else due[0][1]
        self.last.update((first,))
        again = [i != first for _, i, _ in due]
        return pd.DataFrame({
            "envelope_id": [i for _, i, _ in due], "idempotency_key": [key[0]] * len(due), "at": [at for at, _, _ in due],
            "payload_ref": pd.Series([None if a else p for a, (_, _, p) in zip(again, due, strict=True)], dtype=object), "dedupe_of": pd.Series([first if a else None for a in again], dtype=object),
        })


class Gains(InOrder):
    held_schema, held_columns, state_schema = "at long, value double", ["at", "value"], "value double"

    def __init__(self, keys: list[str], forget_ms: int | None = None):
        super().__init__(forget_ms)
        self.keys = keys

    def ready(self, key, due: list[tuple]) -> pd.DataFrame:
        before, gains = self.last.get()[0] if self.last.exists() else None, []
        for _, value in due:
            gains.append(0.0 if before is None else value if value < before else value - before)
            before = value
        self.last.update((before,))
        return pd.DataFrame({**{k: [v] * len(due) for k, v in zip(self.keys, key, strict=True)}, "at": [at for at, _ in due], "value": [v for _, v in due], "gain": gains})


def _ready(df: DataFrame) -> None:
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def tag_in_order(log: DataFrame, late: str = "10 minutes", bypass: bool = False, forget_ms: int | None = None) -> DataFrame:
    """log (envelope_id, idempotency_key, accepted_at, payload_ref) as a stream -> what `ingest.tag_duplicates` gives of the
    whole log: every envelope, later ones of a key with dedupe_of and without a payload reference. With the bypass, and for
    envelopes without a key, nothing is tagged, held or remembered."""
    rows = log.select("envelope_id", "idempotency_key", "accepted_at", "payload_ref")
    none = F.lit(None).cast("string").alias("dedupe_of")
    if bypass:
        return rows.select("*", none)
    _ready(log)
    timed = rows.where("idempotency_key is not null").withWatermark("accepted_at", late).withColumn("at", F.unix_micros("accepted_at"))
    out = "envelope_id string, idempotency_key string, at long, payload_ref string, dedupe_of string"
    tagged = timed.groupBy("idempotency_key").transformWithStateInPandas(FirstOfKey(forget_ms), out, "append", "eventtime")
    tagged = tagged.select("envelope_id", "idempotency_key", F.timestamp_micros("at").alias("accepted_at"), "payload_ref", "dedupe_of")
    return tagged.unionByName(rows.where("idempotency_key is null").select("*", none))


def gains_in_order(samples: DataFrame, keys: list[str], late: str = "10 minutes", forget_ms: int | None = None) -> DataFrame:
    """samples (keys as text, ts, value) as a stream -> (keys, ts, value, gain), what `metrics.counter_gains` gives of all of
    them: a counter that falls between two micro-batches has been reset. `metrics.rate_of` makes rates of stored gains."""
    _ready(samples)
    timed = samples.select(*keys, "ts", F.col("value").cast("double").alias("value")).withWatermark("ts", late).withColumn("at", F.unix_micros("ts"))
    out = ", ".join([*[f"{k} string" for k in keys], "at long, value double, gain double"])
    found = timed.groupBy(*keys).transformWithStateInPandas(Gains(keys, forget_ms), out, "append", "eventtime")
    return found.select(*keys, F.timestamp_micros("at").alias("ts"), "value", "gain")


def state_of(spark: SparkSession, checkpoint: str, name: str = "last", operator: int = 0) -> DataFrame:
    """What a query's keys hold, by the state data source: (key, value, ...)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).option("stateVarName", name).load()

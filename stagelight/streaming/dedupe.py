"""Duplicate tagging on a stream of envelopes: every envelope goes on, later ones of a key tagged with the first."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "envelope_id string, idempotency_key string, accepted_at timestamp, payload_ref string, dedupe_of string"


def tag_stream(log: DataFrame, forget_after_ms: int | None = None) -> DataFrame:
    """log (envelope_id, idempotency_key, accepted_at, payload_ref). The state of a key is its first envelope's id. It is
    kept for ever, or dropped when the key has not been seen for forget_after_ms, so that it stays bounded. Within a
    micro-batch the earliest accepted is first; limit the files of a trigger to bound what a key brings at once."""

    def tag(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            (first,) = state.get
            parts = batches  # every row repeats the first: batch by batch
        else:
            rows = pd.concat(list(batches), ignore_index=True).sort_values(["accepted_at", "envelope_id"], kind="stable")
            first, parts = rows["envelope_id"].iloc[0], iter([rows])
            state.update((first,))
        if forget_after_ms:
            state.setTimeoutDuration(forget_after_ms)
        for rows in parts:
            again = rows["envelope_id"] != first
            rows["dedupe_of"] = pd.Series([first] * len(rows), index=rows.index, dtype=object).where(again, None)
            rows["payload_ref"] = rows["payload_ref"].where(~again, None)
            yield rows[["envelope_id", "idempotency_key", "accepted_at", "payload_ref", "dedupe_of"]]

    timeout = GroupStateTimeout.ProcessingTimeTimeout if forget_after_ms else GroupStateTimeout.NoTimeout
    rows = log.select("envelope_id", "idempotency_key", "accepted_at", "payload_ref")
    return rows.groupBy("idempotency_key").applyInPandasWithState(tag, OUT, "first string", "append", timeout)


def windowed_rate(samples: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Sum and count per name in sliding five-minute windows of a stream, with late samples up to `late`."""
    from pyspark.sql import functions as F

    return samples.withWatermark("ts", late).groupBy(F.window("ts", "5 minutes", "1 minute").alias("w"), "name").agg(F.count("*").alias("n"), F.sum("value").alias("total"))

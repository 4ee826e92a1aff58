"""Metrics of pipeline phases: what a table held when it was written is counted while it is written, by Spark's observations,
and noted in a table of samples (run, phase, name, kind, le, value, at) that the time series functions read.

A phase is watched by putting its table through `Phases.watch` before it is used; counters count rows that meet a condition,
gauges are numbers of the whole table, histograms count values up to each bound. Nothing is read again for it. A phase whose
table has not run has no samples. Streams are watched likewise; a listener notes each micro-batch as a sample of its own.
"""

from __future__ import annotations

import threading
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from stagelight.operators.metrics import BOUNDS

# The phases of the pipeline.
PHASES = ("sources", "gateway", "ingest_log", "parser", "normalize", "quality_gate", "enrich", "conflation", "catalog")
SAMPLES = "run string, phase string, name string, kind string, le double, value double, at timestamp"


def measures(counters: dict[str, Column], gauges: dict[str, Column], histograms: dict[str, Column], bounds: tuple[float, ...] = BOUNDS) -> list[Column]:
    """Aggregates of one observation; a name carries kind and bound, as name|kind|bound."""
    out = [F.count_if(c).alias(f"{n}|counter|") for n, c in counters.items()]
    out += [c.cast("double").alias(f"{n}|gauge|") for n, c in gauges.items()]
    for n, c in histograms.items():
        out += [F.count_if(c <= b).alias(f"{n}|bucket|{b!r}") for b in bounds]
        out += [F.count(c).alias(f"{n}|bucket|inf"), F.coalesce(F.sum(c.cast("double")), F.lit(0.0)).alias(f"{n}|sum|")]
    return out


def _samples(run: str, phase: str, got: dict[str, object], at: datetime) -> list[tuple]:
    out = []
    for name, value in got.items():
        n, kind, bound = name.rsplit("|", 2)
        if value is not None:
            out.append((run, phase, n, kind, float(bound) if bound else None, float(value), at))
    return out


class Phases:
    """One run's observations."""

    def __init__(self, run: str, bounds: tuple[float, ...] = BOUNDS):
        self.run, self.bounds = run, bounds
        self._open: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, phase: str, counters: dict[str, Column] | None = None, gauges: dict[str, Column] | None = None, histograms: dict[str, Column] | None = None) -> DataFrame:
        """df, whose rows are counted under the phase when it runs; `rows` is always counted."""
        if phase not in PHASES:
            raise ValueError(f"no phase {phase}")
        seen = Observation(f"{self.run}/{phase}/{len(self._open)}")
        self._open.append((phase, seen))
        return df.observe(seen, *measures({"rows": F.lit(True)} | (counters or {}), gauges or {}, histograms or {}, self.bounds))

    def watch_stream(self, df: DataFrame, phase: str, counters: dict[str, Column] | None = None, gauges: dict[str, Column] | None = None, histograms: dict[str, Column] | None = None) -> DataFrame:
        """The same for a stream; its batches are noted by `StreamSamples`."""
        return df.observe(f"{self.run}/{phase}", *measures({"rows": F.lit(True)} | (counters or {}), gauges or {}, histograms or {}, self.bounds))

    def collected(self, spark: SparkSession, at: datetime | None = None) -> DataFrame:
        """(SAMPLES) of what has been watched so far. Every watched table must have run: an observation waits for it."""
        at = at or datetime.now(UTC).replace(tzinfo=None)
        rows = [s for phase, seen in self._open for s in _samples(self.run, phase, seen.get, at)]
        return spark.createDataFrame(rows, SAMPLES)

    def write(self, spark: SparkSession, folder: str, at: datetime | None = None) -> None:
        """Adds the samples to a table, a folder for each phase."""
        self.collected(spark, at).write.mode("append").partitionBy("phase").parquet(folder)


class StreamSamples(StreamingQueryListener):
    """Notes what each micro-batch of watched streams counted; `samples` gives it as a table and forgets it."""

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        at = datetime.fromisoformat(event.progress.timestamp.replace("Z", "+00:00")).astimezone(UTC).replace(tzinfo=None)
        with self._lock:
            for name, row in event.progress.observedMetrics.items():
                run, _, phase = name.rpartition("/")
                if phase in PHASES:
                    self._rows += _samples(run, phase, row.asDict(), at)

    def samples(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows, self._rows = self._rows, []
        return spark.createDataFrame(rows, SAMPLES)


def totals(samples: DataFrame) -> DataFrame:
    """(run, phase, name, kind, le, value): counters, sums and buckets added up, the last of each gauge."""
    last = F.max_by("value", "at")
    return samples.groupBy("run", "phase", "name", "kind", "le").agg(F.when(F.col("kind") == "gauge", last).otherwise(F.sum("value")).alias("value"))

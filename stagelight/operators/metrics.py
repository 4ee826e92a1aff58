"""Time series of counters, gauges and histograms: samples (ts, name, labels, value) and questions over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Upper bounds of histogram buckets.
BOUNDS = (0.1, 0.5, 1.0, 2.5, 5.0, 10.0)


def counter_gains(samples: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ts, value, gain): how much a counter rose since the sample before; a fall is a reset and counts from zero, the
    first sample gives nothing. Samples are dealt by hour, and each hour begins with the last sample before it, so a key with
    very many samples is no single task."""
    hour = F.date_trunc("hour", F.col("ts"))
    rows = samples.select(*keys, "ts", "value", hour.alias("_hour"))
    lasts = rows.groupBy(*keys, "_hour").agg(F.max_by("value", "ts").alias("value"))  # a row for each hour of a key
    hours = Window.partitionBy(*keys).orderBy("_hour")
    carried = lasts.select(*keys, F.lead("_hour").over(hours).alias("_hour"), "value").where("_hour is not null").withColumn("ts", F.lit(None).cast("timestamp"))
    order = Window.partitionBy(*keys, "_hour").orderBy("ts")  # a null time sorts first
    before = F.lag("value").over(order)
    up = rows.unionByName(carried).withColumn("_before", before).where("ts is not null")
    before = F.col("_before")
    gain = F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    return up.select(*keys, "ts", "value", gain.alias("gain"))


def rate_of(gains: DataFrame, keys: list[str], width: str = "5 minutes", slide: str = "1 minute", per: float = 60.0) -> DataFrame:
    """Gains per `per` seconds in sliding windows."""
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    totals = gains.groupBy(*keys, F.window("ts", width, slide).alias("w")).agg(F.sum("gain").alias("gain"))
    return totals.select(*keys, F.col("w.start").alias("window_start"), (F.col("gain") * per / seconds).alias("rate"))


def counter_rate(samples: DataFrame, keys: list[str], width: str = "5 minutes", slide: str = "1 minute", per: float = 60.0) -> DataFrame:
    """Increase of a counter per `per` seconds in sliding windows."""
    return rate_of(counter_gains(samples, keys), keys, width, slide, per)


def buckets(samples: DataFrame, keys: list[str], bounds: tuple[float, ...] = BOUNDS) -> DataFrame:
    """(keys, le, n): cumulative counts of values up to each bound and in all."""
    counts = samples.groupBy(*keys).agg(*[F.count_if(F.col("value") <= b).alias(f"b{i}") for i, b in enumerate(bounds)], F.count("value").alias("all"))
    pairs = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)], F.struct(F.lit(float("inf")).alias("le"), F.col("all").alias("n")))
    return counts.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.le", "p.n")


def quantile(histogram: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Linear interpolation within the first bucket that reaches the share; in the last, its lower bound."""
    order = Window.partitionBy(*keys).orderBy("le")
    rows = histogram.withColumn("low", F.coalesce(F.lag("le").over(order), F.lit(0.0))).withColumn("under", F.coalesce(F.lag("n").over(order), F.lit(0)))
    rows = rows.withColumn("rank", q * F.max("n").over(Window.partitionBy(*keys))).where("n >= rank and n > 0")
    first = rows.withColumn("i", F.row_number().over(order)).where("i = 1")
    inside = F.col("low") + (F.col("le") - F.col("low")) * (F.col("rank") - F.col("under")) / F.nullif(F.col("n") - F.col("under"), F.lit(0))
    return first.select(*keys, F.when(F.col("le") == float("inf"), F.col("low")).otherwise(inside).alias("quantile"))


def bucket_counters(samples: DataFrame, keys: list[str], bounds: tuple[float, ...] = BOUNDS, every: str = "minute") -> DataFrame:
    """(keys, le, ts, value): how many values up to each bound there have been by the end of each `every`, as a server counts
    them. Samples are aggregated by key and time first; only these sums are added up in order."""
    each = buckets(samples.withColumn("ts", F.date_trunc(every, F.col("ts"))), [*keys, "ts"], bounds)
    so_far = Window.partitionBy(*keys, "le").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return each.select(*keys, "le", "ts", F.sum("n").over(so_far).cast("double").alias("value"))


def rate_quantiles(counters: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.5, 0.95, 0.99), width: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """counters (keys, more labels, le, ts, value) -> (keys, window_start, share, quantile): quantiles of what came in within
    each window, from the rates of bucket counters summed over other labels than keys and le. A counter's fall is a reset.
    Windows in which nothing came in have no quantile."""
    labels = [c for c in counters.columns if c not in ("ts", "value")]
    rates = counter_rate(counters, labels, width, slide, per=1.0)
    by_bound = rates.groupBy(*keys, "window_start", "le").agg(F.sum("rate").alias("n"))
    each = by_bound.withColumn("share", F.explode(F.array(*[F.lit(float(q)) for q in shares])))
    order = Window.partitionBy(*keys, "window_start", "share").orderBy("le")
    rows = each.withColumn("low", F.coalesce(F.lag("le").over(order), F.lit(0.0))).withColumn("under", F.coalesce(F.lag("n").over(order), F.lit(0.0)))
    all_of = Window.partitionBy(*keys, "window_start", "share")  # a row for each bound
    rows = rows.withColumn("rank", F.col("share") * F.max("n").over(all_of)).where("n >= rank * (1 - 1e-12) and n > 0").withColumn("i", F.row_number().over(order)).where("i = 1")
    inside = F.col("low") + (F.col("le") - F.col("low")) * (F.col("rank") - F.col("under")) / F.nullif(F.col("n") - F.col("under"), F.lit(0.0))
    return rows.select(*keys, "window_start", "share", F.when(F.col("le") == float("inf"), F.col("low")).otherwise(inside).alias("quantile"))


#: Size of a sketch: a quantile's rank is off by about 1.7 / SKETCH of all values at most, with 99 % confidence
SKETCH = 400


def value_sketches(samples: DataFrame, keys: list[str], size: int = SKETCH) -> DataFrame:
    """(keys, sketch, n): KLL sketches of values, which `merged_sketches` puts together over any of the keys. Nulls and NaN do
    not count."""
    value = F.when(~F.isnan(F.col("value").cast("double")), F.col("value").cast("double"))
    return samples.groupBy(*keys).agg(F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch"), F.count(value).alias("n"))


def merged_sketches(sketches: DataFrame, keys: list[str], size: int = SKETCH) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"), F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """(keys, share, quantile) of sketches that hold any value."""
    found = F.array(*[F.struct(F.lit(float(q)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("quantile")) for q in shares])
    return sketches.where("n > 0").select(*keys, F.explode(found).alias("q")).select(*keys, "q.share", "q.quantile")


def freshness(samples: DataFrame, keys: list[str], as_of) -> DataFrame:
    """Seconds since each key's last sample."""
    return samples.groupBy(*keys).agg((F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.max("ts"))).alias("age_seconds"))


def carry_forward(df: DataFrame, keys: list[str], order: str, header: str) -> DataFrame:
    """Adds `carried`: the last header that is not null up to each row."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("carried", F.last(header, ignorenulls=True).over(w))


def observed(df: DataFrame, phase: str) -> DataFrame:
    """df with its row count observed under the phase's name, for query listeners."""
    return df.observe(phase, F.count(F.lit(1)).alias("rows"))

"""Stored tables that merges rewrite in part: rows lie in hash partitions of their key, and a merge reads the partitions that
its own keys fall into and writes those in which a row is new, changed or deleted; the files of all others stay.

Partitions are replaced by Spark's dynamic partition overwrite, whole or not at all. Deleted partitions that end up empty are
removed after that. One merge goes on at a time. Keys are compared as they are; a null key is one key. Rows of proposals with
equal keys are one row: the last by the given order, else the smallest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stagelight.lineage import cut, exists, remove
from stagelight.operators.catalog import field_changes

BUCKETS = 64


class MergedTable:
    """A table of a folder that Spark reads and writes, with a schema and key columns."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: list[str], buckets: int = BUCKETS, keep: tuple[str, ...] = ()):
        """keep: columns that a stored row does not change, such as created_at."""
        self.spark, self.folder, self.schema, self.keys, self.buckets, self.keep = spark, folder, schema, keys, buckets, keep
        self.columns = spark.createDataFrame([], schema).columns
        self.fields = tuple(c for c in self.columns if c not in (*keys, *keep))

    def read(self) -> DataFrame:
        return self._stored().drop("bucket")

    def _stored(self) -> DataFrame:
        schema = f"{self.schema}, bucket int"
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.folder)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _touched(self, rows: DataFrame) -> tuple[list[int], DataFrame]:
        buckets = [r[0] for r in rows.select("bucket").distinct().collect()]  # no more than the table has
        return buckets, self._stored().where(F.col("bucket").isin(buckets))

    def upsert(self, proposed: DataFrame, order: str | None = None) -> dict[str, int]:
        """Writes proposed rows over stored ones; how many rows were new, changed and the same, and partitions written."""
        rows = self._dealt(proposed.select(*self.columns, *([order] if order and order not in self.columns else [])))
        last = Window.partitionBy(*self.keys).orderBy(*([F.desc(order)] if order else []), *self.fields, *self.keep)
        rows = cut(rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").select(*self.columns, "bucket"))
        _, stored = self._touched(rows)
        o, n = stored.withColumn("_there", F.lit(True)).alias("o"), rows.withColumn("_there", F.lit(True)).alias("n")
        both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys], "full")
        old, new = F.col("o._there").isNotNull(), F.col("n._there").isNotNull()
        kind = F.when(~new, "other").when(~old, "new").when(F.size(field_changes("o", "n", self.fields)) > 0, "changed").otherwise("same")
        held = lambda c: F.when(old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")) if c in (*self.keep, *self.keys) else F.when(new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
        merged = cut(both.select(*[held(c).alias(c) for c in self.columns], F.coalesce("o.bucket", "n.bucket").alias("bucket"), kind.alias("_kind")))
        counts = {r["_kind"]: r["count"] for r in merged.groupBy("_kind").count().collect()}
        dirty = [r[0] for r in merged.where("_kind in ('new', 'changed')").select("bucket").distinct().collect()]
        self._replace(merged.drop("_kind"), dirty)
        return {k: counts.get(k, 0) for k in ("new", "changed", "same")} | {"partitions": len(dirty)}

    def delete(self, gone: DataFrame) -> int:
        """Removes rows with the keys of gone; how many there were."""
        rows = cut(self._dealt(gone.select(*self.keys).distinct()))
        buckets, stored = self._touched(rows)
        o, g = stored.alias("o"), rows.withColumn("_gone", F.lit(True)).alias("g")
        marked = cut(o.join(g, [F.col(f"o.{k}").eqNullSafe(F.col(f"g.{k}")) for k in self.keys], "left").select("o.*", "_gone"))
        found = {r["bucket"]: (r["n"], r["kept"]) for r in marked.groupBy("bucket").agg(F.count_if("_gone").alias("n"), F.count_if(F.col("_gone").isNull()).alias("kept")).collect()}
        self._replace(marked.where("_gone is null").drop("_gone"), [b for b, (n, kept) in found.items() if n and kept])
        for b, (n, kept) in found.items():
            if n and not kept:
                remove(self.spark, f"{self.folder}/bucket={b}")
        return sum(n for n, _ in found.values())

    def _replace(self, rows: DataFrame, buckets: list[int]) -> None:
        if buckets:
            some = rows.where(F.col("bucket").isin(buckets)).repartition("bucket")
            some.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.folder)


def upsert_graph(nodes: MergedTable, edges: MergedTable, new_nodes: DataFrame, new_edges: DataFrame) -> dict[str, dict[str, int]]:
    """Nodes first, so that an edge never stands without its ends."""
    return {"nodes": nodes.upsert(new_nodes), "edges": edges.upsert(new_edges)}

"""Content store: contents by their SHA-256, written once, read by reference.

Layout. `write=<id>/<attempt>-<n>.parquet` hold (sha256, content), sorted by digest, a task's contents in packs of about
PACK bytes; `_manifests/<id>.json` names a write's packs with their first and last digest and their sizes. A pack counts
only if a manifest names it. Tasks write packs; the commit writes the manifest in one move, and removes packs that no
message names, such as those of an attempt that was repeated; an abort removes the write's packs. So a reader sees a write
whole or not at all, and an aborted one leaves nothing.

Reading. Digests are never computed again. Contents are range-partitioned before they are written, so a pack spans few
digests: filters on sha256 (=, IN, prefix) that Spark pushes down leave the packs out that cannot hold them, and within a
pack the row groups. A join by reference reads the packs that the prefixes of its references fall into, by the `prefixes`
option: at most 16^PREFIX of them. Large packs are cut into partitions by row groups.

The folder is on any file system that Arrow opens by URI (local, HDFS, S3, ...). One write goes on at a time: contents that
two writes add at once are stored twice, and a reference then finds both, equal, copies. Null contents are not stored; the
empty content is one. An empty store has no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage

from stagelight.shipping import ship
from stagelight.sources.files import given_back, listed, opened, replaced

REFERENCE = "cas:sha256:"
SCHEMA = "sha256 string, content binary"
#: Bytes of a pack, of one of its row groups, and of a partition that reads it
PACK, GROUP, READ = 256 << 20, 8 << 20, 64 << 20
#: Hex digits by which a join's references are looked up
PREFIX = 3
_ARROW = pa.schema([("sha256", pa.string()), ("content", pa.binary())])


@dataclass
class Packs(WriterCommitMessage):
    packs: list[dict]


class ContentWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.write_id = options["path"], uuid.uuid4().hex
        self.pack, self.group = int(options.get("pack", PACK)), int(options.get("group", GROUP))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Packs:
        files, root = opened(self.path)
        attempt, done = uuid.uuid4().hex, []
        files.create_dir(f"{root}/write={self.write_id}")
        held: list[pa.RecordBatch] = []
        pack: dict | None = None
        out = None

        def group() -> None:
            """What is held becomes a row group of the open pack, or of a new one."""
            nonlocal pack, out, held
            rows = pa.Table.from_batches(held).cast(_ARROW)
            held = []
            if pack is None:
                pack = {"path": f"write={self.write_id}/{attempt}-{len(done)}.parquet", "first": rows["sha256"][0].as_py(), "groups": []}
                out = pq.ParquetWriter(f"{root}/{pack['path']}", _ARROW, compression="zstd", filesystem=files)
            out.write_table(rows, row_group_size=len(rows))
            pack["groups"].append({"last": rows["sha256"][-1].as_py(), "bytes": rows.nbytes})
            if sum(g["bytes"] for g in pack["groups"]) >= self.pack:
                close()

        def close() -> None:
            nonlocal pack, out
            out.close()
            done.append(pack)
            pack = out = None

        size = 0
        for batch in iterator:
            per_row = batch.nbytes // max(1, batch.num_rows) + 1
            step = max(1, self.group // per_row)
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                held.append(pa.concat_batches([some, some.slice(0, 0)]))  # a copy: a slice would hold its whole batch
                size += held[-1].nbytes
                if size >= self.group:
                    group()
                    size = 0
            batch = some = None  # the next one comes when this one has gone, but for what is held
        if held and sum(map(len, held)):
            group()
        if pack is not None:
            close()
        held = []
        given_back()
        return Packs(done)

    def commit(self, messages: list[Packs | None]) -> None:
        files, root = opened(self.path)
        packs = [p for m in messages if m for p in m.packs]
        named = {f"{root}/{p['path']}" for p in packs}
        for old in listed(files, f"{root}/write={self.write_id}"):
            if old.path not in named:
                files.delete_file(old.path)
        if packs:
            files.create_dir(f"{root}/_manifests")
            replaced(files, f"{root}/_manifests/{self.write_id}.json", json.dumps(packs).encode())
        else:
            self.abort(messages)

    def abort(self, messages: list[Packs | None]) -> None:
        files, root = opened(self.path)
        files.create_dir(f"{root}/write={self.write_id}")
        files.delete_dir(f"{root}/write={self.write_id}")


class Groups(InputPartition):
    """Some row groups of a pack."""

    def __init__(self, path: str, groups: list[int]):
        super().__init__(path)
        self.path, self.groups = path, groups


class ContentReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.read_bytes = options["path"], int(options.get("read", READ))
        #: Ranges of digests that are wanted, [low, high]; None is all
        self.ranges: list[tuple[str, str]] | None = None
        self.exact: set[str] | None = None
        if "prefixes" in options:
            self._narrow([(p, p + "g") for p in options["prefixes"].split(",") if p])  # g comes after every hex digit

    def _narrow(self, ranges: list[tuple[str, str]]) -> None:
        ours = self.ranges
        self.ranges = ranges if ours is None else [(max(a, c), min(b, d)) for a, b in ours for c, d in ranges if max(a, c) <= min(b, d)]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("sha256",):
                self._wanted({f.value})
            elif isinstance(f, In) and f.attribute == ("sha256",):
                self._wanted(set(f.value))
            elif isinstance(f, StringStartsWith) and f.attribute == ("sha256",):
                self._narrow([(f.value, f.value + "g")])
                yield f
            else:
                yield f

    def _wanted(self, digests: set) -> None:
        digests = {d for d in digests if d is not None}
        self.exact = digests if self.exact is None else self.exact & digests
        self._narrow([(d, d) for d in sorted(digests)])

    def _may_hold(self, first: str, last: str) -> bool:
        return self.ranges is None or any(low <= last and first <= high for low, high in self.ranges)

    def partitions(self) -> list[InputPartition]:
        files, root = opened(self.path)
        out: list[InputPartition] = []
        for manifest in listed(files, f"{root}/_manifests"):
            with files.open_input_stream(manifest.path) as f:
                packs = json.loads(f.read())
            for pack in packs:
                first, run, size = pack["first"], [], 0
                for i, g in enumerate(pack["groups"]):
                    if self._may_hold(first, g["last"]):
                        run.append(i)
                        size += g["bytes"]
                    if run and size >= self.read_bytes:
                        out.append(Groups(pack["path"], run))
                        run, size = [], 0
                    first = g["last"]
                if run:
                    out.append(Groups(pack["path"], run))
        return out

    def read(self, partition: Groups | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a store without packs
            return
        files, root = opened(self.path)
        with pq.ParquetFile(f"{root}/{partition.path}", filesystem=files) as pack:
            for i in partition.groups:
                rows = pack.read_row_group(i)
                if self.exact is not None:
                    rows = rows.filter(pa.compute.is_in(rows["sha256"], pa.array(sorted(self.exact), pa.string())))
                yield from rows.to_batches()
                rows = None  # before the next is read
        given_back()


class ContentStore(DataSource):
    """Options: path; for reading prefixes (of digests, separated by commas); for writing pack and group, their bytes."""

    @classmethod
    def name(cls) -> str:
        return "content_store"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ContentReader:
        return ContentReader(self.options)

    def writer(self, schema, overwrite: bool) -> ContentWriter:
        if overwrite:
            raise ValueError("contents are written once; a store is only added to")
        return ContentWriter(self.options)


def read(spark: SparkSession, folder: str, **options: str | int) -> DataFrame:
    """(sha256, content) of a store. Conditions on sha256 reach the packs."""
    ship(spark)
    spark.dataSource.register(ContentStore)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("content_store").option("path", folder).options(**options).load()


def add(contents: DataFrame, folder: str, **options: str | int) -> None:
    """Adds contents (content) that the store lacks, each once. Digests alone are compared with those of the store, and only
    with packs that they fall into; contents are then dealt by ranges of digests."""
    spark = contents.sparkSession
    rows = contents.where("content is not null").select(F.sha2(F.col("content").cast("binary"), 256).alias("sha256"), F.col("content").cast("binary").alias("content"))
    stored = read(spark, folder).select(F.col("sha256").alias("stored"))
    # each task's copies become one before they are dealt by digest, which the join then goes by too
    fresh = rows.dropDuplicates(["sha256"]).join(stored, F.col("sha256") == F.col("stored"), "left_anti")
    dealt = fresh.repartitionByRange("sha256").sortWithinPartitions("sha256")
    dealt.write.format("content_store").option("path", folder).options(**options).mode("append").save()


def resolved(lines: DataFrame, folder: str, reference: str = "payload_ref") -> DataFrame:
    """lines with the content that their reference names, null where the store has none. Only packs are read that prefixes of
    the references fall into."""
    digest = F.when(F.col(reference).startswith(REFERENCE), F.substring(reference, len(REFERENCE) + 1, 64))
    prefixes = [r[0] for r in lines.select(F.substring(digest, 1, PREFIX).alias("p")).where("p rlike '^[0-9a-f]+$'").distinct().collect()]  # 16^PREFIX at most
    found = read(lines.sparkSession, folder, prefixes=",".join(sorted(prefixes)))
    return lines.join(found.select(F.concat(F.lit(REFERENCE), "sha256").alias("_ref"), "content"), F.col(reference) == F.col("_ref"), "left").drop("_ref")

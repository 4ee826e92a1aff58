"""The ingest log by byte offsets: lines of NDJSON files, read as a stream or from a consumer's offset.

A log is a file, or a folder of files that come in the order of their names, of which the last one may grow. An offset is
(file, byte): all files before it, and that file up to the byte, have been read. Lines end at a newline; a last line without
one is left for later in the last file, as it may still be written, and is a line in the others. Blank lines are passed
over. A file that is shorter than the offset in it has been replaced: it is read from its beginning.

Streams read (file, byte range) partitions of CHUNK bytes on executors; a line belongs to the range that it begins in.
Nothing reads the log before the offset, nor counts its lines.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from stagelight.shipping import ship
from stagelight.sources.files import listed, opened, replaced

SCHEMA = "file string, pos bigint, next bigint, line string"
CHUNK, TAIL, ROWS = 64 << 20, 1 << 16, 10_000
START = {"file": "", "byte": 0}
_ARROW = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("next", pa.int64()), ("line", pa.string())])


class Span(InputPartition):
    """Lines of a file that begin in [begin, end); open: the last one may go without a newline; at most `lines` of them."""

    def __init__(self, file: str, begin: int, end: int, lines: int | None = None):
        super().__init__((file, begin, end))
        self.file, self.begin, self.end, self.lines = file, begin, end, lines


class Log:
    """The files of a log, as they are now."""

    def __init__(self, path: str, chunk: int = CHUNK):
        self.path, self.chunk = path, chunk
        self.files, root = opened(path)
        info = self.files.get_file_info(root)
        whole = [info] if info.is_file else listed(self.files, root)
        self.root = root.rpartition("/")[0] if info.is_file else root
        self.sizes = {f.base_name: f.size for f in whole}

    def full(self, name: str) -> str:
        return f"{self.root}/{name}"

    def end(self) -> dict:
        """After the last whole line of the last file."""
        if not self.sizes:
            return dict(START)
        last = max(self.sizes)
        return {"file": last, "byte": self._after_newline(last, self.sizes[last])}

    def _after_newline(self, name: str, at: int) -> int:
        """The place after the last newline before `at`, looked for backwards."""
        with self.files.open_input_file(self.full(name)) as f:
            while at > 0:
                begin = max(0, at - TAIL)
                f.seek(begin)
                found = f.read(at - begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                at = begin
        return 0

    def ranges(self, start: dict, end: dict) -> Iterator[tuple[str, int, int]]:
        """(file, begin, end) of what lies between two offsets."""
        for name, size in sorted(self.sizes.items()):
            if start["file"] <= name <= end["file"]:
                stop = min(end["byte"], size) if name == end["file"] else size
                begin = start["byte"] if name == start["file"] else 0
                yield name, 0 if begin > size else begin, stop

    def spans(self, start: dict, end: dict) -> list[Span]:
        return [Span(name, a, min(a + self.chunk, stop)) for name, begin, stop in self.ranges(start, end) for a in range(begin, stop, self.chunk)]

    def behind(self, offset: dict) -> int:
        """Bytes of whole lines after an offset."""
        return sum(b - a for _, a, b in self.ranges(offset, self.end()))

    def lines(self, span: Span) -> Iterator[tuple[str, int, int, str]]:
        with io.BufferedReader(self.files.open_input_file(self.full(span.file)), 1 << 20) as f:
            at = span.begin
            if at:  # a line that began before belongs to the range before
                f.seek(at - 1)
                at = at - 1 + len(f.readline())
            f.seek(at)
            left = span.lines
            while at < span.end and left != 0:
                raw = f.readline()
                if not raw:
                    return
                if raw.strip():
                    yield span.file, at, at + len(raw), raw.rstrip(b"\n").decode("utf-8", "replace")
                    left = None if left is None else left - 1
                at += len(raw)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), _ARROW, strict=True)], schema=_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), _ARROW, strict=True)], schema=_ARROW)


class LogStream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.chunk, self.consumer = options["path"], int(options.get("chunk", CHUNK)), options.get("consumer")
        self.offsets = options.get("offsets")

    def initialOffset(self) -> dict:
        return dict(START)

    def latestOffset(self) -> dict:
        return Log(self.path, self.chunk).end()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return Log(self.path, self.chunk).spans(start, end)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _batches(Log(self.path, self.chunk).lines(partition))

    def commit(self, end: dict) -> None:
        if self.consumer and self.offsets:
            Consumer(self.path, self.offsets, self.consumer).save(end)


class LogBatch(DataSourceReader):
    """From an offset on; with `lines` no more than so many, which one task reads in order and stops."""

    def __init__(self, options: dict):
        self.path, self.chunk, self.start = options["path"], int(options.get("chunk", CHUNK)), json.loads(options.get("start", json.dumps(START)))
        self.most = int(options["lines"]) if "lines" in options else None

    def partitions(self) -> list[InputPartition]:
        log = Log(self.path, self.chunk)
        if self.most is None:
            return log.spans(self.start, log.end())
        return [InputPartition([Span(*r) for r in log.ranges(self.start, log.end())])]

    def read(self, partition: Span | InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return iter(())
        log = Log(self.path, self.chunk)
        if isinstance(partition, Span):
            return _batches(log.lines(partition))

        def first() -> Iterator[tuple]:
            left = self.most
            for s in partition.value:
                for row in log.lines(Span(s.file, s.begin, s.end, left)):
                    yield row
                    left -= 1
                if left <= 0:
                    return

        return _batches(first())


class ByteLog(DataSource):
    """Options: path; chunk, the bytes of a partition; for batches start (an offset as JSON) and lines; for streams consumer and
    offsets (a folder), where what has been read is noted after each batch."""

    @classmethod
    def name(cls) -> str:
        return "byte_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogBatch:
        return LogBatch(self.options)

    def streamReader(self, schema) -> LogStream:
        return LogStream(self.options)


class Consumer:
    """A consumer's offset, a file of its own beside those of others. It is read and written on the driver: a few bytes."""

    def __init__(self, path: str, offsets: str, name: str):
        self.path, self.name = path, name
        self.files, root = opened(offsets)
        self.folder, self.at = root, f"{root}/{name}.json"

    def offset(self) -> dict:
        """As saved; the beginning of a file that has been replaced by a shorter one."""
        if not self.files.get_file_info(self.at).is_file:
            return dict(START)
        with self.files.open_input_stream(self.at) as f:
            saved = json.loads(f.read())
        if saved["byte"] > Log(self.path).sizes.get(saved["file"], saved["byte"]):
            saved["byte"] = 0
        return saved

    def save(self, offset: dict) -> None:
        self.files.create_dir(self.folder)
        replaced(self.files, self.at, json.dumps(offset).encode())

    def status(self) -> dict:
        """offset, end, and how many bytes of whole lines are between them."""
        log, offset = Log(self.path), self.offset()
        return {"offset": offset, "end": log.end(), "lag": log.behind(offset)}

    def read_next(self, spark: SparkSession, lines: int) -> DataFrame:
        """The next lines after the offset; only these are read."""
        return from_offset(spark, self.path, self.offset(), lines)

    def acknowledge(self, spark: SparkSession, envelope_id: str) -> bool:
        """Moves the offset behind the first line after it that has this envelope_id; stays if there is none."""
        rows = from_offset(spark, self.path, self.offset()).where(F.get_json_object("line", "$.envelope_id") == envelope_id)
        found = rows.agg(F.min(F.struct("file", "next")).alias("at")).head()["at"]
        if found is not None:
            self.save({"file": found["file"], "byte": found["next"]})
        return found is not None


def _source(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(ByteLog)


def from_offset(spark: SparkSession, path: str, offset: dict | None = None, lines: int | None = None, **options: str | int) -> DataFrame:
    """(file, pos, next, line) from an offset on."""
    _source(spark)
    reader = spark.read.format("byte_log").option("path", path).option("start", json.dumps(offset or START)).options(**options)
    return (reader if lines is None else reader.option("lines", lines)).load()


def stream(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """The log as a stream; where it goes on is in the query's checkpoint."""
    _source(spark)
    return spark.readStream.format("byte_log").option("path", path).options(**options).load()

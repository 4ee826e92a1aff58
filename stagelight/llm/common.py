"""Shared pieces: lineage cuts, document numbering and vectorised word hashing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagelight.shipping import ship

#: Stands for a null doc_id where a key is needed; sorts before every other id.
NULL_KEY = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. One of our own is set only in one process without one, as in tests: on a
    cluster, a folder of one machine would not do."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stagelight-"))
    return folder or context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Stored:
    """A wide intermediate table as compressed Parquet in the shared folder, until drop()."""

    def __init__(self, df: DataFrame):
        self.spark = spark = df.sparkSession
        self.path = f"{_shared_folder(spark)}/stored-{uuid.uuid4().hex}"
        try:
            df.write.option("compression", "zstd").parquet(self.path)
        except BaseException:
            self.drop()
            raise
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def key(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(NULL_KEY).cast("long"))


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so extra columns with clashing names do no harm."""
    return df.select(*[df[n] for n in names])


def with_fields(df: DataFrame, **kinds: str) -> T.StructType:
    """df's schema and more columns; the schema that df holds stays as it is."""
    return T.StructType([*df.schema.fields, *[T.StructField(n, T._parse_datatype_string(k)) for n, k in kinds.items()]])


def fresh(columns: list[str], name: str) -> str:
    """name, with underscores before it until no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


# Vectorised word hashing over bytes. A word is a run of bytes other than space and 0x09-0x0D.

_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: ASCII letters, digits and all bytes of other characters stand in words; the rest separates
_NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SEGMENT = 1 << 20
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        def table_of(base: int) -> np.ndarray:
            out = np.full(max(n, SEGMENT + 4096), base, np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        _powers[:] = [table_of(_P), table_of(pow(_P, -1, 1 << 64))]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of x reaches every bit of the result."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _segments(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(buf):
        end = min(len(buf), at + SEGMENT)
        while end < len(buf):
            spaces = np.flatnonzero(_SPACE[buf[end : end + 4096]])
            if len(spaces):
                end += int(spaces[0])
                break
            end = min(len(buf), end + 4096)
        yield at, end
        at = end


class Words:
    """Words of a list of texts: start, end, document, hash; hashes come from whole words, bounded memory a step."""

    def __init__(self, texts: list[str | None], prefixes: tuple[int, ...] = (), letters: bool = False):
        raw = [((t or "").lower() if letters else t or "").encode("utf-8", "surrogatepass") for t in texts]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        buf = _LOWER[np.frombuffer(b"\n".join(raw), np.uint8)] if raw else np.zeros(0, np.uint8)
        starts, ends, hashes = [], [], []
        cut_hashes: list[list[np.ndarray]] = [[] for _ in prefixes]
        for a, b in _segments(buf):
            seg = buf[a:b]
            space = (_NOT_WORD if letters else _SPACE)[seg]
            edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
            s, e = edge[::2], edge[1::2]
            power, inverse = _power_tables(len(seg) + 1)
            with np.errstate(over="ignore"):
                total = np.concatenate(([np.uint64(0)], np.cumsum((seg.astype(np.uint64) + np.uint64(1)) * power[: len(seg)], dtype=np.uint64)))
                hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)))
                for k, out in zip(prefixes, cut_hashes, strict=True):
                    stop = np.minimum(s + k, e)
                    h = mix((total[stop] - total[s]) * inverse[s] + np.uint64(1_000_003 * k))
                    out.append(np.where(e - s >= k, h, np.uint64(0)))
            starts.append(s + a)
            ends.append(e + a)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.starts, self.ends, self.hashes = join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)
        self.prefix = [join(x, np.uint64) for x in cut_hashes]
        offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
        #: bounds[d]:bounds[d + 1] are the words of document d
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.bounds) - 1


_K = [np.uint64(x | 1) for x in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25, 0xA0761D6478BD642F)]


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; with fewer words than width, the whole sequence is one."""
    words = Words(texts)
    h, out = words.hashes, []
    with np.errstate(over="ignore"):
        n = max(0, len(h) - width + 1)
        rolled = np.zeros(n, np.uint64)
        for j in range(width):
            rolled += h[j : j + n] * _K[j % 5] + np.uint64(j)
        rolled = mix(rolled)
        for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            if b - a >= width:
                out.append(np.unique(rolled[a : b - width + 1]))
            elif b > a:
                short = np.uint64(b - a)
                for j in range(a, b):
                    short = short + h[j] * _K[(j - a) % 5] + np.uint64(j - a)
                out.append(mix(np.array([short ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def text_steps(texts: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, int, list[str | None]]]:
    """Runs of a column of texts with about `most` bytes each, as lists; a longer text is a run of its own."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(texts):
        before = int(size[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + most, "right")))
        yield at, end, texts.slice(at, end - at).to_pylist()
        at = end


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which a task's worker gives what it no longer holds back to the system: workers live on for other tasks,
    and an executor's memory is that of all of them."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every system's library has it
            if trim is not None:
                trim(0)

    return wrapped


def steps(texts: list[str | None], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts with about `most` characters each; a longer text is a run of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t or "") + 1
        if i > at and size + n > most:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)

"""Near duplicates by 64-bit SimHash: segment popcounts, a grid range-join under Manhattan distance, exact verification.

Fingerprint. Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased; shingles of `width` words, repeats
included, are joined by a space (fewer words: the whole sequence; none: fingerprint zero). A bit is 1 if XXH64 (seed 42)
sets it in over half of the shingles.

Embedding. A fingerprint is cut into 32 segments of two bits; the counts of their set bits are a point of whole numbers. A
differing bit moves one count by one at most, so the Manhattan distance of two points is a lower bound of the Hamming
distance of their fingerprints.

Grid join. Segments are dealt to g groups, 2 * g > radius. Within `radius` of each other in all, two points are within 1
of each other in some group. A group's counts are a cell of its grid: every fingerprint is at home in one cell a group, and
visits the cells one step up, so two points that are one step apart meet in the upper one's home cell. Only pairs with one
at home there are compared, by their exact Hamming distance.

Cells. A task reads its cells in order, and gives each cell's links as a spanning forest, never as all pairs: links within
a cell of n members are fewer than n for large cells. Cells that hold or are visited by more than TILE members are cut:
members are dealt to parts by hash, and each pair of parts is a tile of its own, so no task holds a whole hot cell, and
every pair meets in some tile. Links go to `components`.

Nulls: a null text counts as the empty text; rows with a null doc_id take part and carry the component of their text, and
an id counts only if there is one: a component without ids has a null component_id. Repeated rows each stay. Equal
fingerprints are one point, however many rows hold them. Very long texts are hashed by pieces of PIECE bytes, whole. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import cut, only
from stagelight.llm.components import components

SEED, WIDTH, RADIUS = 42, 3, 3
SEGMENTS = 32
#: Members of a cell beyond which it is cut into tiles; runs up to SMALL are compared together
TILE, SMALL = 4096, 16
#: Bytes of a text that are cut into words at a time
PIECE = 1 << 20
#: Cut cells that may go out by broadcast; more are joined by a shuffle
BROADCAST = 100_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text, those of about PIECE bytes at a time."""
    at = 0
    while at < len(raw):
        space = _SPACE.search(raw, at + PIECE)
        end = space.start() if space else len(raw)
        yield raw[at:end].translate(_LOWER).split()
        at = end


def _digests(words: list[bytes], width: int) -> bytes:
    """XXH64 of each shingle, eight bytes each, highest first."""
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    return b"".join([digest(whole[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)])


def fingerprint(raw: bytes | None, width: int = WIDTH) -> int:
    """The fingerprint as a signed number."""
    votes, n, rest = np.zeros(64, np.int64), 0, []
    for words in _pieces(raw or b""):
        rest += words
        if len(rest) >= width:
            bits = np.unpackbits(np.frombuffer(_digests(rest, width), np.uint8).reshape(-1, 8), axis=1)
            votes += bits.sum(0, dtype=np.int64)
            n += len(bits)
            rest = rest[len(rest) - width + 1 :]
    if n == 0 and rest:
        votes, n = np.unpackbits(np.frombuffer(xxhash.xxh64_digest(b" ".join(rest), SEED), np.uint8)).astype(np.int64), 1
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), signed=True)


def fingerprints(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.fromiter((fingerprint(t.as_py(), width) for t in b.column(1)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints)], names=["doc_id", "fp"])

    rows = only(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# Counts are packed two bits each: 0, 1 or 2. Fields outside a cell's group hold 3, which is no count.
_ODD = 0x5555555555555555


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def homes(fp: Column | str, radius: int) -> Column:
    """The home cell of a fingerprint in each group."""
    x = F.col(fp) if isinstance(fp, str) else fp
    low, odd = F.shiftrightunsigned(x, 1), F.lit(_ODD)
    counts = F.shiftleft(x.bitwiseAND(low).bitwiseAND(odd), 1).bitwiseOR(x.bitwiseXOR(low).bitwiseAND(odd))
    groups = radius // 2 + 1
    cuts = [2 * round(i * SEGMENTS / groups) for i in range(groups + 1)]
    inside = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return F.array(*[counts.bitwiseAND(F.lit(_signed(m))).bitwiseOR(F.lit(_signed(~m & (1 << 64) - 1))) for m in inside])


def above(cell: str) -> str:
    """SQL text: the cells one step up from a cell."""
    field = f"(shiftrightunsigned({cell}, 2 * i) & 3L)"
    steps = f"filter(sequence(0, {SEGMENTS - 1}), i -> {field} < 2L)"
    return f"transform({steps}, i -> {cell} ^ shiftleft(if({field} = 0L, 1L, 3L), 2 * i))"


def _cut_cells(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """(cell, parts): cells that are cut. A cell with over `tile` members has that many at home, or half of them come from
    below cells with tile / (2 * SEGMENTS) at home or more, so only such cells are looked at. Nothing is at home where
    parts is 0."""
    held = prints.select(F.explode(homes("fp", radius)).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    held = cut(held.where(F.col("n") >= max(1, tile // (2 * SEGMENTS))))
    if held.isEmpty():
        return held.select("cell", F.lit(0).alias("parts"))
    seen = held.select("cell", "n").unionByName(held.select(F.explode(F.expr(above("cell"))).alias("cell"), "n")).groupBy("cell").agg(F.sum("n").alias("n"))
    large = seen.where(F.col("n") > tile // 2)
    inhabited = prints.select(F.explode(homes("fp", radius)).alias("cell")).join(large, "cell", "left_semi").distinct().withColumn("there", F.lit(1))
    return cut(large.join(inhabited, "cell", "left").select("cell", F.when(F.col("there").isNull(), 0).otherwise(F.ceil(2 * F.col("n") / tile)).cast("int").alias("parts")))


def members(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(cell, tile, home, fp): who is where; members of one (cell, tile) are compared."""
    rows = prints.select("fp", F.explode(homes("fp", radius)).alias("own")).select("fp", "own", F.explode(F.expr(f"concat(array(own), {above('own')})")).alias("cell"))
    rows = rows.select("cell", (F.col("cell") == F.col("own")).alias("home"), "fp")
    large = _cut_cells(prints, radius, tile)
    n = large.count()
    if n == 0:
        return rows.withColumn("tile", F.lit(0).cast("long"))
    rows = rows.join(large.hint("broadcast") if n <= BROADCAST else large, "cell", "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - F.lit(1).cast("long")), lambda j: F.least(part, j) * F.col("parts") + F.greatest(part, j))
    tiles = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).when(F.col("parts") > 0, pairs)
    return rows.select("cell", "home", "fp", F.explode(tiles).alias("tile"))


def forest(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of unsigned points that connect what is connected within the radius, one less than the points of each component."""
    u: list[np.ndarray] = [points[:0]]
    v: list[np.ndarray] = [points[:0]]
    left = points
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                front.extend(found)
                u.append(np.full(len(found), x))
                v.append(found)
    return np.concatenate(u), np.concatenate(v)


def _links(radius: int):
    """Links of members that come sorted by (cell, tile)."""

    def of(cell: np.ndarray, tile: np.ndarray, home: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (tile[1:] != tile[:-1]), [True])))
        size = np.diff(first)
        run = np.repeat(np.arange(len(size)), size)
        fp = fp.view(np.uint64)  # bits of signed numbers are counted without their sign
        u: list[np.ndarray] = [fp[:0]]
        v: list[np.ndarray] = [fp[:0]]
        for i in np.flatnonzero(size > SMALL):
            rows = slice(first[i], first[i + 1])
            if home[rows].any():
                a, b = forest(fp[rows], radius)
                u.append(a)
                v.append(b)
        small = size[run] <= SMALL
        fp, home, run = fp[small], home[small], run[small]
        for s in range(1, SMALL):
            at = np.flatnonzero(run[s:] == run[:-s])
            if not len(at):
                break
            near = (np.bitwise_count(fp[at] ^ fp[at + s]) <= radius) & (home[at] | home[at + s])
            u.append(fp[at[near]])
            v.append(fp[at[near] + s])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (u, v)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for b in batches:
            rows = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows, strict=True)]
            if not len(rows[0]):
                continue
            open_from = len(rows[0]) - int(np.argmin(((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]))[::-1])) if (rows[0][0], rows[1][0]) != (rows[0][-1], rows[1][-1]) else 0
            rest = [x[open_from:] for x in rows]
            if open_from:
                yield of(*[x[:open_from] for x in rows])
        if rest is not None:
            yield of(*rest)

    return run


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """prints (fp), distinct -> (u, v): pairs within the radius that connect all that is connected by such pairs."""
    rows = members(prints, radius, tile).select("cell", "tile", "home", "fp")
    return rows.repartition("cell", "tile").sortWithinPartitions("cell", "tile").mapInArrow(_links(radius), "u long, v long")


def near_duplicates(documents: DataFrame, width: int = WIDTH, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest id reachable by links."""
    rows = cut(fingerprints(documents, width))
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(prints.select("fp"), radius, tile))
    named = cut(prints.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.select("fp", "root").join(groups, "root").select(F.col("fp").alias("print"), "component_id")
    return rows.join(labels, F.col("fp") == F.col("print")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

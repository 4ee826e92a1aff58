"""Best-fit decreasing packing of token sequences.

Lengths are whole numbers up to the capacity, so the corpus is described in full by how many pieces have each length.
The driver packs that histogram (at most `capacity` counts, whatever the corpus size): lengths go in descending order,
a segment tree over remaining capacities finds the tightest open bins in logarithmic time, and bins of equal remaining
capacity are filled together. This is best-fit decreasing over all pieces at once. Its result is a short list of runs
("pieces of this length with these ranks go to these bins"), which executors apply to ranked pieces; ranks are counted
within (length, salt), so a length that a third of all pieces share is spread over many tasks.

Nulls: a null text counts as the empty text (its one piece holds the closing id alone); a null doc_id is an id like any
other. Repeated rows are packed as often as they occur; pieces of equal length take ranks in the order of id, piece, digest
and start within their salt, ties in any order. A very long text is encoded whole, in about 30 bytes a character of memory,
and cut into pieces. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stagelight.llm.common import cut, only, steps

CAPACITY = 1024
END_ID = 2

# The published byte-level scheme that the vocabulary file names as its pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the rest
    for letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in plain):
        letters[chr(256 + i)] = b
    return letters


class Encoder:
    """Ids of whole texts, as the tokenizers library gives them for a byte-level BPE file, as little-endian bytes.

    If the file's merges are in id order, the faster library that takes ranks gives the same ids.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        pre = spec["pre_tokenizer"]
        in_order = all(vocab[a + b] == 256 + i for i, (a, b) in enumerate(merges)) and spec["normalizer"] is None and pre["type"] == "ByteLevel" and not pre["add_prefix_space"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if in_order:
            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
            fast = tiktoken.Encoding("from_file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.whole = lambda text: fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
        else:
            slow = Tokenizer.from_file(path)
            self.whole = lambda text: b"".join(i.to_bytes(4, "little") for i in slow.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        return self.whole(text) if text else b""


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document's ids and the closing id; only longer documents are cut, and then the first
    piece is the one that may be shorter."""
    end = end_id.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in steps(texts, 8_000_000):
                rows: list[list] = [[], [], [], [], []]
                for doc_id, text in zip(ids[a:b], texts[a:b], strict=True):
                    data = memoryview(code(text or "") + end)
                    n = len(data) // 4
                    start, stop = 0, n % capacity or capacity
                    for piece in range(-(-n // capacity)):
                        for column, value in zip(rows, (doc_id, piece, start, stop - start, zlib.crc32(data[4 * start : 4 * stop])), strict=True):
                            column.append(value)
                        start, stop = stop, stop + capacity
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return only(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES)


class Capacities:
    """Segment tree over remaining capacities: which have open bins; the smallest one of at least a size."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = [False] * (2 * self.size)

    def set(self, at: int, open_: bool) -> None:
        at += self.size
        self.tree[at] = open_
        while at > 1:
            at //= 2
            self.tree[at] = self.tree[2 * at] or self.tree[2 * at + 1]

    def at_least(self, least: int) -> int | None:
        at = least + self.size
        if self.tree[at]:
            return least
        while at > 1:  # up until a right sibling has one, then down its left edge
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Runs (length, first rank, end rank, first bin, pieces a bin, offset) and the number of bins, as best-fit
    decreasing over the single pieces packs them."""
    open_bins: dict[int, list[tuple[int, int]]] = {}
    tree, runs, bins = Capacities(capacity), [], 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            open_bins.setdefault(left, []).append((first, n))
            tree.set(left, True)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        rank, todo = 0, counts[length]
        while todo:
            room = tree.at_least(length)
            if room is None:
                room, first, n = capacity, bins, -(-todo // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    tree.set(room, False)
            each = room // length
            full = min(n, todo // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - room))
                put(room - each * length, first, full)
                rank, todo = rank + full * each, todo - full * each
            first, n = first + full, n - full
            if todo and n:  # fewer are left than one bin takes
                runs.append((length, rank, rank + todo, first, todo, capacity - room))
                put(room - todo * length, first, 1)
                first, n, todo = first + 1, n - 1, 0
            put(room, first, n)
    return runs, bins


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """parts as from pieces(); adds sequence_id and offset. Pieces of full capacity get sequences of their own with
    negative numbers. Ranks are within (length, salt), so that no length goes to one task."""
    spark = parts.sparkSession
    names = [*parts.columns, "sequence_id", "offset"]
    salts = max(16, min(512, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # the salt is of the row's place, not of what it holds: any number of equal pieces is dealt evenly
    parts = cut(parts.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")))
    full = parts.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    rest = parts.where(F.col("length") < capacity)
    counted = rest.groupBy("length", "salt").count().collect()  # at most capacity * salts rows
    counts: dict[int, int] = {}
    before = []
    for r in sorted(counted):
        before.append((r["length"], r["salt"], counts.get(r["length"], 0)))
        counts[r["length"]] = counts.get(r["length"], 0) + r["count"]
    runs, _ = best_fit(counts, capacity)
    offsets = spark.createDataFrame(before, "length long, salt int, before long")
    places = spark.createDataFrame(runs, "length long, r0 long, r1 long, bin long, each long, at long")
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = rest.withColumn("n", F.row_number().over(own)).join(offsets, ["length", "salt"]).withColumn("rank", F.col("n") - 1 + F.col("before"))
    # runs are a few for each length whatever the corpus, so they go out whole; should a large capacity make very many of
    # them, they are joined as any table is, with the same result
    placed = ranked.join(F.broadcast(places) if len(runs) < 100_000 else places, "length").where("rank >= r0 and rank < r1")
    placed = placed.withColumn("sequence_id", F.expr("bin + (rank - r0) div each")).withColumn("offset", F.expr("at + (rank - r0) % each * length"))
    return placed.select(*names).unionByName(full.select(*names))


def packed(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(pieces(documents, path, capacity, end_id), capacity)

"""N-gram Jaccard self-join: connected documents whose word-shingle sets reach a Jaccard similarity.

1. Each text gives the sorted distinct hashes of its shingles. Equal sets are one class from here on, so exact copies
   cost one row each and make no pairs.
2. Blocking, without loss. Two linked sets of sizes s <= l differ in at most d = s * (1 - t) / t elements. Hash space is
   cut into m = d + 1 + e segments; each class gives one signature a segment, in size bands that decide d. Linked sets
   agree in m - d of m signatures, so by the T-occurrence bound they share one of their d + 1 rarest. A class with more
   than d signatures of its own links with nothing; of the rest, classes that share one of the d + 1 rarest are chained
   and the chains joined up to candidate components. Common passages fill the e frequent signatures, which are not used.
3. T-occurrence search (DivideSkip) in each candidate component, in one task of bounded size: an inverted list for each
   shingle; a query's short lists are merged over a heap that skips what cannot reach T - L, and documents that occur
   T - L times in them are probed in its L long lists by binary search. A list with more than half of the block is long
   without a choice and kept by who is not in it, which is counted: in a block of near copies that is some ten thousand
   entries a query instead of millions of probes. The first query is the median set of the largest group; documents
   connected to it need no search of their own, as whoever else links with them finds them.
4. A component with more shingles than BLOCK is compared with its median set first, in as many tasks as it takes. The sets
   linked with that are one group and need no comparing among each other; only pairs of parts of which one holds sets
   outside of the group are blocks of their own. So a large group of near copies costs what its outsiders cost.
5. Links become components again.

Rows are known by (doc_id, hash of the text) between the two readings of the texts, so ids never merge rows; between tasks
go hashes of shingles, not texts, so a long repetitive text is as small as its set.

Results per row: n_shingles and component_id, the smallest doc_id reachable by links. Null or word-less texts have no
shingles, link with nothing and keep their own id. Rows with equal ids each stay; a null doc_id counts as larger than all
others and names a component only if it has no other id. Very long texts are hashed in bounded steps and count whole.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagelight.llm.common import NULL_KEY, Stored, cut, key, mix, only, shingle_sets, steps, text_steps, tidy
from stagelight.llm.components import components

#: Shingles that a block may hold: about 80 MB of hashes and lists
BLOCK = 2_000_000


class Bands:
    """Size bands for a similarity t, each with d, the elements that linked sets may differ in: a set takes part in the
    band of every size that it may link with as the larger one."""

    def __init__(self, threshold: Fraction, ratio: float = 1.5):
        self.t = threshold
        self.apart = (1 - threshold) / threshold
        self.ends = [0]
        while self.ends[-1] < 2**40:
            self.ends.append(max(self.ends[-1] + 1, int(self.ends[-1] * ratio)))
        self.ends_array = np.array(self.ends)

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.ends_array, size))

    def of(self, size: int) -> list[int]:
        """d of each band of a set; bands where only equal sets could link are left out."""
        least = -int(-(size * self.t) // 1)
        return [d for b in range(self.band(least), self.band(size) + 1) if (d := int(self.ends[b] * self.apart))]

    def signatures(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """For each band d and one 64-bit signature a segment."""
        if bands := self.of(len(hashes)):
            with np.errstate(over="ignore"):
                total = np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes), dtype=np.uint64)))
                for d in bands:
                    m = segments(d)
                    edges = np.array([(i << 64) // m for i in range(1, m)], np.uint64)
                    at = np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)]))
                    sums = total[at[1:]] - total[at[:-1]]
                    yield d, mix(sums + mix(np.arange(m, dtype=np.uint64) * np.uint64(2**40) + np.uint64(d)))


def segments(d: int) -> int:
    return d + 2 + d // 4


def set_hash(hashes: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))], np.uint64)).view(np.int64)[0])


def sketches(documents: DataFrame, width: int, bands: Bands) -> DataFrame:
    """(k, x, n, h, d, more, sigs): of each row its key and text hash, size and hash of its set and its signatures in a
    band; a row with `more` is a further band of the row before. h is null for a set without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks = [batch.column(i).to_pylist() for i in (0, 1)]
            for a, b, texts in text_steps(batch.column(2)):
                rows: list[tuple] = []
                sigs = []
                for k, x, s in zip(keys[a:b], marks[a:b], shingle_sets(texts, width), strict=True):
                    h = set_hash(s) if len(s) else None
                    for i, (d, sig) in enumerate(list(bands.signatures(s)) or [(0, np.zeros(0, np.uint64))]):
                        rows.append((k, x, len(s), h, d, i > 0))
                        sigs.append(sig)
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in sigs]))).astype(np.int32)
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (*[pa.int64()] * 5, pa.bool_()), strict=True)]
                flat = np.concatenate(sigs).view(np.int64)
                yield pa.RecordBatch.from_arrays([*arrays, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["k", "x", "n", "h", "d", "more", "sigs"])

    return documents.select("k", "x", "text").mapInArrow(tidy(run), "k long, x long, n long, h long, d long, more boolean, sigs array<long>")


#: Signatures of more classes than this count as equally frequent
OFTEN = 1_000


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (sig, h, d) sorted by sig: the rows of signatures that more than one row has, and how many. The first
    and last signature of a task may go on in others: their rows come with n = 0, and the row counts as rows without h."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def rows(sig: np.ndarray, h: np.ndarray, d: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(h), pa.array(d), pa.array(n)], names=["sig", "h", "d", "n"])

    def edge(sig: int, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sig], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([n], pa.int64())], names=["sig", "h", "d", "n"])

    before = None
    at_edge, now, count = True, None, 0  # the group that is open: held rows, or rows already sent as those of an edge
    for batch in batches:
        sig, h, d = (c.to_numpy() for c in batch.columns)
        fresh = np.concatenate(([len(sig) > 0 and (int(sig[0]), int(h[0])) != before], (sig[1:] != sig[:-1]) | (h[1:] != h[:-1])))[: len(sig)]
        sig, h, d = sig[fresh], h[fresh], d[fresh]  # copies of a text come once
        if not len(sig):
            continue
        before = (int(sig[-1]), int(h[-1]))
        if now is None:
            now = int(sig[0])
        starts = np.concatenate(([0], np.flatnonzero(sig[1:] != sig[:-1]) + 1))
        head = len(sig) if len(starts) == 1 else int(starts[1])
        if int(sig[0]) != now:  # the open group ended with the batch before
            head = 0
        # rows of the open group
        if head:
            count += head
            if at_edge or count > OFTEN:
                for x in held:
                    yield rows(*x, np.full(len(x[0]), 0 if at_edge else OFTEN))
                held.clear()
                yield rows(sig[:head], h[:head], d[:head], np.full(head, 0 if at_edge else OFTEN))
            else:
                held.append((sig[:head], h[:head], d[:head]))
        if head == len(sig):
            continue
        # the open group is complete
        if at_edge:
            yield edge(now, count)
            at_edge = False
        elif held and count > 1:
            for x in held:
                yield rows(*x, np.full(len(x[0]), min(count, OFTEN)))
        held.clear()
        # whole groups inside the batch, then the last, which stays open
        starts = starts[starts >= head]
        last = int(starts[-1])
        sizes = np.diff(np.concatenate((starts, [len(sig)])))
        n = np.repeat(np.minimum(sizes, OFTEN), sizes)[: last - head]
        keep = np.flatnonzero(n > 1) + head
        if len(keep):
            yield rows(sig[keep], h[keep], d[keep], n[keep - head])
        now, count = int(sig[last]), len(sig) - last
        held.append((sig[last:], h[last:], d[last:]))
    if now is not None:
        for x in held:
            yield rows(*x, np.zeros(len(x[0]), np.int64))
        yield edge(now, count)


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (sig, h): edges between members of a signature, as stars around the first that this task
    sees, and the first member of the task's first and last signature, which other tasks may go on with."""
    first_sig = sig_now = head = None
    ends: list[tuple[int, int]] = []
    for batch in batches:
        sig, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(sig):
            continue
        new = np.concatenate(([True], sig[1:] != sig[:-1]))
        if sig_now is not None and sig[0] == sig_now:
            new[0] = False
        at = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        heads = np.where(at >= 0, h[np.maximum(at, 0)], head if head is not None else 0)
        if first_sig is None:
            first_sig = int(sig[0])
            ends.append((first_sig, int(h[0])))
        sig_now, head = int(sig[-1]), int(heads[-1])
        linked = heads != h
        if linked.any():
            pairs = np.unique(np.stack([h[linked], heads[linked]], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["sig", "u", "v"])
    if sig_now is not None and sig_now != first_sig:
        ends.append((sig_now, head))
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in ends], pa.int64()), pa.array([h for _, h in ends], pa.int64()), pa.nulls(len(ends), pa.int64())], names=["sig", "u", "v"])


def rarest(classes: DataFrame, done: Callable[[], None] = lambda: None) -> DataFrame:
    """(h, d, sigs) -> (sig, h): of each class that may link, the shared ones among its d + 1 rarest signatures. done is
    called when the classes are no longer read."""
    signed = classes.select(F.explode("sigs").alias("sig"), "h", "d")
    sorted_ = signed.repartitionByRange(F.col("sig"), F.col("h")).sortWithinPartitions("sig", "h")
    stored = Stored(sorted_.mapInArrow(tidy(_shared), "sig long, h long, d long, n long"))
    done()
    found = stored.df
    # signatures at the edges of tasks: two a task, so few that they go to every task, and a frequent one is not dealt out
    edges = found.where("h is null").groupBy("sig").agg(F.least(F.sum("n"), F.lit(OFTEN)).alias("total")).withColumnRenamed("sig", "s")
    rows = found.where("h is not null and n > 0").unionByName(found.where("h is not null and n = 0").join(F.broadcast(edges), F.col("sig") == F.col("s")).where("total > 1").select("sig", "h", "d", F.col("total").alias("n")))
    each = Window.partitionBy("h", "d")
    own = rows.withColumn("shared", F.count("*").over(each)).withColumn("r", F.row_number().over(each.orderBy("n", "sig")))
    # of m = d + 2 + d div 4 signatures, m - shared are the class's own and come first
    chosen = cut(own.where("r <= d + 1 - (d + 2 + d div 4 - shared)").select("sig", "h"))
    stored.drop()
    return chosen


def candidate_edges(classes: DataFrame, done: Callable[[], None] = lambda: None) -> DataFrame:
    """(h, d, sigs) -> edges (u, v) that connect all classes sharing a rare signature, as many as members at most."""
    sorted_ = rarest(classes, done).repartitionByRange(F.col("sig"), F.col("h")).sortWithinPartitions("sig", "h")
    found = cut(sorted_.mapInArrow(_chains, "sig long, u long, v long"))
    ends = found.where("sig is not null")  # two rows a task at most
    across = ends.select(F.col("u"), F.min("u").over(Window.partitionBy("sig")).alias("v")).where("u <> v")
    return found.where("sig is null").select("u", "v").unionByName(across)


class Block:
    """T-occurrence search over the sets of one block. Sets of one group are known to be connected."""

    def __init__(self, sets: list[np.ndarray], threshold: Fraction, groups: list[int] | None = None):
        self.sets, self.t = sets, threshold
        self.size = np.array([len(s) for s in sets], np.int64)
        #: union-find; the root is the smallest member
        self.parent = list(range(len(sets)))
        first: dict[int, int] = {}
        self.members: dict[int, int] = {}
        for i, g in enumerate(groups or range(len(sets))):
            self.join(i, first.setdefault(g, i))
            self.members[first[g]] = self.members.get(first[g], 0) + 1
        self.index()

    def root(self, i: int) -> int:
        up = self.parent
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)

    def needed(self, n: int, m: np.ndarray | int) -> np.ndarray | int:
        """Smallest overlap o of sizes n and m with o >= t * (n + m - o)."""
        p, q = self.t.numerator, self.t.denominator
        return -(-(p * (n + m)) // (p + q))

    def run(self) -> list[int]:
        """The root of each set."""
        k = len(self.sets)
        most = max(self.members, key=lambda r: (self.members[r], -r))
        group = [i for i in range(k) if self.members[most] == 1 or self.root(i) == most]
        pivot = group[int(np.argsort(self.size[group], kind="stable")[len(group) // 2])]
        self.search(pivot)
        for i in range(k):
            if self.root(i) != self.root(pivot):
                self.search(i)
        return [self.root(i) for i in range(k)]

    def index(self) -> None:
        """Inverted lists, one after the other, and each set's lists. Of a list with more than half of the sets, those that
        are not in it are kept too."""
        k = len(self.sets)
        tokens, lists = np.unique(np.concatenate(self.sets), return_inverse=True)
        #: list and member of every entry as one sorted number, so that many lists are probed by one binary search
        self.entries = np.sort(lists * k + np.repeat(np.arange(k), self.size))
        self.first = np.searchsorted(self.entries, np.arange(len(tokens) + 1) * k)
        self.lists = np.split(lists, np.cumsum(self.size)[:-1])
        self.absent: dict[int, np.ndarray] = {}
        for x in np.flatnonzero(np.diff(self.first) * 2 > k).tolist() if k > 2 else ():
            lacks = np.ones(k, bool)
            lacks[self.postings(x)] = False
            self.absent[x] = np.flatnonzero(lacks)

    def postings(self, x: int) -> np.ndarray:
        return self.entries[self.first[x] : self.first[x + 1]] - x * len(self.sets)

    def search(self, q: int) -> None:
        """Joins q with all sets that link with it."""
        n, k, own = int(self.size[q]), len(self.sets), self.root(q)
        # the smallest size in the block that may link with q, besides q's own
        fits = (self.size >= -int(-(n * self.t) // 1)) & (least_of(self.size, self.t) <= n)
        fits[q] = False
        if not fits.any():
            return
        t = int(self.needed(n, int(self.size[fits].min())))
        lists = [x for x in self.lists[q].tolist() if x not in self.absent]
        dense = [x for x in self.lists[q].tolist() if x in self.absent]
        length = self.first[np.array(lists, np.int64) + 1] - self.first[lists] if lists else np.zeros(0, np.int64)
        if len(dense) + (length > 1).sum() < t:  # the other lists hold q alone
            return
        in_dense = len(dense) - (np.bincount(np.concatenate([self.absent[x] for x in dense]), minlength=k) if dense else np.zeros(k, np.int64))
        if t > len(dense):
            at, held = self.divided(np.array(lists)[np.argsort(-length, kind="stable")], np.sort(length)[::-1], t - len(dense), fits, in_dense, n)
        else:  # dense lists alone can reach the overlap, so whoever lacks few of them counts
            held = in_dense + (np.bincount(np.concatenate([self.postings(x) for x in lists]), minlength=k) if lists else 0)
            at = np.flatnonzero(fits & (held >= t))
            held = held[at]
        for i in at[held >= self.needed(n, self.size[at])].tolist():
            if self.root(i) != own:
                self.join(q, i)
                own = self.root(q)

    def divided(self, lists: np.ndarray, length: np.ndarray, t: int, fits: np.ndarray, besides: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """DivideSkip over lists of falling length: members of t of them at least, and in how many they are in all with
        what they have besides; members that cannot link are left out on the way."""
        long_ = divide(length, t)
        found, times = merge_skip([self.postings(x).tolist() for x in lists[long_:].tolist()], t - long_)
        at = np.array(found, np.int64)
        held, need = np.array(times, np.int64) + besides[at], self.needed(n, self.size[at])
        keep = fits[at] & (held + long_ >= need)
        at, held, need = at[keep], held[keep], need[keep]
        done = 0
        while done < long_ and len(at):
            some = lists[done : done + max(16, min(done, (1 << 20) // len(at)))][: long_ - done]
            wanted = (some[:, None] * len(self.sets) + at).ravel()
            place = np.minimum(np.searchsorted(self.entries, wanted), len(self.entries) - 1)
            held = held + (self.entries[place] == wanted).reshape(len(some), len(at)).sum(0)
            done += len(some)
            left = held + long_ - done >= need
            at, held, need = at[left], held[left], need[left]
        return at, held


def least_of(size: np.ndarray, t: Fraction) -> np.ndarray:
    return -(-(size * t.numerator) // t.denominator)


#: What a heap step costs next to a binary probe
HEAP_COST = 20


def divide(length: np.ndarray, t: int) -> int:
    """How many of a query's lists, sorted by falling length, are long: T - 1 at most, since whoever is in T lists in all
    must be in T - L of the short ones. The heap merges all short entries, and at most entries / (T - L) documents are
    probed in L lists."""
    short = length.sum() - np.concatenate(([0], np.cumsum(length)))[:t]
    long_ = np.arange(len(short))
    return int(np.argmin(short * HEAP_COST + short / (t - long_) * long_))


def merge_skip(lists: list[list[int]], least: int) -> tuple[list[int], list[int]]:
    """Members of at least `least` of the sorted lists, and in how many each is. A heap holds the head of every list; if
    its smallest member is in too few, so many lists jump to what is then on top as make sure that nothing is missed."""
    heap = [(x[0], i) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    at = [0] * len(lists)
    found: list[int] = []
    times: list[int] = []
    while len(heap) >= least and heap:
        top = heap[0][0]
        popped = []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            found.append(top)
            times.append(len(popped))
            to = top + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            to = heap[0][0]
        for i in popped:
            at[i] = bisect_left(lists[i], to, at[i])
            if at[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][at[i]], i))
    return found, times


def _hashed(width: int):
    """Rows (root, total, h, text) -> (root, total, h, hashes), each class once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            roots, totals, classes = (batch.column(i).to_pylist() for i in range(3))
            fresh_ = [i for i, h in enumerate(classes) if not (h in seen or seen.add(h))]
            texts = [batch.column(3)[i].as_py() for i in fresh_]
            for a, b in steps(texts):
                sets = shingle_sets(texts[a:b], width)
                rows = fresh_[a:b]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
                hashes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*[pa.array([c[i] for i in rows], pa.int64()) for c in (roots, totals, classes)], hashes], names=["root", "total", "h", "hashes"])

    return run


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    """Copies of the lists of a column of hashes."""
    flat = column.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(np.concatenate(([0], column.value_lengths().to_numpy())))
    return [flat[a:b].copy() for a, b in zip(ends[:-1], ends[1:], strict=True)]


LINKS = "u long, v long"


def _links(us: list[int], vs: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def _solve(threshold: Fraction):
    """Rows (block, h, g, hashes) sorted by block -> (u, v): each class and the root of its component in the block. g is the
    known group of a class."""

    def solve(rows: dict[int, tuple[int, np.ndarray]]) -> tuple[list[int], list[int]]:
        if len(rows) < 2:
            return [], []
        owners = list(rows)
        roots = Block([s for _, s in rows.values()], threshold, [g for g, _ in rows.values()]).run()
        out = [(owners[i], owners[r]) for i, r in enumerate(roots) if i != r]
        return [u for u, _ in out], [v for _, v in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, {}
        for batch in batches:
            us: list[int] = []
            vs: list[int] = []
            for block, h, g, s in zip(*[batch.column(i).to_pylist() for i in range(3)], _arrays(batch.column(3)), strict=True):
                if block != now:
                    u, v = solve(rows)
                    us += u
                    vs += v
                    now, rows = block, {}
                rows.setdefault(h, (g, s))
            if us:
                yield _links(us, vs)
        yield _links(*solve(rows))

    return run


def _against(threshold: Fraction):
    """Rows (h, hashes, pivot, theirs) -> (u, v): the classes that link with their component's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us: list[int] = []
            vs: list[int] = []
            for h, own, pivot, theirs in zip(batch.column(0).to_pylist(), _arrays(batch.column(1)), batch.column(2).to_pylist(), _arrays(batch.column(3)), strict=True):
                both = len(np.intersect1d(own, theirs, assume_unique=True))
                if h != pivot and both * threshold.denominator >= threshold.numerator * (len(own) + len(theirs) - both):
                    us.append(h)
                    vs.append(pivot)
            yield _links(us, vs)

    return run


#: Tasks that a large component's comparison with its pivot is spread over at least
SALTS = 64


def large_blocks(large: DataFrame, sizes: DataFrame, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """Sets (root, total, h, hashes) of components that exceed BLOCK and (root, pivot) -> links (u, v) with pivots, and rows
    (block, h, g, hashes) of the blocks that are left to search."""
    salt = F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int")
    chosen = large.join(sizes, "root").where("h = pivot").dropDuplicates(["root"]).select("root", "pivot", F.col("hashes").alias("theirs"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = large.withColumn("salt", salt).join(chosen, ["root", "salt"]).select("h", "hashes", "pivot", "theirs")
    linked = cut(met.mapInArrow(_against(threshold), LINKS))
    named = large.join(sizes, "root").join(linked.withColumnRenamed("u", "h"), "h", "left")
    named = named.withColumn("out", F.col("v").isNull() & (F.col("h") != F.col("pivot"))).withColumn("g", F.when(F.col("out"), F.col("h")).otherwise(F.col("pivot")))
    parts = lambda c: F.ceil(F.sum(F.when(c, F.size("hashes")).otherwise(0)) / (BLOCK / 2)).cast("int")
    counted = named.groupBy("root").agg(parts(F.col("out")).alias("outs"), parts(~F.col("out")).alias("ins"))
    rows = named.select("root", "h", "g", "out", "hashes").join(counted, "root").where("outs > 0")
    part = F.when(F.col("out"), F.pmod(F.xxhash64("h"), F.col("outs"))).otherwise(F.col("outs") + F.pmod(F.xxhash64("h"), F.col("ins"))).cast("int")
    pair = lambda i: F.xxhash64("root", F.least(i, F.col("part")), F.greatest(i, F.col("part")))
    others = F.sequence(F.lit(0), F.when(F.col("out"), F.col("outs") + F.col("ins")).otherwise(F.col("outs")) - 1)
    dealt = F.transform(F.filter(others, lambda i: (i != F.col("part")) | (F.col("outs") + F.col("ins") == 1)), pair)
    return linked, rows.withColumn("part", part).select(F.explode(dealt).alias("block"), "h", "g", "hashes")


def linked_classes(docs: DataFrame, width: int, threshold: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs (k, x, text) -> rows (k, x, n, h), classes (h, n, k, x) with the first row of each, and (node, root): each
    class that is linked with another, and one class that stands for its component."""
    t = Fraction(threshold)
    sketched = Stored(sketches(docs, width, Bands(t)))
    try:
        found = cut(sketched.df.where("not more").select("k", "x", "n", "h"))
        rank = F.struct((F.col("k") == NULL_KEY).alias("null"), "k", "x")
        classes = cut(found.where("h is not null").groupBy("h", "n").agg(F.min(rank).alias("m")).select("h", "n", "m.k", "m.x"))
        edges = candidate_edges(sketched.df.select("h", "d", "sigs").where("size(sigs) > 0"), sketched.drop)
        near = components(edges)
    finally:
        sketched.drop()
    candidates = near.join(classes, near.node == classes.h).select("h", "k", "x", "n", "root")
    # a table of its own, so that the join can be split where one component has very many classes
    middle = cut(candidates.groupBy("root").agg(F.sum("n").alias("total"), F.percentile_approx("n", 0.5).alias("mid")))
    sized = cut(candidates.join(middle, "root"))
    texts = docs.join(sized.select("k", "x", "root", "total", "h"), ["k", "x"]).select("root", "total", "h", "text")
    sets = Stored(texts.mapInArrow(tidy(_hashed(width)), "root long, total long, h long, hashes array<long>"))
    try:
        small = sets.df.where(F.col("total") <= BLOCK).select(F.col("root").alias("block"), "h", F.col("h").alias("g"), "hashes")
        pivots = sized.where(F.col("total") > BLOCK).groupBy("root").agg(F.min_by("h", F.struct(F.abs(F.col("n") - F.col("mid")), "h")).alias("pivot"))
        with_pivot, blocks = large_blocks(sets.df.where(F.col("total") > BLOCK), pivots, t)
        searched = small.unionByName(blocks).repartition(F.col("block")).sortWithinPartitions("block")
        links = cut(searched.mapInArrow(tidy(_solve(t)), LINKS).unionByName(with_pivot))
    finally:
        sets.drop()
    return found, classes, components(links)


def _keyed(documents: DataFrame) -> DataFrame:
    return only(documents, "doc_id", "text").select(key(F.col("doc_id").cast("long")).alias("k"), F.xxhash64("text").alias("x"), "text")


def jaccard_components(documents: DataFrame, width: int = 5, threshold: str = "0.8") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of documents."""
    found, classes, joined = linked_classes(_keyed(documents), width, threshold)
    named = joined.join(classes, joined.node == classes.h).select("root", "h", "k")
    rank = F.struct((F.col("k") == NULL_KEY).alias("null"), "k")
    least = named.groupBy("root").agg(F.min(rank).alias("m"))
    labels = named.join(least, "root").select("h", F.col("m.k").alias("c"))
    # a table of its own, so that the join with the rows can be split where very many rows are copies of one text
    all_ = cut(classes.select("h", F.col("k").alias("own")).join(labels, "h", "left").select("h", F.coalesce("c", "own").alias("c")))
    real = lambda c: F.when(F.col(c) != NULL_KEY, F.col(c))
    out = found.join(all_, "h", "left")
    return out.select(real("k").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce(real("c"), real("k")).alias("component_id"))


def one_of_each(documents: DataFrame, width: int = 5, threshold: str = "0.8") -> DataFrame:
    """(k, x, empty): key and xxhash64 of the text of one row of each component, the one with the smallest id (null
    last), then text hash; and of all rows without shingles, with empty. Equal ids or null ids never make two rows one;
    rows that agree in k and x have one text."""
    found, classes, joined = linked_classes(_keyed(documents), width, threshold)
    rank = F.struct((F.col("k") == NULL_KEY).alias("null"), "k", "x")
    best = classes.join(joined, classes.h == joined.node, "left").groupBy(F.coalesce("root", "h").alias("root")).agg(F.min(rank).alias("m"))
    rows = best.select("m.k", "m.x", F.lit(False).alias("empty"))
    return rows.unionByName(found.where("h is null").select("k", "x", F.lit(True).alias("empty")).distinct())

"""BPE encoding by a pair occurrence index, and decoding.

Words of a batch that are not known yet are encoded together: every adjacent pair of symbols that has a merge is mapped
to all its positions; ranks that are in use are taken in ascending order from a heap, all positions of a rank are merged
from left to right, and the pairs to either side of each merge enter their lists. A merge can only make pairs of its own
new symbol, so taking ranks in order over the whole batch gives each word what it gets alone. Each worker remembers a
bounded number of words, and each text is put together from its words.

Nulls: a null text counts as the empty text (no ids, empty decoded text). Rows with null or repeated ids stay as they
are. Of pairs with one rank the leftmost is merged first. A very long text is encoded whole, word by word; one word without
a break takes memory in proportion to its length. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stagelight.llm.common import only, steps
from stagelight.llm.packing import byte_letters

#: Chunks and words that are kept in each Python worker
CACHED = 250_000
#: Characters outside the alphabets that have not changed in years: the library's own tables decide what they are
_UNUSUAL = re.compile("[^\x00-\u024f\u2010-\u2027]")
#: White space other than space and line feed
_RARE_SPACE = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class WordBPE:
    """Encodes and decodes as the tokenizers library does for a file with NFC, white space and lower-case normalizers,
    a split pattern, byte letters and a word-end suffix."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.text = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = {b: c for c, b in byte_letters().items()}
        self.merges: dict[int, int] = {}  # pair -> rank
        self.made: list[tuple[int, int, int]] = []  # rank -> left, right, result
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            left, right = self.vocab[a], self.vocab[b]
            self.merges.setdefault(left << 20 | right, len(self.made))
            self.made.append((left, right, self.vocab[a + b]))
        self.pairs = np.array(sorted(self.merges), np.int64)
        self.ranks = np.array([self.merges[p] for p in self.pairs.tolist()], np.int64)
        self.inner = np.array([self.vocab[self.letters[b]] for b in range(256)], np.int64)
        self.last = np.array([self.vocab[self.letters[b] + self.suffix] for b in range(256)], np.int64)
        self.library = Tokenizer.from_file(path)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.space = regex.compile(r"\p{White_Space}+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words: dict[str, tuple[str, str]] = {}
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, by the pair occurrence index over all of them. Positions are numpy arrays, so a rank's
        merges happen at once; only pairs of a symbol with itself, which can overlap, go one by one."""
        if not words:
            return []
        raw = [w.encode("utf-8") for w in words]
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        n = len(symbol)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[np.concatenate(([0], ends[:-1]))] = -1
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray, left: np.ndarray | int, right: np.ndarray | int) -> None:
            pair = np.asarray(left, np.int64) << 20 | right
            found = np.searchsorted(self.pairs, pair)
            found[found == len(self.pairs)] = 0
            hit = self.pairs[found] == pair
            if not hit.any():
                return
            at, ranks = at[hit], self.ranks[found[hit]]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for rank, where in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True):
                if rank in places:
                    places[rank].append(where)
                else:
                    places[rank] = [where]
                    heapq.heappush(active, rank)

        inside = np.flatnonzero(after >= 0)
        add(inside, symbol[inside], symbol[inside + 1])
        while active:
            rank = heapq.heappop(active)
            left, right, result = self.made[rank]
            lists = places.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            at = at[symbol[at] == left]
            next_ = after[at]
            live = (next_ >= 0) & (symbol[next_] == right)  # an earlier merge may have taken one of them
            at, next_ = at[live], next_[live]
            if left == right and len(at) > 1:
                keep, taken = [], -1
                for x, (i, j) in enumerate(zip(at.tolist(), next_.tolist(), strict=True)):
                    if i != taken:
                        keep.append(x)
                        taken = j
                at, next_ = at[keep], next_[keep]
            if not len(at):
                continue
            symbol[at], symbol[next_] = result, -1
            beyond = after[next_]
            after[at] = beyond
            has = beyond >= 0
            before[beyond[has]] = at[has]
            add(at[has], result, symbol[beyond[has]])
            ahead = before[at]
            ahead = ahead[ahead >= 0]
            add(ahead, symbol[ahead], result)
        kept = symbol >= 0
        ids = symbol[kept].tolist()
        bounds = np.concatenate(([0], np.cumsum(kept)[ends - 1])).tolist()
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def normal(self, text: str) -> str:
        if _UNUSUAL.search(text):
            return self.library.normalizer.normalize_str(text)
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        # runs of spaces need no folding: no word crosses them
        text = self.space.sub(" ", text) if _RARE_SPACE.search(text) else text.replace("\n", " ")
        return text.lower()

    def parts(self, chunk: str) -> list[str | int]:
        """Words of a normal chunk; special tokens, which come as chunks after a line end, as ids."""
        if _UNUSUAL.search(chunk):
            return [chunk[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]
        if chunk.isalpha():
            return [chunk]
        if chunk[-1:] in ".," and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return [self.special[chunk[1:]]] if chunk[:1] == "\n" else self.pattern.findall(chunk)

    def chunks(self, text: str) -> list[str]:
        """Normal text cut at spaces, which no word crosses."""
        if "<" not in text or not self.specials or not self.specials.search(text):
            return self.normal(text).split(" ")
        out = []
        for i, piece in enumerate(self.specials.split(text)):
            out += ["\n" + piece] if i % 2 else self.normal(piece).split(" ")
        return out

    def learn(self, chunks: set[str]) -> None:
        split = {c: self.parts(c) for c in chunks}
        new = list({w for ws in split.values() for w in ws if isinstance(w, str)} - self.words.keys())
        for w, ids in zip(new, self.encode_words(new), strict=True):
            self.words[w] = (" " + " ".join(map(str, ids)), " " + " ".join([self.text[i] for i in ids]))
        for c, ws in split.items():
            found = [(f" {w}", f" {self.text[w]}") if isinstance(w, int) else self.words[w] for w in ws]
            self.ids[c], self.decoded[c] = found[0] if len(found) == 1 else ("".join([x[0] for x in found]), "".join([x[1] for x in found]))

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """For each text, its ids in decimal and its decoded text: both as the tokens' parts joined by one space, which
        is how a file without a decoder decodes."""
        split = [self.chunks(t or "") for t in texts]
        if len(self.ids) > CACHED or len(self.words) > CACHED:
            self.ids.clear(), self.decoded.clear(), self.words.clear()
        self.learn(set().union(*split) - self.ids.keys())
        ids, decoded = self.ids, self.decoded
        for chunks in split:
            yield "".join([ids[c] for c in chunks])[1:], "".join([decoded[c] for c in chunks])[1:]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBPE:
    return WordBPE(path)


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = word_bpe(path)
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in steps(texts):
                n, ids_sha, text_sha = [], [], []
                for ids, decoded in code.encode(texts[a:b]):
                    n.append(ids.count(" ") + 1 if ids else 0)
                    ids_sha.append(sha256(ids.encode()).hexdigest())
                    text_sha.append(sha256(decoded.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return only(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Fingerprints, tokens and packing."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stagelight.llm import bpe, packing, simhash

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_edited_fingerprints(odd_documents):
    got = simhash.edited_fingerprints(odd_documents).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in odd_documents.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    following = {i: ids[(n + 1) % len(ids)] for n, i in enumerate(ids)}
    want = defaultdict(set)
    for i, t in rows:
        for head in texts[following[i]]:
            want[i, len(t)].add(sha(t[: len(t) - len(t) // 2] + head[: len(t) // 2]))
    prints = defaultdict(set)
    for r in got:
        assert r["edited_sha256"] in want[r["doc_id"], r["n_chars"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and len(r["fingerprint"]) == 32
        prints[r["doc_id"]].add(r["fingerprint"])
    assert prints[1] == prints[2] == prints[3] and len(prints[2]) == 1
    assert prints[6] == prints[7] == {"0" * 32}


def test_rows_of_one_id_are_spread(spark, monkeypatch):
    """A third of the rows without an id, and many of one id: the same rows whatever the salts."""
    rng = random.Random(17)
    texts = [" ".join(rng.choices("ab cd ef gh ij".split(), k=rng.randint(0, 12))) for _ in range(90)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = lambda: sorted((tuple(r) for r in simhash.edited_fingerprints(df).collect()), key=repr)
    spread = plain()
    assert len(spread) == 90
    monkeypatch.setattr(simhash, "SALTS", 1)
    assert plain() == spread


def test_fingerprints_of_nothing_and_one(spark, no_documents):
    assert simhash.edited_fingerprints(no_documents).count() == 0
    one = simhash.edited_fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).head()
    assert one["edited_sha256"] == sha("abab") and one["near_next"] == 1.0


@pytest.mark.parametrize("radius, spare", [(3, 1), (2, 2), (0, 0), (6, 1)])
def test_block_tables(spark, radius, spare):
    """Every fingerprint within the radius of a query, once, as a comparison with each gives it."""
    rng = random.Random(1)
    base = [rng.getrandbits(128) for _ in range(30)]
    many = base + [b ^ sum(1 << x for x in rng.sample(range(128), rng.randint(0, 7))) for b in base for _ in range(6)]
    prints = spark.createDataFrame([(f"{x:032x}", i) for i, x in enumerate(many)], "fingerprint string, i long").select(*simhash.halves("fingerprint"), "i")
    queries = prints.where("i % 3 = 0").select("hi", "lo").distinct()
    number = lambda hi, lo: (hi % 2**64) << 64 | lo % 2**64
    got = sorted((number(r["q_hi"], r["q_lo"]), r["i"], r["distance"]) for r in simhash.within(prints, queries, radius, spare).collect())
    want = sorted((q, i, n) for q in set(many[::3]) for i, x in enumerate(many) if (n := (q ^ x).bit_count()) <= radius)
    assert got == want and len(want) > len(set(many[::3]))


def plain_fingerprints(spark, texts):
    """Votes counted term by term in Python; hash bits of terms come from Spark's xxhash64."""
    terms = {}
    for t in texts:
        words = re.split(r"[ \t\n\x0b\f\r]+", t.lower())
        terms[t] = [(w, words[i + 1] if i + 1 < len(words) else None) for i, w in enumerate(words) if w]
    every = sorted({x for v in terms.values() for x in v}, key=repr)
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(every)], "i long, w string, x string").selectExpr("i", "xxhash64(w, x) as h").selectExpr("i", "h", "xxhash64(h) as g")
    bits = {every[r["i"]]: (r["h"] % 2**64, r["g"] % 2**64) for r in df.collect()}
    out = {}
    for t, found in terms.items():
        print_ = 0
        for half in (0, 1):
            for b in reversed(range(64)):
                votes = sum(1 if bits[x][half] >> b & 1 else -1 for x in found)
                print_ = print_ << 1 | (votes > 0)
        out[t] = f"{print_:032x}"
    return out


def test_fingerprints_are_brute_force(spark):
    """Fingerprints, both likenesses, and documents within the radius, by plain loops over whole texts."""
    rng = random.Random(13)
    base = " ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=400))
    texts = [base, base, base + " one", base.replace("alpha", "Alpha", 3), base + " two words", "", None, "x", " lead and trail ", "A b a B"]
    rows = [(i * 25, texts[i % len(texts)] if i % 4 else base + " " + "ab " * i) for i in range(40)]
    got = {r["doc_id"]: r for r in simhash.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ids, plain = sorted(i for i, _ in rows), {i: t or "" for i, t in rows}
    following = {i: ids[(n + 1) % len(ids)] for n, i in enumerate(ids)}
    edited = {i: t[: len(t) - len(t) // 2] + plain[following[i]][: len(t) // 2] for i, t in plain.items()}
    prints = plain_fingerprints(spark, set(plain.values()) | set(edited.values()))
    like = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
    for i, t in plain.items():
        f, e = prints[t], prints[edited[i]]
        near = [j for j in ids if like(f, prints[plain[j]]) >= 1 - simhash.RADIUS / 128]
        want = (f, e, like(f, e), like(f, prints[plain[following[i]]]), *((len(near), min(near)) if i % 50 == 0 else (None, None)))
        r = got[i]
        assert (r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"], r["near_docs"], r["near_first"]) == want
    assert len({got[i]["near_docs"] for i in ids if i % 50 == 0}) > 2


def test_bpe_on_odd_documents(odd_documents, no_documents):
    got = sorted(tuple(r) for r in bpe.round_trip(odd_documents.where("doc_id is not null"), WORD).collect())
    t = Tokenizer.from_file(WORD)
    want = []
    for r in odd_documents.where("doc_id is not null").collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want)
    assert bpe.round_trip(no_documents, WORD).count() == 0


CODE, LIBRARY = bpe.WordBPE(WORD), Tokenizer.from_file(WORD)
BYTES, BYTE_LIBRARY = packing.Encoder(BYTE), Tokenizer.from_file(BYTE)
TEXT = st.lists(st.one_of(st.text(max_size=8), st.sampled_from(["<|endoftext|>", "<|startoftext|>", " ", "\n", "'s", "don't", "Σ", "aaaa", "ab" * 9])), max_size=10).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_bpe_is_the_library(texts):
    for t, (ids, decoded) in zip(texts, CODE.encode(texts), strict=True):
        want = LIBRARY.encode(t, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want))
        assert decoded == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_byte_encoder_is_the_library(text):
    assert np.frombuffer(BYTES(text), "<u4").tolist() == BYTE_LIBRARY.encode(text, add_special_tokens=False).ids


def plain_best_fit(lengths, capacity):
    """Best-fit decreasing, one piece at a time."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            min(fits, key=lambda b: b[0])[0] -= n
        else:
            bins.append([capacity - n])
    return sorted(b[0] for b in bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_is_best_fit_decreasing(lengths):
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    runs, bins = packing.best_fit(counts, 40)
    used = [0] * bins
    placed = defaultdict(int)
    for length, r0, r1, first, each, at in runs:
        placed[length] += r1 - r0
        for rank in range(r0, r1):
            b, offset = first + (rank - r0) // each, at + (rank - r0) % each * length
            assert used[b] == offset
            used[b] += length
    assert dict(placed) == dict(counts)
    assert sorted(40 - u for u in used) == plain_best_fit(lengths, 40)


def test_packing(odd_documents, no_documents):
    rows = packing.packed(odd_documents, BYTE).collect()
    t = Tokenizer.from_file(BYTE)
    ids = [np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4") for r in odd_documents.collect()]
    want = []
    for x, r in zip(ids, odd_documents.collect(), strict=True):
        start, stop, piece = 0, len(x) % 1024 or 1024, 0
        while start < len(x):
            want.append((r["doc_id"], piece, start, stop - start, zlib.crc32(x[start:stop].tobytes())))
            start, stop, piece = stop, stop + 1024, piece + 1
    key = lambda x: tuple(v if v is not None else -99 for v in x)
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= -(-sum(map(len, ids)) // 1024) + 2
    assert packing.packed(no_documents, BYTE).count() == 0

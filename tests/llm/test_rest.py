"""Licences, chats, languages, toxicity, URL filters, queries and the pipeline."""

import hashlib
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagelight.llm import chat, langid, license, queries, toxicity, url_filter
from stagelight.llm.common import fold

from .conftest import prose

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    plain = lambda v: v.isoformat() if hasattr(v, "isoformat") else round(v, 6) if isinstance(v, float) else v
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    answer = duck.execute(queries.ORACLE_SQL[name])
    at = [[x[0] for x in answer.description].index(c) for c in columns]
    assert ours == sorted((tuple(plain(r[i]) for i in at) for r in answer.fetchall()), key=repr)


FILES = "doc_id long, path string, text string, rid long, license string"


def test_licences(spark):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0.", 0, ""), (2, "a/b/c.txt", "nothing", 0, ""), (3, "a/b/LICENSE.md", "Released under the MIT License.", 0, ""), (4, "a/x.txt", "words\nReleased under the MIT License.", 0, ""),
        (5, "z/y.txt", None, 0, ""), (6, None, "nothing", 0, ""), (2, "a/b/c.txt", "nothing", 0, ""), (7, "a/x/deep/er/f", "", 0, ""),
    ]
    got = sorted((r["doc_id"], r["license"], r["origin"], r["directory"]) for r in license.scan(spark.createDataFrame(rows, FILES)).collect())
    assert got == [
        (1, "Apache-2.0", "own", None), (2, "MIT", "inherited", "a/b"), (2, "MIT", "inherited", "a/b"), (3, "MIT", "own", None), (4, "MIT", "own", None), (5, None, "none", None), (6, None, "none", None), (7, "Apache-2.0", "inherited", "a"),
    ]
    assert license.scan(spark.createDataFrame([], FILES)).count() == 0


def test_units_against_brute_force(spark):
    """Planted licence lines of every kind and odd ones, wrapped notices, blocks and licence files, against TF-IDF of every
    line, block and licence file with every template."""
    import math
    import re
    from collections import Counter

    rng = random.Random(14)
    planted = {"All rights reserved.": "Proprietary", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    odd = ["subject to the terms of the mozilla public", "..all.. ..rights-reserved. a..b", "The rights of all are reserved, as the terms of the version say", "the and of to", "  All rights reserved  ", "this work, version 2.0", "All", "reserved rights", "\r", "", "", "-- -.-"]
    wrapped = lambda x, w=9, mark="": "\n".join(mark + " ".join(x.split()[i : i + w]) for i in range(0, len(x.split()), w))
    notices = [wrapped(x, rng.randint(4, 14), rng.choice(["", "# ", " * "])) for _, x in license.TEMPLATES]
    rows = [(i, f"a/{i}/LICENSE" if i % 7 == 0 else f"a/{i // 2}/x{i}.txt", "\n".join([f"The {prose(rng, rng.randint(1, 9))} of the {prose(rng, 3)}." for _ in range(rng.randint(0, 4))] + rng.sample([*planted, *odd, *notices], rng.choice([0, 1, 1, 3])))) for i in range(200)]
    rows += [(500 + i, f"b/{i}.txt", f"{prose(rng, 20)}\n{x}\nthe end") for i, x in enumerate(planted)] + [(600, "b/n", None), (None, "b/m", "MIT License")]
    cut_up = lambda x: [t for y in re.split("[^a-z0-9.-]+", x.lower()) if (t := y.strip(".-"))]
    lines = [list(dict.fromkeys(x.strip(" ") for x in t.split("\n"))) if t is not None else [] for _, _, t in rows]
    df, n = Counter(t for d in lines for x in d for t in set(cut_up(x))), sum(map(len, lines))
    vector = lambda x: {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(cut_up(x)).items()}
    size = lambda v: math.sqrt(sum(a * a for a in v.values()))
    given = [(license.SAME.get(k, k), vector(x)) for k, x in license.TEMPLATES]
    want = {}
    for (i, path, text), d in zip(rows, lines, strict=True):
        units = d + [x for x in re.split(r"\n[ \t\r]*\n", text or "") if "\n" in x] + ([text] if path.endswith("LICENSE") else [])
        best = [(-round(sum(a * w.get(t, 0) for t, a in v.items()) / (size(v) * size(w)), 6), k) for v in map(vector, units) if v for k, w in given]
        want[i] = next(((k, -s) for s, k in sorted(best) if -s >= license.THRESHOLD), None)
    out = license.scan(spark.createDataFrame([(*r, 0, "") for r in rows], FILES)).collect()
    assert {r["doc_id"]: (r["license"], round(r["score"], 5)) if r["origin"] == "own" else None for r in out} == {i: w and (w[0], round(w[1], 5)) for i, w in want.items()}
    assert [want[500 + i][0] for i in range(len(planted))] == list(planted.values()) and len(out) == len(rows)
    assert license.scan(spark.createDataFrame([], FILES)).count() == 0


def test_real_licences(spark):
    """Licence files, header comments and SPDX lines among texts without any."""
    rng = random.Random(15)
    year = "Copyright (c) 2020 Someone"
    apache = " ".join(license._APACHE)
    texts = {
        "MIT": ["MIT License\n\n" + year + "\n\n" + "\n\n".join(license._MIT), license._MIT[0], "/* SPDX-License-Identifier: MIT */\nint x;", "-- SPDX-License-Identifier: MIT"],
        "BSD-3-Clause": [year + "\n\n" + "\n\n".join(license._BSD), "\n".join(license._BSD)],
        "Apache-2.0": ["SPDX-License-Identifier: Apache-2.0", "\n\n".join(license._APACHE_FILE), "\n".join("# " + " ".join(apache.split()[i : i + 9]) for i in range(0, 90, 9)) + "\nimport os\n"],
        "GPL-3.0": ["// SPDX-License-Identifier: GPL-3.0-or-later", "\n\n".join(license._GPL)],
        "MPL-2.0": [license._MPL, license._MPL.replace(". ", ".\n")],
    }
    rows, want = [(1000 + i, f"z/{i}", prose(rng, 60)) for i in range(60)], {}
    for name, some in texts.items():
        for x in some:
            want[len(want)] = name
            rows.append((len(want) - 1, f"p{len(want)}/LICENSE", x))
    got = {r["doc_id"]: r["license"] for r in license.scan(spark.createDataFrame([(*r, 0, "") for r in rows], FILES)).collect()}
    assert got == want | {i: None for i in got if i >= 1000}


def test_pattern_of_words():
    import re

    words = ["all", "a", "also", "mit", "apache-2.0", "v", "version", "2.0"]
    p = re.compile(license.pattern_of(words))
    for x in ("all", "alls", "also-", "a.", "mit", "summit", "mit-x", "version", "versio", "v", "2.0", "12.0", "apache-2.0", "apache-2", "x also y"):
        plain = re.compile(r"(?<![a-z0-9])(?:" + "|".join(map(re.escape, words)) + r")(?![a-z0-9])")
        assert bool(p.search(x)) == bool(plain.search(x)), x


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chats(spark):
    rng = random.Random(5)
    bits = [*chat.CONTROL, "\\", "\\l", "\\b", "<", "[", "word", "\n", "é", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system"]), "".join(rng.choices(bits, k=rng.randint(0, 8)))) for c in range(60) for t in range(rng.randint(1, 7))]
    rows += [(100, 1, "user", None), (100, 0, None, "x"), (100, 1, "assistant", "tie"), (101, None, "user", "null turn"), (None, 0, "user", "no id"), (102, 0, "user", "again"), (102, 0, "user", "again")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    formatted = chat.formatted(df)
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    chats = {}
    for c, t, r, x in rows:
        chats.setdefault(c, []).append(((t is not None, t), r or "", x or ""))
    for c, turns in chats.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c] == (len(turns), digest("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), digest(loss))
    texts = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    for c, text in texts.items():
        for mark in chat.CONTROL:
            if mark not in (chat.ROLE, chat.TEXT, chat.TURN, chat.END):
                assert mark not in text
    found = {}
    for r in chat.spans(formatted).orderBy("start").collect():
        found.setdefault(r["conv_id"], []).append(texts[r["conv_id"]][r["start"] : r["start"] + r["length"]])
    assert [len(x) for x in found.get(100, [])] == [3]
    assert chat.read_back(chat.formatted(df.limit(0))).count() == 0


def test_languages(spark, odd_documents, no_documents):
    rng = random.Random(9)
    words = {"aa": "stein unge berch keit", "bb": "tion leaux queré ment", "cc": "zza gno lli ccio"}
    text = lambda lang, n: " ".join("".join(rng.choices(words[lang].split(), k=rng.randint(1, 3))) for _ in range(n))
    rows = [(i, text(lang, rng.randint(5, 80)), lang) for i in range(240) for lang in [rng.choice(list(words))]]
    df = spark.createDataFrame([*rows, (900, None, "aa"), (901, "123 !!", "aa"), (902, "", None), (903, text("aa", 90) + " " + text("bb", 30), None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.languages(df).collect()}
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert got[903]["lang_pred"] == "aa" and 0.55 < got[903]["score"] < 0.9
    held = [(got[i]["lang_pred"], lang) for i, _, lang in rows if got[i]["held_out"]]
    assert held and sum(a == b for a, b in held) / len(held) >= 0.97
    assert langid.languages(odd_documents).count() == odd_documents.count()
    assert langid.languages(no_documents).count() == 0
    unlearned = langid.languages(df.withColumn("lang", df.lang.substr(9, 1)).where("false").unionByName(df.selectExpr("doc_id", "text", "cast(null as string) lang")))
    assert {r["lang_pred"] for r in unlearned.collect()} == {"und"}


def test_toxicity(spark, odd_documents, no_documents):
    rng = random.Random(11)
    labels, docs = [], []
    for i in range(900):
        toxic = rng.random() < 0.3
        words = prose(rng, rng.randint(10, 60)).split()
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Gribbel!", "vexxo", "SNARGle"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (None, 1), (5, None), (7777, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(d, lab).collect()}
    held = [(got[i]["predicted"], y) for i, y in labels if got[i]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert toxicity.toxicity(odd_documents, lab).count() == odd_documents.count()
    assert toxicity.toxicity(no_documents, lab).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity(d.limit(5), lab.limit(0)).collect()} == {0}


def test_pairs_of_terms_are_learned():
    """Neither term alone is toxic; both together are. A sum of single weights cannot tell."""
    rng = np.random.default_rng(0)
    on = rng.random((3000, 2)) < 0.5
    rows = [np.flatnonzero(x) for x in on]
    y = (on[:, 0] & on[:, 1]).astype(float)
    bias, w, v = toxicity.train(rows, y, 2)
    machine = toxicity.Machine(np.zeros(0), bias, w, v)
    doc, x = np.nonzero(on)
    assert ((machine.margins(doc, x, len(on)) > 0) == (y == 1)).mean() > 0.99


def test_pairs_without_marginal_signal(spark):
    """Documents are toxic where both or neither of two words stand: each alone is as common in either kind."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(2500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = prose(rng, 30).split() + ["grumvak"] * a + ["plixnor"] * b
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(a == b)))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(d, lab).collect()}
    held = [(got[i]["predicted"], y) for i, y in labels if got[i]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) >= 0.95


def test_toxicity_learns_from_one_row_an_id(spark):
    docs = [(1, f"text {i}") for i in range(50)] + [(i, "fine words here") for i in range(2, 9)] + [(None, "no id")]
    d = spark.createDataFrame([(*r, "x", 0.1) for r in docs], "doc_id long, text string, _score string, score double")
    lab = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, toxic int")
    assert toxicity.toxicity(d, lab).count() == len(docs)
    seen = []
    train = toxicity.train
    with pytest.MonkeyPatch.context() as m:
        m.setattr(toxicity, "train", lambda rows, *a: seen.append(len(rows)) or train(rows, *a))
        toxicity.fit(d, lab)
    assert seen == [sum(fold_of(i, 5) != 0 for i in range(1, 9))]


def fold_of(i, parts):
    import zlib

    return zlib.crc32(str(i).encode()) % parts


def test_margins_are_brute_force():
    """Scores of whole texts by a plain sum over terms and pairs of terms."""
    rng = np.random.default_rng(1)
    table = np.where(rng.random(toxicity.SLOTS) < 0.6, rng.integers(0, 50, toxicity.SLOTS), -1).astype(np.int32)
    machine = toxicity.Machine(table, -0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    texts = [prose(random.Random(i), n) for i, n in enumerate((0, 1, 5, 40))] + [None, "Ünder ABC abc!"]
    for text, score in zip(texts, machine.scores(texts), strict=True):
        known = sorted(set(toxicity.term_slots([text], table)[1].tolist()))
        margin = machine.bias + sum(machine.weight[i] for i in known) + sum(machine.factor[i] @ machine.factor[j] for i in known for j in known if i < j)
        assert abs(score - 1 / (1 + np.exp(-np.clip(margin, -30, 30)))) < 1e-9


def test_mixture_is_brute_force():
    """Proportions, languages taken out and scores by plain loops over every trigram."""
    import math

    rng = random.Random(2)
    langs = ["aa", "bb", "cc"]
    counts = np.full((3, langid.SLOTS), 0.5)
    for i, words in enumerate(("stein unge berch keit", "tion leaux ment rue", "zza gno lli ccio")):
        counts[i] += langid.slot_counts(" ".join(rng.choices(words.split(), k=3000)))
    table = np.log(counts / counts.sum(1, keepdims=True))
    mixture = langid.Mixture(langs, table)

    def em(grams, active, pi, rounds):
        for _ in range(rounds):
            new = [0.0] * len(active)
            for g in grams:
                parts = [p * math.exp(table[a, g]) for p, a in zip(pi, active)]
                for i, x in enumerate(parts):
                    new[i] += x / sum(parts)
            pi = [x / len(grams) for x in new]
        return pi, sum(math.log(sum(p * math.exp(table[a, g]) for p, a in zip(pi, active))) for g in grams)

    for words in ("stein keit unge", "tion stein leaux berch ment", "zza " * 9 + "rue leaux " * 8):
        grams = [int(g) for x in langid.gram_slots(words) for g in x]
        active = [0, 1, 2]
        pi, best = em(grams, active, [1 / 3] * 3, 12)
        while len(active) > 1:
            out = pi.index(min(pi))
            rest = [p + 1e-12 for i, p in enumerate(pi) if i != out]
            fewer, less = em(grams, active[:out] + active[out + 1 :], [p / sum(rest) for p in rest], 6)
            if best - less >= langid.PENALTY * math.log(len(grams) + 1):
                break
            active, pi, best = active[:out] + active[out + 1 :], fewer, less
        lang, share = mixture.predict(words)
        assert lang == langs[active[pi.index(max(pi))]] and abs(share - max(pi) / sum(pi)) < 1e-6


def test_many_languages(spark, odd_documents, monkeypatch):
    """Forty languages in blocks are learned and told as in one table, and as by the mixture of each text."""
    rng = random.Random(12)
    words = {f"l{i:02d}": [prose(rng, 1) + chr(97 + i % 26) * 2 for _ in range(12)] for i in range(40)}
    text = lambda lang: " ".join(rng.choices(words[lang], k=rng.randint(5, 40)))
    rows = [(i, text(lang), lang) for i in range(400) for lang in [f"l{i % 40:02d}"]] + [(500, text("l03") + " " + text("l20") * 2, None), (501, None, "l01"), (502, "12", "only digits"), (None, text("l05"), "l05")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_rid", F.lit(1)).repartition(5)
    got = lambda: sorted((repr(r["doc_id"]), r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in langid.languages(df).collect())
    whole = got()
    model = langid.learn(df)
    assert model.languages == 40  # a text without letters teaches nothing
    langs, table = model.table()
    mixture = langid.Mixture(langs, table)
    assert [(p, round(s, 9)) for p, s in (mixture.predict(t) for _, t, _ in rows[:20])] == [(p, s) for i in range(20) for d, _, p, s in whole if d == repr(i)]
    assert sum(p == f"l{int(d) % 40:02d}" for d, h, p, _ in whole if h and d != "None" and int(d) < 400) > 80
    monkeypatch.setattr(langid, "LANGUAGES", 10)
    assert got() == whole
    assert len(langid.languages(odd_documents).collect()) == odd_documents.count()


def test_url_filter_of_distant_dates_and_hot_hosts(spark):
    """Against every interval of every pattern, one after the other."""
    rng = random.Random(6)
    at = lambda: datetime(2024, rng.choice([1, 1, 1, 2]), rng.randint(1, 28), rng.choice([0, 5, 5]), rng.choice([0, 0, 30]))
    hosts = ["hot.example", "hot.example", "a.hot.example", "b.example"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/x/y', '/x/z/w', '//', '/x//y'])}" for _ in range(400)]
    captures = [(i, u, at()) for i, u in enumerate(urls)] + [(900, urls[0], datetime(9999, 12, 31, 23)), (901, urls[1], datetime(1, 1, 2)), (902, "http://hot.example/" + "d/" * 300, at())]
    changes = [(rng.choice(["hot.example", "hot.example/x/", "example", "b.example", "b.example/x/"]), rng.choice(["add", "remove"]), at()) for _ in range(60)] + [("a.hot.example", "add", datetime(2, 1, 1))]
    want = {}
    for i, u, t in captures:
        name, _, path = u.removeprefix("http://").partition("/")
        labels, parts = name.split("."), path.split("/")[:-1]
        covers = [".".join(labels[j:]) for j in range(max(1, len(labels) - 1))] + [f"{name}/{'/'.join(parts[: j + 1])}/" for j in range(len(parts))]
        best = None
        for p in covers:
            since = None
            for when in sorted({w for q, _, w in changes if q == p and w <= t}):
                last = max(a for q, a, w in changes if q == p and w == when)
                since = (since or when) if last == "add" else None
            if since is not None and (best is None or (len(p), p) > best[:2]):
                best = (len(p), p, since)
        want[i] = best and best[1:]
    found = url_filter.evaluate(spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp"), spark.createDataFrame(changes, "pattern string, action string, at timestamp"))
    got = {r["page_id"]: (r["pattern"], r["since"]) if r["blocked"] else None for r in found.collect()}
    assert got == want and any(want.values()) and not all(want.values())


def test_url_filter(spark):
    at = lambda d, h=0: datetime(2024, 3, d, h)
    changes = [("bad.example", "add", at(2)), ("bad.example", "add", at(3)), ("bad.example", "remove", at(10)), ("ok.example/x/", "add", at(1)), ("bad.example", "add", at(20)), ("tie.example", "add", at(4)), ("tie.example", "remove", at(4)), (None, "add", at(1)), ("n.example", "add", None)]
    pages = [
        (1, "http://www.bad.example/q?x", at(2)), (2, "http://bad.example", at(1, 23)), (3, "https://bad.example/", at(10)), (4, "http://ok.example/x/y/z", at(5)), (5, "http://ok.example/y", at(5)), (6, None, at(5)), (7, "not a url", at(5)), (8, "http://bad.example/", None),
        (9, "http://bad.example/", datetime(2025, 1, 1)), (10, "http://notbad.example/", at(5)), (11, "http://tie.example/", at(5)), (1, "http://www.bad.example/q?x", at(2)),
    ]
    got = sorted((r["page_id"], r["blocked"]) for r in url_filter.evaluate(spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, fetched_at timestamp, rid string"), spark.createDataFrame(changes, "pattern string, action string, at timestamp")).collect())
    assert got == [(1, 1), (1, 1), (2, 0), (3, 0), (4, 1), (5, 0), (6, 0), (7, 0), (8, 0), (9, 1), (10, 0), (11, 0)]
    assert url_filter.evaluate(spark.createDataFrame([], "page_id long, url string, fetched_at timestamp"), spark.createDataFrame(changes, "pattern string, action string, at timestamp")).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in p.STAGES]
    assert names == ["toxicity", "language_id", "ngram_jaccard_join", "best_fit_packing"]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    now = docs
    for i, (name, stage) in enumerate(p.STAGES):
        after = stage(spark, now, FOLDER)
        after.write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        if i < 3:
            assert after.columns == docs.columns
            kept, before = {r["doc_id"] for r in after.collect()}, {r["doc_id"]: r["text"] for r in now.collect()}
            if name == "toxicity":
                clean = [d for d in before if labels.get(d) == 0]
                assert sum(d in kept for d in clean) / len(clean) >= 0.97
            if name == "language_id":
                assert kept == {d for d, t in before.items() if any(c.isalpha() for c in t or "")}
            if name == "ngram_jaccard_join":
                from fractions import Fraction

                from .test_joins import brute

                assert kept == {d for d, n, c in brute(sorted(before.items()), 5, Fraction(4, 5)) if d == c}
        now = after
    assert {r["doc_id"] for r in now.select("doc_id").distinct().collect()} == kept


def test_stages_of_odd_documents(spark, odd_documents, no_documents):
    """Null and repeated ids, odd texts and columns called as those that stages use; empty tables."""
    import corpus_pipeline as p

    names = ["_score", "score", "found_lang", "_found_share", "row_key", "ROW_TEXT", "_k", "_x", "_lang", "row_number", "row_empty"]
    docs = odd_documents.select("doc_id", "text", "lang", "source").selectExpr("*", *[f"{i} as {n}" for i, n in enumerate(names)])
    rows = sorted((repr(r["doc_id"]), r["text"] or "") for r in docs.collect())
    for name, stage in p.STAGES[:3]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns
        got = sorted((repr(r["doc_id"]), r["text"] or "") for r in after.collect())
        assert all(list(r)[4:] == list(range(len(names))) for r in after.collect())
        if name == "toxicity":
            assert got == rows
        if name == "language_id":
            assert got == [r for r in rows if any(c.isalpha() for c in r[1])]
        assert stage(spark, no_documents, FOLDER).count() == 0
    assert p.pack(spark, no_documents, FOLDER).count() == 0


def test_run_is_its_stages(spark, tmp_path):
    """run() gives what the stages give when each is written and read by itself, and leaves no table behind."""
    import os

    import corpus_pipeline as p

    now = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for i, (_, stage) in enumerate(p.STAGES):
        stage(spark, now, FOLDER).write.parquet(str(tmp_path / str(i)))
        now = spark.read.parquet(str(tmp_path / str(i)))
    shared = spark.conf.get("spark.checkpoint.dir")
    before = {x for x in os.listdir(shared) if x.startswith("stored-")}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    out = p.run(spark, FOLDER)
    plain = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert plain(out) == plain(now)
    assert out.select("sequence_id").distinct().count() == now.select("sequence_id").distinct().count()
    assert {x for x in os.listdir(shared) if x.startswith("stored-")} == before


def test_one_row_of_each_group(spark, odd_documents):
    """Ids never merge rows: null ids, two texts under one id and rows without words, against a brute-force grouping."""
    import corpus_pipeline as p

    from .test_joins import shingles

    rng = random.Random(12)
    twin, other = prose(rng, 80), [prose(rng, 80) for _ in range(12)]
    extra = [(30, twin), *[(31, t) for t in (twin, *other[:4])], (32, other[4]), (32, other[4]), (32, ""), (32, " "), *[(None, t) for t in other[5:10]], (None, other[5]), (None, twin), (None, ""), (33, other[10]), (33, None)]
    docs = odd_documents.unionByName(spark.createDataFrame([(i, t, 1, "x", 0.5, 7, "en", "s", 3) for i, t in extra], odd_documents.schema))
    rows = [(r["doc_id"], shingles(r["text"], 5)) for r in docs.collect()]
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    rank = lambda d: (d is None, d or 0)
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g), key=rank) for g in set(group)}
    member = {s: g for (_, s), g in zip(rows, group, strict=True) if s}
    got = [(r["doc_id"], shingles(r["text"], 5)) for r in p.one_of_each_group(spark, docs, FOLDER).collect()]
    assert sorted((member[s], repr(d)) for d, s in got if s) == sorted((g, repr(least[g])) for g in set(member.values()))
    assert sorted(repr(d) for d, s in got if not s) == sorted(repr(d) for d, s in rows if not s)


def test_folds(spark):
    import zlib

    df = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    assert [r[0] for r in df.select(fold("doc_id", 4)).collect()] == [zlib.crc32(str(i).encode()) % 4 for i in range(50)] + [0]


def test_no_language_is_left_out_of_sets(monkeypatch):
    """A language that is the worst of 41 by itself, but holds most of a text that it shares with another, is found."""
    n = np.ones(100)
    monkeypatch.setattr(langid, "_counted", lambda text: (np.arange(100), n))
    table = np.full((41, langid.SLOTS), 1e-5)
    table[:40, :40] = 1 / 40 + np.arange(40)[:, None] * 1e-5
    table[40, :] = 1e-12
    table[40, 40:100] = 1 / 60
    mixture = langid.Mixture([f"a{i:02}" for i in range(40)] + ["z"], np.log(table))
    assert 40 not in mixture.likeliest(np.arange(100), n)[0]
    lang, share = mixture.predict("x")
    assert lang == "z" and 0.5 < share < 0.7

"""Language identification by multilingual mixture inference.

Learning counts hashed byte trigrams of the letters of all labelled training texts, per language. For each document,
expectation-maximisation finds the proportions of languages that make its trigrams likeliest; then languages are taken
out, weakest first, as long as the likelihood falls by less than the penalty for keeping one. The prediction is the
language with the largest proportion in the set that remains, the score that proportion. Where there are more languages,
a document's set is sought among the CANDIDATES that are likeliest by themselves first. Then every other language is looked at: those
that may raise the likelihood by the penalty go in, and the set is sought again, until a bound shows that no other can.

Any number of languages is learned. Up to LANGUAGES of them go out to executors as one table; more are dealt to blocks, each
of which goes out by itself: a pass for each block finds each document's likeliest languages of the block, a second one
brings the likelihoods of those that are likeliest of all, and the sets are found from these. Further passes bring those that
may still go in, for the documents that have any. The result is the same.

Nulls: `und` with score 0 for a null text or one without letters. Rows with null lang are not learned from but get a
prediction. Rows with a null doc_id count as the id "". If nothing can be learned, every prediction is `und`. Repeated rows each
get their prediction; ties go to the language that sorts first. An empty table gives an empty result. Very long texts are
counted in bounded steps and count whole. Extra columns, whatever their names, are passed on or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagelight.llm.common import Stored, cut, fold, fresh, only, tidy, with_fields

SLOTS = 1 << 14
FOLDS, HELD_OUT = 4, 2
#: Languages that go out to executors together: 67 MB
LANGUAGES = 512
#: Languages that a document's set is sought among first
CANDIDATES = 16
#: Log-likelihood that a language must add for each log(trigrams); neighbouring trigrams share letters, so more than 1/2
PENALTY = 3.0
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_PLAIN = np.array([b if chr(b).isalpha() or b >= 128 else 32 for b in range(256)], np.uint32)


def gram_slots(text: str, most: int = 1 << 22) -> Iterator[np.ndarray]:
    """Slots of all byte trigrams of the lower-cased text, other characters than letters as spaces, in bounded steps."""
    data = _PLAIN[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    for a in range(0, max(len(data) - 2, 0), most):
        x = data[a : a + most + 2]
        x = x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)
        x = x[(x & np.uint32(0xFFFF)) != 0x2020]  # of runs of spaces, the last one counts
        with np.errstate(over="ignore"):
            yield (x * np.uint32(2654435761)) >> np.uint32(18)


def slot_counts(text: str) -> np.ndarray:
    out = np.zeros(SLOTS, np.int64)
    for slots in gram_slots(text):
        out += np.bincount(slots, minlength=SLOTS)
    return out


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["lang", "slot", "n"])
        total.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = total.setdefault(lang, np.zeros(SLOTS, np.int64))
            for slots in gram_slots(text):
                np.add.at(counts, slots, 1) if len(slots) < 2000 else np.add(counts, np.bincount(slots, minlength=SLOTS), out=counts)
            if len(total) > LANGUAGES:
                yield from flush()
    yield from flush()


@dataclass
class Learned:
    """Counts (lang, slot, n) of every training row, in the shared folder, and how many languages there are."""

    counts: DataFrame
    languages: int

    def table(self, block: int | None = None, blocks: int = 1) -> tuple[list[str], np.ndarray]:
        """Languages in order and log P(slot | language), of all or of a block."""
        some = self.counts if block is None else self.counts.where(block_of("lang", blocks) == block)
        counts = some.toArrow()  # at most SLOTS rows for each language of the block
        langs = sorted(set(counts.column("lang").to_pylist()), key=str.encode)
        table = np.full((len(langs), SLOTS), 0.5)
        if langs:
            place = {lang: i for i, lang in enumerate(langs)}
            table[[place[x] for x in counts.column("lang").to_pylist()], counts.column("slot").to_numpy()] += counts.column("n").to_numpy()
        return langs, np.log(table / table.sum(1, keepdims=True)) if langs else table


def block_of(lang: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(lang), F.lit(blocks))


def learn(documents: DataFrame) -> Learned:
    rows = only(documents, "doc_id", "lang", "text").where("lang is not null and text is not null").where(fold("doc_id", FOLDS) != HELD_OUT)
    counts = cut(rows.select("lang", "text").mapInArrow(_learn, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")))
    return Learned(counts, counts.select("lang").distinct().count())


def proportions(n: np.ndarray, p: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """EM over (trigrams x languages) likelihoods p, with counts n; the log-likelihood at the end."""
    pi, total = start, n.sum()
    for _ in range(rounds):
        pi = pi * (p.T @ (n / (p @ pi))) / total
    return pi, float(n @ np.log(p @ pi))


def mixed(n: np.ndarray, p: np.ndarray) -> tuple[int, float, np.ndarray]:
    """Counts n and likelihoods p (trigrams x languages) -> the place of the prediction, its share, and the trigrams' likelihoods
    under the set that remains."""
    most = p.max(1, keepdims=True)
    p = p / most  # the same factor for all languages
    active = np.arange(p.shape[1])
    pi, likelihood = proportions(n, p, np.full(len(active), 1 / len(active)), 12)
    penalty = PENALTY * np.log(n.sum() + 1)
    while len(active) > 1:
        keep = np.arange(len(active)) != int(np.argmin(pi))
        rest = pi[keep] + 1e-12
        fewer, less = proportions(n, p[:, active[keep]], rest / rest.sum(), 6)
        if likelihood - less >= penalty:
            break
        active, pi, likelihood = active[keep], fewer, less
    best = int(np.argmax(pi))
    return int(active[best]), float(min(1.0, pi[best] / pi.sum())), most[:, 0] * (p[:, active] @ (pi / pi.sum()))


def beyond(n: np.ndarray, fit: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whether a language of p may add the penalty to a set under which trigrams have the likelihoods fit: by Jensen's
    inequality, what any shares of some languages can add is at most total * log(the largest mean of p / fit among them)."""
    total = n.sum()
    return total * np.log((n / fit) @ p / total) >= PENALTY * np.log(total + 1)


def _counted(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Slots of a text's trigrams and how often each occurs; None for a text without letters."""
    if text is None or not _LETTER.search(text):
        return None
    counts = slot_counts(text)
    at = np.flatnonzero(counts)
    return at, counts[at].astype(float)


class Mixture:
    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs, self.table = langs, np.ascontiguousarray(np.exp(table).T) if langs else table

    def likeliest(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the CANDIDATES languages that are likeliest by themselves, the first of equal ones, and how likely."""
        alone = n @ np.log(self.table[at])
        best = np.lexsort((np.arange(len(alone)), -alone))[:CANDIDATES]
        return np.sort(best), alone[np.sort(best)]

    def predict(self, text: str | None) -> tuple[str, float]:
        found = _counted(text) if self.langs else None
        if found is None:
            return UNKNOWN, 0.0
        at, n = found
        every = self.table[at]
        some = np.arange(len(self.langs)) if len(self.langs) <= CANDIDATES else self.likeliest(at, n)[0]
        while True:
            best, share, fit = mixed(n, every[:, some])
            more = np.setdiff1d(np.flatnonzero(beyond(n, fit, every)), some) if len(some) < len(self.langs) else some[:0]
            if not len(more):
                return self.langs[some[best]], share
            some = np.union1d(some, more)


def identified(documents: DataFrame, model: Learned, columns: list[str], names: tuple[str, str] = ("_lang", "_score")) -> DataFrame:
    """documents' columns, the prediction and its score under names that none of them has. The table of languages goes out
    once to each executor where it is bounded by LANGUAGES, else block by block."""
    docs = only(documents, *columns)
    if model.languages > LANGUAGES:
        return _by_blocks(docs, model, columns, names)
    shared = documents.sparkSession.sparkContext.broadcast(Mixture(*model.table()))
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=[*columns, *names])

    return docs.mapInArrow(tidy(run), with_fields(docs, **dict(zip(names, ("string", "double"), strict=True))))


def _likeliest(shared):
    """(rid, text) -> (rid, lang, alone): each document's likeliest languages of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = shared.value
        for batch in batches:
            rows: list[tuple] = []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = _counted(text.as_py())
                if found is not None:
                    rows += [(rid, mixture.langs[i], x) for i, x in zip(*mixture.likeliest(*found), strict=True)]
            yield pa.RecordBatch.from_pylist([dict(zip(("rid", "lang", "alone"), r, strict=True)) for r in rows], pa.schema([("rid", pa.int64()), ("lang", pa.string()), ("alone", pa.float64())]))

    return run


def _likelihoods(shared):
    """(rid, text, langs) -> (rid, lang, p): likelihoods of the text's distinct trigrams in some languages of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = shared.value
        place = {lang: i for i, lang in enumerate(mixture.langs)}
        for batch in batches:
            for rid, text, langs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                at, _ = _counted(text.as_py())
                p = [pa.array(mixture.table[at, place[x]]) for x in langs]
                yield pa.RecordBatch.from_arrays([pa.array([rid] * len(langs)), pa.array(langs, pa.string()), pa.array(p, pa.list_(pa.float64()))], names=["rid", "lang", "p"])

    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, text, likely) -> (rid, text, lang, score, fit, langs): the set among the languages whose likelihoods are there."""
    for batch in batches:
        out: list[tuple] = []
        for text, likely in zip(batch.column(1), batch.column(2), strict=True):
            _, n = _counted(text.as_py())
            rows = likely.as_py()
            i, share, fit = mixed(n, np.array([r["p"] for r in rows]).T)
            out.append((rows[i]["lang"], share, fit, [r["lang"] for r in rows]))
        lang, score, fits, langs = zip(*out, strict=True) if out else ((), (), (), ())
        columns = [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(fits, pa.list_(pa.float64())), pa.array(langs, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=["rid", "text", "lang", "score", "fit", "langs"])


def _beyond(shared):
    """(rid, text, fit, langs) -> (rid, lang, p): languages of a block that may still go into a text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = shared.value
        for batch in batches:
            for rid, text, fit, langs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist(), strict=True):
                at, n = _counted(text.as_py())
                every = mixture.table[at]
                known = set(langs)
                more = [i for i in np.flatnonzero(beyond(n, np.array(fit.as_py()), every)) if mixture.langs[i] not in known]
                p = [pa.array(every[:, i]) for i in more]
                yield pa.RecordBatch.from_arrays([pa.array([rid] * len(more), pa.int64()), pa.array([mixture.langs[i] for i in more], pa.string()), pa.array(p, pa.list_(pa.float64()))], names=["rid", "lang", "p"])

    return run


def _by_blocks(docs: DataFrame, model: Learned, columns: list[str], names: tuple[str, str]) -> DataFrame:
    rid = fresh([*columns, *names], "_rid")
    blocks = -(-2 * model.languages // LANGUAGES)  # about half of LANGUAGES in each
    stored = Stored(docs.withColumn(rid, F.monotonically_increasing_id()))
    try:
        texts = stored.df.select(F.col(rid).alias("rid"), "text")

        def each(work, rows_of) -> DataFrame:
            """What work makes of each block's rows, kept."""
            parts = []
            for b in range(blocks):
                shared = docs.sparkSession.sparkContext.broadcast(Mixture(*model.table(b, blocks)))
                if shared.value.langs:
                    parts.append(cut(rows_of(b).mapInArrow(*work(shared))))
                shared.destroy()
            return reduce(DataFrame.unionByName, parts)

        found = each(lambda x: (_likeliest(x), "rid long, lang string, alone double"), lambda b: texts)
        order = Window.partitionBy("rid").orderBy(F.desc("alone"), "lang")  # CANDIDATES rows of each block
        best = cut(found.withColumn("i", F.row_number().over(order)).where(F.col("i") <= CANDIDATES).select("rid", "lang"))
        of_block = lambda b: texts.join(best.where(block_of("lang", blocks) == b).groupBy("rid").agg(F.collect_list("lang").alias("langs")), "rid").select("rid", "text", "langs")
        likely = each(lambda x: (_likelihoods(x), "rid long, lang string, p array<double>"), of_block)
        done: list[DataFrame] = []
        open_ = texts
        while True:
            lists = likely.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("lang", "p"))).alias("likely"))
            solved = cut(open_.join(lists, "rid").select("rid", "text", "likely").mapInArrow(_solved, "rid long, text string, lang string, score double, fit array<double>, langs array<string>"))
            asked = solved.select("rid", "text", "fit", "langs")
            more = each(lambda x: (_beyond(x), "rid long, lang string, p array<double>"), lambda b: asked)  # noqa: B023
            again = cut(more.select("rid").distinct())
            done.append(solved.join(again, "rid", "left_anti").select("rid", "lang", "score"))
            if again.isEmpty():
                break
            open_ = cut(texts.join(again, "rid", "left_semi"))
            likely = cut(likely.join(again, "rid", "left_semi").unionByName(more))
        found = reduce(DataFrame.unionByName, done).select(F.col("rid").alias("_r"), F.col("lang").alias("_l"), F.col("score").alias("_s"))
        whole = stored.df.join(found, F.col(rid) == F.col("_r"), "left")
        return cut(whole.select(*columns, F.coalesce("_l", F.lit(UNKNOWN)).alias(names[0]), F.coalesce("_s", F.lit(0.0)).alias(names[1])))
    finally:
        stored.drop()


def languages(documents: DataFrame) -> DataFrame:
    docs = only(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    found = identified(docs, learn(documents), ["doc_id", "text"])
    return found.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))

"""How far the sources of a language differ in their terms: all pairs of sources, and each source's own terms.

Terms are runs of A-Z, a-z and characters beyond ASCII, A-Z lower-cased. A language keeps the V terms that are in at least
`least` of its documents. A group (language, source) with `count` of a kept term and N of all has p = 1 + floor(10^9 *
(count + 5) / (N + 5 * V)); so has a language. All arithmetic is in whole numbers.

Pairs. The sum of |p - q| over all kept terms starts at V * |p0 - q0|, p0 and q0 being the values of a count of zero, and
only what a posting changes is added. A posting of one group changes its pair with every other group by |p - q0| - |p0 -
q0|: postings of equal p are counted first, so that a group gives one row for each p and partner. A term that two groups
share changes their pair by |p - q| - |p - q0| - |p0 - q| + |p0 - q0|: each term's postings meet, and only what is not zero
goes on. The baseline needs no row for a term, so the work grows with postings, not with terms times groups.

Counting. Each task counts its documents' terms by group and passes them on whenever it holds HELD terms, so its memory is
bounded and a group with a third of all rows is a few rows a task. Postings of a term meet by (language, term).

Nulls in text, language and source count as ''. A group without terms has all pairs, and no terms. Without kept terms
pairs have the value 0. Repeated rows count each; very long texts count whole; ties go by the item's bytes. Extra columns
are ignored, an empty table gives an empty result. At 2^63 occurrences counts would overflow; p is computed in decimals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagelight.llm.common import Stored, cut, only

LEAST, TOP = 30, 50
SCALE, PRIOR = 1_000_000_000, 5
#: Terms that a task holds at most before it passes counts on
HELD = 300_000
#: A-Z become a-z, other ASCII characters than letters become spaces; bytes of other characters stay
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_TERMS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, count, docs), each task's own."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, docs) in held.items():
            found = list(count)
            columns = [pa.repeat(lang, len(found)), pa.repeat(source, len(found)), pa.array(found, pa.binary()), pa.array(list(count.values()), pa.int64()), pa.array([docs[t] for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "docs"])
        held.clear()

    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            found = terms(text.as_py())
            count, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(count)
            count.update(found)
            docs.update(set(found))
            size += len(count)
            if size >= HELD:
                yield from flush()
                size = 0
    yield from flush()


def _p(count: Column, n: Column, v: Column) -> Column:
    whole = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    return 1 + F.call_function("div", whole, (n + PRIOR * v).cast("decimal(20,0)"))


def kept(documents: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, count, total, one): postings of kept terms; total is the language's count, one marks a row a term."""
    each = documents.mapInArrow(_counted, "lang string, source string, term binary, count long, docs long")
    each = each.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")  # a row for each source at most
    every = each.select("lang", "source", "term", "count", F.sum("count").over(of_term).alias("total"), F.sum("docs").over(of_term).alias("in_lang"), F.min("source").over(of_term).alias("first"))
    return every.where(F.col("in_lang") >= least).select("lang", "source", F.col("term").cast("string").alias("term"), "count", "total", (F.col("source") == F.col("first")).alias("one"))


def valued(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Postings with p and q. Groups go out, not postings: stored postings take two bytes each, which Spark would take for their
    size in memory. Groups that matter are fewer than the result's pairs and the languages with `least` documents together."""
    postings = counts.join(F.broadcast(sizes.where("v > 0")), ["lang", "source"])
    return postings.select("lang", "source", "term", "p0", _p(F.col("count"), F.col("n"), F.col("v")).alias("p"), _p(F.col("total"), F.col("n_lang"), F.col("v")).alias("q"))


def audit(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` compares a group with the language's other sources, part `term`
    has the terms that it uses more than its language does."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = only(documents, "text", "lang", "source").select(blank("lang"), blank("source"), F.col("text").cast("binary").alias("text"))
    groups = docs.select("lang", "source").distinct()
    stored = Stored(kept(docs, least))
    try:
        counts = stored.df
        of_group = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
        of_lang = counts.groupBy("lang").agg(F.count_if("one").alias("v"), F.sum("count").alias("n_lang"))
        sizes = groups.join(of_group.hint("merge"), ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0, ["n", "v", "n_lang"])
        sizes = cut(sizes.withColumn("p0", F.when(F.col("v") > 0, _p(F.lit(0).cast("long"), F.col("n"), F.col("v")))))
        postings = valued(counts, sizes)

        above = postings.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # the group limit keeps `top` a task before the shuffle
        above = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

        values = pairs(sizes, postings)
        both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
        beside = values.select("lang", F.explode(both).alias("g"), "value").select("lang", "g.source", F.lit("pair").alias("part"), "g.item", "value").withColumn("rank", F.row_number().over(ranked))
        return cut(above.unionByName(beside))
    finally:
        stored.drop()


def pairs(sizes: DataFrame, postings: DataFrame) -> DataFrame:
    """(lang, a, b, value): each two sources of a language, a < b."""
    apart = lambda x, y: F.abs(F.col(x) - F.col(y))
    left = sizes.select("lang", F.col("source").alias("a"), F.col("p0").alias("a0"), "v")
    right = sizes.select("lang", F.col("source").alias("b"), F.col("p0").alias("b0"))
    every = cut(left.join(right, "lang").where(F.col("a") != F.col("b")))  # as many as the result has
    base = every.where(F.col("a") < F.col("b")).select("lang", "a", "b", F.coalesce(F.col("v") * apart("a0", "b0"), F.lit(0).cast("long")).alias("value"))

    equal = postings.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("n"))
    alone = every.join(equal, ["lang", "a"]).withColumn("value", F.col("n") * (apart("p", "b0") - apart("a0", "b0")))
    alone = alone.where(F.col("value") != 0).select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value")

    side = lambda s: postings.select("lang", "term", F.col("source").alias(s), F.col("p").alias(f"{s}p"), F.col("p0").alias(f"{s}0"))
    shared = side("a").join(side("b"), ["lang", "term"]).where(F.col("a") < F.col("b"))
    shared = shared.withColumn("value", apart("ap", "bp") - apart("ap", "b0") - apart("a0", "bp") + apart("a0", "b0")).where(F.col("value") != 0).select("lang", "a", "b", "value")
    return base.unionByName(alone).unionByName(shared).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST}),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
every AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (({SCALE}::HUGEINT * (coalesce(c.c, 0) + {PRIOR})) // (n.n::HUGEINT + {PRIOR} * v.v)) AS p, 1 + (({SCALE}::HUGEINT * (k.total + {PRIOR})) // (v.n::HUGEINT + {PRIOR} * v.v)) AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) JOIN n USING (lang, source) LEFT JOIN c USING (lang, source, term)
),
sums AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM every x JOIN every y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
found AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM every WHERE c > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""

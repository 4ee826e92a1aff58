"""Document fingerprints by SimHash, in DataFrame operations alone.

Terms are word bigrams of the lower-cased text (the last word closes the text as a term of its own); a term's weight is
how often it occurs. Each term has 128 hash bits and votes +weight or -weight on each; a fingerprint bit is set where
the votes are above zero, so ties and texts without words give zeros.

Fingerprints within a Hamming radius are found by permuted block tables: the bits are cut into radius + SPARE + 1 blocks,
of which at most `radius` can differ, so some choice of SPARE + 1 blocks is equal; there is a table for each choice, keyed
by the bits of its blocks, and queries probe them all. Equal fingerprints are one entry, so copies cost one.

Nulls: a null text counts as the empty text, a null doc_id as smaller than every other id. Repeated rows each stay; where
several rows share an id, the one with the smallest text hash is "the document" that neighbours see. Rows of one id, such
as all without one, are dealt by their texts over SALTS tasks. Very long texts are cut up and count whole, in memory
proportional to their length. Extra columns are ignored. An empty table gives an empty result; the neighbour of a single document is itself.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagelight.llm.common import NULL_KEY, cut, key, only

BITS = 128
#: Radius of the block tables, blocks more than that in a key, and which documents are queries: every fiftieth id
RADIUS, SPARE, EVERY = 3, 1, 50
#: Tasks that the rows of one id are spread over at most: the bits of a positive long
SALTS = 62
#: Votes are counted two to a long; no text has 2^31 terms.
_LANES = 0x0000000100000001


def fingerprints(df: DataFrame, texts: dict[str, str], keys: list[str], extra: list[str]) -> DataFrame:
    """For each row, a fingerprint struct (hi, lo) of each text: texts maps new columns to text columns. Rows are told
    apart by a row number. If df is partitioned by keys, no shuffle follows."""
    keep = [*keys, *extra, "_rid"]
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("t")) for i, c in enumerate(texts.values())])
    rows = df.withColumn("_rid", F.monotonically_increasing_id()).select(*keep, F.explode(sides).alias("_s"))
    rows = rows.select(*keep, F.col("_s.side").alias("_side"), F.split(F.lower("_s.t"), r"\s+").alias("_w"))
    # the word list is used twice here, so it stays a column of its own and is split once a text
    follower = F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1)))
    rows = rows.select(*keep, "_side", F.explode(F.zip_with("_w", follower, lambda w, x: F.when(w != "", F.xxhash64(w, x)))).alias("_h"))
    rows = rows.withColumn("_g", F.when(F.col("_h").isNotNull(), F.xxhash64("_h")))
    # SQL text, as hundreds of Column calls take seconds to build; what is null adds nothing
    lanes = [F.expr(f"sum(shiftrightunsigned({h}, {i}) & {_LANES}L) as {h}{i}") for h in ("_h", "_g") for i in range(32)]
    votes = rows.groupBy(*keep, "_side").agg(F.count("_h").alias("_n"), *lanes)

    def word(h: str) -> Column:
        bits = ", ".join(f"if(2 * (shiftrightunsigned({h}{i}, {32 * lane}) & 4294967295L) > _n, 1L, 0L)" for lane in (1, 0) for i in reversed(range(32)))
        return F.expr(f"aggregate(array({bits}), 0L, (a, b) -> shiftleft(a, 1) | b)")

    prints = votes.select(*keep, "_side", F.struct(word("_h").alias("hi"), word("_g").alias("lo")).alias("_f"))
    return prints.groupBy(*keep).agg(*[F.max(F.when(F.col("_side") == i, F.col("_f"))).alias(name) for i, name in enumerate(texts)]).drop("_rid")


def hex_of(f: str) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f"{f}.hi"), 16, "0"), F.lpad(F.hex(f"{f}.lo"), 16, "0")))


def distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}.hi").bitwiseXOR(F.col(f"{b}.hi"))) + F.bit_count(F.col(f"{a}.lo").bitwiseXOR(F.col(f"{b}.lo")))


def likeness(a: str, b: str) -> Column:
    return 1 - distance(a, b) / F.lit(float(BITS))


def following(ids: DataFrame) -> DataFrame:
    """(k, need, salts) -> (k, need, salts, next): the next larger k, the smallest after the largest. Range partitions are ranked on
    their own; only one row a partition is joined across."""
    parts = cut(ids.repartitionByRange(F.col("k")).withColumn("p", F.spark_partition_id()))
    inner = Window.partitionBy("p").orderBy("k")
    edge = parts.groupBy("p").agg(F.min("k").alias("first"))
    order = Window.orderBy("p")  # one row for each partition
    edge = edge.select("p", F.coalesce(F.lead("first").over(order), F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("over"))
    led = parts.withColumn("n", F.lead("k").over(inner))
    return led.join(edge, "p").select("k", "need", "salts", F.coalesce("n", "over").alias("next"))


def places(bits: str) -> Column:
    """Places of the bits that are set."""
    b = F.col(bits)
    every = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit(b, i) == 1)
    return F.when(F.bit_count(b) == 1, F.array(F.bit_count(b - 1))).otherwise(every)


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last floor(n / 2) code points are replaced by the first
    as many (or all) of the next document's, and how alike they are."""
    # k stands for doc_id from here on: both uses of the shuffled texts below then have the same columns and share it
    docs = only(documents, "doc_id", "text").select(key(F.col("doc_id").cast("long")).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("s", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
    # an id's salts are those of its rows, as bits: one for most ids
    ids = docs.groupBy("k").agg(F.max(F.floor(F.char_length("text") / 2)).alias("need"), F.bit_or(F.expr("shiftleft(1L, s)")).alias("salts"))
    links = cut(following(ids))
    back = links.groupBy(F.col("next").alias("k")).agg(F.max("need").alias("give"), F.first("k").alias("prev"), F.first("salts").alias("prev_salts"))
    link = links.select("k", "next", "salts").join(back, "k").select("k", F.explode(places("salts")).alias("s"), "next", "give", "prev", "prev_salts")
    # one shuffle of the texts, by id and salt; the heads that go to the previous document are half as much
    whole = docs.repartition(F.col("k"), F.col("s")).join(link.hint("shuffle_merge"), ["k", "s"])
    heads = whole.select(F.col("prev").alias("k"), F.explode(places("prev_salts")).alias("s"), F.struct(F.xxhash64("text").alias("x"), F.substring("text", F.lit(1), F.col("give").cast("int")).alias("head")).alias("h"))
    heads = heads.groupBy("k", "s").agg(F.min("h").alias("h")).select("k", "s", F.col("h.head").alias("head"))
    n = F.char_length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    both = whole.join(heads.hint("shuffle_merge"), ["k", "s"]).select(
        "k", "s", "next", n.alias("n_chars"), F.xxhash64("text").alias("x"), "text",
        F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring("head", F.lit(1), half)).alias("edited"),
    )
    both = both.withColumn("sha", F.unhex(F.sha2("edited", 256)))
    found = cut(fingerprints(both, {"f": "text", "e": "edited"}, ["k", "s"], ["next", "n_chars", "x", "sha"]))
    ahead = found.groupBy(F.col("k").alias("nk")).agg(F.min(F.struct("x", "f")).alias("a")).select("nk", F.col("a.f").alias("nf"))
    both = found.join(ahead, F.col("next") == F.col("nk")).drop("nk")
    # every fiftieth document asks for those near it; the rest goes past that join, so that no key is null
    asks = F.col("k") % EVERY == 0
    prints = found.groupBy("f").agg(F.count("*").alias("docs"), F.min(F.when(F.col("k") != NULL_KEY, F.col("k"))).alias("least")).select("f.hi", "f.lo", "docs", "least")
    queries = found.where(asks).select("f.hi", "f.lo").distinct()
    near = within(prints, queries).groupBy("q_hi", "q_lo").agg(F.sum("docs").alias("near_docs"), F.min("least").alias("near_first"))
    asked = both.where(asks).join(near, (F.col("f.hi") == F.col("q_hi")) & (F.col("f.lo") == F.col("q_lo")), "left").drop("q_hi", "q_lo")
    nothing = F.lit(None).cast("long")
    out = asked.unionByName(both.where(~asks).withColumn("near_docs", nothing).withColumn("near_first", nothing))
    return out.select(
        F.when(F.col("k") != NULL_KEY, F.col("k")).alias("doc_id"), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), hex_of("f").alias("fingerprint"), hex_of("e").alias("edited_fingerprint"),
        likeness("f", "e").alias("near_edited"), likeness("f", "nf").alias("near_next"), "near_docs", "near_first",
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(radius: int, spare: int) -> list[tuple[int, int]]:
    """(hi, lo) bits of each table's key: every choice of spare + 1 of radius + spare + 1 blocks."""
    blocks = radius + spare + 1
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    sums = [sum(c) for c in combinations(each, spare + 1)]
    return [(_signed(m >> 64), _signed(m & (1 << 64) - 1)) for m in sums]


def within(index: DataFrame, queries: DataFrame, radius: int = RADIUS, spare: int = SPARE) -> DataFrame:
    """index (hi, lo, ...) and distinct queries (hi, lo) -> index rows within the radius of a query's fingerprint, with
    (q_hi, q_lo) and distance. A pair that agrees in several tables comes from the first of them."""
    masks = block_masks(radius, spare)
    bits = lambda hi, lo, m: (F.col(hi).bitwiseAND(F.lit(m[0])), F.col(lo).bitwiseAND(F.lit(m[1])))
    keys = lambda hi, lo: F.explode(F.array(*[F.struct(F.lit(i).alias("table"), F.xxhash64(F.lit(i), *bits(hi, lo, m)).alias("t")) for i, m in enumerate(masks)]))
    left = index.select("*", keys("hi", "lo").alias("l")).select(*index.columns, F.col("l.table").alias("table"), F.col("l.t").alias("t"))
    right = queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo"), keys("hi", "lo").alias("r")).select("q_hi", "q_lo", F.col("r.t").alias("q_t"))
    apart = F.bit_count(F.col("hi").bitwiseXOR(F.col("q_hi"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("q_lo")))
    agree = lambda m: (F.col("hi").bitwiseXOR(F.col("q_hi")).bitwiseAND(F.lit(m[0])) == 0) & (F.col("lo").bitwiseXOR(F.col("q_lo")).bitwiseAND(F.lit(m[1])) == 0)
    first = F.coalesce(*[F.when(agree(m), F.lit(i)) for i, m in enumerate(masks)])
    met = left.join(right, F.col("t") == F.col("q_t")).withColumn("distance", apart)
    return met.where((F.col("distance") <= radius) & (first == F.col("table"))).drop("t", "q_t", "table")


def halves(fingerprint: str) -> list[Column]:
    """hi and lo of a fingerprint of 32 hex digits."""
    word = lambda at: F.shiftleft(F.conv(F.substring(fingerprint, at, 8), 16, 10).cast("long"), 32).bitwiseOR(F.conv(F.substring(fingerprint, at + 8, 8), 16, 10).cast("long"))
    return [word(1).alias("hi"), word(17).alias("lo")]

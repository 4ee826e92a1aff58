"""Chat formatting with Spark expressions only, and reading the formatted text back.

Turns of a conversation are collected as structs, sorted by turn, and adjacent turns of one role aggregated into one
message each, by slices of the array. A message is a role mark, the texts of its turns with a turn mark between, and an end mark. Control
strings inside texts and roles are escaped by a zero-escape: the escape letter is doubled and the first letter of every
control string is replaced by the escape letter and a code, so that a mark in the output is always a mark, and unescaping
is exact. The loss mask covers texts of the assistant.

Defined cases: null text counts as empty, null role as the empty role, a null turn sorts first and a null conv_id is a
conversation of its own. Turns with equal numbers are ordered by role, then text; repeated rows each stay. A conversation
is one formatted text by contract, so a very long one is one row of that length. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagelight.llm.common import only

ROLE, TEXT, TURN, END = "<|role|>", "<|text|>", "<|turn|>", "<|end|>"
#: Strings that mean something to templates in use; their first letter never appears unescaped in a formatted text.
CONTROL = (ROLE, TEXT, TURN, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"
_ESC = "\\"


def escape(text: Column) -> Column:
    r"""\ becomes \\, < becomes \l, [ becomes \b: no control string can be left, as each begins with < or [."""
    out = F.replace(text, F.lit(_ESC), F.lit(_ESC + _ESC))
    for letter, code in (("<", "l"), ("[", "b")):
        out = F.replace(out, F.lit(letter), F.lit(_ESC + code))
    return out


def unescape(text: Column) -> Column:
    r"""Splits at \\ first, so that a code after a doubled \ is left alone."""
    pieces = F.split(text, r"\\\\", -1)
    plain = lambda p: F.replace(F.replace(p, F.lit(_ESC + "l"), F.lit("<")), F.lit(_ESC + "b"), F.lit("["))
    return F.array_join(F.transform(pieces, plain), _ESC)


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted): one text for each conversation."""
    turns = only(conversations, "conv_id", "turn", "role", "text")
    one = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    role = lambda i: F.get("turns", i)["role"]
    # turns at which another role begins; each message takes the turns up to the next of them
    opens = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == 0) | (role(i) != role(i - 1)))
    opened = chats.select("conv_id", "turns", opens.alias("opens"))
    end = lambda j: F.coalesce(F.get("opens", j + 1), F.size("turns"))
    texts = lambda i, j: F.transform(F.slice("turns", i + 1, end(j) - i), lambda t: escape(t["text"]))
    merged = opened.select("conv_id", F.transform("opens", lambda i, j: F.struct(role(i).alias("role"), F.array_join(texts(i, j), TURN).alias("text"))).alias("messages"))
    message = lambda m: F.concat(F.lit(ROLE), escape(m["role"]), F.lit(TEXT), m["text"], F.lit(END))
    return merged.select("conv_id", F.array_join(F.transform("messages", message), "").alias("formatted"))


def messages(text: Column) -> Column:
    """array<struct<role, texts>> read back from a formatted text."""
    bodies = F.filter(F.split(text, ROLE.replace("|", r"\|"), -1), lambda m: m != "")
    cut = lambda m: F.split(F.substring(m, F.lit(1), (F.char_length(m) - len(END)).cast("int")), TEXT.replace("|", r"\|"), 2)
    split = F.transform(bodies, cut)
    return F.transform(split, lambda p: F.struct(unescape(F.get(p, 0)).alias("role"), F.transform(F.split(F.get(p, 1), TURN.replace("|", r"\|"), -1), unescape).alias("texts")))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what the formatted text alone says: turns, and all text under the loss mask."""
    read = chats.select("conv_id", "formatted", messages(F.col("formatted")).alias("m"))
    turn = lambda m: F.transform(m["texts"], lambda t: F.concat(m["role"], F.lit("\n"), t, F.lit("\n")))
    whole = F.array_join(F.flatten(F.transform("m", turn)), "")
    loss = F.array_join(F.flatten(F.transform(F.filter("m", lambda m: m["role"] == ASSISTANT), lambda m: m["texts"])), "")
    read = read.select("conv_id", "formatted", F.size(F.flatten(F.transform("m", lambda m: m["texts"]))).cast("long").alias("n_turns"), whole.alias("whole"), loss.alias("loss"))
    return read.select(
        "conv_id", "n_turns", F.sha2("whole", 256).alias("turns_sha256"), F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def spans(chats: DataFrame) -> DataFrame:
    """(conv_id, start, length) of each assistant text in the formatted text, in code points from 0, still escaped."""
    marks = "|".join(m.replace("|", r"\|") for m in (ROLE, TEXT, TURN, END))
    parts = chats.select("conv_id", F.posexplode(F.split("formatted", f"(?={marks})", -1)).alias("i", "p"))
    order = Window.partitionBy("conv_id").orderBy("i")
    before = F.coalesce(F.sum(F.char_length("p").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    role = F.last(F.when(F.col("p").startswith(ROLE), F.col("p")), ignorenulls=True).over(order)
    found = parts.select("conv_id", "p", before.alias("before"), role.alias("role"))
    is_text = F.col("p").startswith(TEXT) | F.col("p").startswith(TURN)
    return found.where(is_text & (F.col("role") == ROLE + ASSISTANT)).select("conv_id", (F.col("before") + len(TEXT)).alias("start"), (F.char_length("p") - len(TEXT)).cast("long").alias("length"))


_WIDE = r"(2 * length({0}) - length(replace(replace(replace({0}, '\', ''), '<', ''), '[', '')))"
ORACLE = f"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), plain AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM given),
turns AS (SELECT *, lag(r) OVER w AS before, lead(r) OVER w AS after FROM plain WINDOW w AS (PARTITION BY conv_id ORDER BY turn, r, x))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN before = r THEN {len(TURN)} ELSE {len(ROLE) + len(TEXT)} + {_WIDE.format("r")} END + {_WIDE.format("x")} + CASE WHEN after = r THEN 0 ELSE {len(END)} END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context, and only its reply lies under the loss mask. A conversation that
does not end with an assistant turn gets one more example, the whole
conversation with an empty mask, so that no turn is missing in the output.

Template: a turn is ``<|turn|>role\\n text <|end|>\\n`` (no blanks around the
text). Control strings (the template's own and those of common chat formats)
are broken inside roles and texts by ``\\.`` after their first character;
backslashes are doubled, so ``unescape`` gives back the very text.

Spark functions throughout. Rows are escaped where they are read; one shuffle
brings a conversation's turns together, because its text is one value: a
conversation must fit into a task, any number of them need not. The output
holds each context written out, as the method demands, so it grows with the
square of the number of turns of one conversation and linearly with the
number of conversations.

Defined results: turns are ordered by turn (NULL first), then role, then
text; NULL text or role is empty; repeated rows are turns of their own; a
NULL conv_id is a conversation; an empty table gives an empty output; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import relation, staged

TURN, END = "<|turn|>", "<|end|>\n"
# First characters of control strings: <|...|>, <s>, </s>, <<SYS>>, <</SYS>>, [INST], [/INST].
CONTROL = r"(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1$3\\.$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\)|\\\.", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # Pairs of characters from the left, so a doubled backslash before n stays one.
    return F.regexp_replace(F.regexp_replace(role, r"\G((?:[^\\]|\\[^n])*+)\\n", "$1\n"), r"\\(\\)|\\\.", "$1")


def prefix_target_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                           role_col: str = "role", text_col: str = "text",
                           trained_role: str = "assistant") -> DataFrame:
    """One row per example: conv_id, example (turns it holds), text, and the
    loss mask as characters ``loss_start`` (from 0) to ``loss_end`` (exclusive)."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                 F.concat(F.lit(TURN), escape_role(F.col(role_col)), F.lit("\n")).alias("head"),
                 escape(F.col(text_col)).alias("body")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = whole.withColumn("pieces", F.transform(
        "turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))))

    def example(t: Column, i: Column) -> Column:
        text = F.array_join(F.slice(F.col("pieces"), F.lit(1), i + 1), "")
        end = F.length(text) - len(END)
        trained = t["role"] == trained_role
        return F.struct((i + 1).cast("long").alias("example"), text.alias("text"),
                        F.when(trained, end - F.length(t["body"])).otherwise(end).cast("long").alias("loss_start"),
                        end.cast("long").alias("loss_end"))

    last = F.size("turns") - 1
    made = F.filter(F.transform("turns", lambda t, i: F.when(
        (t["role"] == trained_role) | (i == last), example(t, i))), lambda e: e.isNotNull())
    return pieces.select("conv_id", F.inline(made))


def read_back(examples: DataFrame) -> DataFrame:
    """Digests of what the examples hold, parsed from their texts alone."""
    loss = F.expr("substr(text, CAST(loss_start + 1 AS INT), CAST(loss_end - loss_start AS INT))")
    by_conv = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("full"),
        F.sort_array(F.collect_list(F.struct("example", loss.alias("loss")))).alias("losses"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"))
    parts = F.split(F.col("full"), r"<\|end\|>\n")
    heads = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1),
                        lambda p: F.substr(p, F.lit(len(TURN) + 1)))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        return F.concat(unescape_role(role), F.lit("\n"), unescape(F.substr(p, F.length(role) + 2)), F.lit("\n"))

    parsed = by_conv.withColumn("parsed", F.transform(heads, turn)).withColumn(
        "trained", F.array_join(F.transform("losses", lambda x: unescape(x["loss"])), ""))
    return parsed.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join("parsed", ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"), "formatted_chars")


def op6_chat_examples(spark, sf_dir):
    """All conversations and one whose texts are control strings, written as
    examples and read back."""
    turns = relation(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
        for i, role in enumerate(("user", "assistant"))])))
    return read_back(staged(prefix_target_examples(turns.unionByName(probe)), "examples"))


OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                                  (-7, 1, 'assistant', '</s>[INST] ok [/INST]')) v),
chars AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
         8 + length(role) + 1 + length(text) + 8
         + length(role || text) - length(replace(role || text, '\', ''))
         + 2 * len(regexp_extract_all(text, '(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])')) AS piece
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sums AS (
  SELECT *, sum(piece) OVER (PARTITION BY conv_id ORDER BY place) AS prefix FROM chars)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (WHERE role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
FROM sums GROUP BY conv_id
"""

QUERIES = {"op6_chat_examples": op6_chat_examples}
ORACLE = {"op6_chat_examples": OP6_SQL}

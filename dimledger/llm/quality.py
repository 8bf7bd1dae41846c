"""Quality rules: a threshold table compiled into one Spark projection.

``QUALITY_RULES`` names ratios and the range each must lie in.
``quality_rules`` computes the ratios of every whole text with Spark's own
functions (no user function, no shuffle, nothing but one pass over the rows)
and ANDs the table into ``kept``.

``CLEAN_RULES`` is the table of ``keep_good`` and so of the pipeline. It
measures repeated lines by their share of characters, since a share of lines
rejects a clean text of few lines whose short first line stands again at the
end, and judges stop words only where the text's language is one they belong
to. The registered query keeps ``QUALITY_RULES``, the table of its SQL.

Defined results: a NULL or empty text has 0 words and fails the base rule; a
ratio whose denominator is 0 is 0; repeated rows are judged one by one; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.llm.common import SPACE, relation, word_array

# Stop words of the four languages of the corpus; a word counts in lower case
# or with a capital first letter.
STOP_WORDS = ("the of and to in is that a la el que y en los las de le les et des un une du "
                        "der die das und zu den von ist ein").split()
LANGUAGES = r"^(en|es|fr|de)([-_]|$)"    # theirs, by code


STOP_FORMS = STOP_WORDS + [w.capitalize() for w in STOP_WORDS]


@dataclass(frozen=True)
class Rule:
    """``low <= ratio <= high``; None leaves a side open."""

    ratio: str
    low: float | None = None
    high: float | None = None


QUALITY_RULES = (
    Rule("mean_word_chars", 2.0, 12.0),      # length
    Rule("symbols_per_word", None, 0.1),     # symbols
    Rule("stop_word_ratio", 0.03, None),     # stop words
    Rule("dup_line_ratio", None, 0.3),       # lines
)
# On sf0.1 the labelled clean documents reach 0.14 in repeated lines' characters.
CLEAN_RULES = (*QUALITY_RULES[:3], Rule("dup_char_ratio", None, 0.3))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def _characters(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0), lambda acc, x: acc + F.length(x))


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are (hash, position) pairs sorted once; neighbours with an equal
    hash are repeats, and each repeat covers three positions. Texts in which
    all windows differ, the usual case, skip the sort.
    """
    hashes = F.transform(F.sequence(F.lit(0), n - 3),
                         lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.aggregate(
            F.array(ranked),
            F.lit(0),
            lambda acc, r: F.size(F.array_distinct(F.flatten(F.transform(
                F.filter(r, lambda x, k: (F.get(r, k - 1)["h"] == x["h"])
                         | (F.get(r, k + 1)["h"] == x["h"])),
                lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))

    return F.when(n < 4, F.lit(0)).otherwise(F.aggregate(
        F.array(hashes), F.lit(0),
        lambda acc, h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = QUALITY_RULES,
                  id_col: str = "doc_id", text_col: str = "text",
                  carry: tuple[str, ...] = (), lang_col: str | None = None) -> DataFrame:
    """Base counts, ratios, ``base_failed`` and ``kept`` of every document.

    ``carry`` names input columns to hand through unchanged (a struct
    ``carried``), so that a filtering stage needs no join. With ``lang_col``
    the stop-word rule judges only rows whose language has stop words here.
    ``dup_char_ratio`` is a column only where a rule asks for it.
    """
    by_chars = any(rule.ratio == "dup_char_ratio" for rule in rules)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                         F.struct(*[F.col(c) for c in carry]).alias("carried") if carry
                         else F.lit(0).alias("carried"),
                         (F.coalesce(F.regexp_like(F.lower(F.trim(F.col(lang_col))), F.lit(LANGUAGES)), F.lit(False))
                          if lang_col else F.lit(True)).alias("stop_words_known"))
    words = source.withColumn("w", word_array(F.col("t")))
    n = F.size("w")
    lines = F.filter(F.split("t", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    counted = words.select(
        "doc_id", "carried", "stop_words_known", "w", n.alias("n"),
        F.length(F.regexp_replace("t", SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"))
    measured = counted.select(
        "doc_id", "carried", "stop_words_known", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w"), F.col("n")).cast("long").alias("n_repeat_words"),
        F.size(F.filter("w", lambda x: x.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
        *([_characters(F.col("lines")).alias("line_chars"),
           _characters(F.array_distinct("lines")).alias("own_line_chars")] if by_chars else []))
    ratios = measured.select(
        "*",
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbols_per_word"),
        _ratio(F.col("n_stop_words"), F.col("n_words")).alias("stop_word_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        *([_ratio(F.col("line_chars") - F.col("own_line_chars"), F.col("line_chars")).alias("dup_char_ratio")]
          if by_chars else []),
        ((F.col("n_words") < 50)
         | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)).alias("base_failed"))
    verdict = ~F.col("base_failed")
    for rule in rules:
        exempt = ~F.col("stop_words_known") if rule.ratio == "stop_word_ratio" and lang_col else F.lit(False)
        if rule.low is not None:
            verdict = verdict & (exempt | (F.col(rule.ratio) >= rule.low))
        if rule.high is not None:
            verdict = verdict & (exempt | (F.col(rule.ratio) <= rule.high))
    out = ratios.withColumn("kept", verdict).drop("line_chars", "own_line_chars", "stop_words_known")
    return out if carry else out.drop("carried")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = CLEAN_RULES) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with their columns unchanged; a
    column ``lang`` tells whose stop words a text is held against.

    A generator rather than a filter: a filter on ``kept`` would be pushed
    below the projection, each of its measures written out again inside it.
    """
    judged = quality_rules(docs, rules, carry=tuple(docs.columns), lang_col="lang" if "lang" in docs.columns else None)
    return judged.select(F.inline(F.when(F.col("kept"), F.array("carried"))))


def op3_quality_rules(spark, sf_dir):
    return quality_rules(relation(spark, sf_dir, "documents"))


def _stop_list() -> str:
    return ", ".join(f"'{w}'" for w in STOP_FORMS)


OP3_SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
tok AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM base),
pos AS (
  SELECT rid, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM tok),
tri AS (
  SELECT rid, i, a, lead(a, 1) OVER by_text AS b, lead(a, 2) OVER by_text AS c
  FROM pos WINDOW by_text AS (PARTITION BY rid ORDER BY i)),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS times FROM tri WHERE c IS NOT NULL),
rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM win WHERE times > 1) GROUP BY rid),
cnt AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(w, lambda x: x IN ({_stop_list()}))) AS BIGINT) AS n_stop_words
  FROM tok LEFT JOIN rep USING (rid)),
rat AS (
  SELECT *,
    CASE WHEN n_words > 0 THEN CAST(word_chars AS DOUBLE) / n_words ELSE 0.0::DOUBLE END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN CAST(n_symbols AS DOUBLE) / n_words ELSE 0.0::DOUBLE END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN CAST(n_stop_words AS DOUBLE) / n_words ELSE 0.0::DOUBLE END AS stop_word_ratio,
    CASE WHEN n_lines > 0 THEN CAST(n_dup_lines AS DOUBLE) / n_lines ELSE 0.0::DOUBLE END AS dup_line_ratio,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed
  FROM cnt)
SELECT *, (NOT base_failed AND mean_word_chars >= 2.0 AND mean_word_chars <= 12.0
           AND symbols_per_word <= 0.1 AND stop_word_ratio >= 0.03 AND dup_line_ratio <= 0.3) AS kept
FROM rat
"""

QUERIES = {"op3_quality_rules": op3_quality_rules}
ORACLE = {"op3_quality_rules": OP3_SQL}

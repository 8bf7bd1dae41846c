"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a trend: its sampling rate at training time
``t`` in [0, 1] is ``target * (1 + trend * (2t - 1))``. Integrated, the source
has taken ``target * D(t)`` words by time t, ``D(t) = t + trend * (t*t - t)``.
A document that fills words ``[a, b)`` of its source's demand stands at the
time when half of it is taken: D inverted at ``(a + b) / 2 / target``, which
is a root of a quadratic. Documents are range-sorted by that position.

Targets: the sources share the words of the corpus by weight; a target stops
at ``max_epochs`` times the source's size and the excess is shared again by
weight until no target is above (``source_targets``). The order of documents
inside a source is that of md5 over the seed and doc_id, repeated for every
epoch. A copy is taken if its middle lies below the target, so a source's
taken words differ from its target by half a document at most.

Flow: sizes are counted by Spark functions; one range shuffle of narrow rows
(no texts) by (source, md5) and sums per range give each document the words
before it. A source of any share of the rows is spread over the ranges; no
group is gathered.

Defined results: NULL text has size 0; NULL source is a source (last in
order); repeated rows count each, in the order of their text's md5; an empty
table gives an empty result; a document of size 0 stands in the mix as often
as its place says and takes 0 words. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimledger.llm.common import relation, staged, word_count

WEIGHTS = (1, 2, 3)          # by source in order, repeating
TRENDS = (-0.5, 0.0, 0.5)    # of the weights above: heavy sources come late
MAX_EPOCHS = 3
SEED = "mix-1"


def _cycle(index: Column, values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def running_sum(df: DataFrame, order: list[str], group: str, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same ``group``
    before each row in ``order`` (which starts with the group).

    Rows are cut into ranges of the order, written once; a window per range
    and the summed totals of earlier ranges add up. No window spans more than
    a range, whatever a group's share of the rows.
    """
    ranged = staged(df.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(group, "range_no").agg(F.sum(value).alias("range_total"))
    earlier = Window.partitionBy(group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col(group).alias("of_group"), F.col("range_no").alias("of_range"),
                          F.coalesce(F.sum("range_total").over(earlier), F.lit(0)).alias("base"))
    within = (Window.partitionBy("range_no", group).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    summed = ranged.withColumn("inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
    joined = summed.join(bases, F.col(group).eqNullSafe(F.col("of_group"))
                         & (F.col("range_no") == F.col("of_range")), "left")
    return joined.withColumn(out, F.col("base") + F.col("inside")).drop(
        "range_no", "of_group", "of_range", "base", "inside")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, trends: tuple = TRENDS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: size, weight, trend and target. One row per source.

    A source is capped once the level (words per weight) passes
    ``max_epochs * size / weight``; sources sorted by that point, the level
    after capping the first k is the words left over the weight left, and the
    first source that stays below its point ends the capping.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on: the windows below are over that list.
    everyone = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = (total.withColumn("place", F.row_number().over(everyone) - 1)
               .select("source", "source_size",
                       _cycle(F.col("place"), weights).cast("long").alias("weight"),
                       _cycle(F.col("place"), trends).cast("double").alias("trend")))
    point = (F.lit(max_epochs) * F.col("source_size")).cast("double") / F.col("weight")
    before = Window.orderBy("point", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (weighed.withColumn("point", point)
              .withColumn("words_left", F.sum("source_size").over(whole) - F.coalesce(
                  F.sum(F.lit(max_epochs) * F.col("source_size")).over(before), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(
                  F.sum("weight").over(before), F.lit(0)))
              .withColumn("level", F.col("words_left").cast("double") / F.col("weight_left")))
    final = F.min(F.when(F.col("level") <= F.col("point"), F.struct("point", "level"))).over(whole)["level"]
    capped = F.lit(max_epochs).cast("double") * F.col("source_size")
    return (levels.withColumn("final", final)
            .select("source", "source_size", "weight", "trend",
                    F.least(F.coalesce(F.col("final") * F.col("weight"), capped), capped).alias("target")))


def curriculum_mix(docs: DataFrame, weights: tuple = WEIGHTS, trends: tuple = TRENDS,
                   max_epochs: int = MAX_EPOCHS, seed: str = SEED,
                   id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, row_key, size, source_size, target,
    taken, and ``positions`` (a training position in [0, 1] for every copy)."""
    row_key = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"), row_key.alias("row_key"),
                        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    placed = staged(running_sum(sizes, ["source", "row_key", "text_key"], "source", "size", "ahead"), "placed")
    targets = source_targets(placed, weights, trends, max_epochs).withColumnRenamed("source", "of_source")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("of_source")), "left")
    middle = F.col("ahead") + F.col("size") / 2.0
    copies = F.when(F.col("source_size") > 0, F.greatest(F.lit(0), F.least(
        F.lit(max_epochs), F.ceil((F.col("target") - middle) / F.col("source_size"))))).otherwise(F.lit(0)).cast("int")

    def position(copy: Column) -> Column:
        u = F.least(F.lit(1.0), (copy * F.col("source_size") + middle) / F.col("target"))
        # t + k (t^2 - t) = u  =>  k t^2 + (1 - k) t - u = 0; the form below holds for k = 0 too.
        k = F.col("trend")
        return 2 * u / ((1 - k) + F.sqrt((1 - k) * (1 - k) + 4 * k * u))

    return (joined.withColumn("copies", copies)
            .select("doc_id", "source", "row_key", "text_key", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken"),
                    F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position))
                    .otherwise(F.array().cast("array<double>")).alias("positions")))


def training_order(mix: DataFrame) -> DataFrame:
    """Every copy of every taken document, range-sorted by training position."""
    return (mix.select("*", F.posexplode("positions").alias("copy", "position")).drop("positions")
            .orderBy("position", "row_key", "text_key", "copy"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in training order, columns of ``docs`` unchanged:
    a row for every copy taken.

    Texts move once, to their place in the order: the narrow mix is joined on
    the keys it was made from. Rows equal in doc_id and text share those keys;
    ``turn`` tells them apart so that each keeps its own copies.
    """
    keys = ["row_key", "text_key", "of_source"]
    seed = options.get("seed", SEED)
    mix = curriculum_mix(docs, **options)
    per_key = Window.partitionBy("row_key", "text_key", "source").orderBy("positions")
    taken = (mix.withColumn("turn", F.row_number().over(per_key)).filter(F.size("positions") > 0)
             .select(F.col("row_key").alias("k1"), F.col("text_key").alias("k2"), F.col("source").alias("k3"),
                     F.col("turn").alias("k4"), "positions"))
    named = docs.select(F.struct(*docs.columns).alias("row"), F.md5(F.concat(
        F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("row_key"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), F.col("source").alias("of_source"))
    numbered = named.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy("row_key")))
    joined = numbered.join(taken, (F.col("row_key") == F.col("k1")) & (F.col("text_key") == F.col("k2"))
                           & F.col("of_source").eqNullSafe(F.col("k3")) & (F.col("turn") == F.col("k4")))
    return (joined.select("row", "row_key", "text_key", F.explode("positions").alias("position"))
            .orderBy("position", "row_key", "text_key").select("row.*"))


def op5_curriculum_mix(spark, sf_dir):
    """Per document what the mix takes, in the order of first training position."""
    mix = curriculum_mix(relation(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken",
                      F.size("positions").cast("long").alias("copies"),
                      F.get("positions", F.lit(0)).alias("first_position")).orderBy("first_position", "doc_id")


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS rk,
         md5(coalesce(text, '')) AS tk,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rk, tk
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM docs),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM docs GROUP BY source),
wts AS (
  SELECT source, source_size, place % 3 + 1 AS w, (place % 3 - 1) * 0.5::DOUBLE AS k FROM src),
-- A set of capped sources is right if the level it leaves caps these and no others.
lim AS (
  SELECT a.source, CAST(a.source_size * 3 AS DOUBLE) / a.w AS lim FROM wts a),
cand AS (
  SELECT l.lim AS cut,
         CAST((SELECT sum(source_size) FROM wts)
              - (SELECT coalesce(sum(3 * x.source_size), 0) FROM wts x
                 WHERE CAST(x.source_size * 3 AS DOUBLE) / x.w < l.lim) AS DOUBLE)
         / (SELECT sum(x.w) FROM wts x WHERE CAST(x.source_size * 3 AS DOUBLE) / x.w >= l.lim) AS level
  FROM (SELECT DISTINCT lim FROM lim) l),
fin AS (SELECT level FROM cand WHERE level <= cut ORDER BY cut LIMIT 1),
tgt AS (
  SELECT source, source_size, k,
         least(coalesce((SELECT level FROM fin) * w, 3.0::DOUBLE * source_size), 3.0::DOUBLE * source_size) AS target
  FROM wts),
mid AS (
  SELECT doc_id, size, source_size, target, k, CAST(ahead AS DOUBLE) + size / 2.0::DOUBLE AS m
  FROM placed p JOIN tgt t ON p.source IS NOT DISTINCT FROM t.source),
cop AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN greatest(0, least(3, CAST(ceil((target - m) / source_size) AS BIGINT))) ELSE 0 END AS copies
  FROM mid)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies,
       CASE WHEN copies > 0 THEN 2 * least(1.0::DOUBLE, m / target)
            / ((1 - k) + sqrt((1 - k) * (1 - k) + 4 * k * least(1.0::DOUBLE, m / target))) END AS first_position
FROM cop
"""

QUERIES = {"op5_curriculum_mix": op5_curriculum_mix}
ORACLE = {"op5_curriculum_mix": OP5_SQL}

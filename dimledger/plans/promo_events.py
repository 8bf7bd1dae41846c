"""Promo states with expiry as events, instead of rewriting stored states.

Below one root:

* ``states`` (by ``load_date``): the promo states of each day, replaced by a rerun
  of that day only;
* ``due`` (by ``due_month`` and ``load_date``): the unused promos of each load by
  the month in which they end, so that a day's expiry reads one month's
  promos and never the states;
* ``changes`` (by ``changed_on``): the status changes that a day's expiry made.

``promo_states`` folds the changes into the states at read time. ``compact``
folds them into the stored states of old load dates, which bounds the changes
that a read joins. A promo state is named by promo and load date.

NULL end dates never expire, nor do promos without an id, which no change can
name. A change whose state was used or is gone
after its day was loaded again has no effect. Before the first load there is
no table and ``promo_states`` raises.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimledger.plans.promo import EXPIRED
from dimledger.sources.sinks import read_if_exists, replace_partition, staged, write_partition

__all__ = ["store_states", "expire_day", "promo_states", "compact"]

CHANGE = "promocode_id string, state_date date, new_status string, changed_on date"


def _paths(root: str) -> tuple[str, str, str]:
    return tuple(f"{root.rstrip('/')}/{n}" for n in ("states", "due", "changes"))


def _month(day) -> Column:
    return F.date_format(day, "yyyy-MM")


def _fold(states: DataFrame, changes: DataFrame) -> DataFrame:
    made = (changes.groupBy(F.col("promocode_id").alias("_id"), "state_date")
            .agg(F.max_by("new_status", "changed_on").alias("_new")))
    j = states.join(made, (F.col("promocode_id") == F.col("_id")) & (F.col("load_date") == F.col("state_date")), "left")
    return j.withColumn("status", F.coalesce("status", "_new")).select(*states.columns)


def store_states(state: DataFrame, root: str, day: _dt.date) -> None:
    """Make ``state`` the promo states of ``day`` (columns ``promocode_id``,
    ``status``, ``end_date`` and any others). Promos of the day that were
    compacted as expired stay so."""
    spark = state.sparkSession
    states, due, _ = _paths(root)
    before = read_if_exists(spark, f"{states}/load_date={day.isoformat()}")
    if before is not None:
        was = before.where(F.col("status") == EXPIRED).select(F.col("promocode_id").alias("_id"),
                                                              F.col("status").alias("_was")).distinct()
        state = (state.join(was, F.col("promocode_id") == F.col("_id"), "left")
                 .withColumn("status", F.coalesce("status", "_was")).drop("_id", "_was"))
    with staged(state) as copy:
        replace_partition(copy, states, "load_date", day.isoformat())
        open_ = (copy.where(F.col("status").isNull() & F.col("end_date").isNotNull())
                 .select("promocode_id", "end_date", _month("end_date").alias("due_month"),
                         F.lit(day).alias("load_date")))
        # Few files a month, and a month that holds most promos is split by its bytes.
        write_partition(open_.hint("rebalance", "due_month"), due, ["due_month", "load_date"])


def expire_day(spark: SparkSession, root: str, day: _dt.date) -> None:
    """Record that the unused promos that end on ``day`` expired, in place of what an
    earlier run recorded for the day. Reads one month of ``due``."""
    _, due, changes = _paths(root)
    table = read_if_exists(spark, due)
    if table is None:
        return
    ends = (table.where((F.col("due_month") == f"{day:%Y-%m}") & (F.col("end_date") == F.lit(day)))
            .select("promocode_id", F.col("load_date").alias("state_date"), F.lit(EXPIRED).alias("new_status")))
    replace_partition(ends.distinct(), changes, "changed_on", day.isoformat())


def _changes(spark: SparkSession, root: str) -> DataFrame:
    table = read_if_exists(spark, _paths(root)[2])
    return spark.createDataFrame([], CHANGE) if table is None else table


def promo_states(spark: SparkSession, root: str) -> DataFrame:
    """All promo states with the changes folded in."""
    return _fold(spark.read.parquet(_paths(root)[0]), _changes(spark, root))


def compact(spark: SparkSession, root: str, through: _dt.date) -> None:
    """Fold the changes of states loaded up to ``through`` into the stored states
    and drop them. Only load dates that have changes are rewritten. States are
    written before changes are dropped; folding a change twice does nothing,
    so a compaction that failed is run again."""
    states, _, changes = _paths(root)
    old = F.col("state_date") <= F.lit(through)
    made = _changes(spark, root)
    dates = made.where(old).select(F.col("state_date").alias("load_date")).distinct()
    stored = spark.read.parquet(states).join(dates, "load_date", "left_semi")
    with staged(_fold(stored, made)) as copy:
        write_partition(copy, states, ["load_date"])
    # One partition for each day that had old changes: days, not rows.
    for (day,) in made.where(old).select("changed_on").distinct().collect():
        with staged(made.where(~old & (F.col("changed_on") == F.lit(day)))) as copy:
            replace_partition(copy, changes, "changed_on", day.isoformat())

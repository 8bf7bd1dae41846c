"""Daily promo-code state and per-specification totals.

* ``specs``   specification_id, title, created
* ``coupons`` coupon_id, code, active, specification_id, end, start, limit
  (``start``/``end`` may be text; bad text reads as NULL)
* ``ops``     op_id, coupon_id, status, updated, user_id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.functions.columns import day_bounds, in_window, lenient_timestamp
from dimledger.operators.relational import latest_per_key
from dimledger.sources.schemas import PROMO_STATS, SPEC_STATS, conform
from dimledger.sources.sinks import expire

__all__ = ["specs_since", "coupons_of", "spec_stats", "promo_state", "expire_status",
           "USED", "ABORTED", "CANCELED", "EXPIRED"]

# Operation statuses of the promo service (fixed values):
USED, ABORTED, CANCELED, EXPIRED = "used", "aborted", "canceled", "expired"


def specs_since(specs: DataFrame, created_from: Column) -> DataFrame:
    return specs.where(F.col("created") >= created_from).select("specification_id", "title")


def coupons_of(coupons: DataFrame, specs: DataFrame) -> DataFrame:
    """Coupons of the given specifications (a semi-join, no fan-out)."""
    return coupons.join(specs.select("specification_id"), "specification_id", "left_semi")


def spec_stats(coupons: DataFrame, specs: DataFrame) -> DataFrame:
    """Per specification: number of coupons and the sum of their usage limits."""
    c = coupons_of(coupons, specs)
    totals = (c.where(F.col("specification_id").isNotNull())
              .groupBy("specification_id")
              .agg(F.count("coupon_id").alias("unique_promo_cnt"),
                   F.coalesce(F.sum("limit"), F.lit(0)).alias("user_limit")))
    titles = specs.select("specification_id", F.col("title").alias("specification_title"))
    return conform(totals.join(titles, "specification_id", "left"), SPEC_STATS)


def promo_state(coupons: DataFrame, ops: DataFrame, day) -> DataFrame:
    """Coupons created on ``day`` or operated on that day, with the day's state.

    Of the day's operations, a cancellation always counts; of ``used`` and
    ``aborted`` operations on active coupons only the last per coupon and
    user counts (ties broken by operation id, D-27), and only when it is
    ``used``. The day is the half-open ``[day, day + 1)`` (D-24).

    The coupon table is large and scanned whole; one day of operations is
    small. Adaptive execution broadcasts the day's operations where their bytes
    allow it, so the coupon table need not be shuffled. The operation → coupon lookup is an inner join: an operation on an
    unknown coupon can only be a cancellation, which the final join from the
    coupon side drops anyway.
    """
    lo, hi = day_bounds(day)
    day_ops = ops.where(in_window("updated", lo, hi)).select("op_id", "coupon_id", "status", "updated", "user_id")
    o = coupons.select("coupon_id", "active").join(day_ops, "coupon_id")
    attempts = o.where(F.col("status").isin(USED, ABORTED) & (F.col("active") == F.lit(True)))
    last = latest_per_key(attempts, ["coupon_id", "user_id"], ["updated", "op_id"])
    kept = (o.where(F.col("status") == CANCELED)
            .unionByName(last.where(F.col("status") == USED))
            .select("coupon_id", "status", "updated"))
    p = coupons.join(kept, "coupon_id", "left")
    start, end, upd = lenient_timestamp("start"), lenient_timestamp("end"), lenient_timestamp("updated")
    p = p.where(in_window(start, lo, hi) | in_window(upd, lo, hi))
    return conform(p.select(F.col("coupon_id").alias("promocode_id"), "code", "specification_id",
                            "status", upd.cast("date").alias("updated_date"),
                            end.cast("date").alias("end_date"),
                            start.cast("date").alias("start_date")), PROMO_STATS)


def expire_status(promos: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Promos whose end date falls in the window and that were never used
    become ``expired``."""
    return expire(promos, "end_date", lo, hi, "status", EXPIRED)


def daily_promo_run(spark, coupons: DataFrame, ops: DataFrame, specs: DataFrame, day,
                    stats_root: str, spec_root: str, created_from: Column) -> None:
    """One day of the promo tables, rerun-safe.

    * the day's states of the promos of recent specifications (created since
      ``created_from``) replace the ``load_date=<day>`` partition of
      ``stats_root`` (D-25: a rerun leaves one copy, or none if the day is now
      empty); promos that a later run marked ``expired`` stay so;
    * promos that end on ``day`` and were never used become ``expired``; only
      the partitions holding such rows are rewritten, staged through the
      checkpoint folder because the table is read and written by one job;
    * the spec totals are written to a new version of ``spec_root`` and
      published.
    """
    import datetime as _dt

    from dimledger.sources.sinks import (new_version_path, publish, read_if_exists, replace_partition, staged,
                                         write_partition)

    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    recent = specs_since(specs, created_from)
    state = promo_state(coupons_of(coupons, recent), ops, day)
    before = read_if_exists(spark, f"{stats_root.rstrip('/')}/load_date={day.isoformat()}")
    if before is not None:
        gone = before.where(F.col("status") == EXPIRED).select("promocode_id", F.lit(EXPIRED).alias("_was")).distinct()
        state = (state.join(gone, "promocode_id", "left")
                 .withColumn("status", F.coalesce("status", "_was")).drop("_was"))
    with staged(state) as copy:
        replace_partition(copy, stats_root, "load_date", day.isoformat())

    table = spark.read.parquet(stats_root)
    lo, hi = F.lit(day), F.lit(day + _dt.timedelta(days=1))
    due = (F.col("end_date") >= lo) & (F.col("end_date") < hi) & F.col("status").isNull()
    touched = table.where(due).select("load_date").distinct()
    rewritten = expire_status(table.join(touched, "load_date", "left_semi"), lo, hi)
    with staged(rewritten) as copy:
        write_partition(copy, stats_root, ["load_date"])

    totals = spec_stats(coupons, recent)
    path = new_version_path(spec_root, day)
    totals.write.mode("overwrite").parquet(path)
    publish(spark, spec_root, path)

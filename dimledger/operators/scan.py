"""Ordered scans per key that stay parallel when one key is hot.

``Window.partitionBy(key)`` sends every row of a key to one task; with a key
that holds a third of the data that task is the whole job. ``carry_last``
therefore splits only the keys that are hot:

1. a row count, by slots of keys and then for the keys of full slots, finds
   the keys with more than ``hot_rows`` rows. There are at most
   ``total_rows / hot_rows`` of them, which bounds the broadcast that tags
   them;
2. rows of hot keys get a bucket (a slice of the first order column, e.g.
   the hour), all other keys keep one bucket, and the window runs per
   ``(key, bucket)``;
3. for hot keys, ``max_by`` per ``(key, bucket)`` keeps the last value of
   every bucket, and a window over those one-row-per-bucket summaries (small
   even for the hottest key) finds the value carried into each bucket;
4. that carried value is put in front of its bucket as an extra row, so the
   per-bucket window picks it up; the extra rows are dropped afterwards.

The result equals a plain ``Window.partitionBy(key)`` scan exactly, and the
data is shuffled once. Whether any key is hot is checked first with one
small job (counts of slots; the numbers of full ones go to the driver); with
no hot key the plain window is used and none of the above is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["carry_last", "hot_keys", "with_previous", "with_next", "day_bucket", "HOT_ROWS"]

# Keys with more rows than this are split into time buckets.
HOT_ROWS = 2_000_000
# Keys are counted together in so many slots first.
SLOTS = 4096


def day_bucket(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("day", c)


def _sorted(cols: list[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in cols]


def hot_keys(df: DataFrame, key: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows (at most ``rows / hot_rows`` of
    them), or None when there is none. Slots of keys are counted first, a few
    thousand numbers per task; only the keys of slots that could hold a hot
    one are counted each."""
    slot = F.pmod(F.xxhash64(*key), F.lit(SLOTS))
    full = [r["slot"] for r in df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > hot_rows).select("slot").collect()]
    if not full:
        return None
    hot = ((df if len(full) == SLOTS else df.where(slot.isin(full)))
           .groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > hot_rows).select(*key, F.lit(True).alias("_hot")))
    return None if hot.isEmpty() else hot


_AUTO = object()


def carry_last(df: DataFrame, key: list[str], order: list[str], value: str, out: str,
               include_current: bool = True, reverse: bool = False,
               bucket: str | None = "hour", hot_rows: int = HOT_ROWS,
               hot=_AUTO) -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or before each row.

    Rows are ordered by ``order`` within ``key`` (descending when ``reverse``,
    which turns "last before" into "first after"). With ``include_current``
    false the row itself is not looked at. ``order`` should be unique within
    a key. ``bucket`` is the ``date_trunc`` unit used to split hot keys
    (``None`` disables the split: plain window). ``hot`` may pass the result
    of ``hot_keys`` already computed for the same keys.
    """
    frame_end = Window.currentRow if include_current else -1
    if bucket is not None and hot is _AUTO:
        hot = hot_keys(df, key, hot_rows)
    if bucket is None or hot is None:
        w = (Window.partitionBy(*key).orderBy(*_sorted(order, reverse))
             .rowsBetween(Window.unboundedPreceding, frame_end))
        return df.withColumn(out, F.last(value, ignorenulls=True).over(w))

    tagged = (df.join(F.broadcast(hot), key, "left")
              .withColumn("_bkt", F.when(F.col("_hot"), F.date_trunc(bucket, F.col(order[0]))))
              .withColumn("_syn", F.lit(False)))

    # Last value of every bucket of a hot key, then the value carried into
    # each bucket from the buckets before it.
    ordering = F.struct(*[F.col(c) for c in order])
    pick = F.min_by if reverse else F.max_by
    # One row per bucket of a hot key; rows without a value have a NULL
    # ordering, which max_by/min_by skip.
    summary = (tagged.where(F.col("_hot"))
               .groupBy(*key, "_bkt")
               .agg(pick(F.col(value), F.when(F.col(value).isNotNull(), ordering)).alias("_lastv")))
    w_b = (Window.partitionBy(*key).orderBy(*_sorted(["_bkt"], reverse))
           .rowsBetween(Window.unboundedPreceding, -1))
    carry = (summary.select(*key, "_bkt", F.last("_lastv", ignorenulls=True).over(w_b).alias("_carry"))
             .where(F.col("_carry").isNotNull()))
    synthetic = carry.select(
        *key, "_bkt", F.lit(True).alias("_syn"),
        *[F.lit(None).cast(t).alias(c) for c, t in df.dtypes if c not in key and c != value],
        F.col("_carry").alias(value))
    stream = tagged.drop("_hot").unionByName(synthetic)

    w = (Window.partitionBy(*key, "_bkt")
         .orderBy(F.col("_syn").desc(), *_sorted(order, reverse))
         .rowsBetween(Window.unboundedPreceding, frame_end))
    return (stream.withColumn(out, F.last(value, ignorenulls=True).over(w))
            .where(~F.col("_syn")).drop("_bkt", "_syn"))


def _neighbour(df: DataFrame, key: list[str], order: list[str], cols: list[str], out: str, reverse: bool,
               bucket: str | None = "hour", hot_rows: int = HOT_ROWS, hot=_AUTO) -> DataFrame:
    if bucket is not None and hot is _AUTO:
        hot = hot_keys(df, key, hot_rows)
    if bucket is None or hot is None:
        # Without hot keys each column is looked up by itself: a struct of
        # them would be shuffled beside them.
        w = Window.partitionBy(*key).orderBy(*_sorted(order, reverse))
        return df.withColumn(out, F.when(F.row_number().over(w) > 1,
                                         F.struct(*[F.lag(c).over(w).alias(c) for c in cols])))
    v = df.withColumn("_v", F.struct(*[F.col(c) for c in cols]))
    return carry_last(v, key, order, "_v", out, include_current=False, reverse=reverse, bucket=bucket,
                      hot_rows=hot_rows, hot=hot).drop("_v")


def with_previous(df: DataFrame, key: list[str], order: list[str], cols: list[str],
                  out: str = "prev", **kw) -> DataFrame:
    """``lag`` of ``cols`` (as one struct column ``out``) per key, by ``order``."""
    return _neighbour(df, key, order, cols, out, False, **kw)


def with_next(df: DataFrame, key: list[str], order: list[str], cols: list[str],
              out: str = "next", **kw) -> DataFrame:
    """``lead`` of ``cols`` (as one struct column ``out``) per key, by ``order``."""
    return _neighbour(df, key, order, cols, out, True, **kw)

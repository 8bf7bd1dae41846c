"""High-water marks for incremental loads (a batch watermark, not streaming)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.functions.columns import ts_lit

__all__ = ["delta_since", "next_watermark", "watermark_value"]


# Floor used when no watermark is stored yet: everything is newer.
EPOCH_FLOOR = "0001-01-01 00:00:00"


def watermark_value(meta: DataFrame | None, col: str = "max_update_dt") -> Column | None:
    """The stored watermark as a scalar-subquery column (``None`` = first run).

    An empty table or a NULL value reads as the floor timestamp, so a missing
    watermark loads everything instead of nothing (D-07) and the comparison
    stays a plain ``col > subquery`` that Spark pushes into the scan.
    """
    if meta is None:
        return None
    return meta.select(F.coalesce(F.max(col), ts_lit(EPOCH_FLOOR))).scalar()


def delta_since(df: DataFrame, wm: Column | None, cols: list[str]) -> DataFrame:
    """Rows changed after the watermark (strict ``>``) in any of ``cols``.

    With ``[create_dt, update_dt]`` this is ``create_dt > wm OR (update_dt IS
    NOT NULL AND update_dt > wm)``: a NULL column never passes. ``wm=None``
    (first run) keeps every row (D-07). Written as plain comparisons, so the
    filter reaches the parquet scan.
    """
    if wm is None:
        return df
    return df.where(reduce(lambda a, b: a | b, [F.col(c) > wm for c in cols]))


def next_watermark(delta: DataFrame, cols: list[str], previous: DataFrame | None = None,
                   col: str = "max_update_dt") -> DataFrame:
    """One-row table with the new watermark: the greatest of the old one and
    every watermark column in the delta. An empty delta keeps the old value."""
    candidates = [F.max(c) for c in cols]
    new = delta.agg(F.greatest(*candidates).alias(col) if len(candidates) > 1
                    else candidates[0].alias(col))
    if previous is None:
        return new
    both = new.unionByName(previous.select(col))
    return both.agg(F.max(col).alias(col))

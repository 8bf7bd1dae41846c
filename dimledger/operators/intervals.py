"""Join of two tables on a key where their validity intervals meet, by time bins.

A range residual on an equi-join forms every pair of a key before it looks at
the times, which is quadratic for a key with many versions. Here time is cut
into bins of 1 hour, 16 hours, 256 hours and so on (eight levels reach beyond
the open end of a version). An interval belongs to the finest level whose
bins are wider than it, so it touches at most two bins there and on every
coarser level. Two intervals meet in the bins of the coarser of their two
levels: an equi-join on (key, level, bin, meeting), where the meeting says
which of both is at its own level there. Two that are both finer never meet,
or the coarsest bins would pair all versions of a key. A pair may share two
bins; the bin of the overlap's start owns it, so each pair comes out once and
no ``distinct`` is needed.

Where the intervals of one side do not overlap within a key, as in a history,
a bin holds at most 17 of its intervals of that level (they are longer than a
sixteenth of the bin), so the pairs formed grow in line with the rows of the
other side; only the finest bin, an hour, may hold up to 3,600 versions that
last a second. The price is at most 18 rows per interval.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["overlap_join", "binned"]

TOP_LEVEL = 7          # 16**7 hours are 30,000 years
BITS = 4               # a level's bins are 2**BITS times as wide as those below
# Who is at its own level where two intervals meet.
BOTH, LEFT_ONLY, RIGHT_ONLY = 0, 1, 2


def _hour(c: str) -> Column:
    """Hours since 1970 of a zone-less time; independent of the session's zone."""
    day = F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date"))
    return (day * 24 + F.hour(c)).cast("long")


def binned(df: DataFrame, start: str, end: str, prefix: str, own_level: int, coarser: int) -> DataFrame:
    """``df`` once per level, bin and meeting in which its interval can meet
    another: ``<prefix>hour`` (of its start), ``<prefix>at`` (level),
    ``<prefix>bin`` and ``<prefix>met`` (``BOTH`` and ``own_level`` at its own
    level, ``coarser`` above). Intervals without a start or end, or that end
    before they start, meet nothing and are left out."""
    h0, h1, own, at = (f"{prefix}{n}" for n in ("hour", "_h1", "level", "at"))
    span = F.col(h1) - F.col(h0)
    level = F.lit(TOP_LEVEL)
    for n in reversed(range(TOP_LEVEL)):
        level = F.when(span < (1 << (BITS * n)), F.lit(n)).otherwise(level)
    out = (df.where(F.col(start) <= F.col(end)).withColumn(h0, _hour(start)).withColumn(h1, _hour(end))
           .withColumn(own, level))
    out = out.select("*", F.explode(F.sequence(F.col(own), F.lit(TOP_LEVEL))).alias(at))
    first, last = (F.expr(f"shiftright(`{h}`, {BITS} * `{at}`)") for h in (h0, h1))
    out = out.select("*", F.explode(F.sequence(first, last)).alias(f"{prefix}bin"))
    meetings = F.when(F.col(own) == F.col(at), F.array(F.lit(BOTH), F.lit(own_level))).otherwise(F.array(F.lit(coarser)))
    return out.select("*", F.explode(meetings).alias(f"{prefix}met")).drop(h1, own)


def _candidates(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_span: tuple[str, str],
                right_span: tuple[str, str]) -> DataFrame:
    a = binned(left.where(F.col(left_key).isNotNull()), *left_span, "_l_", LEFT_ONLY, RIGHT_ONLY)
    b = binned(right.where(F.col(right_key).isNotNull()), *right_span, "_r_", RIGHT_ONLY, LEFT_ONLY)
    same = a[left_key] == b[right_key]
    for n in ("at", "bin", "met"):
        same = same & (a[f"_l_{n}"] == b[f"_r_{n}"])
    return a.join(b, same)


def overlap_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                 start: str, end: str) -> DataFrame:
    """Inner join of ``left`` and ``right`` on the keys where their closed
    intervals ``[start, end]`` meet; ``start`` and ``end`` of the result are the
    intersection. Other columns must have different names. NULL keys match
    nothing; repeated rows match each time; empty inputs give no rows.
    """
    lo, hi = "_r_start", "_r_end"
    r = right.withColumnRenamed(start, lo).withColumnRenamed(end, hi)
    # the bin of the later start, in whole hours, is the one in which the overlap starts
    owner = F.expr(f"shiftright(greatest(_l_hour, _r_hour), {BITS} * _l_at)")
    met = _candidates(left, r, left_key, right_key, (start, end), (lo, hi)).where(
        (owner == F.col("_l_bin")) & (F.col(start) <= F.col(hi)) & (F.col(lo) <= F.col(end)))
    helpers = [f"_{side}_{n}" for side in "lr" for n in ("hour", "at", "bin", "met")]
    return (met.withColumn(start, F.greatest(start, lo)).withColumn(end, F.least(end, hi))
            .drop(lo, hi, *helpers))

"""Dimension states on two time axes, so that snapshots may arrive in any order.

A *state* is what one key looked like over an interval of valid time
(``effective_from`` .. ``effective_to``, as in ``scd2``) and while that was
believed (``known_from`` <= load time < ``known_to``; the sentinel stands for
"still"). Only present keys have states: a gap means the key was absent.

``deliver`` places the full snapshot of one day in its place: it says what
holds from that day until the next day that was delivered, so a state that
covers the stretch is split around it. Nothing is overwritten: the state it
splits keeps its row with the time at which it stopped being believed.
``versions_of`` folds the states into the versions and tombstones that
``scd2_merge`` builds from the same snapshots in their order, today's belief
or that of any earlier load.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimledger.functions.columns import SENTINEL, ts_lit
from dimledger.operators.scan import HOT_ROWS, hot_keys, with_next, with_previous
from dimledger.operators.scd2 import DELETED, FROM, TO, one_second

__all__ = ["KNOWN_FROM", "KNOWN_TO", "state_schema", "one_row_per_key", "deliver", "known_states", "versions_of"]

KNOWN_FROM, KNOWN_TO = "known_from", "known_to"


def state_schema(fields: Sequence[T.StructField]) -> T.StructType:
    """Key and attribute fields followed by both time axes."""
    axes = [T.StructField(c, T.TimestampNTZType()) for c in (FROM, TO, KNOWN_FROM, KNOWN_TO)]
    return T.StructType([*fields, *axes])


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def one_row_per_key(snapshot: DataFrame, key: list[str], attrs: list[str]) -> DataFrame:
    """The snapshot without repeated rows. A key with two different rows has
    no state of its own and fails the job (D-35)."""
    if not attrs:
        return snapshot.select(*key).distinct()
    row = F.struct(*attrs)
    both = snapshot.groupBy(*key).agg(F.min(row).alias("_lo"), F.max(row).alias("_hi"))
    clash = F.raise_error(F.concat(F.lit("two different rows in one snapshot for key "),
                                   F.to_json(F.struct(*key))))
    return both.withColumn("_row", F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_lo")).otherwise(clash)
                           ).select(*key, "_row.*")


def deliver(states: DataFrame, snapshot: DataFrame, key: list[str], attrs: list[str], valid_from: Column,
            load_time: Column, next_valid: Column | None = None) -> DataFrame:
    """``states`` after the full snapshot of ``valid_from`` was loaded at ``load_time``.

    ``next_valid`` is the next day for which a snapshot was delivered before,
    or None where this one is the newest; days lie at least two seconds apart.
    Load times must not go back. Per key, over ``[valid_from, next_valid)``:

    * the snapshot agrees with the believed state: nothing changes;
    * otherwise the believed state, if any, stops being believed and comes
      back cut to the parts before and after; the snapshot's row, if any,
      takes the stretch between.

    A day delivered again replaces what it said before. Keys are compared
    NULL-safely. States that cannot meet the stretch never enter the join; for
    that ``states`` is read twice, so it should be a stored table (or a
    checkpoint) when deliveries follow each other. Empty states and an empty
    snapshot (all keys absent) are valid.
    """
    sentinel = ts_lit(SENTINEL)
    stretch_end = sentinel if next_valid is None else next_valid - one_second()
    axes = [FROM, TO, KNOWN_FROM, KNOWN_TO]
    cols = [*key, *attrs]
    states = states.select(*cols, *axes)
    met = (F.col(KNOWN_TO) == sentinel) & (F.col(FROM) <= stretch_end) & (F.col(TO) >= valid_from)
    h = states.where(met).withColumn("_in_h", F.lit(True)).alias("h")
    s = one_row_per_key(snapshot, key, attrs).withColumn("_in_s", F.lit(True)).alias("s")
    j = h.join(s, _all([F.col(f"h.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key]), "full_outer")
    in_h, in_s = F.col("h._in_h").isNotNull(), F.col("s._in_s").isNotNull()
    same = in_h & in_s & _all([F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in attrs])

    def state(side: str, start: Column, end: Column, known_from: Column, known_to: Column) -> Column:
        spans = zip(axes, (start, end, known_from, known_to))
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols],
                        *[v.cast("timestamp_ntz").alias(a) for a, v in spans], F.lit(True).alias("_present"))

    h_from, h_to, h_known = (F.col(f"h.{a}") for a in (FROM, TO, KNOWN_FROM))
    # A state first believed in this very load leaves no trace when it is replaced by it.
    believed = F.when(same, state("h", h_from, h_to, h_known, sentinel)) \
        .when(in_h & (h_known < load_time), state("h", h_from, h_to, h_known, load_time))
    before = F.when(in_h & ~same & (h_from < valid_from),
                    state("h", h_from, valid_from - one_second(), load_time, sentinel))
    now = F.when(in_s & ~same, state("s", valid_from, stretch_end, load_time, sentinel))
    slots = [believed, before, now]
    if next_valid is not None:
        slots.append(F.when(in_h & ~same & (h_to >= next_valid),
                            state("h", next_valid, h_to, load_time, sentinel)))
    placed = j.select(F.inline(F.array(*slots))).where(F.col("_present")).drop("_present")
    return states.where(~met).unionByName(placed)


def known_states(states: DataFrame, known_at: Column | None = None) -> DataFrame:
    """The states believed now, or at load time ``known_at``; they do not
    overlap within a key."""
    if known_at is None:
        return states.where(F.col(KNOWN_TO) == ts_lit(SENTINEL))
    return states.where((F.col(KNOWN_FROM) <= known_at) & (known_at < F.col(KNOWN_TO)))


def versions_of(states: DataFrame, key: list[str], attrs: list[str], tracked: list[str],
                known_at: Column | None = None, bucket: str | None = "day",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """Versions and tombstones in the layout of ``scd2`` from the states
    believed now or at ``known_at``.

    States that follow each other without a gap and agree in ``tracked`` are
    one version with the attributes of the first. A gap after a version, also
    the one up to now, is a tombstone with that version's attributes. No
    interval ends before it starts. Keys with more than ``hot_rows`` states
    are scanned in ``bucket`` slices.
    """
    sentinel = ts_lit(SENTINEL)
    s = known_states(states, known_at).select(*key, *attrs, FROM, TO)
    hot = hot_keys(s, key, hot_rows) if bucket is not None else None
    scan = {"bucket": bucket, "hot": hot}
    near = list(dict.fromkeys([*tracked, FROM, TO]))
    s = with_previous(s, key, [FROM], near, out="_p", **scan)
    s = with_next(s, key, [FROM], near, out="_n", **scan)

    def agrees(other: str) -> Column:
        return _all([F.col(c).eqNullSafe(F.col(f"{other}.{c}")) for c in tracked])

    follows = F.col("_p").isNotNull() & (F.col("_p")[TO] + one_second() == F.col(FROM)) & agrees("_p")
    goes_on = F.col("_n").isNotNull() & (F.col(TO) + one_second() == F.col("_n")[FROM]) & agrees("_n")
    # First and last states of the runs; the last one knows where the run ends and what comes next.
    edges = (s.withColumn("_first", ~follows).withColumn("_last", ~goes_on)
             .where("_first OR _last").withColumn("_after", F.col("_n")[FROM]).drop("_p", "_n"))
    edges = with_next(edges, key, [FROM], [TO, "_after"], out="_e", **scan)
    runs = edges.where("_first").select(
        *key, *attrs, FROM,
        F.when(F.col("_last"), F.col(TO)).otherwise(F.col("_e")[TO]).alias("_end"),
        F.when(F.col("_last"), F.col("_after")).otherwise(F.col("_e._after")).alias("_after"))

    def row(start: Column, end: Column, deleted: int) -> Column:
        return F.struct(*[F.col(c) for c in [*key, *attrs]], start.alias(FROM), end.alias(TO),
                        F.lit(deleted).alias(DELETED))

    gone = F.col("_end") + one_second()
    absent = (F.col("_end") < sentinel) & (F.col("_after").isNull() | (F.col("_after") > gone))
    tombstone = row(gone, F.coalesce(F.col("_after") - one_second(), sentinel), 1)
    version = row(F.col(FROM), F.col("_end"), 0)
    return runs.select(F.inline(F.when(absent, F.array(version, tombstone)).otherwise(F.array(version))))

"""Versioned (SCD2) dimensions: current rows, one-pass merge, history from a
change log, and the point-in-time join of facts to the version valid then.

History layout: key columns, attribute columns, ``effective_from``,
``effective_to`` (the open version ends at the sentinel) and ``deleted_flg``
(1 on a tombstone). Parquet tables cannot be updated in place, so every
mutation here is a pure function ``old history, snapshot → new history``; the
caller writes the result to a new version directory (see ``sources.sinks``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.functions.columns import SENTINEL, ts_lit
from dimledger.operators.relational import latest_per_key
from dimledger.operators.scan import HOT_ROWS, carry_last, hot_keys, with_next

__all__ = ["current_rows", "open_rows", "scd2_merge", "scd2_history", "pit_join",
           "FROM", "TO", "DELETED", "one_second"]

FROM, TO, DELETED = "effective_from", "effective_to", "deleted_flg"


def one_second() -> Column:
    return F.expr("INTERVAL '1' SECOND")


def _sentinel() -> Column:
    return ts_lit(SENTINEL)


def open_rows(hist: DataFrame) -> DataFrame:
    """Rows ending at the sentinel: live versions and open tombstones."""
    return hist.where(F.col(TO) == _sentinel())


def current_rows(hist: DataFrame) -> DataFrame:
    """The live version of every key: open and not deleted."""
    return hist.where((F.col(TO) == _sentinel()) & (F.col(DELETED) == 0))


def scd2_merge(hist: DataFrame, snapshot: DataFrame, key: list[str], tracked: list[str],
               attrs: list[str], run_ts: Column, from_col: str | None = None,
               with_change: bool = False, dedupe: bool = True) -> DataFrame:
    """Apply a full source snapshot to a history in one pass.

    Each key is classified by one full-outer join of the open history rows
    with the snapshot:

    * ``I`` new key (or a key whose open row is a tombstone, D-30): open a version;
    * ``U`` a tracked attribute changed, NULL-safe (D-01, D-03): close the open
      version one second before the new one starts and open the new one;
    * ``D`` key absent from the snapshot (D-04): close it at ``run_ts - 1s`` (at
      its own start, if that is later) and open a tombstone carrying the last
      attributes, ``deleted_flg = 1`` (D-05);
    * ``S`` otherwise: unchanged. Untracked changes do not make a version.

    A new version starts at ``from_col`` of the snapshot row (the source's
    update time) or at ``run_ts``. Closed history rows never enter the join.
    A NULL ``from_col`` falls back to ``run_ts``. The snapshot is reduced to one
    row per key first (latest by ``from_col``, then greatest by attributes, so
    equal times do not open two versions, D-35); ``dedupe=False`` skips that
    when the caller already guarantees it.
    Running the same snapshot twice gives the same history.
    """
    cols = [*key, *attrs]
    snap = snapshot.select(*cols, *([from_col] if from_col else []))
    if dedupe:
        snap = latest_per_key(snap, key, [*([from_col] if from_col else []), *attrs])
    stamped = F.coalesce(F.col(f"s.{from_col}"), run_ts) if from_col else run_ts

    open_ = open_rows(hist)
    closed = hist.where(F.col(TO) != _sentinel())

    h = open_.select(*[F.col(c).alias(c) for c in cols], FROM, TO, DELETED,
                     F.lit(True).alias("_in_h")).alias("h")
    s = snap.withColumn("_in_s", F.lit(True)).alias("s")
    cond = reduce(lambda a, b: a & b, [F.col(f"h.{k}") == F.col(f"s.{k}") for k in key])
    j = h.join(s, cond, "full_outer")

    in_h = F.col("h._in_h").isNotNull()
    in_s = F.col("s._in_s").isNotNull()
    live = F.col(f"h.{DELETED}") == 0
    differs = reduce(lambda a, b: a | b,
                     [~F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in tracked],
                     F.lit(False))
    change = (F.when(~in_h, "I")
              .when(~in_s & live, "D")
              .when(~in_s, "S")
              .when(~live, "I")
              .when(differs, "U")
              .otherwise("S"))
    j = j.withColumn("_chg", change)
    # A change stamped at or before the start of the version it replaces (a
    # late correction) starts one second after it, so versions never overlap.
    new_from = F.when(in_h, F.greatest(stamped, F.col(f"h.{FROM}") + one_second())).otherwise(stamped)
    # So does the tombstone of a version that starts at or after the run.
    gone_from = F.greatest(run_ts, F.col(f"h.{FROM}") + one_second())

    def version(side: str, start: Column, end: Column, flag: int | Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols],
                        start.cast("timestamp_ntz").alias(FROM),
                        end.cast("timestamp_ntz").alias(TO),
                        (F.lit(flag) if isinstance(flag, int) else flag).cast("int").alias(DELETED),
                        F.col("_chg").alias("_chg"), F.lit(True).alias("_present"))

    chg = F.col("_chg")
    # The existing open row: kept, or closed just before what replaces it.
    old = F.when(chg == "S", version("h", F.col(f"h.{FROM}"), F.col(f"h.{TO}"), F.col(f"h.{DELETED}"))) \
        .when(in_h & in_s & chg.isin("U", "I"),
              version("h", F.col(f"h.{FROM}"), new_from - one_second(), F.col(f"h.{DELETED}"))) \
        .when(chg == "D", version("h", F.col(f"h.{FROM}"), gone_from - one_second(), 0))
    # The row that opens now: a new version, or a tombstone.
    new = F.when(chg.isin("I", "U"), version("s", new_from, _sentinel(), 0)) \
        .when(chg == "D", version("h", gone_from, _sentinel(), 1))

    # inline turns an empty slot into a row of NULLs, without the presence
    # flag (no lambda: stays in codegen)
    merged = j.select(F.inline(F.array(old, new))).where(F.col("_present")).drop("_present")
    passthrough = closed.select(*cols, FROM, TO, DELETED).withColumn("_chg", F.lit(None).cast("string"))
    out = passthrough.unionByName(merged)
    return out if with_change else out.drop("_chg")


def scd2_history(changes: DataFrame, key: list[str], attrs: list[str], ts: str,
                 tie: str, tracked: list[str] | None = None, bucket: str | None = "day",
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Build versions from a change log (one row per observed state).

    A version starts at a row whose tracked attributes differ from the
    previous row of the key (ordered by ``ts``, then ``tie``) and ends one
    second before the next version starts; the last one ends at the sentinel.
    Both scans split keys with more than ``hot_rows`` rows into ``bucket``
    slices of time, so one busy key is spread over many tasks.
    """
    tracked = tracked or attrs
    order = [ts, tie]
    v = changes.select(*key, *attrs, ts, tie)
    # Version starts are a subset of the changes, so keys hot among the
    # starts are hot among the changes: one hot-key table serves both scans.
    hot = hot_keys(v, key, hot_rows) if bucket is not None else None
    v = v.withColumn("_cur", F.struct(*[F.col(c) for c in tracked]))
    v = carry_last(v, key, order, "_cur", "_prev", include_current=False, bucket=bucket, hot=hot)
    starts = v.where(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(F.col("_cur")))
    starts = starts.drop("_cur", "_prev")
    starts = with_next(starts, key, order, [ts], out="_next", bucket=bucket, hot=hot)
    return starts.select(
        *key, *attrs,
        F.col(ts).cast("timestamp_ntz").alias(FROM),
        F.coalesce(F.col("_next")[ts] - one_second(), _sentinel()).alias(TO),
        F.lit(0).alias(DELETED))


def pit_join(facts: DataFrame, hist: DataFrame, fact_key: list[str], hist_key: list[str],
             ts: str, cols: list[str], how: str = "inner", method: str = "asof",
             include_deleted: bool = False, bucket: str | None = "hour",
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach to each fact the ``cols`` of the version valid at ``ts``, point
    in time (D-11). A version is valid from ``effective_from`` up to one second
    after ``effective_to`` (exclusive): versions end a second before the next
    one starts, and a fact inside that second belongs to the one that ends.

    ``method='asof'`` (default) merges facts and versions into one ordered
    stream per key and carries the latest version forward, bucketed by day:
    linear in facts + versions, no fact × version pairs, and a hot key is
    split across tasks. ``method='range'`` is the equi-join with a range
    residual; it is simpler and fine when versions per key are few.
    Tombstones match nothing unless ``include_deleted``.
    """
    versions = hist if include_deleted else hist.where(F.col(DELETED) == 0)
    if method == "range":
        h = versions.select(*[F.col(a).alias(f"_hk{i}") for i, a in enumerate(hist_key)],
                            *cols, F.col(FROM).alias("_vf"), F.col(TO).alias("_vt"))
        cond = reduce(lambda a, b: a & b,
                      [facts[f] == h[f"_hk{i}"] for i, f in enumerate(fact_key)])
        cond = cond & (facts[ts] >= h["_vf"]) & (facts[ts] < h["_vt"] + one_second())
        out = facts.join(h, cond, how)
        return out.drop(*[f"_hk{i}" for i in range(len(hist_key))], "_vf", "_vt")

    fact_cols = facts.columns
    # A fact without its key matches nothing; all of them would be one key.
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in fact_key])
    unknown = facts.where(~known)
    facts = facts.where(known)
    keys = [f"_pk{i}" for i in range(len(fact_key))]
    f_side = facts.select(*[F.col(k).alias(n) for k, n in zip(fact_key, keys)],
                          F.col(ts).alias("_t"), F.lit(1).alias("_tag"),
                          F.lit(None).cast("timestamp_ntz").alias("_vt_order"),
                          F.struct(*[F.col(c) for c in fact_cols]).alias("_fact"),
                          F.lit(None).alias("_ver"))
    ver_struct = F.struct(*[F.col(c) for c in cols], F.col(FROM).alias("_vf"), F.col(TO).alias("_vt"))
    v_side = versions.select(*[F.col(k).alias(n) for k, n in zip(hist_key, keys)],
                             F.col(FROM).cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_tag"),
                             F.col(TO).cast("timestamp_ntz").alias("_vt_order"),
                             F.lit(None).alias("_fact"), ver_struct.alias("_ver"))
    f_side = f_side.withColumn("_ver", F.lit(None).cast(v_side.schema["_ver"].dataType))
    v_side = v_side.withColumn("_fact", F.lit(None).cast(f_side.schema["_fact"].dataType))
    stream = f_side.unionByName(v_side)
    # Keys are hot because of their facts (a history holds few versions per
    # key), so only the fact keys are counted; the versions are not computed
    # twice for the check.
    hot = hot_keys(f_side.select(*keys), keys, hot_rows) if bucket is not None else None
    # Versions sort before facts at the same instant (effective_from is
    # inclusive); among versions starting together the longer one is last.
    stream = carry_last(stream, keys, ["_t", "_tag", "_vt_order"], "_ver", "_match",
                        include_current=True, bucket=bucket, hot=hot)
    hit = F.col("_match").isNotNull() & (F.col("_t") < F.col("_match._vt") + one_second())
    matched = stream.where(F.col("_tag") == 1)
    if how == "inner":
        matched = matched.where(hit)
    elif how != "left":
        raise ValueError("pit_join supports how='inner' or 'left'")
    out = matched.select(*[F.col("_fact")[c].alias(c) for c in fact_cols],
                         *[F.when(hit, F.col("_match")[c]).alias(c) for c in cols])
    if how == "left":
        out = out.unionByName(unknown, allowMissingColumns=True)
    return out

"""Card fraud report.

Event types (fixed values of the report format): 1 = operation with a
blacklisted or expired passport, 2 = operation on an expired contract,
3 = operations of one card in different cities within one hour.

Inputs have the shapes of the bank warehouse:

* ``clients``   client_id, last_name, first_name, patronymic, passport_num,
  passport_valid_to, phone (+ SCD2 columns when versioned)
* ``accounts``  account_num, valid_to, client
* ``cards``     card_num, account_num
* ``terminals`` terminal_id, terminal_city
* ``txn``       trans_id, trans_date, card_num, terminal
* ``blacklist`` passport_num, entry_dt

The owner chain card → account → client is resolved among the dimensions
first (they are much smaller than the facts), so the fact table is joined
once, on ``card_num``.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimledger.functions.columns import full_name, strip_spaces
from dimledger.operators.intervals import overlap_join
from dimledger.operators.scan import HOT_ROWS, with_previous
from dimledger.operators.scd2 import DELETED, FROM, TO, current_rows, pit_join
from dimledger.sources.schemas import REPORT, conform
from dimledger.sources.sinks import replace_partition, write_partition

__all__ = ["card_owners", "rule_blacklisted", "rule_expired_document", "rule_expired_contract",
           "velocity_rule", "fraud_report", "refresh_report", "late_corrections", "events_in_force", "write_report", "REPORT_COLUMNS"]

REPORT_COLUMNS = ["event_dt", "passport", "fio", "phone", "event_type"]
OWNER_COLUMNS = ["card_num", "account_num", "account_valid_to", "client_id", "passport_num",
                 "passport_valid_to", "fio", "phone"]


def card_owners(clients: DataFrame, accounts: DataFrame, cards: DataFrame,
                versions: str = "pit") -> DataFrame:
    """One row per card (per validity interval with ``versions='pit'``) with the
    account and client fields the rules need.

    ``versions``: ``'current'`` uses the live version of each dimension;
    ``'all'`` joins every version, as the reference's report does (one hit per
    version, D-11); ``'pit'`` intersects validity intervals along the chain so
    facts can be joined to the owner valid at the transaction time.
    """
    cl = clients.select("client_id", "passport_num", "passport_valid_to", "phone",
                        full_name("last_name", "first_name", "patronymic").alias("fio"),
                        *([FROM, TO, DELETED] if versions != "all" else []))
    ac = accounts.select("account_num", F.col("valid_to").alias("account_valid_to"), "client",
                         *([FROM, TO, DELETED] if versions != "all" else []))
    cd = cards.select("card_num", "account_num",
                      *([FROM, TO, DELETED] if versions != "all" else []))
    if versions == "current":
        cl, ac, cd = (current_rows(x).drop(FROM, TO, DELETED) for x in (cl, ac, cd))
    if versions in ("current", "all"):
        return (cd.join(ac, "account_num").join(cl, F.col("client") == F.col("client_id"))
                .select(*OWNER_COLUMNS))
    if versions != "pit":
        raise ValueError(f"unknown versions mode {versions!r}")
    live = [x.where(F.col(DELETED) == 0).drop(DELETED) for x in (cl, ac, cd)]
    cl, ac, cd = live
    chain = overlap_join(cd, ac.withColumnRenamed("account_num", "_acc"), "account_num", "_acc", FROM, TO).drop("_acc")
    chain = overlap_join(chain, cl, "client", "client_id", FROM, TO)
    return chain.select(*OWNER_COLUMNS, FROM, TO).withColumn(DELETED, F.lit(0))


def _with_owner(txn: DataFrame, owners: DataFrame, pit: bool | None) -> DataFrame:
    """Owner fields per operation: the owner valid at the operation time when
    ``owners`` has validity intervals (``pit=None`` detects it), else by card.
    The join strategy is left to adaptive execution, which knows the bytes of
    the owner chain once it is shuffled."""
    t = txn.select("card_num", "trans_date")
    if pit is None:
        pit = FROM in owners.columns
    if pit:
        cols = [c for c in owners.columns if c not in ("card_num", FROM, TO, DELETED)]
        return pit_join(t, owners, ["card_num"], ["card_num"], "trans_date", cols)
    return t.join(owners, "card_num")


def _blacklist_first_entry(blacklist: DataFrame) -> DataFrame:
    """Earliest blacklisting per normalised passport. A transaction is flagged
    when any entry precedes it, i.e. when the earliest one does, so the fact
    join needs one row per passport (no fan-out per entry)."""
    return (blacklist.groupBy(strip_spaces("passport_num").alias("_bl_passport"))
            .agg(F.min("entry_dt").alias("blacklisted_at")))


def _attach_blacklist(owners: DataFrame, blacklist: DataFrame) -> DataFrame:
    bl = _blacklist_first_entry(blacklist)
    return (owners.join(bl, strip_spaces("passport_num") == F.col("_bl_passport"), "left")
            .drop("_bl_passport"))


def _events(j: DataFrame, flags: list[tuple[Column, int]]) -> DataFrame:
    """One row per (operation, rule that fires). A single flag is a filter;
    several are exploded from an array (plain explode + filter stays in
    generated code, a lambda ``filter`` would not)."""
    cols = [F.col("trans_date").alias("event_dt"), F.col("passport_num").alias("passport"), "fio", "phone"]
    if len(flags) == 1:
        cond, t = flags[0]
        return j.where(cond).select(*cols, F.lit(t).alias("event_type"))
    types = F.array(*[F.when(cond, F.lit(t)) for cond, t in flags])
    return (j.select(*cols, F.explode(types).alias("event_type"))
            .where(F.col("event_type").isNotNull()))


def _distinct_events(events: DataFrame) -> DataFrame:
    """Distinct events. A person's events of a quarter go to one task: next to
    each other their texts compress to little in the shuffle and in files."""
    sliced = events.withColumn("_slice", F.date_trunc("quarter", F.col("event_dt")))
    return sliced.repartition("passport", "fio", "phone", "_slice").distinct().drop("_slice")


def _expired_document(inclusive: bool) -> Column:
    vt = F.col("passport_valid_to")
    if inclusive:
        # valid through the whole last day
        return vt.isNotNull() & (F.col("trans_date") >= F.date_add(vt, 1).cast("timestamp_ntz"))
    return vt.isNotNull() & (vt.cast("timestamp_ntz") < F.col("trans_date"))


def rule_blacklisted(txn: DataFrame, owners: DataFrame, blacklist: DataFrame,
                     pit: bool | None = None) -> DataFrame:
    """Type 1a: operation after the client's passport entered the blacklist
    (strictly after; passports compared with spaces removed on both sides)."""
    j = _with_owner(txn, _attach_blacklist(owners, blacklist).where(F.col("blacklisted_at").isNotNull()), pit)
    return _events(j, [(F.col("blacklisted_at") < F.col("trans_date"), 1)])


def rule_expired_document(txn: DataFrame, owners: DataFrame, inclusive: bool = False,
                          pit: bool | None = None) -> DataFrame:
    """Type 1b: operation after the passport expired. With ``inclusive`` the
    passport is valid through its last day; by default any time after 00:00
    of that day counts as expired, as in the reference (D-15)."""
    j = _with_owner(txn, owners.where(F.col("passport_valid_to").isNotNull()), pit)
    return _events(j, [(_expired_document(inclusive), 1)])


def rule_expired_contract(txn: DataFrame, owners: DataFrame, pit: bool | None = None) -> DataFrame:
    """Type 2: operation after the account's contract ended."""
    j = _with_owner(txn, owners.where(F.col("account_valid_to").isNotNull()), pit)
    return _events(j, [(F.col("trans_date") > F.col("account_valid_to"), 2)])


def velocity_rule(txn: DataFrame, terminals: DataFrame, owners: DataFrame,
                  within: str = "1 hour", bucket: str | None = "hour",
                  hot_rows: int = HOT_ROWS, pit: bool | None = None) -> DataFrame:
    """Type 3: an operation less than ``within`` after the previous operation of
    the same card, in a different city.

    ``terminals`` is either current cities (``terminal_id``,
    ``terminal_city``) or the terminal history (with validity columns), in
    which case each operation's city is the one valid at its time.

    The previous operation is found on the fact alone (card, time, id,
    terminal), ordered by time with the transaction id as tie-break (D-12); a
    card with more than ``hot_rows`` operations is split into ``bucket``
    slices of time so it is still spread over tasks. Cities
    are looked up only for the few rows that pass the time test; an unknown
    terminal has no city and is never flagged.
    """
    # An operation without a card has no owner and is never reported: all of
    # them would be one key of the window.
    t = txn.select("trans_id", "trans_date", "card_num", "terminal").where(F.col("card_num").isNotNull())
    t = with_previous(t, ["card_num"], ["trans_date", "trans_id"], ["trans_date", "terminal"],
                      out="_prev", bucket=bucket, hot_rows=hot_rows)
    gap = F.col("trans_date") - F.col("_prev.trans_date")
    near = t.where(F.col("_prev").isNotNull() & (gap < F.expr(f"INTERVAL {within}")))
    if FROM in terminals.columns:
        # Versioned terminals: each operation's city is the one valid at its
        # own time, so a terminal that moved between two operations counts
        # as two cities. Only the few rows under ``within`` are looked up.
        versions = terminals.select("terminal_id", "terminal_city", FROM, TO, DELETED)
        near = near.select("card_num", "trans_date", "terminal",
                           F.col("_prev.terminal").alias("_pt"), F.col("_prev.trans_date").alias("_pd"))
        near = pit_join(near, versions, ["terminal"], ["terminal_id"], "trans_date", ["terminal_city"],
                        how="inner", method="range").withColumnRenamed("terminal_city", "_c1")
        moved = (pit_join(near, versions, ["_pt"], ["terminal_id"], "_pd", ["terminal_city"],
                          how="inner", method="range")
                 .where(F.col("_c1") != F.col("terminal_city"))
                 .select("card_num", "trans_date"))
    else:
        cities = terminals.select("terminal_id", "terminal_city")
        cur = cities.select(F.col("terminal_id").alias("_t1"), F.col("terminal_city").alias("_c1"))
        prev = cities.select(F.col("terminal_id").alias("_t2"), F.col("terminal_city").alias("_c2"))
        moved = (near.join(cur, F.col("terminal") == F.col("_t1"), "left")
                 .join(prev, F.col("_prev.terminal") == F.col("_t2"), "left")
                 .where(F.col("_c1") != F.col("_c2"))
                 .select("card_num", "trans_date"))
    j = _with_owner(moved, owners, pit)
    return _events(j, [(F.lit(True), 3)])


def fraud_report(txn: DataFrame, owners: DataFrame, blacklist: DataFrame, terminals: DataFrame,
                 report_dt: Column, inclusive_document: bool = False, within: str = "1 hour",
                 pit: bool | None = None, history: DataFrame | None = None, velocity: bool = True) -> DataFrame:
    """All four rules, one row per distinct event (D-10), stamped ``report_dt``;
    without ``velocity`` those of types 1 and 2 only.

    Rules 1a, 1b and 2 are flags on a single join of the facts with the
    owners (plus the first blacklist entry per passport), so the fact table is
    read and shuffled once for all three.

    For an incremental run ``txn`` holds only the newly loaded operations and
    ``history`` the operations loaded before; the velocity rule then also
    looks at earlier operations from ``within`` before the first new one (a
    card's previous operation may be in yesterday's load) and reports only
    events at or after it.
    """
    o = _attach_blacklist(owners, blacklist)
    if pit is None:
        pit = FROM in o.columns
    j = _with_owner(txn, o, pit)
    static = _events(j, [
        ((F.col("blacklisted_at") < F.col("trans_date")) | _expired_document(inclusive_document), 1),
        (F.col("account_valid_to").isNotNull() & (F.col("trans_date") > F.col("account_valid_to")), 2),
    ])
    if not velocity:
        return _distinct_events(static).withColumn("report_dt", report_dt.cast("timestamp_ntz"))
    if history is None:
        fast = velocity_rule(txn, terminals, owners, within=within, pit=pit)
    else:
        cols = ["trans_id", "trans_date", "card_num", "terminal"]
        first_new = txn.select(F.min("trans_date")).scalar()
        earlier = history.where(F.col("trans_date") >= first_new - F.expr(f"INTERVAL {within}"))
        recent = txn.select(*cols).unionByName(earlier.select(*cols)).distinct()
        fast = (velocity_rule(recent, terminals, owners, within=within, pit=pit)
                .where(F.col("event_dt") >= first_new))
    return _distinct_events(static.unionByName(fast)).withColumn("report_dt", report_dt.cast("timestamp_ntz"))


def _row_sums(prefix: str, columns: list[str]) -> list[Column]:
    """Per group, both halves of the rows' hashes summed by ``_side``: all 0 if
    the rows of both sides are the same, in any order."""
    hashed = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    halves = F.shiftright(hashed, 32), hashed.bitwiseAND(F.lit(0xFFFFFFFF))
    return [F.sum(F.col("_side") * h).alias(f"{prefix}{k}") for k, h in enumerate(halves)]


def _changed_passports(before: tuple[DataFrame, DataFrame], after: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(_passport, _owner): passports of owner rows, or with a first blacklist
    entry, that are only in one of both; ``_owner`` if more than the dates that
    rules 1 and 2 compare differs. Owner rows are summed up per passport where
    they are, and the blacklist is compared on its own, so no wide row is
    shuffled for this."""
    columns = [c for c in after[0].columns if c in before[0].columns]
    dates = ("account_num", "account_valid_to", "client_id", "passport_valid_to")
    sides = before[0].select(*columns, F.lit(1).alias("_side")).unionByName(
        after[0].select(*columns, F.lit(-1).alias("_side")))
    rows = sides.groupBy(F.col("passport_num").alias("_passport")).agg(
        *_row_sums("_row", columns), *_row_sums("_own", [c for c in columns if c not in dates]))
    entries = [_blacklist_first_entry(x[1]).where(F.col("_bl_passport").isNotNull()) for x in (before, after)]
    none = F.lit(None).cast(entries[0].schema["blacklisted_at"].dataType)
    entry = (entries[0].select("_bl_passport", F.col("blacklisted_at").alias("_was"), none.alias("_is"))
             .unionByName(entries[1].select("_bl_passport", none.alias("_was"), F.col("blacklisted_at").alias("_is")))
             .groupBy("_bl_passport").agg(F.max("_was").alias("_was"), F.max("_is").alias("_is"))
             .where(~F.col("_was").eqNullSafe(F.col("_is"))))
    return (rows.join(entry, strip_spaces("_passport") == F.col("_bl_passport"), "left")
            .where("_row0 <> 0 OR _row1 <> 0 OR _bl_passport IS NOT NULL")
            .select("_passport", F.expr("_own0 <> 0 OR _own1 <> 0").alias("_owner")))


def refresh_report(report: DataFrame, txn: DataFrame, before: tuple[DataFrame, DataFrame],
                   after: tuple[DataFrame, DataFrame], terminals: DataFrame, report_dt: Column,
                   **options) -> DataFrame:
    """``report`` brought up to date after owners or blacklist rows arrived late.

    ``before`` and ``after`` are (owners, blacklist) as the report knew them
    and as they are now. Owner rows (with the first blacklist entry of their
    passport) that are only in one of both name the passports whose events may
    differ; their old events are retracted, and events are made anew from the
    operations of all cards that have such a passport. Rule 3 reads neither
    the blacklist nor the dates of documents and contracts: where nothing else
    changed its events stand, with the new stamp. Equal to the report from
    scratch over the same operations, but only these cards' operations are
    joined. New operations are the daily report's work.
    """
    passports = _changed_passports(before, after).checkpoint()
    velocity = not passports.where("_owner").isEmpty()
    names = passports.select("_passport")
    owners = after[0].join(names, F.col("passport_num").eqNullSafe(F.col("_passport")), "left_semi")
    pit = options.get("pit")
    pit = FROM in after[0].columns if pit is None else pit
    if pit or velocity:
        cards = owners.select("card_num").distinct().checkpoint()
        txn = txn.join(cards, "card_num", "left_semi")
    if pit:
        # All versions of a card decide which one is valid at a time.
        owners = after[0].join(cards, "card_num", "left_semi")
    again = fraud_report(txn, owners, after[1], terminals, report_dt, velocity=velocity, **options)
    if pit:
        again = again.join(names, F.col("passport").eqNullSafe(F.col("_passport")), "left_semi")
    if velocity:
        kept = report.join(names, F.col("passport").eqNullSafe(F.col("_passport")), "left_anti")
    else:
        marked = report.join(names.withColumn("_changed", F.lit(True)),
                             F.col("passport").eqNullSafe(F.col("_passport")), "left")
        stamp = F.when(F.col("_changed"), report_dt.cast("timestamp_ntz")).otherwise(F.col("report_dt"))
        kept = marked.where("_changed IS NULL OR event_type = 3").withColumn("report_dt", stamp).select(*report.columns)
    return kept.unionByName(again)


def events_in_force(reported: DataFrame, retracted: DataFrame | None) -> DataFrame:
    """The events that hold after all report days: each as its last day left it,
    reported or retracted (``report_date`` orders the days; an event of both on
    one day is reported)."""
    said = reported.select(*REPORT_COLUMNS, "report_date", F.lit(1).alias("_said"))
    if retracted is not None:
        said = said.unionByName(retracted.select(*REPORT_COLUMNS, "report_date", F.lit(0).alias("_said")))
    return (said.groupBy(*REPORT_COLUMNS).agg(F.max(F.struct("report_date", "_said")).alias("_last"))
            .where("_last._said = 1").drop("_last"))


def late_corrections(reported: DataFrame, retracted: DataFrame | None, txn: DataFrame, owners: DataFrame,
                     blacklist: DataFrame, terminals: DataFrame, passports: DataFrame, since: Column,
                     report_dt: Column, within: str = "1 hour", **options) -> tuple[DataFrame, DataFrame]:
    """(events to add, events to retract) of earlier operations, after owners or
    blacklist rows arrived late.

    ``passports`` (column ``passport``, distinct) are those whose events may
    differ from ``since`` on. ``txn`` and ``owners`` must hold all cards that
    have or had such a passport, operations from ``within`` before ``since``.
    Events before ``since`` and of other passports stay as they are.
    """
    def concerned(events: DataFrame) -> DataFrame:
        p = passports.select(F.col("passport").alias("_p"))
        return (events.where(F.col("event_dt") >= since)
                .join(p, F.col("passport").eqNullSafe(F.col("_p")), "left_semi"))

    def only_in(a: DataFrame, b: DataFrame) -> DataFrame:
        return (a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(2)))
                .groupBy(*REPORT_COLUMNS).agg(F.min("_side").alias("_a"), F.max("_side").alias("_b"))
                .where("_a = 1 AND _b = 1").select(*REPORT_COLUMNS, report_dt.cast("timestamp_ntz").alias("report_dt")))

    now = concerned(fraud_report(txn, owners, blacklist, terminals, report_dt, within=within, **options))
    now = now.select(*REPORT_COLUMNS)
    before = events_in_force(concerned(reported), None if retracted is None else concerned(retracted))
    return only_in(now, before), only_in(before, now)


def write_report(report: DataFrame, path: str, run_date=None) -> None:
    """Store a report run as the partition of its report date, replacing that
    day on a rerun (D-10), also when the rerun has no events if ``run_date``
    names the day: the reference appended every run instead."""
    out = conform(report, REPORT).withColumn("report_date", F.to_date("report_dt"))
    if run_date is None:
        write_partition(out, path, ["report_date"])
    else:
        replace_partition(out, path, "report_date", run_date.isoformat())

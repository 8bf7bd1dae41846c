"""Daily load of the bank warehouse: versioned dimensions and append-only
facts behind a high-water mark, written so that a rerun is harmless.

* A dimension history is partitioned by ``closed_on``: ``open`` holds the
  open rows (live versions and tombstones), and each run writes the rows it
  closed to ``closed_on=<run date>``. A run reads only the open partition
  (partition pruning), merges it, stages the result in the shared checkpoint
  folder (cutting the lineage to the table it is about to replace) and
  replaces the open partition and its own closed partition, which keeps what
  earlier runs of the same day closed. Older closed history is never read or
  rewritten, so the daily cost follows the number of live keys, not the
  length of the history.
* Facts are partitioned by load date and a day is replaced as a whole: by the
  delivery's rows that no other day holds. Rows beyond the watermark of the
  days *before* it need no look; late rows and rows without a time are looked
  up in an index of loaded rows, so that none is lost or loaded twice.
* The watermark is a table of one row per load date, written to a new version
  directory and published last.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimledger.functions.columns import SENTINEL, strip_spaces, ts_lit
from dimledger.operators.scd2 import FROM, TO, scd2_merge
from dimledger.operators.watermark import next_watermark, watermark_value
from dimledger.sources import schemas
from dimledger.sources.readers import BAD_LINE, daily_csv_rejects, read_daily_csv
from dimledger.sources.runs import PlainTable, PublishedTable, Run
from dimledger.sources.sinks import current_version, staged

__all__ = ["read_current", "read_history", "read_facts", "load_dimension", "load_facts", "daily_fraud_run",
           "atomic_fraud_run", "ingest_transactions", "ingest_drop_files",
           "OPEN_PARTITION"]

OPEN_PARTITION = "open"


def read_current(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The published version of a table, or None (or an empty frame of
    ``schema``) before the first load."""
    path = current_version(spark, root)
    if path is None:
        return spark.createDataFrame([], schema) if schema is not None else None
    return spark.read.parquet(path)


def _table(spark: SparkSession, root):
    return PlainTable(spark, root) if isinstance(root, str) else root


def read_history(spark: SparkSession, root, schema: T.StructType,
                 open_only: bool = False) -> DataFrame:
    """A dimension history (all versions, or only the open partition)."""
    hist = _table(spark, root).read()
    if hist is None:  # first load: no table yet
        return spark.createDataFrame([], schema)
    if open_only:
        hist = hist.where(F.col("closed_on") == OPEN_PARTITION)
    return hist.drop("closed_on")


def load_dimension(spark: SparkSession, root, snapshot: DataFrame, key: list[str],
                   tracked: list[str], attrs: list[str], run_ts: Column, run_date: _dt.date,
                   history_schema: T.StructType, from_col: str | None = None, changes=None) -> None:
    """Merge a full source snapshot into the dimension history at ``root`` (a path
    or a table of ``sources.runs``).

    ``changes`` is a table that takes the keys inserted, updated or deleted on
    ``run_date``. A replayed day changes nothing any more, so it keeps the keys
    that the day has already.
    """
    history = _table(spark, root)
    table = history.read()
    open_rows = read_history(spark, history, history_schema, open_only=True)
    merged = scd2_merge(open_rows, snapshot, key=key, tracked=tracked, attrs=attrs,
                        run_ts=run_ts, from_col=from_col, with_change=changes is not None)
    today = run_date.isoformat()
    if changes is not None:
        keys = merged.where(F.col("_chg").isin("I", "U", "D")).select(*key)
        known = changes.read()
        if known is not None:
            keys = keys.unionByName(known.where(F.col("load_date") == F.lit(run_date)).select(*key))
        with staged(keys.distinct()) as copy:
            changes.replace(copy, "load_date", today)
        merged = merged.drop("_chg")
    is_open = F.col(TO) == ts_lit(SENTINEL)
    # Both partitions are replaced by one commit; versions closed by an earlier
    # run of the day stay, and a replayed run does not add them twice.
    closed = merged.where(~is_open)
    if table is not None:
        closed = closed.unionByName(table.where(F.col("closed_on") == today).select(*closed.columns)).distinct()
    labelled = (merged.where(is_open).withColumn("closed_on", F.lit(OPEN_PARTITION))
                .unionByName(closed.withColumn("closed_on", F.lit(today))))
    with staged(labelled) as copy:
        history.replace_all_of(copy, "closed_on", [OPEN_PARTITION, today])


def load_facts(spark: SparkSession, fact_root, meta_root, delivery: DataFrame,
               ts_cols: list[str], load_date: _dt.date, index_root=None) -> None:
    """Make the delivery's rows that no other load date holds the ``load_date``
    partition, then store this date's watermark.

    Rows beyond the watermark of the earlier load dates are new without a
    look. The others, late rows and rows without a time, are looked up in an
    index of loaded rows (a digest per row, by load date): each is kept
    once, on the first date that delivers it. When an older day comes after a
    newer one, all its rows are looked up. The watermark table has a row per
    load date, so a day delivered again, with more rows or none, is complete.
    ``fact_root``, ``meta_root`` and ``index_root`` are paths or tables of
    ``sources.runs``; the index lies beside the watermarks by default.
    """
    if index_root is None:
        index_root = f"{meta_root.rstrip('/')}_index"
    fact, loaded_index = _table(spark, fact_root), _table(spark, index_root)
    watermarks = PublishedTable(spark, meta_root) if isinstance(meta_root, str) else meta_root
    meta = watermarks.read()
    day, today = F.lit(load_date), load_date.isoformat()
    rows = delivery.withColumn("_digest", F.unhex(F.md5(F.to_json(F.struct(*delivery.columns)))))
    index = loaded_index.read()
    if index is not None:
        others = index.where(F.col("load_date") != day).select(F.col("digest").alias("_digest"))
        newest = meta.agg(F.max("load_date")).first()[0]
        if newest is not None and newest > load_date:
            rows = rows.join(others, "_digest", "left_anti")
        else:
            wm = watermark_value(meta.where(F.col("load_date") < day))
            fresh = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > wm, F.lit(False)) for c in ts_cols])
            rows = rows.where(fresh).unionByName(rows.where(~fresh).join(others, "_digest", "left_anti"))
    with staged(rows) as copy:
        fact.replace(copy.drop("_digest"), "load_date", today)
        loaded_index.replace(copy.select(F.col("_digest").alias("digest")), "load_date", today)
    loaded = fact.read().where(F.col("load_date") == day).drop("load_date")
    wm = next_watermark(loaded, ts_cols).withColumn("load_date", day)
    if meta is not None:
        wm = wm.unionByName(meta.where(F.col("load_date") != day))
    watermarks.rewrite(wm)


def read_facts(spark: SparkSession, root, like: DataFrame) -> DataFrame:
    """A fact table, or an empty frame shaped like ``like`` (plus
    ``load_date``) before anything was loaded into it."""
    facts = _table(spark, root).read()
    if facts is None:
        return spark.createDataFrame([], like.withColumn("load_date", F.lit(None).cast("date")).schema)
    return facts


def _upd() -> Column:
    # a version starts at the source's update time, or its creation time (D-06)
    return F.coalesce(F.col("update_dt"), F.col("create_dt")).alias("upd")


HISTORY = {name: schemas.with_history_columns(s) for name, s in
           [("clients", schemas.CLIENTS), ("accounts", schemas.ACCOUNTS), ("cards", schemas.CARDS),
            ("terminals", schemas.TERMINALS_FILE)]}
TERMINAL_ATTRS = ["terminal_type", "terminal_city", "terminal_address"]

# Kinds of daily files: schema and separator.
DROP_FILES = {"terminals": (schemas.TERMINALS_FILE, ","),
              "passport_blacklist": (schemas.BLACKLIST_FILE, ";"),
              "transactions": (schemas.TRANSACTIONS_FILE, ";")}


def _tables(spark: SparkSession, warehouse: str):
    """Tables of a warehouse whose tables are replaced in place, by name."""
    root = warehouse.rstrip("/")
    return lambda name: (PublishedTable if name.startswith("meta_") and not name.endswith("_index")
                         else PlainTable)(spark, f"{root}/{name}")


def _transactions(lines: DataFrame) -> DataFrame:
    return lines.select(strip_spaces("trans_id").alias("trans_id"), F.col("trans_dt").alias("trans_date"),
                        strip_spaces("card_num").alias("card_num"), "oper_type", "amt", "oper_result", "terminal")


def _blacklist(lines: DataFrame) -> DataFrame:
    return lines.select(strip_spaces("passport_num").alias("passport_num"), "entry_dt")


def _load_file(spark: SparkSession, table, kind: str, lines: DataFrame, bad: DataFrame, day: _dt.date) -> None:
    """Load one daily file: its lines into the table of its kind, the bad ones apart."""
    table(f"rejects/{kind}").replace(bad, "load_date", day.isoformat())
    if kind == "terminals":
        load_dimension(spark, table("dim_terminals"), lines, ["terminal_id"], TERMINAL_ATTRS, TERMINAL_ATTRS,
                       ts_lit(day), day, HISTORY["terminals"])
        return
    rows, ts = (_transactions(lines), "trans_date") if kind == "transactions" else (_blacklist(lines), "entry_dt")
    load_facts(spark, table(f"fact_{kind}"), table(f"meta_{kind}"), rows, [ts], day,
               index_root=table(f"meta_{kind}_index"))


def daily_fraud_run(spark: SparkSession, clients: DataFrame, accounts: DataFrame, cards: DataFrame,
                    drop_dir: str, warehouse: str, run_date: _dt.date, table=None) -> None:
    """One day of the bank warehouse, end to end, rerun-safe.

    ``clients`` / ``accounts`` / ``cards`` are full extracts of the source
    system (``sources.schemas.CLIENTS`` / ``ACCOUNTS`` / ``CARDS``); the day's
    ``transactions_DDMMYYYY.csv`` (``;``), ``terminals_DDMMYYYY.csv`` (``,``)
    and ``passport_blacklist_DDMMYYYY.csv`` (``;``) are read from ``drop_dir``.
    Tables live under ``warehouse``: ``dim_*`` (partitioned SCD2 histories) with
    the keys each day changed (``changed_*``), ``fact_*`` (by load date) with
    their ``meta_*`` watermarks, ``rep_fraud`` and ``rep_fraud_retracted`` (by
    report date). The report covers the operations loaded today, matched to
    the owner and the terminal cities valid at each operation's time, and the
    events of earlier operations that owners or blacklist rows of today bring
    about; events that they take away are in ``rep_fraud_retracted``.
    ``fraud.events_in_force`` folds both.

    ``table`` gives the table of a name (``Run.table``); by default the tables
    are replaced in place, one after the other. ``atomic_fraud_run`` commits
    them together.
    """
    from dimledger.plans.fraud import card_owners, fraud_report, late_corrections
    from dimledger.sources.schemas import REPORT, conform

    table = table or _tables(spark, warehouse)
    run_ts, today = ts_lit(run_date), run_date.isoformat()
    client_attrs = ["last_name", "first_name", "patronymic", "date_of_birth", "passport_num",
                    "passport_valid_to", "phone"]
    sources = {
        "clients": (clients.select("client_id", *client_attrs, _upd()),
                    "client_id", ["passport_num", "phone"], client_attrs),
        "accounts": (accounts.select("account_num", "valid_to", "client", _upd()),
                     "account_num", ["client"], ["valid_to", "client"]),
        "cards": (cards.select(strip_spaces("card_num").alias("card_num"), "account_num", _upd()),
                  "card_num", ["account_num"], ["account_num"]),
    }
    for name, (snapshot, key, tracked, attrs) in sources.items():
        load_dimension(spark, table(f"dim_{name}"), snapshot, [key], tracked, attrs, run_ts, run_date,
                       HISTORY[name], from_col="upd", changes=table(f"changed_{name}"))
    for kind, (schema, sep) in DROP_FILES.items():
        _load_file(spark, table, kind, read_daily_csv(spark, drop_dir, kind, run_date, schema, sep=sep),
                   daily_csv_rejects(spark, drop_dir, kind, run_date, schema, sep=sep), run_date)

    cities = read_history(spark, table("dim_terminals"), HISTORY["terminals"])
    clients_all, accounts_all, cards_all = (read_history(spark, table(f"dim_{n}"), HISTORY[n]) for n in sources)
    facts, blacklist = table("fact_transactions").read(), table("fact_passport_blacklist").read()

    def owners_of(some_cards: DataFrame) -> DataFrame:
        # The histories are cut down to the cards (semi-joins) before the
        # point-in-time chain is built: the daily cost follows the active
        # cards, not the whole customer base.
        cards_h = cards_all.join(some_cards, "card_num", "left_semi")
        accounts_h = accounts_all.join(cards_h.select("account_num").distinct(), "account_num", "left_semi")
        clients_h = clients_all.join(accounts_h.select(F.col("client").alias("client_id")).distinct(),
                                     "client_id", "left_semi")
        return card_owners(clients_h, accounts_h, cards_h, versions="pit")

    new = facts.where(F.col("load_date") == F.lit(run_date))
    earlier = facts.where(F.col("load_date") < F.lit(run_date))
    # The velocity rule looks one hour before the first new operation. An
    # operation is never loaded before it happened, so older loads than the
    # date of that instant cannot hold it: the partition filter keeps the
    # look-back from scanning the whole history.
    hour = F.expr("INTERVAL 1 HOUR")
    since = new.select(F.to_date(F.min("trans_date") - hour)).scalar()
    before = earlier.where(F.col("load_date") >= since)
    active = new.select("card_num").unionByName(before.select("card_num")).distinct()
    report = fraud_report(new, owners_of(active), blacklist, cities, report_dt=run_ts, history=before)

    reports, retractions = table("rep_fraud"), table("rep_fraud_retracted")
    past = F.col("report_date") < F.lit(run_date)
    reported, retracted = reports.read(), retractions.read()
    if reported is None:
        retractions.replace(spark.createDataFrame([], REPORT), "report_date", today)
    else:
        changed = {n: table(f"changed_{n}").read().where(F.col("load_date") == F.lit(run_date)).select(key)
                   for n, (_, key, _, _) in sources.items()}
        listed = blacklist.where(F.col("load_date") == F.lit(run_date))
        passports, linked, first = _late_scope(spark, changed, listed, clients_all, accounts_all, cards_all)
        late = earlier.where((F.col("load_date") >= first.select(F.to_date(F.min("at") - hour)).scalar())
                             & (F.col("trans_date") >= first.select(F.min("at") - hour).scalar())
                             ).join(linked, "card_num", "left_semi")
        added, gone = late_corrections(
            reported.where(past), None if retracted is None else retracted.where(past), late,
            owners_of(linked), blacklist, cities, passports, first.select(F.min("at")).scalar(), run_ts)
        report = report.unionByName(added).distinct()
        with staged(conform(gone, REPORT)) as copy:
            retractions.replace(copy, "report_date", today)
    with staged(conform(report, REPORT)) as copy:
        reports.replace(copy, "report_date", today)


def _late_scope(spark: SparkSession, changed: dict[str, DataFrame], listed: DataFrame, clients: DataFrame,
                accounts: DataFrame, cards: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What today's dimension changes and blacklist rows may bear on: passports,
    all cards that have or had one of them, and the instants from which each
    change holds (column ``at``).

    A change bears on cards through the chain client, account, card in any of
    its versions. It holds from the start of the version it opened; before
    that the history is as it was. A blacklist row holds from its entry. The
    joins are on keys of the dimensions, no fact is read.
    """
    def down(client_ids: DataFrame, account_nums: DataFrame, card_nums: DataFrame) -> DataFrame:
        a = account_nums.unionByName(accounts.join(client_ids.withColumnRenamed("client_id", "client"), "client",
                                                   "left_semi").select("account_num")).distinct()
        return card_nums.unionByName(cards.join(a, "account_num", "left_semi").select("card_num")).distinct()

    spaceless = listed.select(strip_spaces("passport_num").alias("_p")).distinct()
    hit = clients.join(spaceless, strip_spaces("passport_num") == F.col("_p"), "left_semi").select("client_id")
    touched = down(changed["clients"].unionByName(hit).distinct(), changed["accounts"], changed["cards"])
    held = accounts.join(cards.join(touched, "card_num", "left_semi"), "account_num", "left_semi")
    passports = (clients.join(held.select(F.col("client").alias("client_id")), "client_id", "left_semi")
                 .select(F.col("passport_num").alias("passport")).distinct().checkpoint())
    holders = (clients.join(passports, F.col("passport_num").eqNullSafe(F.col("passport")), "left_semi")
               .select("client_id").distinct())
    none = [spark.createDataFrame([], f"{c} string") for c in ("account_num", "card_num")]
    linked = down(holders, *none).checkpoint()
    at = listed.select(F.col("entry_dt").alias("at"))
    for hist, keys in ((clients, changed["clients"]), (accounts, changed["accounts"]), (cards, changed["cards"])):
        opened = hist.where(F.col(TO) == ts_lit(SENTINEL)).join(keys, keys.columns, "left_semi")
        at = at.unionByName(opened.select(F.col(FROM).alias("at")))
    return passports, linked, at


def atomic_fraud_run(spark: SparkSession, clients: DataFrame, accounts: DataFrame, cards: DataFrame,
                     drop_dir: str, warehouse: str, run_date: _dt.date) -> int:
    """``daily_fraud_run`` as one run of ``sources.runs``: all its tables change at
    once, or none if any step fails. Returns the number of the committed
    record; ``sources.runs.read_table`` reads the tables."""
    run = Run(spark, warehouse)
    daily_fraud_run(spark, clients, accounts, cards, drop_dir, warehouse, run_date, table=run.table)
    return run.commit()


def ingest_transactions(spark: SparkSession, drop_dir: str, warehouse: str, checkpoint: str,
                        archive_dir: str | None = None):
    """Load every new ``transactions_DDMMYYYY.csv`` in ``drop_dir`` exactly
    once (Structured Streaming file source, one file per micro-batch), each as
    the load date named in its file, behind the transaction watermark. The
    stream checkpoint records which files were done; a replayed batch
    rewrites the same load-date partition."""
    from dimledger.streaming.ingest import ingest_files

    table = _tables(spark, warehouse)

    def load(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn(
            "_day", F.to_date(F.regexp_extract("source_file", r"_(\d{8})\.csv$", 1), "ddMMyyyy"))
        day = named.select(F.min("_day")).first()[0]   # one file per batch: one date
        if day is None:
            return
        _load_file(spark, table, "transactions", named.where(F.col(BAD_LINE).isNull()),
                   named.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line")), day)

    return ingest_files(spark, drop_dir, schemas.TRANSACTIONS_FILE, checkpoint, load,
                        archive_dir=archive_dir, max_files_per_trigger=1, pattern="transactions_*.csv")


def ingest_drop_files(spark: SparkSession, drop_dir: str, warehouse: str, checkpoint: str,
                      archive_dir: str | None = None, files_per_batch: int = 30):
    """Load every new daily file of the three kinds in ``drop_dir`` exactly once,
    by one stream.

    The stream carries file names only (contents are not read by it) and its
    checkpoint records which files were done. Each batch is one run of
    ``sources.runs`` over all tables: files are routed by name to the schema
    and table of their kind, in order of their days, and committed together.
    A batch that fails leaves every table as it was and is replayed: a header
    that does not name its columns in order fails the batch before any of it
    counts. A batch replayed after its commit replaces the same partitions.

    Bad lines go to ``rejects/<kind>``, names of no kind or day to
    ``rejects/names`` (by the day of the pickup's batch number), and a terminal
    file older than one already merged to ``rejects/late_terminals`` with its
    rows, because the in-order merge cannot place it. Loaded files are moved
    to ``archive_dir`` by Spark.
    """
    from dimledger.streaming.ingest import ingest_names

    name_of = r"^(terminals|passport_blacklist|transactions)_([0-9]{8})\.csv$"

    def load(batch: DataFrame, batch_id: int) -> None:
        names = batch.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path")
        day = F.try_to_date(F.regexp_extract("name", name_of, 2), "ddMMyyyy")
        # At most files_per_batch names: the driver routes files, never their lines.
        routed = sorted(((r.day, r.kind, r.name, r.path) for r in names.select(
            day.alias("day"), F.regexp_extract("name", name_of, 1).alias("kind"), "name", "path").collect()),
            key=lambda r: (r[0] is not None, r[0], list(DROP_FILES).index(r[1]) if r[1] else -1, r[2]))
        with Run(spark, warehouse) as run:
            unknown = [(name,) for d, _, name, _ in routed if d is None]
            if unknown:
                run.table("rejects/names").replace(spark.createDataFrame(unknown, "name string"),
                                                   "batch", str(batch_id))
            for d, kind, name, path in routed:
                if d is None:
                    continue
                schema, sep = DROP_FILES[kind]
                folder = path[:-len(name) - 1]
                lines = read_daily_csv(spark, folder, kind, d, schema, sep=sep)
                if kind == "terminals" and _merged_after(run.table("rejects/terminals"), d):
                    run.table("rejects/late_terminals").replace(lines, "load_date", d.isoformat())
                    continue
                _load_file(spark, run.table, kind, lines,
                           daily_csv_rejects(spark, folder, kind, d, schema, sep=sep), d)

    return ingest_names(spark, drop_dir, checkpoint, load, archive_dir=archive_dir,
                        max_files_per_trigger=files_per_batch, pattern="*.csv")


def _merged_after(done, day: _dt.date) -> bool:
    """Whether a partition of the reject table names a later day (each load makes one)."""
    return any(part.split("=")[1] > day.isoformat() for part in done.run.tables.get(done.name, {}))

"""Query catalogue over the supplied test tables.

The bank, retail and promo tables of the reference are not in the test
data, so each operator runs on an analogue built from the TPC-H-like
tables. The adapters below only rename and derive columns; the work is done
by the library operators. Every query reads whole tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is
DuckDB SQL over the same parquet files giving the same rows.
"""

from __future__ import annotations

import datetime as _dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimledger.functions.columns import ts_lit
from dimledger.operators.relational import (anti_join, any_level_join, exclude, expand_hierarchy,
                                            fill, hierarchy_roots, latest_per_key, normalise_missing,
                                            null_safe_join, profile, snapshot_as_of, sum_by)
from dimledger.operators.bitemporal import deliver, state_schema, versions_of
from dimledger.operators.intervals import overlap_join
from dimledger.operators.scd2 import pit_join, scd2_history, scd2_merge
from dimledger.operators.watermark import delta_since, next_watermark, watermark_value
from dimledger.plans import bank, feed, fraud, promo, promo_events
from dimledger.session import checkpoint_dir
from dimledger.sources.readers import read_docs, sql_query
from dimledger.sources.runs import Run, read_table
from dimledger.sources.sinks import replace_window

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


_RELATIONS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One lazy relation per table and session, as a catalog table would be:
    the file listing and footer schema are read once, and queries that use a
    table twice refer to the same relation."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _RELATIONS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _RELATIONS[key] = spark.read.parquet(path)
    return df


# ---------------------------------------------------------------- analogues
# client := customer; card, account := customer (velocity) or order (contract)

def clients_of(customer: DataFrame, passport_valid_to=None) -> DataFrame:
    valid_to = passport_valid_to if passport_valid_to is not None else F.lit(None).cast("date")
    return customer.select(
        F.col("c_custkey").alias("client_id"), F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_nationkey").cast("string").alias("patronymic"),
        F.col("c_name").alias("passport_num"), valid_to.alias("passport_valid_to"),
        F.concat(F.lit("+7"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("phone"))


def expiring_passports(customer: DataFrame) -> DataFrame:
    """Passports of BUILDING clients never expire; the others end 1998-01-01."""
    return clients_of(customer, F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("date"))
                      .otherwise(F.lit(_dt.date(1998, 1, 1))))


def owners_by_customer(customer: DataFrame, clients: DataFrame | None = None) -> DataFrame:
    """Card = account = client: owners keyed by customer key."""
    accounts = customer.select(F.col("c_custkey").alias("account_num"),
                               F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                               F.col("c_custkey").alias("client"))
    cards = customer.select(F.col("c_custkey").alias("card_num"), F.col("c_custkey").alias("account_num"))
    return fraud.card_owners(clients if clients is not None else clients_of(customer),
                             accounts, cards, versions="all")


def owners_by_order(customer: DataFrame, orders: DataFrame, contract_days: int = 90,
                    clients: DataFrame | None = None) -> DataFrame:
    """Card = account = order; the contract ends ``contract_days`` after the order."""
    accounts = orders.select(F.col("o_orderkey").alias("account_num"),
                             (F.col("o_orderdate") + F.make_interval(days=F.lit(contract_days)))
                             .alias("valid_to"),
                             F.col("o_custkey").alias("client"))
    cards = orders.select(F.col("o_orderkey").alias("card_num"), F.col("o_orderkey").alias("account_num"))
    return fraud.card_owners(clients if clients is not None else clients_of(customer),
                             accounts, cards, versions="all")


def event_txns(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("trans_id"), F.col("ts").alias("trans_date"),
                         F.col("user_id").alias("card_num"),
                         F.regexp_extract("props", r"(\d+)", 1).try_cast("bigint").alias("terminal"))


def lineitem_txns(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trans_id"),
        F.col("l_shipdate").alias("trans_date"), F.col("l_orderkey").alias("card_num"),
        F.col("l_suppkey").alias("terminal"))


def order_txns(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").cast("string").alias("trans_id"),
                         F.col("o_orderdate").alias("trans_date"), F.col("o_custkey").alias("card_num"),
                         F.lit(None).cast("bigint").alias("terminal"))


def supplier_terminals(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("terminal_id"), F.col("n_name").alias("terminal_city"))


def urgent_blacklist(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """A client is blacklisted at each urgent, finished order."""
    o = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return (o.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_name").alias("passport_num"), F.col("o_orderdate").alias("entry_dt")))


SQL_CLIENT = ("c.c_name AS passport, c.c_name || ' ' || c.c_mktsegment || ' ' || "
              "CAST(c.c_nationkey AS VARCHAR) AS fio, "
              "'+7' || lpad(CAST(c.c_custkey AS VARCHAR), 10, '0') AS phone")

# ------------------------------------------------------------------ fraud


VELOCITY_SQL = f"""
WITH t AS (
  SELECT event_id AS trans_id, ts AS trans_date, user_id AS card_num,
         TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS terminal
  FROM events),
l AS (
  SELECT card_num, trans_date, terminal,
         lag(trans_date) OVER (PARTITION BY card_num ORDER BY trans_date, trans_id) AS prev_dt,
         lag(terminal) OVER (PARTITION BY card_num ORDER BY trans_date, trans_id) AS prev_terminal
  FROM t),
city AS (
  SELECT s.s_suppkey AS terminal_id, n.n_name AS terminal_city
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey),
moved AS (
  SELECT l.card_num, l.trans_date FROM l
  LEFT JOIN city c1 ON c1.terminal_id = l.terminal
  LEFT JOIN city c2 ON c2.terminal_id = l.prev_terminal
  WHERE l.prev_dt IS NOT NULL AND l.trans_date - l.prev_dt < INTERVAL 1 HOUR
    AND c1.terminal_city <> c2.terminal_city)
SELECT m.trans_date AS event_dt, {SQL_CLIENT}, 3 AS event_type
FROM moved m JOIN customer c ON c.c_custkey = m.card_num
"""


@query("velocity_rule", VELOCITY_SQL)
def q_velocity_rule(spark, d):
    customer = table(spark, d, "customer")
    return fraud.velocity_rule(event_txns(table(spark, d, "events")),
                               supplier_terminals(table(spark, d, "supplier"), table(spark, d, "nation")),
                               owners_by_customer(customer))


BLACKLIST_SQL = f"""
WITH bl AS (
  SELECT replace(c.c_name, ' ', '') AS passport, min(o.o_orderdate) AS entry_dt
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F'
  GROUP BY 1)
SELECT o.o_orderdate AS event_dt, {SQL_CLIENT}, 1 AS event_type
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN bl ON bl.passport = replace(c.c_name, ' ', '')
WHERE bl.entry_dt < o.o_orderdate
"""


@query("rule_blacklisted", BLACKLIST_SQL)
def q_rule_blacklisted(spark, d):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    return fraud.rule_blacklisted(order_txns(orders), owners_by_customer(customer),
                                  urgent_blacklist(orders, customer))


CONTRACT_SQL = f"""
SELECT l.l_shipdate AS event_dt, {SQL_CLIENT}, 2 AS event_type
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
WHERE l.l_shipdate > o.o_orderdate + INTERVAL 90 DAY
"""


@query("rule_expired_contract", CONTRACT_SQL)
def q_rule_expired_contract(spark, d):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    return fraud.rule_expired_contract(lineitem_txns(table(spark, d, "lineitem")),
                                       owners_by_order(customer, orders))


DOCUMENT_SQL = f"""
SELECT o.o_orderdate AS event_dt, {SQL_CLIENT}, 1 AS event_type
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE o.o_orderpriority = '1-URGENT' AND c.c_mktsegment <> 'BUILDING'
  AND CAST(DATE '1998-01-01' AS TIMESTAMP) < o.o_orderdate
"""


@query("rule_expired_document", DOCUMENT_SQL)
def q_rule_expired_document(spark, d):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    urgent = order_txns(orders.where(F.col("o_orderpriority") == "1-URGENT"))
    return fraud.rule_expired_document(urgent, owners_by_customer(customer, expiring_passports(customer)))


REPORT_SQL = f"""
WITH bl AS (
  SELECT replace(c.c_name, ' ', '') AS passport, min(o.o_orderdate) AS entry_dt
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F'
  GROUP BY 1),
t AS (
  SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                   CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR)) AS trans_id,
         l.l_shipdate AS trans_date, l.l_orderkey AS card_num, l.l_suppkey AS terminal
  FROM lineitem l),
own AS (
  SELECT o.o_orderkey AS card_num, o.o_orderdate + INTERVAL 90 DAY AS account_valid_to,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE DATE '1998-01-01' END AS passport_valid_to,
         replace(c.c_name, ' ', '') AS norm_passport, {SQL_CLIENT}
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
j AS (SELECT t.trans_date, own.*, bl.entry_dt FROM t JOIN own ON own.card_num = t.card_num
      LEFT JOIN bl ON bl.passport = own.norm_passport),
l AS (
  SELECT card_num, trans_date, terminal,
         lag(trans_date) OVER (PARTITION BY card_num ORDER BY trans_date, trans_id) AS prev_dt,
         lag(terminal) OVER (PARTITION BY card_num ORDER BY trans_date, trans_id) AS prev_terminal
  FROM t),
city AS (
  SELECT s.s_suppkey AS terminal_id, n.n_name AS terminal_city
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey),
moved AS (
  SELECT l.card_num, l.trans_date FROM l
  LEFT JOIN city c1 ON c1.terminal_id = l.terminal
  LEFT JOIN city c2 ON c2.terminal_id = l.prev_terminal
  WHERE l.prev_dt IS NOT NULL AND l.trans_date - l.prev_dt < INTERVAL 1 HOUR
    AND c1.terminal_city <> c2.terminal_city),
ev AS (
  SELECT trans_date AS event_dt, passport, fio, phone, 1 AS event_type FROM j WHERE entry_dt < trans_date
  UNION ALL
  SELECT trans_date, passport, fio, phone, 1 FROM j
   WHERE passport_valid_to IS NOT NULL AND CAST(passport_valid_to AS TIMESTAMP) < trans_date
  UNION ALL
  SELECT trans_date, passport, fio, phone, 2 FROM j WHERE trans_date > account_valid_to
  UNION ALL
  SELECT m.trans_date, own.passport, own.fio, own.phone, 3 FROM moved m JOIN own ON own.card_num = m.card_num)
SELECT DISTINCT event_dt, passport, fio, phone, event_type, TIMESTAMP '2024-02-01 00:00:00' AS report_dt
FROM ev
"""


@query("fraud_report", REPORT_SQL)
def q_fraud_report(spark, d):
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    owners = owners_by_order(customer, orders, 90, expiring_passports(customer))
    return fraud.fraud_report(lineitem_txns(table(spark, d, "lineitem")), owners,
                              urgent_blacklist(orders, customer),
                              supplier_terminals(table(spark, d, "supplier"), table(spark, d, "nation")),
                              report_dt=ts_lit("2024-02-01"))


@query("fraud_report_late", REPORT_SQL)
def q_fraud_report_late(spark, d):
    """The report over all operations when a third of the blacklist and the
    contracts of some cards arrive late: built on what was known first, then
    refreshed; equal to the report from scratch."""
    folder = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="dimledger-ckpt-"))
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    txn = lineitem_txns(table(spark, d, "lineitem"))
    terminals = supplier_terminals(table(spark, d, "supplier"), table(spark, d, "nation"))
    owners = owners_by_order(customer, orders, 90, expiring_passports(customer))
    blacklist = urgent_blacklist(orders, customer)
    late = F.pmod(F.xxhash64("passport_num"), F.lit(3)) == 0
    known_owners = owners.withColumn("account_valid_to", F.when(
        F.pmod(F.xxhash64("card_num"), F.lit(50)) != 0, F.col("account_valid_to")))
    known = (known_owners, blacklist.where(~late))
    path = f"{folder}/dimledger-query/{uuid.uuid4().hex}"
    fraud.fraud_report(txn, *known, terminals, report_dt=ts_lit("2024-02-01")).write.parquet(path)
    return fraud.refresh_report(spark.read.parquet(path), txn, known, (owners, blacklist), terminals,
                                report_dt=ts_lit("2024-02-01"))


# ------------------------------------------------------------------ SCD2

SENT = "TIMESTAMP '5999-12-31 00:00:00'"


def open_end_as_null(hist: DataFrame) -> DataFrame:
    """History as the catalogue shows it: the open end (the 5999-12-31
    sentinel, kept as such in the tables) appears as ``effective_to`` NULL
    with ``is_open`` true. Year 5999 is outside the nanosecond range that
    pandas conversions of a result use; the mapping is one-to-one."""
    is_open = F.col("effective_to") == ts_lit("5999-12-31")
    cols = [c for c in hist.columns if c != "effective_to"]
    return hist.select(*cols[:cols.index("effective_from") + 1],
                       F.when(~is_open, F.col("effective_to")).alias("effective_to"),
                       *cols[cols.index("effective_from") + 1:], is_open.alias("is_open"))


def sql_open_end_as_null(cte: str, cols: str) -> str:
    return (f"SELECT {cols}, effective_from, CASE WHEN effective_to = {SENT} THEN NULL ELSE effective_to END "
            f"AS effective_to, deleted_flg, effective_to = {SENT} AS is_open FROM {cte}")

HISTORY_CTE = f"""
o AS (
  SELECT o_custkey AS client_id, o_orderpriority AS priority, o_orderdate AS ts, o_orderkey AS tie,
         lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_p,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders),
s AS (SELECT * FROM o WHERE rn = 1 OR prev_p IS DISTINCT FROM priority),
hist AS (
  SELECT client_id, priority, ts AS effective_from,
         coalesce(lead(ts) OVER (PARTITION BY client_id ORDER BY ts, tie) - INTERVAL 1 SECOND, {SENT})
           AS effective_to,
         0 AS deleted_flg
  FROM s)"""


def priority_history(orders: DataFrame) -> DataFrame:
    changes = orders.select(F.col("o_custkey").alias("client_id"),
                            F.col("o_orderpriority").alias("priority"),
                            F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tie"))
    return scd2_history(changes, ["client_id"], ["priority"], "ts", "tie")


@query("scd2_history", f"WITH {HISTORY_CTE} {sql_open_end_as_null('hist', 'client_id, priority')}")
def q_scd2_history(spark, d):
    return open_end_as_null(priority_history(table(spark, d, "orders")))


# Years in the order in which their snapshots are delivered; the year 1998 comes twice.
DELIVERED = [1998, 1995, 2001, 1996, 2000, 1998, 1997, 1999]


def _out_of_order_sql(years: list[int]) -> str:
    """Versions from the snapshots of ``years``, from their meaning: runs of
    delivered years in which a client is present with one priority."""
    days = ", ".join(f"({i}, {y})" for i, y in enumerate(sorted(set(years))))
    return f"""
WITH day(n, y) AS (VALUES {days}),
start AS (SELECT n, make_timestamp(y + 1, 1, 1, 0, 0, 0.0) AS t FROM day),
state AS (
  SELECT n, o_custkey AS client_id, o_orderpriority AS priority, o_orderstatus AS status
  FROM orders JOIN day ON y = year(o_orderdate)
  QUALIFY row_number() OVER (PARTITION BY o_custkey, n ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
marked AS (
  SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(priority) OVER w IS NOT DISTINCT FROM priority THEN 0 ELSE 1 END AS fresh
  FROM state WINDOW w AS (PARTITION BY client_id ORDER BY n)),
run AS (SELECT *, sum(fresh) OVER (PARTITION BY client_id ORDER BY n) AS r FROM marked),
version AS (
  SELECT client_id, min_by(priority, n) AS priority, min_by(status, n) AS status, min(n) AS a, max(n) + 1 AS b,
         lead(min(n)) OVER (PARTITION BY client_id ORDER BY min(n)) AS following
  FROM run GROUP BY client_id, r),
spans AS (
  SELECT client_id, priority, status, a, b, 0 AS deleted_flg FROM version
  UNION ALL
  SELECT client_id, priority, status, b, coalesce(following, 1000), 1 FROM version
  WHERE b < (SELECT count(*) FROM day) AND (following IS NULL OR following > b)),
hist AS (
  SELECT client_id, priority, status, s.t AS effective_from,
         coalesce(e.t - INTERVAL 1 SECOND, {SENT}) AS effective_to, deleted_flg
  FROM spans JOIN start s ON s.n = a LEFT JOIN start e ON e.n = b)
{sql_open_end_as_null("hist", "client_id, priority, status")}"""


def _delivered_states(spark, d) -> DataFrame:
    """A client's latest order of a year, delivered year by year in the order
    of ``DELIVERED``. A year's snapshot is valid from the next New Year."""
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="dimledger-ckpt-"))
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("client_id"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"), "o_orderdate", "o_orderkey", F.year("o_orderdate").alias("year"))
    latest = latest_per_key(orders, ["client_id", "year"], ["o_orderdate", "o_orderkey"]).checkpoint()
    states = spark.createDataFrame([], state_schema(latest.select("client_id", "priority", "status").schema.fields))
    seen: set[int] = set()
    for n, year in enumerate(DELIVERED):
        later = min((y for y in seen if y > year), default=None)
        states = deliver(states, latest.where(F.col("year") == year), ["client_id"], ["priority", "status"],
                         valid_from=ts_lit(_dt.date(year + 1, 1, 1)), load_time=ts_lit(_dt.date(2010, 1, n + 1)),
                         next_valid=None if later is None else ts_lit(_dt.date(later + 1, 1, 1))).checkpoint()
        seen.add(year)
    return states


@query("scd2_out_of_order", _out_of_order_sql(DELIVERED))
def q_scd2_out_of_order(spark, d):
    """The history after all deliveries: the same as after loading in order."""
    return open_end_as_null(versions_of(_delivered_states(spark, d), ["client_id"], ["priority", "status"],
                                        ["priority"]))


@query("scd2_known_then", _out_of_order_sql(DELIVERED[:4]))
def q_scd2_known_then(spark, d):
    """The history as it was believed after the fourth delivery."""
    return open_end_as_null(versions_of(_delivered_states(spark, d), ["client_id"], ["priority", "status"],
                                        ["priority"], known_at=ts_lit(_dt.date(2010, 1, 4))))


@query("owner_overlap", f"""
WITH {HISTORY_CTE},
big AS (
  SELECT o_custkey AS client_id, o_totalprice >= 250000 AS large, o_orderdate AS ts, o_orderkey AS tie,
         lag(o_totalprice >= 250000) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before
  FROM orders),
size AS (
  SELECT client_id, large, ts AS f, coalesce(lead(ts) OVER (PARTITION BY client_id ORDER BY ts, tie)
         - INTERVAL 1 SECOND, {SENT}) AS t
  FROM big WHERE before IS DISTINCT FROM large),
both_ AS (
  SELECT hist.client_id, priority, large, greatest(effective_from, f) AS effective_from,
         least(effective_to, t) AS effective_to, deleted_flg
  FROM hist JOIN size ON size.client_id = hist.client_id AND effective_from <= t AND f <= effective_to
  WHERE f <= t AND effective_from <= effective_to)
{sql_open_end_as_null("both_", "client_id, priority, large")}""")
def q_owner_overlap(spark, d):
    """Two histories of a client, priority and order size, on the intersection of their validity."""
    orders = table(spark, d, "orders")
    sizes = scd2_history(orders.select(F.col("o_custkey").alias("size_client"), F.col("o_orderdate").alias("ts"),
                                       (F.col("o_totalprice") >= 250000).alias("large"),
                                       F.col("o_orderkey").alias("tie")), ["size_client"], ["large"], "ts", "tie")
    both = overlap_join(priority_history(orders), sizes.drop("deleted_flg"), "client_id", "size_client",
                        "effective_from", "effective_to")
    return open_end_as_null(both.select("client_id", "priority", "large", "effective_from", "effective_to",
                                        "deleted_flg"))


PIT_SQL = f"""
WITH {HISTORY_CTE},
f AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, o.o_custkey AS client_id
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT f.*, h.priority, h.effective_from
FROM f JOIN hist h ON h.client_id = f.client_id
 AND f.l_shipdate >= h.effective_from AND f.l_shipdate < h.effective_to + INTERVAL 1 SECOND
"""


def _pit(spark, d, method):
    orders = table(spark, d, "orders")
    facts = (table(spark, d, "lineitem")
             .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
             .select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                     F.col("o_custkey").alias("client_id")))
    return pit_join(facts, priority_history(orders), ["client_id"], ["client_id"], "l_shipdate",
                    ["priority", "effective_from"], method=method)


@query("pit_join", PIT_SQL)
def q_pit_join(spark, d):
    return _pit(spark, d, "asof")


@query("pit_join_range", PIT_SQL)
def q_pit_join_range(spark, d):
    return _pit(spark, d, "range")


def latest_order_state(orders: DataFrame, before: str) -> DataFrame:
    o = orders.where(F.col("o_orderdate") < ts_lit(before))
    latest = latest_per_key(o.select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus",
                                     "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.select(F.col("o_custkey").alias("client_id"), F.col("o_orderpriority").alias("priority"),
                         F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("update_dt"))


HIST_SCHEMA = T.StructType([
    T.StructField("client_id", T.LongType()), T.StructField("priority", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("effective_from", T.TimestampNTZType()),
    T.StructField("effective_to", T.TimestampNTZType()), T.StructField("deleted_flg", T.IntegerType())])


def _snapshot_sql(cte: str, before: str, extra: str = "") -> str:
    return f"""{cte} AS (
  SELECT client_id, priority, status, update_dt FROM (
    SELECT o_custkey AS client_id, o_orderpriority AS priority, o_orderstatus AS status,
           o_orderdate AS update_dt,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate < TIMESTAMP '{before}' {extra}) x WHERE rn = 1)"""


MERGE_SQL = f"""
WITH {_snapshot_sql('s1', '1995-07-01 00:00:00')},
{_snapshot_sql('s2', '1995-10-01 00:00:00',
               'AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)')},
h1 AS (SELECT client_id, priority, status, update_dt AS effective_from FROM s1),
j AS (SELECT h.client_id AS hk, h.priority AS hp, h.status AS hs, h.effective_from AS hf,
             s.client_id AS sk, s.priority AS sp, s.status AS ss, s.update_dt AS sf
      FROM h1 h FULL OUTER JOIN s2 s ON h.client_id = s.client_id),
merged AS (
SELECT hk AS client_id, hp AS priority, hs AS status, hf AS effective_from, {SENT} AS effective_to,
       0 AS deleted_flg
FROM j WHERE hk IS NOT NULL AND sk IS NOT NULL AND hp IS NOT DISTINCT FROM sp
UNION ALL
SELECT hk, hp, hs, hf, sf - INTERVAL 1 SECOND, 0 FROM j
WHERE hk IS NOT NULL AND sk IS NOT NULL AND hp IS DISTINCT FROM sp
UNION ALL
SELECT sk, sp, ss, sf, {SENT}, 0 FROM j WHERE sk IS NOT NULL AND (hk IS NULL OR hp IS DISTINCT FROM sp)
UNION ALL
SELECT hk, hp, hs, hf, TIMESTAMP '1995-10-01 00:00:00' - INTERVAL 1 SECOND, 0 FROM j WHERE sk IS NULL
UNION ALL
SELECT hk, hp, hs, TIMESTAMP '1995-10-01 00:00:00', {SENT}, 1 FROM j WHERE sk IS NULL)
{sql_open_end_as_null('merged', 'client_id, priority, status')}
"""


@query("scd2_merge", MERGE_SQL)
def q_scd2_merge(spark, d):
    """History loaded from the 1995-07-01 state, then the 1995-10-01 state in
    which clients with a negative balance have been closed."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    s1 = latest_order_state(orders, "1995-07-01")
    closed = customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("client_id"))
    s2 = anti_join(latest_order_state(orders, "1995-10-01"), closed, "client_id")
    empty = spark.createDataFrame([], HIST_SCHEMA)
    # both states are one row per client already (latest_order_state)
    args = dict(key=["client_id"], tracked=["priority"], attrs=["priority", "status"], from_col="update_dt",
                dedupe=False)
    h1 = scd2_merge(empty, s1, run_ts=ts_lit("1995-07-01"), **args)
    return open_end_as_null(scd2_merge(h1, s2, run_ts=ts_lit("1995-10-01"), **args))


CHANGES_SQL = f"""
WITH {_snapshot_sql('s1', '1995-07-01 00:00:00')},
{_snapshot_sql('s2', '1995-10-01 00:00:00',
               'AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)')}
SELECT coalesce(s1.client_id, s2.client_id) AS client_id,
       CASE WHEN s1.client_id IS NULL THEN 'I' WHEN s2.client_id IS NULL THEN 'D'
            WHEN s1.priority IS DISTINCT FROM s2.priority THEN 'U' ELSE 'S' END AS change
FROM s1 FULL OUTER JOIN s2 ON s1.client_id = s2.client_id
"""


@query("scd2_changes", CHANGES_SQL)
def q_scd2_changes(spark, d):
    """How each client is classified by the second load of ``scd2_merge``:
    I(nsert), U(pdate), D(elete) or S(ame)."""
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    s1 = latest_order_state(orders, "1995-07-01")
    closed = customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("client_id"))
    s2 = anti_join(latest_order_state(orders, "1995-10-01"), closed, "client_id")
    args = dict(key=["client_id"], tracked=["priority"], attrs=["priority", "status"], from_col="update_dt",
                dedupe=False)
    h1 = scd2_merge(spark.createDataFrame([], HIST_SCHEMA), s1, run_ts=ts_lit("1995-07-01"), **args)
    merged = scd2_merge(h1, s2, run_ts=ts_lit("1995-10-01"), with_change=True, **args)
    return merged.where(F.col("_chg").isNotNull()).select("client_id", F.col("_chg").alias("change")).distinct()


TERMINAL_MERGE_SQL = f"""
WITH s1 AS (
  SELECT s.s_suppkey AS terminal_id, s.s_name AS terminal_address, n.n_name AS terminal_city
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey),
s2 AS (
  SELECT s.s_suppkey AS terminal_id, s.s_name AS terminal_address,
         CASE WHEN s.s_acctbal > 5000 THEN r.r_name ELSE n.n_name END AS terminal_city
  FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  WHERE s.s_acctbal >= 0),
j AS (SELECT h.terminal_id AS hk, h.terminal_address AS ha, h.terminal_city AS hc,
             s.terminal_id AS sk, s.terminal_address AS sa, s.terminal_city AS sc
      FROM s1 h FULL OUTER JOIN s2 s ON h.terminal_id = s.terminal_id),
merged AS (
SELECT hk AS terminal_id, ha AS terminal_address, hc AS terminal_city,
       TIMESTAMP '2024-01-01 00:00:00' AS effective_from, {SENT} AS effective_to, 0 AS deleted_flg
FROM j WHERE sk IS NOT NULL AND hc IS NOT DISTINCT FROM sc AND ha IS NOT DISTINCT FROM sa
UNION ALL
SELECT hk, ha, hc, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-02 00:00:00' - INTERVAL 1 SECOND, 0
FROM j WHERE hk IS NOT NULL AND (sk IS NULL OR hc IS DISTINCT FROM sc OR ha IS DISTINCT FROM sa)
UNION ALL
SELECT sk, sa, sc, TIMESTAMP '2024-01-02 00:00:00', {SENT}, 0
FROM j WHERE sk IS NOT NULL AND (hk IS NULL OR hc IS DISTINCT FROM sc OR ha IS DISTINCT FROM sa)
UNION ALL
SELECT hk, ha, hc, TIMESTAMP '2024-01-02 00:00:00', {SENT}, 1 FROM j WHERE sk IS NULL)
{sql_open_end_as_null('merged', 'terminal_id, terminal_address, terminal_city')}
"""


@query("scd2_snapshot_merge", TERMINAL_MERGE_SQL)
def q_scd2_snapshot_merge(spark, d):
    """Terminal-style dimension: full daily snapshots, versions stamped with
    the load date. Day two moves rich terminals to their region's city and
    drops terminals with a negative balance."""
    supplier, nation, region = (table(spark, d, n) for n in ("supplier", "nation", "region"))
    base = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    s1 = base.select(F.col("s_suppkey").alias("terminal_id"), F.col("s_name").alias("terminal_address"),
                     F.col("n_name").alias("terminal_city"))
    s2 = (base.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
          .where(F.col("s_acctbal") >= 0)
          .select(F.col("s_suppkey").alias("terminal_id"), F.col("s_name").alias("terminal_address"),
                  F.when(F.col("s_acctbal") > 5000, F.col("r_name")).otherwise(F.col("n_name"))
                  .alias("terminal_city")))
    schema = T.StructType([
        T.StructField("terminal_id", T.LongType()), T.StructField("terminal_address", T.StringType()),
        T.StructField("terminal_city", T.StringType()),
        T.StructField("effective_from", T.TimestampNTZType()),
        T.StructField("effective_to", T.TimestampNTZType()), T.StructField("deleted_flg", T.IntegerType())])
    args = dict(key=["terminal_id"], tracked=["terminal_address", "terminal_city"],
                attrs=["terminal_address", "terminal_city"])
    h1 = scd2_merge(spark.createDataFrame([], schema), s1, run_ts=ts_lit("2024-01-01"), **args)
    return open_end_as_null(scd2_merge(h1, s2, run_ts=ts_lit("2024-01-02"), **args))


# ------------------------------------------------------------- watermarks

@query("watermark_delta", """
SELECT * FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2001-06-01 00:00:00')
""")
def q_watermark_delta(spark, d):
    """Orders loaded after the watermark left by the load that ran before 2001-06-01."""
    orders = table(spark, d, "orders")
    meta = next_watermark(orders.where(F.col("o_orderdate") < ts_lit("2001-06-01")), ["o_orderdate"])
    return delta_since(orders, watermark_value(meta), ["o_orderdate"])


TWO_COL_CTE = """
acc AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_orderdate AS create_dt,
         CASE WHEN l.l_linestatus = 'F' THEN l.l_shipdate END AS update_dt
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""


def _accounts_like(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return (table(spark, d, "lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("o_orderdate").alias("create_dt"),
                    F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("update_dt")))


@query("two_col_watermark", f"""
WITH {TWO_COL_CTE}
SELECT * FROM acc
WHERE create_dt > TIMESTAMP '2001-06-01 00:00:00'
   OR (update_dt IS NOT NULL AND update_dt > TIMESTAMP '2001-06-01 00:00:00')
""")
def q_two_col_watermark(spark, d):
    return delta_since(_accounts_like(spark, d), ts_lit("2001-06-01"), ["create_dt", "update_dt"])


@query("next_watermark", f"""
WITH {TWO_COL_CTE},
delta AS (SELECT * FROM acc WHERE create_dt > TIMESTAMP '2001-06-01 00:00:00'
          OR (update_dt IS NOT NULL AND update_dt > TIMESTAMP '2001-06-01 00:00:00'))
SELECT greatest(TIMESTAMP '2001-06-01 00:00:00', (SELECT max(create_dt) FROM delta),
                (SELECT max(update_dt) FROM delta)) AS max_update_dt
""")
def q_next_watermark(spark, d):
    previous = spark.range(1).select(ts_lit("2001-06-01").alias("max_update_dt"))
    delta = delta_since(_accounts_like(spark, d), watermark_value(previous), ["create_dt", "update_dt"])
    return next_watermark(delta, ["create_dt", "update_dt"], previous)


# ------------------------------------------------------ relational helpers

@query("not_in_terminals", """
SELECT * FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F')
""")
def q_not_in(spark, d):
    li = table(spark, d, "lineitem").where((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"))
    return anti_join(table(spark, d, "part"), li, "p_partkey", "l_partkey", null_aware=True)


@query("snapshot_as_of", """
SELECT * FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1999-06-15 12:00:00')
""")
def q_snapshot_as_of(spark, d):
    return snapshot_as_of(table(spark, d, "orders"), "o_orderdate", ts_lit("1999-06-15 12:00:00"))


@query("latest_per_key", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) x WHERE rn = 1
""")
def q_latest_per_key(spark, d):
    return latest_per_key(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("null_keeping_filter", """
SELECT p_partkey, p_type FROM (SELECT p_partkey, nullif(p_type, 'SMALL') AS p_type FROM part) x
WHERE p_type IS NULL OR p_type NOT IN ('ECONOMY', 'PROMO')
""")
def q_null_keeping_filter(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("p_type"))
    return exclude(p, "p_type", ["ECONOMY", "PROMO"], keep_null=True)


@query("null_safe_merge", """
SELECT p.p_partkey, p.p_size, n.n_name
FROM part p JOIN nation n ON nullif(p.p_size, 7) IS NOT DISTINCT FROM nullif(n.n_nationkey, 7)
""")
def q_null_safe_merge(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", F.nullif("p_size", F.lit(7)).alias("_k"))
    n = table(spark, d, "nation").select("n_name", F.nullif("n_nationkey", F.lit(7)).alias("_nk"))
    return null_safe_join(p, n, [("_k", "_nk")]).select("p_partkey", "p_size", "n_name")


@query("fill_normalise", """
SELECT p_partkey,
       coalesce(CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_type END, 'x') AS class,
       CASE WHEN p_size > 45 OR p_size < 3 THEN 0.0 ELSE p_retailprice END AS measure,
       CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_brand END AS brand
FROM part
""")
def q_fill_normalise(spark, d):
    p = table(spark, d, "part").select(
        "p_partkey",
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("class"),
        F.when(F.col("p_size") > 45, F.lit(float("nan")))
        .when(F.col("p_size") < 3, F.lit(None).cast("double"))
        .otherwise(F.col("p_retailprice")).alias("measure"),
        F.when(F.col("p_brand") == "Brand#1", F.lit("None")).otherwise(F.col("p_brand")).alias("brand"))
    p = normalise_missing(p, ["measure", "brand"])
    return fill(p, {"class": "x", "measure": 0.0})


@query("replace_window", """
SELECT o_orderkey, o_custkey,
       CASE WHEN CAST(o_orderdate AS DATE) = DATE '1999-01-04' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       CAST(o_orderdate AS DATE) AS load_date
FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '1999-01-04'
   OR (CAST(o_orderdate AS DATE) = DATE '1999-01-04' AND o_orderstatus <> 'P')
""")
def q_replace_window(spark, d):
    """Orders loaded through 1999-01-04, then that day loaded again with other
    prices and without its pending orders."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                         F.col("o_orderdate").cast("date").alias("load_date"))
    day = _dt.date(1999, 1, 4)
    loaded = o.where(F.col("load_date") <= F.lit(day)).drop("o_orderstatus")
    again = (o.where((F.col("load_date") == F.lit(day)) & (F.col("o_orderstatus") != "P"))
             .withColumn("o_totalprice", F.col("o_totalprice") * 2).drop("o_orderstatus"))
    return replace_window(loaded, again, "load_date", [day])


@query("fact_reload", """
SELECT o_orderkey, o_custkey, o_orderdate,
       CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01 00:00:00' THEN DATE '1998-01-01' ELSE DATE '2100-01-01' END AS load_date
FROM orders
""")
def q_fact_reload(spark, d):
    """All orders through the fact load in two deliveries: the newer one first,
    the older one in part, then both again in full."""
    root = f"{checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix='dimledger-ckpt-'))}/dimledger-query/{uuid.uuid4().hex}"
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz")
                                              .alias("o_orderdate"))
    cut = ts_lit("1998-01-01 00:00:00")
    old, new = orders.where(F.col("o_orderdate") <= cut), orders.where(F.col("o_orderdate") > cut)
    for delivery, day in ((new, _dt.date(2100, 1, 1)), (old.where("o_orderstatus = 'F'"), _dt.date(1998, 1, 1)),
                          (old, _dt.date(1998, 1, 1)), (new, _dt.date(2100, 1, 1))):
        bank.load_facts(spark, f"{root}/facts", f"{root}/meta", delivery, ["o_orderdate"], day)
    return spark.read.parquet(f"{root}/facts").select("o_orderkey", "o_custkey", "o_orderdate", "load_date")


@query("late_fact_load", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderkey % 5 = 0 THEN DATE '2100-01-02' ELSE DATE '2100-01-01' END AS load_date
FROM orders
""")
def q_late_fact_load(spark, d):
    """Two deliveries of orders, some without a time: the second one has all
    rows, among them a fifth that are older than the watermark and were not
    delivered before; then both again. Every order is loaded once."""
    root = f"{checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix='dimledger-ckpt-'))}/dimledger-query/{uuid.uuid4().hex}"
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(
        F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("timestamp_ntz")).alias("o_orderdate"))
    first = orders.where("o_orderkey % 5 <> 0")
    days = _dt.date(2100, 1, 1), _dt.date(2100, 1, 2)
    for delivery, day in ((first, days[0]), (orders, days[1]), (first, days[0]), (orders, days[1])):
        bank.load_facts(spark, f"{root}/facts", f"{root}/meta", delivery, ["o_orderdate"], day)
    return spark.read.parquet(f"{root}/facts").select("o_orderkey", "o_custkey", "o_orderdate", "load_date")


@query("category_closure", """
WITH RECURSIVE node AS (
  SELECT o_orderkey AS id,
         lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS parent FROM orders),
tree AS (
  SELECT id, id AS root, CAST(0 AS BIGINT) AS depth FROM node WHERE parent IS NULL
  UNION ALL
  SELECT n.id, t.root, t.depth + 1 FROM node n JOIN tree t ON n.parent = t.id)
SELECT id, root, depth, false AS cyclic FROM tree
""")
def q_category_closure(spark, d):
    """Chains of a customer's orders, each below the one before: a forest as
    deep as the longest chain."""
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="dimledger-ckpt-"))
    o = table(spark, d, "orders")
    before = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return hierarchy_roots(o.select(F.col("o_orderkey").alias("id"), F.lag("o_orderkey").over(before).alias("parent")),
                           "id", "parent")


@query("profile", """
SELECT count(*) AS rows, count(l_orderkey) AS l_orderkey, count(l_partkey) AS l_partkey,
       count(l_suppkey) AS l_suppkey, count(l_linenumber) AS l_linenumber,
       count(l_quantity) AS l_quantity, count(l_extendedprice) AS l_extendedprice,
       count(l_discount) AS l_discount, count(l_tax) AS l_tax, count(l_returnflag) AS l_returnflag,
       count(l_linestatus) AS l_linestatus, count(l_shipdate) AS l_shipdate
FROM lineitem
""")
def q_profile(spark, d):
    return profile(table(spark, d, "lineitem"))


@query("sum_by", """
SELECT l_partkey, l_returnflag, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS l_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS l_extendedprice
FROM (SELECT l_partkey, nullif(l_returnflag, 'A') AS l_returnflag, l_quantity, l_extendedprice FROM lineitem) x
WHERE l_partkey IS NOT NULL AND l_returnflag IS NOT NULL
GROUP BY l_partkey, l_returnflag
""")
def q_sum_by(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", F.nullif("l_returnflag", F.lit("A")).alias("l_returnflag"),
                                            "l_quantity", "l_extendedprice")
    return sum_by(li, ["l_partkey", "l_returnflag"], ["l_quantity", "l_extendedprice"], scale=2)


# ------------------------------------------------------------------ feed
# category tree := region → nation → supplier (binary ids), root ASIA;
# item := part; shop := nation; warehouse := supplier; stock, check line :=
# lineitem, dated by the month of shipping (a monthly snapshot keeps a
# single report date dense enough at small scale factors)

ZERO_HEX = "00" * 16
SALE_HEX = "904de8752e8c25484334f95ea0596522"
FEED_DAY = "1998-06-01"
FEED_EXCLUDED_CITY = "NATION_3"


def _bin(prefix: str, c: str):
    return F.concat(F.lit(prefix), F.col(c).cast("string")).cast("binary")


def _cat_key():
    return F.when(F.col("p_size") <= 25,
                  F.concat(F.lit("N"), (F.col("p_size") - 1).cast("string"))) \
        .otherwise(F.concat(F.lit("S"), (F.col("p_size") * 2).cast("string"))).cast("binary")


def category_groups(spark, d) -> DataFrame:
    region, nation, supplier = (table(spark, d, n) for n in ("region", "nation", "supplier"))
    zero = F.unhex(F.lit(ZERO_HEX))
    return (region.select(_bin("R", "r_regionkey").alias("_idrref"), zero.alias("_parentidrref"),
                          F.col("r_name").alias("_description"))
            .unionByName(nation.select(_bin("N", "n_nationkey").alias("_idrref"),
                                       _bin("R", "n_regionkey").alias("_parentidrref"),
                                       F.col("n_name").alias("_description")))
            .unionByName(supplier.select(_bin("S", "s_suppkey").alias("_idrref"),
                                         _bin("N", "s_nationkey").alias("_parentidrref"),
                                         F.col("s_name").alias("_description"))))


def feed_items(part: DataFrame) -> DataFrame:
    return part.select(_bin("P", "p_partkey").alias("_idrref"), F.col("p_name").alias("_description"),
                       F.col("p_partkey").cast("double").alias("_fld26454"),
                       _cat_key().alias("_fld2428rref"))


def feed_skus(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").cast("string").alias("zitemsn_n_wc"),
                       F.when(F.col("p_brand") == "Brand#1", F.lit("")).otherwise(F.col("p_brand"))
                       .alias("directortxt"),
                       F.col("p_type").alias("categtxt"), F.base64(_cat_key()).alias("categ_id"))


def feed_stores(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.base64(_bin("N", "n_nationkey")).alias("store_id"),
                    F.col("n_nationkey").cast("string").alias("store_code"),
                    F.concat(F.lit(feed.STORE_PREFIX), F.col("n_name")).alias("store"),
                    F.col("n_name").alias("city"),
                    F.when(F.col("r_name").isin("ASIA", "EUROPE"), F.lit("KZ")).otherwise(F.lit("US"))
                    .alias("country")))


def feed_warehouses(supplier: DataFrame) -> DataFrame:
    return supplier.select(_bin("W", "s_suppkey").alias("_idrref"),
                           _bin("N", "s_nationkey").alias("_fld30704rref"),
                           F.when(F.col("s_acctbal") > 0, F.unhex(F.lit("01")))
                           .otherwise(F.unhex(F.lit("00"))).alias("_fld25076"))


def feed_stock(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.base64(_bin("P", "l_partkey")).alias("items_id"),
        F.base64(_bin("W", "l_suppkey")).alias("warehouse_id"),
        (F.col("l_quantity") * 0.125).alias("quant"), F.col("l_extendedprice").alias("price"),
        F.trunc("l_shipdate", "month").alias("date"),
        F.when(F.col("l_returnflag") == "R", F.lit("UZ")).otherwise(F.lit("KZ")).alias("country"),
        F.when(F.col("l_discount") > 0.08, F.lit("B")).when(F.col("l_linestatus") == "O", F.lit("N"))
        .otherwise(F.lit("")).alias("quality"))


def feed_general(lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    j = lineitem.join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    one, zero = F.base64(F.unhex(F.lit("01"))), F.base64(F.unhex(F.lit("00")))
    return j.select(
        F.base64(_bin("P", "l_partkey")).alias("item"),
        F.base64(_bin("N", "s_nationkey")).alias("shops"),
        F.col("l_quantity").cast("string").alias("kf_quan"),
        F.col("l_extendedprice").cast("string").alias("kf_curr"),
        F.when(F.col("l_returnflag") == "A", zero).otherwise(one).alias("post"),
        F.when(F.col("l_returnflag") == "R", one).otherwise(zero).alias("delete"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string")).otherwise(zero).alias("b2bflag"),
        F.when(F.col("l_linestatus") == "O", F.base64(F.unhex(F.lit(SALE_HEX)))).otherwise(zero).alias("opertype"),
        F.trunc("l_shipdate", "month").alias("date"),
        F.base64(_bin("W", "l_suppkey")).alias("whs"),
        F.col("l_linenumber").cast("string").alias("whs_i"))


def feed_abc(part: DataFrame) -> DataFrame:
    """Two ranking snapshots: one taken 1998-05-01 (parts up to size 40) and
    a later one (2030-01-01) that a 1998 run must not see."""
    def snap(df, epoch, shift):
        return df.select(
            F.col("p_partkey").cast("double").alias("SKU_ID"),
            (F.col("p_size") * 10.0 + shift).alias("TOTAL_SALES_QUANTITY"),
            (F.col("p_retailprice") + shift).alias("TOTAL_SALES_VALUE"),
            F.when(F.col("p_size") < 15, "X").when(F.col("p_size") < 30, "Y").otherwise("Z").alias("XYZ_RANK"),
            F.substring("p_type", 1, 1).alias("ABC_RANK"), F.col("p_brand").alias("CATEGORY_SHORT"),
            F.col("p_type").alias("class"), F.col("p_size").cast("double").alias("class_size"),
            (F.col("p_size") / 2.0).alias("category_sizes"),
            (F.col("p_retailprice") / 10.0).alias("class_category_sizes"),
            F.lit(epoch).cast("bigint").alias("timestamp"))
    early = snap(part.where(F.col("p_size") <= 40), 893980800, 0.0)
    late = snap(part, 1893456000, 1.0)
    return early.unionByName(late)


class _FeedInputs:
    """Feed analogues, each built only when a query asks for it."""

    def __init__(self, spark, d):
        self.spark, self.d = spark, d

    def _t(self, name):
        return table(self.spark, self.d, name)

    @property
    def paths(self):
        return feed.category_paths(category_groups(self.spark, self.d), root_name="ASIA")

    @property
    def items(self):
        return feed_items(self._t("part"))

    @property
    def skus(self):
        return feed_skus(self._t("part"))

    @property
    def stores(self):
        return feed_stores(self._t("nation"), self._t("region"))

    @property
    def warehouses(self):
        return feed_warehouses(self._t("supplier"))

    @property
    def stock(self):
        return feed_stock(self._t("lineitem"))

    @property
    def general(self):
        return feed_general(self._t("lineitem"), self._t("supplier"))

    @property
    def abc(self):
        return feed_abc(self._t("part"))


SQL_FEED_CTE = f"""
nodes AS (
  SELECT encode('R' || CAST(r_regionkey AS VARCHAR)) AS id, unhex('{ZERO_HEX}') AS parent, r_name AS descr FROM region
  UNION ALL SELECT encode('N' || CAST(n_nationkey AS VARCHAR)), encode('R' || CAST(n_regionkey AS VARCHAR)), n_name FROM nation
  UNION ALL SELECT encode('S' || CAST(s_suppkey AS VARCHAR)), encode('N' || CAST(s_nationkey AS VARCHAR)), s_name FROM supplier),
root AS (
  SELECT id FROM nodes WHERE to_base64(parent) = 'AAAAAAAAAAAAAAAAAAAAAA==' AND descr = 'ASIA'),
paths AS (
  -- a plain parent -> child chain: a level is NULL once a branch ends
  SELECT DISTINCT to_base64(a.id) AS cat_1, to_base64(b.id) AS cat_2, to_base64(c.id) AS cat_3
  FROM root
  LEFT JOIN nodes a ON a.parent = root.id
  LEFT JOIN nodes b ON b.parent = a.id
  LEFT JOIN nodes c ON c.parent = b.id),
catkey AS (
  SELECT p.*, encode(CASE WHEN p_size <= 25 THEN 'N' || CAST(p_size - 1 AS VARCHAR)
                          ELSE 'S' || CAST(p_size * 2 AS VARCHAR) END) AS ck FROM part p),
-- What the feed means in the test tables' own keys; text labels are made last.
asia_nation AS (
  SELECT n_nationkey AS nk FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')),
asia_supplier AS (SELECT s_suppkey AS sk, s_nationkey AS nk FROM supplier SEMI JOIN asia_nation ON s_nationkey = nk),
goods AS (
  SELECT p_partkey AS pk, p_name, p_brand, p_type, CAST(p_partkey AS VARCHAR) AS code,
         -- a nation with suppliers below it is no end of a path
         p_size > 25 OR p_size - 1 NOT IN (SELECT nk FROM asia_supplier) AS at_end
  FROM part
  WHERE CASE WHEN p_size > 25 THEN p_size * 2 IN (SELECT sk FROM asia_supplier)
             ELSE p_size - 1 IN (SELECT nk FROM asia_nation) END),
kz_nation AS (
  SELECT n_nationkey AS nk, n_name FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE r_name IN ('ASIA', 'EUROPE')),
line AS (
  SELECT l.*, s_acctbal, n_name, CAST(date_trunc('month', l_shipdate) AS DATE) AS month
  FROM lineitem l, supplier, kz_nation WHERE l_suppkey = s_suppkey AND s_nationkey = nk),
sku AS (
  SELECT CASE p_brand WHEN 'Brand#1' THEN 'Не присвоено' ELSE p_brand END AS category_short, p_name AS item_name,
         to_base64(encode('P' || code)) AS items_id, code AS webcode, p_type AS category_name FROM goods),
stk AS (
  SELECT month AS date, to_base64(encode('P' || CAST(l_partkey AS VARCHAR))) AS items_id, stock, price,
         n_name AS store, n_name AS city
  FROM (SELECT month, l_partkey, n_name, CAST(sum(CAST(l_quantity * 0.125 AS DECIMAL(18,6))) AS DOUBLE) AS stock,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,6))) AS DOUBLE) AS price
        FROM line
        WHERE s_acctbal > 0 AND l_returnflag <> 'R' AND l_discount <= 0.08 AND n_name <> '{FEED_EXCLUDED_CITY}'
        GROUP BY ALL)),
sales AS (
  SELECT month AS date, code AS webcode, p_name AS item_name, n_name AS store, quantity, item_total, n_name AS city
  FROM (SELECT month, l_partkey, n_name, l_suppkey, l_linenumber, CAST(sum(round(l_quantity)) AS BIGINT) AS quantity,
               CAST(sum(round(l_extendedprice)) AS BIGINT) AS item_total
        FROM line WHERE l_returnflag NOT IN ('A', 'R') AND l_discount <> 0 AND l_linestatus = 'O'
        GROUP BY ALL)
  JOIN goods ON l_partkey = pk
  WHERE at_end AND pk NOT IN (216158, 62763, 108285))"""


@query("expand_hierarchy", f"WITH {SQL_FEED_CTE} SELECT * FROM paths")
def q_expand_hierarchy(spark, d):
    return feed.category_paths(category_groups(spark, d), root_name="ASIA")


@query("any_level_join", f"""
WITH {SQL_FEED_CTE}
SELECT DISTINCT i.p_partkey, i.p_name
FROM catkey i JOIN paths ON to_base64(i.ck) IN (paths.cat_1, paths.cat_2, paths.cat_3)
""")
def q_any_level_join(spark, d):
    paths = feed.category_paths(category_groups(spark, d), root_name="ASIA")
    items = table(spark, d, "part").select("p_partkey", "p_name", F.base64(_cat_key()).alias("cat"))
    return any_level_join(items, "cat", paths, feed.LEVELS).select("p_partkey", "p_name").distinct()


@query("sku_categories", f"WITH {SQL_FEED_CTE} SELECT * FROM sku")
def q_sku_categories(spark, d):
    x = _FeedInputs(spark, d)
    return feed.sku_categories(x.items, x.skus, x.paths)


@query("daily_stock", f"WITH {SQL_FEED_CTE} SELECT date, items_id, stock, price, store, city FROM stk")
def q_daily_stock(spark, d):
    """Back-fill: the stock report of every day in one job."""
    x = _FeedInputs(spark, d)
    return feed.daily_stock(x.stock, x.warehouses, x.stores, excluded_city=FEED_EXCLUDED_CITY)


@query("daily_sales", f"WITH {SQL_FEED_CTE} SELECT * FROM sales")
def q_daily_sales(spark, d):
    """Back-fill: the sales report of every day in one job."""
    x = _FeedInputs(spark, d)
    return feed.daily_sales(x.general, x.items, x.stores, x.paths)


ABC_SQL = f"""
WITH {SQL_FEED_CTE},
abc AS (
  SELECT CAST(p_partkey AS DOUBLE) AS SKU_ID, CAST(p_size * 10 AS DOUBLE) AS TOTAL_SALES_QUANTITY,
         p_retailprice AS TOTAL_SALES_VALUE,
         CASE WHEN p_size < 15 THEN 'X' WHEN p_size < 30 THEN 'Y' ELSE 'Z' END AS XYZ_RANK,
         substr(p_type, 1, 1) AS ABC_RANK, p_brand AS CATEGORY_SHORT, p_type AS class,
         CAST(p_size AS DOUBLE) AS class_size, p_size / 2.0 AS category_sizes,
         p_retailprice / 10.0 AS class_category_sizes, CAST(893980800 AS BIGINT) AS "timestamp"
  FROM part WHERE p_size <= 40
  UNION ALL
  SELECT CAST(p_partkey AS DOUBLE), CAST(p_size * 10 AS DOUBLE) + 1.0, p_retailprice + 1.0,
         CASE WHEN p_size < 15 THEN 'X' WHEN p_size < 30 THEN 'Y' ELSE 'Z' END,
         substr(p_type, 1, 1), p_brand, p_type, CAST(p_size AS DOUBLE), p_size / 2.0,
         p_retailprice / 10.0, CAST(1893456000 AS BIGINT)
  FROM part),
ranks AS (
  SELECT CAST(CAST(round(SKU_ID) AS BIGINT) AS VARCHAR) AS webcode,
         TOTAL_SALES_QUANTITY AS total_sales_quantity, TOTAL_SALES_VALUE AS total_sales_value,
         XYZ_RANK AS xyz_rank, ABC_RANK AS abc_rank, CATEGORY_SHORT AS category_short_y, class,
         class_size, category_sizes, class_category_sizes
  FROM abc WHERE "timestamp" = (SELECT max("timestamp") FROM abc WHERE "timestamp" <= {feed.abc_cutoff(FEED_DAY)})),
st6 AS (
  SELECT webcode, item_name, city, store AS shop_name, category_short, category_name,
         coalesce(CAST(sum(CAST(price AS DECIMAL(18,6))) AS DOUBLE), 0.0) AS price,
         coalesce(CAST(sum(CAST(stock AS DECIMAL(18,6))) AS DOUBLE), 0.0) AS quant
  FROM stk JOIN sku USING (items_id)
  WHERE stk.date = DATE '{FEED_DAY}' AND webcode IS NOT NULL AND item_name IS NOT NULL
    AND city IS NOT NULL AND store IS NOT NULL AND category_short IS NOT NULL
    AND category_name IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5, 6),
sl4 AS (
  SELECT webcode, item_name, store AS shop_name, city,
         coalesce(CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS quantity,
         coalesce(CAST(sum(CAST(item_total AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS item_total
  FROM sales
  WHERE date = DATE '{FEED_DAY}' AND webcode IS NOT NULL AND item_name IS NOT NULL
    AND store IS NOT NULL AND city IS NOT NULL
  GROUP BY 1, 2, 3, 4),
t AS (
  SELECT st6.*, coalesce(sl4.quantity, 0.0) AS quantity, coalesce(sl4.item_total, 0.0) AS item_total
  FROM st6 LEFT JOIN sl4 USING (webcode, item_name, shop_name, city)
  WHERE st6.category_name IS NULL OR st6.category_name NOT IN
    ('Сертификат гарантии', 'Прочие услуги', 'Сертификат подарочный', 'Гарантийный талон'))
SELECT TIMESTAMP '{FEED_DAY} 00:00:00' AS date, t.webcode AS sku_id, t.item_name AS sku_name,
       t.category_short AS category_short_x, t.category_name, t.city AS city_name, t.shop_name,
       t.quant AS stock_value, t.quantity AS sales_quantity, t.item_total AS sales_value,
       r.total_sales_quantity, r.total_sales_value, r.xyz_rank, r.abc_rank, r.category_short_y,
       coalesce(r.class, 'x') AS class, r.class_size, r.category_sizes, r.class_category_sizes
FROM t LEFT JOIN ranks r ON r.webcode = t.webcode
"""


@query("abc_feed", ABC_SQL)
def q_abc_feed(spark, d):
    x = _FeedInputs(spark, d)
    paths = x.paths
    stock = feed.daily_stock(x.stock, x.warehouses, x.stores, ds=FEED_DAY,
                             excluded_city=FEED_EXCLUDED_CITY)
    sales = feed.daily_sales(x.general, x.items, x.stores, paths, ds=FEED_DAY)
    skus = feed.sku_categories(x.items, x.skus, paths)
    ranks = feed.abc_snapshot(x.abc, feed.abc_cutoff(FEED_DAY))
    return feed.abc_feed(stock, skus, sales, ranks, FEED_DAY)


@query("abc_enrich", f"""
WITH t AS (
  SELECT CAST(l_partkey AS VARCHAR) AS webcode,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS stock_value
  FROM lineitem GROUP BY l_partkey),
abc AS (
  SELECT CAST(p_partkey AS DOUBLE) AS SKU_ID, p_type AS class, substr(p_type, 1, 1) AS ABC_RANK,
         CAST(893980800 AS BIGINT) AS "timestamp" FROM part WHERE p_size <= 40
  UNION ALL
  SELECT CAST(p_partkey AS DOUBLE), p_type, substr(p_type, 1, 1), CAST(1893456000 AS BIGINT) FROM part),
r AS (SELECT CAST(CAST(round(SKU_ID) AS BIGINT) AS VARCHAR) AS webcode, class, ABC_RANK AS abc_rank
      FROM abc WHERE "timestamp" = (SELECT max("timestamp") FROM abc WHERE "timestamp" <= {feed.abc_cutoff(FEED_DAY)}))
SELECT t.webcode, t.stock_value, coalesce(r.class, 'x') AS class, r.abc_rank
FROM t LEFT JOIN r ON r.webcode = t.webcode
""")
def q_abc_enrich(spark, d):
    """Stock per item ⟕ the ranking snapshot of the day; unranked items get class 'x'."""
    # group on the numeric key and turn the (few) results into text codes
    li = table(spark, d, "lineitem").select("l_partkey", F.col("l_quantity").alias("stock_value"))
    totals = (sum_by(li, ["l_partkey"], ["stock_value"], scale=2)
              .select(F.col("l_partkey").cast("string").alias("webcode"), "stock_value"))
    ranks = feed.abc_snapshot(feed_abc(table(spark, d, "part")), feed.abc_cutoff(FEED_DAY))
    return (totals.join(ranks.select("webcode", "class", "abc_rank"), "webcode", "left")
            .select("webcode", "stock_value", F.coalesce("class", F.lit("x")).alias("class"), "abc_rank"))


# ------------------------------------------------------------------ promo
# coupon := part (spec := brand); coupon operation := event

PROMO_DAY = "2024-01-15"


def promo_coupons(part: DataFrame) -> DataFrame:
    start = F.date_add(F.lit(_dt.date(2024, 1, 1)), F.col("p_size")).cast("timestamp_ntz")
    end = F.date_add(F.lit(_dt.date(2024, 1, 31)), F.col("p_size")).cast("timestamp_ntz")
    bad = (F.col("p_type") == "PROMO") & (F.col("p_size") > 40)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return part.select(F.col("p_partkey").cast("string").alias("coupon_id"), F.col("p_name").alias("code"),
                       (F.col("p_type") != "ECONOMY").alias("active"),
                       F.col("p_brand").alias("specification_id"),
                       F.when(bad, F.lit("not a date")).otherwise(F.date_format(end, fmt)).alias("end"),
                       F.when(bad, F.lit("not a date")).otherwise(F.date_format(start, fmt)).alias("start"),
                       F.col("p_size").alias("limit"))


def promo_ops(events: DataFrame) -> DataFrame:
    status = (F.when(F.col("event_type") == "purchase", "used")
              .when(F.col("event_type") == "error", "aborted")
              .when(F.col("event_type") == "signup", "canceled")
              .otherwise(F.col("event_type")))
    return events.select(F.col("event_id").alias("op_id"),
                         F.regexp_extract("props", r"(\d+)", 1).alias("coupon_id"),
                         status.alias("status"), F.col("ts").alias("updated"),
                         F.col("user_id").cast("string").alias("user_id"))


def promo_specs(part: DataFrame) -> DataFrame:
    return (part.groupBy(F.col("p_brand").alias("specification_id"))
            .agg(F.max("p_size").alias("_m"))
            .select("specification_id", F.concat(F.lit("Spec "), F.col("specification_id")).alias("title"),
                    F.date_add(F.lit(_dt.date(2022, 11, 1)), F.col("_m")).cast("timestamp_ntz").alias("created")))


SQL_PROMO_CTE = """
coupons AS (
  SELECT CAST(p_partkey AS VARCHAR) AS coupon_id, p_name AS code, p_type <> 'ECONOMY' AS active,
         p_brand AS specification_id,
         CASE WHEN p_type = 'PROMO' AND p_size > 40 THEN 'not a date'
              ELSE strftime(CAST(DATE '2024-01-31' + p_size AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS "end",
         CASE WHEN p_type = 'PROMO' AND p_size > 40 THEN 'not a date'
              ELSE strftime(CAST(DATE '2024-01-01' + p_size AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS start,
         p_size AS "limit"
  FROM part),
ops AS (
  SELECT event_id AS op_id, regexp_extract(props, '(\\d+)', 1) AS coupon_id,
         CASE event_type WHEN 'purchase' THEN 'used' WHEN 'error' THEN 'aborted'
                         WHEN 'signup' THEN 'canceled' ELSE event_type END AS status,
         ts AS updated, CAST(user_id AS VARCHAR) AS user_id
  FROM events),
specs AS (
  SELECT p_brand AS specification_id, 'Spec ' || p_brand AS title,
         CAST(DATE '2022-11-01' + max(p_size) AS TIMESTAMP) AS created
  FROM part GROUP BY p_brand)"""


@query("promo_state", f"""
WITH {SQL_PROMO_CTE},
o AS (
  SELECT ops.*, c.active FROM ops LEFT JOIN coupons c ON c.coupon_id = ops.coupon_id
  WHERE ops.updated >= TIMESTAMP '{PROMO_DAY} 00:00:00' AND ops.updated < TIMESTAMP '{PROMO_DAY} 00:00:00' + INTERVAL 1 DAY),
la AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY coupon_id, user_id ORDER BY updated DESC, op_id DESC) AS rn
    FROM o WHERE status IN ('used', 'aborted') AND active = true) x
  WHERE rn = 1 AND status = 'used'),
kept AS (SELECT coupon_id, status, updated FROM o WHERE status = 'canceled'
         UNION ALL SELECT coupon_id, status, updated FROM la),
p AS (
  SELECT c.*, k.status, k.updated, TRY_CAST(c.start AS TIMESTAMP) AS start_ts,
         TRY_CAST(c."end" AS TIMESTAMP) AS end_ts
  FROM coupons c LEFT JOIN kept k ON k.coupon_id = c.coupon_id)
SELECT coupon_id AS promocode_id, code, specification_id, status, CAST(updated AS DATE) AS updated_date,
       CAST(end_ts AS DATE) AS end_date, CAST(start_ts AS DATE) AS start_date
FROM p
WHERE (start_ts >= TIMESTAMP '{PROMO_DAY} 00:00:00' AND start_ts < TIMESTAMP '{PROMO_DAY} 00:00:00' + INTERVAL 1 DAY)
   OR (updated >= TIMESTAMP '{PROMO_DAY} 00:00:00' AND updated < TIMESTAMP '{PROMO_DAY} 00:00:00' + INTERVAL 1 DAY)
""")
def q_promo_state(spark, d):
    return promo.promo_state(promo_coupons(table(spark, d, "part")), promo_ops(table(spark, d, "events")),
                             PROMO_DAY)


# Only coupons of specifications created since a date: the brand number dates the specification.
@query("promo_state_recent_specs", ORACLE["promo_state"].replace(
    "  FROM part),\nops AS",
    "  FROM part WHERE DATE '2022-11-01' + CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) >= DATE '2022-11-13'),\nops AS"))
def q_promo_state_recent_specs(spark, d):
    part = table(spark, d, "part")
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    specs = part.select(F.col("p_brand").alias("specification_id"), F.col("p_brand").alias("title"),
                        F.date_add(F.lit(_dt.date(2022, 11, 1)), number).cast("timestamp_ntz").alias("created")).distinct()
    recent = promo.specs_since(specs, ts_lit("2022-11-13 00:00:00"))
    return promo.promo_state(promo.coupons_of(promo_coupons(part), recent), promo_ops(table(spark, d, "events")), PROMO_DAY)


@query("spec_stats", f"""
WITH {SQL_PROMO_CTE},
sp AS (SELECT specification_id, title FROM specs WHERE created >= TIMESTAMP '2022-12-01 06:00:00')
SELECT c.specification_id, sp.title AS specification_title, count(c.coupon_id) AS unique_promo_cnt,
       CAST(coalesce(sum(c."limit"), 0) AS BIGINT) AS user_limit
FROM coupons c JOIN sp ON sp.specification_id = c.specification_id
GROUP BY c.specification_id, sp.title
""")
def q_spec_stats(spark, d):
    part = table(spark, d, "part")
    specs = promo.specs_since(promo_specs(part), ts_lit("2022-12-01 06:00:00"))
    return promo.spec_stats(promo_coupons(part), specs)


@query("expire_status", """
SELECT CAST(o_orderkey AS VARCHAR) AS promocode_id,
       CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1998-10-01' AND CAST(o_orderdate AS DATE) < DATE '1998-11-01'
                 AND nullif(o_orderstatus, 'P') IS NULL THEN 'expired'
            ELSE nullif(o_orderstatus, 'P') END AS status,
       CAST(o_orderdate AS DATE) AS end_date
FROM orders
""")
def q_expire_status(spark, d):
    """Promo table := orders (no status yet := 'P'); October 1998 promos expire."""
    promos = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("promocode_id"),
                                              F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                                              F.col("o_orderdate").cast("date").alias("end_date"))
    return promo.expire_status(promos, F.lit(_dt.date(1998, 10, 1)), F.lit(_dt.date(1998, 11, 1)))


def query_folder(spark: SparkSession) -> str:
    """A new folder for one query's tables."""
    folder = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="dimledger-ckpt-"))
    return f"{folder}/dimledger-query/{uuid.uuid4().hex}"


@query("expire_status_events", """
SELECT CAST(o_orderkey AS VARCHAR) AS promocode_id,
       CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-10-01' AND DATE '1998-10-03'
                 AND nullif(o_orderstatus, 'P') IS NULL THEN 'expired'
            ELSE nullif(o_orderstatus, 'P') END AS status,
       CAST(o_orderdate AS DATE) AS end_date,
       CASE WHEN o_orderkey % 3 = 0 THEN DATE '1998-09-02' ELSE DATE '1998-09-01' END AS load_date
FROM orders
""")
def q_expire_status_events(spark, d):
    """The promos of ``expire_status`` stored on two days; three days expire as
    events; the first load is compacted, loaded and expired again."""
    root = query_folder(spark)
    promos = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("promocode_id"),
                                              F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                                              F.col("o_orderdate").cast("date").alias("end_date"))
    first, second = (promos.where(c) for c in ("promocode_id % 3 <> 0", "promocode_id % 3 = 0"))
    promo_events.store_states(first, root, _dt.date(1998, 9, 1))
    promo_events.store_states(second, root, _dt.date(1998, 9, 2))
    for day in (1, 2):
        promo_events.expire_day(spark, root, _dt.date(1998, 10, day))
    promo_events.compact(spark, root, _dt.date(1998, 9, 1))
    promo_events.store_states(first, root, _dt.date(1998, 9, 1))
    for day in (2, 3):
        promo_events.expire_day(spark, root, _dt.date(1998, 10, day))
    return promo_events.promo_states(spark, root)


@query("promo_state_docs", ORACLE["promo_state"])
def q_promo_state_docs(spark, d):
    """``promo_state`` from document collections (JSON lines): the day's window is
    a filter of the document scan."""
    root = query_folder(spark)
    coupons, ops = promo_coupons(table(spark, d, "part")), promo_ops(table(spark, d, "events"))
    ops = ops.withColumn("updated", F.col("updated").cast("timestamp_ntz"))
    for name, df in (("coupons", coupons), ("ops", ops)):
        df.write.json(f"{root}/{name}")
    return promo.promo_state(read_docs(spark, f"{root}/coupons", coupons.schema),
                             read_docs(spark, f"{root}/ops", ops.schema), PROMO_DAY)


@query("run_record", """
SELECT o.o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       o_orderstatus, t.orders_cnt
FROM orders o JOIN (SELECT o_orderstatus AS st, count(*) AS orders_cnt FROM orders GROUP BY o_orderstatus) t ON t.st = o_orderstatus
""")
def q_run_record(spark, d):
    """Two tables by runs: orders by status and their counts. A second run doubles
    the prices of one status; a third writes both tables and is never committed."""
    root = query_folder(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    states = ["F", "O", "P"]

    def counts(df):
        return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders_cnt"))

    with Run(spark, root) as run:
        run.table("orders").replace_all_of(orders, "o_orderstatus", states)
        run.table("counts").rewrite(counts(orders))
    with Run(spark, root) as run:
        own = run.table("orders").read().where("o_orderstatus = 'P'")
        run.table("orders").replace(own.withColumn("o_totalprice", F.col("o_totalprice") * 2), "o_orderstatus", "P")
    lost = Run(spark, root)
    lost.table("orders").replace(orders.where("o_orderkey < 0"), "o_orderstatus", "F")
    lost.table("counts").rewrite(counts(orders.where("o_orderkey < 0")))
    return read_table(spark, root, "orders").join(read_table(spark, root, "counts"), "o_orderstatus")


# ---------------------------------------------------------- parameterised SQL

PERIOD_SQL = """
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, o_orderdate
FROM {orders}
WHERE o_orderdate >= :period_start AND o_orderdate < :period_end AND o_orderstatus = :status
"""


@query("period_orders_sql", """
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-04-01 00:00:00'
  AND o_orderstatus = 'F'
""")
def q_period_orders_sql(spark, d):
    """A report period bound as typed parameters of Spark SQL."""
    return sql_query(spark, PERIOD_SQL,
                     {"period_start": _dt.datetime(1998, 1, 1), "period_end": _dt.datetime(1998, 4, 1),
                      "status": "F"},
                     orders=table(spark, d, "orders"))


# ------------------------------------------------------- point-in-time fraud

PIT_BLACKLIST_SQL = f"""
WITH {HISTORY_CTE},
own AS (
  SELECT o.o_orderkey AS card_num, c.c_name || '/' || h.priority AS passport,
         replace(c.c_name || '/' || h.priority, ' ', '') AS norm_passport,
         c.c_name || ' ' || c.c_mktsegment || ' ' || CAST(c.c_nationkey AS VARCHAR) AS fio,
         '+7' || lpad(CAST(c.c_custkey AS VARCHAR), 10, '0') AS phone,
         h.effective_from, h.effective_to
  FROM orders o JOIN hist h ON h.client_id = o.o_custkey JOIN customer c ON c.c_custkey = o.o_custkey),
bl AS (
  SELECT replace(c.c_name || '/' || o.o_orderpriority, ' ', '') AS passport, min(o.o_orderdate) AS entry_dt
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F'
  GROUP BY 1)
SELECT l.l_shipdate AS event_dt, own.passport, own.fio, own.phone, 1 AS event_type
FROM lineitem l
JOIN own ON own.card_num = l.l_orderkey AND l.l_shipdate >= own.effective_from AND l.l_shipdate < own.effective_to + INTERVAL 1 SECOND
JOIN bl ON bl.passport = own.norm_passport
WHERE bl.entry_dt < l.l_shipdate
"""


@query("rule_blacklisted_pit", PIT_BLACKLIST_SQL)
def q_rule_blacklisted_pit(spark, d):
    """Blacklist rule against the owner valid at the operation time (D-11).

    The client's passport is versioned: it changes whenever the client's order
    priority changes (versions from ``scd2_history``). Cards and accounts are
    orders, valid throughout. A passport is blacklisted at each urgent,
    finished order placed under it.
    """
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    hist = priority_history(orders)
    clients = (hist.join(customer, F.col("client_id") == F.col("c_custkey"))
               .select("client_id", F.col("c_name").alias("last_name"),
                       F.col("c_mktsegment").alias("first_name"),
                       F.col("c_nationkey").cast("string").alias("patronymic"),
                       F.concat(F.col("c_name"), F.lit("/"), F.col("priority")).alias("passport_num"),
                       F.lit(None).cast("date").alias("passport_valid_to"),
                       F.concat(F.lit("+7"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("phone"),
                       "effective_from", "effective_to", "deleted_flg"))

    def always(df):
        return df.select("*", ts_lit("1990-01-01").alias("effective_from"),
                         ts_lit("5999-12-31").alias("effective_to"), F.lit(0).alias("deleted_flg"))

    accounts = always(orders.select(F.col("o_orderkey").alias("account_num"),
                                    F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                                    F.col("o_custkey").alias("client")))
    cards = always(orders.select(F.col("o_orderkey").alias("card_num"), F.col("o_orderkey").alias("account_num")))
    owners = fraud.card_owners(clients, accounts, cards, versions="pit")
    o = orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    blacklist = (o.join(customer, F.col("o_custkey") == F.col("c_custkey"))
                 .select(F.concat(F.col("c_name"), F.lit("/"), F.col("o_orderpriority")).alias("passport_num"),
                         F.col("o_orderdate").alias("entry_dt")))
    return fraud.rule_blacklisted(lineitem_txns(table(spark, d, "lineitem")), owners, blacklist)

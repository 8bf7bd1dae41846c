"""Expiry as events, and promo states from documents."""

import datetime as dt
import os

import pytest

from dimledger.catalogue import PROMO_DAY, QUERIES
from dimledger.plans import promo, promo_events
from dimledger.sources.readers import read_docs
from rows import SF_SMALL, rows
from test_promo import coupons, ops

D1, D2, D3 = (dt.date(2024, 5, d) for d in (10, 11, 12))
STATE = "promocode_id string, status string, end_date date, code string"


def stored(spark, root):
    return [(r[0], r[1], r[-1]) for r in rows(promo_events.promo_states(spark, root))]


def test_expiry_as_events(spark, scratch):
    state = lambda *r: spark.createDataFrame(r, STATE)
    with pytest.raises(Exception):
        promo_events.promo_states(spark, scratch + "/none")
    promo_events.expire_day(spark, scratch, D1)                                   # nothing stored yet
    day1 = state(("a", None, D2, "x"), ("b", "used", D2, "x"), ("c", None, None, "x"), ("d", None, D3, "x"),
                 (None, None, D2, "x"))
    promo_events.store_states(day1, scratch, D1)
    promo_events.store_states(state(("a", None, D2, "y"), ("d", "canceled", D3, "y")), scratch, D2)
    before = stored(spark, scratch)
    assert all(s != "expired" for _, s, _ in before) and len(before) == 7
    promo_events.expire_day(spark, scratch, D2)
    want = sorted([("a", "expired", D1), ("b", "used", D1), ("c", None, D1), ("d", None, D1), ("a", "expired", D2),
                   ("d", "canceled", D2), (None, None, D1)], key=str)
    assert sorted(stored(spark, scratch), key=str) == want
    states = os.path.join(scratch, "states", "load_date=2024-05-10")
    files = sorted(os.listdir(states))
    promo_events.expire_day(spark, scratch, D2)                                   # again: nothing is rewritten
    assert sorted(stored(spark, scratch), key=str) == want and sorted(os.listdir(states)) == files

    promo_events.compact(spark, scratch, D1)
    promo_events.compact(spark, scratch, D1)
    assert sorted(stored(spark, scratch), key=str) == want
    left = spark.read.parquet(os.path.join(scratch, "changes")).collect()
    assert [(r.promocode_id, r.state_date) for r in left] == [("a", D2)]
    # The day again: b is unused now, a stays expired, d was used.
    promo_events.store_states(state(("a", None, D2, "x"), ("b", None, D2, "x"), ("d", "used", D3, "x")), scratch, D1)
    promo_events.expire_day(spark, scratch, D3)
    got = stored(spark, scratch)
    assert ("a", "expired", D1) in got and ("b", None, D1) in got and ("d", "used", D1) in got
    promo_events.store_states(state(), scratch, D2)                               # a day without states any more
    assert {r[2] for r in stored(spark, scratch)} == {D1}


def test_a_days_expiry_reads_one_month(spark, scratch):
    promo_events.store_states(spark.createDataFrame([("a", None, D2, "x"), ("b", None, dt.date(2024, 7, 1), "x")], STATE),
                              scratch, D1)
    due = spark.read.parquet(os.path.join(scratch, "due"))
    plan = due.where((due.due_month == "2024-05"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(due_month" in plan
    assert sorted(n for n in os.listdir(os.path.join(scratch, "due")) if "=" in n) == [
        "due_month=2024-05", "due_month=2024-07"]


def test_the_window_is_a_filter_of_the_document_scan(spark, scratch):
    for name, df in (("coupons", coupons(spark)), ("ops", ops(spark))):
        df.write.json(os.path.join(scratch, name))
    with open(os.path.join(scratch, "ops", "more.json"), "w") as f:
        f.write('{"op_id": 99, "status": "used"}\nnot json\n{"op_id": "x", "updated": "soon", "extra": {"a": 1}}\n')
    docs = [read_docs(spark, os.path.join(scratch, n), df.schema)
            for n, df in (("coupons", coupons(spark)), ("ops", ops(spark)))]
    day = dt.date(2024, 5, 10)
    out = promo.promo_state(*docs, day)
    assert rows(out) == rows(promo.promo_state(coupons(spark), ops(spark), day))
    scans = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines()
             if "FileScan json" in line and "op_id" in line]
    assert scans and all("GreaterThanOrEqual(updated,2024-05-10" in s and "LessThan(updated,2024-05-11" in s
                         for s in scans)
    plan = QUERIES["promo_state_docs"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(updated,{PROMO_DAY}" in plan

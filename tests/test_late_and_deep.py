"""Late rows, rows without a time, deletes of late versions, exact sums, deep trees."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimledger.functions.columns import exact_sum, ts_lit
from dimledger.operators.relational import hierarchy_roots
from dimledger.operators.scd2 import scd2_merge
from dimledger.plans.bank import load_facts
from dimledger.plans import fraud
from dimledger.plans.fraud import fraud_report, refresh_report

D1, D2, D3 = (dt.date(2024, 3, d) for d in (1, 2, 3))


def test_rows_without_a_time_and_late_rows_are_loaded_once(spark, scratch):
    facts, meta = os.path.join(scratch, "facts"), os.path.join(scratch, "meta")

    def load(day, data):
        load_facts(spark, facts, meta, spark.createDataFrame(data, "id string, t timestamp_ntz"), ["t"], day)
        return sorted((r.id, r.load_date) for r in spark.read.parquet(facts).collect())

    noon = dt.datetime(2024, 3, 1, 12)
    assert load(D1, [("n1", None), ("a", noon)]) == [("a", D1), ("n1", D1)]
    late = ("old", noon - dt.timedelta(hours=3))
    second = [("n1", None), ("n2", None), ("a", noon), late, ("b", noon + dt.timedelta(days=1))]
    want = [("a", D1), ("b", D2), ("n1", D1), ("n2", D2), ("old", D2)]
    assert load(D2, second) == want
    assert load(D2, second) == want
    assert load(D1, [("n1", None), ("a", noon), late]) == want       # an older day again: held by a newer one
    assert load(D3, second) == want


def test_a_delete_never_ends_a_version_before_its_start(spark):
    hist = spark.createDataFrame([("k", "x", dt.datetime(2024, 3, 2, 9), dt.datetime(5999, 12, 31), 0)],
                                 "id string, a string, effective_from timestamp_ntz, effective_to timestamp_ntz, "
                                 "deleted_flg int")
    out = scd2_merge(hist, spark.createDataFrame([], "id string, a string"), ["id"], ["a"], ["a"], ts_lit(D2))
    got = sorted((r.effective_from, r.effective_to, r.deleted_flg) for r in out.collect())
    assert all(a <= b for a, b, _ in got)
    assert got == [(dt.datetime(2024, 3, 2, 9), dt.datetime(2024, 3, 2, 9), 0),
                   (dt.datetime(2024, 3, 2, 9, 0, 1), dt.datetime(5999, 12, 31), 1)]


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_sums_of_small_and_large_values(spark, parts):
    rng = random.Random(6)
    values = [round(rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-9, 3), 9) for _ in range(3000)]
    values += [float(rng.randint(-10 ** 12, 10 ** 12)) for _ in range(500)] + [1e-7, 1e-7, 4e-7, 1e-9]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(parts)
    want = float(sum(Decimal(repr(v)) for v in values))
    assert df.agg(exact_sum("x")).first()[0] == want
    small = spark.createDataFrame([(1e-7,), (1e-7,), (4e-7,)], "x double")
    assert small.agg(exact_sum("x")).first()[0] == 6e-7
    assert small.where("x > 1").agg(exact_sum("x")).first()[0] is None
    assert spark.createDataFrame([(0.25,), (-0.5,)], "x double").agg(exact_sum("x", 2)).first()[0] == -0.25


def test_trees_of_any_depth_and_cycles(spark):
    chain = [(i, i - 1 if i else None) for i in range(300)]
    rows = chain + [(1000, 999), (1001, 1000), (2000, 2002), (2001, 2000), (2002, 2001), (2003, 2001), (3000, 3000)]
    got = {r.id: (r.root, r.depth, r.cyclic) for r in hierarchy_roots(
        spark.createDataFrame(rows, "id long, parent long"), "id", "parent").collect()}
    want = {i: (0, i, False) for i in range(300)} | {1000: (1000, 0, False), 1001: (1000, 1, False)}
    want |= {i: (None, None, True) for i in (2000, 2001, 2002, 2003, 3000)}
    assert got == want
    assert hierarchy_roots(spark.createDataFrame([], "id long, parent long"), "id", "parent").collect() == []


def test_refreshed_report_equals_the_one_from_scratch(spark):
    t = dt.datetime(2024, 3, 1, 10)
    hour = dt.timedelta(hours=1)
    txn = spark.createDataFrame([(f"t{k}", t + k * hour / 2, f"c{k % 4}", f"T{k % 3}") for k in range(24)],
                                "trans_id string, trans_date timestamp_ntz, card_num string, terminal string")
    terminals = spark.createDataFrame([("T0", "A"), ("T1", "B"), ("T2", "A")], "terminal_id string, terminal_city string")
    schema = ("card_num string, account_num string, account_valid_to timestamp_ntz, client_id string, "
              "passport_num string, passport_valid_to date, fio string, phone string")

    def owners(phone, passport):
        return spark.createDataFrame([
            ("c0", "a0", t + 3 * hour, "k0", "p0", None, "F0", "1"), ("c1", "a1", None, "k1", "p1", None, "F1", phone),
            ("c2", "a2", None, "k2", passport, dt.date(2024, 2, 1), "F2", "3"), ("c3", "a3", None, "k0", "p0", None, "F0", "1")],
            schema)

    def entries(*rows):
        return spark.createDataFrame(list(rows), "passport_num string, entry_dt timestamp_ntz")

    before = owners("2", None), entries(("p9", t))
    after = owners("2-new", "p2"), entries(("p9", t), ("p 0", t + 2 * hour), ("p0", t + 5 * hour))
    stamp = ts_lit(D3)
    old = fraud_report(txn, *before, terminals, stamp)
    fresh = sorted(map(str, refresh_report(old, txn, before, after, terminals, stamp).collect()))
    scratch = sorted(map(str, fraud_report(txn, *after, terminals, stamp).collect()))
    assert fresh == scratch and fresh != sorted(map(str, old.collect()))
    same = refresh_report(old, txn, before, before, terminals, stamp)
    assert sorted(map(str, same.collect())) == sorted(map(str, old.collect()))
    assert same.where(F.col("passport") == "nobody").count() == 0


@pytest.mark.parametrize("versioned", [False, True])
def test_refresh_runs_rule_3_only_where_owners_changed(spark, monkeypatch, versioned):
    t = dt.datetime(2024, 3, 1, 10)
    hour = dt.timedelta(hours=1)
    txn = spark.createDataFrame([(f"t{k}", t + k * hour / 6, f"c{k % 3}", f"T{k % 4}") for k in range(24)]
                                + [("t0", t, "c0", "T1"), ("n", t, None, "T0"), ("m", t, "c9", None)],
                                "trans_id string, trans_date timestamp_ntz, card_num string, terminal string")
    terminals = spark.createDataFrame([(f"T{k}", "AB"[k % 2]) for k in range(4)], "terminal_id string, terminal_city string")
    schema = ("card_num string, account_num string, account_valid_to timestamp_ntz, client_id string, "
              "passport_num string, passport_valid_to date, fio string, phone string")

    def owners(ends, phone="1"):
        out = spark.createDataFrame([
            ("c0", "a0", ends, "k0", "p0", None, "F0", phone), ("c1", "a1", None, "k1", None, None, "F1", "2"),
            ("c1", "a1", None, "k1", None, None, "F1", "2"), ("c2", "a2", ends, "k2", "p2", dt.date(2024, 2, 1), None, "3")],
            schema)
        return out if not versioned else out.selectExpr(
            "*", "timestamp_ntz'2020-01-01 00:00:00' AS effective_from",
            "timestamp_ntz'5999-12-31 00:00:00' AS effective_to", "0 AS deleted_flg")

    def entries(*rows):
        return spark.createDataFrame([(None, t), *rows], "passport_num string, entry_dt timestamp_ntz")

    before = owners(None), entries(("p9", t))
    dates = owners(t + hour), entries(("p9", t), ("p 2", t), (None, t - hour))
    phones = owners(t + hour, "1-new"), dates[1]
    stamp = ts_lit(D3)
    old = fraud_report(txn, *before, terminals, stamp).localCheckpoint()
    runs = []
    rule = fraud.velocity_rule
    monkeypatch.setattr(fraud, "velocity_rule", lambda *a, **k: runs.append(1) or rule(*a, **k))
    for after, reruns in ((dates, 0), (phones, 1), (before, 0)):
        runs.clear()
        fresh = sorted(map(str, refresh_report(old, txn, before, after, terminals, stamp).collect()))
        assert len(runs) == reruns
        assert fresh == sorted(map(str, fraud_report(txn, *after, terminals, stamp).collect()))
    later = refresh_report(old, txn, before, dates, terminals, ts_lit("2024-03-09")).where("event_type = 3")
    stamps = {(r.passport, r.report_dt.day) for r in later.collect()}
    assert {s for s in stamps if s[0] is not None} == {("p0", 9), ("p2", 9)} and {d for p, d in stamps if p is None} <= {D3.day}


def test_hot_keys_are_counted_by_slots_first(spark):
    from dimledger.operators import scan

    df = spark.createDataFrame([(k % 97 if k % 3 else None,) for k in range(3000)] + [(7,)] * 500, "k long")
    want = {r[0] for r in df.groupBy("k").count().where("count > 400").collect()}
    for hot_rows in (400, 10_000):
        got = scan.hot_keys(df, ["k"], hot_rows)
        assert ({r["k"] for r in got.collect()} if got is not None else set()) == (want if hot_rows == 400 else set())
    sample = df.selectExpr("k", "monotonically_increasing_id() AS id", "'wide' AS w")
    plan = scan.with_previous(sample, ["k"], ["id"], ["id", "w"])._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window"):].split("\n", 1)[1]
    assert "struct(" not in below        # no copy of the columns is shuffled

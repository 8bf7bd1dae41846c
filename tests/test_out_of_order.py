"""Snapshots in any order on two time axes, and joins of validity intervals by bins."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from rows import rows
from dimledger.functions.columns import SENTINEL_TS, ts_lit
from dimledger.operators.bitemporal import deliver, known_states, state_schema, versions_of
from dimledger.operators.intervals import _candidates, overlap_join
from dimledger.operators.scd2 import scd2_merge

SNAP = "k string, a string, b string"
HIST = SNAP + ", effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg int"
DAYS = [dt.date(2024, 3, d) for d in (1, 2, 4, 7)]


def in_order(spark, snapshots):
    hist = spark.createDataFrame([], HIST)
    for day in sorted(snapshots):
        hist = scd2_merge(hist, spark.createDataFrame(snapshots[day], SNAP), ["k"], ["a"], ["a", "b"],
                          ts_lit(day)).checkpoint()
    return rows(hist)


def delivered(spark, snapshots, order):
    states = spark.createDataFrame([], state_schema(spark.createDataFrame([], SNAP).schema.fields))
    seen = set()
    for n, day in enumerate(order):
        later = min((d for d in seen if d > day), default=None)
        states = deliver(states, spark.createDataFrame(snapshots[day], SNAP), ["k"], ["a", "b"], ts_lit(day),
                         ts_lit(dt.date(2025, 1, n + 1)), None if later is None else ts_lit(later)).checkpoint()
        seen.add(day)
    return states


def random_snapshots(seed):
    rng = random.Random(seed)
    return {day: [(k, rng.choice(["x", "y", None]), rng.choice("12")) for k in "pqrstuvw" if rng.random() < 0.7]
            for day in DAYS}


@pytest.mark.parametrize("seed", range(2))
def test_any_order_equals_loading_in_order(spark, seed):
    snapshots = random_snapshots(seed)
    want = in_order(spark, snapshots)
    orders = list(itertools.permutations(DAYS))
    for order in random.Random(seed).sample(orders, 2):
        got = versions_of(delivered(spark, snapshots, order), ["k"], ["a", "b"], ["a"])
        assert rows(got.select(*[c.split()[0] for c in HIST.split(", ")])) == want
        assert got.where("effective_to < effective_from").isEmpty()


def test_what_was_known_at_each_load(spark):
    snapshots = random_snapshots(9)
    order = [DAYS[2], DAYS[0], DAYS[3], DAYS[1]]
    states = delivered(spark, snapshots, order)
    for n in range(1, 5):
        known = versions_of(states, ["k"], ["a", "b"], ["a"], known_at=ts_lit(dt.datetime(2025, 1, n, 12)))
        assert rows(known) == in_order(spark, {d: snapshots[d] for d in order[:n]})
    assert versions_of(states, ["k"], ["a", "b"], ["a"], known_at=ts_lit(dt.date(2024, 1, 1))).isEmpty()
    assert known_states(states).where("known_to <= known_from").isEmpty()


def test_a_day_again_replaces_what_it_said(spark):
    snapshots = random_snapshots(4)
    states = delivered(spark, snapshots, DAYS)
    fixed = {**snapshots, DAYS[1]: [("p", "z", "1"), ("new", "z", None)]}
    again = deliver(states, spark.createDataFrame(fixed[DAYS[1]] * 2, SNAP), ["k"], ["a", "b"], ts_lit(DAYS[1]),
                    ts_lit(dt.date(2025, 2, 1)), ts_lit(DAYS[2]))
    assert rows(versions_of(again, ["k"], ["a", "b"], ["a"])) == in_order(spark, fixed)
    same = deliver(states, spark.createDataFrame(snapshots[DAYS[3]], SNAP), ["k"], ["a", "b"], ts_lit(DAYS[3]),
                   ts_lit(dt.date(2025, 2, 1)))
    assert rows(same) == rows(states)


def test_empty_snapshots_null_keys_and_ties(spark):
    snapshots = {DAYS[0]: [(None, "x", "1"), ("p", None, None)], DAYS[1]: [], DAYS[2]: [(None, "x", "2")]}
    got = rows(versions_of(delivered(spark, snapshots, [DAYS[2], DAYS[1], DAYS[0]]), ["k"], ["a", "b"], ["a"]))
    d0, d1, d2 = (dt.datetime.combine(d, dt.time()) for d in DAYS[:3])
    s = dt.timedelta(seconds=1)
    assert sorted(got, key=str) == sorted([
        (None, "x", "1", d0, d1 - s, 0), (None, "x", "1", d1, d2 - s, 1), (None, "x", "2", d2, SENTINEL_TS, 0),
        ("p", None, None, d0, d1 - s, 0), ("p", None, None, d1, SENTINEL_TS, 1)], key=str)
    with pytest.raises(Exception, match="two different rows"):
        delivered(spark, {DAYS[0]: [("p", "x", "1"), ("p", "y", "1")]}, [DAYS[0]])


def test_hot_key_states_are_split(spark):
    snapshots = random_snapshots(6)
    states = delivered(spark, snapshots, DAYS)
    assert rows(versions_of(states, ["k"], ["a", "b"], ["a"], hot_rows=1)) == in_order(spark, snapshots)


def intervals(rng, n, keys=3):
    out = []
    for i in range(n):
        f = dt.datetime(2020, 1, 1) + dt.timedelta(seconds=rng.randrange(10 ** rng.randrange(1, 9)))
        t = SENTINEL_TS if rng.random() < 0.1 else f + dt.timedelta(seconds=rng.randrange(-5, 10 ** rng.randrange(1, 9)))
        out.append((rng.choice([None, *range(keys)]), i, rng.choice([f, f, f, None]), t))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_overlap_join_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    left, right = intervals(rng, 120), intervals(rng, 120)
    right += right[:10]
    ends = "s timestamp_ntz, e timestamp_ntz"
    got = overlap_join(spark.createDataFrame(left, f"lk int, li int, {ends}"),
                       spark.createDataFrame(right, f"rk int, ri int, {ends}"), "lk", "rk", "s", "e")
    want = [(li, ri, max(a, c), min(b, d)) for k, li, a, b in left for q, ri, c, d in right
            if None not in (k, a, c) and k == q and a <= b and c <= d and a <= d and c <= b]
    assert got.columns == ["lk", "li", "s", "e", "rk", "ri"]
    assert sorted(map(tuple, got.select("li", "ri", "s", "e").collect())) == sorted(want)
    assert overlap_join(spark.createDataFrame([], f"lk int, li int, {ends}"),
                        spark.createDataFrame(right, f"rk int, ri int, {ends}"), "lk", "rk", "s", "e").isEmpty()


def test_pairs_formed_are_linear_in_the_versions_of_one_key(spark):
    def history(n, step):
        start = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
        h = spark.range(n).select(
            F.lit(1).alias("k"), (start + F.make_dt_interval(mins=F.col("id") * step)).alias("s"),
            (start + F.make_dt_interval(mins=(F.col("id") + 1) * step, secs=F.lit(-1))).alias("e"))
        return h.withColumn("e", F.when(F.col("s") == h.agg(F.max("s")).scalar(), ts_lit(SENTINEL_TS))
                            .otherwise(F.col("e")))

    def pairs(n):
        right = history(n, 11).select(F.col("k").alias("q"), F.col("s").alias("f"), F.col("e").alias("t"))
        return _candidates(history(n, 7), right, "k", "q", ("s", "e"), ("f", "t")).count()

    small, large = pairs(2_000), pairs(100_000)
    assert large < 60 * small          # all pairs of the key: 2,500 times as many
    assert large < 40 * 100_000

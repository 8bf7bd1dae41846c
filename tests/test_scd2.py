import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import rows
from dimledger.functions.columns import SENTINEL_TS, ts_lit
from dimledger.operators.scd2 import current_rows, pit_join, scd2_history, scd2_merge

SNAP = T.StructType([T.StructField("id", T.StringType()), T.StructField("a", T.StringType()),
                     T.StructField("b", T.StringType()), T.StructField("upd", T.TimestampNTZType())])
HIST = T.StructType([T.StructField("id", T.StringType()), T.StructField("a", T.StringType()),
                     T.StructField("b", T.StringType()),
                     T.StructField("effective_from", T.TimestampNTZType()),
                     T.StructField("effective_to", T.TimestampNTZType()),
                     T.StructField("deleted_flg", T.IntegerType())])
D1, D2, D3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
SEC = dt.timedelta(seconds=1)


def merge(spark, hist, snap, run, from_col="upd"):
    return scd2_merge(hist, spark.createDataFrame(snap, SNAP), key=["id"], tracked=["a"],
                      attrs=["a", "b"], run_ts=ts_lit(run), from_col=from_col)


def day1(spark):
    snap = [("k_same", "x", "1", D1), ("k_chg", "x", "1", D1), ("k_untracked", "x", "1", D1),
            ("k_null", None, "1", D1), ("k_tonull", "x", "1", D1), ("k_gone", "x", "1", D1)]
    return merge(spark, spark.createDataFrame([], HIST), snap, D1)


def test_first_load_opens_one_version_per_key(spark):
    h = rows(day1(spark))
    assert len(h) == 6
    assert all(r[4] == SENTINEL_TS and r[5] == 0 for r in h)


def test_change_classes(spark):
    snap2 = [("k_same", "x", "1", D1), ("k_chg", "y", "1", D2), ("k_untracked", "x", "2", D2),
             ("k_null", "v", "1", D2), ("k_tonull", None, "1", D2), ("k_new", "n", "1", D2)]
    h = rows(merge(spark, day1(spark).cache(), snap2, D2))
    by = {}
    for r in h:
        by.setdefault(r[0], []).append(r)
    assert by["k_same"] == [("k_same", "x", "1", D1, SENTINEL_TS, 0)]
    assert sorted(by["k_chg"], key=lambda r: r[3]) == [
        ("k_chg", "x", "1", D1, D2 - SEC, 0), ("k_chg", "y", "1", D2, SENTINEL_TS, 0)]
    # an untracked attribute alone makes no version
    assert by["k_untracked"] == [("k_untracked", "x", "1", D1, SENTINEL_TS, 0)]
    # NULL -> value and value -> NULL are changes (null-safe compare)
    assert len(by["k_null"]) == 2 and len(by["k_tonull"]) == 2
    assert by["k_new"] == [("k_new", "n", "1", D2, SENTINEL_TS, 0)]
    # a vanished key is closed and gets an open tombstone with its last attributes
    assert sorted(by["k_gone"], key=lambda r: r[3]) == [
        ("k_gone", "x", "1", D1, D2 - SEC, 0), ("k_gone", "x", "1", D2, SENTINEL_TS, 1)]


def test_returning_key_closes_tombstone(spark):
    h1 = day1(spark)
    h2 = merge(spark, h1, [("k_same", "x", "1", D1)], D2)
    h3 = rows(merge(spark, h2, [("k_same", "x", "1", D1), ("k_gone", "z", "1", D3)], D3))
    gone = sorted([r for r in h3 if r[0] == "k_gone"], key=lambda r: r[3])
    assert gone == [("k_gone", "x", "1", D1, D2 - SEC, 0), ("k_gone", "x", "1", D2, D3 - SEC, 1),
                    ("k_gone", "z", "1", D3, SENTINEL_TS, 0)]


def test_same_snapshot_twice_is_idempotent(spark):
    snap = [("a1", "x", "1", D1), ("a2", "y", "1", D1)]
    h1 = merge(spark, spark.createDataFrame([], HIST), snap, D1)
    h2 = merge(spark, h1, snap, D2)
    assert rows(h1) == rows(h2)


def test_empty_snapshot_deletes_everything(spark):
    h = rows(merge(spark, day1(spark), [], D2))
    open_ = [r for r in h if r[4] == SENTINEL_TS]
    assert len(open_) == 6 and all(r[5] == 1 for r in open_)
    assert rows(current_rows(spark.createDataFrame(h, HIST))) == []


def test_duplicate_snapshot_rows_keep_latest(spark):
    snap = [("d", "old", "1", D1), ("d", "new", "1", D2)]
    h = rows(merge(spark, spark.createDataFrame([], HIST), snap, D2))
    assert h == [("d", "new", "1", D2, SENTINEL_TS, 0)]


def test_snapshot_without_update_time_uses_run_ts(spark):
    h1 = merge(spark, spark.createDataFrame([], HIST), [("t", "x", "1", None)], D1, from_col=None)
    h2 = rows(merge(spark, h1, [("t", "y", "1", None)], D2, from_col=None))
    assert h2 == [("t", "x", "1", D1, D2 - SEC, 0), ("t", "y", "1", D2, SENTINEL_TS, 0)]


def test_history_properties_on_orders(spark):
    """At most one open row per key; versions of a key never overlap."""
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    ch = o.select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("p"),
                  F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tie"))
    h = scd2_history(ch, ["k"], ["p"], "ts", "tie")
    assert h.groupBy("k").agg(F.sum((F.col("effective_to") == ts_lit(SENTINEL_TS)).cast("int")).alias("n")) \
        .where("n != 1").count() == 0
    a, b = h.alias("a"), h.alias("b")
    overlaps = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.effective_from") < F.col("b.effective_from"))
                      & (F.col("b.effective_from") <= F.col("a.effective_to")))
    assert overlaps.count() == 0


def test_history_hot_key_split_equals_plain(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    ch = o.select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("p"),
                  F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tie"))
    plain = scd2_history(ch, ["k"], ["p"], "ts", "tie", bucket=None)
    split = scd2_history(ch, ["k"], ["p"], "ts", "tie", bucket="month", hot_rows=3)
    assert rows(plain) == rows(split)


PIT_HIST = [("c", "v1", D1, D2 - SEC, 0), ("c", "v2", D2, D3 - SEC, 0), ("c", "v2", D3, SENTINEL_TS, 1)]


def test_pit_join_edges(spark):
    hist = spark.createDataFrame(PIT_HIST, "k string, v string, effective_from timestamp_ntz, "
                                           "effective_to timestamp_ntz, deleted_flg int")
    facts = spark.createDataFrame(
        [(1, "c", D1), (2, "c", D2 - SEC), (3, "c", D2 - dt.timedelta(microseconds=500000)),
         (4, "c", D2), (5, "c", D1 - SEC), (6, "c", D3 + SEC), (7, "x", D2)],
        "id int, k string, ts timestamp_ntz")
    for method in ("asof", "range"):
        got = rows(pit_join(facts, hist, ["k"], ["k"], "ts", ["v"], method=method).select("id", "v"))
        # at effective_from, at effective_to, and in the last second of a
        # version (v1 ends at D2-1s, v2 starts at D2); before the first version
        # and on a tombstone nothing matches
        assert got == [(1, "v1"), (2, "v1"), (3, "v1"), (4, "v2")], method
    left = rows(pit_join(facts, hist, ["k"], ["k"], "ts", ["v"], how="left").select("id", "v"))
    assert len(left) == 7 and (6, None) in left and (5, None) in left


def test_pit_join_hot_key_split_equals_range(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    ch = o.select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("p"),
                  F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tie"))
    hist = scd2_history(ch, ["k"], ["p"], "ts", "tie")
    facts = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", F.col("o_custkey").alias("k"))
    a = pit_join(facts, hist, ["k"], ["k"], "l_shipdate", ["p"], method="asof", bucket="month", hot_rows=5)
    b = pit_join(facts, hist, ["k"], ["k"], "l_shipdate", ["p"], method="range")
    assert rows(a) == rows(b)


def test_late_correction_never_overlaps(spark):
    h1 = merge(spark, spark.createDataFrame([], HIST), [("k", "x", "1", D2)], D2)
    # the source reports a change stamped before the open version's start
    h2 = rows(merge(spark, h1, [("k", "y", "1", D1)], D3))
    assert h2 == [("k", "x", "1", D2, D2, 0), ("k", "y", "1", D2 + SEC, SENTINEL_TS, 0)]


def test_merge_keeps_keys_without_a_time_and_opens_one_version_each(spark):
    h = merge(spark, spark.createDataFrame([], HIST), [("x", "1", "a", None), ("y", "1", "a", D1), ("y", "2", "a", D1)], D2)
    assert [(r[0], r[1], r[3]) for r in rows(h)] == [("x", "1", D2), ("y", "2", D1)]
    # without a source time, repeated keys of a snapshot still open one version
    twice = merge(spark, spark.createDataFrame([], HIST), [("t", "1", "a", None), ("t", "2", "a", None)], D2, from_col=None)
    assert [(r[0], r[1]) for r in rows(twice)] == [("t", "2")]

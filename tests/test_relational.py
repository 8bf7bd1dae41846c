import datetime as dt

from pyspark.sql import functions as F

from rows import rows
from dimledger.functions.columns import ts_lit
from dimledger.operators.relational import (anti_join, any_level_join, deepest_level_join, exclude,
                                            expand_hierarchy, fill, latest_per_key, normalise_missing,
                                            null_safe_join, profile, snapshot_as_of, sum_by)
from dimledger.operators.watermark import delta_since, next_watermark, watermark_value


def tree(spark):
    # root -> a -> a1 -> a11 -> a111 (level 4, not reached); root -> b (leaf at level 1)
    return spark.createDataFrame(
        [("root", "0", "Goods"), ("a", "root", "A"), ("b", "root", "B"), ("a1", "a", "A1"),
         ("a11", "a1", "A11"), ("a111", "a11", "A111"), ("other", "0", "Other")],
        "id string, parent string, name string")


def test_expand_hierarchy_levels(spark):
    paths = expand_hierarchy(tree(spark), "id", "parent", (F.col("parent") == "0") & (F.col("name") == "Goods"))
    assert rows(paths) == [("a", "a1", "a11"), ("b", None, None)]


def test_any_level_vs_deepest(spark):
    paths = expand_hierarchy(tree(spark), "id", "parent", (F.col("parent") == "0") & (F.col("name") == "Goods"))
    items = spark.createDataFrame([("i_mid", "a1"), ("i_leaf", "a11"), ("i_b", "b"), ("i_deep", "a111")],
                                  "item string, cat string")
    lv = ["cat_1", "cat_2", "cat_3"]
    assert [r[0] for r in rows(any_level_join(items, "cat", paths, lv))] == ["i_b", "i_leaf", "i_mid"]
    assert [r[0] for r in rows(deepest_level_join(items, "cat", paths, lv))] == ["i_b", "i_leaf"]


def test_null_aware_anti_join(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(anti_join(left, right, "k", null_aware=True)) == [(2,)]
    assert rows(anti_join(left, empty, "k", null_aware=True)) == [(1,), (2,), (None,)]
    assert rows(anti_join(left, with_null, "k", null_aware=True)) == []
    assert rows(anti_join(left, right, "k")) == [(2,), (None,)]


def test_exclude_keep_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(exclude(df, "c", ["a"])) == [("b",), (None,)]
    assert rows(exclude(df, "c", ["a"], keep_null=False)) == [("b",)]


def test_fill_and_normalise(spark):
    df = spark.createDataFrame([(None, float("nan"), "None"), ("k", 1.5, "v")], "cls string, m double, t string")
    out = fill(normalise_missing(df, ["m", "t"]), {"cls": "x", "m": 0.0})
    assert rows(out) == [("k", 1.5, "v"), ("x", 0.0, None)]


def test_sum_by_drops_null_keys_and_zero_fills(spark):
    df = spark.createDataFrame([("a", 1.1), ("a", 2.2), (None, 5.0), ("b", None)], "k string, v double")
    assert rows(sum_by(df, ["k"], ["v"], scale=2)) == [("a", 3.3), ("b", 0.0)]


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (None, "q")], "k2 int, b string")
    assert rows(null_safe_join(a, b, [("k", "k2")]).select("a", "b")) == [("x", "p"), ("y", "q")]


def test_latest_per_key_tie_break(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("u", t, 1, "used"), ("u", t, 2, "aborted"), ("v", t, 1, "used")],
                               "k string, ts timestamp_ntz, op int, s string")
    assert rows(latest_per_key(df, ["k"], ["ts", "op"])) == [("u", t, 2, "aborted"), ("v", t, 1, "used")]


def test_snapshot_as_of_keeps_all_rows_of_snapshot(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], "id int, ts int")
    assert [r[0] for r in rows(snapshot_as_of(df, "ts", F.lit(25)))] == [3]
    assert [r[0] for r in rows(snapshot_as_of(df, "ts", F.lit(10)))] == [1, 2]
    assert rows(snapshot_as_of(df, "ts", F.lit(5))) == []


def test_profile_counts_non_null(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a int, b string")
    assert rows(profile(df)) == [(2, 2, 1)]


def test_watermark_rules(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, None), (2, t + dt.timedelta(hours=1), None),
                                (3, t - dt.timedelta(days=1), t + dt.timedelta(hours=2))],
                               "id int, create_dt timestamp_ntz, update_dt timestamp_ntz")
    # first run: no watermark, everything loads
    assert len(rows(delta_since(df, None, ["create_dt"]))) == 3
    meta = spark.createDataFrame([(t,)], "max_update_dt timestamp_ntz")
    wm = watermark_value(meta)
    # strict: equal to the watermark is not new; NULL update_dt is skipped
    assert [r[0] for r in rows(delta_since(df, wm, ["create_dt", "update_dt"]))] == [2, 3]
    delta = delta_since(df, wm, ["create_dt", "update_dt"])
    assert rows(next_watermark(delta, ["create_dt", "update_dt"], meta)) == [(t + dt.timedelta(hours=2),)]
    # an empty delta keeps the old watermark
    assert rows(next_watermark(df.limit(0), ["create_dt", "update_dt"], meta)) == [(t,)]
    # a NULL stored watermark means "load everything"
    null_meta = spark.createDataFrame([(None,)], "max_update_dt timestamp_ntz")
    assert len(rows(delta_since(df, watermark_value(null_meta), ["create_dt"]))) == 3
    assert ts_lit("2024-01-01") is not None


def test_preview_and_union_all(spark):
    from dimledger.operators.relational import preview, union_all
    a = spark.createDataFrame([(i, "a") for i in range(30)], "k int, src string")
    b = spark.createDataFrame([("b", 99)], "src string, k int")
    assert len(rows(preview(a))) == 10
    u = union_all(a, b, b)                     # by name, duplicates kept
    assert u.count() == 32 and u.where("src = 'b'").count() == 2

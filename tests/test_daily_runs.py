import datetime as dt
import os

from pyspark.sql import functions as F

from rows import SF_SMALL, rows
from dimledger import catalogue as C
from dimledger.functions.columns import ts_lit
from dimledger.plans import feed, promo
from dimledger.sources.sinks import current_version
from test_promo import DAY, coupons, ops


def test_daily_promo_run_rerun_and_expiry(spark, scratch):
    stats, specs_root = os.path.join(scratch, "stats"), os.path.join(scratch, "specs")
    specs = spark.createDataFrame([("s1", "Spring", dt.datetime(2023, 1, 1)), ("s2", "Old", dt.datetime(2023, 1, 1))],
                                  "specification_id string, title string, created timestamp_ntz")
    cut = ts_lit("2022-12-01 06:00:00")
    promo.daily_promo_run(spark, coupons(spark), ops(spark), specs, DAY, stats, specs_root, cut)
    promo.daily_promo_run(spark, coupons(spark), ops(spark), specs, DAY, stats, specs_root, cut)  # rerun
    first = rows(spark.read.parquet(stats))
    assert len(first) == 5 and [r[0] for r in first].count("c_new") == 1
    # a later day on which the unused promo c_new ends: it expires in its own partition
    end_day = dt.date(2024, 6, 1)
    promo.daily_promo_run(spark, coupons(spark), ops(spark).limit(0), specs, end_day, stats, specs_root, cut)
    after = {(r["promocode_id"], r["load_date"]): r["status"] for r in spark.read.parquet(stats).collect()}
    assert after[("c_new", DAY)] == "expired"
    assert after[("c_used", DAY)] == "used"
    assert rows(spark.read.parquet(current_version(spark, specs_root))) == [("s1", "Spring", 4, 20),
                                                                           ("s2", "Old", 4, 4)]


def test_daily_feed_run_replaces_its_day(spark, scratch):
    out = os.path.join(scratch, "feed")
    x = C._FeedInputs(spark, SF_SMALL)
    args = dict(groups=C.category_groups(spark, SF_SMALL), items=x.items, skus=x.skus, general=x.general,
                stores=x.stores, warehouses=x.warehouses, stock=x.stock, abc=x.abc, day=C.FEED_DAY,
                out_path=out, root_name="ASIA", excluded_city=C.FEED_EXCLUDED_CITY)
    expected = feed.daily_feed_run(**args).count()
    feed.daily_feed_run(**args)
    got = spark.read.parquet(out)
    assert got.count() == expected
    assert got.select(F.countDistinct("date")).first()[0] in (0, 1)


def test_promo_run_keeps_old_specs_out_and_expiry_through_a_rerun(spark, scratch):
    stats, specs_root = os.path.join(scratch, "stats2"), os.path.join(scratch, "specs2")
    old = spark.createDataFrame([("s1", "Old", dt.datetime(2020, 1, 1))],
                                "specification_id string, title string, created timestamp_ntz")
    cut = F.lit(dt.datetime(2022, 1, 1)).cast("timestamp_ntz")
    promo.daily_promo_run(spark, coupons(spark), ops(spark), old, DAY, stats, specs_root, cut)
    assert spark.read.parquet(stats).where("specification_id = 's1'").count() == 0

    specs = spark.createDataFrame([("s1", "Spring", dt.datetime(2023, 1, 1)), ("s2", "Old", dt.datetime(2023, 1, 1))],
                                  "specification_id string, title string, created timestamp_ntz")
    run = lambda day: promo.daily_promo_run(
        spark, coupons(spark), ops(spark), specs, day, stats, specs_root, cut)
    run(DAY)
    run(dt.date(2024, 6, 1))       # c_new ends on this day, unused
    before = sorted((r.promocode_id, r.status or "") for r in spark.read.parquet(stats).collect())
    assert ("c_new", "expired") in before
    run(DAY)       # an older day again: what expired later stays expired
    assert sorted((r.promocode_id, r.status or "") for r in spark.read.parquet(stats).collect()) == before

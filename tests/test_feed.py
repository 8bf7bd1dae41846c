import datetime as dt

from pyspark.sql import functions as F


from dimledger.plans import feed

DAY = dt.date(2024, 4, 1)


def test_abc_feed_fan_out_fill_and_ranks(spark):
    stock = spark.createDataFrame([
        (DAY, "i1", 3.0, 300.0, "Shop A", "Almaty"),
        (DAY, "i1", 2.0, 200.0, "Shop B", "Almaty"),     # shop without sales
        (DAY, "i2", 1.0, 10.0, "Shop A", "Almaty"),      # sku without rank
        (DAY, "i3", 1.0, 10.0, "Shop A", "Almaty"),      # excluded category
        (DAY, "i4", 1.0, 10.0, None, "Almaty"),          # NULL group key: dropped
    ], "date date, items_id string, stock double, price double, store string, city string")
    skus = spark.createDataFrame([
        ("Phones", "Phone", "i1", "100", "Smartphones"), ("Cases", "Case", "i2", "200", "Accessories"),
        ("Svc", "Warranty", "i3", "300", "Сертификат гарантии"), ("X", "Four", "i4", "400", "Y"),
    ], "category_short string, item_name string, items_id string, webcode string, category_name string")
    sales = spark.createDataFrame([
        (DAY, "100", "Phone", "Shop A", 2, 1000, "Almaty"),
        (DAY, "100", "Phone", "Shop A", 1, 500, "Almaty"),  # second warehouse row of the same shop
    ], "date date, webcode string, item_name string, store string, quantity long, item_total long, city string")
    ranks = spark.createDataFrame([("100", 50.0, 9000.0, "X", "A", "Phones", "c1", 1.0, 2.0, 3.0)],
                                  "webcode string, total_sales_quantity double, total_sales_value double, "
                                  "xyz_rank string, abc_rank string, category_short string, class string, "
                                  "class_size double, category_sizes double, class_category_sizes double")
    out = feed.abc_feed(stock, skus, sales, ranks, DAY)
    assert out.columns == [f.name for f in feed.FEED_SCHEMA.fields]
    got = {(r["sku_id"], r["shop_name"]): r for r in out.collect()}
    assert set(got) == {("100", "Shop A"), ("100", "Shop B"), ("200", "Shop A")}
    a = got[("100", "Shop A")]
    assert (a["stock_value"], a["sales_quantity"], a["sales_value"], a["class"]) == (3.0, 3.0, 1500.0, "c1")
    b = got[("100", "Shop B")]
    assert (b["sales_quantity"], b["sales_value"]) == (0.0, 0.0)
    c = got[("200", "Shop A")]
    assert c["class"] == "x" and c["xyz_rank"] is None and c["date"] == dt.datetime(2024, 4, 1)
    # reference grain: each warehouse row repeats the stock row
    ref = feed.abc_feed(stock, skus, sales, ranks, DAY, grain="reference")
    assert ref.where("sku_id = '100' AND shop_name = 'Shop A'").count() == 2


def test_abc_cutoff():
    assert feed.abc_cutoff("2024-04-01") == int(dt.datetime(2024, 4, 2, 6, tzinfo=dt.timezone.utc).timestamp())


def test_sums_keep_decimals_and_casts_round(spark):
    from dimledger.functions.columns import exact_sum, whole_number
    df = spark.createDataFrame([(0.125, "1.7"), (0.125, "2.2"), (0.004, "n/a")], "x double, q string")
    got = df.agg(exact_sum("x").alias("x"), F.sum(whole_number("q")).alias("q")).first()
    assert got == (0.254, 4)

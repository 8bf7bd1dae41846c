"""Daily stock / sales / ABC-XYZ feed per shop.

Inputs have the shapes of the retail warehouse (binary ids, base64 in SQL):

* ``groups``     (_reference141) _idrref, _parentidrref, _description — category tree
* ``items``      (_reference140) _idrref, _description, _fld26454 (web code), _fld2428rref (category)
* ``skus``       (zitemsn) zitemsn_n_wc, directortxt, categtxt, categ_id (base64 text)
* ``general``    check lines: item, shops, kf_quan, kf_curr, post, delete, b2bflag,
  opertype, date, whs, whs_i (ids and flags already as base64 text)
* ``stores``     store_id, store_code, store, city, country
* ``warehouses`` (_reference188) _idrref, _fld30704rref (store), _fld25076 (purchasable flag)
* ``stock``      (stock_daily) items_id, warehouse_id, quant, price, date, country, quality
* ``abc``        (abc_etalon) SKU_ID, TOTAL_SALES_QUANTITY, TOTAL_SALES_VALUE, XYZ_RANK,
  ABC_RANK, CATEGORY_SHORT, class, class_size, category_sizes, class_category_sizes, timestamp

``ds=None`` runs a back-fill over every date in one job (grouped by date);
a date runs the daily report, and the date filter reaches the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimledger.functions.columns import (ZERO_ID_B64, default_label, exact_sum, flag_set,
                                         flag_unset, int_code, normalise_code, ts_lit, whole_number)
from dimledger.operators.relational import (any_level_join, deepest_level_join, exclude,
                                            expand_hierarchy, fill, snapshot_as_of, sum_by)
from dimledger.sources.schemas import conform

__all__ = ["category_paths", "sku_categories", "eligible_stores", "daily_stock", "daily_sales",
           "abc_snapshot", "abc_cutoff", "abc_feed", "FEED_SCHEMA"]

# Fixed values of the reference's feed (text compared as is):
ROOT_GROUP = "Товары"
STORE_PREFIX = "Магазин "
COUNTRY = "KZ"
EXCLUDED_CITY = "Бишкек"
SALE_OPERATION_B64 = "kE3odS6MJUhDNPleoFllIg=="
EXCLUDED_SALES_CATEGORIES = ["AccComp Программное обеспечение", "AccComp Медиа Сервисы"]
EXCLUDED_WEBCODES = ["216158", "62763", "108285"]
EXCLUDED_FEED_CATEGORIES = ["Сертификат гарантии", "Прочие услуги", "Сертификат подарочный",
                            "Гарантийный талон"]
GOOD_QUALITY = ["N", ""]

LEVELS = ["cat_1", "cat_2", "cat_3"]

FEED_SCHEMA = T.StructType([
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("sku_id", T.StringType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("category_short_x", T.StringType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("shop_name", T.StringType()),
    T.StructField("stock_value", T.DoubleType()),
    T.StructField("sales_quantity", T.DoubleType()),
    T.StructField("sales_value", T.DoubleType()),
    T.StructField("total_sales_quantity", T.DoubleType()),
    T.StructField("total_sales_value", T.DoubleType()),
    T.StructField("xyz_rank", T.StringType()),
    T.StructField("abc_rank", T.StringType()),
    T.StructField("category_short_y", T.StringType()),
    T.StructField("class", T.StringType()),
    T.StructField("class_size", T.DoubleType()),
    T.StructField("category_sizes", T.DoubleType()),
    T.StructField("class_category_sizes", T.DoubleType()),
])


def category_paths(groups: DataFrame, root_name: str = ROOT_GROUP, depth: int = 3) -> DataFrame:
    """Distinct (cat_1, cat_2, cat_3) below the named root, as base64 ids."""
    root = (F.base64("_parentidrref") == F.lit(ZERO_ID_B64)) & (F.col("_description") == root_name)
    nodes = groups.select("_idrref", "_parentidrref", "_description")
    paths = expand_hierarchy(nodes, "_idrref", "_parentidrref", root, depth=depth)
    # paths are distinct already and base64 is one-to-one
    return paths.select(*[F.base64(c).alias(c) for c in LEVELS[:depth]])


def sku_categories(items: DataFrame, skus: DataFrame, paths: DataFrame) -> DataFrame:
    """Items with their category labels, kept when the category is anywhere in
    the goods tree. Web codes are compared as normalised decimal text."""
    cat = (skus.select(F.col("zitemsn_n_wc").alias("_wc"), "directortxt", "categtxt", "categ_id")
           .distinct())
    prod = items.select("_idrref", "_description", "_fld26454",
                        normalise_code("_fld26454").alias("_code"))
    j = prod.join(cat.withColumn("_ccode", normalise_code("_wc")),
                  F.col("_code") == F.col("_ccode"), "inner")
    j = any_level_join(j, "categ_id", paths, LEVELS)
    return j.select(default_label("directortxt").alias("category_short"),
                    F.col("_description").alias("item_name"),
                    F.base64("_idrref").alias("items_id"),
                    int_code("_fld26454").alias("webcode"),
                    F.col("categtxt").alias("category_name")).distinct()


def _store_label(c) -> Column:
    return F.replace(F.col(c), F.lit(STORE_PREFIX), F.lit(""))


def eligible_stores(warehouses: DataFrame, stores: DataFrame, country: str = COUNTRY,
                    excluded_city: str = EXCLUDED_CITY) -> DataFrame:
    """Purchasable warehouses of shops in the country, minus one city."""
    st = stores.select("store_id", "store", "city", "country")
    w = warehouses.select(F.base64("_idrref").alias("whs_id"),
                          F.base64("_fld30704rref").alias("_store_ref"), "_fld25076")
    return (w.join(st, F.col("_store_ref") == F.col("store_id"))
            .where((F.col("country") == country) & (F.col("city") != excluded_city)
                   & flag_set("_fld25076"))
            .select("store_id", _store_label("store").alias("store"), "city", "whs_id"))


def _on_day(c: str, ds) -> Column:
    if isinstance(ds, str):
        ds = _dt.date.fromisoformat(ds)
    return F.col(c).cast("date") == F.lit(ds)


def daily_stock(stock: DataFrame, warehouses: DataFrame, stores: DataFrame, ds=None,
                country: str = COUNTRY, excluded_city: str = EXCLUDED_CITY) -> DataFrame:
    """Stock and stock value per item, shop and city (for one date, or every date)."""
    s = stock.where((F.col("country") == country) & F.col("quality").isin(*GOOD_QUALITY))
    if ds is not None:
        s = s.where(_on_day("date", ds))
    shops = eligible_stores(warehouses, stores, country, excluded_city)
    j = s.join(shops, F.col("warehouse_id") == F.col("whs_id"))
    return (j.groupBy(F.col("date").cast("date").alias("date"), "items_id", "store", "city")
            .agg(exact_sum("quant").alias("stock"), exact_sum("price").alias("price"))
            .select("date", "items_id", "stock", "price", "store", "city"))


def daily_sales(general: DataFrame, items: DataFrame, stores: DataFrame, paths: DataFrame, ds=None,
                country: str = COUNTRY, excluded_categories=EXCLUDED_SALES_CATEGORIES,
                excluded_webcodes=EXCLUDED_WEBCODES) -> DataFrame:
    """Sold quantity and revenue per item and shop from posted, non-deleted,
    non-B2B sale lines; items must sit at the deepest level of a goods path.

    Grouped like the reference, including the two warehouse columns
    (``whs``, ``whs_i``), so one item and shop can give several rows (D-18).
    """
    g = general.where(flag_set("post", True) & flag_unset("delete", True) & flag_unset("b2bflag", True)
                      & F.col("item").isNotNull()
                      & (F.col("opertype") == F.lit(SALE_OPERATION_B64)))
    if ds is not None:
        g = g.where(_on_day("date", ds))
    it = items.select(F.base64("_idrref").alias("_item"), "_description",
                      int_code("_fld26454").alias("item_code"),
                      F.base64("_fld2428rref").alias("cat_id")).distinct()
    st = stores.select("store_id", "store", "city", "country")
    j = (g.join(it, F.col("item") == F.col("_item"), "left")
         .join(st, F.col("shops") == F.col("store_id"), "left")
         .where(F.col("country") == country))
    sales = (j.groupBy(F.col("date").cast("date").alias("date"), "store", "item_code", "_description",
                       "country", "city", "cat_id", "whs", "whs_i")
             .agg(F.sum(whole_number("kf_quan")).alias("quantity"),
                  F.sum(whole_number("kf_curr")).alias("item_total")))
    sales = sales.select("date", F.col("item_code").alias("webcode"),
                         F.col("_description").alias("item_name"),
                         _store_label("store").alias("store"), "quantity", "item_total", "city",
                         "cat_id")
    deepest = paths.withColumn("_deep", F.coalesce(*[F.col(c) for c in reversed(LEVELS)]))
    deepest = deepest.where(~F.col("_deep").isin(*excluded_categories))
    out = deepest_level_join(sales, "cat_id", deepest.select(*LEVELS), LEVELS)
    out = out.where(~F.col("webcode").isin(*excluded_webcodes))
    return out.select("date", "webcode", "item_name", "store", "quantity", "item_total", "city")


def abc_cutoff(day) -> int:
    """Epoch seconds of ``day`` 00:00 UTC + 1 day + 6 h: the newest ABC
    snapshot taken before the next morning's run belongs to ``day``."""
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    start = _dt.datetime(day.year, day.month, day.day, tzinfo=_dt.timezone.utc)
    return int((start + _dt.timedelta(days=1, hours=6)).timestamp())


def abc_snapshot(abc: DataFrame, cutoff: int) -> DataFrame:
    """Latest ABC/XYZ ranking at or before ``cutoff``, keyed by text web code."""
    snap = snapshot_as_of(abc, "timestamp", F.lit(cutoff).cast("bigint"))
    return snap.select(int_code("SKU_ID").alias("webcode"),
                       F.col("TOTAL_SALES_QUANTITY").alias("total_sales_quantity"),
                       F.col("TOTAL_SALES_VALUE").alias("total_sales_value"),
                       F.col("XYZ_RANK").alias("xyz_rank"), F.col("ABC_RANK").alias("abc_rank"),
                       F.col("CATEGORY_SHORT").alias("category_short"), "class", "class_size",
                       "category_sizes", "class_category_sizes")


def abc_feed(stock: DataFrame, skus: DataFrame, sales: DataFrame, ranks: DataFrame, day,
             excluded=EXCLUDED_FEED_CATEGORIES, grain: str = "keys") -> DataFrame:
    """The 19-column feed for one day.

    stock ⋈ sku categories (SQL equality: NULL ids never match, D-20) → sum per
    item/shop (NULL-key groups dropped) ⟕ sales ⟕ rank snapshot. Missing
    sales are 0, a missing class is ``'x'``, missing ranks stay NULL (D-21).
    With ``grain='keys'`` sales are first summed to the four join keys so the
    left join cannot repeat stock rows (D-18); ``grain='reference'`` keeps the
    warehouse grain and its fan-out.
    """
    keys6 = ["webcode", "item_name", "city", "shop_name", "category_short", "category_name"]
    keys4 = ["webcode", "item_name", "shop_name", "city"]
    s = stock.join(skus, "items_id")
    s = s.select("webcode", "item_name", "price", F.col("stock").alias("quant"), "city",
                 F.col("store").alias("shop_name"), "category_short", "category_name")
    s = sum_by(s, keys6, ["price", "quant"], scale=6)
    sl = sales.select("webcode", "item_name", F.col("store").alias("shop_name"),
                      F.col("quantity").cast("double").alias("quantity"),
                      F.col("item_total").cast("double").alias("item_total"), "city")
    if grain == "keys":
        sl = sum_by(sl, keys4, ["quantity", "item_total"], scale=6)
    t = s.join(sl, keys4, "left")
    t = fill(t, {"quantity": 0.0, "item_total": 0.0})
    t = exclude(t, "category_name", excluded, keep_null=True)
    r = ranks.withColumnRenamed("category_short", "category_short_y")
    t = (t.withColumnRenamed("category_short", "category_short_x")
         .join(r, "webcode", "left")
         .withColumn("class", F.coalesce(F.col("class"), F.lit("x"))))
    t = t.select(ts_lit(day).alias("date"), F.col("webcode").alias("sku_id"),
                 F.col("item_name").alias("sku_name"), "category_short_x", "category_name",
                 F.col("city").alias("city_name"), "shop_name",
                 F.col("quant").alias("stock_value"), F.col("quantity").alias("sales_quantity"),
                 F.col("item_total").alias("sales_value"), "total_sales_quantity",
                 "total_sales_value", "xyz_rank", "abc_rank", "category_short_y", "class",
                 "class_size", "category_sizes", "class_category_sizes")
    return conform(t, FEED_SCHEMA)


def daily_feed_run(groups: DataFrame, items: DataFrame, skus: DataFrame, general: DataFrame,
                   stores: DataFrame, warehouses: DataFrame, stock: DataFrame, abc: DataFrame,
                   day, out_path: str, root_name: str = ROOT_GROUP,
                   excluded_city: str = EXCLUDED_CITY) -> DataFrame:
    """Build the day's feed from the warehouse tables and replace that day's
    partition (``feed_date``) of ``out_path``: a rerun leaves one copy, or none
    if the day is now empty. Returns the feed."""
    from dimledger.sources.sinks import replace_partition

    paths = category_paths(groups, root_name=root_name)
    day_stock = daily_stock(stock, warehouses, stores, ds=day, excluded_city=excluded_city)
    day_sales = daily_sales(general, items, stores, paths, ds=day)
    out = abc_feed(day_stock, sku_categories(items, skus, paths), day_sales,
                   abc_snapshot(abc, abc_cutoff(day)), day)
    replace_partition(out, out_path, "feed_date", day if isinstance(day, str) else day.isoformat())
    return out

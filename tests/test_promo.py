import datetime as dt

from pyspark.sql import functions as F

from rows import rows
from dimledger.plans import promo

DAY = dt.date(2024, 5, 10)
T = dt.datetime(2024, 5, 10, 12, 0)
S = dt.timedelta(seconds=1)


def coupons(spark):
    return spark.createDataFrame([
        ("c_used", "U", True, "s1", "2024-06-01 00:00:00", "2024-05-01 00:00:00", 5),
        ("c_used_abort", "UA", True, "s1", "2024-06-01 00:00:00", "2024-05-01 00:00:00", 5),
        ("c_abort_used", "AU", True, "s1", "2024-06-01 00:00:00", "2024-05-01 00:00:00", 5),
        ("c_cancel", "C", True, "s1", "2024-06-01 00:00:00", "2024-05-01 00:00:00", 5),
        ("c_inactive", "I", False, "s2", "2024-06-01 00:00:00", "2024-05-01 00:00:00", 1),
        ("c_tie", "T", True, "s2", "2024-06-01 00:00:00", "2024-05-01 00:00:00", 1),
        ("c_new", "N", True, "s2", "2024-06-01 00:00:00", "2024-05-10 23:59:59.999999", 1),
        ("c_quiet", "Q", True, "s2", "2024-06-01 00:00:00", "2024-05-01 00:00:00", 1),
        ("c_bad", "B", True, None, "soon", "garbage", None),
    ], "coupon_id string, code string, active boolean, specification_id string, end string, "
       "start string, limit int")


def ops(spark):
    return spark.createDataFrame([
        (1, "c_used", "used", T, "u1"),
        (2, "c_used_abort", "used", T, "u1"), (3, "c_used_abort", "aborted", T + S, "u1"),
        (4, "c_abort_used", "aborted", T, "u1"), (5, "c_abort_used", "used", T + S, "u1"),
        (6, "c_cancel", "canceled", T, "u1"),
        (7, "c_inactive", "used", T, "u1"),
        (8, "c_tie", "aborted", T, "u1"), (9, "c_tie", "used", T, "u1"),
        (10, "c_unknown", "used", T, "u1"),
        (11, "c_used", "used", dt.datetime(2024, 5, 11, 0, 0), "u2"),  # next day
    ], "op_id long, coupon_id string, status string, updated timestamp_ntz, user_id string")


def test_promo_state_cases(spark):
    got = {r[0]: r for r in rows(promo.promo_state(coupons(spark), ops(spark), DAY))}
    assert got["c_used"][3] == "used" and got["c_used"][4] == DAY
    assert "c_used_abort" not in got           # last attempt aborted
    assert got["c_abort_used"][3] == "used"
    assert got["c_cancel"][3] == "canceled"
    assert "c_inactive" not in got             # inactive coupons' uses do not count
    assert got["c_tie"][3] == "used"           # equal times: higher operation id wins
    assert got["c_new"][3] is None and got["c_new"][6] == DAY   # created in the last microsecond
    assert "c_quiet" not in got and "c_unknown" not in got and "c_bad" not in got


def test_promo_state_without_operations(spark):
    none = ops(spark).limit(0)
    got = rows(promo.promo_state(coupons(spark), none, DAY))
    assert [r[0] for r in got] == ["c_new"]


def test_spec_stats(spark):
    specs = spark.createDataFrame([("s1", "Spring", dt.datetime(2023, 1, 1)), ("s2", "Old", dt.datetime(2022, 1, 1))],
                                  "specification_id string, title string, created timestamp_ntz")
    recent = promo.specs_since(specs, F.lit(dt.datetime(2022, 12, 1, 6)).cast("timestamp_ntz"))
    assert rows(promo.spec_stats(coupons(spark), recent)) == [("s1", "Spring", 4, 20)]


def test_expire_status(spark):
    df = spark.createDataFrame([("a", None, DAY), ("b", "used", DAY), ("c", None, dt.date(2024, 5, 11))],
                               "promocode_id string, status string, end_date date")
    out = promo.expire_status(df, F.lit(DAY), F.lit(dt.date(2024, 5, 11)))
    assert rows(out) == [("a", "expired", DAY), ("b", "used", DAY), ("c", None, dt.date(2024, 5, 11))]

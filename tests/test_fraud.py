import datetime as dt

from rows import rows
from dimledger.functions.columns import SENTINEL_TS, ts_lit
from dimledger.plans import fraud

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)
MIN = dt.timedelta(minutes=1)


def owners(spark, passport_valid_to=None, account_valid_to=None):
    clients = spark.createDataFrame(
        [("cl1", "Ivanov", "Ivan", "Ivanovich", "12 34", passport_valid_to, "+7000"),
         ("cl2", "Petrov", "Petr", None, "5678", None, "+7001")],
        "client_id string, last_name string, first_name string, patronymic string, "
        "passport_num string, passport_valid_to date, phone string")
    accounts = spark.createDataFrame([("acc1", account_valid_to, "cl1"), ("acc2", None, "cl2")],
                                     "account_num string, valid_to timestamp_ntz, client string")
    cards = spark.createDataFrame([("card1", "acc1"), ("card2", "acc2")], "card_num string, account_num string")
    return fraud.card_owners(clients, accounts, cards, versions="all")


def txn(spark, rows_):
    return spark.createDataFrame(rows_, "trans_id string, trans_date timestamp_ntz, card_num string, terminal string")


TERMINALS = [("t_a", "Almaty"), ("t_a2", "Almaty"), ("t_b", "Astana"), ("t_moved", "Astana")]


def test_velocity_rule_edges(spark):
    t = txn(spark, [
        ("1", T0, "card1", "t_a"),
        ("2", T0 + 59 * MIN + dt.timedelta(seconds=59), "card1", "t_b"),   # 59:59 later, other city: flagged
        ("3", T0 + 119 * MIN + dt.timedelta(seconds=59), "card1", "t_a"),  # exactly 1:00:00 later: not flagged
        ("4", T0 + 150 * MIN, "card1", "t_a2"),                            # same city: not flagged
        ("5", T0 + 160 * MIN, "card1", "t_unknown"),                       # unknown terminal: not flagged
        ("6", T0, "card2", "t_b"),                                         # first row of a card
        ("7", T0, "card2", "t_a"),                                         # equal time, tie-break by id: flagged
    ])
    terms = spark.createDataFrame(TERMINALS, "terminal_id string, terminal_city string")
    got = rows(fraud.velocity_rule(t, terms, owners(spark)))
    assert [(r[0], r[4]) for r in got] == [(T0, 3), (T0 + 59 * MIN + dt.timedelta(seconds=59), 3)]
    # a NULL patronymic makes the whole name NULL, as string concatenation does
    assert {r[2] for r in got} == {"Ivanov Ivan Ivanovich", None}


def test_velocity_hot_card_split_equals_plain(spark):
    base = [(str(i), T0 + i * 7 * MIN, "card1", ["t_a", "t_b", "t_a2"][i % 3]) for i in range(200)]
    t = txn(spark, base)
    terms = spark.createDataFrame(TERMINALS, "terminal_id string, terminal_city string")
    plain = fraud.velocity_rule(t, terms, owners(spark), bucket=None)
    split = fraud.velocity_rule(t, terms, owners(spark), bucket="hour", hot_rows=10)
    assert rows(plain) == rows(split) and len(rows(plain)) > 0


def test_expired_document_default_and_inclusive(spark):
    o = owners(spark, passport_valid_to=dt.date(2024, 3, 1))
    t = txn(spark, [("1", dt.datetime(2024, 3, 1, 0, 0), "card1", None),
                    ("2", dt.datetime(2024, 3, 1, 10, 0), "card1", None),
                    ("3", dt.datetime(2024, 3, 2, 0, 0), "card1", None),
                    ("4", dt.datetime(2030, 1, 1), "card2", None)])  # NULL expiry: never
    assert [r[0] for r in rows(fraud.rule_expired_document(t, o))] == [
        dt.datetime(2024, 3, 1, 10, 0), dt.datetime(2024, 3, 2)]
    assert [r[0] for r in rows(fraud.rule_expired_document(t, o, inclusive=True))] == [dt.datetime(2024, 3, 2)]


def test_blacklist_strict_and_normalised(spark):
    o = owners(spark)
    bl = spark.createDataFrame([("1234", T0), ("1 2 3 4", T0 + MIN)], "passport_num string, entry_dt timestamp_ntz")
    t = txn(spark, [("1", T0, "card1", None), ("2", T0 + 2 * MIN, "card1", None)])
    got = rows(fraud.rule_blacklisted(t, o, bl))
    # the entry equal to the event time does not count; one row per operation
    assert [(r[0], r[1], r[4]) for r in got] == [(T0 + 2 * MIN, "12 34", 1)]


def test_expired_contract(spark):
    o = owners(spark, account_valid_to=T0)
    t = txn(spark, [("1", T0, "card1", None), ("2", T0 + MIN, "card1", None)])
    assert [(r[0], r[4]) for r in rows(fraud.rule_expired_contract(t, o))] == [(T0 + MIN, 2)]


def test_report_distinct_and_stamped(spark):
    o = owners(spark, passport_valid_to=dt.date(2024, 1, 1), account_valid_to=T0)
    bl = spark.createDataFrame([("1234", T0 - MIN)], "passport_num string, entry_dt timestamp_ntz")
    terms = spark.createDataFrame(TERMINALS, "terminal_id string, terminal_city string")
    t = txn(spark, [("1", T0 + MIN, "card1", "t_a"), ("2", T0 + MIN, "card1", "t_b")])
    got = rows(fraud.fraud_report(t, o, bl, terms, report_dt=ts_lit("2024-03-02")))
    assert sorted((r[0], r[4]) for r in got) == [(T0 + MIN, 1), (T0 + MIN, 2), (T0 + MIN, 3)]
    assert {r[5] for r in got} == {dt.datetime(2024, 3, 2)}


def test_card_owners_point_in_time(spark):
    D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    S = SENTINEL_TS
    clients = spark.createDataFrame(
        [("cl1", "A", "B", "C", "P-old", None, "ph", D1, D2 - dt.timedelta(seconds=1), 0),
         ("cl1", "A", "B", "C", "P-new", None, "ph", D2, S, 0)],
        "client_id string, last_name string, first_name string, patronymic string, passport_num string, "
        "passport_valid_to date, phone string, effective_from timestamp_ntz, effective_to timestamp_ntz, "
        "deleted_flg int")
    accounts = spark.createDataFrame([("acc1", None, "cl1", D1, S, 0)],
                                     "account_num string, valid_to timestamp_ntz, client string, "
                                     "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg int")
    cards = spark.createDataFrame([("card1", "acc1", D1, S, 0)],
                                  "card_num string, account_num string, effective_from timestamp_ntz, "
                                  "effective_to timestamp_ntz, deleted_flg int")
    bl = spark.createDataFrame([("P-old", D1), ("P-new", D1)], "passport_num string, entry_dt timestamp_ntz")
    t = txn(spark, [("1", dt.datetime(2024, 1, 15), "card1", None), ("2", dt.datetime(2024, 2, 15), "card1", None)])
    pit = fraud.card_owners(clients, accounts, cards, versions="pit")
    got = rows(fraud.rule_blacklisted(t, pit, bl, pit=True))
    assert [(r[0], r[1]) for r in got] == [(dt.datetime(2024, 1, 15), "P-old"), (dt.datetime(2024, 2, 15), "P-new")]
    cur = fraud.card_owners(clients, accounts, cards, versions="current")
    assert {r[1] for r in rows(fraud.rule_blacklisted(t, cur, bl))} == {"P-new"}


def test_velocity_terminal_that_moved_city(spark):
    S = SENTINEL_TS
    moved_at = T0 + 30 * MIN
    versions = spark.createDataFrame(
        [("t_m", "Almaty", T0 - 60 * MIN, moved_at - dt.timedelta(seconds=1), 0),
         ("t_m", "Astana", moved_at, S, 0)],
        "terminal_id string, terminal_city string, effective_from timestamp_ntz, effective_to timestamp_ntz, "
        "deleted_flg int")
    t = txn(spark, [("1", T0, "card1", "t_m"), ("2", T0 + 40 * MIN, "card1", "t_m")])
    got = rows(fraud.velocity_rule(t, versions, owners(spark)))
    assert [(r[0], r[4]) for r in got] == [(T0 + 40 * MIN, 3)]      # Almaty then Astana
    current = versions.where("effective_to = timestamp_ntz'5999-12-31 00:00:00'").select("terminal_id", "terminal_city")
    assert rows(fraud.velocity_rule(t, current, owners(spark))) == []  # same city today

"""Two days of the bank warehouse end to end (files in, report out), and a rerun."""

import datetime as dt
import os

from pyspark.sql import functions as F

from dimledger.plans.bank import daily_fraud_run
from dimledger.sources import schemas
from dimledger.sources.readers import daily_file_name

D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
T0 = dt.datetime(2024, 1, 1)


def _sources(spark, day):
    phone_change = day >= D2
    clients = spark.createDataFrame([
        ("C1", "Ivanov", "Ivan", "Ivanovich", dt.date(1990, 1, 1), "1111 111111", dt.date(2030, 1, 1),
         "+7-new" if phone_change else "+7-old", T0, dt.datetime(2024, 3, 2) if phone_change else None),
        ("C2", "Petrov", "Petr", None, dt.date(1980, 1, 1), "2222", dt.date(2024, 2, 15), "+7-2", T0, None),
    ], schemas.CLIENTS)
    accounts = spark.createDataFrame([("A1", dt.date(2030, 1, 1), "C1", T0, None),
                                      ("A2", dt.date(2024, 2, 20), "C2", T0, None)], schemas.ACCOUNTS)
    cards = spark.createDataFrame([("0000 1111", "A1", T0, None), ("0000 2222", "A2", T0, None)], schemas.CARDS)
    return clients, accounts, cards


def _drop(folder, day, txns, blacklist):
    with open(os.path.join(folder, daily_file_name("terminals", day)), "w") as f:
        f.write("terminal_id,terminal_type,terminal_city,terminal_address\nT1,POS,Almaty,a1\nT2,ATM,Astana,a2\n")
    with open(os.path.join(folder, daily_file_name("transactions", day)), "w") as f:
        f.write("trans_id;trans_dt;amt;card_num;oper_type;oper_result;terminal\n")
        for t in txns:
            f.write(";".join(t) + "\n")
    with open(os.path.join(folder, daily_file_name("passport_blacklist", day)), "w") as f:
        f.write("date;passport_num;entry_dt\n")
        for b in blacklist:
            f.write(";".join(b) + "\n")


def test_two_days_and_rerun(spark, scratch):
    drop, wh = os.path.join(scratch, "drop"), os.path.join(scratch, "dwh")
    os.makedirs(drop)
    _drop(drop, D1, [("t1", "2024-03-01 10:00:00", "10.00", "0000 1111", "PAY", "OK", "T1"),
                     ("t2", "2024-03-01 23:30:00", "10.00", "0000 1111", "PAY", "OK", "T1")], [])
    _drop(drop, D2, [("t3", "2024-03-02 00:10:00", "5.00", "0000 1111", "PAY", "OK", "T2"),
                     ("t4", "2024-03-02 05:00:00", "5.00", "0000 1111", "PAY", "OK", "T2"),
                     ("t5", "2024-03-02 12:00:00", "7.00", "0000 2222", "PAY", "OK", "T1")],
          [("2024-03-02", "1111 111111", "2024-03-02 01:00:00")])
    daily_fraud_run(spark, *_sources(spark, D1), drop, wh, D1)
    daily_fraud_run(spark, *_sources(spark, D2), drop, wh, D2)

    def report():
        rep = spark.read.parquet(os.path.join(wh, "rep_fraud"))
        return sorted((r["report_date"], r["event_dt"], r["passport"], r["phone"], r["event_type"], r["fio"])
                      for r in rep.collect())

    first = report()
    assert first == [
        (D2, dt.datetime(2024, 3, 2, 0, 10), "1111 111111", "+7-new", 3, "Ivanov Ivan Ivanovich"),
        (D2, dt.datetime(2024, 3, 2, 5, 0), "1111 111111", "+7-new", 1, "Ivanov Ivan Ivanovich"),
        (D2, dt.datetime(2024, 3, 2, 12, 0), "2222", "+7-2", 1, None),
        (D2, dt.datetime(2024, 3, 2, 12, 0), "2222", "+7-2", 2, None),
    ]
    clients = spark.read.parquet(os.path.join(wh, "dim_clients"))
    assert clients.where("client_id = 'C1'").count() == 2          # phone change made a version
    assert spark.read.parquet(os.path.join(wh, "fact_transactions")).count() == 5
    # card numbers are stored without spaces
    assert spark.read.parquet(os.path.join(wh, "fact_transactions")).where(F.col("card_num") == "00001111").count() == 4

    daily_fraud_run(spark, *_sources(spark, D2), drop, wh, D2)        # rerun the day
    assert report() == first
    assert spark.read.parquet(os.path.join(wh, "fact_transactions")).count() == 5
    assert spark.read.parquet(os.path.join(wh, "dim_clients")).count() == 3


def test_ingest_transactions_once_per_file(spark, scratch):
    from dimledger.plans.bank import ingest_transactions
    drop, wh, ck = (os.path.join(scratch, n) for n in ("drop2", "dwh2", "ck2"))
    os.makedirs(drop)
    _drop(drop, D1, [("t1", "2024-03-01 10:00:00", "10.00", "0000 1111", "PAY", "OK", "T1")], [])
    _drop(drop, D2, [("t2", "2024-03-02 10:00:00", "10.00", "0000 1111", "PAY", "OK", "T1"),
                     ("t3", "2024-03-02 11:00:00", "10.00", "0000 2222", "PAY", "OK", "T2")], [])
    ingest_transactions(spark, drop, wh, ck)
    ingest_transactions(spark, drop, wh, ck)          # nothing new: nothing loaded twice
    facts = spark.read.parquet(os.path.join(wh, "fact_transactions"))
    assert sorted((r["trans_id"], r["load_date"]) for r in facts.collect()) == [
        ("t1", D1), ("t2", D2), ("t3", D2)]


def test_streamed_files_keep_bad_lines_apart_and_check_headers(spark, scratch):
    import pytest

    from dimledger.plans.bank import ingest_transactions
    drop, wh, ck = (os.path.join(scratch, n) for n in ("drop3", "dwh3", "ck3"))
    os.makedirs(drop)
    _drop(drop, D1, [("t1", "2024-03-01 10:00:00", "10.00", "0000 1111", "PAY", "OK", "T1"),
                     ("t2", "no time", "x", "0000 1111", "PAY", "OK", "T1")], [])
    ingest_transactions(spark, drop, wh, ck)
    assert [r.trans_id for r in spark.read.parquet(os.path.join(wh, "fact_transactions")).collect()] == ["t1"]
    rejects = spark.read.parquet(os.path.join(wh, "rejects", "transactions")).collect()
    assert [(r.load_date, r.line.split(";")[0]) for r in rejects] == [(D1, "t2")]
    with open(os.path.join(drop, daily_file_name("transactions", D2)), "w") as f:
        f.write("trans_id;trans_dt;oper_type;amt;card_num;oper_result;terminal\n"
                "t3;2024-03-02 10:00:00;PAY;5.00;0000 1111;OK;T1\n")
    with pytest.raises(Exception):
        ingest_transactions(spark, drop, wh, ck)
    assert spark.read.parquet(os.path.join(wh, "fact_transactions")).count() == 1

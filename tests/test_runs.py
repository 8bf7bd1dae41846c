"""Runs over several tables: all or nothing, late corrections, routed files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dimledger.functions.columns import ts_lit
from dimledger.plans import bank
from dimledger.plans.fraud import REPORT_COLUMNS, card_owners, events_in_force, fraud_report
from dimledger.sources.runs import ConcurrentRun, Run, collect_leftovers, commits, read_table
from test_bank_run import D1, D2, _drop, _sources
from rows import rows

D3 = dt.date(2024, 3, 3)


def numbers(spark, *values, day="a"):
    return spark.createDataFrame([(v, day) for v in values], "v int, day string")


def small_run(run, spark, base):
    run.table("one").replace(numbers(spark, base), "day", "a")
    run.table("two").replace_all_of(numbers(spark, base, base + 1).unionByName(numbers(spark, base, day="b")),
                                    "day", ["a", "b", "c"])
    run.table("three").rewrite(numbers(spark, base))
    old = run.table("one").read()
    run.table("one").replace(old.unionByName(numbers(spark, base + 5)), "day", "a")     # replaced from itself


def state(spark, root, number=None):
    return {n: rows(read_table(spark, root, n, number)) for n in ("one", "two", "three")}


def test_a_run_that_fails_at_any_write_leaves_every_table_as_it_was(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "wh")
    assert read_table(spark, root, "one") is None
    with Run(spark, root) as run:
        small_run(run, spark, 10)
        assert run.table("two").read().count() == 3 and commits(spark, root) == []
    first = state(spark, root)
    assert first == {"one": [(10, "a"), (15, "a")], "two": [(10, "a"), (10, "b"), (11, "a")], "three": [(10, "a")]}

    for step in range(1, 6):
        left = [step]
        plain = Run.next_directory

        def failing(self):
            left[0] -= 1
            if left[0] == 0:
                raise OSError("lost")
            return plain(self)

        monkeypatch.setattr(Run, "next_directory", failing)
        if step <= 4:
            with pytest.raises(OSError, match="lost"), Run(spark, root) as run:
                small_run(run, spark, 20)
            monkeypatch.setattr(Run, "next_directory", plain)
            assert state(spark, root) == first and len(commits(spark, root)) == 1
        else:                                   # all writes done, the record itself is cut short
            run = Run(spark, root)
            small_run(run, spark, 20)
            monkeypatch.setattr(Run, "next_directory", plain)
            with open(os.path.join(root, "_commits", "0000000002.json"), "w") as f:
                f.write('{"number": 2, "tab')
            assert state(spark, root) == first
            assert run.commit() == 3
    second = state(spark, root)
    assert second["one"] == [(20, "a"), (25, "a")] and state(spark, root, 1) == first


def test_of_two_runs_from_one_record_the_second_fails(spark, scratch):
    root = os.path.join(scratch, "wh")
    a, b = Run(spark, root), Run(spark, root)
    small_run(a, spark, 1)
    small_run(b, spark, 2)
    a.commit()
    with pytest.raises(ConcurrentRun):
        b.commit()
    assert state(spark, root)["three"] == [(1, "a")]


def test_leftovers_are_removed_and_named_directories_kept(spark, scratch):
    root = os.path.join(scratch, "wh")
    for base in (1, 2, 3):
        with Run(spark, root) as run:
            small_run(run, spark, base)
            run.table("deep/er").replace(numbers(spark, base), "day", "a")
    before = state(spark, root), state(spark, root, 2)
    assert collect_leftovers(spark, root) == []                       # too young
    gone = collect_leftovers(spark, root, keep=2, older_than_hours=-1.0)
    # run 1 whole (5), and of runs 2 and 3 the first write of table one
    assert len(gone) == 7 and sum("/deep/er/" in p for p in gone) == 1
    assert (state(spark, root), state(spark, root, 2)) == before
    with pytest.raises(ValueError):
        collect_leftovers(spark, root, keep=0)


def test_late_rows_correct_the_report_and_every_step_reads_the_old_state(spark, scratch, monkeypatch):
    drop, wh = os.path.join(scratch, "drop"), os.path.join(scratch, "dwh")
    os.makedirs(drop)
    op = lambda i, t, card="0000 1111", term="T1": (i, t, "10.00", card, "PAY", "OK", term)
    _drop(drop, D1, [op("t1", "2024-03-01 10:00:00"), op("t2", "2024-03-01 23:30:00"),
                     op("t5", "2024-03-01 12:00:00", "0000 2222")], [])
    # The blacklist row is of the evening before the first operation, and the second
    # client's new passport is older than the operation already reported.
    _drop(drop, D2, [op("t3", "2024-03-02 00:10:00", term="T2")], [("2024-03-02", "1111 111111", "2024-03-01 11:00:00")])
    _drop(drop, D3, [op("t6", "2024-03-03 00:10:00")], [])

    def sources(day):
        clients, accounts, cards = _sources(spark, D1)
        if day >= D2:
            late = F.col("client_id") == "C2"
            clients = (clients.withColumn("passport_num", F.when(late, F.lit("3333")).otherwise(F.col("passport_num")))
                       .withColumn("passport_valid_to", F.when(late, F.lit(dt.date(2031, 1, 1)))
                                   .otherwise(F.col("passport_valid_to")))
                       .withColumn("update_dt", F.when(late, ts_lit("2024-02-20")).otherwise(F.col("update_dt"))))
        return clients, accounts, cards

    def in_force():
        return rows(events_in_force(read_table(spark, wh, "rep_fraud"), read_table(spark, wh, "rep_fraud_retracted")))

    def from_scratch():
        owners = card_owners(*[bank.read_history(spark, read_as_table(f"dim_{n}"), bank.HISTORY[n])
                               for n in ("clients", "accounts", "cards")], versions="pit")
        cities = bank.read_history(spark, read_as_table("dim_terminals"), bank.HISTORY["terminals"])
        return rows(fraud_report(read_table(spark, wh, "fact_transactions"), owners,
                                 read_table(spark, wh, "fact_passport_blacklist"), cities,
                                 ts_lit(D1)).select(*REPORT_COLUMNS))

    def read_as_table(name):
        return Run(spark, wh).table(name)

    assert bank.atomic_fraud_run(spark, *sources(D1), drop, wh, D1) == 1
    day1 = in_force()
    assert [(r[1], r[4]) for r in day1] == [("2222", 1), ("2222", 2)] and day1 == from_scratch()

    # A run that fails when all tables are written: after each write the record is
    # the old one and the directories it names are untouched.
    record = commits(spark, wh)

    def listing():
        return {(n, p, d): sorted(os.listdir(os.path.join(wh, n, f"run={d}", p)))
                for n, parts in record[0]["tables"].items() for p, d in parts.items()}

    files, steps, plain = listing(), [], Run.next_directory

    def watched(self):
        assert commits(spark, wh) == record and listing() == files
        steps.append(1)
        return plain(self)

    def lost(self):
        raise OSError("lost")

    monkeypatch.setattr(Run, "next_directory", watched)
    commit = Run.commit
    monkeypatch.setattr(Run, "commit", lost)
    with pytest.raises(OSError, match="lost"):
        bank.atomic_fraud_run(spark, *sources(D2), drop, wh, D2)
    monkeypatch.setattr(Run, "next_directory", plain)
    monkeypatch.setattr(Run, "commit", commit)
    assert len(steps) == 18 and in_force() == day1

    assert bank.atomic_fraud_run(spark, *sources(D2), drop, wh, D2) == 2
    want = [(dt.datetime(2024, 3, 1, 12), "3333", None, "+7-2", 2),
            (dt.datetime(2024, 3, 1, 23, 30), "1111 111111", "Ivanov Ivan Ivanovich", "+7-old", 1),
            (dt.datetime(2024, 3, 2, 0, 10), "1111 111111", "Ivanov Ivan Ivanovich", "+7-old", 1),
            (dt.datetime(2024, 3, 2, 0, 10), "1111 111111", "Ivanov Ivan Ivanovich", "+7-old", 3)]
    assert in_force() == want == from_scratch()
    gone = read_table(spark, wh, "rep_fraud_retracted").where(F.col("report_date") == F.lit(D2))
    assert [(r.passport, r.event_type) for r in gone.orderBy("event_type").collect()] == [("2222", 1), ("2222", 2)]
    bank.atomic_fraud_run(spark, *sources(D2), drop, wh, D2)                  # the day again
    assert in_force() == want


def test_three_kinds_of_files_by_one_stream(spark, scratch):
    drop, wh, ck, done = (os.path.join(scratch, n) for n in ("drop", "wh", "ck", "done"))
    os.makedirs(drop)
    _drop(drop, D1, [("t1", "2024-03-01 10:00:00", "10.00", "0000 1111", "PAY", "OK", "T1"),
                     ("t2", "no time", "x", "0000 1111", "PAY", "OK", "T1")],
          [("2024-03-01", "1111 111111", "2024-03-01 01:00:00")])
    _drop(drop, D3, [("t3", "2024-03-03 10:00:00", "10.00", "0000 1111", "PAY", "OK", "T1")], [])
    with open(os.path.join(drop, "notes_2024.csv"), "w") as f:
        f.write("x\n")
    with open(os.path.join(drop, "transactions_99999999.csv"), "w") as f:
        f.write("x\n")

    def tables():
        return {n: rows(read_table(spark, wh, n)) for n in commits(spark, wh, 1)[-1]["tables"]
                if not n.endswith("_index")}

    bank.ingest_drop_files(spark, drop, wh, ck, archive_dir=done)
    got = tables()
    assert [(r[0], r[-1]) for r in got["fact_transactions"]] == [("t1", D1), ("t3", D3)]
    assert [r[0] for r in got["fact_passport_blacklist"]] == ["1111111111"]
    assert [r[0] for r in got["dim_terminals"]] == ["T1", "T2"]
    assert [r[0].split(";")[0] for r in got["rejects/transactions"]] == ["t2"]
    assert [r[0] for r in got["rejects/names"]] == ["notes_2024.csv", "transactions_99999999.csv"]
    record = commits(spark, wh)
    bank.ingest_drop_files(spark, drop, wh, ck, archive_dir=done)               # nothing new
    assert commits(spark, wh) == record

    # One wrong header: no table of the batch changes, the files wait.
    _drop(drop, D2, [("t4", "2024-03-02 10:00:00", "10.00", "0000 1111", "PAY", "OK", "T1")], [])
    right = open(os.path.join(drop, "transactions_02032024.csv")).read()
    with open(os.path.join(drop, "transactions_02032024.csv"), "w") as f:
        f.write(right.replace("trans_dt;amt;card_num", "trans_dt;card_num;amt"))
    with pytest.raises(Exception):
        bank.ingest_drop_files(spark, drop, wh, ck, archive_dir=done)
    assert commits(spark, wh) == record and tables() == got
    with open(os.path.join(drop, "transactions_02032024.csv"), "w") as f:
        f.write(right)
    bank.ingest_drop_files(spark, drop, wh, ck, archive_dir=done)
    after = tables()
    assert [(r[0], r[-1]) for r in after["fact_transactions"]] == [("t1", D1), ("t3", D3), ("t4", D2)]
    assert after["dim_terminals"] == got["dim_terminals"]                      # an older snapshot is not merged
    assert [r[0] for r in after["rejects/late_terminals"]] == ["T1", "T2"]

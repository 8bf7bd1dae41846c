import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rows import rows
from dimledger.functions.columns import ts_lit
from dimledger.plans.bank import load_dimension, load_facts, read_current, read_history
from dimledger.sources import schemas
from dimledger.sources.readers import daily_csv_rejects, daily_file_name, read_daily_csv
from dimledger.session import checkpoint_dir
from dimledger.sources.sinks import (current_version, publish, replace_partition, replace_window,
                                     write_partition)
from dimledger.sources.schemas import conform
from dimledger.streaming import ingest_files
from dimledger.streaming.ingest import batch_partition_writer


def test_write_partition_rerun_keeps_one_copy(spark, scratch):
    path = os.path.join(scratch, "t")
    day1 = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, d date")
    write_partition(day1, path, ["d"])
    rerun = spark.createDataFrame([(3, dt.date(2024, 1, 2))], "v int, d date")
    write_partition(rerun, path, ["d"])
    write_partition(rerun, path, ["d"])
    assert rows(spark.read.parquet(path).select("v")) == [(1,), (3,)]


def test_replace_window(spark):
    t = spark.createDataFrame([(1, "d1"), (2, "d2")], "v int, d string")
    n = spark.createDataFrame([(3, "d2")], "v int, d string")
    assert rows(replace_window(t, n, "d", ["d2"])) == [(1, "d1"), (3, "d2")]


def test_publish_pointer(spark, scratch):
    root = os.path.join(scratch, "dim")
    assert current_version(spark, root) is None
    publish(spark, root, "/x/v1")
    publish(spark, root, "/x/v2")
    assert current_version(spark, root) == "/x/v2"


def test_conform_orders_casts_and_rejects_missing(spark):
    df = spark.createDataFrame([("a", 1)], "passport string, event_type long")
    try:
        conform(df, schemas.REPORT)
        raise AssertionError("missing columns must fail")
    except ValueError:
        pass
    out = conform(df, schemas.REPORT, strict=False)
    assert out.columns == [f.name for f in schemas.REPORT.fields]
    assert dict(out.dtypes)["event_type"] == "int"


def test_daily_csv_and_dimension_load(spark, scratch):
    src = os.path.join(scratch, "drop")
    os.makedirs(src)
    day = dt.date(2024, 3, 5)
    with open(os.path.join(src, daily_file_name("terminals", day)), "w") as f:
        f.write("terminal_id;terminal_type;terminal_city;terminal_address\nT1;POS;Almaty;a\nT2;ATM;Astana;b\n")
    snap = read_daily_csv(spark, src, "terminals", day, schemas.TERMINALS_FILE)
    hist_schema = schemas.with_history_columns(schemas.TERMINALS_FILE)
    root = os.path.join(scratch, "dim_terminals")
    args = dict(key=["terminal_id"], tracked=["terminal_type", "terminal_city", "terminal_address"],
                attrs=["terminal_type", "terminal_city", "terminal_address"], history_schema=hist_schema)
    load_dimension(spark, root, snap, run_ts=ts_lit(day), run_date=day, **args)
    moved = snap.withColumn("terminal_city", F.when(F.col("terminal_id") == "T1", "Shymkent")
                            .otherwise(F.col("terminal_city")))
    nxt = day + dt.timedelta(days=1)
    load_dimension(spark, root, moved, run_ts=ts_lit(nxt), run_date=nxt, **args)
    load_dimension(spark, root, moved, run_ts=ts_lit(nxt), run_date=nxt, **args)  # rerun
    hist = read_history(spark, root, hist_schema)
    assert hist.count() == 3
    assert hist.where("terminal_id = 'T1' AND deleted_flg = 0").count() == 2
    assert read_history(spark, root, hist_schema, open_only=True).count() == 2
    parts = sorted(r[0] for r in spark.read.parquet(root).select("closed_on").distinct().collect())
    assert parts == ["2024-03-06", "open"]


def test_fact_load_is_rerun_safe(spark, scratch):
    t = dt.datetime(2024, 3, 5, 10)
    staged = spark.createDataFrame([("1", t), ("2", t + dt.timedelta(hours=1))], "trans_id string, trans_dt timestamp_ntz")
    facts, meta = os.path.join(scratch, "facts"), os.path.join(scratch, "meta")
    load_facts(spark, facts, meta, staged, ["trans_dt"], dt.date(2024, 3, 5))
    load_facts(spark, facts, meta, staged, ["trans_dt"], dt.date(2024, 3, 5))
    assert spark.read.parquet(facts).count() == 2
    assert rows(read_current(spark, meta)) == [(t + dt.timedelta(hours=1), dt.date(2024, 3, 5))]


T = "trans_id string, trans_dt timestamp_ntz"


def test_redelivered_late_and_empty_days_are_complete(spark, scratch):
    facts, meta = os.path.join(scratch, "facts"), os.path.join(scratch, "meta")
    d1, d2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)

    def at(day, hour):
        return dt.datetime(day.year, day.month, day.day, hour)

    def load(day, data):
        load_facts(spark, facts, meta, spark.createDataFrame(data, T), ["trans_dt"], day)
        return sorted(r.trans_id for r in spark.read.parquet(facts).collect())

    assert load(d2, [("c", at(d2, 9))]) == ["c"]
    # a file of an older day arrives after a newer one
    assert load(d1, [("a", at(d1, 9)), ("b", at(d1, 10))]) == ["a", "b", "c"]
    # the day is delivered again with one more row, then with none
    assert load(d2, [("b", at(d1, 10)), ("c", at(d2, 9)), ("d", at(d2, 8))]) == ["a", "b", "c", "d"]
    assert load(d2, []) == ["a", "b"]
    assert load(d2, [("c", at(d2, 9))]) == ["a", "b", "c"]


def test_two_runs_of_a_day_keep_what_each_closed(spark, scratch):
    hist_schema = schemas.with_history_columns(schemas.TERMINALS_FILE)
    root = os.path.join(scratch, "dim")
    names = schemas.TERMINALS_FILE.fieldNames()
    attrs = names[1:]
    day, nxt = dt.date(2024, 3, 5), dt.date(2024, 3, 6)

    def load(cities, when):
        snap = spark.createDataFrame([tuple([k, *[city] * len(attrs)]) for k, city in cities.items()], schemas.TERMINALS_FILE)
        load_dimension(spark, root, snap, key=[names[0]], tracked=attrs, attrs=attrs, run_ts=ts_lit(when),
                       run_date=when, history_schema=hist_schema)

    load({"x": "1", "y": "1"}, day)
    load({"x": "2", "y": "1"}, nxt)
    load({"x": "2", "y": "2"}, nxt)
    load({"x": "2", "y": "2"}, nxt)
    got = sorted((r[names[0]], r[attrs[0]]) for r in read_history(spark, root, hist_schema).collect())
    assert got == [("x", "1"), ("x", "2"), ("y", "1"), ("y", "2")]
    assert not os.listdir(os.path.join(checkpoint_dir(spark), "dimledger-stage"))


def test_storage_errors_are_not_a_first_run(spark, scratch):
    bad = os.path.join(scratch, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("this is no parquet file")
    with pytest.raises(Exception):
        read_history(spark, bad, schemas.TERMINALS_FILE)
    assert read_history(spark, os.path.join(scratch, "none"), schemas.TERMINALS_FILE).count() == 0


def test_replace_partition_with_nothing(spark, scratch):
    path = os.path.join(scratch, "t")
    df = spark.createDataFrame([(1, "a")], "x int, d string")
    replace_partition(df, path, "d", "2024-01-01")
    replace_partition(df, path, "d", "2024-01-02")
    replace_partition(df.limit(0), path, "d", "2024-01-01")
    assert [str(r.d) for r in spark.read.parquet(path).collect()] == ["2024-01-02"]


def test_ingest_files_once(spark, scratch):
    src, arch = os.path.join(scratch, "in"), os.path.join(scratch, "archive")
    ck, out = os.path.join(scratch, "ck"), os.path.join(scratch, "out")
    os.makedirs(src)

    def drop(day, n):
        with open(os.path.join(src, daily_file_name("passport_blacklist", day)), "w") as f:
            f.write("date;passport_num;entry_dt\n")
            for i in range(n):
                f.write(f"{day.isoformat()};P{i} {day.day};{day.isoformat()} 10:00:00\n")

    writer = batch_partition_writer(out)

    def batch(df, batch_id):
        writer(df.drop("source_file"), batch_id)
        if batch_id == 0:
            writer(df.drop("source_file"), batch_id)   # a replayed batch leaves one copy

    drop(dt.date(2024, 3, 1), 2)
    drop(dt.date(2024, 3, 2), 1)
    ingest_files(spark, src, schemas.BLACKLIST_FILE, ck, batch, archive_dir=arch, max_files_per_trigger=1)
    assert spark.read.parquet(out).count() == 3
    drop(dt.date(2024, 3, 3), 4)
    ingest_files(spark, src, schemas.BLACKLIST_FILE, ck, batch, archive_dir=arch, max_files_per_trigger=1)
    assert spark.read.parquet(out).count() == 7


def test_write_report_replaces_its_day(spark, scratch):
    from dimledger.plans.fraud import write_report
    path = os.path.join(scratch, "rep")
    t = dt.datetime(2024, 3, 1, 12)
    rep = spark.createDataFrame([(t, "p", "f", "ph", 1, dt.datetime(2024, 3, 2, 8))],
                                "event_dt timestamp_ntz, passport string, fio string, phone string, "
                                "event_type int, report_dt timestamp_ntz")
    write_report(rep, path)
    write_report(rep, path)
    assert spark.read.parquet(path).count() == 1


def test_read_typed_csv_by_position(spark, scratch):
    from pyspark.sql import types as T
    from dimledger.sources.readers import read_typed_csv
    p = os.path.join(scratch, "res.csv")
    with open(p, "w") as f:
        f.write("items_id,stock,price,store,city\nA,1.5,10,S1,C1\n")
    schema = T.StructType([T.StructField("items_id", T.StringType()), T.StructField("quant", T.DoubleType()),
                           T.StructField("price", T.DoubleType()), T.StructField("shop_name", T.StringType()),
                           T.StructField("city", T.StringType())])
    assert rows(read_typed_csv(spark, p, schema)) == [("A", 1.5, 10.0, "S1", "C1")]


def test_read_docs(spark, scratch):
    from pyspark.sql import types as T
    from dimledger.sources.readers import read_docs
    p = os.path.join(scratch, "docs.json")
    with open(p, "w") as f:
        f.write('{"_id": "s1", "title": "A", "created": "2023-01-01T00:00:00", "extra": 1}\n')
    schema = T.StructType([T.StructField("_id", T.StringType()), T.StructField("title", T.StringType()),
                           T.StructField("created", T.TimestampNTZType())])
    assert rows(read_docs(spark, p, schema)) == [("s1", "A", dt.datetime(2023, 1, 1))]


def test_bad_lines_are_kept_apart_and_headers_checked(spark, scratch):
    day = dt.date(2024, 3, 5)
    path = os.path.join(scratch, daily_file_name("passport_blacklist", day))
    with open(path, "w") as f:
        f.write("date;passport_num;entry_dt\n2024-03-05;P1;2024-03-05 10:00:00\nno date at all;P2;x\n")
    good = read_daily_csv(spark, scratch, "passport_blacklist", day, schemas.BLACKLIST_FILE)
    assert [r.passport_num for r in good.collect()] == ["P1"] and good.count() == 1
    assert good.select("passport_num").count() == 1
    bad = daily_csv_rejects(spark, scratch, "passport_blacklist", day, schemas.BLACKLIST_FILE)
    assert [r.line for r in bad.collect()] == ["no date at all;P2;x"]
    with open(path, "w") as f:
        f.write("date;entry_dt;passport_num\n2024-03-05;2024-03-05 10:00:00;P1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_daily_csv(spark, scratch, "passport_blacklist", day, schemas.BLACKLIST_FILE).collect()

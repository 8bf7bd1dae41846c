"""Property tests for the SCD2 merge and the hot-key split."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rows import rows
from dimledger.functions.columns import SENTINEL_TS, ts_lit
from dimledger.operators.scan import with_previous
from dimledger.operators.scd2 import scd2_merge

KEYS = ["k0", "k1", "k2", "k3"]
VALUES = st.sampled_from(["a", "b", None])
SNAPSHOT = st.dictionaries(st.sampled_from(KEYS), VALUES, max_size=len(KEYS))
SNAP_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])
HIST_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType()),
                            T.StructField("effective_from", T.TimestampNTZType()),
                            T.StructField("effective_to", T.TimestampNTZType()),
                            T.StructField("deleted_flg", T.IntegerType())])
DAY0 = dt.datetime(2024, 1, 1)


def _merge(spark, hist, snap, run):
    df = spark.createDataFrame(sorted(snap.items()), SNAP_SCHEMA)
    return scd2_merge(hist, df, key=["id"], tracked=["v"], attrs=["v"], run_ts=ts_lit(run))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(snapshots=st.lists(SNAPSHOT, min_size=1, max_size=4))
def test_history_rebuilds_every_loaded_snapshot(spark, snapshots):
    hist = spark.createDataFrame([], HIST_SCHEMA)
    runs = [DAY0 + dt.timedelta(days=i) for i in range(len(snapshots))]
    for snap, run in zip(snapshots, runs):
        hist = spark.createDataFrame(rows(_merge(spark, hist, snap, run)), HIST_SCHEMA)
    h = rows(hist)
    by_key = {}
    for r in h:
        by_key.setdefault(r[0], []).append(r)
    for versions in by_key.values():
        assert sum(v[3] == SENTINEL_TS for v in versions) <= 1
        versions.sort(key=lambda v: v[2])
        for a, b in zip(versions, versions[1:]):
            assert a[3] < b[2]                       # no overlap, in order
    for snap, run in zip(snapshots, runs):
        seen = {r[0]: r[1] for r in h if r[2] <= run <= r[3] and r[4] == 0}
        assert seen == snap
    again = rows(_merge(spark, hist, snapshots[-1], runs[-1] + dt.timedelta(days=1)))
    assert again == h


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=st.lists(st.tuples(st.sampled_from(["c1", "c2"]), st.integers(0, 72 * 60)), min_size=1,
                       max_size=60, unique=True),
       hot=st.integers(1, 10))
def test_hot_key_split_equals_plain_window(spark, events, hot):
    data = [(c, DAY0 + dt.timedelta(minutes=m), i) for i, (c, m) in enumerate(events)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id int")
    plain = with_previous(df, ["k"], ["ts", "id"], ["ts", "id"], bucket=None)
    split = with_previous(df, ["k"], ["ts", "id"], ["ts", "id"], bucket="hour", hot_rows=hot)
    assert rows(plain.select("k", "id", F.col("prev.id"))) == rows(split.select("k", "id", F.col("prev.id")))

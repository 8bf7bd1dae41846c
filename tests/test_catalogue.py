"""Every registered query against its DuckDB SQL, and plan checks."""

import contextlib
import datetime as dt
import decimal
import io
import math

import duckdb
import pytest

from rows import SF_SMALL
from __spark_entry__ import entry
from dimledger.catalogue import ORACLE, QUERIES


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE


TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    missing = set(queries()) - set(oracle_sql())
    assert not missing, missing


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got = sorted([tuple(_norm(v) for v in r) for r in df.collect()], key=_key)
    rel = duck.sql(oracle_sql()[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    cur = duck.execute(oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = sorted([tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()], key=_key)
    assert got == want


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_nested_loop_or_cartesian(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_filters_reach_the_scan(spark):
    plan = _plan(queries()["snapshot_as_of"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), EqualTo(o_orderdate,ScalarSubquery" in plan
    plan = _plan(queries()["watermark_delta"](spark, SF_SMALL))
    assert "GreaterThan(o_orderdate,ScalarSubquery" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(queries()["rule_expired_contract"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() >= 0


def _exchanges(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return [line.strip() for line in buf.getvalue().splitlines() if "Exchange hashpartitioning" in line]


def test_velocity_shuffles_facts_once_by_card(spark):
    # the window shuffles the facts by card; of them only the rows that pass the
    # time test go on to the owner join, whose sides are planned by their bytes
    ex = _exchanges(queries()["velocity_rule"](spark, SF_SMALL))
    assert all("hashpartitioning(card_num" in e for e in ex) and len(ex) <= 3, ex


def test_promo_state_shuffles_by_coupon_once(spark):
    # the per-user latest attempt, then one join of both sides by coupon
    ex = _exchanges(queries()["promo_state"](spark, SF_SMALL))
    assert len(ex) <= 3 and sum("user_id" not in e for e in ex) <= 2, ex


def test_daily_stock_shuffles_only_for_the_aggregate(spark):
    ex = _exchanges(queries()["daily_stock"](spark, SF_SMALL))
    assert len(ex) == 1 and "items_id" in ex[0], ex

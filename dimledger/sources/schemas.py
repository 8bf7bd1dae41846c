"""Declared schemas of the reference's tables, and ``conform``.

No schema is inferred anywhere: files are read with these StructTypes and
outputs are cast to them by name and order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["conform", "HIST_COLUMNS", "CLIENTS", "ACCOUNTS", "CARDS", "TRANSACTIONS_FILE",
           "TERMINALS_FILE", "BLACKLIST_FILE", "REPORT", "PROMO_STATS", "SPEC_STATS",
           "WATERMARK", "with_history_columns"]

S, D, TS, I, L, DB, B = (T.StringType(), T.DateType(), T.TimestampNTZType(), T.IntegerType(),
                         T.LongType(), T.DoubleType(), T.BooleanType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


HIST_COLUMNS = [("effective_from", TS), ("effective_to", TS), ("deleted_flg", I)]

CLIENTS = _struct(("client_id", S), ("last_name", S), ("first_name", S), ("patronymic", S),
                  ("date_of_birth", D), ("passport_num", S), ("passport_valid_to", D),
                  ("phone", S), ("create_dt", TS), ("update_dt", TS))
ACCOUNTS = _struct(("account_num", S), ("valid_to", D), ("client", S), ("create_dt", TS),
                   ("update_dt", TS))
CARDS = _struct(("card_num", S), ("account_num", S), ("create_dt", TS), ("update_dt", TS))
TRANSACTIONS_FILE = _struct(("trans_id", S), ("trans_dt", TS), ("amt", T.DecimalType(18, 2)),
                            ("card_num", S), ("oper_type", S), ("oper_result", S), ("terminal", S))
TERMINALS_FILE = _struct(("terminal_id", S), ("terminal_type", S), ("terminal_city", S),
                         ("terminal_address", S))
BLACKLIST_FILE = _struct(("date", D), ("passport_num", S), ("entry_dt", TS))
WATERMARK = _struct(("max_update_dt", TS))
REPORT = _struct(("event_dt", TS), ("passport", S), ("fio", S), ("phone", S), ("event_type", I),
                 ("report_dt", TS))
PROMO_STATS = _struct(("promocode_id", S), ("code", S), ("specification_id", S), ("status", S),
                      ("updated_date", D), ("end_date", D), ("start_date", D))
SPEC_STATS = _struct(("specification_id", S), ("specification_title", S),
                     ("unique_promo_cnt", L), ("user_limit", L))


def with_history_columns(schema: T.StructType, drop=("create_dt", "update_dt")) -> T.StructType:
    """The SCD2 table for a source schema: its fields plus the version columns."""
    kept = [f for f in schema.fields if f.name not in drop]
    return T.StructType(kept + [T.StructField(n, t, True) for n, t in HIST_COLUMNS])


def conform(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Select the schema's columns in its order, cast to its types.

    A column missing from ``df`` is an error (``strict``) or a typed NULL.
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing and strict:
        raise ValueError(f"columns missing for conform: {missing}")
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])

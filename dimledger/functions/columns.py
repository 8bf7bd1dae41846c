"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "SENTINEL", "SENTINEL_TS", "ZERO_ID_B64", "TRUE_FLAG_B64", "UNASSIGNED_LABEL",
    "ts_lit", "strip_spaces", "full_name", "default_label", "flag_set", "flag_unset",
    "normalise_code", "int_code", "whole_number", "day_bounds", "in_window", "lenient_timestamp", "exact_sum",
]

# Fixed values that must equal the reference's for the same results:
# the open end of a version, the all-zero 16-byte id and the one-byte "true"
# flag as base64 text, and the label given to items without a category.
SENTINEL = "5999-12-31 00:00:00"
ZERO_ID_B64 = "AAAAAAAAAAAAAAAAAAAAAA=="
TRUE_FLAG_B64 = "AQ=="
UNASSIGNED_LABEL = "Не присвоено"

SENTINEL_TS = _dt.datetime(5999, 12, 31)


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal (test data and DuckDB timestamps are zone-less).

    Built from text, so the wall-clock value does not depend on the session or
    process time zone.
    """
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    elif isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def strip_spaces(c) -> Column:
    """Key cleanup used for card numbers, transaction ids and passports."""
    return F.replace(F.col(c) if isinstance(c, str) else c, F.lit(" "), F.lit(""))


def full_name(*parts) -> Column:
    """``a || ' ' || b || ' ' || c``: null when any part is null (not concat_ws)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    spaced = [cols[0]]
    for c in cols[1:]:
        spaced += [F.lit(" "), c]
    return F.concat(*spaced)


def default_label(c, label: str = UNASSIGNED_LABEL) -> Column:
    """Keep a non-empty text, otherwise (empty or null) the default label."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) > 0, c).otherwise(F.lit(label))


def flag_set(c, encoded: bool = False) -> Column:
    """One-byte flag equals true: ``base64(c) = 'AQ=='`` for a binary column,
    ``c = 'AQ=='`` for one already stored as base64 text (``encoded``)."""
    c = F.col(c) if isinstance(c, str) else c
    return (c if encoded else F.base64(c)) == F.lit(TRUE_FLAG_B64)


def flag_unset(c, encoded: bool = False) -> Column:
    """``!= 'AQ=='`` as SQL writes it: a NULL flag is dropped, not kept."""
    c = F.col(c) if isinstance(c, str) else c
    return (c if encoded else F.base64(c)) != F.lit(TRUE_FLAG_B64)


def normalise_code(c) -> Column:
    """Numeric code in any spelling ('62763', '62763.0', 62763.0) → '62763'.

    Dirty text gives NULL instead of failing the job (ANSI casts raise).
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast("decimal(38,0)").try_cast("string")


def int_code(c) -> Column:
    """``CAST(CAST(x AS INT) AS varchar)`` with rounding, as the warehouse did."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double")).cast("bigint").cast("string")


def whole_number(c) -> Column:
    """``CAST(x AS INT)`` as the warehouse does it: rounded, as a bigint; text
    that is no number gives NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("string").try_cast("double")).cast("bigint")


def day_bounds(day) -> tuple[Column, Column]:
    """Half-open ``[day, day + 1)`` as ``timestamp_ntz`` literals (D-24)."""
    if isinstance(day, str):
        day = _dt.date.fromisoformat(day)
    start = _dt.datetime(day.year, day.month, day.day)
    return ts_lit(start), ts_lit(start + _dt.timedelta(days=1))


def in_window(c, lo: Column, hi: Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c >= lo) & (c < hi)


def lenient_timestamp(c) -> Column:
    """Parse text to ``timestamp_ntz``; garbage gives NULL (pandas errors='coerce')."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast("timestamp_ntz")


def exact_sum(c, scale: int = 12) -> Column:
    """Sum of a money/quantity column that does not depend on row order.

    Double addition is not associative, so partial sums on different executors
    can differ in the last bit from run to run. A value is split into bands:
    its whole part, its millionths, and the rest in units of ``10^-12``. Each
    band is summed as a long (exact, with a map-side combine, and faster than
    a widened decimal); one addition of the three sums as decimals and one
    rounding to double end it. Equal to summing ``decimal(38, scale)``, up to
    9.2e18 in a group, beyond which it raises; ``scale`` is at most 12.
    """
    c = F.col(c) if isinstance(c, str) else c
    whole = F.floor(c).cast("bigint")
    units = F.round((c - whole) * F.lit(10 ** scale)).cast("bigint")
    fine = 10 ** max(scale - 6, 0)                     # units of a millionth
    bands = [(whole, 1), ((units - units % fine) / fine, 10 ** min(scale, 6)), (units % fine, 10 ** scale)]
    # Sums of bands are whole numbers far below 10^22; 12 digits follow the point.
    sums = [F.sum(band.cast("bigint")).cast("decimal(24,0)") / F.lit(Decimal(unit))
            for band, unit in (bands if scale > 6 else bands[:2])]
    return reduce(lambda a, b: a + b, [part.cast("decimal(38,12)") for part in sums]).cast("double")

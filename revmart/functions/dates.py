"""Date and time helpers for ISO review timestamps held as strings.

Dates are cut from the string itself, never through a timestamp, so the
feed-local calendar day survives whatever the session time zone is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_from_iso(col: Column | str) -> Column:
    """Calendar date of ``yyyy-MM-ddTHH:mm:ss±hh:mm``; the offset is ignored. [O-25]

    ``try_cast`` keeps a malformed value NULL instead of failing the job
    (ANSI mode is on by default in Spark 4).
    """
    return _c(col).try_cast("date")


def time_of_day(col: Column | str) -> Column:
    """Characters 12-19 of the ISO string: ``HH:mm:ss``. [O-23]"""
    return _c(col).substr(12, 8)


def year_key(col: Column | str) -> Column:
    return _c(col).substr(1, 4)


def month_key(col: Column | str) -> Column:
    return _c(col).substr(6, 2)


def year_month(col: Column | str) -> Column:
    """``yyyy-MM`` of a date or timestamp column (first 7 characters of its text). [O-22, O-23]"""
    return F.substring(_c(col).cast("string"), 1, 7)


def month_start(df: DataFrame, col: str) -> tuple[Column, bool]:
    """Grouping key for the month of ``col``: the first day of the month for
    date/timestamp columns (integer work, no per-row text formatting), else
    the ``yyyy-MM`` text itself. Returns (key, is_date)."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.trunc(F.col(col).cast("date"), "month"), True
    return year_month(col), False


def month_text(key: Column, is_date: bool) -> Column:
    """``yyyy-MM`` text of a ``month_start`` key (formatted once per group)."""
    return year_month(key) if is_date else key


def _month_bounds(month: str) -> tuple[dt.date, dt.date]:
    year, mon = int(month[:4]), int(month[5:7])
    lo = dt.date(year, mon, 1)
    hi = dt.date(year + (mon == 12), mon % 12 + 1, 1)
    return lo, hi


def is_month(year_col: str, month_col: str, month: str) -> Column:
    """Whether int year/month keys name ``month`` (``yyyy-MM``)."""
    lo, _ = _month_bounds(month)
    return (F.col(year_col) == lo.year) & (F.col(month_col) == lo.month)


def odd_month_keys(year_col: str, month_col: str) -> Column:
    """Whether int year/month keys are NULL or name no month of a four-digit year."""
    y, m = F.col(year_col), F.col(month_col)
    return y.isNull() | m.isNull() | (y < 1000) | (y > 9999) | (m < 1) | (m > 12)


def month_filter(
    df: DataFrame,
    date_col: str,
    month: str,
    partition_cols: tuple[str, str] | None = None,
) -> DataFrame:
    """Rows whose ``date_col`` falls in ``month`` (``yyyy-MM``). [O-28]

    Same rows as ``substr(date_col, 1, 7) = month`` but written as a range
    so the parquet scan can push it down, plus a test of the year/month
    partition columns (when given) so whole directories are pruned. Keys cut
    from an oddly written timestamp can be NULL or no month at all; rows with
    such keys are kept for the date itself to decide.
    """
    lo, hi = _month_bounds(month)
    dtype = df.schema[date_col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        lo_c = F.lit(lo.isoformat()).cast(dtype.simpleString())
        hi_c = F.lit(hi.isoformat()).cast(dtype.simpleString())
    else:
        lo_c, hi_c = F.lit(lo), F.lit(hi)
    cond = (F.col(date_col) >= lo_c) & (F.col(date_col) < hi_c)
    if partition_cols:
        cond = cond & (is_month(*partition_cols, month) | odd_month_keys(*partition_cols))
    return df.where(cond)

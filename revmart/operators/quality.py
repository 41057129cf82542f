"""Quality checks on a zone: distributions, null-column check, previews.

Distributions are small aggregates; previews are top-n (``TakeOrderedAndProject``:
each task keeps n rows, the driver merges n per task), never a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.functions.dates import month_filter, year_month
from revmart.operators.aggregate import count_by


def count_by_year_month(df: DataFrame, year: str = "ano", month: str = "mes") -> DataFrame:
    """Load check: rows per partition year and month. [O-29]"""
    return count_by(df.select(year, month), [year, month])


def count_by_votes(
    df: DataFrame, vote_sum: str = "nu_sum_votes_reviews", vote_count: str = "ds_count_votes_reviews"
) -> DataFrame:
    """Rows per (vote sum, vote count), first key ascending, second descending. [O-31, O-42]"""
    return (
        count_by(df, [vote_sum, vote_count], "total")
        .select("total", vote_sum, vote_count)
        .orderBy(F.asc(vote_sum), F.desc(vote_count))
    )


def count_by_rating(df: DataFrame, rating: str = "nu_rating_review") -> DataFrame:
    """Rows per rating, ratings descending (as text). [O-32, O-43]"""
    return count_by(df, [rating], "total").select("total", rating).orderBy(F.desc(rating))


def count_by_version(df: DataFrame, version: str = "nu_version_app") -> DataFrame:
    """Rows per app version, versions descending (as text: 1.9.0 above 1.10.0). [O-33, O-43]"""
    return count_by(df, [version], "total").select("total", version).orderBy(F.desc(version))


def distinct_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct value combinations of a few columns (the null-column check). [O-38]"""
    return df.select(*columns).distinct()


def sort_multi_key(df: DataFrame, keys: Sequence[str], split_ties: bool = True) -> DataFrame:
    """Global ascending sort (NULLs first) on several keys. [O-39]

    A range shuffle sends every row of one key value to one partition, so a
    key holding a third of all rows would make one huge sort task. With
    ``split_ties`` a hash of the whole row is appended as the last sort key:
    the order on ``keys`` is unchanged (ties have no defined order anyway) but
    the range partitioner can now cut a hot key across partitions. The hash
    follows from the row alone, so a task run again after a lost executor
    sends every row to the same partition.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    if split_ties:
        order.append(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return df.orderBy(*order)


def preview_rows(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the rows are deterministic. [O-13, O-45]"""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def preview_pandas(df: DataFrame, n: int, order_by: Sequence[str] | None = None):
    """A bounded preview on the driver: at most ``n`` rows reach it. [O-13]"""
    return preview_rows(df, n, order_by).toPandas()


def preview_months(
    df: DataFrame,
    months: Sequence[str] = ("2022-06", "2022-07"),
    n: int = 3,
    columns: Sequence[str] = ("ds_title", "ds_reviews"),
    date: str = "dt_date",
    label: str = "ano",
    order_by: Sequence[str] | None = ("nu_id",),
    partition_cols: tuple[str, str] | None = None,
) -> DataFrame:
    """Sample rows per month. [O-20, O-28, O-44, O-46]

    ``n`` rows per month, stacked with UNION ALL, each branch tagged
    with its month as ``yyyyMM`` text. The month test is a date range (and
    partition equality when the zone is partitioned), so it prunes."""
    branches = []
    for month in months:
        rows = month_filter(df, date, month, partition_cols)
        rows = preview_rows(rows, n, order_by)
        branches.append(rows.select(*columns, F.lit(month.replace("-", "")).alias(label)))
    out = branches[0]
    for b in branches[1:]:
        out = out.unionAll(b)
    return out


def month_rows(df: DataFrame, date: str, month: str) -> DataFrame:
    """The literal form of the month test: ``substr(date, 1, 7) = month``. [O-28]"""
    return df.where(year_month(date) == F.lit(month))

"""Aggregates: row counts per key, the monthly mart, distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.functions.dates import month_start, month_text


def count_by(df: DataFrame, keys: Sequence[str | Column], name: str = "count") -> DataFrame:
    """Rows per key. [O-29..O-33]

    Partial counts are combined map-side before the shuffle, so a hot key
    costs one row per map task, not its row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_as_decimal(col: str | Column, precision: int = 18, scale: int = 1) -> Column:
    """Mean of a (possibly textual) numeric column as ``decimal(p, s)``, half-up. [O-21, O-22, O-34]

    Text that is not a number counts as NULL instead of aborting the job.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.avg(c.try_cast("double")).cast(f"decimal({precision},{scale})")


def gold_mart(
    df: DataFrame,
    rating: str = "nu_rating_review",
    version: str = "nu_version_app",
    review_id: str = "nu_id",
    date: str = "dt_date",
) -> DataFrame:
    """Mean rating and distinct reviews per (year-month, app version). [O-34, O-35, O-36]

    ``count_distinct`` is planned as a two-level aggregate: first on
    (month, version, id) - hashed by id too, so a hot (month, version) group
    spreads over all reducers - then a partial/final count per group.
    Rows are grouped on the month's first day; its ``yyyy-MM`` text is
    formatted once per group, after the aggregate.
    """
    key, is_date = month_start(df, date)
    return (
        df.groupBy(key.alias("month_start"), F.col(version).alias("nu_versao_app"))
        .agg(
            mean_as_decimal(rating).alias("nu_media_reviews_app"),
            F.count_distinct(F.col(review_id)).alias("nu_quantidade_usuarios"),
        )
        .select(
            "nu_media_reviews_app",
            "nu_versao_app",
            "nu_quantidade_usuarios",
            month_text(F.col("month_start"), is_date).alias("pt_ano_mes"),
        )
    )


def distinct_count_by_month(df: DataFrame, date: str = "dt_date") -> DataFrame:
    """Rows per year-month after whole-row de-duplication. [O-30, O-37]"""
    key, is_date = month_start(df, date)
    counted = count_by(df.distinct(), [key.alias("month_start")], "total_registros")
    return counted.select("total_registros", month_text(F.col("month_start"), is_date).alias("data"))

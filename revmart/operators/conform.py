"""Conforming operators: landing rows -> bronze rows.

All are ``DataFrame -> DataFrame`` and compose with ``df.transform``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions.dates import date_from_iso, month_key, time_of_day, year_key
from revmart.functions.text import normalise_text
from revmart.schemas import BRONZE_COLUMNS, BRONZE_PRE_DEDUP, BRONZE_RENAMES


def void_to_string(df: DataFrame) -> DataFrame:
    """Every all-NULL (``void``) column becomes a string NULL; others pass through. [O-14, O-20, O-21]"""
    return df.select([
        F.lit(None).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f.name)
        for f in df.schema.fields
    ])


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = BRONZE_RENAMES) -> DataFrame:
    """Bulk rename in one projection; names absent from ``df`` are ignored. [O-16]"""
    return df.withColumnsRenamed(dict(mapping))


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep ``columns`` in this order; the scan reads only what is kept. [O-15]"""
    return df.select(*columns)


def normalise_columns(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """``{out_col: src_col}``: accent/emoji strip + upper-case, in one Arrow pass. [O-17, O-24, O-49]"""
    return df.withColumns({out: normalise_text(src) for out, src in targets.items()})


def add_partition_keys(df: DataFrame, ts_col: str = "updated", year: str = "ano", month: str = "mes") -> DataFrame:
    """Year (chars 1-4) and month (chars 6-7) of the ISO string, as text. [O-17, O-23]"""
    return df.withColumns({year: year_key(ts_col), month: month_key(ts_col)})


def split_review_timestamp(
    df: DataFrame, ts_col: str = "ts_review", date_col: str = "dt_date", time_col: str = "hr_review"
) -> DataFrame:
    """Feed-local calendar date and ``HH:mm:ss`` cut from the ISO string. [O-17, O-23, O-25]"""
    return df.withColumns({date_col: date_from_iso(ts_col), time_col: time_of_day(ts_col)})


def dedup(df: DataFrame) -> DataFrame:
    """Whole-row distinct. [O-37]

    Partial aggregation collapses copies inside each map task, so even a
    group of copies holding a third of all rows crosses the shuffle as at
    most one row per map task."""
    return df.distinct()


def conform_bronze(landing: DataFrame) -> DataFrame:
    """Landing rows -> bronze rows (``BRONZE_COLUMNS``), duplicates removed. [J-2 body]

    Order of effects: rename, strip accents/emoji and upper-case title and
    body, keep the 13 pre-check columns, drop duplicate rows, then add the
    date and time of day. The two derived columns are functions of
    ``ts_review`` alone, so deduplicating before deriving them gives the same
    rows while shuffling two columns fewer. Rows that differ only in the
    three columns dropped afterwards (``contentType``, author, link) stay
    separate rows, as in the original pipeline.
    """
    renamed = rename_columns(landing)
    texts = normalise_columns(renamed, {"ds_title": "ds_title", "ds_reviews": "content"})
    unique = dedup(select_columns(texts, BRONZE_PRE_DEDUP))
    return split_review_timestamp(unique).select(*BRONZE_COLUMNS)


def stamp_load_time(df: DataFrame, load_ts=None, col: str = "ts_gravado_em") -> DataFrame:
    """Add the load timestamp. [O-26]

    ``current_timestamp()`` (one value per query) or a given literal for
    repeatable runs."""
    value = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp")
    return df.withColumn(col, value)

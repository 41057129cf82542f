"""Conform operators: renames, dates under any time zone, de-duplication."""

import datetime as dt

from pyspark.sql import functions as F

from revmart.functions.dates import month_filter
from revmart.operators.conform import (
    conform_bronze,
    rename_columns,
    split_review_timestamp,
    void_to_string,
)
from revmart.schemas import BRONZE_COLUMNS, LANDING_SCHEMA


def _landing(spark, rows):
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def _row(i, title="Título", content="Ótimo app 😀", updated="2022-06-30T23:30:11-07:00", author=None):
    return (str(i), title, content, None, "0", "1", "5", updated, "1.2", author, None,
            int(updated[:4]), int(updated[5:7]))


def test_rename_ignores_unknown_names(spark):
    from revmart.schemas import BRONZE_RENAMES

    df = _landing(spark, [_row(1)])
    renamed = df.withColumnsRenamed({**BRONZE_RENAMES, "noSuchColumn": "ds_never"})
    assert renamed.columns == rename_columns(df).columns and "contentType" in renamed.columns
    assert {"nu_id", "ds_title", "pt_ano", "pt_mes", "ds_link"} <= set(renamed.columns)


def test_void_to_string_keeps_other_columns(spark):
    df = spark.range(3).select("id", F.lit(None).alias("v"), F.lit("x").alias("s"))
    out = void_to_string(df)
    assert out.dtypes == [("id", "bigint"), ("v", "string"), ("s", "string")]
    assert out.where(F.col("v").isNotNull()).count() == 0


def test_date_is_feed_local_in_any_session_zone(spark):
    df = spark.createDataFrame([("2022-06-30T23:30:11-07:00",), ("bad",), (None,)], "ts_review string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = split_review_timestamp(df).collect()
            assert rows[0].dt_date == dt.date(2022, 6, 30) and rows[0].hr_review == "23:30:11"
            assert rows[1].dt_date is None  # malformed text stays NULL, no job failure
            assert rows[2].dt_date is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_bronze_dedup_and_order_of_effects(spark):
    rows = [
        _row(1), _row(1),  # exact copies
        _row(2, title="Cafe"), _row(2, title="Café"),  # equal only after accent strip
        _row(3, author="a"), _row(3, author="b"),  # differ only in a dropped column
    ]
    bronze = conform_bronze(_landing(spark, rows))
    assert bronze.columns == BRONZE_COLUMNS
    got = sorted((r.nu_id, r.ds_title) for r in bronze.collect())
    assert got == [("1", "TITULO"), ("2", "CAFE"), ("3", "TITULO"), ("3", "TITULO")]
    first = bronze.where(F.col("nu_id") == "1").first()
    assert first.ds_reviews == "OTIMO APP "
    assert (first.pt_ano, first.pt_mes, str(first.dt_date)) == (2022, 6, "2022-06-30")


def test_month_filter_equals_substring_form(spark, sf001):
    orders = spark.read.parquet(f"{sf001}/orders.parquet")
    ranged = month_filter(orders, "o_orderdate", "1996-03")
    literal = orders.where(F.substring(F.col("o_orderdate").cast("string"), 1, 7) == "1996-03")
    assert ranged.count() > 0
    assert ranged.exceptAll(literal).count() == 0 and literal.exceptAll(ranged).count() == 0
    for month in ("1995-12", "1996-01"):
        a = month_filter(orders, "o_orderdate", month)
        b = orders.where(F.substring(F.col("o_orderdate").cast("string"), 1, 7) == month)
        assert a.count() == b.count()


def test_sort_splits_a_hot_key_across_partitions(spark):
    from revmart.operators.quality import sort_multi_key

    hot = spark.range(0, 40000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id"
    )
    out = sort_multi_key(hot, ["k"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = out.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 0.34 * 40000 * 0.75  # the hot third is cut up
    keys = [r.k for r in out.select("k").collect()]
    assert keys == sorted(keys)


def test_version_text_sorts_lexicographically(spark):
    from revmart.operators.quality import count_by_version

    df = spark.createDataFrame([("1.10.0",), ("1.9.0",), ("1.9.0",), ("2.0",)], "nu_version_app string")
    got = [(r.nu_version_app, r.total) for r in count_by_version(df).collect()]
    assert got == [("2.0", 1), ("1.9.0", 2), ("1.10.0", 1)]


def test_mean_as_decimal_half_up_and_tolerant(spark):
    from revmart.operators.aggregate import mean_as_decimal

    rows = [("a", "1.1"), ("a", "1.2"), ("b", "2.2"), ("b", "2.3"), ("c", "-2.2"), ("c", "-2.3"),
            ("d", "4"), ("d", "not a number")]
    df = spark.createDataFrame(rows, "g string, r string")
    got = {r.g: str(r.m) for r in df.groupBy("g").agg(mean_as_decimal("r").alias("m")).collect()}
    assert got == {"a": "1.2", "b": "2.3", "c": "-2.3", "d": "4.0"}


def test_month_filter_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    stamps = st.lists(st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31)),
                      min_size=1, max_size=50)

    @settings(max_examples=10, deadline=None, derandomize=True, database=None)
    @given(stamps, st.sampled_from(["1999-12", "2000-01", "2000-02", "2024-02", "2030-12"]))
    def check(values, month):
        df = spark.createDataFrame([(v, v.date()) for v in values], "ts timestamp_ntz, d date")
        for col in ("ts", "d"):
            ranged = month_filter(df, col, month).count()
            literal = df.where(F.substring(F.col(col).cast("string"), 1, 7) == month).count()
            assert ranged == literal

    check()


def test_preview_pandas_is_bounded_and_ordered(spark, sf001):
    from revmart.operators.quality import preview_pandas
    from revmart.plans import catalog

    pdf = preview_pandas(catalog.rv_bronze(spark, sf001), 5, ["nu_id"])
    assert len(pdf) == 5
    assert list(pdf["nu_id"]) == sorted(pdf["nu_id"])
    assert list(pdf.columns) == BRONZE_COLUMNS

"""The four stages as jobs of (spark, input, output path).

Each stage reads the previous zone back from storage rather than chaining the
in-memory plan: the written zone is the lineage cut, so a lost executor never
forces a re-run of earlier stages, and every check runs on what was written.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions.dates import is_month, odd_month_keys
from revmart.operators.conform import add_partition_keys, conform_bronze, stamp_load_time, void_to_string
from revmart.plans.sql import (
    COUNT_BY_RATING_SQL,
    COUNT_BY_VERSION_SQL,
    COUNT_BY_VOTES_SQL,
    DISTINCT_COUNT_BY_MONTH_SQL,
    NULL_COLUMNS_SQL,
    PREVIEW_MONTHS_SQL,
    PREVIEW_ROWS_SQL,
    count_sql,
    gold_sql,
)
from revmart.schemas import (
    BRONZE_FILE_ORDER,
    BRONZE_PARTITIONS,
    BRONZE_SCHEMA,
    FEED_PAGE_XML_SCHEMA,
    GOLD_PARTITIONS,
    GOLD_SCHEMA,
    LANDING_PARTITIONS,
    SILVER_SCHEMA,
)
from revmart.sources.feed import CORRUPT, bad_pages, entries_of_parsed, entries_of_records, feed_entries, parse_pages, xml_entry_records
from revmart.sources.zones import read_landing, read_zone, write_zone

SILVER_VIEW = "vw_reviews_silver"
log = logging.getLogger(__name__)


def landing_rows(entries: DataFrame) -> DataFrame:
    """Entries -> landing rows: void columns typed, year/month keys added."""
    return add_partition_keys(void_to_string(entries))


def landing_frame(pages: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Pages -> landing rows (``mode``: FAILFAST only, see ``feed_entries``)."""
    return landing_rows(feed_entries(pages, mode))


def landing_job(
    spark: SparkSession,
    pages: DataFrame,
    out_path: str,
    mode: str = "FAILFAST",
    files: str | int = "rebalance",
    quarantine_path: str | None = None,
) -> DataFrame:
    """J-1: landed feed pages -> landing zone, partitioned by ano/mes (text). [J-1]

    ``files="keep"`` skips the rebalance shuffle; right when pages arrive in
    time order, so each task's pages span few months (few files per task).

    ``mode="FAILFAST"`` (the original behaviour) fails the run on a malformed
    page. With ``mode="PERMISSIVE"`` and a ``quarantine_path`` the good pages
    land and the malformed ones are written, raw, to the quarantine zone:
    their count is observed during the landing write, and only when it is
    non-zero is a second pass made to pick them out. The quarantine is this
    run's: a run without malformed pages leaves an earlier one empty.
    """
    _require_quarantine(mode, quarantine_path)
    parsed = parse_pages(pages, mode, T.StructType([FEED_PAGE_XML_SCHEMA["entry"]]))
    observation = None
    if mode == "PERMISSIVE":
        observation = Observation("bad_pages")
        bad = F.sum(F.col(f"feed.{CORRUPT}").isNotNull().cast("long"))
        parsed = parsed.observe(observation, F.coalesce(bad, F.lit(0)).alias("bad"))
    write_zone(landing_rows(entries_of_parsed(parsed)), out_path, LANDING_PARTITIONS, files=files)
    if observation is not None:
        _write_quarantine(spark, bad_pages(pages), int(observation.get["bad"]), quarantine_path)
    return read_landing(spark, out_path)


def _require_quarantine(mode: str, quarantine_path: str | None) -> None:
    if mode != "FAILFAST" and not quarantine_path:
        raise ValueError("PERMISSIVE landing needs a quarantine_path: malformed pages are never dropped")


def _write_quarantine(spark: SparkSession, bad: DataFrame, count: int, path: str) -> None:
    """``bad`` (``count`` rows) as this run's quarantine; what an earlier run left there goes."""
    if count:
        log.warning("%d malformed feed pages quarantined at %s", count, path)
        bad.write.mode("overwrite").parquet(path)
        return
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([], bad.schema).write.mode("overwrite").parquet(path)


def landing_job_from_xml_files(
    spark: SparkSession,
    path: str,
    out_path: str,
    mode: str = "FAILFAST",
    files: str | int = "rebalance",
    quarantine_path: str | None = None,
) -> DataFrame:
    """J-1 variant: landed raw XML files read by the XML data source (entries
    streamed record by record) -> landing zone. [J-1]

    ``files``, ``mode`` and ``quarantine_path`` as in ``landing_job``, entry by
    entry: entries that parse land, and a file with one that does not is
    quarantined whole (``page_url``, its path, and ``xml``), since the source
    cannot always tell where the next entry begins. Landing the file again
    once it is mended repeats rows, which bronze removes. FAILFAST, a
    malformed entry fails the run rather than landing as an empty row.
    """
    _require_quarantine(mode, quarantine_path)
    records = xml_entry_records(spark, path, mode)
    observation = None
    if mode == "PERMISSIVE":
        observation = Observation("bad_entries")
        bad = F.sum(F.col(CORRUPT).isNotNull().cast("long"))
        records = records.observe(observation, F.coalesce(bad, F.lit(0)).alias("bad"))
    write_zone(landing_rows(entries_of_records(records)), out_path, LANDING_PARTITIONS, files=files)
    if observation is not None:
        corrupt = xml_entry_records(spark, path, mode).where(F.col(CORRUPT).isNotNull())
        # the source refuses to read its corrupt records alone: a field goes along
        one = corrupt.groupBy("page_url").agg(F.min(CORRUPT).alias("xml"), F.count("e.id").alias("parsed"))
        corrupt = one.select("page_url", F.when(F.col("parsed") >= 0, F.col("xml")).alias("xml"))
        _write_quarantine(spark, corrupt, int(observation.get["bad"]), quarantine_path)
    return read_landing(spark, out_path)


def only_months(df: DataFrame, year: str, month: str, months: Sequence[str]) -> DataFrame:
    """Rows of the given ``yyyy-MM`` months, by partition-column equality, so
    the scan reads only those partition directories."""
    return df.where(reduce(lambda a, b: a | b, [is_month(year, month, m) for m in months]))


def rebuild_scope(df: DataFrame, year: str, month: str, months: Sequence[str]) -> DataFrame:
    """What a rebuild of ``months`` reads: those months, and the rows whose keys
    are NULL or no month. No month list can name the latter, so every rebuild
    takes them along; else their directories would go stale."""
    named = reduce(lambda a, b: a | b, [is_month(year, month, m) for m in months])
    return df.where(named | odd_month_keys(year, month))


def _require_months(df: DataFrame, year: str, month: str, months: Sequence[str]) -> None:
    """Every requested month must have input rows: a month without any would
    keep its old output directory under a dynamic overwrite. Reads partition
    values only; at most ``len(months)`` rows reach the driver."""
    found = {f"{r[0]:04d}-{r[1]:02d}" for r in df.select(year, month).distinct().collect()}
    missing = sorted(set(months) - found)
    if missing:
        raise ValueError(f"no input rows for months {missing}")


def bronze_job(
    spark: SparkSession,
    landing_path: str,
    out_path: str,
    files: str | int = "keep",
    months: Sequence[str] | None = None,
) -> DataFrame:
    """J-2: landing zone -> bronze zone (conformed, de-duplicated, sorted in file). [J-2]

    By default the de-duplication reducers write their own rows: whole texts
    cross the network once. The shuffle is by whole row behind a map-side
    distinct, so neither a hot month nor a group of copies gathers in one
    reducer; a month gets one file per reducer at most, and AQE sets the
    number of reducers by bytes. ``files="rebalance"`` or ``"compact"`` gives
    fewer files per month for a second shuffle.

    ``months`` (``yyyy-MM`` list) recomputes only those partitions (and the
    rows whose keys name no month) and leaves the others in place (dynamic
    overwrite). Exact: the year/month keys are
    part of every row, so duplicates never span months and a bronze month
    depends on its landing month alone.
    """
    landing = read_landing(spark, landing_path)
    if months:
        _require_months(only_months(landing, "ano", "mes", months), "ano", "mes", months)
        landing = rebuild_scope(landing, "ano", "mes", months)
    write_zone(
        conform_bronze(landing), out_path, BRONZE_PARTITIONS, BRONZE_FILE_ORDER, files=files,
        overwrite="dynamic" if months else "static",
    )
    return read_zone(spark, out_path, BRONZE_SCHEMA)


def silver_job(
    spark: SparkSession,
    bronze_path: str,
    out_path: str,
    load_ts=None,
    months: Sequence[str] | None = None,
    files: str | int = "keep",
) -> DataFrame:
    """J-3: bronze zone + load timestamp -> silver zone. [J-3]

    No shuffle by default: a task writes the rows of its bronze splits (each
    of one directory, or of a few small ones) into the matching silver
    directories; a local sort keeps the in-file order. ``files="compact"``
    gives one file per directory. ``months`` restamps only those partitions
    (and the rows whose keys name no month).
    """
    bronze = read_zone(spark, bronze_path, BRONZE_SCHEMA)
    if months:
        _require_months(only_months(bronze, "pt_ano", "pt_mes", months), "pt_ano", "pt_mes", months)
        bronze = rebuild_scope(bronze, "pt_ano", "pt_mes", months)
    silver = stamp_load_time(bronze, load_ts)
    write_zone(
        silver, out_path, BRONZE_PARTITIONS, BRONZE_FILE_ORDER, files=files,
        overwrite="dynamic" if months else "static",
    )
    return read_zone(spark, out_path, SILVER_SCHEMA)


def gold_job(
    spark: SparkSession, silver_path: str, out_path: str, view: str = SILVER_VIEW, files: str | int = "rebalance"
) -> DataFrame:
    """J-4: silver zone -> monthly mart per app version, partitioned by pt_ano_mes. [J-4, O-12, O-48]

    ``files="compact"`` gives one file per month."""
    read_zone(spark, silver_path, SILVER_SCHEMA).createOrReplaceTempView(view)
    gold = spark.sql(gold_sql(view))
    write_zone(gold, out_path, GOLD_PARTITIONS, files=files)
    return read_zone(spark, out_path, GOLD_SCHEMA)


#: The report's checks of the silver zone and, below, of the landing zone.
SILVER_CHECKS = {
    "distinct_count_by_month": DISTINCT_COUNT_BY_MONTH_SQL,
    "count_by_votes": COUNT_BY_VOTES_SQL,
    "count_by_rating": COUNT_BY_RATING_SQL,
    "count_by_version": COUNT_BY_VERSION_SQL,
    "preview_months": PREVIEW_MONTHS_SQL,
    "preview_rows": PREVIEW_ROWS_SQL,
}
LANDING_CHECKS = {
    "count_by_year_month": count_sql("ano", "mes", total="total"),
    "null_columns": NULL_COLUMNS_SQL,
}
LANDING_VIEW = "vw_reviews_landing"


def quality_report(
    spark: SparkSession, silver_path: str, view: str = SILVER_VIEW, landing_path: str | None = None,
    landing_view: str = LANDING_VIEW,
) -> dict[str, DataFrame]:
    """J-5: the validation statements over the written zones (lazy). [J-5, O-19, O-47, O-48]

    They read the zones, not the plans that produced them, so no stage is
    re-run and the load timestamp is the one stored. With ``landing_path``
    also the two checks of the landing zone: rows per year and month, and the
    values of the columns that should be all NULL.
    """
    read_zone(spark, silver_path, SILVER_SCHEMA).createOrReplaceTempView(view)
    report = {name: spark.sql(sql.format(view=view)) for name, sql in SILVER_CHECKS.items()}
    if landing_path is not None:
        read_landing(spark, landing_path).createOrReplaceTempView(landing_view)
        report |= {name: spark.sql(sql.format(view=landing_view)) for name, sql in LANDING_CHECKS.items()}
    return report


#: Per check the columns that name a row, and its value (NULL: the row itself is the finding).
REPORT_KEYS = {
    "distinct_count_by_month": (["data"], "total_registros"),
    "count_by_votes": (["nu_sum_votes_reviews", "ds_count_votes_reviews"], "total"),
    "count_by_rating": (["nu_rating_review"], "total"),
    "count_by_version": (["nu_version_app"], "total"),
    "preview_months": (["ano", "ds_title", "ds_reviews"], None),
    "preview_rows": (["nu_id", "dt_date", "hr_review"], None),
    "count_by_year_month": (["ano", "mes"], "total"),
    "null_columns": (["ds_link", "ds_desc_author", "contentType"], None),
}


def report_table(report: dict[str, DataFrame]) -> DataFrame:
    """The whole report as one table: ``check``, ``key`` (its columns joined by
    ``|``, NULL as ``-``) and ``value``."""
    parts = []
    for name, df in report.items():
        keys, value = REPORT_KEYS[name]
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
        found = F.col(value).cast("long") if value else F.lit(None).cast("long")
        parts.append(df.select(F.lit(name).alias("check"), key.alias("key"), found.alias("value")))
    return reduce(DataFrame.unionAll, parts)


def run_stages(spark: SparkSession, pages: DataFrame, root: str, load_ts=None) -> dict[str, str]:
    """All four stages under ``root``; returns the zone paths."""
    paths = {z: os.path.join(root, z) for z in ("landing", "bronze", "silver", "gold")}
    landing_job(spark, pages, paths["landing"])
    bronze_job(spark, paths["landing"], paths["bronze"])
    silver_job(spark, paths["bronze"], paths["silver"], load_ts)
    gold_job(spark, paths["silver"], paths["gold"])
    return paths

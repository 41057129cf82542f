"""Registered queries: every operator bound to the test tables, plus the
equivalent DuckDB SQL used as the correctness oracle.

Bindings (the test tables carry no review feed):

* review fixture "RV" = ``reviews_from_documents(documents)``; its feed pages
  = ``feed_pages_from_documents(documents)``;
* the mart shape on ``lineitem``: ``l_quantity`` as rating, ``l_returnflag``
  as app version, ``l_partkey`` as review id, ``l_shipdate`` as date;
* counts, duplicates, sorts and month filters on ``orders``.

Every query reads whole tables. Queries that end in a zone write their rows
under the shared checkpoint folder and return the zone read back. Counts and
previews read a bronze and a silver zone of RV, written once for each session and
table folder, as the checks of the original read the written silver zone.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.functions.dates import month_filter
from revmart.functions.text import normalise_text, url_strip_query
from revmart.operators.aggregate import distinct_count_by_month, gold_mart
from revmart.operators.conform import (
    add_partition_keys,
    conform_bronze,
    rename_columns,
    select_columns,
    split_review_timestamp,
    stamp_load_time,
    void_to_string,
)
from revmart.operators.quality import (
    count_by_rating,
    count_by_version,
    count_by_votes,
    count_by_year_month,
    distinct_subset,
    month_rows,
    preview_months,
    preview_rows,
    sort_multi_key,
)
from revmart.plans.jobs import bronze_job, gold_job, landing_frame, landing_job, quality_report, report_table, silver_job
from revmart.plans.sql import (
    COUNT_BY_RATING_SQL,
    COUNT_BY_VERSION_SQL,
    COUNT_BY_VOTES_SQL,
    GOLD_SQL,
    PREVIEW_MONTHS_SQL,
    PREVIEW_ROWS_SQL,
    distinct_count_sql,
    run_on,
)
from revmart.schemas import (
    BRONZE_COLUMNS,
    BRONZE_FILE_ORDER,
    BRONZE_PARTITIONS,
    BRONZE_PRE_DEDUP,
    BRONZE_SCHEMA,
    GOLD_DISPLAY_ORDER,
    GOLD_PARTITIONS,
    GOLD_SCHEMA,
    LANDING_COLUMNS,
    SILVER_SCHEMA,
    SILVER_STAMP,
)
from revmart.session import scratch_path, shared_scratch
from revmart.sources.feed import feed_content_text, feed_entries, feed_last_page, feed_links, union_pages
from revmart.sources.fixtures import ENTRIES_PER_PAGE, feed_pages_from_documents, reviews_from_documents
from revmart.sources.zones import read_landing, read_zone, write_zone
from revmart.streaming.landing_stream import start_landing_stream

# Fixed load time for repeatable silver rows.
LOAD_TS = dt.datetime(2022, 8, 1, 3, 0, 0)
FILTER_MONTH = "1996-03"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def rv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_documents(table(spark, sf_dir, "documents"))


def rv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RV as the landing zone reads it: year/month keys as int."""
    keyed = add_partition_keys(rv(spark, sf_dir))
    return keyed.withColumns({"ano": F.col("ano").cast("int"), "mes": F.col("mes").cast("int")})


def rv_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_bronze(rv_landing(spark, sf_dir))


def bronze_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RV's bronze zone, written at the first call."""

    def write(path: str) -> None:
        write_zone(rv_bronze(spark, sf_dir), path, BRONZE_PARTITIONS, BRONZE_FILE_ORDER, files="keep")

    return read_zone(spark, shared_scratch(spark, f"bronze:{sf_dir}", write), BRONZE_SCHEMA)


def silver_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RV's silver zone, written from the bronze one at the first call."""

    def write(path: str) -> None:
        silver = stamp_load_time(bronze_zone(spark, sf_dir), LOAD_TS)
        write_zone(silver, path, BRONZE_PARTITIONS, BRONZE_FILE_ORDER, files="keep")

    return read_zone(spark, shared_scratch(spark, f"silver:{sf_dir}", write), SILVER_SCHEMA)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_pages_from_documents(table(spark, sf_dir, "documents")).select("page_url", "xml")


def _stamped(df: DataFrame) -> DataFrame:
    """Replace the load timestamp by a presence flag (its value is run-dependent)."""
    return df.withColumn(SILVER_STAMP, F.col(SILVER_STAMP).isNotNull())


def _lineitem_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_mart(
        table(spark, sf_dir, "lineitem"),
        rating="l_quantity",
        version="l_returnflag",
        review_id="l_partkey",
        date="l_shipdate",
    )


# ---------------------------------------------------------------- queries --

def q_gold_reviews_by_version_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_mart(spark, sf_dir)


def q_gold_reviews_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = GOLD_SQL.format(
        view="{view}", rating="l_quantity", version="l_returnflag", review_id="l_partkey", date="l_shipdate"
    )
    return run_on(spark, sql, table(spark, sf_dir, "lineitem"))


def q_gold_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_mart(spark, sf_dir).sort(*GOLD_DISPLAY_ORDER)


def q_count_by_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_date_text", F.col("o_orderdate").cast("string"))
    keyed = add_partition_keys(orders, "o_date_text")
    keyed = keyed.withColumns({"ano": F.col("ano").cast("int"), "mes": F.col("mes").cast("int")})
    return count_by_year_month(keyed)


def q_landing_count_by_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_year_month(landing_frame(pages(spark, sf_dir)))


def q_distinct_count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    # every order delivered twice: the distinct must remove the copies
    return distinct_count_by_month(orders.unionAll(orders), "o_orderdate")


def q_distinct_count_by_month_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return run_on(spark, distinct_count_sql("o_orderdate"), orders.unionAll(orders))


def q_count_by_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_votes(silver_zone(spark, sf_dir))


def q_count_by_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_rating(silver_zone(spark, sf_dir))


def q_count_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_version(silver_zone(spark, sf_dir))


def q_count_by_votes_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on(spark, COUNT_BY_VOTES_SQL, silver_zone(spark, sf_dir))


def q_count_by_rating_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on(spark, COUNT_BY_RATING_SQL, silver_zone(spark, sf_dir))


def q_count_by_version_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on(spark, COUNT_BY_VERSION_SQL, silver_zone(spark, sf_dir))


def q_distinct_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_subset(table(spark, sf_dir, "documents"), ["lang", "source"])


def q_null_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = rename_columns(rv_landing(spark, sf_dir))
    return distinct_subset(renamed, ["ds_link", "ds_desc_author", "contentType"])


def q_bronze_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = rv_landing(spark, sf_dir)
    # the same page landed twice: every review arrives as two identical rows
    return conform_bronze(landing.unionAll(landing))


def q_sort_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_date_text", F.col("o_orderdate").cast("string"))
    keyed = add_partition_keys(orders, "o_date_text").drop("o_date_text")
    keyed = keyed.withColumns({"ano": F.col("ano").cast("int"), "mes": F.col("mes").cast("int")})
    return sort_multi_key(keyed, ["ano", "mes", "o_orderpriority", "o_orderstatus"])


def q_conform_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = rename_columns(rv_landing(spark, sf_dir)).withColumn("ds_reviews", F.col("content"))
    return select_columns(renamed, BRONZE_PRE_DEDUP)


def q_void_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    raw = docs.select("doc_id", "lang", *[F.lit(None).alias(c) for c in ("contentType", "author", "link")])
    return void_to_string(raw)


def q_partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_partition_keys(rv(spark, sf_dir)).select("id", "updated", "ano", "mes")


def q_date_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = rename_columns(rv(spark, sf_dir))
    return split_review_timestamp(renamed).select("nu_id", "ts_review", "dt_date", "hr_review")


def q_text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", normalise_text("text").alias("text_norm"))


def q_url_strip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", url_strip_query("url").alias("url_base"))


def q_silver_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = stamp_load_time(bronze_zone(spark, sf_dir))
    return _stamped(silver).select("nu_id", "pt_ano", "pt_mes", SILVER_STAMP)


def q_preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_rows(bronze_zone(spark, sf_dir), 5, ["nu_id"])


def q_preview_rows_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on(spark, PREVIEW_ROWS_SQL, bronze_zone(spark, sf_dir))


def q_preview_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_months(bronze_zone(spark, sf_dir))


def q_preview_months_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_on(spark, PREVIEW_MONTHS_SQL, bronze_zone(spark, sf_dir))


def q_filter_month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_filter(table(spark, sf_dir, "orders"), "o_orderdate", FILTER_MONTH)


def q_filter_month_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_rows(table(spark, sf_dir, "orders"), "o_orderdate", FILTER_MONTH)


def q_feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return void_to_string(feed_entries(pages(spark, sf_dir)))


def q_feed_content_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_content_text(pages(spark, sf_dir))


def q_feed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_links(pages(spark, sf_dir))


def q_feed_last_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_last_page(pages(spark, sf_dir))


def q_feed_union_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = feed_entries(pages(spark, sf_dir))
    # two monthly crawl batches whose feeds carried different tag sets:
    # June's lacked the version tag, July's the vote sum
    # (an entry without a date belongs to the second)
    in_june = F.coalesce(F.col("updated").startswith("2022-06"), F.lit(False))
    june = entries.where(in_june).drop("version")
    july = entries.where(~in_june).drop("voteSum")
    return void_to_string(union_pages(june, july)).select(*LANDING_COLUMNS)


def q_zone_roundtrip_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold-lineitem")
    write_zone(_lineitem_mart(spark, sf_dir), path, GOLD_PARTITIONS)
    return read_zone(spark, path, GOLD_SCHEMA)


def q_zone_roundtrip_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing-rv")
    write_zone(add_partition_keys(rv(spark, sf_dir)), path, ["ano", "mes"])
    return read_landing(spark, path)


def q_zone_roundtrip_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = scratch_path(spark, "bronze-rv")
    write_zone(rv_bronze(spark, sf_dir), bronze, BRONZE_PARTITIONS, ["dt_date", "hr_review"])
    silver = scratch_path(spark, "silver-rv")
    stamped = stamp_load_time(read_zone(spark, bronze, BRONZE_SCHEMA), LOAD_TS)
    write_zone(stamped, silver, BRONZE_PARTITIONS, ["dt_date", "hr_review"], files="keep")
    return _stamped(read_zone(spark, silver, SILVER_SCHEMA))


def q_zone_roundtrip_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "bronze-rv")
    write_zone(rv_bronze(spark, sf_dir), path, BRONZE_PARTITIONS, ["dt_date", "hr_review"])
    return read_zone(spark, path, BRONZE_SCHEMA)


def q_job_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_job(spark, pages(spark, sf_dir), scratch_path(spark, "landing"))


def _through_bronze(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    landing = scratch_path(spark, "landing")
    landing_job(spark, pages(spark, sf_dir), landing)
    bronze = scratch_path(spark, "bronze")
    return bronze, bronze_job(spark, landing, bronze)


def q_job_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_bronze(spark, sf_dir)[1]


def q_job_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, _ = _through_bronze(spark, sf_dir)
    return _stamped(silver_job(spark, bronze, scratch_path(spark, "silver"), LOAD_TS))


def q_job_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, _ = _through_bronze(spark, sf_dir)
    silver = scratch_path(spark, "silver")
    silver_job(spark, bronze, silver)
    # a view name of its own, so concurrent calls in one session never clash
    view = f"vw_reviews_silver_{uuid.uuid4().hex}"
    return gold_job(spark, silver, scratch_path(spark, "gold"), view=view)


def odd_timestamps(reviews: DataFrame) -> DataFrame:
    """Reviews whose timestamps are partly written oddly: a one-digit month, a
    leading blank, or none at all."""
    odd = (
        F.when(F.col("id").cast("long") % 4 == 1, F.regexp_replace("updated", "-0", "-"))
        .when(F.col("id").cast("long") % 4 == 2, F.concat(F.lit(" "), F.col("updated")))
        .when(F.col("id").cast("long") % 16 == 3, F.lit(None).cast("string"))
        .otherwise(F.col("updated"))
    )
    return reviews.withColumn("updated", odd)


def q_filter_month_odd_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month filter with partition keys over a zone of odd timestamps."""
    landing, bronze = scratch_path(spark, "landing-odd"), scratch_path(spark, "bronze-odd")
    write_zone(add_partition_keys(odd_timestamps(rv(spark, sf_dir))), landing, ["ano", "mes"])
    zone = bronze_job(spark, landing, bronze)
    return month_filter(zone, "dt_date", "2022-06", ("pt_ano", "pt_mes")).select("nu_id", "ts_review", "dt_date")


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    landing_job(spark, pages(spark, sf_dir), landing)
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    bronze_job(spark, landing, bronze)
    silver_job(spark, bronze, silver, LOAD_TS)
    # view names of their own, so concurrent calls in one session never clash
    own = uuid.uuid4().hex
    return report_table(quality_report(spark, silver, f"silver_{own}", landing, f"landing_{own}"))


def q_stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = scratch_path(spark, "landed-pages")
    pages(spark, sf_dir).write.mode("overwrite").parquet(landed)
    out = scratch_path(spark, "landing-stream")
    query = start_landing_stream(spark, landed, out, scratch_path(spark, "landing-stream-ckpt"))
    query.awaitTermination()
    return read_landing(spark, out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_reviews_by_version_month": q_gold_reviews_by_version_month,
    "gold_reviews_sql": q_gold_reviews_sql,
    "gold_sorted": q_gold_sorted,
    "count_by_year_month": q_count_by_year_month,
    "landing_count_by_year_month": q_landing_count_by_year_month,
    "distinct_count_by_month": q_distinct_count_by_month,
    "distinct_count_by_month_sql": q_distinct_count_by_month_sql,
    "count_by_votes": q_count_by_votes,
    "count_by_rating": q_count_by_rating,
    "count_by_version": q_count_by_version,
    "count_by_votes_sql": q_count_by_votes_sql,
    "count_by_rating_sql": q_count_by_rating_sql,
    "count_by_version_sql": q_count_by_version_sql,
    "distinct_subset": q_distinct_subset,
    "null_column_check": q_null_column_check,
    "bronze_dedup": q_bronze_dedup,
    "sort_multi_key": q_sort_multi_key,
    "conform_columns": q_conform_columns,
    "void_to_string": q_void_to_string,
    "partition_keys": q_partition_keys,
    "date_time_split": q_date_time_split,
    "text_normalise": q_text_normalise,
    "url_strip_query": q_url_strip_query,
    "silver_stamp": q_silver_stamp,
    "preview_rows": q_preview_rows,
    "preview_rows_sql": q_preview_rows_sql,
    "preview_months": q_preview_months,
    "preview_months_sql": q_preview_months_sql,
    "filter_month_range": q_filter_month_range,
    "filter_month_literal": q_filter_month_literal,
    "feed_entries": q_feed_entries,
    "feed_content_text": q_feed_content_text,
    "feed_links": q_feed_links,
    "feed_last_page": q_feed_last_page,
    "feed_union_pages": q_feed_union_pages,
    "zone_roundtrip_gold": q_zone_roundtrip_gold,
    "zone_roundtrip_bronze": q_zone_roundtrip_bronze,
    "zone_roundtrip_landing": q_zone_roundtrip_landing,
    "zone_roundtrip_silver": q_zone_roundtrip_silver,
    "job_landing": q_job_landing,
    "job_bronze": q_job_bronze,
    "job_silver": q_job_silver,
    "job_gold": q_job_gold,
    "stream_landing": q_stream_landing,
    "filter_month_odd_keys": q_filter_month_odd_keys,
    "quality_report": q_quality_report,
}


# ----------------------------------------------------------------- oracle --

NORM = r"upper(regexp_replace(strip_accents({c}), '[^\x00-\x7F]', '', 'g'))"


def _norm(c: str) -> str:
    return NORM.format(c=c)


RV_CTE = f"""
rv AS (
  SELECT
    CAST(doc_id AS VARCHAR) AS id,
    'Review ' || CAST(doc_id AS VARCHAR) || ' of ' || source AS title,
    text AS content,
    CAST(NULL AS VARCHAR) AS contentType,
    CAST(doc_id % 3 AS VARCHAR) AS voteSum,
    CAST(doc_id % 5 AS VARCHAR) AS voteCount,
    CAST(doc_id % 5 + 1 AS VARCHAR) AS rating,
    CAST(DATE '2022-06-01' + CAST(doc_id % 61 AS INTEGER) AS VARCHAR) || 'T'
      || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00:00-07:00' AS updated,
    source AS version,
    CAST(NULL AS VARCHAR) AS author,
    CAST(NULL AS VARCHAR) AS link,
    doc_id,
    doc_id // {ENTRIES_PER_PAGE} AS page_no
  FROM documents
)"""

RV_LANDING_CTE = RV_CTE + """,
rv_landing AS (
  SELECT id, title, content, contentType, voteSum, voteCount, rating, updated, version, author, link,
         CAST(substr(updated, 1, 4) AS INTEGER) AS ano, CAST(substr(updated, 6, 2) AS INTEGER) AS mes
  FROM rv
)"""


def _bronze_ctes(src: str) -> str:
    return f""",
b0 AS (
  SELECT DISTINCT
    id AS nu_id, {_norm('title')} AS ds_title, {_norm('content')} AS ds_reviews, contentType,
    voteSum AS nu_sum_votes_reviews, voteCount AS ds_count_votes_reviews, rating AS nu_rating_review,
    updated AS ts_review, version AS nu_version_app, author AS ds_desc_author, link AS ds_link,
    ano AS pt_ano, mes AS pt_mes
  FROM {src}
),
bronze AS (
  SELECT nu_id, ds_title, ds_reviews, nu_sum_votes_reviews, ds_count_votes_reviews, nu_rating_review,
         TRY_CAST(substr(ts_review, 1, 10) AS DATE) AS dt_date, substr(ts_review, 12, 8) AS hr_review,
         ts_review, nu_version_app, pt_ano, pt_mes
  FROM b0
)"""


BRONZE_WITH = "WITH " + RV_LANDING_CTE + _bronze_ctes("rv_landing")

LINEITEM_MART_SQL = """
SELECT CAST(avg(l_quantity) AS DECIMAL(18,1)) AS nu_media_reviews_app,
       l_returnflag AS nu_versao_app,
       count(DISTINCT l_partkey) AS nu_quantidade_usuarios,
       substr(CAST(l_shipdate AS VARCHAR), 1, 7) AS pt_ano_mes
FROM lineitem
GROUP BY substr(CAST(l_shipdate AS VARCHAR), 1, 7), l_returnflag
"""

ORDERS_KEYED = """
SELECT *, CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS INTEGER) AS ano,
          CAST(substr(CAST(o_orderdate AS VARCHAR), 6, 2) AS INTEGER) AS mes
FROM orders
"""

BRONZE_SELECT = ", ".join(BRONZE_COLUMNS)
LAST_PAGE = f"(SELECT max(doc_id // {ENTRIES_PER_PAGE}) FROM documents)"
FEED = "https://reviews.example/app/feed"


def _page_url(p: str) -> str:
    return f"'{FEED}/page=' || CAST({p} AS VARCHAR) || '/xml?cc=br&ref=crawl'"


def _link_url(p: str) -> str:
    return f"'{FEED}/page=' || CAST({p} AS VARCHAR) || '/xml?urlDesc=/feed'"


FEED_LINKS_SQL = f"""
WITH p AS (SELECT DISTINCT doc_id // {ENTRIES_PER_PAGE} AS page_no FROM documents)
SELECT {_page_url('page_no')} AS page_url,
       CASE WHEN page_no < {LAST_PAGE} THEN {_link_url('page_no + 1')} END AS link_next,
       {_link_url(LAST_PAGE)} AS link_last
FROM p
"""

ORACLE: dict[str, str] = {
    "gold_reviews_by_version_month": LINEITEM_MART_SQL,
    "gold_reviews_sql": LINEITEM_MART_SQL,
    "gold_sorted": LINEITEM_MART_SQL + " ORDER BY pt_ano_mes, nu_versao_app, nu_media_reviews_app, nu_quantidade_usuarios",
    "count_by_year_month": f"""
        SELECT ano, mes, count(*) AS "count" FROM ({ORDERS_KEYED}) GROUP BY ano, mes""",
    "landing_count_by_year_month": "WITH " + RV_LANDING_CTE + """
        SELECT CAST(substr(updated, 1, 4) AS VARCHAR) AS ano, substr(updated, 6, 2) AS mes, count(*) AS "count"
        FROM rv GROUP BY 1, 2""",
    "distinct_count_by_month": """
        WITH base AS (SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders))
        SELECT count(*) AS total_registros, substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS data
        FROM base GROUP BY substr(CAST(o_orderdate AS VARCHAR), 1, 7)""",
    "count_by_votes": BRONZE_WITH + """
        SELECT count(*) AS total, nu_sum_votes_reviews, ds_count_votes_reviews FROM bronze
        GROUP BY nu_sum_votes_reviews, ds_count_votes_reviews
        ORDER BY nu_sum_votes_reviews, ds_count_votes_reviews DESC""",
    "count_by_rating": BRONZE_WITH + """
        SELECT count(*) AS total, nu_rating_review FROM bronze
        GROUP BY nu_rating_review ORDER BY nu_rating_review DESC""",
    "count_by_version": BRONZE_WITH + """
        SELECT count(*) AS total, nu_version_app FROM bronze
        GROUP BY nu_version_app ORDER BY nu_version_app DESC""",
    "distinct_subset": "SELECT DISTINCT lang, source FROM documents",
    "null_column_check": "WITH " + RV_CTE + """
        SELECT DISTINCT link AS ds_link, author AS ds_desc_author, contentType FROM rv""",
    "bronze_dedup": "WITH " + RV_LANDING_CTE + ", twice AS (SELECT * FROM rv_landing UNION ALL SELECT * FROM rv_landing)"
        + _bronze_ctes("twice") + f" SELECT {BRONZE_SELECT} FROM bronze",
    "sort_multi_key": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, ano, mes
        FROM ({ORDERS_KEYED}) ORDER BY ano, mes, o_orderpriority, o_orderstatus""",
    "conform_columns": "WITH " + RV_LANDING_CTE + """
        SELECT id AS nu_id, title AS ds_title, content AS ds_reviews, contentType,
               voteSum AS nu_sum_votes_reviews, voteCount AS ds_count_votes_reviews, rating AS nu_rating_review,
               updated AS ts_review, version AS nu_version_app, author AS ds_desc_author, link AS ds_link,
               ano AS pt_ano, mes AS pt_mes
        FROM rv_landing""",
    "void_to_string": """
        SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS contentType, CAST(NULL AS VARCHAR) AS author,
               CAST(NULL AS VARCHAR) AS link
        FROM documents""",
    "partition_keys": "WITH " + RV_CTE + """
        SELECT id, updated, substr(updated, 1, 4) AS ano, substr(updated, 6, 2) AS mes FROM rv""",
    "date_time_split": "WITH " + RV_CTE + """
        SELECT id AS nu_id, updated AS ts_review, TRY_CAST(substr(updated, 1, 10) AS DATE) AS dt_date,
               substr(updated, 12, 8) AS hr_review
        FROM rv""",
    "text_normalise": f"SELECT doc_id, {_norm('text')} AS text_norm FROM documents",
    "url_strip_query": r"SELECT page_id, url, regexp_replace(url, '\?.*', '') AS url_base FROM pages",
    "silver_stamp": BRONZE_WITH + """
        SELECT nu_id, pt_ano, pt_mes, true AS ts_gravado_em FROM bronze""",
    "preview_rows": BRONZE_WITH + f" SELECT {BRONZE_SELECT} FROM bronze ORDER BY nu_id LIMIT 5",
    "preview_months": BRONZE_WITH + """
        (SELECT ds_title, ds_reviews, '202206' AS ano FROM bronze
           WHERE substr(CAST(dt_date AS VARCHAR), 1, 7) = '2022-06' ORDER BY nu_id LIMIT 3)
        UNION ALL
        (SELECT ds_title, ds_reviews, '202207' AS ano FROM bronze
           WHERE substr(CAST(dt_date AS VARCHAR), 1, 7) = '2022-07' ORDER BY nu_id LIMIT 3)""",
    "filter_month_range": f"""
        SELECT * FROM orders WHERE substr(CAST(o_orderdate AS VARCHAR), 1, 7) = '{FILTER_MONTH}'""",
    "feed_entries": "WITH " + RV_CTE + f" SELECT {', '.join(LANDING_COLUMNS)} FROM rv",
    "feed_content_text": "SELECT CAST(doc_id AS VARCHAR) AS id, text AS content FROM documents",
    "feed_links": FEED_LINKS_SQL,
    "feed_last_page": f"""
        WITH l AS ({FEED_LINKS_SQL})
        SELECT page_url, link_next, link_last,
               regexp_replace(page_url, '\\?.*', '') = regexp_replace(link_last, '\\?.*', '') AS is_last_page
        FROM l""",
    "feed_union_pages": "WITH " + RV_CTE + """
        SELECT id, title, content, contentType,
               CASE WHEN starts_with(updated, '2022-06') THEN voteSum END AS voteSum,
               voteCount, rating, updated,
               CASE WHEN starts_with(updated, '2022-06') THEN NULL ELSE version END AS version,
               author, link
        FROM rv""",
    "zone_roundtrip_gold": LINEITEM_MART_SQL,
    "zone_roundtrip_bronze": BRONZE_WITH + f" SELECT {BRONZE_SELECT} FROM bronze",
    "job_landing": "WITH " + RV_LANDING_CTE + " SELECT * FROM rv_landing",
    "job_bronze": BRONZE_WITH + f" SELECT {BRONZE_SELECT} FROM bronze",
    "job_silver": BRONZE_WITH + """
        SELECT nu_id, ds_title, ds_reviews, nu_sum_votes_reviews, ds_count_votes_reviews, nu_rating_review,
               dt_date, hr_review, ts_review, nu_version_app, true AS ts_gravado_em, pt_ano, pt_mes
        FROM bronze""",
    "job_gold": BRONZE_WITH + """
        SELECT CAST(avg(TRY_CAST(nu_rating_review AS DOUBLE)) AS DECIMAL(18,1)) AS nu_media_reviews_app,
               nu_version_app AS nu_versao_app,
               count(DISTINCT nu_id) AS nu_quantidade_usuarios,
               substr(CAST(dt_date AS VARCHAR), 1, 7) AS pt_ano_mes
        FROM bronze GROUP BY substr(CAST(dt_date AS VARCHAR), 1, 7), nu_version_app""",
    "stream_landing": "WITH " + RV_LANDING_CTE + " SELECT * FROM rv_landing",
    "filter_month_odd_keys": "WITH " + RV_CTE + """
        SELECT nu_id, ts_review, dt_date FROM (
          SELECT id AS nu_id, CAST(substr(updated, 1, 10) AS DATE) AS dt_date,
            CASE WHEN doc_id % 4 = 1 THEN replace(updated, '-0', '-')
                 WHEN doc_id % 4 = 2 THEN ' ' || updated
                 WHEN doc_id % 16 = 3 THEN NULL ELSE updated END AS ts_review
          FROM rv)
        WHERE ts_review IS NOT NULL AND substr(CAST(dt_date AS VARCHAR), 1, 7) = '2022-06'""",
    "quality_report": BRONZE_WITH + """
        , counted AS (
          SELECT 'distinct_count_by_month' AS c, substr(CAST(dt_date AS VARCHAR), 1, 7) AS k FROM (SELECT DISTINCT * FROM bronze)
          UNION ALL SELECT 'count_by_votes', nu_sum_votes_reviews || '|' || ds_count_votes_reviews FROM bronze
          UNION ALL SELECT 'count_by_rating', nu_rating_review FROM bronze
          UNION ALL SELECT 'count_by_version', nu_version_app FROM bronze
          UNION ALL SELECT 'count_by_year_month', CAST(ano AS VARCHAR) || '|' || CAST(mes AS VARCHAR) FROM rv_landing)
        SELECT c AS "check", k AS "key", count(*) AS "value" FROM counted GROUP BY c, k
        UNION ALL SELECT DISTINCT 'null_columns', '-|-|-', CAST(NULL AS BIGINT) FROM rv_landing
        UNION ALL (SELECT 'preview_rows', nu_id || '|' || CAST(dt_date AS VARCHAR) || '|' || hr_review, NULL
                   FROM bronze ORDER BY nu_id LIMIT 5)
        UNION ALL (SELECT 'preview_months', '202206|' || ds_title || '|' || ds_reviews, NULL
                   FROM bronze WHERE substr(CAST(dt_date AS VARCHAR), 1, 7) = '2022-06' ORDER BY nu_id LIMIT 3)
        UNION ALL (SELECT 'preview_months', '202207|' || ds_title || '|' || ds_reviews, NULL
                   FROM bronze WHERE substr(CAST(dt_date AS VARCHAR), 1, 7) = '2022-07' ORDER BY nu_id LIMIT 3)""",
}
ORACLE["distinct_count_by_month_sql"] = ORACLE["distinct_count_by_month"]
ORACLE["preview_months_sql"] = ORACLE["preview_months"]
ORACLE["preview_rows_sql"] = ORACLE["preview_rows"]
ORACLE["zone_roundtrip_landing"] = ORACLE["job_landing"]
ORACLE["filter_month_literal"] = ORACLE["filter_month_range"]
ORACLE["zone_roundtrip_silver"] = ORACLE["job_silver"]
for _name in ("count_by_votes", "count_by_rating", "count_by_version"):
    ORACLE[f"{_name}_sql"] = ORACLE[_name]

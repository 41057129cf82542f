"""Explicit zone schemas and the fixed names the pipeline must reproduce.

Fixed values: the column names, rename map and column orders below must equal
the ones of the original pipeline for results to line up, so they are stated
plainly here in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------
# Feed tags kept per entry (all strings), in landing-zone order.
FEED_TEXT_TAGS = ["id", "title", "content", "voteSum", "voteCount", "rating", "updated", "version"]
# Tags that only carry attributes or nested children: they land as NULL.
FEED_VOID_TAGS = ["contentType", "author", "link"]
LANDING_COLUMNS = [
    "id", "title", "content", "contentType", "voteSum", "voteCount",
    "rating", "updated", "version", "author", "link",
]
LANDING_PARTITIONS = ["ano", "mes"]

# Bronze renames, old name -> new name.
BRONZE_RENAMES = {
    "id": "nu_id",
    "title": "ds_title",
    "voteSum": "nu_sum_votes_reviews",
    "voteCount": "ds_count_votes_reviews",
    "rating": "nu_rating_review",
    "updated": "ts_review",
    "version": "nu_version_app",
    "author": "ds_desc_author",
    "link": "ds_link",
    "ano": "pt_ano",
    "mes": "pt_mes",
}
# Columns kept before the duplicate check (the body arrives as "content").
BRONZE_PRE_DEDUP = [
    "nu_id", "ds_title", "ds_reviews", "contentType", "nu_sum_votes_reviews",
    "ds_count_votes_reviews", "nu_rating_review", "ts_review", "nu_version_app",
    "ds_desc_author", "ds_link", "pt_ano", "pt_mes",
]
BRONZE_COLUMNS = [
    "nu_id", "ds_title", "ds_reviews", "nu_sum_votes_reviews", "ds_count_votes_reviews",
    "nu_rating_review", "dt_date", "hr_review", "ts_review", "nu_version_app",
    "pt_ano", "pt_mes",
]
BRONZE_PARTITIONS = ["pt_ano", "pt_mes"]
# In-file order of the bronze and silver zones after the partition keys.
BRONZE_FILE_ORDER = ["dt_date", "hr_review", "nu_version_app", "nu_rating_review"]
SILVER_STAMP = "ts_gravado_em"
GOLD_COLUMNS = ["nu_media_reviews_app", "nu_versao_app", "nu_quantidade_usuarios", "pt_ano_mes"]
GOLD_PARTITIONS = ["pt_ano_mes"]
GOLD_DISPLAY_ORDER = ["pt_ano_mes", "nu_versao_app", "nu_media_reviews_app", "nu_quantidade_usuarios"]
# --- end of fixed values ------------------------------------------------

S = T.StringType()

LANDING_SCHEMA = T.StructType(
    [T.StructField(c, S) for c in LANDING_COLUMNS]
    + [T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType())]
)
# On disk the landing keys are text (``mes=06``); a malformed timestamp can
# leave a non-numeric key, so they are read as text and converted leniently.
LANDING_FILE_SCHEMA = T.StructType(
    [T.StructField(c, S) for c in LANDING_COLUMNS + LANDING_PARTITIONS]
)

BRONZE_SCHEMA = T.StructType([
    T.StructField("nu_id", S),
    T.StructField("ds_title", S),
    T.StructField("ds_reviews", S),
    T.StructField("nu_sum_votes_reviews", S),
    T.StructField("ds_count_votes_reviews", S),
    T.StructField("nu_rating_review", S),
    T.StructField("dt_date", T.DateType()),
    T.StructField("hr_review", S),
    T.StructField("ts_review", S),
    T.StructField("nu_version_app", S),
    T.StructField("pt_ano", T.IntegerType()),
    T.StructField("pt_mes", T.IntegerType()),
])

SILVER_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields[:-2]
    + [T.StructField(SILVER_STAMP, T.TimestampType())]
    + BRONZE_SCHEMA.fields[-2:]
)

GOLD_SCHEMA = T.StructType([
    T.StructField("nu_media_reviews_app", T.DecimalType(18, 1)),
    T.StructField("nu_versao_app", S),
    T.StructField("nu_quantidade_usuarios", T.LongType()),
    T.StructField("pt_ano_mes", S),
])

PAGE_SCHEMA = T.StructType([T.StructField("page_url", S), T.StructField("xml", S)])


def _content_type() -> T.StructType:
    return T.StructType([T.StructField("_VALUE", S), T.StructField("_type", S)])


# What from_xml extracts from one feed page. Scalar tags keep the last
# occurrence; "content" is an array so the text-typed child can be chosen.
FEED_PAGE_XML_SCHEMA = T.StructType([
    T.StructField("link", T.ArrayType(T.StructType([
        T.StructField("_rel", S), T.StructField("_href", S),
    ]))),
    T.StructField("entry", T.ArrayType(T.StructType(
        [T.StructField(t, S) for t in FEED_TEXT_TAGS if t != "content"]
        + [T.StructField("content", T.ArrayType(_content_type()))]
    ))),
])

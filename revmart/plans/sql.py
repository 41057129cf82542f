"""SQL forms of the mart and the validation statements.

Run with ``spark.sql`` against a temp view (or a DataFrame argument); Catalyst
produces the same plan as the DataFrame operators. Month text is the first 7
characters of the date's text form; rating text is read with ``try_cast``
so a stray value becomes NULL rather than failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Output column names (nu_media_reviews_app, nu_versao_app,
# nu_quantidade_usuarios, pt_ano_mes, total_registros, data, total, ano), the
# month labels '202206' / '202207', the sample size 3 and the sort directions
# below are the ones the original validation statements and mart produce.

# Grouped on the month's first day (integer work per row); the yyyy-MM text
# is formatted once per group.
GOLD_SQL = """
SELECT
    CAST(avg(try_cast({rating} AS DOUBLE)) AS DECIMAL(18,1)) AS nu_media_reviews_app,
    {version} AS nu_versao_app,
    count(DISTINCT {review_id}) AS nu_quantidade_usuarios,
    substr(CAST(month_start AS STRING), 1, 7) AS pt_ano_mes
FROM (SELECT *, trunc(CAST({date} AS DATE), 'MM') AS month_start FROM {view})
GROUP BY month_start, {version}
"""


def distinct_count_sql(date: str = "dt_date") -> str:
    """A ``{view}`` template: distinct rows per month of ``date``."""
    return f"""
WITH base AS (SELECT DISTINCT * FROM {{view}})
SELECT count(*) AS total_registros, substr(CAST(month_start AS STRING), 1, 7) AS data
FROM (SELECT trunc(CAST({date} AS DATE), 'MM') AS month_start FROM base)
GROUP BY month_start
"""


DISTINCT_COUNT_BY_MONTH_SQL = distinct_count_sql()

COUNT_SQL = "SELECT count(*) AS {total}, {keys} FROM {{view}} GROUP BY {keys}"


def count_sql(*keys: str, order: str = "", total: str = "total") -> str:
    """A ``{view}`` template that counts rows per ``keys``."""
    return COUNT_SQL.format(total=total, keys=", ".join(keys)) + (f" ORDER BY {order}" if order else "")


COUNT_BY_VOTES_SQL = count_sql(
    "nu_sum_votes_reviews", "ds_count_votes_reviews", order="nu_sum_votes_reviews, ds_count_votes_reviews DESC"
)
COUNT_BY_RATING_SQL = count_sql("nu_rating_review", order="nu_rating_review DESC")
COUNT_BY_VERSION_SQL = count_sql("nu_version_app", order="nu_version_app DESC")

PREVIEW_ROWS_SQL = "SELECT * FROM {view} ORDER BY nu_id LIMIT 5"
NULL_COLUMNS_SQL = "SELECT DISTINCT link AS ds_link, author AS ds_desc_author, contentType FROM {view}"


def month_sample_sql(month: str, n: int = 3) -> str:
    """A ``{view}`` template: sample rows of one month (``yyyy-MM``).

    The month is a date range, which reaches the scan, plus a test of the
    partition keys, which prunes directories; keys that are NULL or no month
    stay in (``functions.dates.odd_month_keys``). Ordered by the review id, so
    the sample is the same in every run.
    """
    year, number = int(month[:4]), int(month[5:7])
    return f"""
(SELECT ds_title, ds_reviews, '{year}{number:02d}' AS ano FROM {{view}}
  WHERE dt_date >= DATE'{month}-01' AND dt_date < add_months(DATE'{month}-01', 1)
    AND ((pt_ano = {year} AND pt_mes = {number}) OR pt_ano IS NULL OR pt_mes IS NULL
         OR pt_ano < 1000 OR pt_ano > 9999 OR pt_mes < 1 OR pt_mes > 12)
  ORDER BY nu_id LIMIT {n})
"""


PREVIEW_MONTHS_SQL = "UNION ALL".join(month_sample_sql(m) for m in ("2022-06", "2022-07"))


def gold_sql(view: str, rating="nu_rating_review", version="nu_version_app", review_id="nu_id", date="dt_date") -> str:
    return GOLD_SQL.format(view=view, rating=rating, version=version, review_id=review_id, date=date)


def run_on(spark: SparkSession, sql_text: str, df: DataFrame) -> DataFrame:
    """Run a ``{view}`` SQL template against a DataFrame without a named view. [O-48]"""
    return spark.sql(sql_text.replace("{view}", "{src_view}"), src_view=df)

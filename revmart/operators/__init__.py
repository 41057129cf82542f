from revmart.operators.aggregate import count_by, distinct_count_by_month, gold_mart, mean_as_decimal
from revmart.operators.conform import (
    add_partition_keys,
    conform_bronze,
    dedup,
    normalise_columns,
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
    preview_pandas,
    preview_rows,
    sort_multi_key,
)

__all__ = [
    "add_partition_keys",
    "conform_bronze",
    "count_by",
    "count_by_rating",
    "count_by_version",
    "count_by_votes",
    "count_by_year_month",
    "dedup",
    "distinct_count_by_month",
    "distinct_subset",
    "gold_mart",
    "mean_as_decimal",
    "month_rows",
    "normalise_columns",
    "preview_months",
    "preview_pandas",
    "preview_rows",
    "rename_columns",
    "select_columns",
    "sort_multi_key",
    "split_review_timestamp",
    "stamp_load_time",
    "void_to_string",
]

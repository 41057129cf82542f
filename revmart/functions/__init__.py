from revmart.functions.dates import (
    date_from_iso,
    month_filter,
    month_key,
    time_of_day,
    year_key,
    year_month,
)
from revmart.functions.text import normalise_text, strip_accents, url_strip_query, xml_escape

__all__ = [
    "date_from_iso",
    "month_filter",
    "month_key",
    "normalise_text",
    "strip_accents",
    "time_of_day",
    "url_strip_query",
    "xml_escape",
    "year_key",
    "year_month",
]

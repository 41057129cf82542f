"""Review rows and feed pages derived, in Spark, from the ``documents`` table.

The pipeline's real input is a review feed of a mobile-app store. The test
tables carry no such feed, so these builders derive one deterministically
from ``documents`` (one review per document, whole text as the review body).
Work grows with the table; nothing is collected to the driver.

Review fixture "RV", per document:

* ``id`` = doc_id as text, ``content`` = the whole text,
  ``title`` = ``Review <doc_id> of <source>``;
* ``voteSum`` / ``voteCount`` = doc_id mod 3 / mod 5, ``rating`` = doc_id mod 5 + 1;
* ``version`` = source;
* ``updated`` = 2022-06-01 plus (doc_id mod 61) days and (doc_id mod 24)
  hours, written ``yyyy-MM-ddTHH:mm:ss-07:00``;
* ``contentType``, ``author``, ``link`` = NULL.

The expressions are Spark SQL text: the same plans as the Column API, built
with one parse on the JVM instead of hundreds of driver round trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from revmart.functions.text import xml_escape_sql as esc
from revmart.schemas import LANDING_COLUMNS

# Fixed values of the derived feed.
FEED_BASE = "https://reviews.example/app/feed"
ATOM_NS = "http://www.w3.org/2005/Atom"
STORE_NS = "https://reviews.example/ns/store"
FEED_START_DATE = "2022-06-01"
ENTRIES_PER_PAGE = 50


def review_fields_sql(doc_id: str, text: str, source: str) -> dict[str, str]:
    """The RV review fields of one document as SQL expressions."""
    return {
        "id": f"CAST({doc_id} AS STRING)",
        "title": f"concat('Review ', CAST({doc_id} AS STRING), ' of ', {source})",
        "content": text,
        "contentType": "CAST(NULL AS STRING)",
        "voteSum": f"CAST({doc_id} % 3 AS STRING)",
        "voteCount": f"CAST({doc_id} % 5 AS STRING)",
        "rating": f"CAST({doc_id} % 5 + 1 AS STRING)",
        "updated": (
            f"concat(date_format(date_add(DATE'{FEED_START_DATE}', CAST({doc_id} % 61 AS INT)), 'yyyy-MM-dd'),"
            f" 'T', lpad(CAST({doc_id} % 24 AS STRING), 2, '0'), ':00:00-07:00')"
        ),
        "version": source,
        "author": "CAST(NULL AS STRING)",
        "link": "CAST(NULL AS STRING)",
    }


def reviews_from_documents(docs: DataFrame) -> DataFrame:
    """Landing-shaped review rows (all strings, NULL void columns)."""
    f = review_fields_sql("doc_id", "text", "source")
    return docs.selectExpr(*[f"{f[c]} AS {c}" for c in LANDING_COLUMNS])


def page_url_sql(page_no: str) -> str:
    """URL of feed page ``page_no`` as the crawler requested it (with a query)."""
    return f"concat('{FEED_BASE}/page=', CAST({page_no} AS STRING), '/xml?cc=br&ref=crawl')"


def link_url_sql(page_no: str) -> str:
    """URL of page ``page_no`` as the feed links to it (a different query)."""
    return f"concat('{FEED_BASE}/page=', CAST({page_no} AS STRING), '/xml?urlDesc=/feed')"


def _element(tag: str, value: str) -> str:
    return f"'<{tag}>', {esc(value)}, '</{tag}>'"


def _link(rel: str, url: str) -> str:
    return f"'<link rel=\"{rel}\" href=\"', {esc(url)}, '\"/>'"


def entry_xml_sql(doc_id: str, text: str, source: str) -> str:
    """One ``<entry>`` per review, shaped like a store review feed entry."""
    r = review_fields_sql(doc_id, text, source)
    rid = esc(r["id"])
    parts = [
        "'<entry>'",
        _element("updated", r["updated"]),
        _element("id", r["id"]),
        _element("title", r["title"]),
        f"'<content type=\"text\">', {esc(r['content'])}, '</content>'",
        f"'<content type=\"html\">&lt;p&gt;review ', {rid}, '&lt;/p&gt;</content>'",
        "'<im:contentType term=\"Application\" label=\"App\"/>'",
        _element("im:voteSum", r["voteSum"]),
        _element("im:voteCount", r["voteCount"]),
        _element("im:rating", r["rating"]),
        _element("im:version", r["version"]),
        f"'<author><name>user ', {rid}, '</name><uri>{FEED_BASE}/user/', {rid}, '</uri></author>'",
        f"'<link rel=\"related\" href=\"{FEED_BASE}/review/', {rid}, '\"/>'",
        "'</entry>'",
    ]
    return f"concat({', '.join(parts)})"


def feed_pages_sql(entries_per_page: int = ENTRIES_PER_PAGE) -> str:
    """SQL over ``{docs}``: one Atom page per ``doc_id div entries_per_page``."""
    k = int(entries_per_page)
    last = f"(SELECT max(doc_id div {k}) FROM {{docs}})"
    # a page number is a run of ids; where ids repeat, its entries fill several pages of k
    number = "concat(CAST(page_no AS STRING), CASE WHEN part > 0 THEN concat('-', CAST(part AS STRING)) ELSE '' END)"
    header = ", ".join([
        f"'<feed xmlns:im=\"{STORE_NS}\" xmlns=\"{ATOM_NS}\">'",
        f"'<id>{FEED_BASE}</id><title>App reviews</title>'",
        f"'<link rel=\"alternate\" type=\"text/html\" href=\"{FEED_BASE}\"/>'",
        _link("self", page_url_sql(number)),
        _link("first", link_url_sql("0")),
        _link("last", link_url_sql(last)),
        f"CASE WHEN page_no < {last} THEN concat({_link('next', link_url_sql('page_no + 1'))}) ELSE '' END",
    ])
    body = f"array_join(transform(entries, e -> {entry_xml_sql('e.doc_id', 'e.text', 'e.source')}), '\\n')"
    return f"""
        SELECT page_no, {page_url_sql(number)} AS page_url,
               concat({header}, '\\n', {body}, '\\n</feed>') AS xml
        FROM (
            SELECT page_no, posexplode(transform(
                       sequence(0, (size(held) - 1) div {k}), i -> slice(held, CAST(i * {k} + 1 AS INT), {k})
                   )) AS (part, entries)
            FROM (
                SELECT doc_id div {k} AS page_no,
                       array_sort(collect_list(struct(doc_id, text, source))) AS held
                FROM {{docs}}
                GROUP BY doc_id div {k}
            )
        )
    """


def feed_pages_from_documents(docs: DataFrame, entries_per_page: int = ENTRIES_PER_PAGE) -> DataFrame:
    """``(page_no, page_url, xml)``: the RV reviews as paginated Atom pages.

    Page ``p`` holds the documents with ``doc_id div entries_per_page = p``;
    ``doc_id`` is the table's key, so that is at most ``entries_per_page``
    entries (a bounded group). Should ids repeat, further pages ``p-1``,
    ``p-2`` ... hold the rest. Every page links to the last page; all but the last link to the next one. The last page number
    is a scalar subquery (one value), not a join. Only the raw columns cross
    the shuffle; the entry markup is built after it, per page.
    """
    return docs.sparkSession.sql(feed_pages_sql(entries_per_page), docs=docs)

"""Atom review feed pages -> review rows, page links and the last-page flag.

A page table has one row per landed feed page: ``page_url`` and ``xml``.
Parsing is ``from_xml`` on executors (one JVM parse per page, no Python), so
pages spread over tasks like any other rows. Entries and links are read with
schemas of their own, so reading two links builds no review.

Semantics kept from the original per-page parser:

* namespace prefixes are dropped from tag names (``im:rating`` -> ``rating``);
* a ``content`` child counts only when its ``type`` attribute is ``text``;
* a repeated tag keeps its last occurrence;
* only an element's direct text is taken, so ``contentType``, ``author`` and
  ``link`` (attributes / nested children only) land as NULL, as does any
  empty element;
* surrounding whitespace is kept;
* a malformed page fails the job (``FAILFAST``). Readers of links and
  ``parse_pages`` also take ``mode="PERMISSIVE"``, which gives NULL fields for
  it; readers of entries refuse that mode, since they would lose the page
  (``landing_job`` puts such pages in quarantine).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.functions.text import url_strip_query
from revmart.schemas import FEED_PAGE_XML_SCHEMA, FEED_TEXT_TAGS, FEED_VOID_TAGS, LANDING_COLUMNS, PAGE_SCHEMA


CORRUPT = "_corrupt_record"


def _xml_options(mode: str) -> dict[str, str]:
    opts = {
        "ignoreNamespace": "true",
        "ignoreSurroundingSpaces": "false",
        "mode": mode,
    }
    if mode == "PERMISSIVE":
        opts["columnNameOfCorruptRecord"] = CORRUPT
    return opts


def _only(field: str) -> T.StructType:
    return T.StructType([FEED_PAGE_XML_SCHEMA[field]])


def _refuse_permissive(mode: str) -> None:
    if mode != "FAILFAST":
        raise ValueError("a permissive reader of entries would drop malformed pages; use landing_job with a quarantine zone")


def parse_pages(pages: DataFrame, mode: str = "FAILFAST", schema: T.StructType = FEED_PAGE_XML_SCHEMA) -> DataFrame:
    """Add a parsed ``feed`` struct (``link`` and ``entry`` arrays) to each page. [O-01]

    In ``PERMISSIVE`` mode the struct also carries ``_corrupt_record``: the
    raw text of a page that failed to parse (NULL for good pages).
    """
    if mode == "PERMISSIVE":
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return pages.withColumn("feed", F.from_xml(F.col("xml"), schema, _xml_options(mode)))


def bad_pages(pages: DataFrame) -> DataFrame:
    """Pages whose XML does not parse, as landed (``page_url``, ``xml``)."""
    parsed = parse_pages(pages, "PERMISSIVE")
    return parsed.where(F.col(f"feed.{CORRUPT}").isNotNull()).select("page_url", "xml")


def _last_where_sql(arr: str, pred: str, field: str) -> str:
    """``field`` of the last element of ``arr`` satisfying ``pred`` (NULL if none)."""
    return f"try_element_at(filter({arr}, x -> {pred}), -1).{field}"


def _text_sql(expr: str) -> str:
    # an empty element has no text in the original parser; from_xml gives ''
    return f"nullif({expr}, '')"


def _entry_field_sql(tag: str) -> str:
    if tag == "content":
        return _text_sql(_last_where_sql("e.content", "x._type = 'text'", "_VALUE"))
    if tag in FEED_VOID_TAGS:
        return "NULL"
    return _text_sql(f"e.{tag}")


ENTRY_FIELDS_SQL = [f"{_entry_field_sql(c)} AS {c}" for c in LANDING_COLUMNS]
assert all(t in LANDING_COLUMNS for t in FEED_TEXT_TAGS)


def feed_entries(pages: DataFrame, mode: str = "FAILFAST", keep_page_url: bool = False) -> DataFrame:
    """One row per ``entry`` of every page, landing-zone columns, all strings. [O-01]

    The attribute-only tags come out as typed-less NULL columns, exactly like
    an all-empty column of the original accumulated frame; ``void_to_string``
    repairs them before the sink.
    """
    _refuse_permissive(mode)
    return entries_of_parsed(parse_pages(pages, mode, _only("entry")), keep_page_url)


def entries_of_parsed(parsed: DataFrame, keep_page_url: bool = False) -> DataFrame:
    """``feed_entries`` on pages already passed through ``parse_pages``."""
    keep = ["page_url"] if keep_page_url else []
    # the outer form: explode() alone makes the optimizer test the array first, which parses the page again
    exploded = parsed.selectExpr(*keep, "explode_outer(feed.entry) AS e").where("e IS NOT NULL")
    return exploded.selectExpr(*keep, *ENTRY_FIELDS_SQL)


def xml_entry_records(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """``e`` (one entry) per ``entry`` element of landed XML files, and in
    ``PERMISSIVE`` mode ``_corrupt_record`` (the file's text, if the entry does
    not parse) and ``page_url`` (the file). [O-01]

    ``rowTag=entry`` streams each file record by record, so a large file is
    never materialised as one giant string row (as ``read_pages(fmt="xml")``
    does with a page). The source does not split an XML file (one task per
    file; its ``multiLine=false`` mode means one record per line, which feed
    texts with newlines break), so land feeds as many page-sized files for
    parallelism.
    """
    fields = list(FEED_PAGE_XML_SCHEMA["entry"].dataType.elementType.fields)
    names = [f.name for f in fields]
    kept = ["struct({}) AS e".format(", ".join(f"`{n}`" for n in names))]
    if mode == "PERMISSIVE":
        fields.append(T.StructField(CORRUPT, T.StringType()))
        kept += [CORRUPT, "_metadata.file_path AS page_url"]
    reader = spark.read.format("xml").option("rowTag", "entry").options(**_xml_options(mode))
    return reader.schema(T.StructType(fields)).load(path).selectExpr(*kept)


def entries_of_records(records: DataFrame) -> DataFrame:
    """Landing-zone columns of the records that parsed."""
    if CORRUPT in records.columns:
        records = records.where(F.col(CORRUPT).isNull())
    return records.selectExpr(*ENTRY_FIELDS_SQL)


def entries_from_xml_files(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Entries straight from landed XML files via the XML data source. [O-01]

    Same field semantics as ``feed_entries``; page-level links are not read
    (use ``read_pages`` + ``feed_links`` for those).
    """
    _refuse_permissive(mode)
    return entries_of_records(xml_entry_records(spark, path, mode))


def feed_content_text(pages: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Entry id with its text-typed ``content`` child (html children skipped). [O-02]"""
    return feed_entries(pages, mode).select("id", "content")


#: Tags of a feed page that the pipeline reads or knows to be without direct text.
KNOWN_TAGS = {"feed", "entry", "name", "uri", *FEED_TEXT_TAGS, *FEED_VOID_TAGS}


def unknown_tags(pages: DataFrame) -> DataFrame:
    """``tag`` and ``count`` of elements that landing does not keep, so that a
    feed's new tags are noticed. [O-01]

    Names are read off the markup (comments and CDATA aside; text cannot hold
    a raw ``<``), without prefixes and whatever their depth.
    """
    markup = F.regexp_replace("xml", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    names = F.regexp_extract_all(markup, F.lit(r"<(?:[\w.-]+:)?([\w.-]+)"), 1)
    found = pages.select(F.explode(F.filter(names, lambda n: ~n.isin(*sorted(KNOWN_TAGS)))).alias("tag"))
    return found.groupBy("tag").agg(F.count("*").alias("count"))


def feed_links(pages: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Per page: ``href`` of the last ``rel='next'`` and ``rel='last'`` links. [O-03]"""
    return parse_pages(pages, mode, _only("link")).selectExpr(
        "page_url",
        _last_where_sql("feed.link", "x._rel = 'next'", "_href") + " AS link_next",
        _last_where_sql("feed.link", "x._rel = 'last'", "_href") + " AS link_last",
    )


def feed_last_page(pages: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Per page: is it the last page (URLs compared without their query string)? [O-04, O-27]"""
    return feed_links(pages, mode).select(
        "page_url",
        "link_next",
        "link_last",
        (url_strip_query("page_url") == url_strip_query("link_last")).alias("is_last_page"),
    )


def union_pages(*frames: DataFrame) -> DataFrame:
    """Stack batches of entries by column name; a column missing in a batch is NULL. [O-05]"""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def frame_from_entries(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Small driver-side entry dicts (tests, fixtures) -> a DataFrame. [O-06]

    Keys may differ between entries: the columns are the union of keys in
    first-seen order, all strings, absent keys NULL - the shape a stack of
    per-page record frames had. Not for bulk data: pages go through
    ``feed_entries`` on executors.
    """
    names: dict[str, None] = {}
    for e in entries:
        names.update(dict.fromkeys(e))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], schema)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages: a ``(page_url, xml)`` table, or a folder of raw XML files.

    For raw files each file is one page and its URL is the feed's own
    ``rel='self'`` link (the file path when there is none, or when the page
    does not parse: whoever reads its entries decides about that).
    """
    if fmt == "parquet":
        return spark.read.schema(PAGE_SCHEMA).parquet(path)
    raw = spark.read.text(path, wholetext=True).select(
        F.col("value").alias("xml"), F.col("_metadata.file_path").alias("file_path")
    )
    links = parse_pages(raw, "PERMISSIVE", _only("link"))
    own = F.expr(_text_sql(_last_where_sql("feed.link", "x._rel = 'self'", "_href")))
    return links.select(F.coalesce(own, F.col("file_path")).alias("page_url"), "xml")

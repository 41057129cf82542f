"""Feed page parsing: the literal cases of the original parser's semantics."""

import pytest
from pyspark.sql import functions as F

from revmart.operators.conform import void_to_string
from revmart.sources.feed import (
    entries_from_xml_files,
    feed_content_text,
    feed_entries,
    feed_last_page,
    feed_links,
    read_pages,
    union_pages,
)

HEAD = '<feed xmlns:im="https://x/ns/store" xmlns="http://www.w3.org/2005/Atom">'
LINKS = (
    '<link rel="alternate" type="text/html" href="https://x/app"/>'
    '<link rel="self" href="https://x/p=1/xml?cc=br"/>'
    '<link rel="last" href="https://x/p=3/xml?urlDesc=/a"/>'
    '<link rel="next" href="https://x/p=2/xml?urlDesc=/b"/>'
)
ENTRY_FULL = (
    "<entry><updated>2022-06-30T23:30:11-07:00</updated><id>11</id>"
    "<title>First</title><title>Second</title>"
    '<content type="text">  body &amp; more \n</content>'
    '<content type="html">&lt;p&gt;html&lt;/p&gt;</content>'
    '<im:contentType term="Application" label="App"/>'
    "<im:voteSum>1</im:voteSum><im:voteCount></im:voteCount><im:rating>5</im:rating>"
    "<im:version>1.2.3</im:version>"
    "<author><name>someone</name><uri>https://x/u</uri></author>"
    '<link rel="related" href="https://x/r/11"/></entry>'
)
ENTRY_SPARSE = '<entry><id>12</id><content type="html">only html</content></entry>'


def _pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_url string, xml string")


def test_entry_semantics(spark):
    pages = _pages(spark, ("https://x/p=1/xml?cc=br", HEAD + LINKS + ENTRY_FULL + ENTRY_SPARSE + "</feed>"))
    rows = {r.id: r for r in void_to_string(feed_entries(pages)).collect()}
    full, sparse = rows["11"], rows["12"]
    assert full.title == "Second"  # repeated tag: last wins
    assert full.content == "  body & more \n"  # text child only, blanks kept
    assert full.rating == "5" and full.version == "1.2.3"  # namespace dropped
    assert full.voteSum == "1" and full.voteCount is None  # empty element -> NULL
    assert full.updated == "2022-06-30T23:30:11-07:00"
    assert full.contentType is None and full.author is None and full.link is None
    assert sparse.content is None and sparse.title is None  # html only / missing tag


def test_unknown_tags_are_counted(spark):
    from revmart.sources.feed import unknown_tags

    extra = '<entry><id>1</id><im:price a="1">2</im:price><!-- <no/> --><title><![CDATA[<not>]]></title><im:price/><new/></entry>'
    pages = _pages(spark, ("u", HEAD + LINKS + ENTRY_FULL + extra + "</feed>"), ("v", HEAD + ENTRY_FULL + "</feed>"))
    assert {tuple(r) for r in unknown_tags(pages).collect()} == {("price", 2), ("new", 1)}


def test_void_columns_become_string(spark):
    pages = _pages(spark, ("u", HEAD + ENTRY_FULL + "</feed>"))
    raw = feed_entries(pages)
    assert dict(raw.dtypes)["author"] == "void"
    assert dict(void_to_string(raw).dtypes)["author"] == "string"


def test_links_and_last_page(spark):
    last = HEAD + '<link rel="last" href="https://x/p=3/xml?urlDesc=/a"/>' + ENTRY_SPARSE + "</feed>"
    no_last = HEAD + '<link rel="next" href="https://x/p=2/xml"/></feed>'
    empty_link = HEAD + "<link/></feed>"
    pages = _pages(
        spark,
        ("https://x/p=1/xml?cc=br", HEAD + LINKS + "</feed>"),
        ("https://x/p=3/xml?cc=br", last),
        ("https://x/p=3/xml", last),
        ("https://x/p=9/xml", no_last),
        ("https://x/p=8/xml", empty_link),
    )
    got = {r.page_url: r for r in feed_last_page(pages).collect()}
    assert got["https://x/p=1/xml?cc=br"].link_next == "https://x/p=2/xml?urlDesc=/b"
    assert got["https://x/p=1/xml?cc=br"].is_last_page is False
    assert got["https://x/p=3/xml?cc=br"].is_last_page is True  # queries differ, bases equal
    assert got["https://x/p=3/xml"].is_last_page is True  # without a query string
    assert got["https://x/p=9/xml"].link_last is None and got["https://x/p=9/xml"].is_last_page is None
    assert got["https://x/p=8/xml"].link_next is None


def test_broken_page_fails_fast_or_nulls(spark):
    pages = _pages(spark, ("u", HEAD + "<entry><id>1</id></feed>"))
    with pytest.raises(Exception):
        feed_entries(pages).collect()
    assert feed_links(pages, mode="PERMISSIVE").first().link_last is None
    # readers of entries would lose the page: they refuse the mode
    for read in (feed_entries, feed_content_text):
        with pytest.raises(ValueError):
            read(pages, mode="PERMISSIVE")
    with pytest.raises(ValueError):
        entries_from_xml_files(spark, "/nonexistent", "PERMISSIVE")


def test_union_pages_fills_missing_columns(spark):
    pages = _pages(spark, ("u", HEAD + ENTRY_FULL + ENTRY_SPARSE + "</feed>"))
    e = feed_entries(pages)
    a = e.where(F.col("id") == "11").select("id", "title")
    b = e.where(F.col("id") == "12").select("id", "content")
    rows = {r.id: r for r in union_pages(a, b).collect()}
    assert rows["11"].content is None and rows["11"].title == "Second"
    assert rows["12"].title is None


def test_generated_feed_round_trip(spark, sf001):
    from revmart.sources.fixtures import feed_pages_from_documents, reviews_from_documents

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    parsed = void_to_string(feed_entries(feed_pages_from_documents(docs).select("page_url", "xml")))
    assert parsed.exceptAll(reviews_from_documents(docs)).count() == 0
    assert reviews_from_documents(docs).exceptAll(parsed).count() == 0


def test_frame_from_entries_unions_keys(spark):
    from revmart.sources.feed import frame_from_entries

    df = frame_from_entries(spark, [{"id": "1", "title": "a"}, {"id": "2", "rating": "5"}])
    assert df.columns == ["id", "title", "rating"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "a", None), ("2", None, "5")]


def test_feed_builder_splits_pages_of_repeated_ids(spark, sf001):
    from revmart.sources.fixtures import feed_pages_from_documents

    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    pages = feed_pages_from_documents(docs.unionAll(docs)).select("page_url", "xml")
    assert pages.select("page_url").distinct().count() == pages.count()
    per_page = [r["count"] for r in feed_entries(pages, keep_page_url=True).groupBy("page_url").count().collect()]
    assert max(per_page) == 50 and sum(per_page) == 2 * docs.count()


def _parses(df):
    return df._jdf.queryExecution().executedPlan().toString().count("from_xml(")


def test_a_page_is_parsed_once(spark, tmp_path):
    from revmart.plans.jobs import landing_frame

    spark.createDataFrame([("u", HEAD + LINKS + ENTRY_FULL + "</feed>")], "page_url string, xml string").write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    for read in (feed_entries, feed_content_text, feed_links, feed_last_page, landing_frame):
        assert _parses(read(pages)) == 1, read
    # a reader of links builds no entry
    assert "rating" not in feed_links(pages)._jdf.queryExecution().executedPlan().toString()


def test_page_url_from_any_self_link(spark, tmp_path):
    links = [
        '<link href="https://x/p=1/xml?a=1&amp;b=2" rel="self"/>',
        "<link rel='self' href='https://x/p=2/xml'/>",
        '<link type="t"\n rel="self"\n href="https://x/p=3/xml?cc=br"/>',
    ]
    for i, link in enumerate(links):
        last = '<link rel="last" href="https://x/p=3/xml?urlDesc=/a"/>'
        (tmp_path / f"p{i}.xml").write_text(HEAD + link + last + ENTRY_SPARSE + "</feed>", encoding="utf-8")
    (tmp_path / "broken.xml").write_text(HEAD + "<entry>", encoding="utf-8")
    pages = read_pages(spark, str(tmp_path), fmt="xml")
    urls = {r.page_url for r in pages.collect()}
    assert {"https://x/p=1/xml?a=1&b=2", "https://x/p=2/xml", "https://x/p=3/xml?cc=br"} < urls
    assert any(u.endswith("broken.xml") for u in urls)
    good = feed_last_page(pages.where("page_url like 'https%'")).collect()
    assert {r.page_url: r.is_last_page for r in good} == {
        "https://x/p=1/xml?a=1&b=2": False, "https://x/p=2/xml": False, "https://x/p=3/xml?cc=br": True,
    }


def test_read_raw_xml_page_files(spark, tmp_path):
    from revmart.sources.feed import read_pages

    for i, body in enumerate([HEAD + LINKS + ENTRY_FULL + "</feed>", HEAD + ENTRY_SPARSE + "</feed>"]):
        (tmp_path / f"page{i}.xml").write_text(body, encoding="utf-8")
    pages = read_pages(spark, str(tmp_path), fmt="xml")
    urls = [r.page_url for r in pages.collect()]
    assert "https://x/p=1/xml?cc=br" in urls  # taken from the rel="self" link
    assert any(u.endswith("page1.xml") for u in urls)  # no self link: the file path
    assert sorted(r.id for r in feed_entries(pages).collect()) == ["11", "12"]


def test_pretty_printed_page_with_declaration_and_cdata(spark):
    xml = (
        '<?xml version="1.0" encoding="utf-8"?>\n' + HEAD
        + "\n  <author><name>Store</name></author>\n  <updated>2022-07-01T00:00:00-07:00</updated>"
        + '\n  <link rel="last" href="https://x/p=2/xml?a=1"/>'
        + "\n  <entry>\n    <id>1</id>\n    <title>  spaced  </title>"
        + '\n    <content type="text"><![CDATA[a <b> & c]]></content>\n    <im:rating>4</im:rating>\n  </entry>'
        + "\n  <entry>\n    <id>2</id>\n    <title/>\n  </entry>\n</feed>\n"
    )
    rows = {r.id: r for r in feed_entries(_pages(spark, ("u", xml))).collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"].title, rows["1"].content, rows["1"].rating) == ("  spaced  ", "a <b> & c", "4")
    assert rows["2"].title is None


def test_read_page_table(spark, sf001):
    from revmart.plans import catalog
    from revmart.session import scratch_path
    from revmart.sources.feed import read_pages

    path = scratch_path(spark, "t-pages")
    catalog.pages(spark, sf001).write.parquet(path)
    pages = read_pages(spark, path)
    assert pages.columns == ["page_url", "xml"]
    assert feed_entries(pages).count() == spark.read.parquet(f"{sf001}/documents.parquet").count()


def test_entries_from_xml_files_match_page_parsing(spark, sf001, tmp_path):
    from revmart.plans import catalog
    from revmart.sources.feed import entries_from_xml_files

    pages = catalog.pages(spark, sf001)
    for i, r in enumerate(pages.limit(3).collect()):
        (tmp_path / f"p{i}.xml").write_text(r.xml, encoding="utf-8")
    from_files = void_to_string(entries_from_xml_files(spark, str(tmp_path)))
    from_pages = void_to_string(feed_entries(spark.createDataFrame(pages.limit(3).collect())))
    assert from_files.count() == from_pages.count() > 0
    assert from_files.exceptAll(from_pages).count() == 0


def test_feed_round_trip_preserves_arbitrary_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from revmart.sources.fixtures import feed_pages_from_documents

    # characters XML 1.0 can carry (no other C0 controls, surrogates or U+FFFE/FFFF)
    xml_char = st.characters(
        blacklist_categories=("Cs",),
        blacklist_characters=[chr(c) for c in range(0x20) if c not in (9, 10, 13)] + ["￾", "￿"],
    )
    texts = st.lists(st.text(xml_char, max_size=60), min_size=1, max_size=40)

    @settings(max_examples=12, deadline=None, derandomize=True, database=None)
    @given(texts)
    def check(values):
        docs = spark.createDataFrame(
            [(i, v, "src") for i, v in enumerate(values)], "doc_id long, text string, source string"
        )
        pages = feed_pages_from_documents(docs).select("page_url", "xml")
        got = {int(r.id): r.content for r in feed_entries(pages).collect()}
        assert len(got) == len(values)
        for i, v in enumerate(values):
            assert got[i] == (v if v != "" else None), (v, got[i])

    check()

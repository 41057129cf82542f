from revmart.sources.feed import (
    bad_pages,
    entries_from_xml_files,
    feed_content_text,
    feed_entries,
    feed_last_page,
    feed_links,
    frame_from_entries,
    parse_pages,
    read_pages,
    union_pages,
)
from revmart.sources.fixtures import feed_pages_from_documents, reviews_from_documents
from revmart.sources.zones import layout_for_write, read_landing, read_zone, write_zone

__all__ = [
    "bad_pages",
    "entries_from_xml_files",
    "feed_content_text",
    "feed_entries",
    "feed_last_page",
    "feed_links",
    "feed_pages_from_documents",
    "frame_from_entries",
    "layout_for_write",
    "parse_pages",
    "read_landing",
    "read_pages",
    "read_zone",
    "reviews_from_documents",
    "union_pages",
    "write_zone",
]

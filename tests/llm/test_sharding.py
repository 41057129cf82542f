"""Sharding: balance, groups, slots and edge cases."""

import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from revmart.llm import registry
from revmart.llm.sharding import shard_documents


def _check(rows, shards):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    assert set(by_shard) <= set(range(shards))
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {s: sum(r.size for r in by_shard[s]) for s in range(shards)}


def test_query_balances_bytes_and_keeps_groups(spark, sf01):
    rows = registry.QUERIES["op4_histogram_shards"](spark, sf01).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    assert all(r.size == len(docs[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in rows)
    sizes = _check(rows, 24)
    largest = max(r.size for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    shards_of = defaultdict(set)
    for r in rows:
        shards_of[docs[r.doc_id]].add(r.shard)
    assert max(len(s) for s in shards_of.values()) == 1


def test_hot_text_is_split_and_the_rest_stays_together(spark, make_docs):
    hot = [(i, "the same text " * 20) for i in range(600)]
    others = [(1000 + i, f"text {i // 2} " * 25) for i in range(1200)]
    docs = make_docs(hot + others)
    rows = shard_documents(docs, shards=12).collect()
    sizes = _check(rows, 12)
    mean = sum(sizes.values()) / 12
    assert all(abs(s - mean) <= 0.05 * mean for s in sizes.values())
    shards_of = defaultdict(set)
    for r in rows:
        shards_of[r.text].add(r.shard)
    assert len(shards_of["the same text " * 20]) >= 3
    assert sum(len(s) > 1 for s in shards_of.values()) <= 6


def test_partitioning_changes_nothing(spark, make_docs):
    docs = make_docs([(i, f"t{i % 37} " * (i % 11)) for i in range(400)])
    one = {(r.doc_id, r.shard, r.slot) for r in shard_documents(docs, shards=5, rows_per_slot_range=30).collect()}
    two = {(r.doc_id, r.shard, r.slot) for r in shard_documents(docs.repartition(9), shards=5, rows_per_slot_range=30).collect()}
    assert one == two


def test_edge_cases(spark, make_docs):
    assert shard_documents(make_docs([])).count() == 0
    rows = shard_documents(make_docs([(1, None), (2, ""), (2, ""), (None, "é" * 9), (4, "x" * 200_000)]), shards=3).collect()
    _check(rows, 3)
    assert Counter(r.size for r in rows) == Counter([8, 8, 8, 26, 200_008])
    clash = make_docs([(1, "a"), (2, "b")]).selectExpr("*", "'x' as shard", "1 as slot", "2 as keep")
    found = shard_documents(clash, shards=2)
    assert len(found.columns) == len(set(found.columns)) and "keep" in found.columns
    _check(found.collect(), 2)


def test_repeated_rows_are_cut_by_number(spark, make_docs):
    docs = make_docs([(1, "one row " * 12)] * 2000 + [(10 + i, f"text {i:04} " * 10) for i in range(2000)])
    rows = shard_documents(docs, shards=24, rows_per_slot_range=50).collect()
    assert len(rows) == 4000
    sizes = _check(rows, 24)
    mean = sum(sizes.values()) / 24
    assert all(abs(s - mean) <= max(0.01 * mean, max(r.size for r in rows)) for s in sizes.values())
    again = shard_documents(docs.repartition(7), shards=24, rows_per_slot_range=50).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in rows) == Counter((r.doc_id, r.shard, r.slot) for r in again)


def test_splitters_equal_a_sort(spark, make_docs):
    docs = make_docs([(i, f"t{i % 400} " * (1 + i % 13)) for i in range(900)])
    rows = shard_documents(docs, shards=8, tolerance=0.0, together=0.0).select(
        "size", "shard", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("k1"), F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("slot")), 1).alias("k2")
    ).collect()
    rows.sort(key=lambda r: (r.k1, r.k2))
    total, below, largest = sum(r.size for r in rows), 0, max(r.size for r in rows)
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    for before, r in zip([None, *rows], rows, strict=False):
        if before is not None and before.shard != r.shard:
            # the boundary is the place nearest to the shard's share of all bytes
            assert abs(below - total * r.shard / 8) <= largest / 2 + 1
        below += r.size

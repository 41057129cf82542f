"""Mixing: targets, cut and edge cases."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from revmart.llm import registry
from revmart.llm.mixing import SEED, mix_counts, mix_sources, mixture, taken_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _targets(sizes, weights=(1, 2, 3), cap=3.0):
    """Brute force: shares by weight, capped, the excess shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        rate = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if rate * weight[s] >= cap * sizes[s]}
        if not over:
            target |= {s: rate * weight[s] for s in open_}
            break
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return target


def _check(docs, mixed):
    rows = mixed.collect()
    sizes = defaultdict(int)
    largest = defaultdict(int)
    for r in docs.collect():
        n = len(WORD.findall(r.text or ""))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    assert len(rows) == docs.count()
    want, taken = _targets(sizes), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size) and r.copies == len(r.virtual_times)
        taken[r.source] += r.taken
    total = sum(sizes.values())
    assert sum(taken.values()) <= total
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(largest.values()) + 1, s
    return rows


def test_whole_table_meets_targets(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    first = _check(docs, mix_sources(docs))
    again = mix_sources(docs.repartition(7), rows_per_bucket=20_000).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_small_buckets_give_the_same_kind_of_mix(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    _check(docs, mix_sources(docs, rows_per_bucket=9))


def test_edge_cases(spark, make_docs):
    rows = [(1, "a b c", "é"), (2, None, "é"), (3, "", "z"), (4, "d " * 500, None), (4, "d " * 500, None), (None, "e", "z"), (6, " \t", "empty")]
    rows += [(10 + i, "x y", "hot") for i in range(60)]
    docs = make_docs(rows)
    found = _check(docs, mix_sources(docs))
    assert all(r.taken == 0 for r in found if r.size == 0)
    assert mix_sources(make_docs([])).count() == 0
    assert mix_sources(make_docs([(1, None, None)])).collect()[0].taken == 0


def test_clashing_columns_are_replaced(spark, make_docs):
    docs = make_docs([(1, "a b", "s"), (2, "c", "s")]).selectExpr("*", "'x' as size", "7 as taken", "0 as extra")
    mixed = mix_sources(docs)
    assert len(mixed.columns) == len(set(mixed.columns)) and "extra" in mixed.columns
    assert sorted((r.doc_id, r.size, r.taken) for r in mixed.collect()) == [(1, 2, 2), (2, 1, 1)]


def test_mixture_is_sorted_and_repeats_small_sources(spark, make_docs):
    docs = make_docs([(i, "a b c d", "big") for i in range(40)] + [(100 + i, "e f", "small") for i in range(5)])
    rows = mixture(docs).collect()
    assert [r.virtual_time for r in rows] == sorted(r.virtual_time for r in rows)
    assert sum(r.source == "small" for r in rows) == 15


def test_plan_is_native(spark, sf001):
    plan = registry.QUERIES["op2_weighted_fair_mix"](spark, sf001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def sorted_mix(docs):
    """Brute force: all copies of all documents in one list, sorted by virtual time and cut at the budget."""
    rows = docs.withColumn("place", F.xxhash64(F.lit(SEED), "doc_id", "text")).collect()
    by_source, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        n = len(WORD.findall(r.text or ""))
        by_source[r.source].append((r.place, r.doc_id is not None, r.doc_id or 0, n))
        sizes[r.source] += n
    targets, clock = _targets(sizes), []
    for s, own in by_source.items():
        end = 0
        for place, named, i, n in sorted(own):
            end += n
            if n and targets[s]:
                clock += [((sizes[s] * e + (end - n / 2)) / targets[s], s is None, (s or "").encode(), place, named, i, n, end) for e in range(3)]
    left, taken = sum(sizes.values()), Counter()
    for _, nameless, s, _, named, i, n, _ in sorted(clock):
        left -= n
        if left < 0:
            break
        taken[None if nameless else s.decode(), i if named else None, n] += n
    return taken


def test_taken_words_equal_a_global_sort(spark, sf01, make_docs):
    heavy = [(7, "same words here", "a")] * 300 + [(i, f"t{i} " * (i % 9), "ba"[i % 2]) for i in range(10, 200)] + [(None, "no id at all", None)] * 50
    for docs in (spark.read.parquet(f"{sf01}/documents.parquet"), make_docs(heavy)):
        want = sorted_mix(docs)
        for mixed in (mix_counts(docs), mix_sources(docs)):
            found = Counter()
            for r in mixed.where("taken > 0").collect():
                found[r.source, r.doc_id, r.size] += r.taken
            assert found == want
        taken = Counter()
        for r in taken_documents(docs).collect():
            n = len(WORD.findall(r.text))
            taken[r.source, r.doc_id, n] += n
        assert taken == want


def test_taken_documents_move_no_text(spark, sf01, make_docs):
    taken = taken_documents(spark.read.parquet(f"{sf01}/documents.parquet"))
    plan = taken._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert "text#" in plan and "Python" not in plan
    assert all("BroadcastExchange" in line for line in exchanges), exchanges
    clash = make_docs([(1, "a b", "s"), (2, "c", "s"), (2, None, "t")]).selectExpr("*", "'x' as size", "7 as taken", "0 as __keep")
    rows = taken_documents(clash).collect()
    assert sorted((r.doc_id, r.size, r.taken) for r in rows) == [(1, "x", 7), (2, "x", 7)]
    assert taken_documents(make_docs([])).count() == 0

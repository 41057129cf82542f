"""Removal of repeated passages against a set of all windows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import prose, thue_morse
from revmart.llm import registry, substrings
from revmart.llm.automaton import SuffixAutomaton
from revmart.llm.substrings import remove_repeats
from revmart.llm.words import gram_hashes, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=20):
    """{(id, text): (words, removed, kept)}; rows sharing an id are one document."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for i, text in order:
        words = WORD.findall(text or "")
        for s in range(len(words) - window + 1):
            key, place = tuple(words[s : s + window]), (i is None, i or 0, s)
            first[key] = min(first.get(key, place), place)
    out = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        keep = [True] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (i is None, i or 0, s):
                keep[s : s + window] = [False] * window
        kept = [w for w, k in zip(words, keep, strict=True) if k]
        out[i, text] = (len(words), len(words) - len(kept), " ".join(kept))
    return out


def found_of(df):
    return {(r.doc_id, r.text): (r.n_words, r.n_removed, r.kept_text) for r in df.collect()}


def test_query_equals_brute_force(spark, sf01):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()]
    rows = registry.QUERIES["op10_suffix_automata_substrings"](spark, sf01).collect()
    want = {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for (i, _), (n, k, t) in brute(docs).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want


@pytest.mark.parametrize("heavy", [1000, 2])
def test_overlapping_passages_equal_brute_force(spark, make_docs, heavy):
    rng = random.Random(heavy)
    passages = [prose(k, n).split() for k, n in enumerate((21, 60, 35, 24, 200))]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) - 5)
            words += prose(1000 * i + len(words), rng.randint(0, 12)).split() + p[a : a + rng.randint(5, 60)]
        rows.append((500 - i, " ".join(words)))
    rows += [(900 + i, "again and " * 30) for i in range(3)]
    assert found_of(remove_repeats(make_docs(rows), shard_passages=heavy)) == brute(rows)


@pytest.mark.parametrize(("window", "gram"), [(20, 5), (7, 3), (6, 3), (6, 5), (5, 5)])
def test_windows_around_heavy_anchors_equal_brute_force(spark, make_docs, window, gram):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("abc") if rng.random() < 0.9 else str(rng.random()) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(100 + i, f"{prose(i, 30)} the very common line {prose(7, 17)} {prose(500 + i, 20)}") for i in range(20)]
    assert found_of(remove_repeats(make_docs(rows), window=window, gram=gram, shard_passages=1)) == brute(rows, window)


def test_windows_are_made_only_where_half_of_one_recurs(spark):
    line = prose(1, 8).split()
    own = [prose(10 + k, 15).split() + line + prose(50 + k, 12).split() for k in range(6)]
    own.append(own[0][:10] + own[1][10:])  # passage 1 but for its first ten words: the eight before its line are others
    passages = [(1, k, 0, 0, 15, " ".join(w).encode()) for k, w in enumerate(own)]
    schema = "fp long, id long, tag long, start int, anchor int, words binary"
    assert substrings._windows(spark.createDataFrame(passages[:6], schema), 20, 5).count() == 0
    made = substrings._windows(spark.createDataFrame(passages, schema), 20, 5).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in made} == {1: 8, 6: 8}


def test_edge_cases(spark, make_docs):
    long = prose(1, 40_000)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, prose(4, 19)), (5, prose(4, 19)), (6, prose(6, 20)), (7, "\t" + prose(6, 20) + "\n"),
            (8, long), (9, "x " + long), (10, "a " * 300), (None, prose(6, 20)), (11, prose(11, 30)), (11, prose(11, 30)), (11, "y " + prose(11, 30))]
    assert found_of(remove_repeats(make_docs(rows))) == brute(rows)
    assert remove_repeats(make_docs([])).count() == 0
    assert found_of(remove_repeats(make_docs([(1, None)]))) == {(1, None): (0, 0, "")}


@pytest.mark.parametrize("bits", [5, 6, 24])
def test_anchors_of_texts_longer_than_places_can_be_told_apart(monkeypatch, bits):
    monkeypatch.setattr(substrings, "_PLACE_BITS", np.uint64(bits))
    for texts in ([prose(1, 1000)], ["a b " * 300], [prose(k, n) for k, n in enumerate((45, 3, 20, 400, 19, 64))]):
        (words,) = words_of(pa.array(texts))
        grams = gram_hashes(words.hashes, 5)
        cut = [int(g) >> bits for g in grams]
        want = set()
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            want |= {min(range(s, s + 16), key=lambda g: (cut[g], g)) for s in range(a, b - 19)}
        found, places = substrings._anchor_places(words, 20, 5)
        assert places.tolist() == sorted(want) and found.tolist() == grams[places].tolist()


@pytest.mark.parametrize("heavy", [1000, 1])
def test_one_copy_stays_in_rows_without_an_id(spark, make_docs, heavy):
    head = prose(1, 25)
    texts = [prose(2, 40)] * 3 + [f"{head} {prose(k, 30)}" for k in (3, 4, 5)] + ["of " + head, prose(6, 19), prose(6, 19)]
    cleaned = remove_repeats(make_docs([(None, t) for t in texts] + [(7, prose(7, 30))]).repartition(4), shard_passages=heavy)
    rows = [(r.text, r.n_removed) for r in cleaned.collect()]
    assert sorted(n for t, n in rows if t == texts[0]) == [0, 40, 40]
    assert sorted(n for t, n in rows if head in t) == [0, 25, 25, 25]
    assert sorted(n for t, n in rows if head not in t and t != texts[0]) == [0, 0, 0]


def test_clashing_columns(spark, make_docs):
    docs = make_docs([(1, prose(1, 25)), (2, prose(1, 25))]).selectExpr("*", "'a' as id", "2 as tag", "'s' as spans", "9 as n_words")
    rows = remove_repeats(docs)
    assert len(rows.columns) == len(set(rows.columns))
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.id, r.tag, r.spans) for r in rows.collect()) == [(1, 25, 0, "a", 2, "s"), (2, 25, 25, "a", 2, "s")]


def arrays(texts):
    """Letters, where each text begins, and places: text i's words from 100 i on."""
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    letters = np.array([w for t in texts for w in t], dtype=np.int64)
    return letters, first, np.array([100 * i + e for i, t in enumerate(texts) for e in range(len(t))], dtype=np.int64)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), min_size=1, max_size=6), st.integers(1, 6))
def test_automaton_knows_first_places(texts, window):
    letters, starts, places = arrays(texts)
    first = {}
    for i, words in enumerate(texts):
        for e in range(window - 1, len(words)):
            first.setdefault(tuple(words[e - window + 1 : e + 1]), i * 100 + e)
    want = [
        starts[i] + e
        for i, words in enumerate(texts)
        for e in range(window - 1, len(words))
        if first[tuple(words[e - window + 1 : e + 1])] < i * 100 + e
    ]
    assert SuffixAutomaton(letters, starts, places).earlier(letters, starts, places, window).tolist() == want


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 2), max_size=15), min_size=1, max_size=5),
    st.lists(st.lists(st.integers(0, 3), max_size=25), min_size=1, max_size=4),
    st.integers(1, 5),
)
def test_automaton_streams_other_sequences(texts, others, window):
    first = {}
    for i, words in enumerate(texts):
        for e in range(window - 1, len(words)):
            first.setdefault(tuple(words[e - window + 1 : e + 1]), i * 100 + e)
    letters, starts, places = arrays(others)
    places = places + 150
    want = [
        starts[i] + e
        for i, words in enumerate(others)
        for e in range(window - 1, len(words))
        if first.get(tuple(words[e - window + 1 : e + 1]), 10**6) < i * 100 + e + 150
    ]
    assert SuffixAutomaton(*arrays(texts)).earlier(letters, starts, places, window).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=15), min_size=1, max_size=5))
def test_states_are_classes_of_equal_ends(texts):
    ends = {}
    for i, words in enumerate(texts):
        for a in range(len(words)):
            for b in range(a + 1, len(words) + 1):
                ends.setdefault(tuple(words[a:b]), set()).add((i, b))
    automaton = SuffixAutomaton(*arrays(texts))
    assert len(automaton.length) == 1 + len({frozenset(x) for x in ends.values()})
    assert sorted(automaton.length[1:].tolist()) == sorted(
        max(len(w) for w, x in ends.items() if x == group) for group in {frozenset(x) for x in ends.values()}
    )


@pytest.mark.parametrize("order", [10, 11])
@pytest.mark.parametrize("shard", [1000, 1])
def test_words_that_confuse_polynomial_hashes_are_no_repeats(spark, make_docs, order, shard):
    a, b = thue_morse(order)
    tail = prose(7, 40)
    rows = [(0, " ".join([*[a] * 10, *tail.split()[:19]])), (1, " ".join([*[b] * 10, *tail.split()[:19]])), (2, " ".join(f"{a[:500 + i]}" for i in range(20)))]
    cleaned = remove_repeats(make_docs(rows), shard_passages=shard)
    assert [r.n_removed for r in cleaned.orderBy("doc_id").collect()] == [0, 0, 0]

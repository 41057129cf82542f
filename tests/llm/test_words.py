"""Word views and set signatures on arrays."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import thue_morse
from revmart.llm.neardup import superminhash
from revmart.llm.words import gram_hashes, joined_bytes, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\x0c\r\x1c\x85\xa0é漢😀Z.", max_size=20)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_equal_the_pattern(texts, chunk):
    column = pa.array([None, *texts], pa.string()).slice(1)
    found, hashes = [], {}
    for words in words_of(column, chunk_bytes=chunk):
        for i in range(len(words.rows)):
            span = range(words.first[i], words.first[i + 1])
            own = [words.data[words.starts[k] : words.ends[k]].tobytes().decode() for k in span]
            found.append(own)
            for w, k in zip(own, span, strict=True):
                assert hashes.setdefault(w, words.hashes[k]) == words.hashes[k]
    assert found == [WORD.findall(t or "") for t in texts]
    assert len(set(hashes.values())) == len(hashes)


def test_lower_case_and_letters():
    upper, lower = (next(words_of(pa.array([t]), lower=True)).hashes for t in ("The ÉND", "the ÉnD"))
    assert (upper == lower).all()
    words = next(words_of(pa.array(["a-b, c1d (é)"]), letters=True))
    assert [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)] == ["a", "b", "c", "d", "é"]


def test_gram_hashes_depend_on_order_and_length():
    h = np.arange(1, 6, dtype=np.uint64)
    grams = gram_hashes(h, 3)
    assert len(grams) == 3 and len(set(grams.tolist()) | set(gram_hashes(h[::-1], 3).tolist())) == 6
    assert len(gram_hashes(h, 6)) == 0


def _plain_superminhash(shingles, places):
    """One set at a time, one shingle at a time, without early stopping."""
    from revmart.llm.neardup import _draw

    best = [1 << 64] * places
    for s in shingles:
        order = list(range(places))
        one = np.array([s], dtype=np.uint64)
        for j in range(places):
            k = j + int(_draw(one, 2 * j)[0]) % (places - j)
            order[j], order[k] = order[k], order[j]
            best[order[j]] = min(best[order[j]], (j << 48) | int(_draw(one, 2 * j + 1)[0]) >> 16)
    return best


def test_early_stopping_changes_nothing():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 2, 7, 40, 300)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    found = superminhash(np.concatenate(sets), first, 16)
    assert found.tolist() == [_plain_superminhash(s.tolist(), 16) for s in sets]


def test_share_of_equal_places_estimates_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(30):
        common, a, b = np.split(rng.integers(0, 1 << 62, 300).astype(np.uint64), [200, 250])
        pair = [np.concatenate([common, a]), np.concatenate([common, b])]
        sig = superminhash(np.concatenate(pair), np.array([0, 250, 500]), 128)
        errors.append((sig[0] == sig[1]).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_words_of_the_thue_morse_kind_differ():
    for order in (10, 11, 12):
        a, b = thue_morse(order)
        words = next(words_of(pa.array([f"x {a} {b} x{a} x{b}"])))
        assert len(set(words.hashes.tolist())) == 5


def test_long_chunks_hash_alike():
    long = "ab " * 3_000_000  # more bytes than a plain sum can hold
    words = next(words_of(pa.array([long + "cd"])))
    assert len(set(words.hashes[:-1].tolist())) == 1
    assert words.hashes[-1] == next(words_of(pa.array(["cd"]))).hashes[0] and words.hashes[0] == next(words_of(pa.array(["ab"]))).hashes[0]


def test_joined_bytes():
    words = next(words_of(pa.array(["  É b\n\nC", None, "d", ""])))
    joined, first = joined_bytes(words, lower=True)
    assert joined == "É b c d ".encode() and first.tolist() == [0, 3, 5, 7, 9]

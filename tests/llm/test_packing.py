"""Packing: ids, pieces, capacity, density and edge cases."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revmart.llm import registry
from revmart.llm.encoding import byte_encoder
from revmart.llm.packing import pack_documents, pack_lengths, piece_starts, token_pieces


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(rows, tokenizer, sequence=2048):
    out = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        starts = piece_starts(len(ids), sequence)
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    return sorted(out, key=repr)


def check_layout(rows, sequence=2048):
    """Pieces of a sequence follow each other without a gap; returns the number of sequences."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end and length > 0
            end += length
        assert end <= sequence
    return len(by_sequence)


def pieces_of(rows):
    return sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr)


def test_query_is_exact_and_dense(spark, sf01, tokenizer):
    rows = registry.QUERIES["op7_sum_of_squares_packing"](spark, sf01).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()]
    assert pieces_of(rows) == expected(docs, tokenizer)
    least = -(-sum(r.length for r in rows) // 2048)
    assert check_layout(rows) <= 1.01 * least + 1


def test_edge_cases(spark, make_docs, tokenizer):
    rows = [(1, None), (2, ""), (2, ""), (None, "é漢😀 ​\x00 ~"), (4, "x" * 3000), (5, "ab " * 6000), (6, " " * 5000), (7, "<|endoftext|>x"), (8, "x <|endoftext|> y " * 3000)]
    found = pack_documents(make_docs(rows)).collect()
    assert pieces_of(found) == expected(rows, tokenizer)
    check_layout(found)
    assert pack_documents(make_docs([])).count() == 0


def test_groups_and_ids_column(spark, make_docs, tokenizer):
    docs = make_docs([(i, f"word{i} " * (i % 40)) for i in range(300)]).selectExpr("*", "1 as piece", "'x' as sequence_id", "2 as length")
    found = pack_documents(docs, docs_per_group=50, sequence=128, with_ids=True).collect()
    check_layout(found, 128)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)
    again = pack_documents(docs.repartition(5), docs_per_group=50, sequence=128).collect()
    assert {(r.doc_id, r.piece, r.sequence_id, r.offset) for r in found} == {(r.doc_id, r.piece, r.sequence_id, r.offset) for r in again}


def test_pieces_put_the_short_one_first(spark, make_docs):
    rows = sorted(token_pieces(make_docs([(1, "a b c d e f g")]), sequence=3).collect(), key=lambda r: r.piece)
    assert [(r.start, r.length) for r in rows] == [(0, 2), (2, 3), (5, 3)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_lengths_fit(lengths):
    where, offset = pack_lengths(np.array(lengths, dtype=np.int64), 30)
    used = {}
    for w, o, n in sorted(zip(where, offset, lengths, strict=True)):
        assert used.get(w, 0) == o
        used[w] = o + n
        assert used[w] <= 30


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'sreltvd 123\n\t\r.,;!éñßàø–“…  ", max_size=60))
def test_fast_ids_equal_the_tokenizer(text):
    encoder = byte_encoder()
    assert encoder.ids(text).tolist() == encoder._slow.encode(text, add_special_tokens=False).ids


def naive(lengths, sequence):
    """Every piece, largest first, where the sum of squared gap counts becomes least; the fullest of equals."""
    gaps, placed = [], []
    for size in sorted(lengths, reverse=True):
        best = None
        for at in {g for g in gaps if g >= size}:
            after = [g for g in gaps if g]
            after.remove(at)
            after += [at - size] if at > size else []
            cost = (sum(c * c for c in Counter(after).values()), at)
            best = min(best, cost) if best else cost
        at = best[1] if best else sequence
        if best:
            gaps.remove(at)
        gaps.append(at - size)
        placed.append((size, sequence - at))
    return placed, len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40))
def test_placement_equals_a_naive_loop(lengths):
    where, offset = pack_lengths(np.array(lengths, dtype=np.int64), 30)
    order = np.argsort(-np.array(lengths, dtype=np.int64), kind="stable")
    placed, sequences = naive(lengths, 30)
    assert [(lengths[i], int(offset[i])) for i in order] == placed
    assert len(set(where.tolist())) == sequences

"""Fill-in-the-middle: exact round trips and the rule in plain Python."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from revmart.llm.fill_middle import Piece, arrange, cut, digest, fill_in_middle, parts_of, restore, restored_digests, stream, write


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aé😀\n<>PSM ", max_size=30), st.text(alphabet="ab\n", max_size=5), st.data())
def test_arranged_texts_are_restored(text, before, data):
    if any(s in text for s in ("<P>", "<S>", "<M>")):
        return
    raw = (before + text).encode()
    start, size = len(before.encode()), len(text.encode())
    places = sorted(data.draw(st.lists(st.integers(0, size), min_size=2, max_size=2)))
    p, m, s = raw[start:][: places[0]], raw[start:][places[0] : places[1]], raw[start:][places[1] :]
    for form, want in (("psm", b"<P>" + p + b"<S>" + s + b"<M>" + m), ("spm", b"<S>" + s + b"<P>" + p + b"<M>" + m)):
        table = arrange(parts_of(start, size, (places[0], places[1])), form)
        assert b"".join(memoryview(x) for x in stream(table, memoryview(raw))) == want
        assert digest(table, memoryview(raw)) == hashlib.sha256(want).hexdigest()
        back = restore(want, 0, len(want), form)
        assert write(back, memoryview(want)) == text


def test_cuts_split_pieces():
    table = [Piece(0, 5, 4), Piece(0, 20, 3)]
    assert cut(table, 2) == 1 and table == [Piece(0, 5, 2), Piece(0, 7, 2), Piece(0, 20, 3)]
    assert cut(table, 4) == 2 and cut(table, 7) == 3 and cut(table, 0) == 0 and len(table) == 3


def plain(doc_id, text, rate=100):
    text = text or ""
    h = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 50 else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_edge_cases(spark, make_docs):
    long = "é word\n" * 200_000
    texts = [None, "", "\n", "\n\n", "no end", "a\nb", "é\n😀\n", "has <P> in it", "<M>", "x\r\ny\n", long, "a\nb", "<", "<\n<S"]
    rows = list(enumerate(texts)) + [(3, "other\ntext\nhere"), (3, "other\ntext\nhere")]
    for rate in (100, 40):
        docs = make_docs(rows).selectExpr("*", "1 as form", "'x' as extra")
        formed = fill_in_middle(docs, rate=rate)
        assert [c for c in formed.columns][-6:] == ["extra", "n_lines", "form", "prefix_chars", "middle_chars", "formed_text"]
        got = sorted((r.doc_id, r.n_lines, r.form, r.prefix_chars or -1, r.middle_chars or -1, r.formed_text) for r in formed.collect())
        want = [(i, *plain(i, t, rate)) for i, t in rows]
        assert got == sorted((i, n, f, p or -1, m or -1, t) for i, n, f, p, m, t in want)
        sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
        back = sorted((r.doc_id, r.output_sha256, r.restored_sha256) for r in restored_digests(formed).collect())
        assert back == sorted((i, sha(w[5]), sha(t)) for (i, t), w in zip(rows, want, strict=True))
    assert fill_in_middle(make_docs([])).count() == 0
    assert fill_in_middle(make_docs([(None, "a\nb\n")])).first().form in ("psm", "spm")

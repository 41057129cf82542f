"""Edit-aware counts against counting the edited text anew."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revmart.llm import registry
from revmart.llm.encoding import byte_encoder
from revmart.llm.token_counts import CountedText, count_documents, edit_documents, safe_leaves

EDITS = "array<struct<start:int,removed:int,inserted:string>>"
PIECES = st.text(alphabet="ab'sreltv \n\t.,é3!漢  ", max_size=40)


def plain_count(text):
    return len(byte_encoder()._slow.encode(text, add_special_tokens=False).ids)


def apply_plain(text, start, removed, inserted):
    start = min(max(start, 0), len(text))
    return text[:start] + inserted + text[start + max(removed, 0) :]


@settings(max_examples=300, deadline=None)
@given(PIECES, st.lists(st.tuples(st.integers(-2, 60), st.integers(0, 20), PIECES), max_size=6), st.sampled_from([1, 4, 16]))
def test_any_edits(text, edits, leaf):
    counted = CountedText(text, byte_encoder(), leaf)
    for e in edits:
        counted.edit(*e)
        text = apply_plain(text, *e)
        assert counted.text == text and counted.tree.n_tokens == plain_count(text)
        assert sum(counted.tree.leaf_chars()) == len(text)


def test_leaves_encode_alone(spark, sf001):
    for r in spark.read.parquet(f"{sf001}/documents.parquet").limit(40).collect():
        leaves = safe_leaves(r.text, 64)
        assert "".join(leaves) == r.text
        assert sum(plain_count(x) for x in leaves) == plain_count(r.text)


def test_query_equals_counting_anew(spark, sf001):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    rows = registry.QUERIES["op3_edit_aware_counts"](spark, sf001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id]
        after = apply_plain(text, len(text) // 4, 12, "an edit, isn't it?")
        after = apply_plain(after, len(text) // 2, 40, "") + text[:25]
        assert (r.n_chars_before, r.n_tokens_before, r.n_chars, r.n_tokens) == (len(text), plain_count(text), len(after), plain_count(after))
    # what is far from the edits is not encoded again
    assert sum(r.reencoded_chars for r in rows if r.n_chars > 20_000) < 0.2 * sum(r.n_chars for r in rows if r.n_chars > 20_000) + 1


def test_edge_cases(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (2, ""), (None, "a b"), (5, "word " * 60_000)]).selectExpr("*", "'x' as extra", "0 as n_tokens")
    counted = count_documents(docs)
    assert len(counted.columns) == len(set(counted.columns))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in counted.collect()) == [(0, 2), (1, 0), (2, 0), (2, 0), (5, plain_count("word " * 60_000))]
    edits = F.expr(f"cast(array(struct(null, 1, 'x'), null, struct(1, null, null), struct(1000000, 5, ' end')) as {EDITS})")
    edited = edit_documents(counted.withColumn("edits", edits)).collect()
    for r in edited:
        assert r.text.endswith(" end") and r.n_tokens == plain_count(r.text)
    none = edit_documents(counted.withColumn("edits", F.lit(None).cast(EDITS))).collect()
    assert all(r.reencoded_chars == 0 for r in none)
    assert edit_documents(count_documents(make_docs([])).withColumn("edits", edits)).count() == 0

"""Toxicity: accuracy on held-out labels and edge cases."""

import numpy as np

import pyarrow as pa

from conftest_llm import prose
from revmart.llm import registry, toxicity
from revmart.llm.toxicity import Category, WordCounts, best_threshold, fit_chain, judge_toxicity, predict_linear
from revmart.llm.words import words_of

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, sf01):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    chain = fit_chain(docs, labels.where("doc_id % 3 <> 0"), registry.CATEGORIES)
    rows = judge_toxicity(docs, chain).withColumnRenamed("toxic", "flagged").join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    toxic, clean = ([r.flagged for r in rows if r.toxic == k] for k in (1, 0))
    # the labels call about one junk document in fourteen toxic that has no such word left in it
    assert np.mean(toxic) >= 0.92 and np.mean(clean) <= 0.01


def test_later_model_uses_the_earlier_probability(spark, make_docs):
    # the second category is the first one's, whatever the words
    rows = [(i, ("bad stuff " if i % 2 else "nice things ") + prose(i, 30)) for i in range(200)]
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(200)], LABELS)
    chain = fit_chain(make_docs(rows), labels, registry.CATEGORIES)
    assert [x.category for x in chain] == ["low_quality", "toxic"] and chain[1].model.earlier[0] > 0
    judged = judge_toxicity(make_docs(rows), chain).collect()
    assert all(r.toxic == bool(r.doc_id % 2) for r in judged)


def test_query_returns_all_documents(spark, sf001):
    rows = registry.QUERIES["op5_classifier_chain_toxicity"](spark, sf001).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == spark.read.parquet(f"{sf001}/documents.parquet").count()
    assert all(0 <= r.toxic_score <= 1 and 0 <= r.low_quality_score <= 1 for r in rows)


def test_edge_cases(spark, make_docs):
    rows = [(i, "bad words here" if i % 2 else "good words here") for i in range(200)] + [(950, None), (951, ""), (951, ""), (None, "bad"), (953, "bad " * 50_000)]
    docs = make_docs(rows).selectExpr("*", "'x' as toxic", "1 as words", "2 as id")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)] + [(0, None, 1), (None, 1, 1), (950, 1, 0), (953, 1, 1)], LABELS)
    only = [Category("toxic", "toxic", 1)]
    judged = judge_toxicity(docs, fit_chain(docs, labels, only))
    assert len(judged.columns) == len(set(judged.columns)) and judged.count() == len(rows)
    by_text = {r.text: r.toxic for r in judged.collect()}
    assert by_text["bad words here"] and not by_text["good words here"]
    assert fit_chain(docs, labels.limit(0), only) == []
    assert fit_chain(make_docs([]), labels, only) == []
    none_toxic = fit_chain(docs, labels.where("toxic = 0"), only)
    assert not any(r.toxic for r in judge_toxicity(docs, none_toxic).collect())
    assert judge_toxicity(make_docs([]), none_toxic).count() == 0


def test_links_learn_from_rows_with_their_own_label(spark, make_docs):
    rows = [(i, ("bad stuff " if i % 2 else "nice things ") + prose(i, 30)) for i in range(200)]
    # toxic ones have no quality; most labelled ids are not in docs
    labels = [(i, None if i % 2 else 1, i % 2) for i in range(200)] + [(i, 1, 0) for i in range(200, 5000)]
    labels = spark.createDataFrame(labels, LABELS)
    judged = judge_toxicity(make_docs(rows), fit_chain(make_docs(rows), labels, registry.CATEGORIES, sample_docs=200)).collect()
    assert all(r.toxic == bool(r.doc_id % 2) for r in judged) and not any(r.low_quality for r in judged)


def test_threshold_does_not_cut_ties():
    assert best_threshold(np.array([0.9, 0.9, 0.1]), np.array([True, False, False])) == 0.5
    assert best_threshold(np.array([0.2, 0.1]), np.array([False, False])) > 1


def test_sample_is_bounded_in_words_and_repeatable(spark, make_docs):
    rows = [(i, ("bad stuff " if i % 2 else "nice things ") + prose(i % 40, 30)) for i in range(200)]
    long = [(500 + i, " ".join(f"w{chr(97 + i)}{'abcdefghij'[k % 10]}{k}x" for k in range(3000))) for i in range(5)]
    docs = make_docs(rows + long + [(7, "another text of the same id"), (7, "a third one")] + [(9, rows[9][1])] * 50)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)] + [(500 + i, 1, 0) for i in range(5)], LABELS)
    only = [Category("toxic", "toxic", 1)]
    chains = [fit_chain(d, labels, only, sample_words=500)[0] for d in (docs, docs.repartition(5))]
    assert all((a == b).all() for a, b in zip(chains[0].model[:3], chains[1].model[:3], strict=True)) and chains[0].threshold == chains[1].threshold
    by_id = toxicity._sample(docs, labels, only, "doc_id", "text", 16_000, 500).collect()
    assert len({r.id for r in by_id}) == len(by_id) < 205 and sum(len(r.words) for r in by_id) <= 500
    assert len(toxicity._sample(docs, labels, only, "doc_id", "text", 16_000, 10**9).collect()) == 205


def test_a_link_scores_as_its_weights_say(spark, make_docs):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"], 12, p=[0.3, 0.3, 0.2, 0.15, 0.05]))) for i in range(300)]
    labels = [(i, 1, int("omega" in t)) for i, t in rows]
    chain = fit_chain(make_docs(rows), spark.createDataFrame(labels, LABELS), [Category("toxic", "toxic", 1)])
    scores = {r.doc_id: r.toxic_score for r in judge_toxicity(make_docs(rows), chain).collect()}
    # brute force: the score of every row from the model's weights and its words' rates, word by word
    model = chain[0].model
    for i, text in rows[:60]:
        words = next(words_of(pa.array([text]), lower=True, letters=True))
        entries = [int(h) for h in toxicity._entries(words)[1]]
        sums = {h: entries.count(h) for h in entries}
        counts = WordCounts(np.zeros(len(sums), np.int64), np.array(list(sums), np.uint64), np.array(list(sums.values()), float), np.array([12.0]))
        assert abs(predict_linear(model, counts, np.zeros((1, 0)))[0] - scores[i]) < 1e-9
    flagged = [scores[i] >= chain[0].threshold for i, *_ in rows]
    assert np.mean([f == bool(y) for f, (_, _, y) in zip(flagged, labels, strict=True)]) > 0.95

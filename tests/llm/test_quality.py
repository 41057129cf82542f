"""Quality rules: counts against brute force, verdicts, edge cases."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest_llm import prose
from revmart.llm import registry
from revmart.llm.quality import QualityModel, fit_quality, forest_scores, grow_tree, judge_quality, _assemble

LABELS = "doc_id long, quality int, toxic int"


def brute_counts(text):
    raw = (text or "").encode()
    words = raw.split()
    grams = list(zip(words, words[1:], words[2:], strict=False))
    times, covered = Counter(grams), [False] * len(words)
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered[i : i + 3] = [True] * 3
    lines = [x for x in raw.split(b"\n") if x.strip()]
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(covered)


def counts_of(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_query_counts_and_verdicts(spark, sf01):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()}
    rows = registry.QUERIES["op6_isolation_forest_quality"](spark, sf01).collect()
    assert {r.doc_id: counts_of(r) for r in rows} == {i: brute_counts(t) for i, t in docs.items()}
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf01}/labels.parquet").collect()}
    passed = [r for r in rows if not r.base_failed and r.doc_id in label]
    good = [r.kept for r in passed if label[r.doc_id] == 1]
    bad = [r.kept for r in passed if label[r.doc_id] == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.2


def test_verdicts_hold_on_documents_that_were_not_labelled(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    labels = spark.read.parquet(f"{sf01}/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    rows = judge_quality(docs, fit_quality(docs, seen)).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept for r in rows if r.quality == 1]) >= 0.97
    assert np.mean([r.kept for r in rows if r.quality == 0]) <= 0.5


def test_edge_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, "a\n a\na\na\n"), (5, "é漢 # |"), (5, "é漢 # |"), (None, prose(1, 60)), (7, "x y z " * 20_000), (8, prose(2, 30_000))]
    docs = make_docs(rows).selectExpr("*", "'k' as kept", "1 as n_words", "2 as __label")
    labels = spark.createDataFrame([(8, 1, 0), (8, 1, 0), (7, 0, 0), (None, 1, 0), (1, None, 0), (99, 0, 0)], LABELS)
    for known in (labels, labels.limit(0)):
        found = judge_quality(docs, fit_quality(docs, known))
        assert len(found.columns) == len(set(found.columns))
        assert sorted((r.doc_id or 0, counts_of(r)) for r in found.collect()) == sorted((i or 0, brute_counts(t)) for i, t in rows)
    kept = {r.doc_id: r.kept for r in judge_quality(docs, QualityModel(None, 1.0)).collect()}
    assert kept[None] and kept[8] and not kept[7] and not kept[1]
    empty = make_docs([])
    assert judge_quality(empty, fit_quality(empty, labels)).count() == 0


def test_forest_scores_outliers_higher():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(size=(400, 2)), [[9.0, 9.0], [0.0, -12.0]]])
    nodes = [(t, i, *n) for t in range(60) for i, n in enumerate(grow_tree(rows[rng.choice(402, 128, replace=False)], t))]
    scores = forest_scores(_assemble(nodes, 128), rows)
    assert scores[400:].min() > np.quantile(scores[:400], 0.99)
    assert len(grow_tree(np.ones((5, 2)), 0)) == 1


def _junk(rng, kind):
    """A text whose symbols, ASCII marks and ASCII capitals are ordinary."""
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    sizes = {"long words": (14, 22), "short words": (1, 2)}.get(kind, (2, 9))
    line = lambda: (" ".join(word(rng.randint(*sizes)) for _ in range(12)) + ".").capitalize()
    lines = [line() for _ in range(30)]
    if kind == "lines":
        lines += [line()] * 25
        rng.shuffle(lines)
    if kind == "marks":
        lines = [x.replace(" ", " … ☎ ", 8) for x in lines]
    return "\n".join(lines)


def test_every_statistic_singles_out_its_junk(spark, sf01):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rng, kinds = random.Random(4), ["lines", "long words", "short words", "marks"]
    junk = [(10_000_000 + i, _junk(rng, kinds[i // 2 % 4])) for i in range(240)]
    docs = docs.unionByName(spark.createDataFrame(junk, "doc_id long, text string"))
    labels = labels.unionByName(spark.createDataFrame([(i, 0) for i, _ in junk], "doc_id long, quality int"))
    judged = judge_quality(docs, fit_quality(docs, labels.where("doc_id % 2 = 0")))
    rows = judged.join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    kept = {k: [r.kept for r in rows if r.doc_id >= 10_000_000 and kinds[(r.doc_id - 10_000_000) // 2 % 4] == k] for k in kinds}
    assert {k: len(v) for k, v in kept.items()} == dict.fromkeys(kinds, 30)
    assert all(np.mean(v) <= 0.1 for v in kept.values()), {k: np.mean(v) for k, v in kept.items()}
    assert np.mean([r.kept for r in rows if r.quality == 1]) >= 0.98


def test_minimum_of_words_is_the_models(make_docs):
    docs = make_docs([(1, None), (2, "one"), (3, " ".join(f"w{i}" for i in range(49))), (4, " ".join(f"w{i}" for i in range(50)))])
    for least, passed in ((50, {4}), (1, {2, 3, 4}), (49, {3, 4})):
        judged = judge_quality(docs, QualityModel(None, 1.0, min_words=least)).collect()
        assert {r.doc_id for r in judged if r.kept} == passed == {r.doc_id for r in judged if not r.base_failed}

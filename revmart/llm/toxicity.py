"""Toxicity by a classifier chain.

The categories are predicted in order. Each has a linear model (logistic
regression) on the rates of telling words, and from the second category on
also on the probabilities of the categories before it. While fitting, those
earlier probabilities come from models that did not see the row (out-of-fold
predictions), so a later model learns how far they can be trusted on new
documents.

Words are runs of letters, ASCII lower-cased, known by a 64-bit hash; their
first four and five bytes count as words too, so that the forms of a word
that inflects are known by its stem. Each fit chooses its own words, from its training rows alone: those whose
documents carry the category far more or less often than chance allows.

Fitting uses at most ``sample_docs`` labelled documents, those with the most
labels and among them those with the smallest hashes, and of these as many as
hold ``sample_words`` distinct words in all (two stated bounds: a few tens of
thousands of documents fix the weights of words frequent enough to be chosen).
Their word counts are made by Spark; the chain is fitted on them in one task,
whose memory the second bound limits however long the texts are (16 bytes a
word, several times over). A model is a few thousand weights.

Scale. Scoring is one pass over the texts without a shuffle. Fitting reads
the texts once more and moves word counts of the sample alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.llm.common import checkpointed, require_columns
from revmart.llm.words import Words, stem_hashes, words_of

SAMPLE_DOCS = 16_000
SAMPLE_WORDS = 20_000_000
FOLDS = 3
STEMS = (4, 5)
MIN_DOCS = 3
MIN_SCORE = 5.0
STEPS = 150
RATE = 0.5
RIDGE = 1e-5


class Category(NamedTuple):
    """A name, the label column it is read from and the value that means yes."""

    name: str
    label_col: str
    yes: int


class LinearModel(NamedTuple):
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    earlier: np.ndarray  # weights of the earlier categories' log odds
    bias: float


class ChainLink(NamedTuple):
    category: str
    model: LinearModel
    threshold: float


class WordCounts(NamedTuple):
    """Entries of a sparse documents x words matrix (stems are words too), and
    words per document."""

    doc: np.ndarray
    word: np.ndarray
    times: np.ndarray
    totals: np.ndarray


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _telling_words(counts: WordCounts, rows: np.ndarray, yes: np.ndarray) -> np.ndarray:
    """Hashes of the words that occur in ``MIN_DOCS`` training rows and whose
    share of ``yes`` rows is ``MIN_SCORE`` standard errors from the mean."""
    inside = rows[counts.doc]
    words, back = np.unique(counts.word[inside], return_inverse=True)
    held = np.bincount(back, minlength=len(words)).astype(float)
    with_yes = np.bincount(back, weights=yes[counts.doc[inside]], minlength=len(words))
    mean = with_yes.sum() / max(held.sum(), 1)
    score = np.abs(with_yes - held * mean) / np.sqrt(np.maximum(held * mean * (1 - mean), 1e-9))
    return words[(held >= MIN_DOCS) & (score >= MIN_SCORE)]


def fit_linear(counts: WordCounts, earlier: np.ndarray, yes: np.ndarray, rows: np.ndarray) -> LinearModel:
    """Logistic regression on the training ``rows`` by adaptive gradient steps."""
    words = _telling_words(counts, rows, yes)
    at = np.minimum(np.searchsorted(words, counts.word), max(len(words) - 1, 0))
    use = rows[counts.doc] & (words[at] == counts.word) if len(words) else np.zeros(len(counts.word), dtype=bool)
    doc, col = counts.doc[use], at[use]
    value = counts.times[use] / np.sqrt(np.maximum(counts.totals[doc], 1))
    n, k, e = len(yes), len(words), earlier.shape[1]
    weights, seen = np.zeros(k + e + 1), np.full(k + e + 1, 1e-8)
    size = max(int(rows.sum()), 1)
    for _ in range(STEPS):
        score = np.bincount(doc, weights[col] * value, n) + earlier @ weights[k : k + e] + weights[-1]
        error = np.where(rows, _sigmoid(score) - yes, 0.0)
        slope = np.concatenate([np.bincount(col, error[doc] * value, k), earlier.T @ error, [error.sum()]]) / size
        slope[:-1] += RIDGE * weights[:-1]
        seen += slope * slope
        weights -= RATE * slope / np.sqrt(seen)
    return LinearModel(words, weights[:k], weights[k : k + e], float(weights[-1]))


def predict_linear(model: LinearModel, counts: WordCounts, earlier: np.ndarray) -> np.ndarray:
    """Probability per document; ``earlier`` holds log odds."""
    score = earlier @ model.earlier + model.bias
    if len(model.words) and len(counts.word):
        at = np.minimum(np.searchsorted(model.words, counts.word), len(model.words) - 1)
        hit = model.words[at] == counts.word
        own = np.bincount(counts.doc[hit], model.weights[at[hit]] * counts.times[hit], len(counts.totals))
        score = score + own / np.sqrt(np.maximum(counts.totals, 1))
    return _sigmoid(score)


def best_threshold(p: np.ndarray, yes: np.ndarray) -> float:
    """The probability from which a document counts as yes: the best F1,
    halfway to the next lower probability; above all where nothing is yes."""
    if not yes.any():
        return 1.1
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(yes[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + yes.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = 0.0  # ties are not cut
    k = int(f1.argmax())
    after = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + after) / 2)


def _entries(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every word and stem."""
    doc = np.repeat(np.arange(len(words.rows)), np.diff(words.first))
    stems = [stem_hashes(words, n) for n in STEMS]
    return np.concatenate([doc, *[doc[at] for at, _ in stems]]), np.concatenate([words.hashes, *[h for _, h in stems]])


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in words_of(batch.column("text"), lower=True, letters=True):
            doc, hashes = _entries(words)
            order = np.argsort(doc, kind="stable")
            first = np.searchsorted(doc[order], np.arange(len(words.rows) + 1))
            unique = [np.unique(hashes[order[a:b]], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
            rows = batch.slice(words.rows.start, len(words.rows))
            others = [name for name in rows.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[rows.column(name) for name in others],
                    pa.array(np.diff(words.first), pa.int32()),
                    pa.array([u.view(np.int64) for u, _ in unique], pa.list_(pa.int64())),
                    pa.array([c for _, c in unique], pa.list_(pa.int32())),
                ],
                names=[*others, "total", "words", "times"],
            )


def _sample(
    docs: DataFrame, labels: DataFrame, categories: list[Category], id_col: str, text_col: str, sample_docs: int, sample_words: int
) -> DataFrame:
    """Word counts and labels (``y0``, ``y1``, ..., NULL where there is none) of
    the sampled documents: labelled ones that ``docs`` holds, those with the
    most labels first."""
    cols = list(dict.fromkeys(c.label_col for c in categories))
    some = labels.where(" or ".join(f"`{c}` is not null" for c in cols))
    known = some.groupBy(F.col(id_col).alias("id")).agg(
        *[F.max((F.col(c.label_col) == c.yes).cast("int")).alias(f"y{i}") for i, c in enumerate(categories)]
    )
    present = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    held = sum((F.col(f"y{i}").isNotNull().cast("int") for i in range(len(categories))), F.lit(0))
    order = [held.desc(), F.xxhash64(F.lit("sample"), "id"), F.col("id")]
    chosen = present.orderBy(*order).limit(sample_docs)  # the documented bound
    names = [f"y{i}" for i in range(len(categories))]
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.struct(F.xxhash64(text).alias("print"), text.alias("text")).alias("t"))
    # of rows that share an id the text with the smallest hash, map-side first
    picked = texts.join(F.broadcast(chosen), "id").groupBy("id", *names).agg(F.min("t").alias("t")).select("id", *names, "t.text")
    schema = "id long, " + ", ".join(f"{n} int" for n in names) + ", total int, words array<long>, times array<int>"
    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int")
    counted = checkpointed(picked.mapInArrow(_counted_words, schema).withColumn("fold", fold))
    # one number for each of the sampled documents
    upto = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sizes = counted.select("id", *names, F.size("words").cast("long").alias("size"))
    within = sizes.withColumn("upto", upto).where(F.col("upto") <= sample_words).select("id")
    return counted.join(F.broadcast(within), "id", "left_semi")


def _matrix(rows: pd.DataFrame) -> WordCounts:
    """The sample's matrix without the words of fewer than ``MIN_DOCS``
    documents, which no fit could choose."""
    held = rows["words"].map(len).to_numpy()
    empty = np.zeros(0, np.int64)
    words = np.concatenate([empty, *rows["words"]]).astype(np.int64, copy=False).view(np.uint64)
    times = np.concatenate([empty, *rows["times"]]).astype(np.float32)
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), held)
    _, back, docs = np.unique(words, return_inverse=True, return_counts=True)
    known = docs[back] >= MIN_DOCS
    return WordCounts(doc[known], words[known], times[known], rows["total"].to_numpy().astype(float))


_FITTED = "category int, words binary, weights binary, earlier binary, bias double, threshold double"


def _fit_categories(count: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", ignore_index=True)
        counts, fold = _matrix(rows), rows["fold"].to_numpy()
        earlier = np.zeros((len(rows), 0))  # out-of-fold probabilities of the categories so far
        out = []
        for i in range(count):
            # a link learns from the rows that have its own label and predicts for all
            has = rows[f"y{i}"].notna().to_numpy()
            yes = rows[f"y{i}"].fillna(0).to_numpy().astype(float)
            odds, unseen = _log_odds(earlier), np.zeros(len(rows))
            for k in range(FOLDS):
                left_out = fold == k
                model = fit_linear(counts, odds, yes, has & ~left_out)
                unseen[left_out] = predict_linear(model, counts, odds)[left_out]
            model = fit_linear(counts, odds, yes, has)
            arrays = (x.tobytes() for x in (model.words, model.weights, model.earlier))
            out.append((i, *arrays, model.bias, best_threshold(unseen[has], yes[has] > 0)))
            earlier = np.column_stack([earlier, unseen])
        return pd.DataFrame(out, columns=["category", "words", "weights", "earlier", "bias", "threshold"])

    return fit


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[Category],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    sample_words: int = SAMPLE_WORDS,
) -> list[ChainLink]:
    """The chain's models, in order, with a threshold each (best F1 of the
    out-of-fold predictions). Each is fitted on the rows that have its own
    label; rows without any are skipped, and with no labelled document the
    chain is empty. Ids are numbers. Of rows that share an id one is sampled, by
    the hash of its text; of its labels the largest counts. Documents are
    sampled in order as long as their distinct words stay within ``sample_words``."""
    require_columns(docs, id_col, text_col)
    require_columns(labels, id_col, *[c.label_col for c in categories])
    sample = _sample(docs, labels, categories, id_col, text_col, sample_docs, sample_words)
    fitted = sample.groupBy().applyInPandas(_fit_categories(len(categories)), _FITTED)  # one group: the bounded sample
    chain = []
    for row in sorted(fitted.collect()):  # one row per category
        arrays = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["weights"]), np.frombuffer(row["earlier"])
        chain.append(ChainLink(categories[row["category"]].name, LinearModel(*arrays, row["bias"]), row["threshold"]))
    return chain


def judge_toxicity(docs: DataFrame, chain: list[ChainLink], text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` plus ``<category>_score`` for each category and
    ``<category>`` (its score reaches the threshold).

    NULL or empty text: scored by the models' biases. An empty chain adds
    nothing. Columns of ``docs`` with the made names are replaced.
    """
    require_columns(docs, text_col)
    made = [T.StructField(f"{x.category}_score", T.DoubleType()) for x in chain]
    made += [T.StructField(x.category, T.BooleanType()) for x in chain]
    taken = {f.name for f in made} - {text_col}
    kept = [f for f in docs.schema.fields if f.name not in taken]
    schema = T.StructType([*kept, *made])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column(text_col), lower=True, letters=True):
                n = len(words.rows)
                doc, hashes = _entries(words)
                counts = WordCounts(doc, hashes, np.ones(len(doc)), np.diff(words.first).astype(float))
                scores = np.zeros((n, 0))
                for link in chain:
                    p = predict_linear(link.model, counts, _log_odds(scores))
                    scores = np.column_stack([scores, p])
                flags = [pa.array(scores[:, i] >= link.threshold) for i, link in enumerate(chain)]
                rows = batch.slice(words.rows.start, n)
                yield pa.RecordBatch.from_arrays([*rows.columns, *[pa.array(c) for c in scores.T], *flags], names=schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(judge, schema)

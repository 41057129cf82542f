"""Quality rules: isolation forests on rule statistics.

Rules of thumb (short documents, documents that mostly repeat themselves)
reject outright. What they let through is scored by isolation forests over
the rules' statistics: a document that random splits separate after few
steps is unlike the others. How short a path is too short is read from
labelled rows.

One forest splits on what words are made of, one on how much lines and words
repeat. Ordinary documents repeat some lines or none, so in one forest for
all statistics those splits single out good documents and hide the junk.

Fitting. The trees see
a bounded sample of them (``trees * sample`` rows, each tree its own
``sample``, chosen by hash), which is how isolation forests are grown; the
thresholds are set on counts over *all* labelled documents. A forest (at most
``trees * (2 * sample - 1)`` nodes) is small enough to ship with the tasks.

Scale. Two passes over the texts, neither of which shuffles them: the labels
are joined to statistics.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.llm.common import buckets_for, checkpointed, require_columns
from revmart.llm.words import Words, gram_hashes, words_of

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TREES = 100
#: Small, so that a kind of junk that makes up some hundredths of a corpus is still rare in a tree.
TREE_SAMPLE = 64
#: Share of the labelled good documents that the threshold must keep.
KEEP_GOOD = 0.995
SCORE_BINS = 2000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the first forest splits on, as logarithms: symbols, punctuation marks, ASCII capitals and characters, each per word.
WORD_RATES = ["symbol_rate", "mark_rate", "capital_rate", "mean_word_chars"]
#: What the second one splits on, as logarithms: duplicates among the lines and words in repeated windows among the words.
REPEAT_RATES = ["dup_line_rate", "repeat_rate"]
RATES = WORD_RATES + REPEAT_RATES
RATE_FLOOR = 0.01


class Statistics(NamedTuple):
    counts: np.ndarray  # texts x COUNTS
    rates: np.ndarray  # texts x RATES


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _marks(data: np.ndarray) -> np.ndarray:
    """The bytes that begin a mark: ASCII punctuation, signs of Latin-1, U+2000
    to U+2BFF (dashes, quotes, arrows, shapes), CJK and full-width punctuation
    and pictographs (U+1F000 to U+1FFFF)."""
    is_mark, latin, full = np.zeros((3, 256), dtype=bool)
    is_mark[33:48] = is_mark[58:65] = is_mark[91:97] = is_mark[123:127] = True
    latin[0xA1:0xC0] = True
    latin[[0xAA, 0xB5, 0xBA]] = False  # letters
    full[0x81:0x90] = full[0x9A:0xA1] = True
    marks = is_mark[data]
    # beyond ASCII: few bytes in most texts
    at = np.flatnonzero(data[:-1] >= 0xC2)
    lead, second, third = data[at], data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    marks[at] = (
        ((lead == 0xC2) & latin[second])
        | ((lead == 0xE2) & (second <= 0xAF))
        | ((lead == 0xE3) & (second == 0x80))
        | ((lead == 0xEF) & (second == 0xBC) & full[third])
        | ((lead == 0xF0) & (second == 0x9F))
    )
    return marks


def _repeat_words(grams: np.ndarray) -> int:
    """Words inside a 3-word window that the text holds twice or more."""
    _, back, times = np.unique(grams, return_inverse=True, return_counts=True)
    repeated = times[back] > 1
    if not repeated.any():
        return 0
    covered = np.zeros(len(grams) + 2, dtype=bool)
    for j in range(3):
        covered[j : j + len(grams)] |= repeated
    return int(covered.sum())


def _chunk_statistics(words: Words) -> Statistics:
    n = len(words.rows)
    counts, other, lines = np.zeros((n, len(COUNTS)), np.int64), np.zeros((n, 2)), np.ones(n)
    if not len(words.starts):
        return Statistics(counts, np.full((n, len(RATES)), np.log(RATE_FLOOR)))
    data = words.data
    # running counts over bytes; a text's count is a difference of two
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    is_symbol, is_capital = np.zeros((2, 256), dtype=bool)
    is_symbol[list(SYMBOLS)] = True
    is_capital[65:91] = True
    symbols, *others = (np.concatenate([[0], np.cumsum(x)]) for x in (is_symbol[data], _marks(data), is_capital[data]))
    word_chars = np.concatenate([[0], np.cumsum(lead[words.ends] - lead[words.starts])])
    grams = gram_hashes(words.hashes, 3)
    raw = data.tobytes()
    for i in range(n):
        a, b = words.first[i], words.first[i + 1]
        if a == b:
            continue
        lo, hi = words.starts[a], words.ends[b - 1]
        lines[i], dup = _duplicate_lines(raw[words.offsets[i] : words.offsets[i + 1]])
        repeats = _repeat_words(grams[a : b - 2]) if b - a >= 4 else 0
        counts[i] = b - a, word_chars[b] - word_chars[a], symbols[hi] - symbols[lo], dup, repeats
        other[i] = [s[hi] - s[lo] for s in others]
    total = np.maximum(counts[:, 0], 1)
    per_word = np.column_stack([counts[:, 2], other, counts[:, 1]]) / total[:, None]
    shares = np.column_stack([per_word, counts[:, 3] / lines, counts[:, 4] / total])
    return Statistics(counts, np.log(shares + RATE_FLOOR))


def text_statistics(texts: pa.Array) -> Statistics:
    """Counts and rates of each text; zeros for NULL and empty ones."""
    found = [_chunk_statistics(w) for w in words_of(texts)]
    if not found:
        return Statistics(np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(RATES))))
    return Statistics(np.vstack([x.counts for x in found]), np.vstack([x.rates for x in found]))


def base_failed(counts: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    return (counts[:, 0] < min_words) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


class Forest(NamedTuple):
    """Nodes of all trees. ``feature`` -1: a leaf, its ``value`` the path
    length it stands for; else rows below ``value`` go to ``left``."""

    roots: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sample: int


def _average_path(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_tree(rows: np.ndarray, seed: int) -> list[tuple[int, float, int, int]]:
    """Nodes (feature, value, left, right) of one tree; the root comes first."""
    rng = np.random.default_rng(seed)
    limit = math.ceil(math.log2(max(len(rows), 2)))
    nodes: list[tuple[int, float, int, int]] = []

    def grow(part: np.ndarray, depth: int) -> int:
        at = len(nodes)
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(part) < 2 or not len(open_features):
            nodes.append((-1, depth + _average_path(len(part)), -1, -1))
            return at
        feature = int(rng.choice(open_features))
        split = float(rng.uniform(low[feature], high[feature]))
        below = part[:, feature] < split
        nodes.append((feature, split, -1, -1))
        if not below.any() or below.all():
            below = part[:, feature] <= low[feature]
            split = float(np.nextafter(low[feature], high[feature]))
        left, right = grow(part[below], depth + 1), grow(part[~below], depth + 1)
        nodes[at] = (feature, split, left, right)
        return at

    grow(rows, 0)
    return nodes


def forest_scores(forest: Forest, rates: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1): 2 to the minus (mean path length over the mean expected)."""
    depth = np.zeros(len(rates))
    index = np.arange(len(rates))
    for root in forest.roots:
        at = np.full(len(rates), root)
        walking = index
        while len(walking):
            feature = forest.feature[at[walking]]
            walking = walking[feature >= 0]
            here = at[walking]
            below = rates[walking, forest.feature[here]] < forest.value[here]
            at[walking] = np.where(below, forest.left[here], forest.right[here])
        depth += forest.value[at]
    return 2.0 ** (-depth / max(len(forest.roots), 1) / max(_average_path(forest.sample), 1e-9))


class QualityModel(NamedTuple):
    """A forest over ``WORD_RATES`` and one over ``REPEAT_RATES``, and the
    lowest score that each rejects. ``forest`` None: nothing was labelled,
    only the base rules hold. ``min_words``: documents with fewer fail them."""

    forest: Forest | None
    threshold: float
    repeat_forest: Forest | None = None
    repeat_threshold: float = 1.0
    min_words: int = MIN_WORDS


def _rate_rows(min_words: int):
    def rate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_statistics(batch.column("__text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), pa.array(base_failed(found.counts, min_words)), *[pa.array(x) for x in found.rates.T]],
                names=["__id", "__failed", *RATES],
            )

    return rate_rows


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    trees: int = TREES,
    sample: int = TREE_SAMPLE,
    keep_good: float = KEEP_GOOD,
    min_words: int = MIN_WORDS,
) -> QualityModel:
    """Grow the forests on, and calibrate their thresholds with, labelled documents.

    ``label_col``: 1 good, 0 bad, NULL skipped. A threshold is the one that
    separates good from bad best (largest gap between the shares rejected)
    among those that keep at least ``keep_good`` of the good documents which
    the base rules pass. That of the repeats is set on what the first forest
    keeps, and both together keep that share. No labelled document: base
    rules only. No bad one: nothing is rejected beyond the base rules. The
    model holds ``min_words`` of the base rules.
    """
    require_columns(docs, id_col, text_col)
    require_columns(labels, id_col, label_col)
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.min(label_col).cast("int").alias("__label")
    )
    schema = T.StructType(
        [T.StructField("__id", docs.schema[id_col].dataType), T.StructField("__failed", T.BooleanType())]
        + [T.StructField(r, T.DoubleType()) for r in RATES]
    )
    # statistics first: the join then moves a few numbers per document, and no text
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    passed = texts.mapInArrow(_rate_rows(min_words), schema).where(~F.col("__failed"))
    rated = checkpointed(passed.join(known, "__id").select("__label", *RATES))
    # a row is offered to one tree by its hash (to several where there are few
    # rows), and a tree takes the rows with the smallest hashes
    offers = min(trees, buckets_for(2 * trees * sample, max(1, rated.count())))
    offered = rated.withColumn("offer", F.explode(F.sequence(F.lit(0), F.lit(offers - 1))))
    tree = F.pmod(F.xxhash64(F.lit("tree"), "offer", *RATES), F.lit(trees)).cast("int")
    place = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit("row"), *RATES), *RATES)
    sampled = offered.withColumn("tree", tree).withColumn("row", F.row_number().over(place)).where(F.col("row") <= sample)

    parts = [WORD_RATES, REPEAT_RATES]

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, names in enumerate(parts):
            out += [(part, int(key[0]), i, *x) for i, x in enumerate(grow_tree(rows[names].to_numpy(), int(key[0])))]
        return pd.DataFrame(out, columns=["part", "tree", "node", "feature", "value", "left_node", "right_node"])

    grown = sampled.groupBy("tree").applyInPandas(
        grow, "part int, tree int, node int, feature int, value double, left_node int, right_node int"
    )
    nodes = sorted(tuple(r) for r in grown.collect())  # 2 * trees * (2 * sample - 1) rows at most
    if not nodes:
        return QualityModel(None, 1.0, min_words=min_words)
    words, repeats = (_assemble([x[1:] for x in nodes if x[0] == part], sample) for part in range(len(parts)))

    def counted(model: QualityModel, scored: Forest, names: list[str]) -> dict[tuple[int, int], int]:
        """Labelled rows that ``model`` keeps, by label and bin of their score."""

        def score(batches):
            for batch in batches:
                rates = np.column_stack([batch.column(r).to_numpy(zero_copy_only=False) for r in RATES])
                rows = np.flatnonzero(_accepted(_scores(model, rates), model))
                own = rates[rows][:, [RATES.index(r) for r in names]]
                bins = np.minimum((forest_scores(scored, own) * SCORE_BINS).astype(np.int64), SCORE_BINS - 1)
                yield pa.RecordBatch.from_arrays([batch.column("__label").take(pa.array(rows)), pa.array(bins)], names=["label", "bin"])

        found = rated.mapInArrow(score, "label int, bin long").groupBy("label", "bin").count().collect()
        return {(r["label"], r["bin"]): r["count"] for r in found}

    every = counted(QualityModel(None, 1.0), words, WORD_RATES)
    model = QualityModel(words, _threshold(every, keep_good), min_words=min_words)
    left = counted(model, repeats, REPEAT_RATES)
    good, good_left = (sum(n for (label, _), n in c.items() if label == 1) for c in (every, left))
    # of what is left, so that of all good documents keep_good stay
    keep_left = min(1.0, keep_good * good / good_left) if good_left else keep_good
    return model._replace(repeat_forest=repeats, repeat_threshold=_threshold(left, keep_left))


def _assemble(nodes: list[tuple], sample: int) -> Forest:
    starts: dict[int, int] = {}
    for i, (tree, *_) in enumerate(nodes):
        starts.setdefault(tree, i)
    shift = np.array([starts[t] for t, *_ in nodes])
    feature = np.array([x[2] for x in nodes])
    left, right = (np.array([x[k] for x in nodes]) + shift for k in (4, 5))
    return Forest(np.array(sorted(starts.values())), feature, np.array([x[3] for x in nodes]), left, right, sample)


def _threshold(counts: dict[tuple[int, int], int], keep_good: float) -> float:
    """The lowest score that is rejected; 1 where nothing is."""
    good, bad = (np.array([counts.get((k, b), 0) for b in range(SCORE_BINS)], float) for k in (1, 0))
    if not bad.sum():
        return 1.0
    good_above = good[::-1].cumsum()[::-1] / max(good.sum(), 1)
    bad_above = bad[::-1].cumsum()[::-1] / bad.sum()
    gap = np.where(good_above <= 1 - keep_good, bad_above - good_above, 0.0)
    return float(gap.argmax()) / SCORE_BINS if gap.max() > 0 else 1.0


def _scores(model: QualityModel, rates: np.ndarray) -> np.ndarray:
    """Rows x 2: what each forest says; 0 where there is none."""
    k = len(WORD_RATES)
    parts = (model.forest, rates[:, :k]), (model.repeat_forest, rates[:, k:])
    return np.column_stack([forest_scores(f, x) if f else np.zeros(len(x)) for f, x in parts])


def _accepted(scores: np.ndarray, model: QualityModel) -> np.ndarray:
    return (scores < [model.threshold, model.repeat_threshold]).all(axis=1)


def judge_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` plus its counts, ``base_failed``,
    ``anomaly_score`` and ``repeat_score`` (of the two forests; 0 without
    one) and ``kept``.

    NULL or empty text: all counts 0, base_failed. Repeated rows are judged
    alike. Columns of ``docs`` with the made names are replaced.
    """
    require_columns(docs, text_col)
    made = [*COUNTS, "base_failed", "anomaly_score", "repeat_score", "kept"]
    kept_cols = [c for c in docs.columns if c not in made or c == text_col]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept_cols])
    schema = T.StructType(
        [*docs.schema.fields]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
        + [T.StructField("base_failed", T.BooleanType())]
        + [T.StructField(c, T.DoubleType()) for c in ("anomaly_score", "repeat_score")]
        + [T.StructField("kept", T.BooleanType())]
    )

    def judge(batches):
        for batch in batches:
            found = text_statistics(batch.column(text_col))
            failed = base_failed(found.counts, model.min_words)
            scores = _scores(model, found.rates)
            kept = ~failed & _accepted(scores, model)
            made_cols = [*[pa.array(c) for c in found.counts.T], pa.array(failed), *[pa.array(c) for c in scores.T], pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made_cols], names=schema.names)

    return docs.mapInArrow(judge, schema)

"""Removing repeated passages with suffix automata.

A window is ``window`` consecutive words of one document. Every word covered
by a window that also starts earlier in the corpus (smaller id, or same
document and earlier start) goes. A row without an id is a document of its own,
after all that have one.

1. *Anchors.* Of every window's 5-grams the one with the smallest hash is its
   anchor. Equal windows have equal anchors at equal places, so only anchors
   that occur twice can belong to a repeated window. Neighbouring windows
   mostly share their anchor: about one word in nine is one.
2. *Contexts.* An anchor's context is all words that a window around it can
   reach. Occurrences whose contexts have equal bytes (a 128-bit BLAKE2 hash of
   them) are copies of each other: all but the first are repeated in full, and
   only the first goes on.
3. *Automata.* First occurrences of anchors with several contexts are the
   reference passages. They are cut into shards by anchor; a shard's suffix
   automaton (arrays, built and walked for a shard's passages together) meets exactly the
   passages that share an anchor with it, which are streamed through it, word for word. Where their matching statistic reaches the window
   and the automaton knows an earlier place, the window is repeated.
   An anchor with more than ``shard_passages`` contexts would make a shard of
   its own grow with the corpus; its windows are compared by a SHA-256 of their
   bytes instead (grouped with map-side pre-aggregation), which decides the same.
   Of the words around the anchor a window takes at least half before it or half
   behind it, so windows are made only where those words occur twice with it.
4. *Removal.* Repeated spans are merged per document and cut out.

Scale. What is shuffled: anchors twice (8 and 44 bytes each), then only
repeated ones, and the texts twice, to their wanted places and to their
spans. Every phase ends in a written table, with which its shuffle files go,
and a table is deleted when the phases that read it are over, so the disk in
use is that of one phase and what it reads.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.llm.automaton import SuffixAutomaton
from revmart.llm.common import buckets_for, checkpointed, keyed_table, require_columns, written
from revmart.llm.words import Words, chunks_of, gram_hashes, joined_bytes, words_of
from revmart.session import drop_scratch, scratch_path

WINDOW = 20
GRAM = 5
SHARD_PASSAGES = 1000
LAST_ID = (1 << 63) - 1
#: Tags of rows without an id begin here: above those of texts, which are 32-bit hashes.
FIRST_TURN = 1 << 32

_GOLD = 0x9E3779B97F4A7C15  # odd
_PLACE_BITS = np.uint64(24)


def _anchor_places(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of all windows: their hashes and their first words' indices."""
    grams = gram_hashes(words.hashes, gram)
    spread = window - gram + 1
    sizes = np.diff(words.first)
    if not (sizes >= window).any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(words.first[:-1], words.first[1:], strict=True)])
    # stretches of as many grams as places can be told apart, each with the whole windows of its starts
    most = 1 << int(_PLACE_BITS)
    chosen = []
    for lo in range(0, len(grams) - spread + 1, most - spread + 1):
        # (hash, place) in one integer: its minimum is the leftmost smallest gram
        part = grams[lo : lo + most]
        best = (part >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while reach < spread:
            step = min(reach, spread - reach)
            best = np.minimum(best[:-step], best[step:])
            reach += step
        own = starts[np.searchsorted(starts, lo) : np.searchsorted(starts, lo + len(best))] - lo
        chosen.append((best[own] & np.uint64(most - 1)).astype(np.int64) + lo)
    places = np.unique(np.concatenate(chosen))
    return grams[places], places


def _owner(words: Words, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.first, places, side="right") - 1


def _reach(words: Words, places: np.ndarray, text: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    lo = np.maximum(places - (window - gram), words.first[text])
    hi = np.minimum(places + window, words.first[text + 1])
    return lo, hi


def _fingerprints_only(window: int, gram: int):
    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                prints, _ = _anchor_places(words, window, gram)
                if len(prints):
                    yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64))], names=["fp"])

    return fingerprints


def _contexts(words: Words, places: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A 128-bit hash, as two longs, of the words from ``lo`` up to ``hi`` and of where between them the place is."""
    joined, at = joined_bytes(words)
    spans = zip(at[lo].tolist(), at[hi].tolist(), strict=True)
    halves = np.frombuffer(b"".join(blake2b(joined[a:b], digest_size=16).digest() for a, b in spans), dtype=np.uint64).reshape(-1, 2).copy()
    halves[:, 0] += (places - lo).astype(np.uint64) * np.uint64(_GOLD)
    return halves.view(np.int64)


def _anchors(window: int, gram: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
            for words in words_of(batch.column("text")):
                prints, places = _anchor_places(words, window, gram)
                if not len(places):
                    continue
                text = _owner(words, places)
                contexts = _contexts(words, places, *_reach(words, places, text, window, gram))
                row = words.rows.start + text
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(prints.view(np.int64)),
                        pa.array(contexts[:, 0]),
                        pa.array(contexts[:, 1]),
                        pa.array(ids[row]),
                        pa.array(tags[row]),
                        pa.array((places - words.first[text]).astype(np.int32)),
                    ],
                    names=["fp", "c1", "c2", "id", "tag", "pos"],
                )

    return anchors


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values and where each row's begin."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _passages(window: int, gram: int):
    """The contexts' words around the wanted anchors of each text."""

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, ends = _lists(batch.column("wanted"))
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tag"))
            for words in words_of(batch.column("text")):
                rows = words.rows
                own = wanted[ends[rows.start] : ends[rows.stop]]
                text = np.repeat(np.arange(len(rows)), np.diff(ends[rows.start : rows.stop + 1]))
                at = (own >> 1) + words.first[text]
                lo, hi = _reach(words, at, text, window, gram)
                joined, byte = joined_bytes(words)
                own_words = [joined[a:b] for a, b in zip(byte[lo].tolist(), (byte[hi] - 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram_hashes(words.hashes, gram)[at].view(np.int64)),
                        pa.array((own & 1).astype(bool)),
                        pa.array(ids[rows.start + text]),
                        pa.array(tags[rows.start + text]),
                        pa.array((lo - words.first[text]).astype(np.int32)),
                        pa.array((at - lo).astype(np.int32)),
                        pa.array(own_words, pa.binary()),
                    ],
                    names=["fp", "heavy", "id", "tag", "start", "anchor", "words"],
                )

    return passages


def _through_automaton(window: int):
    """One shard: its automaton, and its passages streamed through it."""

    def match(passages: pd.DataFrame) -> pd.DataFrame:
        split = [p.split(b" ") for p in passages["words"]]
        first = np.concatenate([[0], np.cumsum([len(p) for p in split])])
        # the automaton's letters: the words themselves, numbered
        letters = pd.factorize(np.array([w for p in split for w in p], dtype=object))[0].astype(np.int64)
        # rows that share an id are one document, those without an id are not
        turn = passages["tag"].where(passages["tag"] >= FIRST_TURN, 0)
        document = pd.DataFrame({"id": passages["id"], "turn": turn}).groupby(["id", "turn"]).ngroup().to_numpy().astype(np.int64)
        start = passages["start"].to_numpy().astype(np.int64)
        begins = np.repeat(first[:-1], np.diff(first))
        places = np.repeat((document << 40) + start, np.diff(first)) + np.arange(len(letters)) - begins
        ends = SuffixAutomaton(letters, first, places).earlier(letters, first, places, window)
        text = np.searchsorted(first, ends, side="right") - 1
        # windows that overlap or touch are one span
        opens = np.ones(len(ends), dtype=bool)
        opens[1:] = (text[1:] != text[:-1]) | (np.diff(ends) > window)
        lo = np.flatnonzero(opens)
        hi = np.append(lo[1:], len(ends))[: len(lo)] - 1
        own = text[lo]
        shift = start[own] - first[own]
        return pd.DataFrame({
            "id": passages["id"].to_numpy()[own],
            "tag": passages["tag"].to_numpy()[own],
            "lo": (ends[lo] - window + 1 + shift).astype(np.int32),
            "hi": (ends[hi] + 1 + shift).astype(np.int32),
        })

    return match


def _place(at: str) -> Column:
    """Where a word stands in the order of the corpus."""
    turn = F.greatest(F.col("tag"), F.lit(FIRST_TURN))  # 32-bit tags do not order rows
    return F.struct(F.col("id").alias("id"), turn.alias("turn"), F.col(at).alias("at"))


def _halves(passages: DataFrame, window: int, gram: int) -> DataFrame:
    """The passages around heavy anchors with the places (``lo`` to ``hi``) of
    the windows that take at least half of their other words from before the
    anchor, and again with those of all other windows, which take the rest or
    more from behind it. ``half``: a hash of the words these have in common."""
    before = (window - gram + 1) // 2
    behind = window - gram + 1 - before
    own, anchor = F.split(F.col("words").cast("string"), " "), F.col("anchor")
    last = F.size(own) - window

    def half(side: int, begin: Column, size: int, lo: Column, hi: Column) -> DataFrame:
        common = F.xxhash64(F.lit(side), F.slice(own, begin + 1, size)).alias("half")
        return passages.where(lo <= hi).select("fp", common, "id", "tag", "start", "words", lo.alias("lo"), hi.alias("hi"))

    left = half(0, anchor - before, before + gram, F.lit(0), F.least(anchor - before, last))
    right = half(1, anchor, gram + behind, F.greatest(anchor - before + 1, F.lit(0)), last)
    return left.unionByName(right)


def _windows(passages: DataFrame, window: int, gram: int) -> DataFrame:
    """The windows of the passages around heavy anchors that may be repeated, by a
    hash of their bytes. Equal windows have equal halves: where a half occurs
    once, none is made."""
    halves = _halves(passages, window, gram)
    often = keyed_table(halves.groupBy("fp", "half").agg(F.count("*").alias("n")).where("n > 1").select("fp", "half"))
    split = halves.join(often, ["fp", "half"]).withColumn("words", F.split(F.col("words").cast("string"), " "))
    at = F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("at")
    own = F.unhex(F.sha2(F.concat_ws(" ", F.slice("words", F.col("at") + 1, window)), 256))
    return split.select("fp", "id", "tag", "start", "words", at).select(
        "fp", own.alias("window"), "id", "tag", (F.col("start") + F.col("at")).alias("lo")
    )


def _by_window_hash(passages: DataFrame, window: int, gram: int) -> DataFrame:
    """Repeated windows of the passages around heavy anchors."""
    windows = _windows(passages, window, gram)
    first = windows.groupBy("fp", "window").agg(F.min(_place("lo")).alias("first"), F.count("*").alias("n"))
    first = keyed_table(first.where("n > 1"))
    repeated = windows.join(first, ["fp", "window"]).where(_place("lo") > F.col("first"))
    return repeated.select("id", "tag", "lo", (F.col("lo") + window).cast("int").alias("hi"))


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (start and end in one long) of each text merged where they touch."""
    for batch in batches:
        packed, ends = _lists(batch.column("spans"))
        row = np.repeat(np.arange(len(batch)), np.diff(ends))
        order = np.lexsort((packed, row))
        row, packed = row[order], packed[order]
        base = row.astype(np.int64) << 40  # texts one after the other on one line
        lo, hi = base + (packed >> 32), base + (packed & 0xFFFFFFFF)
        reached = np.maximum.accumulate(hi)
        opens = np.concatenate([[True], lo[1:] > reached[:-1]]) if len(lo) else np.zeros(0, dtype=bool)
        start = np.flatnonzero(opens)
        end = np.append(start[1:], len(lo)) - 1
        pairs = np.column_stack([lo[start] - base[start], reached[end] - base[start]]).astype(np.int32).reshape(-1)
        first = 2 * np.searchsorted(row[start], np.arange(len(batch) + 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("tag"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(pairs))],
            names=["id", "tag", "spans"],
        )


def repeated_spans(
    texts: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_passages: int = SHARD_PASSAGES
) -> DataFrame:
    """``texts`` (``id``, ``tag``, ``text``) to merged word spans that are
    repeated: ``id``, ``tag``, ``spans`` (starts and ends in turn)."""
    spark = texts.sparkSession
    folder = scratch_path(spark, "substrings")
    schema = "fp long, c1 long, c2 long, id long, tag long, pos int"
    anchors = texts.mapInArrow(_anchors(window, gram), schema)
    prints = texts.select("text").mapInArrow(_fingerprints_only(window, gram), "fp long")
    twice = written(prints.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), f"{folder}/twice")
    repeated = written(anchors.join(twice, "fp"), f"{folder}/repeated")

    contexts = written(
        repeated.groupBy("fp", "c1", "c2").agg(F.min(_place("pos")).alias("first"), F.count("*").alias("n")),
        f"{folder}/contexts",
    )
    reach = F.struct(
        F.greatest(F.col("pos") - (window - gram), F.lit(0)).alias("lo"), (F.col("pos") + window).alias("hi")
    )
    copies = repeated.join(contexts.where("n > 1").select("fp", "c1", "c2", "first"), ["fp", "c1", "c2"]).where(
        _place("pos") > F.col("first")
    ).select("id", "tag", reach.alias("s")).select("id", "tag", "s.lo", "s.hi")
    copies = written(copies, f"{folder}/copies")

    several = contexts.groupBy("fp").agg(F.count("*").alias("held")).where("held > 1")
    wanted = (
        repeated.join(contexts.select("fp", "c1", "c2", "first").join(several, "fp"), ["fp", "c1", "c2"])
        .where(_place("pos") == F.col("first"))
        .groupBy("id", "tag")
        # an anchor's place, and in the last bit whether it is a heavy one
        .agg(F.collect_list(F.col("pos") * 2 + (F.col("held") > shard_passages).cast("int")).alias("wanted"))
    )
    wanted = written(wanted, f"{folder}/wanted")
    for over in ("twice", "repeated", "contexts"):
        drop_scratch(spark, f"{folder}/{over}")
    passages = written(
        texts.join(wanted, ["id", "tag"])
        .select("id", "tag", "text", "wanted")
        .mapInArrow(_passages(window, gram), "fp long, heavy boolean, id long, tag long, start int, anchor int, words binary"),
        f"{folder}/passages",
    )
    light = passages.where("not heavy")
    shards = buckets_for(light.count(), shard_passages)
    matched = (
        light.withColumn("shard", F.pmod(F.xxhash64("fp"), F.lit(shards)))
        .select("shard", "id", "tag", "start", "words")
        .groupBy("shard")
        .applyInPandas(lambda p: _through_automaton(window)(p), "id long, tag long, lo int, hi int")
    )
    heavy = _by_window_hash(passages.where("heavy"), window, gram)
    spans = copies.unionByName(matched).unionByName(heavy)
    span = F.shiftleft(F.col("lo").cast("long"), 32) + F.col("hi")
    per_text = spans.groupBy("id", "tag").agg(F.collect_list(span).alias("spans"))
    merged = checkpointed(per_text.mapInArrow(_merge_spans, "id long, tag long, spans array<int>"))
    drop_scratch(spark, folder)
    return merged


def _cut_text(raw: bytes, spans: list[int] | None) -> tuple[int, int, str]:
    """Words of a text, how many of them go, and the others."""
    own = raw.split()  # on the same six ASCII blanks
    if not spans:
        return len(own), 0, b" ".join(own).decode()
    kept = []
    at = 0
    for lo, hi in zip(spans[::2], spans[1::2], strict=True):
        kept += own[at:lo]
        at = hi
    kept += own[at:]
    return len(own), len(own) - len(kept), b" ".join(kept).decode()


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    shard_passages: int = SHARD_PASSAGES,
) -> DataFrame:
    """Every row of ``docs`` plus ``n_words``, ``n_removed`` and ``kept_text``
    (the kept words, joined by one blank).

    NULL or empty text: no words, ``kept_text`` empty. Texts shorter than the
    window lose nothing. Rows that share an id are one document: of equal
    windows at equal places in them none is the earlier one. Rows with a NULL
    id are documents of their own, in no stated order, after all others: of
    copies of a passage in them one stays. Columns of ``docs`` with the made names are replaced.
    An empty table gives no rows.
    """
    require_columns(docs, id_col, text_col)
    made = ("n_words", "n_removed", "kept_text")
    kept = [c for c in docs.columns if c not in made or c in (id_col, text_col)]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    named = docs.withColumns({"__id": F.col(id_col).cast("long"), "__tag": F.hash(F.col(text_col)).cast("long")})
    # their turns are numbers of rows, fixed by a checkpoint of those rows
    turn = F.monotonically_increasing_id() + F.lit(FIRST_TURN + 1)
    unnamed = checkpointed(docs.where(F.col(id_col).isNull()).withColumns({"__id": F.lit(LAST_ID), "__tag": turn}))
    docs = named.where(F.col(id_col).isNotNull()).unionByName(unnamed)
    texts = docs.select(F.col("__id").alias("id"), F.col("__tag").alias("tag"), F.col(text_col).alias("text"))
    spans = repeated_spans(texts, window, gram, shard_passages)
    joined = docs.join(
        spans.select(F.col("id").alias("__id"), F.col("tag").alias("__tag"), F.col("spans").alias("__spans")), ["__id", "__tag"], "left"
    ).select(*[F.col(f"`{c}`") for c in kept], "__spans")
    fields = [f for f in joined.schema.fields if f.name != "__spans"]
    schema = T.StructType(
        [*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    )

    def cut(batches):
        for batch in batches:
            for rows, offsets, data in chunks_of(batch, text_col):
                raw, at = data.tobytes(), offsets.tolist()
                spans = rows.column("__spans").to_pylist()
                found = [_cut_text(raw[lo:hi], s) for lo, hi, s in zip(at[:-1], at[1:], spans, strict=True)]
                n, removed, texts_kept = (list(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*rows.drop_columns(["__spans"]).columns, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts_kept, pa.string())],
                    names=schema.names,
                )

    return joined.mapInArrow(cut, schema)

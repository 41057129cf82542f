"""Near-duplicates by SuperMinHash, banding, verification and union-find.

1. *Signatures.* A document is the set of its distinct word shingles.
   SuperMinHash gives every shingle a random permutation of the signature's
   places and, at the j-th place of it, a value in [j, j + 1); a place keeps
   the smallest value it is given. Values of one shingle are spread over the
   places by one permutation, which lowers the variance against plain
   MinHash, and a document stops at the level where no place can improve:
   long documents after the first or second.
2. *Classes.* Documents with equal word sequences fall together by a 128-bit
   BLAKE2 hash of their words' bytes, map-side first, so thousands of copies
   are one row from here. Classes are the nodes; ids are labels that they
   carry, so rows that share an id but not the text are apart.
3. *Banding.* Each class goes into one bucket per band of its signature. Two sets of the threshold's similarity or more share
   none of the buckets with probability ``(1 - s**rows)**bands`` at most
   (2e-8 for 0.85, 3e-6 for 0.8, with the defaults).
4. *Verification.* Links are confirmed on full sets of the words' own bytes,
   not of their hashes, and pairs of a bucket are never all emitted. Every class
   is first compared with the smallest class it meets; buckets whose documents are then in one component are
   done, which settles groups of close copies at one comparison each. In any
   other bucket the documents outside its largest component are compared
   with all of other components: pair by pair in small buckets, and in larger
   ones by blocks of sets inside a task, which returns links only, one fewer
   than it has components at most. That decides every candidate pair, by comparison or because both ends are
   connected already.
5. *Grouping.* Confirmed links are grouped by union-find; a component's name
   is the smallest id of its classes.

Scale. Buckets shuffle 24 bytes per class and band. Texts move once, to pick
one of each class that met another one; these move with their pairs and
blocks. A bucket that holds a third of all rows costs one comparison per row
as far as its documents are alike; documents in it that resemble none have to
be compared with all (nothing short of that proves that no link is lost), by
tasks of two blocks each.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import checkpointed, keyed_table, require_columns
from revmart.llm.components import connected_components
from revmart.llm.words import Words, gram_hashes, joined_bytes, mix64, words_of
from revmart.llm.workers import release_memory

SHINGLE_WORDS = 5
THRESHOLD = 80
BANDS = 24
ROWS = 4
#: Up to so many documents a bucket is compared pair by pair, above in blocks of so many.
SMALL_BUCKET = 16
BLOCK = 512

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(48)  # a value is its level and 48 random bits
_UNSET = np.uint64((1 << 64) - 1)
SIGNED = "id long, print long, n long, f1 long, f2 long, bands array<long>"


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' distinct shingle hashes, sorted, one after the other, and
    where each text's begin. Fewer words than ``size``: all of them as one
    shingle; no words: none."""
    grams = gram_hashes(words.hashes, size)
    sets = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= size:
            sets.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            sets.append(gram_hashes(words.hashes[a:b], int(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), first


def _draw(shingles: np.ndarray, k: int) -> np.ndarray:
    return mix64(shingles + np.uint64((k + 1) * int(_GOLD) % (1 << 64)))


def superminhash(shingles: np.ndarray, first: np.ndarray, places: int) -> np.ndarray:
    """Signatures (texts x places) of the sets that ``first`` cuts out of ``shingles``."""
    texts = len(first) - 1
    signature = np.full((texts, places), _UNSET)
    flat = signature.reshape(-1)
    text = np.repeat(np.arange(texts), np.diff(first))
    live = np.diff(first) > 0
    order = None  # each shingle's permutation so far, from the second level on
    for level in range(places):
        pick = level + (_draw(shingles, 2 * level) % np.uint64(places - level)).astype(np.int64)
        value = (np.uint64(level) << _LEVEL) | (_draw(shingles, 2 * level + 1) >> np.uint64(16))
        if order is None:
            place = pick
        else:
            at = np.arange(len(shingles))
            place = order[at, pick].astype(np.int64)
            order[at, pick] = order[:, level]
        np.minimum.at(flat, text * places + place, value)
        # a text goes on while one of its places may still get a lower value
        live &= (signature >> _LEVEL).max(axis=1) > level
        stay = live[text]
        if not stay.any():
            break
        if order is None:
            order = np.tile(np.arange(places, dtype=np.uint16), (int(stay.sum()), 1))
            order[np.arange(len(order)), pick[stay]] = 0
        elif not stay.all():
            order = order[stay]
        if not stay.all():
            shingles, text = shingles[stay], text[stay]
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket key per text and band."""
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=np.uint64)
        for r in range(rows):
            key = mix64(key * _GOLD + signature[:, b * rows + r])
        keys[:, b] = key
    return keys.view(np.int64)


def _fingerprints(words: Words) -> list[np.ndarray]:
    """A 128-bit hash of each text's words, as two longs."""
    joined, at = joined_bytes(words, lower=True)
    ends = at[words.first].tolist()
    digests = b"".join(blake2b(joined[a:b], digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:], strict=True))
    halves = np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)
    return [halves[:, 0].copy(), halves[:, 1].copy()]


def _sign(size: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints_of_texts = batch.column("id"), batch.column("print")
            for words in words_of(batch.column("text"), lower=True):
                shingles, first = shingle_sets(words, size)
                counts = np.diff(first)
                prints = _fingerprints(words)
                keys = band_keys(superminhash(shingles, first, bands * rows), bands, rows)
                offsets = pa.array(np.arange(len(counts) + 1) * bands, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(words.rows.start, len(words.rows)),
                        prints_of_texts.slice(words.rows.start, len(words.rows)),
                        pa.array(counts.astype(np.int64)),
                        pa.array(prints[0]),
                        pa.array(prints[1]),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1))),
                    ],
                    names=["id", "print", "n", "f1", "f2", "bands"],
                )

    return sign


def _shingles(text: bytes, size: int) -> set[tuple[bytes, ...]]:
    """The set of a text's shingles, byte by byte."""
    words = text.lower().split()  # of bytes: A-Z, and on the same six ASCII blanks
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)], strict=False))


def _similar(a: set, b: set, threshold: int) -> bool:
    shared = len(a & b)
    return 100 * shared >= threshold * (len(a) + len(b) - shared)


def _linked(size: int, threshold: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, set()  # many pairs in a row have the same right side
        for batch in batches:
            left, right, nodes = batch.column("a_text"), batch.column("b_text"), batch.column("b").to_pylist()
            keep = np.zeros(len(batch), dtype=bool)
            for i, node in enumerate(nodes):
                if node != held:
                    held, own = node, _shingles(right[i].as_buffer().to_pybytes(), size)
                keep[i] = _similar(_shingles(left[i].as_buffer().to_pybytes(), size), own, threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
            release_memory()

    return linked


def _alike(a: str, b: str, threshold: int):
    """What the sizes alone allow: the smaller set must be the threshold's share of the larger."""
    return F.lit(100) * F.least(a, b) >= F.lit(threshold) * F.greatest(a, b)


def _verified(pairs: DataFrame, held: DataFrame, size: int, threshold: int) -> DataFrame:
    """The links (``u``, ``v``) among ``pairs`` (``a``, ``b``)."""
    left = held.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = held.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return checkpointed(full.mapInArrow(_linked(size, threshold), "a long, b long").select(F.col("a").alias("u"), F.col("b").alias("v")))


def _first_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """Every class with the one of smallest id that it shares a bucket with."""
    smallest = keyed_table(members.groupBy("key").agg(F.min(F.struct("id", "node", "n")).alias("c")))
    met = members.join(smallest, "key").groupBy("node", "n").agg(F.min("c").alias("c"))
    return met.where((F.col("node") != F.col("c.node")) & _alike("n", "c.n", threshold)).select(F.col("node").alias("a"), F.col("c.node").alias("b"))


def _unsettled(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with ``label``,
    ``odd`` (not of the bucket's largest component), the bucket's size
    ``held`` and how many of it are ``odd_held``."""
    labelled = checkpointed(
        members.select("key", "node", "n")
        .join(components, "node", "left")
        .withColumn("label", F.coalesce("component", "node"))
        .drop("component")
    )
    sizes = labelled.groupBy("key", "label").agg(F.count("*").alias("c"))
    open_keys = sizes.groupBy("key").agg(
        F.count("*").alias("labels"), F.sum("c").alias("held"), F.max(F.struct("c", "label")).alias("top")
    ).where("labels > 1").select("key", "held", (F.col("held") - F.col("top.c")).alias("odd_held"), F.col("top.label").alias("top"))
    marked = labelled.join(keyed_table(open_keys), "key").withColumn("odd", F.col("label") != F.col("top")).drop("top")
    return checkpointed(marked)


def _small_links(small: DataFrame, held: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links between components in small buckets, pair by pair."""
    o = small.where("odd").select("key", F.col("node").alias("o_node"), F.col("n").alias("o_n"), F.col("label").alias("o_label"))
    met = small.join(o, "key").where((F.col("label") != F.col("o_label")) & _alike("n", "o_n", threshold))
    pairs = met.select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct()
    return _verified(pairs, held, size, threshold)


def _block_links(size: int, threshold: int):
    """Links between components among the texts of one or two blocks."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t.encode() for t in rows["text"]]
        parts = []
        for words in words_of(pa.array(rows["text"], pa.string()), lower=True):
            own, first = shingle_sets(words, size)
            parts += [own[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        sizes = np.array([len(p) for p in parts])
        vocabulary, shingles = np.unique(np.concatenate(parts), return_inverse=True)
        first = np.concatenate([[0], np.cumsum(sizes)])
        label, nodes, mark = rows["label"].to_numpy(), rows["node"].to_numpy(), np.zeros(len(vocabulary), dtype=np.int64)
        found = []
        labels, place = np.unique(label, return_inverse=True)
        joined = np.arange(len(labels))  # each label's group over the links found here: a link joins two, so labels bound their number
        for i in np.flatnonzero(rows["odd"].to_numpy()):
            own = shingles[first[i] : first[i + 1]]
            mark[own] = 1
            shared = np.add.reduceat(mark[shingles], first[:-1])
            mark[own] = 0
            alike = np.flatnonzero((100 * shared >= threshold * (sizes + sizes[i] - shared)) & (label != label[i]))
            # those that earlier links join already need none
            alike = alike[joined[place[alike]] != joined[place[i]]]
            exact = _shingles(texts[i], size) if len(alike) else set()
            for j in alike:
                mine, other = joined[place[i]], joined[place[j]]
                if mine != other and _similar(exact, _shingles(texts[j], size), threshold):
                    joined[joined == max(mine, other)] = min(mine, other)
                    found.append((int(nodes[i]), int(nodes[j])))
        return pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    return links


def _large_links(large: DataFrame, held: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links between components in large buckets: every block that holds odd
    classes with every other block. A bucket's odd classes are dealt by
    hash to its first blocks, the others to the rest, ``BLOCK`` to a block."""
    odd_blocks = F.ceil(F.col("odd_held") / F.lit(BLOCK))
    other_blocks = F.ceil((F.col("held") - F.col("odd_held")) / F.lit(BLOCK))
    place = F.xxhash64(F.lit("block"), "node")
    block = F.when(F.col("odd"), F.pmod(place, odd_blocks)).otherwise(odd_blocks + F.pmod(place, other_blocks))
    placed = large.select(
        "key", "node", "label", "odd", block.cast("int").alias("block"),
        (odd_blocks + other_blocks).cast("int").alias("blocks"), odd_blocks.cast("int").alias("odd_blocks"),
    )
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = F.transform(others, lambda k: F.struct(F.least(k, "block").alias("p"), F.greatest(k, "block").alias("q")))
    useful = F.filter(pairs, lambda x: x["p"] < F.col("odd_blocks"))
    sent = placed.select("key", "node", "label", "odd", F.explode(useful).alias("pair"))
    full = sent.join(held, "node").select("key", "pair", "node", "label", "odd", "text")
    return checkpointed(full.groupBy("key", "pair").applyInPandas(lambda r: _block_links(size, threshold)(r), "u long, v long").distinct())


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    threshold: int = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``class_id`` (the
    smallest id with the same words in the same order), ``component_id`` (the
    smallest id reachable over links, its own included) and ``kept`` (it is that id).

    A link is ``100 * intersection >= threshold * union`` of the sets of
    distinct shingles of ``shingle_words`` words, ASCII letters lower-cased.

    NULL or empty text, or one of blanks: the empty set, linked with nothing.
    Rows that share an id go each by its own text. Ids are numbers (anything
    else is refused by the cast). A NULL id never stands for a component; rows of a class without any id have NULL ``class_id`` and
    ``component_id`` and are kept. An empty table gives no rows. Other columns
    are not read.
    """
    found = _verdicts(docs, id_col, text_col, shingle_words, threshold, bands, rows)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "class_id", "component_id", "kept")


def distinct_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, each by its own
    verdict, and of rows that share the id and the component one: of rows with
    one id and texts that resemble nothing each other all stay.

    A NULL id names no group: of rows without an id that have the same words one
    stays, and so do all without words.
    """
    found = _verdicts(docs, id_col, text_col, shingle_words, threshold, BANDS, ROWS)
    # of the texts of a component, the one with the smallest hash
    chosen = found.where("kept and id is not null").groupBy("id", "node").agg(F.min("print").alias("print"))
    named = docs.where(F.col(id_col).isNotNull()).withColumns({"__id": F.col(id_col).cast("long"), "__print": _print(text_col)})
    named = named.join(chosen.select(F.col("id").alias("__id"), F.col("print").alias("__print")), ["__id", "__print"], "left_semi")
    named = named.dropDuplicates(["__id", "__print"]).select(*[F.col(f"`{c}`") for c in docs.columns])
    nameless = found.where("id is null")
    first = nameless.where("n > 0").groupBy("f1", "f2").agg(F.min("print").alias("__print")).select("__print")
    empty = nameless.where("n = 0").select(F.col("print").alias("__print")).distinct()
    unnamed = docs.where(F.col(id_col).isNull()).withColumn("__print", _print(text_col))
    copies = unnamed.join(first, "__print", "left_semi").dropDuplicates(["__print"])
    unnamed = copies.unionByName(unnamed.join(empty, "__print", "left_semi")).select(*[F.col(f"`{c}`") for c in docs.columns])
    return named.unionByName(unnamed)


def _print(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def _verdicts(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, threshold: int, bands: int, rows: int) -> DataFrame:
    """Per row ``id``, its text's hash ``print``, its class (``n``, ``f1``,
    ``f2``), the component's ``node`` (NULL without words), ``class_id``,
    ``component_id`` and ``kept``."""
    require_columns(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), _print(text_col).alias("print"))
    signed = checkpointed(texts.mapInArrow(_sign(shingle_words, bands, rows), SIGNED))
    row = F.when(F.col("id").isNotNull(), F.struct("id", "print"))
    classes = signed.where("n > 0").groupBy("f1", "f2").agg(F.min("n").alias("n"), F.min(row).alias("row"), F.first("bands").alias("bands"))
    # numbers of classes, fixed by the checkpoint
    classes = checkpointed(classes.withColumn("node", F.monotonically_increasing_id()))

    banded = classes.where("row is not null").select(F.explode("bands").alias("key"), F.col("row.id").alias("id"), "node", "n")
    shared = keyed_table(banded.groupBy("key").agg(F.count("*").alias("held")).where("held > 1").select("key"))
    members = checkpointed(banded.join(shared, "key"))
    components = _components(texts, classes, members, shingle_words, threshold)

    named = classes.select("node", "f1", "f2", F.col("row.id").alias("class_id"))
    linked = named.select("node", "class_id").join(components, "node")
    labels = keyed_table(linked.groupBy("component").agg(F.min("class_id").alias("label")))
    labelled = linked.join(labels, "component").select("node", "component", "label")
    placed = named.join(labelled, "node", "left").select(
        "f1", "f2", "class_id", F.coalesce("component", "node").alias("node"), F.coalesce("label", "class_id").alias("label")
    )
    found = signed.select("id", "print", "n", "f1", "f2").join(placed, ["f1", "f2"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("label"))
    return found.select(
        "id", "print", "n", "f1", "f2", "node",
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        component.alias("component_id"),
        (component.isNull() | F.coalesce(F.col("id") == component, F.lit(False))).alias("kept"),
    )


def _components(texts: DataFrame, classes: DataFrame, members: DataFrame, size: int, threshold: int) -> DataFrame:
    """Components (``node``, ``component``) of the links among ``members`` of the buckets."""
    rows = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("row.id").alias("id"), F.col("row.print").alias("print"))
    held = checkpointed(texts.join(rows, ["id", "print"]).select("node", "text").dropDuplicates(["node"]))
    links = _verified(_first_pairs(members, threshold), held, size, threshold)
    components = checkpointed(connected_components(links))
    unsettled = _unsettled(members, components)
    links = (
        links.unionByName(_small_links(unsettled.where(F.col("held") <= SMALL_BUCKET), held, size, threshold))
        .unionByName(_large_links(unsettled.where(F.col("held") > SMALL_BUCKET), held, size, threshold))
    )
    return checkpointed(connected_components(links))

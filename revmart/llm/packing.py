"""Packing documents into sequences by the sum-of-squares rule.

Documents become token ids plus an end id. Longer ones than a sequence are
cut into whole sequences, the shorter rest coming first. Every other piece is
placed, largest first, in the open sequence for which the sum over gap sizes
of (open sequences with that gap) squared becomes smallest: placing it takes
one sequence from the count of its gap and adds one to the count of what
remains, so gaps that many sequences share are used up and rare ones kept for
the documents that fit them. A sequence is opened only for a piece that fits
no open one.

Scale. A document has one piece at most that is shorter than a sequence. These
are dealt by hash into groups of about ``docs_per_group``, each packed on its
own: a group's open sequences are a table of counts by gap, so a task holds a
few columns of its group and nothing that grows with the corpus. What a group
leaves unfilled is about one sequence. Full pieces need no packing; they are
dealt to groups of their own, whose number follows from the bytes of all texts (a
token has one at least), and numbered there.
Ids need not be shuffled: only what the caller keeps of a piece is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.llm.common import buckets_for, require_columns
from revmart.llm.encoding import byte_encoder

SEQUENCE = 2048
END_ID = 0
DOCS_PER_GROUP = 8192
FULL_PER_GROUP = 1 << 17
#: Ids sent to the JVM at a time.
BATCH_IDS = 1 << 20


def piece_starts(n: int, sequence: int) -> list[int]:
    """Where the pieces of ``n`` ids begin: the shorter one first."""
    rest = n % sequence
    return ([0] if rest else []) + list(range(rest, n, sequence))


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    tokenizer_path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """One row per piece: the document's id, ``piece`` (from 0), ``start``
    (ids before it), ``length`` and ``ids`` (binary, little-endian 32-bit).

    Ids are those of a plain ``encode`` without special tokens added. NULL text
    is empty: a document of the end id alone. Repeated rows are documents of
    their own.
    """
    require_columns(docs, id_col, text_col)
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer_path, ranks_path, control_ids=True)

        def rows_of(rows: list[tuple], own: pa.Array) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [own.take(pa.array(columns[0])), *[pa.array(c, f) for c, f in zip(columns[1:], (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)]],
                names=schema.names,
            )

        for batch in batches:
            own, texts = batch.column(0), batch.column(1)
            rows, held = [], 0
            for i in range(len(batch)):
                ids = np.append(encoder.ids(texts[i].as_py() or ""), np.array([end_id], dtype="<u4"))
                starts = piece_starts(len(ids), sequence)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    rows.append((i, k, a, b - a, ids[a:b].tobytes()))
                held += len(ids)
                if held >= BATCH_IDS:
                    yield rows_of(rows, own)
                    rows, held = [], 0
            if rows:
                yield rows_of(rows, own)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def pack_lengths(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """A sequence (from 0) and an offset in it for every length up to ``sequence``."""
    open_by_used: list[list[int]] = [[] for _ in range(sequence + 1)]
    count = np.zeros(sequence + 1, dtype=np.int64)
    used: list[int] = []
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        levels = np.flatnonzero(count[: sequence - size + 1])
        if len(levels):
            after = levels + size
            # change of the sum of squares; a sequence that becomes full leaves the sum
            change = np.where(after < sequence, 2 * count[after] + 1, 0) - 2 * count[levels] + 1
            level = int(levels[len(levels) - 1 - change[::-1].argmin()])  # the fullest among equals
            to = open_by_used[level].pop()
            count[level] -= 1
        else:
            level, to = 0, len(used)
            used.append(0)
        where[i], offset[i] = to, level
        used[to] = level + size
        if used[to] < sequence:
            open_by_used[used[to]].append(to)
            count[used[to]] += 1
    return where, offset


def pack_pieces(
    pieces: DataFrame, groups: int, sequence: int = SEQUENCE, key_cols: tuple[str, ...] = ("doc_id", "piece"), full_groups: int = 1
) -> DataFrame:
    """Every row of ``pieces`` (any columns, with ``length``) plus
    ``sequence_id`` and ``offset`` (its place in that sequence).

    ``key_cols`` deal the pieces to ``groups`` groups, full ones to
    ``full_groups`` more; sequences of different groups differ in id. Ties go
    by the key columns, so reruns agree.
    """
    require_columns(pieces, "length", *key_cols)
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = T.StructType(
        [pieces.schema[c] for c in columns] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(list(key_cols), kind="stable", ignore_index=True)
        if key[0] >= groups:
            where, offset = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        else:
            where, offset = pack_lengths(rows["length"].to_numpy(), sequence)
        return rows[columns].assign(sequence_id=(int(key[0]) << 32) + where, offset=offset)

    place = F.xxhash64(F.lit("pack"), *key_cols)
    group = F.when(F.col("length") < sequence, F.pmod(place, F.lit(groups))).otherwise(F.pmod(place, F.lit(full_groups)) + groups)
    return pieces.select(*columns).withColumn("__group", group).groupBy("__group").applyInPandas(lambda k, r: pack(k, r), schema)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    docs_per_group: int = DOCS_PER_GROUP,
    with_ids: bool = False,
    **tokenizer,
) -> DataFrame:
    """One row per piece of every row of ``docs``: its id, ``piece``,
    ``start``, ``length``, ``ids_crc32`` (of the ids as little-endian 32-bit),
    ``sequence_id``, ``offset``, and ``ids`` if asked for.

    See ``token_pieces`` for NULL, empty and repeated rows. NULL ids are
    documents like others. An empty table gives no rows.
    """
    pieces = token_pieces(docs, id_col, text_col, sequence, **tokenizer)
    kept = [id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32")]
    pieces = pieces.select(*kept, *(["ids"] if with_ids else []))
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()
    full_groups = buckets_for(size // sequence, FULL_PER_GROUP)
    return pack_pieces(pieces, buckets_for(rows, docs_per_group), sequence, (id_col, "piece", "ids_crc32"), full_groups)

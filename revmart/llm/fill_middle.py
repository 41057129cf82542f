"""Fill-in-the-middle transformation over piece tables.

A document is a piece table: a list of descriptors ``(buffer, start, length)``
over two immutable buffers, the batch's UTF-8 bytes and the sentinels. No
operation moves text:

* *cutting* at a byte splits the descriptor that holds it;
* an *arrangement* permutes the descriptors and puts sentinel descriptors
  between them;
* *restoring* finds the sentinels in an arranged text, makes a descriptor of
  each part and applies the inverse permutation;
* *hashing* streams the descriptors' bytes into SHA-256; *writing* joins them.

A document is cut at two line ends. ``psm`` is ``<P>`` prefix ``<S>`` suffix
``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, and a
text that is empty, that holds a sentinel or that the draw leaves out stays
``plain``. All draws follow from a SHA-256 of the document's id.

Scale. A narrow transformation on Arrow batches, nothing is shuffled. A batch
is worked on in stretches of a few megabytes (or one longer document).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.llm.common import require_columns
from revmart.llm.words import chunks_of

SEED = 7
#: Percent of the documents that are arranged, and of these as ``spm``.
RATE, SPM_RATE = 100, 50

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT_BUFFER, SENTINEL_BUFFER = 0, 1
#: Forms as orders of the parts (0 prefix, 1 middle, 2 suffix), each part behind its own sentinel.
ARRANGEMENTS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
SENTINEL_OF = (PREFIX, MIDDLE, SUFFIX)


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


def sentinel_piece(sentinel: bytes) -> Piece:
    return Piece(SENTINEL_BUFFER, SENTINELS.index(sentinel), len(sentinel))


def cut(table: list[Piece], at: int) -> int:
    """Split the piece that byte ``at`` of the table's text lies in; the index
    of the piece that begins there. Splitting at the table's end is allowed."""
    for i, piece in enumerate(table):
        if at <= 0:
            return i
        if at < piece.length:
            table[i : i + 1] = [Piece(piece.buffer, piece.start, at), Piece(piece.buffer, piece.start + at, piece.length - at)]
            return i + 1
        at -= piece.length
    return len(table)


def parts_of(start: int, length: int, ends: tuple[int, int]) -> list[list[Piece]]:
    """A document of the text buffer cut into prefix, middle and suffix at two of its bytes."""
    table = [Piece(TEXT_BUFFER, start, length)]
    first = cut(table, ends[0])
    second = cut(table, ends[1])
    return [table[:first], table[first:second], table[second:]]


def arrange(parts: list[list[Piece]], form: str) -> list[Piece]:
    """The parts in the form's order, each behind its sentinel."""
    return [piece for part in ARRANGEMENTS[form] for piece in (sentinel_piece(SENTINEL_OF[part]), *parts[part])]


def restore(data: bytes, start: int, length: int, form: str) -> list[Piece]:
    """The document that an arranged text of the buffer ``data`` was made of:
    its parts found by their sentinels, and the inverse permutation of them.

    The sentinels are found from the left: an arranged document holds none of
    its own, and no sentinel can begin inside another.
    """
    if form not in ARRANGEMENTS:
        return [Piece(TEXT_BUFFER, start, length)]
    order = ARRANGEMENTS[form]
    end = start + length
    at, marks = start, []
    for part in order:
        at = data.index(SENTINEL_OF[part], at, end)
        marks.append(at)
        at += len(SENTINEL_OF[part])
    found: list[Piece] = [Piece(TEXT_BUFFER, 0, 0)] * len(order)
    for i, part in enumerate(order):
        begin = marks[i] + len(SENTINEL_OF[part])
        found[part] = Piece(TEXT_BUFFER, begin, (marks[i + 1] if i + 1 < len(order) else end) - begin)
    return found


def stream(table: list[Piece], data: memoryview) -> Iterator[memoryview]:
    """The table's bytes, piece by piece, without a copy."""
    held = (data, memoryview(SENTINELS))
    for buffer, start, length in table:
        yield held[buffer][start : start + length]


def write(table: list[Piece], data: memoryview) -> str:
    return b"".join(stream(table, data)).decode()


def digest(table: list[Piece], data: memoryview) -> str:
    """SHA-256 of the table's text as lowercase hex."""
    sha = hashlib.sha256()
    for part in stream(table, data):
        sha.update(part)
    return sha.hexdigest()


def _draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit draws of an id."""
    hexes = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(hexes[k : k + 8], 16) for k in (0, 8, 16, 24)]


class _Places(NamedTuple):
    """Line ends and code points of a batch's bytes."""

    line_ends: np.ndarray  # bytes after each \n
    others: np.ndarray  # bytes that begin no code point

    @classmethod
    def of(cls, data: np.ndarray) -> _Places:
        return cls(np.flatnonzero(data == 10) + 1, np.flatnonzero((data & 0xC0) == 0x80))

    def chars(self, lo: int, hi: int) -> int:
        return hi - lo - int(np.searchsorted(self.others, hi) - np.searchsorted(self.others, lo))


def _formed(id_col: str, text_col: str, seed: int, rate: int, spm_rate: int, schema: T.StructType):
    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, offsets, data in (c for b in batches for c in chunks_of(b, text_col)):
            raw = data.tobytes()
            whole = memoryview(raw)
            places = _Places.of(data)
            ids = batch.column(id_col).to_pylist()
            columns: list[list] = [[] for _ in MADE]
            for doc_id, start, end in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                first = int(np.searchsorted(places.line_ends, start, side="right"))
                last = int(np.searchsorted(places.line_ends, end, side="right"))
                # the last unit may lack a line end
                n = last - first + int(end > start and raw[end - 1] != 10)
                h1, h2, h3, h4 = _draws(doc_id, seed)
                if start == end or any(raw.find(s, start, end) >= 0 for s in SENTINEL_OF) or h3 % 100 >= rate:
                    row = (n, "plain", None, None, write([Piece(TEXT_BUFFER, start, end - start)], whole))
                else:
                    unit_end = lambda k: start if k == 0 else int(places.line_ends[first + k - 1]) if first + k <= last else end  # noqa: B023, E731
                    a, b = (unit_end(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    form = "spm" if h4 % 100 < spm_rate else "psm"
                    table = arrange(parts_of(start, end - start, (a - start, b - start)), form)
                    row = (n, form, places.chars(start, a), places.chars(a, b), write(table, whole))
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
            kept = [batch.column(f.name) for f in schema.fields if f.name not in MADE]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    return formed


MADE = ("n_lines", "form", "prefix_chars", "middle_chars", "formed_text")


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """Every row of ``docs`` plus ``n_lines``, ``form`` (``plain``, ``psm`` or
    ``spm``), ``prefix_chars`` and ``middle_chars`` (code points; NULL if
    plain) and ``formed_text``.

    Ids are numbers; a NULL id draws as the empty string. NULL or empty text:
    no lines, ``plain``, an empty ``formed_text``. Rows that share an id draw
    alike, each cut by its own lines. Columns of ``docs`` with the made names
    are replaced. An empty table gives no rows.
    """
    require_columns(docs, id_col, text_col)
    clash = {id_col, text_col} & set(MADE)
    if clash:
        raise ValueError(f"the id and text columns may not be named {sorted(clash)}")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in MADE])
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in zip(MADE, kinds, strict=True)]])
    return docs.mapInArrow(_formed(id_col, text_col, seed, rate, spm_rate, schema), schema)


def restored_digests(formed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Formed texts read back: ``n_lines``, ``form``, ``prefix_chars``,
    ``middle_chars``, and the SHA-256 of the text as it is (``output_sha256``)
    and of the document restored from it and its form (``restored_sha256``)."""
    needed = formed.select(F.col(id_col), *MADE)
    fields = [f for f in needed.schema.fields if f.name != "formed_text"]
    schema = T.StructType([*fields, T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, offsets, data in (c for b in batches for c in chunks_of(b, "formed_text")):
            raw = data.tobytes()
            whole = memoryview(raw)
            out, back = [], []
            for form, start, end in zip(batch.column("form").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                out.append(digest([Piece(TEXT_BUFFER, start, end - start)], whole))
                back.append(digest(restore(raw, start, end - start, form), whole))
            kept = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.string()), pa.array(back, pa.string())], names=schema.names)

    return needed.mapInArrow(read, schema)

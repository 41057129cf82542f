"""Token counts that follow edits.

Every document keeps a segment tree over its pre-tokens. The leaves are runs
of pre-tokens between *safe cuts*: a single blank with a non-blank on either
side always starts a pre-token and nothing before or after it changes how the
two sides are encoded. A leaf knows its characters and tokens, an inner node
the sums of its subtree, so the place of an edit is found, and the total
brought up to date, along one path.

An edit touches the leaves under it plus, as context, the neighbours whose
cut lies within a character of it. Only their text is cut and encoded again.

Scale. The first count and the edits are narrow: one pass over the texts, no
shuffle. A state row (text and leaves) is what a store of documents would
keep; ``edit_documents`` takes it back with the edits in an array column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmart.llm.common import require_columns
from revmart.llm.encoding import ByteEncoder, byte_encoder

#: A leaf ends at the first safe cut after so many characters.
LEAF_CHARS = 256
_STATE = ["n_tokens", "leaf_chars", "leaf_tokens"]


def _cut_pattern(leaf_chars: int) -> re.Pattern[str]:
    # the longest first part is fixed, so the search never backs up (compiled once: re keeps it)
    return re.compile(r"(?s:.){%d}(?s:.)*?(?=(?<=\S) \S)" % leaf_chars)


def safe_leaves(text: str, leaf_chars: int = LEAF_CHARS) -> list[str]:
    """The text cut into leaves."""
    leaves, at, pattern = [], 0, _cut_pattern(leaf_chars)
    while at < len(text):
        found = pattern.match(text, at)
        end = found.end() if found else len(text)
        leaves.append(text[at:end])
        at = end
    return leaves


class TokenTree:
    """Sums of characters and tokens over the leaves, as two binary heaps."""

    def __init__(self, chars: Sequence[int], tokens: Sequence[int]) -> None:
        self._size = 1
        while self._size < len(chars):
            self._size *= 2
        self.leaves = len(chars)
        self._chars, self._tokens = ([0] * (2 * self._size) for _ in range(2))
        self._chars[self._size : self._size + len(chars)] = chars
        self._tokens[self._size : self._size + len(tokens)] = tokens
        for node in range(self._size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
        self._tokens[node] = self._tokens[2 * node] + self._tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self._tokens[1]

    def leaf_chars(self) -> list[int]:
        return self._chars[self._size : self._size + self.leaves]

    def leaf_tokens(self) -> list[int]:
        return self._tokens[self._size : self._size + self.leaves]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last leaf past
        the end), and where it starts."""
        node, start = 1, 0
        while node < self._size:
            node *= 2
            if place >= start + self._chars[node] and start + self._chars[node] < self._chars[1]:
                start += self._chars[node]
                node += 1
        return node - self._size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """New sums of a leaf, carried up to the root."""
        node = leaf + self._size
        self._chars[node], self._tokens[node] = chars, tokens
        while node > 1:
            node //= 2
            self._sum(node)


class CountedText:
    """A text with its tree; ``reencoded`` counts the characters encoded again."""

    def __init__(self, text: str, encoder: ByteEncoder, leaf_chars: int, chars=None, tokens=None) -> None:
        self.text, self._encoder, self._leaf_chars, self.reencoded = text, encoder, leaf_chars, 0
        if chars is None:
            parts = safe_leaves(text, leaf_chars) or [""]
            chars, tokens = [len(p) for p in parts], [encoder.count(p) for p in parts]
        self.tree = TokenTree(chars or [0], tokens or [0])

    def edit(self, start: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters from ``start`` on; both are kept inside the text."""
        size = len(self.text)
        start = min(max(start, 0), size)
        end = min(start + max(removed, 0), size)
        # a leaf's cut is safe while the characters next to it stay: at start - 2 or before, at end + 1 or after
        first, lo = self.tree.find(max(start - 2, 0))
        last, at = self.tree.find(end)
        hi = at + self.tree.leaf_chars()[last]
        while hi < size and hi < end + 1:
            last += 1
            hi += self.tree.leaf_chars()[last]
        part = self.text[lo:start] + inserted + self.text[end:hi]
        self.text = self.text[:lo] + part + self.text[hi:]
        leaves = safe_leaves(part, self._leaf_chars)
        self.reencoded += len(part)
        slots = last - first + 1
        if len(leaves) <= slots:
            for k in range(slots):
                leaf = leaves[k] if k < len(leaves) else ""
                self.tree.put(first + k, len(leaf), self._encoder.count(leaf) if leaf else 0)
            return
        # more leaves than before: sums of the others stay, the tree is laid out anew over them
        chars, tokens = self.tree.leaf_chars(), self.tree.leaf_tokens()
        chars[first : last + 1] = [len(x) for x in leaves]
        tokens[first : last + 1] = [self._encoder.count(x) for x in leaves]
        self.tree = TokenTree(chars, tokens)


def _schema(docs: DataFrame, *added: T.StructField) -> T.StructType:
    names = {f.name for f in added}
    return T.StructType([f for f in docs.schema.fields if f.name not in names] + list(added))


_COUNT_FIELDS = (
    T.StructField("n_tokens", T.LongType()),
    T.StructField("leaf_chars", T.ArrayType(T.IntegerType())),
    T.StructField("leaf_tokens", T.ArrayType(T.IntegerType())),
)


def count_documents(docs: DataFrame, text_col: str = "text", leaf_chars: int = LEAF_CHARS, **tokenizer) -> DataFrame:
    """Every row of ``docs`` plus ``n_tokens`` and the leaves of its tree
    (``leaf_chars``, ``leaf_tokens``).

    NULL or empty text: 0 tokens, one empty leaf. Columns of ``docs`` with the
    made names are replaced. Rows are counted one by one, repeated ones too.
    """
    require_columns(docs, text_col)
    schema = _schema(docs, *_COUNT_FIELDS)
    kept = schema.names[: -len(_COUNT_FIELDS)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(**tokenizer)
        for batch in batches:
            trees = [CountedText(t.as_py() or "", encoder, leaf_chars).tree for t in batch.column(text_col)]
            made = [
                pa.array([t.n_tokens for t in trees], pa.int64()),
                pa.array([t.leaf_chars() for t in trees], pa.list_(pa.int32())),
                pa.array([t.leaf_tokens() for t in trees], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(count, schema)


def edit_documents(
    counted: DataFrame, edits_col: str = "edits", text_col: str = "text", leaf_chars: int = LEAF_CHARS, **tokenizer
) -> DataFrame:
    """Counted rows after their edits: ``text``, ``n_tokens`` and the leaves
    brought up to date, plus ``reencoded_chars``.

    ``edits_col`` holds an array of ``(start, removed, inserted)``, applied in
    order, places in code points of the text as it then is. Places outside
    the text are moved to its ends; NULL arrays, edits, places or insertions
    change nothing where they are NULL.
    """
    require_columns(counted, edits_col, text_col, *_STATE)
    out = T.StructField("reencoded_chars", T.LongType())
    schema = _schema(counted, out)
    kept = schema.names[:-1]

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(**tokenizer)
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(kept)}
            texts = []
            for text, chars, tokens, edits in zip(
                columns[text_col].to_pylist(), columns["leaf_chars"].to_pylist(), columns["leaf_tokens"].to_pylist(),
                columns[edits_col].to_pylist(), strict=True,
            ):
                counted_text = CountedText(text or "", encoder, leaf_chars, chars or [], tokens or [])
                for e in edits or []:
                    if e is not None and e["start"] is not None:
                        counted_text.edit(e["start"], e["removed"] or 0, e["inserted"] or "")
                texts.append(counted_text)
            columns[text_col] = pa.array([t.text for t in texts], pa.string())
            columns["n_tokens"] = pa.array([t.tree.n_tokens for t in texts], pa.int64())
            columns["leaf_chars"] = pa.array([t.tree.leaf_chars() for t in texts], pa.list_(pa.int32()))
            columns["leaf_tokens"] = pa.array([t.tree.leaf_tokens() for t in texts], pa.list_(pa.int32()))
            again = pa.array([t.reencoded for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*[columns[c] for c in kept], again], names=schema.names)

    return counted.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(edit, schema)

"""Words of whole texts as numpy arrays, straight from Arrow's UTF-8 buffers.

Used inside Arrow batches by the operators on words. A batch is cut into
chunks of about a quarter of a megabyte, so memory is bounded by the chunk (or by the one
longest text), not by the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from revmart.llm.workers import once, release_memory

CHUNK_BYTES = 1 << 18
BLANKS = b" \t\n\x0b\x0c\r"

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)

#: A word's id folds three polynomial hashes of its bytes, each over a prime field.
#: Modulo a prime no word has a twin by its shape alone, as words of the
#: Thue-Morse kind have modulo a power of two.
PRIMES = (2147483647, 2147483629, 2147483587)
_BASES = (1481765933, 823564440, 1791095845)
#: Up to so many bytes a sum of (byte + 1) * power cannot overflow.
_PLAIN_SUM = 1 << 23


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    """1 to 256 per byte; upper-case ASCII as its lower case if asked."""
    values = np.arange(1, 257, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


def _is_blank(letters: bool) -> np.ndarray:
    """Bytes between words: the blanks, or all of ASCII but the letters."""
    table = np.zeros(256, dtype=bool)
    table[list(BLANKS)] = True
    if letters:
        table[:128] = True
        table[65:91] = table[97:123] = False
    return table


def _geometric(base: int, prime: int, n: int) -> np.ndarray:
    """The base's first ``n`` powers modulo the prime, by doubling. They are
    kept as 32 bits, which the primes fit; what they meet has 64."""
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += step
    return out.astype(np.uint32)


def _make_powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(_geometric(b, p, n), _geometric(pow(b, -1, p), p, n)) for b, p in zip(_BASES, PRIMES, strict=True)]


def _powers(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each prime the base's powers and their inverses, for ``size`` bytes at least."""
    if size <= 1 << 19:
        return once("powers", lambda: _make_powers((1 << 19) + 1))
    return _make_powers(size + 1)  # a very long text: for this chunk alone


def _running_sums(data: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """For each prime the running sums of value times power."""
    own = values[data]
    sums = []
    for (up, _), prime in zip(_powers(len(data)), PRIMES, strict=True):
        terms = own * up[: len(data)]
        if len(data) > _PLAIN_SUM:
            terms %= np.uint64(prime)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(terms, out=total[1:])
        sums.append(total)
    return sums


def _span_ids(sums: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit id for the bytes of each span."""
    out = (ends - starts).astype(np.uint64)
    for (_, down), total, prime in zip(_powers(len(sums[0]) - 1), sums, PRIMES, strict=True):
        p = np.uint64(prime)
        out = mix64(out * _GOLD + (total[ends] - total[starts]) % p * down[starts] % p)
    return out


class Words(NamedTuple):
    """Words of consecutive texts.

    ``hashes``: one per word. ``starts``, ``ends``: byte spans in ``data``.
    ``first``: index of each text's first word, and the end of the last's.
    ``offsets``: byte spans of the texts. ``rows``: their places in the batch.
    ``sums``: running sums of the bytes' hash terms, for ids of parts.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    offsets: np.ndarray
    rows: range
    sums: list[np.ndarray]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than texts, NULL as empty) and bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def chunks_of(batch: pa.RecordBatch, text_col: str, chunk_bytes: int = 1 << 22) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in stretches of rows with about ``chunk_bytes`` of text (or one
    longer text): the rows, their texts' offsets and bytes."""
    if len(batch) == 0:
        return
    offsets, data = buffers(batch.column(text_col))
    at = 0
    while at < len(batch):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1)
        yield batch.slice(at, stop - at), offsets[at : stop + 1] - offsets[at], data[offsets[at] : offsets[stop]]
        at = stop


def _words(data: np.ndarray, offsets: np.ndarray, rows: range, lower: bool, letters: bool) -> Words:
    size = len(data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, none.astype(np.uint64), np.zeros(len(rows) + 1, np.int64), offsets, rows, [np.zeros(1, np.uint64)] * len(PRIMES))
    inside = ~_is_blank(letters)[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < size)]
    begins[edges] = inside[edges]
    finishes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    sums = _running_sums(data, _byte_values(lower))
    hashes = _span_ids(sums, starts, ends)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets), offsets, rows, sums)


def words_of(texts: pa.Array, lower: bool = False, letters: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """The texts' words, chunk by chunk; every text is in one chunk.

    ``lower``: ASCII letters as lower case. ``letters``: words are runs of
    letters (ASCII ones and all bytes above) instead of non-blanks."""
    if len(texts) == 0:
        return
    offsets, data = buffers(texts)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, side="right")) - 1)
        lo, hi = int(offsets[at]), int(offsets[stop])
        yield _words(data[lo:hi], offsets[at : stop + 1] - lo, range(at, stop), lower, letters)
        at = stop
    release_memory()


def stem_hashes(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the words of more than ``length`` bytes, and hashes of their
    first ``length`` bytes (other than those of whole words)."""
    at = np.flatnonzero(words.ends - words.starts > length)
    starts = words.starts[at]
    return at, mix64(_span_ids(words.sums, starts, starts + length) + _GOLD)


def joined_bytes(words: Words, lower: bool = False) -> tuple[bytes, np.ndarray]:
    """The words' own bytes, each followed by one blank, and where each word
    begins there (one more than words: the end)."""
    sizes = words.ends - words.starts
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(first[-1], 32, dtype=np.uint8)
    if len(sizes):
        shift = np.repeat(words.starts - first[:-1], sizes)
        to = np.arange(len(shift)) + np.repeat(np.arange(len(sizes)), sizes)  # a blank behind each word before
        out[to] = words.data[to + shift]
    joined = out.tobytes()
    return (joined.lower() if lower else joined), first


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each word on; ``len(hashes) - n + 1`` of
    them, those that cross texts included."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(size, n, dtype=np.uint64)
    for j in range(n):
        out = (out + hashes[j : j + size]) * _GOLD
        out ^= out >> np.uint64(29)
    return mix64(out)

"""Vectorised text primitives over Arrow string columns.

A column's UTF-8 buffer is handled as one numpy array, so a batch of documents costs a
few array passes and no Python object per word. Hashes are polynomials modulo 2**64 in
an odd base, taken from prefix sums, which makes the hash of any run of bytes or of any
window of words a difference of two prefixes. They depend on content alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once. A longer document is handled alone.
CHUNK_BYTES = 1 << 21

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_SECOND_BASE = 0x165667B19E3779F9
_MASK = (1 << 64) - 1


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true inside the inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: The separators of `[^\x20\x09-\x0D]+`.
WHITE = byte_set((0x09, 0x0D), (0x20, 0x20))
#: The separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
NOT_ALNUM = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (self._run(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)


_BYTES, _WORDS, _SECOND = _Powers(_BYTE_BASE), _Powers(_WORD_BASE), _Powers(_SECOND_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that order and low bits carry no structure."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each row's UTF-8; null is empty."""
    data, at = text_buffers(column)
    whole = data.tobytes()
    for i in range(len(at) - 1):
        yield whole[at[i] : at[i + 1]]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each; a row is never split."""
    if not batch.num_rows:
        return
    column = batch.column(batch.schema.get_field_index(text))
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        yield batch.slice(low, high - low)


def word_spans(data: np.ndarray, at: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each row's first word (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~separator[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[at] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    up, down = _BYTES.get(len(data) + 1)
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, length: int, second: bool = False) -> np.ndarray:
    """The hash of words[i : i + length] for every i that has so many words after it; `second` gives one of another base over other values."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = (_SECOND if second else _WORDS).get(len(words) + 1)
    prefix = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum((mix(words) if second else words) * up[:-1], out=prefix[1:])
    return mix((prefix[length:] - prefix[:n]) * down[:n])


def window_rows(first: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n windows lie within one row, given each row's first word."""
    stops = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + length <= stops


def row_of_word(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values, by doubling."""
    out, done = values, 1
    while done * 2 <= width:
        out, done = np.minimum(out[: len(out) - done], out[done:]), done * 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of booleans or numbers over the rows that the offsets part."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[at[1:]] - total[at[:-1]]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in [s, s + length) for some s; places past n are cut off."""
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, np.minimum(starts + length, n), -1)
    return np.cumsum(delta[:-1]) > 0


def sorted_member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


def pair_member(first: np.ndarray, second: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which pairs of values are among `pairs`."""
    order = np.argsort(pairs[0], kind="stable")
    one, two = (x[order] for x in pairs)
    out = np.zeros(len(first), dtype=bool)
    maybe = np.flatnonzero(sorted_member(first, one))
    while len(maybe):
        at = np.searchsorted(one, first[maybe])
        same = two[at] == second[maybe]
        out[maybe[same]] = True
        # What is left has a first value that stands in several pairs: those looked at go.
        maybe, seen = maybe[~same], np.unique(at[~same])
        one, two = np.delete(one, seen), np.delete(two, seen)
        maybe = maybe[sorted_member(first[maybe], one)]
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x) -> np.ndarray:
    return np.asarray(x, dtype=np.int64).view(np.uint64)

"""Whole Arrow text columns as numpy word tables, without a Python object per word.

A word is a run of bytes other than ASCII white space (9 to 13 and 32). Words and lines get 64-bit hashes from one
running polynomial sum over the bytes: the hash of a span is a difference of two sums times an inverse power.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
#: Bytes of text handled at once; longer texts are still handled whole.
CHUNK = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def trim() -> None:
    """Give memory that a task has freed back to the machine: Python workers live on for other stages."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK + CHUNK // 4)
        for k, b in enumerate((BASE, INVERSE)):
            p = np.full(size, b, U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of x."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) over the rows; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    buffers = texts.buffers()
    off = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, one more than there are bytes."""
    p, _ = powers(len(data) + 1)
    out = np.empty(len(data) + 1, U)
    out[0] = 0
    np.cumsum((data.astype(U) + U(1)) * p[:-1], out=out[1:])
    return out


def spans(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end)."""
    _, q = powers(len(total))
    return mix((total[end] - total[start]) * q[start])


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, cut where a row begins."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Words:
    """The words of one chunk: byte spans, hashes, and for each row the slice ptr[r]:ptr[r + 1]."""

    def __init__(self, data: np.ndarray, off: np.ndarray, total: np.ndarray | None = None):
        self.data, self.off = data, off
        space = (data == 32) | ((data >= 9) & (data <= 13))
        self.start, self.end = runs(~space, off)
        self.ptr = np.searchsorted(self.start, off)
        self.total = sums(data) if total is None else total
        self.hash = spans(self.total, self.start, self.end)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams at every word, and which of them end inside the row."""
        size = len(self.hash)
        out = np.zeros(size, U)
        if size >= n:
            acc = self.hash[: size - n + 1].copy()
            for k in range(1, n):
                acc *= BASE
                acc += self.hash[k : size - n + 1 + k]
            out[: size - n + 1] = mix(acc)
        left = np.repeat(self.ptr[1:], self.counts) - np.arange(size)
        return out, left >= n

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams of each row, or of a shorter row all its words as one; and the slices by row."""
        g, ok = self.grams(n)
        short = np.flatnonzero((self.counts > 0) & (self.counts < n))
        if len(short):
            at = self.ptr[short]
            acc = self.hash[at].copy()
            for k in range(1, n - 1):
                more = self.counts[short] > k
                acc[more] = acc[more] * BASE + self.hash[at[more] + k]
            g[at] = mix(acc + self.counts[short].astype(U))
            ok[at] = True
        where = np.flatnonzero(ok)
        return g[where], np.searchsorted(where, self.ptr)


def char_sums(data: np.ndarray) -> np.ndarray:
    """Running counts of characters (UTF-8 lead bytes), one more than there are bytes."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def by_row(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of values over the slices of each row."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[ptr[1:]] - c[ptr[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a key occurs more than once, and where it has occurred before."""
    every, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        s = keys[order]
        same = s[1:] == s[:-1]
        later[order[1:]] = same
        every[order[:-1]] = same
        every |= later
    return every, later


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    """How a column travels in Arrow batches."""
    return df.select(df[column]).limit(0).toArrow().schema.field(0).type

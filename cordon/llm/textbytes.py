"""Vectorised work on the bytes of many texts at once (numpy inside tasks).

A chunk of texts is one byte array and the offsets of its rows.  Tokens are
runs of bytes of one class; they never cross a row.  Chunks are bounded in
bytes, so a batch with very long texts needs no more memory than others (a
single longer text is a chunk of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1 rows, from 0); null texts are empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return body, at - at[0]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with at most ``limit`` bytes of text each."""
    if not batch.num_rows:
        return
    _, at = text_bytes(batch.column(text))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def class_table(default: int, **classes: tuple[int, object]) -> np.ndarray:
    """256 byte classes: ``name=(class, bytes)``."""
    t = np.full(256, default, np.uint8)
    for k, members in classes.values():
        t[np.frombuffer(bytes(members), np.uint8)] = k
    return t


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def tokens(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the runs of one class (class 0 separates)."""
    n = len(kind)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    rows = offsets[:-1][offsets[:-1] < n]
    new[rows] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    inside = kind[start] != 0
    start, end = start[inside], end[inside]
    return start, end, np.searchsorted(offsets, start, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (well-known constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHash:
    """64-bit hashes of byte spans, from one running sum of the bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.full(n + 1, _MULTIPLIER, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        back = np.full(n + 1, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
        back[0] = 1
        self._back = np.multiply.accumulate(back)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=self._sum[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        h = (self._sum[end] - self._sum[start]) * self._back[start]
        return mix(h + np.uint64(salt * 0xD6E8FEB86659FD93 % (1 << 64)) + (end - start).astype(np.uint64))


def row_sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of values[start:end] per row; empty rows give 0."""
    if not len(start):
        return np.zeros((0, *values.shape[1:]))
    padded = np.concatenate([values, np.zeros((1, *values.shape[1:]), values.dtype)]).astype(np.float64)
    out = np.add.reduceat(padded, np.column_stack([start, end]).ravel(), axis=0)[::2]
    out[start == end] = 0
    return out

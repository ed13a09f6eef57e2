"""Texts of Arrow batches as byte arrays: words, rolling hashes, packed arrays.

A word is a run of bytes other than 0x20 and 0x09 to 0x0D. Hashes are 64 bits wide and
the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.session import materialise

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_RNG = np.random.default_rng(20240901)
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_PLACE = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def whole_text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def with_row(docs: DataFrame, number: str | None = None, **columns: str | Column) -> DataFrame:
    """The named columns and ``row``, a number of its own for every row.

    ``number`` is a column of ``docs`` that holds stored numbers. Without it each job that
    runs the frame numbers anew, by the splits of its own scan, so the frame may be run once
    only: what uses it more often writes it first. Only the named columns are read, so no
    other can clash.
    """
    picked = [F.col(c) if isinstance(c, str) else c for c in columns.values()]
    picked = [c.alias(name) for name, c in zip(columns, picked)]
    return docs.select(*picked, (F.col(number) if number else F.monotonically_increasing_id()).alias("row"))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written with a column of row numbers, and that column's name.

    The copy stays for as long as the result is read, so it is written compactly.
    """
    number = "row"
    while number.lower() in map(str.lower, docs.columns):
        number += "_"
    return materialise(docs.withColumn(number, F.monotonically_increasing_id()), "numbered", compression="zstd"), number


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, where each begins and the last ends)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def runs(at: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer row is a range of its own."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``data[s:e]`` for every pair, in time linear in the data."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of every run of ``size`` bytes, with few arrays held at a time."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    tail = total[1:]
    np.take(_BYTE, data, out=tail, mode="clip")
    tail *= up[:-1]
    np.cumsum(tail, out=tail)
    h = total[size:] - total[:-size]
    del total, tail
    h *= down[: len(h)]
    h += np.uint64(size * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    return mix(h)


class Words:
    """Words of a run of documents: ``start``, ``end``, ``doc`` and ``hash`` of each."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        n = len(data)
        inside = _IS_WORD[data]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(at, self.start, "right") - 1
        self.hash = span_hashes(data, self.start, self.end)
        self.n_docs = len(at) - 1
        self.count = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate(([0], np.cumsum(self.count)))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``size`` words within one document."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total += self.hash[k : k + n] * _PLACE[k]
        whole = self.doc[:n] == self.doc[size - 1 : size - 1 + n]
        at = np.flatnonzero(whole)
        return at, mix(total[at])

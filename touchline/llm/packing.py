"""Packing token sequences: non-negative least squares over a histogram of lengths.

Documents are tokenised, ended by an end id and cut into pieces: full windows, and what is
left at the end. The histogram of lengths, which has at most as many rows as the window
has tokens, is all the driver sees. Combinations of up to three rounded lengths that fill
the window are enumerated; non-negative least squares gives how often to repeat each so
that together they use up the histogram; the counts are rounded and cut to what is there.
The pieces left over are packed greedily by length, longest first, again as patterns that
are repeated as often as their lengths allow. The result is a list of rank ranges per
length. A piece's rank among its length is its rank in its task plus a prefix sum over
tasks, so every task places its own pieces and no step sorts or holds a length's pieces.

Null texts count as empty: one piece, the end id. Rows with the same id are documents of
their own. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, Window

from touchline.llm.text import whole_text
from touchline.llm.tokens import encoder, texts
from touchline.session import Scratch

WINDOW = 2048
GRID = 16

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "part int, rank long"
)


def _cutter(tokenizer: str, end: int, window: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, end), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            for row, some in texts(batch, 1):
                ids = batch.column(0).slice(row, len(some)).to_pylist()
                out = []
                for doc, raw in zip(ids, encode.many(some)):
                    n = len(raw) // 4
                    for start in range(0, n, window):
                        piece = raw[4 * start : 4 * (start + window)]
                        length = len(piece) // 4
                        out.append((doc, start, length, zlib.crc32(piece), n, part, int(seen[length]), piece))
                        seen[length] += 1
                *columns, pieces = zip(*out)
                kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"]
                if with_ids:
                    arrays.append(pa.array(pieces, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return cut


def combinations(bins: int) -> list[tuple[int, ...]]:
    """Up to three bin numbers, largest first, whose sum is ``bins``."""
    found: list[tuple[int, ...]] = [(bins,)]
    for a in range(bins - 1, 0, -1):
        if 2 * a >= bins:
            found.append((a, bins - a))
        for b in range(min(a, bins - a - 1), 0, -1):
            if 1 <= bins - a - b <= b:
                found.append((a, b, bins - a - b))
    return found


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative x that minimises |a x - b|, by an active set."""
    x, inside = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(3 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[inside] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        inside[best] = True
        while True:
            z = np.zeros_like(x)
            z[inside] = np.linalg.lstsq(a[:, inside], b, rcond=None)[0]
            if (z[inside] > 0).all():
                break
            low = inside & (z <= 0)
            x = x + np.min(x[low] / np.maximum(x[low] - z[low], 1e-300)) * (z - x)
            inside &= x > 1e-12
            x[~inside] = 0
        x = z
    return x


class Layout:
    """Which sequence and slot the k-th piece of a length goes to."""

    def __init__(self, histogram: dict[int, int], window: int = WINDOW, grid: int = GRID):
        self.left = np.zeros(window + 1, np.int64)
        for length, n in histogram.items():
            self.left[length] = n
        self.used = np.zeros(window + 1, np.int64)
        self.sequences = 0
        self.ranges: list[tuple[int, int, int, int, int, int]] = []  # length, lo, n, sequence, per, slot
        self._repeat([(window, 1)], int(self.left[window]))
        self._fit(window, grid)
        for _ in count():
            longest = np.flatnonzero(self.left)
            if not len(longest):
                break
            self._greedy(window, longest)
        self.ranges.sort()

    def _take(self, length: int, n: int, sequence: int, per: int, slot: int) -> None:
        if n:
            self.ranges.append((length, int(self.used[length]), n, sequence, per, slot))
            self.used[length] += n
            self.left[length] -= n

    def _repeat(self, pattern: list[tuple[int, int]], times: int) -> None:
        slot = 0
        for length, per in pattern:
            self._take(length, times * per, self.sequences, per, slot)
            slot += per
        self.sequences += times

    def _fit(self, window: int, grid: int) -> None:
        bins = window // grid
        of = -(-np.arange(window + 1) // grid)
        there = np.bincount(of, self.left, bins + 1)[1:]
        if not there.sum():
            return
        ways = combinations(bins)
        a = np.zeros((bins, len(ways)))
        for j, way in enumerate(ways):
            for k in way:
                a[k - 1, j] += 1
        # Short pieces fill gaps anywhere, so fitting them exactly matters less.
        weight = np.where(np.arange(1, bins + 1) * 8 <= bins, 0.1, 1.0)
        x = nnls(a * weight[:, None], there / there.max() * weight) * there.max()
        free = there.astype(np.int64)
        for j in np.argsort(-x, kind="stable"):
            way = ways[j]
            most = min(int(free[k - 1]) // way.count(k) for k in set(way))
            times = min(int(np.floor(x[j] + 0.5)), most)
            if times <= 0:
                continue
            for slot, k in enumerate(way):
                free[k - 1] -= times
                todo, sequence = times, self.sequences
                for length in range(min(k * grid, window), (k - 1) * grid, -1):  # longest first
                    n = int(min(todo, self.left[length]))
                    self._take(length, n, sequence, 1, slot)
                    todo, sequence = todo - n, sequence + n
            self.sequences += times

    def _greedy(self, window: int, longest: np.ndarray) -> None:
        room, pattern = window, []
        for length in longest[::-1].tolist():
            per = int(min(room // length, self.left[length]))
            if per:
                pattern.append((length, per))
                room -= per * length
            if not room:
                break
        self._repeat(pattern, min(int(self.left[n]) // per for n, per in pattern))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, slot) of pieces."""
        table = np.array(self.ranges, np.int64).reshape(-1, 6)
        key = (table[:, 0] << 48) + table[:, 1]
        i = np.searchsorted(key, (length << 48) + rank, "right") - 1
        step = rank - table[i, 1]
        return table[i, 3] + step // table[i, 4], table[i, 5] + step % table[i, 4]


def _placer(layout: Layout):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, slot = layout.place(length, rank)
            kept = batch.drop_columns(["rank"])
            kept = kept.append_column("sequence_id", pa.array(sequence, pa.int64()))
            yield kept.append_column("slot", pa.array(slot, pa.int64()))

    return place


def pack(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, slot,
    offset, and with ``with_ids`` the ids (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    more = ", ids binary" if with_ids else ""
    with Scratch(spark, "pack") as scratch:
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
        pieces = scratch.write(
            rows.mapInArrow(_cutter(tokenizer, end, window, with_ids), PIECES + more), "pieces"
        )
        counts = scratch.write(pieces.groupBy("part", "length").count(), "counts")
        histogram = counts.groupBy("length").agg(F.sum("count").alias("n")).collect()  # window rows
        layout = Layout({r["length"]: r["n"] for r in histogram}, window)
        before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        base = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
        ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
        ranked = ranked.drop("base", "part")
        schema = ", ".join(f"{n} {t}" for n, t in ranked.drop("rank").dtypes)
        placed = ranked.mapInArrow(_placer(layout), f"{schema}, sequence_id long, slot long")
        earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        offset = F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot"]
        return scratch.publish(placed.select(*names, offset, *(["ids"] if with_ids else [])))

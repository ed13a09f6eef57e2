"""Spelling variants: words one edit apart, by Gram matrices of letter counts in blocks.

A word is a vector of letter counts. One replaced letter moves it by a squared distance of
2, one inserted or deleted letter by 1, so the products of a block's vectors, one NumPy
matrix product, leave only the pairs at a distance of 1 or 2, whose edit is then checked.
Blocks hold words of two adjacent lengths that agree in their first or in their last half:
an edit changes one place, so one half is always whole and no pair is lost. A pair is
taken where its first difference says it belongs, so it is counted once.

A block of more than ``TILE`` words is cut into tiles by a hash, and every two tiles meet in
a task of their own, so no common half is gathered in one place. What a task finds is summed
per word before it is shuffled.

A word's form is its near word of largest n, if that is ``lead`` times its own n or more (ties:
the smallest in code-point order); following forms to the last gives its root.

A null text has no words, an empty one neither; a null id counts as an empty one; repeated
rows count as often as they occur; an empty table gives no rows. Texts and words may be of any
length. Only the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.text import whole_text
from touchline.session import Scratch

LETTERS = "[A-Za-zÀ-ÿ]"
TILE = 2048  # words of a tile, and with that the memory of a task
STRIP = 256  # rows of one matrix product
WIDE = 64  # longer words are compared one pair at a time
FOUND = "word string, near long, best_n long, best string"


def runs_of_letters(docs: DataFrame, doc_id: str, text: str, shortest: int) -> DataFrame:
    """``id`` and ``run`` of every maximal run of at least ``shortest`` letters, A-Z lowered."""
    runs = F.regexp_extract_all(whole_text(text), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    return found.withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))


def drop_letters(one_in: int) -> Callable[[Column, Column], Column]:
    """Deletes one letter of a run where ``one_in`` divides the crc32 of ``id:run``."""

    def changed(doc_id: Column, run: Column) -> Column:
        h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
        at = (h % F.length(run)).cast("int")
        rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        return F.when(h % one_in == 0, rest).otherwise(run)

    return changed


def words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = 7,
    least: int = 2,
    change: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """``word`` and ``n`` of every word of at least ``shortest`` letters, seen ``least`` times."""
    found = runs_of_letters(docs, doc_id, text, shortest)
    word = F.col("run") if change is None else change(F.col("id"), F.col("run"))
    found = found.select(word.alias("word")).where(F.length("word") >= shortest)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _halves(counted: DataFrame) -> DataFrame:
    """Every word under its four keys: each half, as the shorter and as the longer length."""
    size = F.length("word")
    both = F.explode(F.array(size, size - 1)).alias("base")
    rows = counted.select("word", "n", both)
    head = F.floor(F.col("base") / 2).cast("int")
    tail = F.col("base") - head
    half = F.array(
        F.struct(F.lit(0).alias("side"), F.substring(F.col("word"), F.lit(1), head).alias("half")),
        F.struct(F.lit(1).alias("side"), F.substring(F.col("word"), F.length("word") - tail + 1, tail).alias("half")),
    )
    rows = rows.select("word", "n", "base", F.explode(half).alias("h")).select("word", "n", "base", "h.side", "h.half")
    return rows.select(F.xxhash64("base", "side", "half").alias("key"), "base", "side", "word", "n")


def _tiled(keyed: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows of common keys once for every pair of tiles (i, j) that holds their own tile."""
    rows = keyed.join(hot, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select(
        "key",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        "mine",
        "base",
        "side",
        "word",
        "n",
    )


def first_difference(a: str, b: str) -> int:
    """Where ``a`` and ``b`` first differ if they are one edit apart (a not longer), else -1."""
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return at if at < len(a) and a[at + 1 :] == b[at + 1 :] else -1
    return at if len(b) == len(a) + 1 and a[at:] == b[at + 1 :] else -1


class _Block:
    """Rows of whole groups: their words, counts of letters and tiles."""

    def __init__(self, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts)
        self.words = rows.column("word").to_pylist()
        self.n, self.base, self.side, i, j, self.mine, key = (
            rows.column(c).to_numpy() for c in ("n", "base", "side", "i", "j", "mine", "key")
        )
        self.alike = i == j
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        self.group = np.cumsum(new) - 1
        self.size = np.fromiter(map(len, self.words), np.int64, len(self.words))
        codes = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        letters, place = np.unique(codes, return_inverse=True)
        row = np.repeat(np.arange(len(self.words)), self.size)
        flat = np.bincount(row * len(letters) + place, minlength=len(self.words) * len(letters))
        # Sums of squares stay exact: below 2^24 in 32 bits, else in 64.
        kind = np.float32 if self.size.max() < 2048 else np.float64
        self.counts = flat.reshape(len(self.words), len(letters)).astype(kind)
        self.square = np.einsum("ij,ij->i", self.counts, self.counts)
        self.codes, self.first = codes.astype(np.int32), np.cumsum(self.size) - self.size

    def meeting(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows, the shorter first, at a squared distance of 1 or 2 within a group."""
        found = []
        edge = np.flatnonzero(np.diff(self.group)) + 1
        last_of = np.append(edge, len(self.group))[self.group]  # end of each row's group
        at = 0
        while at < len(self.words):
            to = min(at + STRIP, len(self.words))
            far = int(last_of[to - 1])
            near = self.square[at:to, None] + self.square[None, at:far] - 2 * (self.counts[at:to] @ self.counts[at:far].T)
            a, b = np.nonzero(near <= 2)
            a, b = a + at, b + at
            ok = (a < b) & (self.group[a] == self.group[b]) & (self.alike[a] | (self.mine[a] != self.mine[b]))
            a, b = a[ok], b[ok]
            swap = self.size[a] > self.size[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            ok = self.size[a] == self.base[a]  # two words of the longer length meet in their own block
            found.append((a[ok], b[ok]))
            at = to
        return tuple(np.concatenate(x) for x in zip(*found))

    def _differences(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``first_difference`` of every pair."""
        at = np.full(len(a), -1)
        short = self.size[b] <= WIDE
        for k in np.flatnonzero(~short):
            at[k] = first_difference(self.words[a[k]], self.words[b[k]])
        for some in np.array_split(np.flatnonzero(short), max(1, int(short.sum()) >> 14)):
            if len(some) == 0:
                continue
            width = int(self.size[b[some]].max()) + 1
            x, y = (self._padded(rows[some], width) for rows in (a, b))
            same = x[:, :-1] == y[:, :-1]
            first = np.where(same.all(1), width - 1, (~same).argmin(1) if width == 1 else np.argmax(~same, 1))
            equal = self.size[a[some]] == self.size[b[some]]
            after = np.arange(width - 1)[None, :] > first[:, None]
            replaced = equal & (first < self.size[a[some]]) & (same | ~after).all(1)
            from_here = np.arange(width - 1)[None, :] >= first[:, None]
            inserted = ~equal & ((x[:, :-1] == y[:, 1:]) | ~from_here).all(1)
            at[some] = np.where(replaced | inserted, first, -1)
        return at

    def _padded(self, rows: np.ndarray, width: int) -> np.ndarray:
        place = np.arange(width)[None, :]
        inside = place < self.size[rows][:, None]
        where = np.where(inside, self.first[rows][:, None] + place, 0)
        return np.where(inside, self.codes[where], -1)

    def found(self) -> pa.RecordBatch | None:
        a, b = self.meeting()
        at = self._differences(a, b)
        ok = (at >= 0) & ((at >= self.base[a] // 2) == (self.side[a] == 0))
        a, b = a[ok], b[ok]
        if len(a) == 0:
            return None
        # A word may be in several groups of the block: number the words, best first.
        rows = np.unique(np.concatenate([a, b]))
        ranked = sorted({(-int(self.n[r]), self.words[r]) for r in rows})
        number = {word: k for k, (_, word) in enumerate(ranked)}
        whose = np.zeros(len(self.words), np.int64)
        whose[rows] = [number[self.words[r]] for r in rows]
        left, right = whose[np.concatenate([a, b])], whose[np.concatenate([b, a])]
        count = np.bincount(left, minlength=len(ranked))
        best = np.full(len(ranked), len(ranked))
        np.minimum.at(best, left, right)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([w for _, w in ranked]),
                pa.array(count, pa.int64()),
                pa.array([-ranked[k][0] for k in best], pa.int64()),
                pa.array([ranked[k][1] for k in best]),
            ],
            ["word", "near", "best_n", "best"],
        )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of sorted rows; a block is cut only where a group ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        key = np.stack([batch.column(c).to_numpy() for c in (0, 1, 2)])
        edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            if [last.column(c)[0].as_py() for c in (0, 1, 2)] != key[:, 0].tolist():
                edges = np.concatenate([[0], edges])
        for edge in edges:
            if size + edge - at >= TILE:
                held.append(batch.slice(at, edge - at))
                out = _Block([p for p in held if p.num_rows]).found()
                if out is not None:
                    yield out
                held, size, at = [], 0, int(edge)
        held.append(batch.slice(at))
        size += batch.num_rows - at
        held = [p for p in held if p.num_rows]
    if held:
        out = _Block(held).found()
        if out is not None:
            yield out


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: forms followed to the last, twice as far in every round."""
    reached = scratch.write(forms.select("word", F.col("form").alias("root")), "roots-0")
    step = 0
    while True:
        step += 1
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = reached.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = scratch.write(moved, f"roots-{step}")
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def variants(counted: DataFrame, lead: int = 10, tile: int = TILE) -> DataFrame:
    """Near words, form and root of each row of distinct ``word`` and its ``n``."""
    with Scratch(counted.sparkSession, "variants") as scratch:
        counted = scratch.write(counted.select("word", F.col("n").cast("long").alias("n")), "words")
        shortest = counted.agg(F.min(F.length("word"))).first()[0] or 0
        keyed = _halves(counted).where(F.col("base") >= shortest)  # no word is shorter than that
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile)
        hot = scratch.write(sizes.select("key", F.ceil(F.col("size") / tile).cast("int").alias("tiles")), "hot")
        tiled = _tiled(keyed, hot)
        placed = tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        near = placed.mapInArrow(_compare, FOUND)
        near = near.groupBy("word").agg(
            F.sum("near").alias("n_near"),
            F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))).alias("best"),
        )
        rows = counted.join(near, "word", "left")
        far = -F.col("best.less") >= lead * F.col("n")
        rows = rows.select(
            "word",
            F.when(far, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(far, -F.col("best.less")).alias("form_n"),
        )
        rows = scratch.write(rows, "near")
        roots = _roots(scratch, rows.where("form IS NOT NULL"))
        rows = rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
        return scratch.publish(rows.select("word", "form", "root", "n", "n_near", "form_n"))

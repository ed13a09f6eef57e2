"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text. The ordinary one is trained on
windows of ordinary texts. The toxic one is trained on what sets toxic texts apart: the
stretches covered by the ``CONTRAST`` strings of 8 bytes whose share of toxic texts differs
most from their share of ordinary ones (by log likelihood, so rare forms of one stem add
up), as far as it differs by more than the best of so many strings would by chance; the ordinary dictionary lies behind it, so that both compress common text alike. Each
text is cut into overlapping windows of 32 bytes; a window's margin is the number of bytes
by which the toxic dictionary compresses it better. The two largest margins of a text, and
how many and what share of its windows reach a few bytes, give its score by a logistic
curve.

Learning uses a sample of labelled rows of at most ``TOXIC`` toxic and ``ORDINARY``
ordinary texts, chosen by a hash of the id, of those that are not held out; copies of a
text under one id count once. Two thirds of it train the dictionaries, the rest calibrates
the curve, so no row does both (where a part lacks one of the labels, both use the whole
sample). Strings are counted and stretches cut by Spark jobs over the whole texts of the
sample; at most ``PIECES`` pieces of each dictionary's text, chosen by hash, reach the
driver, where it is trained. Every row of ``docs`` is scored over its whole text.

A null or empty text has no windows and all its margins are 0; a null id is not held out
and has no label; several labels of an id count as toxic if one is; without labels of both
kinds every score is 0; an empty table gives no rows. Repeated rows get equal scores, and
columns of other names are not read, so they cannot clash. Too little text to train on
is the dictionary itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.text import bytes_of, runs, whole_text
from touchline.session import materialise

TOXIC, ORDINARY = 2000, 4000
WINDOW, STEP = 32, 16
GRAM, CONTRAST = 8, 512
PIECES, COMMON_PIECE, TOXIC_PIECE = 20_000, 256, 64
COMMON_BYTES, TOXIC_BYTES = 12 << 10, 2 << 10
LEVEL = 6
PREDICT_FROM = 0.7
RIDGE = 0.3
REACH = (3, 4, 5, 6, 8)
FEATURES = ["top", "second", *(f"{kind}_{k}" for kind in ("hits", "share") for k in REACH)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@lru_cache(maxsize=4)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    plain = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    return zstandard.ZstdCompressor(dict_data=words, compression_params=plain)


def _sizes(content: bytes, data: bytes, spans: bytes) -> np.ndarray:
    made = _compressor(content).multi_compress_to_buffer(zstandard.BufferWithSegments(data, spans))
    return np.fromiter(map(len, made), np.int64, len(made))


def margins(data: np.ndarray, at: np.ndarray, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """The ``FEATURES`` of each text of a run."""
    size = np.diff(at)
    n = np.where(size > 0, np.maximum(0, -(-(size - WINDOW) // STEP)) + 1, 0)
    found = np.zeros((len(size), len(FEATURES)))
    if not n.sum():
        return found
    doc = np.repeat(np.arange(len(size)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = at[doc] + place * STEP
    spans = np.stack([start, np.minimum(start + WINDOW, at[doc + 1]) - start], 1).astype("<u8").tobytes()
    raw = data.tobytes()
    m = _sizes(ordinary, raw, spans) - _sizes(toxic, raw, spans)
    first = (np.cumsum(n) - n)[n > 0]
    top = np.maximum.reduceat(m, first)
    whose = np.repeat(np.arange(len(first)), n[n > 0])
    # The second largest: leave out the first window that has the largest.
    is_top = np.flatnonzero(m == top[whose])
    rest = m.copy()
    rest[is_top[np.unique(whose[is_top], return_index=True)[1]]] = -WINDOW
    second = np.maximum(0, np.maximum.reduceat(rest, first))
    hits = [np.add.reduceat((m >= k).astype(np.int64), first) for k in REACH]
    shares = [4 * np.log1p(30 * h / n[n > 0]) for h in hits]  # about as wide as the counts
    found[n > 0] = np.stack([np.maximum(0, top), second, *map(np.log1p, hits), *shares], 1)
    return found


def _scorer(ordinary: bytes, toxic: bytes):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = bytes_of(batch.column(1))
            for first, last in runs(at, 1 << 20):
                part = at[first : last + 1]
                found = margins(data[part[0] : part[-1]], part - part[0], ordinary, toxic)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *(pa.array(f) for f in found.T)],
                    ["doc_id", *FEATURES],
                )

    return score


def _measured(docs: DataFrame, ordinary: bytes, toxic: bytes) -> DataFrame:
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(_scorer(ordinary, toxic), schema)


def grams(data: np.ndarray) -> np.ndarray:
    """Every string of ``GRAM`` bytes of a text, as a number."""
    if len(data) < GRAM:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(data, GRAM)
    return np.ascontiguousarray(windows).view("<i8").ravel()


def stretches(data: np.ndarray, marked: np.ndarray) -> list[bytes]:
    """The different maximal runs of a text that ``marked`` (sorted) strings cover, in pieces."""
    found = np.flatnonzero(np.isin(grams(data), marked))
    if not len(found):
        return []
    breaks = np.flatnonzero(np.diff(found) > GRAM) + 1
    ends = found[np.append(breaks - 1, len(found) - 1)] + GRAM
    raw, pieces = data.tobytes(), set()
    for first, last in zip(found[np.append(0, breaks)].tolist(), ends.tolist()):
        # Pieces overlap, so that no string is lost between two.
        for at in range(first, max(first + 1, last - GRAM + 1), TOXIC_PIECE):
            pieces.add(raw[at : min(last, at + TOXIC_PIECE + GRAM - 1)])
    return sorted(pieces)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = bytes_of(batch.column(0))
        toxic = batch.column(1).to_numpy()
        for first, last in runs(at, 1 << 20):
            held = [np.unique(grams(data[at[i] : at[i + 1]])) for i in range(first, last)]
            gram, place = np.unique(np.concatenate(held), return_inverse=True)
            kind = np.repeat(toxic[first:last], [len(h) for h in held])
            t = np.bincount(place[kind == 1], minlength=len(gram))
            o = np.bincount(place[kind == 0], minlength=len(gram))
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(t), pa.array(o)], ["gram", "t", "o"])


def _cut(pieces_of):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = bytes_of(batch.column(1))
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                pieces = pieces_of(data[at[i] : at[i + 1]])
                ids = pa.array([doc_id] * len(pieces), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(pieces, pa.binary())], ["doc_id", "piece"])

    return cut


def _windows(data: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[i : i + COMMON_PIECE] for i in range(0, len(raw), COMMON_PIECE)]


def _pieces(texts: DataFrame, pieces_of) -> list[bytes]:
    cut = texts.select("doc_id", F.col("text").cast("binary")).mapInArrow(_cut(pieces_of), "doc_id long, piece binary")
    # At most PIECES rows of a bounded length.
    chosen = cut.orderBy(F.xxhash64("doc_id", "piece"), "piece").limit(PIECES).collect()
    return [bytes(r["piece"]) for r in chosen]


def _trained(pieces: list[bytes], size: int, **params: int) -> bytes:
    if sum(map(len, pieces)) > size:
        try:
            return zstandard.train_dictionary(size, pieces, **params).as_bytes()
        except zstandard.ZstdError:  # too few pieces for the trainer
            pass
    return b" ".join(pieces)[-size:]


def contrast(t: Column, o: Column, n_toxic: int, n_ordinary: int) -> Column:
    """Log likelihood gained by two shares, of toxic and ordinary texts, over one; 0 if the toxic one is lower."""

    def fit(k: Column, n: int, p: Column) -> Column:
        there = F.when(k > 0, k * F.log(p)).otherwise(0.0)
        return there + F.when(k < n, (F.lit(n) - k) * F.log(1 - p)).otherwise(0.0)

    a, b, both = t / n_toxic, o / n_ordinary, (t + o) / (n_toxic + n_ordinary)
    gain = fit(t, n_toxic, a) + fit(o, n_ordinary, b) - fit(t, n_toxic, both) - fit(o, n_ordinary, both)
    return F.when(a > b, gain).otherwise(0.0)


def dictionaries(sample: DataFrame) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary trained on a sample of (doc_id, text, toxic) with both labels."""
    total = sample.groupBy().agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_ordinary = total["t"], total["n"] - total["t"]
    counted = sample.select(F.col("text").cast("binary"), "toxic").mapInArrow(_counted, "gram long, t long, o long")
    counted = counted.groupBy("gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).where("t > 0")
    gain = contrast(F.col("t"), F.col("o"), n_toxic, n_ordinary)
    best = materialise(counted.select("gram", F.round(gain, 6).alias("gain")).where("gain > 0"), "toxic-strings")
    # At most CONTRAST rows.
    top = best.orderBy(F.desc("gain"), "gram").limit(CONTRAST).collect()
    by_chance = np.log(max(1, best.count()))
    top = [r for r in top if r["gain"] > by_chance] or top
    marked = np.sort(np.array([r["gram"] for r in top], np.int64))
    common = b" " + _trained(_pieces(sample.where("toxic = 0"), _windows), COMMON_BYTES) + b" "
    apart = _pieces(sample.where("toxic = 1"), lambda data: stretches(data, marked))
    return common, b" " + _trained(apart, TOXIC_BYTES, k=16, d=8) + common


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic curve (last one constant) by Newton steps, lightly regularised."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.diag([RIDGE] * (len(w) - 1) + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, and the margins."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = [known.where(f"toxic = {k}").orderBy(order).limit(n) for k, n in ((1, TOXIC), (0, ORDINARY))]
    # At most TOXIC + ORDINARY rows, so it may be broadcast.
    picked = F.broadcast(chosen[0].union(chosen[1]))
    texts = rows.join(picked, "doc_id").select("doc_id", "text", "toxic").distinct()
    # An id may have several texts, so the bound is held once more.
    bound = [texts.where(f"toxic = {k}").orderBy(order, F.xxhash64("text")).limit(n) for k, n in ((1, TOXIC), (0, ORDINARY))]
    part = F.crc32(F.concat(F.lit("part:"), F.col("doc_id").cast("string"))) % 3 == 0
    sample = materialise(bound[0].union(bound[1]).withColumn("calibrates", part), "toxic-sample")
    kinds = {(r["calibrates"], r["toxic"]) for r in sample.select("calibrates", "toxic").distinct().collect()}
    p = F.lit(0.0)
    ordinary = marked = b" " * 8
    if {k for _, k in kinds} == {0, 1}:
        train, calibrate = sample.where("NOT calibrates"), sample.where("calibrates")
        if len(kinds) < 4:
            train = calibrate = sample
        ordinary, marked = dictionaries(train)
        labelled = calibrate.select("doc_id", "toxic").distinct()
        seen = _measured(calibrate, ordinary, marked).join(labelled, "doc_id")
        table = np.array(seen.select(*FEATURES, "toxic").collect(), float)
        table = table[np.lexsort(table.T)]
        weights = fit_curve(table[:, :-1], table[:, -1])
        gap = F.lit(float(weights[-1]))
        for f, w in zip(FEATURES, weights):
            gap = gap + F.col(f) * float(w)
        p = 1 / (1 + F.exp(-gap))
    scored = _measured(rows, ordinary, marked).withColumn("score", p)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"),
        *FEATURES,
    )

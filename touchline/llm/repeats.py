"""Finding what repeats: hashes dealt out in packed arrays, and coverage of documents.

Hashes of a run of documents are sorted, made distinct, and sent as packed arrays to
buckets by their upper bits; the number of buckets follows the size of the data. What is
found to repeat within the run is known at once and is sent once, so a hash that a third of
all documents hold reaches its bucket once per run and not once per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.text import bytes_of, runs

RUN = 2 << 20  # bytes of text per packed run
BUCKET = 16 << 20  # bytes of text per bucket
NO_ID = np.iinfo(np.int64).min  # a null id comes before all others

SENT = "bucket int, probes binary, refs binary, doc binary, pos binary, base long, known_doc binary, known_pos binary"
_SENT = ["bucket", "probes", "refs", "doc", "pos", "base", "known_doc", "known_pos"]
_KINDS = [pa.int32()] + [pa.binary()] * 4 + [pa.int64()] + [pa.binary()] * 2


def bucket_count(rows: DataFrame) -> int:
    """A power of two that follows the bytes of text."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 << max(3, int(size // BUCKET).bit_length())


def _planes(x: np.ndarray) -> bytes:
    """Sorted 32-bit values as differences, byte by byte: the upper bytes are mostly zero."""
    return np.diff(x, prepend=np.uint32(0)).astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    d = np.frombuffer(raw, "u1").reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(d, dtype=np.uint32)


Anchors = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _sender(anchors: Anchors, buckets: int):
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    low = np.uint64(32 - (buckets.bit_length() - 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            row = batch.column(0).to_numpy()
            data, at = bytes_of(batch.column(1))
            # A run is named by its first row, so it ends where the numbers do not go on by one.
            edge = np.concatenate(([0], np.flatnonzero(np.diff(row) != 1) + 1, [len(row)])) if len(row) else []
            parts = ((int(i) + f, int(i) + l) for i, j in zip(edge, edge[1:]) for f, l in runs(at[i : j + 1], RUN))
            for first, last in parts:
                span = at[first : last + 1]
                probe, ref, doc, pos = anchors(data[span[0] : span[-1]], span - span[0])
                value, n = np.unique(probe, return_counts=True)
                twice = value[n > 1]
                known = np.isin(ref, twice)
                value = np.sort(np.concatenate((value, twice)))
                order = np.argsort(ref[~known], kind="stable")
                sent = [x[~known][order] for x in (ref, doc, pos)]
                cut, cuts = (
                    np.searchsorted(x >> shift, np.arange(buckets + 1, dtype=np.uint64)) for x in (value, sent[0])
                )
                packed = (value >> low).astype("<u4"), (sent[0] >> low).astype("<u4")
                out = []
                for b in range(buckets):
                    i, j, k, m = cut[b], cut[b + 1], cuts[b], cuts[b + 1]
                    here = b == turn % buckets
                    if i == j and not here:
                        continue
                    out.append(
                        (
                            b,
                            _planes(packed[0][i:j]),
                            _planes(packed[1][k:m]),
                            sent[1][k:m].astype("<u4").tobytes(),
                            sent[2][k:m].astype("<u4").tobytes(),
                            int(row[first]),
                            doc[known].astype("<u4").tobytes() if here else b"",
                            pos[known].astype("<u4").tobytes() if here else b"",
                        )
                    )
                turn += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], _SENT)

    return send


def _matcher(table: pa.Table) -> pa.Table:
    """Positions of the references whose hash the bucket holds at least twice."""
    parts = table.to_pylist()
    value = np.sort(np.concatenate([_unplanes(p["probes"]) for p in parts]))
    twice = np.unique(value[1:][value[1:] == value[:-1]])
    ref = [_unplanes(p["refs"]) for p in parts]
    sent = np.concatenate(ref)
    at = np.minimum(np.searchsorted(twice, sent), max(0, len(twice) - 1))
    hits = np.split(twice[at] == sent if len(twice) else np.zeros(len(sent), bool), np.cumsum([len(r) for r in ref])[:-1])
    rows, places = [], []
    for p, hit in zip(parts, hits):
        for keep, doc, pos in ((hit, "doc", "pos"), (slice(None), "known_doc", "known_pos")):
            rows.append(np.frombuffer(p[doc], "<u4")[keep].astype(np.int64) + p["base"])
            places.append(np.frombuffer(p[pos], "<u4")[keep].astype(np.int64))
    return pa.table({"row": np.concatenate(rows), "pos": np.concatenate(places)})


def repeated_anchors(rows: DataFrame, anchors: Anchors, buckets: int) -> DataFrame:
    """(row, pos): anchors whose hash is found at another place of ``rows`` (row, id, text).

    ``anchors(data, at)`` gives the probing hashes, and of each reference its hash, document
    and place; references must be among the probes.
    """
    sent = rows.select("row", "text").mapInArrow(_sender(anchors, buckets), SENT)
    # A bucket is heavy work on few bytes: dealt to as many partitions, not merged by size.
    sent = sent.repartition(buckets, "bucket")
    return sent.groupBy("bucket").applyInArrow(_matcher, "row long, pos long")


def with_places(rows: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """``rows`` that have places, with the list of them; a list is bounded by its document."""
    return rows.join(places.groupBy("row").agg(F.collect_list("pos").alias(name)), "row")


def documents_of(batch: pa.RecordBatch, list_column: int) -> Iterator[tuple]:
    """Runs of (rows, ids, data, at, offsets of the lists, values of the lists)."""
    row = batch.column("row").to_numpy()
    doc = batch.column("id").fill_null(int(NO_ID)).to_numpy()
    data, at = bytes_of(batch.column("text"))
    lists = batch.column(list_column)
    edge, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    for first, last in runs(at, RUN):
        span = at[first : last + 1]
        yield row[first:last], doc[first:last], data[span[0] : span[-1]], span - span[0], edge[first : last + 1], flat


def earliest(key: tuple[np.ndarray, ...], doc: np.ndarray, row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Whether each occurrence is the earliest, by document, row and place, of its key."""
    order = np.lexsort((pos, row, doc, *key[::-1]))
    first = np.ones(len(order), bool)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in key:
        same &= k[order][1:] == k[order][:-1]
    first[1:] = ~same
    out = np.empty(len(order), bool)
    out[order] = first
    return out


def merged(start: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Maximal covered spans of intervals."""
    order = np.argsort(start, kind="stable")
    spans: list[list[int]] = []
    for s, e in zip(start[order].tolist(), (start + length)[order].tolist()):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return [tuple(s) for s in spans]

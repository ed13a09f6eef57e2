"""Repeated passages by fixed-block anchors.

A passage of ``WINDOW`` words contains a whole block of half as many words that begins at a
multiple of its length. All such blocks are indexed as references, and every rolling window
of a block's length probes them. A reference that is hit is extended to the windows around
it; of each window's occurrences the earliest stays and every other is a repeat, so what is
removed are the maximal exact repeats of at least ``WINDOW`` words. Windows are judged on
the input. Words are compared by 64-bit hashes of their bytes.

Earlier means a smaller id, or the same document and an earlier start; null ids come first,
and rows with one id are taken in the order of the table. Null texts and texts of fewer
words than a window lose nothing. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.repeats import bucket_count, documents_of, earliest, merged, repeated_anchors, with_places
from touchline.llm.text import Words, bytes_of, runs, whole_text, with_row
from touchline.session import Scratch

WINDOW = 20

FOUND = "bucket int, h binary, doc binary, pos binary, rows binary, ids binary, known_row binary, known_pos binary"
_FOUND = ["bucket", "h", "doc", "pos", "rows", "ids", "known_row", "known_pos"]
_KINDS = [pa.int32()] + [pa.binary()] * 7


def block_anchors(block: int, data: np.ndarray, at: np.ndarray):
    words = Words(data, at)
    first, h = words.windows(block)
    place = first - words.first[words.doc[first]] if len(first) else first
    ref = np.flatnonzero(place % block == 0)
    return h, h[ref], words.doc[first[ref]] if len(ref) else ref, place[ref]


def _windows(block: int, window: int, buckets: int):
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            for row, ids, data, at, edge, hits in documents_of(batch, 3):
                words = Words(data, at)
                first, h = words.windows(window)
                begins = np.zeros(len(words.hash) + 1, np.int64)
                for i in range(len(row)):
                    n = words.count[i] - window + 1
                    if n > 0:  # windows that hold a hit block begin up to window - block before it
                        p = hits[edge[i] : edge[i + 1]]
                        low = np.clip(p - (window - block), 0, n)
                        high = np.clip(p + 1, 0, n)
                        np.add.at(begins, words.first[i] + low, 1)
                        np.add.at(begins, words.first[i] + high, -1)
                wanted = np.cumsum(begins)[first] > 0 if len(first) else np.zeros(0, bool)
                first, h = first[wanted], h[wanted]
                doc = words.doc[first] if len(first) else first
                pos = first - words.first[doc] if len(first) else first
                lead = earliest((h,), ids[doc], row[doc], pos)
                order = np.flatnonzero(lead)[np.argsort(h[lead], kind="stable")]
                cut = np.searchsorted(h[order] >> shift, np.arange(buckets + 1, dtype=np.uint64))
                out = []
                for b in range(buckets):
                    some, here = order[cut[b] : cut[b + 1]], b == turn % buckets
                    if not len(some) and not here:
                        continue
                    used, local = np.unique(doc[some], return_inverse=True)
                    out.append(
                        (
                            b,
                            h[some].astype("<u8").tobytes(),
                            local.astype("<u4").tobytes(),
                            pos[some].astype("<u4").tobytes(),
                            row[used].astype("<i8").tobytes(),
                            ids[used].astype("<i8").tobytes(),
                            row[doc[~lead]].astype("<i8").tobytes() if here else b"",
                            pos[~lead].astype("<i8").tobytes() if here else b"",
                        )
                    )
                turn += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], _FOUND)

    return find


def _later(table: pa.Table) -> pa.Table:
    """Windows of a bucket that have an earlier occurrence."""
    h, row, ids, pos, rows, places = [], [], [], [], [], []
    for p in table.to_pylist():
        doc = np.frombuffer(p["doc"], "<u4")
        h.append(np.frombuffer(p["h"], "<u8"))
        pos.append(np.frombuffer(p["pos"], "<u4").astype(np.int64))
        row.append(np.frombuffer(p["rows"], "<i8")[doc])
        ids.append(np.frombuffer(p["ids"], "<i8")[doc])
        rows.append(np.frombuffer(p["known_row"], "<i8"))
        places.append(np.frombuffer(p["known_pos"], "<i8"))
    h, row, ids, pos = map(np.concatenate, (h, row, ids, pos))
    later = ~earliest((h,), ids, row, pos)
    return pa.table({"row": np.concatenate([row[later], *rows]), "pos": np.concatenate([pos[later], *places])})


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_words and the digest of every document as it is."""
    for batch in batches:
        data, at = bytes_of(batch.column(2))
        for first, last in runs(at, 4 << 20):
            n, digest = [], []
            for i in range(first, last):
                words = data[at[i] : at[i + 1]].tobytes().split()
                n.append(len(words))
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            part = [batch.column(c).slice(first, last - first) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*part, pa.array(n, pa.int64()), pa.array(digest)], ["row", "doc_id", "n_words", "sha"])


def _cutter(window: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, _, data, at, edge, starts in documents_of(batch, 3):
                for i in range(len(row)):
                    words = data[at[i] : at[i + 1]].tobytes().split()
                    p = starts[edge[i] : edge[i + 1]]
                    spans, kept, reached = merged(p, np.full(len(p), window)), [], 0
                    for s, e in spans:
                        kept += words[reached:s]
                        reached = e
                    text = b" ".join(kept + words[reached:])
                    removed = sum(e - s for s, e in spans)
                    flat = [x for s in spans for x in s]
                    out.append((int(row[i]), removed, flat, hashlib.sha256(text).hexdigest(), text if with_text else None))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["row", "n_removed", "spans", "cut_sha", "text"])

    return cut


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, with_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_words, n_removed, spans (first and past-last
    words of the removed runs, flat), kept_sha256; with ``with_text`` also what is left of the
    changed documents (``kept_text``, null if nothing was removed)."""
    block = window // 2
    with Scratch(docs.sparkSession, "substring") as scratch:
        rows = with_row(docs, id=F.col(doc_id).cast("long"), text=whole_text(text).cast("binary"))
        rows = scratch.write(rows.select("row", "id", "text"), "rows")
        buckets = bucket_count(rows)
        hits = scratch.write(repeated_anchors(rows, partial(block_anchors, block), buckets), "hits")
        some = scratch.write(with_places(rows, hits, "hits").select("row", "id", "text", "hits"), "some")
        found = some.mapInArrow(_windows(block, window, buckets), FOUND)
        later = scratch.write(found.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_later, "row long, pos long"), "later")
        changed = with_places(some.drop("hits"), later, "starts").select("row", "id", "text", "starts")
        schema = "row long, n_removed long, spans array<long>, cut_sha string, text binary"
        changed = scratch.write(changed.mapInArrow(_cutter(window, with_text), schema), "changed")
        plain = rows.mapInArrow(_plain, "row long, doc_id long, n_words long, sha string")
        joined = plain.join(changed.withColumnRenamed("text", "kept_text"), "row", "left")
        return scratch.publish(
            joined.select(
                "row",
                "doc_id",
                "n_words",
                F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                F.coalesce("spans", F.array().cast("array<long>")).alias("spans"),
                F.coalesce("cut_sha", "sha").alias("kept_sha256"),
                *(["kept_text"] if with_text else []),
            )
        )

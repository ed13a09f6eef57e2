"""Repeated byte strings by suffix arrays.

A string of ``WINDOW`` bytes that is found twice holds, at the same place each time, the
same least 32-byte gram (by hash, leftmost first). So documents are sampled by these
anchors; anchors whose gram repeats are cut out with all the windows they are least in, and
such fragments meet by gram. Equal fragments are collapsed to the earliest, those that
differ are cut to what agrees with another one around the gram, and equal ones collapsed
again. Where fragments with one gram still differ, their suffix array, built by linear grouping, and common
prefixes show which windows they share; of each window's occurrences the earliest stays and
the others are removed. Strings are judged on the input; matches never cross documents.

Anchors and fragments are compared by 64-bit hashes, windows within a suffix array by their
bytes. The fragments of one gram are sorted together, unless it has many: of a gram with
``HOT`` different surroundings or more each window is a key of its own, the hash of its
bytes, and only equal windows meet, first within a task and then in a join, so such a gram
spreads over all tasks. Surroundings are counted over the runs of text that hold ``SEEN``
or more of them; which way a gram goes changes the load and not what is found.

Earlier means a smaller id, or the same document and an earlier start; null ids come first,
and rows with one id are taken in the order of the table. Null texts count as empty; a text
shorter than a window loses nothing. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.repeats import bucket_count, documents_of, earliest, merged, repeated_anchors, with_places
from touchline.llm.suffixes import common_prefixes, suffix_array
from touchline.llm.text import bytes_of, mix, span_hashes, whole_text, window_hashes, with_row
from touchline.session import Scratch

WINDOW, GRAM = 100, 32
BLOCK = 64 << 10  # bytes of fragments per suffix array; one gram's fragments are not parted
HOT, SEEN = 4096, 8

FOUND = (
    "bucket int, h binary, doc binary, pos binary, size binary, gram binary, text binary, rows binary, "
    "ids binary, known_row binary, known_span binary, many binary"
)
_FOUND = [f.split()[0] for f in FOUND.split(", ")]
_KINDS = [pa.int32()] + [pa.binary()] * 11
_PLACE = np.uint64((1 << 30) - 1)


def minimizers(window: int, data: np.ndarray, at: np.ndarray):
    """Of each anchor: hash, document, place, and first and last window it is least in.

    The least of many hashes is small, so it is hashed again: upper bits are even and make even buckets.
    """
    n = len(data) - GRAM + 1
    empty = np.zeros(0, np.int64)
    if n < window - GRAM + 1:
        return np.zeros(0, np.uint64), empty, empty, empty, empty
    gram = window_hashes(data, GRAM)
    least = gram & ~_PLACE
    least |= np.arange(n, dtype=np.uint64)
    wide, width = window - GRAM + 1, 1
    while 2 * width <= wide:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if wide > width:
        rest = wide - width
        least = np.minimum(least[:-rest], least[rest:])
    size = np.diff(at)
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)[: len(least)]
    left = np.repeat(at[1:].astype(np.int32), size)[: len(least)]
    left -= np.arange(len(least), dtype=np.int32)
    start = np.flatnonzero(left >= window)
    del left
    if not len(start):
        return np.zeros(0, np.uint64), empty, empty, empty, empty
    least = least[start]
    least &= _PLACE
    anchor = least.view(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[start[1:]] != doc[start[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    whose = doc[start[first]].astype(np.int64)
    base = at[whose]
    return mix(gram[anchor[first]]), whose, anchor[first] - base, start[first] - base, start[last] - base


def byte_anchors(window: int, data: np.ndarray, at: np.ndarray):
    h, doc, pos, _, _ = minimizers(window, data, at)
    return h, h, doc, pos


def _span(pos: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """A place and a length in one number."""
    return (pos.astype(np.int64) << 16) | size


def _fragments(window: int, buckets: int, seen: int):
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            for row, ids, data, at, edge, hits in documents_of(batch, 3):
                h, doc, place, first, last = minimizers(window, data, at)
                whose = np.repeat(np.arange(len(row)), np.diff(edge))
                hit = np.isin((doc << 32) | place, (whose << 32) | hits[edge[0] : edge[-1]])
                h, doc, first, last, place = (x[hit] for x in (h, doc, first, last, place))
                size = last + window - first
                begin = at[doc] + first
                same = span_hashes(data, begin, begin + size) if len(h) else h
                lead = earliest((h, same), ids[doc], row[doc], first)
                order = np.flatnonzero(lead)[np.argsort(h[lead], kind="stable")]
                cut = np.searchsorted(h[order] >> shift, np.arange(buckets + 1, dtype=np.uint64))
                gram, n = np.unique(h[lead], return_counts=True)
                many = np.stack([gram, n.astype(np.uint64)], 1)[n >= seen].astype("<u8").tobytes()
                raw, out = data.tobytes(), []
                for b in range(buckets):
                    some, here = order[cut[b] : cut[b + 1]], b == turn % buckets
                    if not len(some) and not here:
                        continue
                    used, local = np.unique(doc[some], return_inverse=True)
                    spans = zip(begin[some].tolist(), (begin + size)[some].tolist())
                    out.append(
                        (
                            b,
                            h[some].astype("<u8").tobytes(),
                            local.astype("<u4").tobytes(),
                            first[some].astype("<u4").tobytes(),
                            size[some].astype("<u2").tobytes(),
                            (place - first)[some].astype("<u2").tobytes(),
                            b"".join(raw[i:j] for i, j in spans),
                            row[used].astype("<i8").tobytes(),
                            ids[used].astype("<i8").tobytes(),
                            row[doc[~lead]].astype("<i8").tobytes() if here else b"",
                            _span(first[~lead], size[~lead]).astype("<i8").tobytes() if here else b"",
                            many if here else b"",
                        )
                    )
                turn += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], _FOUND)

    return find


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["h", "n"])


def _without(hot: np.ndarray):
    """The packed fragments but those of the hot grams."""

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"h": "<u8", "doc": "<u4", "pos": "<u4", "size": "<u2", "gram": "<u2"}
        for batch in batches:
            out = batch.to_pylist()
            for p in out:
                keep = ~np.isin(np.frombuffer(p["h"], "<u8"), hot)
                if keep.all():
                    continue
                size = np.frombuffer(p["size"], "<u2").astype(np.int64)
                p["text"] = np.frombuffer(p["text"], np.uint8)[np.repeat(keep, size)].tobytes()
                for k, kind in kinds.items():
                    p[k] = np.frombuffer(p[k], kind)[keep].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], t) for k, t in zip(_FOUND, _KINDS)], _FOUND)

    return leave


def _hot_windows(hot: np.ndarray, window: int):
    """Every window of the hot grams' fragments; ``first`` if none of its run is earlier."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                h = np.frombuffer(p["h"], "<u8")
                some = np.flatnonzero(np.isin(h, hot))
                if not len(some):
                    continue
                size, doc = np.frombuffer(p["size"], "<u2").astype(np.int64), np.frombuffer(p["doc"], "<u4")
                n = size[some] - window + 1
                f = np.repeat(some, n)
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = (np.cumsum(size) - size)[f] + place
                w = span_hashes(np.frombuffer(p["text"], np.uint8), start, start + window)
                ids, row = (np.frombuffer(p[k], "<i8")[doc[f]] for k in ("ids", "rows"))
                pos = np.frombuffer(p["pos"], "<u4").astype(np.int64)[f] + place
                first = earliest((h[f], w), ids, row, pos)
                columns = [h[f].view("<i8"), w.view("<i8"), ids, row, pos, first]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "w", "id", "row", "pos", "first"])

    return find


def _hot_later(every: DataFrame, window: int) -> DataFrame:
    """(row, pos): windows of the hot grams that have an earlier occurrence."""
    place = F.struct("id", "row", "pos")
    top = every.where("first").groupBy("h", "w").agg(F.min(place).alias("top"), F.count(F.lit(1)).alias("n"))
    again = every.where("first").join(top.where("n > 1").drop("n"), ["h", "w"]).where(place != F.col("top"))
    later = again.select("row", "pos").union(every.where("NOT first").select("row", "pos"))
    return later.select("row", (F.col("pos") * (1 << 16) + window).alias("pos"))


def shared_windows(text: np.ndarray, start: np.ndarray, size: np.ndarray, window: int):
    """(class, fragment, offset) of windows found at least twice in some fragments of a text."""
    symbols = np.ones(int(size.sum()) + len(size) + 1, np.int64)  # 1 parts fragments, 0 ends all
    symbols[-1] = 0
    owner, rest = np.full(len(symbols), -1), np.zeros(len(symbols), np.int64)
    to = 0
    for k, (s, n) in enumerate(zip(start.tolist(), size.tolist())):
        symbols[to : to + n] = text[s : s + n].astype(np.int64) + 2
        owner[to : to + n] = k
        rest[to : to + n] = np.arange(n, 0, -1)
        to += n + 1
    listed = symbols.tolist()
    order = suffix_array(listed)
    common = np.array(common_prefixes(listed, order))
    order = np.array(order)
    left = rest[order]
    same = np.zeros(len(order), bool)
    same[1:] = np.minimum(common[1:], np.minimum(left[1:], left[:-1])) >= window
    kind = np.cumsum(~same)
    held = same.copy()
    held[:-1] |= same[1:]
    place = order[held]
    return kind[held], owner[place], size[owner[place]] - rest[place]


def _blocks(h: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Fragments in order of their gram, those of one gram together, if it has several."""
    order = np.argsort(h, kind="stable")
    edge = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
    block, total = [], 0
    for i, j in zip(edge.tolist(), np.append(edge[1:], len(order)).tolist()):
        if j - i > 1:
            block.append(order[i:j])
            total += int(size[order[i:j]].sum())
            if total >= BLOCK:
                yield np.concatenate(block)
                block, total = [], 0
    if block:
        yield np.concatenate(block)


def _later(window: int, table: pa.Table) -> pa.Table:
    """(row, pos): what a bucket's fragments show to have an earlier occurrence."""

    def flat(name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """The packed values of all parts, without a copy of each, and where each part begins."""
        data, at = bytes_of(table.column(name))
        return data.view(kind), at // np.dtype(kind).itemsize

    h, part = flat("h", "<u8")
    whose, held = flat("rows", "<i8")
    doc = flat("doc", "<u4")[0] + np.repeat(held[:-1], np.diff(part))
    row, ids = whose[doc], flat("ids", "<i8")[0][doc]
    pos, size, gram = (flat(k, kind)[0].astype(np.int64) for k, kind in (("pos", "<u4"), ("size", "<u2"), ("gram", "<u2")))
    text = flat("text", "u1")[0]
    rows, spans = [flat("known_row", "<i8")[0]], [flat("known_span", "<i8")[0]]
    del table, doc, whose
    begin = np.cumsum(size) - size

    def collapse(kept: np.ndarray) -> np.ndarray:
        """Those of the fragments that are the earliest of their content; others are found."""
        same = span_hashes_in(text, begin[kept], size[kept])
        lead = earliest((h[kept], same), ids[kept], row[kept], pos[kept])
        rows.append(row[kept[~lead]])
        spans.append(_span(pos[kept[~lead]], size[kept[~lead]]))
        return kept[lead]

    kept = collapse(np.arange(len(h))) if len(h) else np.zeros(0, np.int64)
    if len(kept):
        # A fragment is cut to what agrees with another one of its gram, to either side.
        left = _agreement(h[kept], text, begin[kept] + gram[kept] - 1, gram[kept], -1)
        right = _agreement(h[kept], text, begin[kept] + gram[kept], size[kept] - gram[kept], 1)
        cut = gram[kept] - left
        begin[kept], pos[kept], size[kept] = begin[kept] + cut, pos[kept] + cut, left + right
        kept = kept[size[kept] >= window]
        kept = collapse(kept) if len(kept) else kept
    for block in _blocks(h[kept], size[kept]):
        some = kept[block]
        kind, owner, offset = shared_windows(text, begin[some], size[some], window)
        f = some[owner]
        again = ~earliest((kind,), ids[f], row[f], pos[f] + offset)
        rows.append(row[f[again]])
        spans.append(_span((pos[f] + offset)[again], window))
    return pa.table({"row": np.concatenate(rows).astype(np.int64), "pos": np.concatenate(spans).astype(np.int64)})


def _judge(window: int):
    def judge(table: pa.Table) -> pa.Table:
        found = _later(window, table)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks
        return found

    return judge


def span_hashes_in(text: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """``span_hashes`` of spans in order of their beginnings, a bounded part at a time."""
    out, i = [], 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(begin, begin[i] + most, "right")))
        base, end = begin[i], (begin[i:j] + size[i:j]).max()
        out.append(span_hashes(text[base:end], begin[i:j] - base, begin[i:j] - base + size[i:j]))
        i = j
    return np.concatenate(out)


def _agreement(h: np.ndarray, text: np.ndarray, origin: np.ndarray, length: np.ndarray, step: int) -> np.ndarray:
    """How many bytes from its origin on each fragment has in common with another of its gram."""
    order = np.argsort(h, kind="stable")
    edge = np.append(np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1])), len(h))
    found, i = np.zeros(len(h), np.int64), 0
    while i < len(h):  # whole grams, a bounded number of fragments at a time
        j = int(edge[np.searchsorted(edge, min(i + 4096, len(h)))])
        some = order[i:j]
        found[some] = _agree(h[some], text, origin[some], length[some], step)
        i = j
    return found


def _agree(h: np.ndarray, text: np.ndarray, origin: np.ndarray, length: np.ndarray, step: int) -> np.ndarray:
    """Sorted neighbours agree most. Bytes of zero can make this too large, never too small."""
    width = max(8, -(-int(length.max()) // 8) * 8)
    reach = np.arange(width)
    there = reach < length[:, None]
    symbols = np.where(there, text[np.where(there, origin[:, None] + step * reach, 0)], np.uint8(0))
    words = np.ascontiguousarray(symbols).view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], h))
    differ = symbols[order[1:]] != symbols[order[:-1]]
    shared = np.where(differ.any(1), differ.argmax(1), width)
    shared[h[order[1:]] != h[order[:-1]]] = 0
    best = np.zeros(len(h), np.int64)
    best[order[1:]] = shared
    best[order[:-1]] = np.maximum(best[order[:-1]], shared)
    return np.minimum(best, length)


def _cutter(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, _, data, at, edge, packed in documents_of(batch, 3):
                for i in range(len(row)):
                    raw = data[at[i] : at[i + 1]].tobytes()
                    some = packed[edge[i] : edge[i + 1]]
                    spans, kept, reached = merged(some >> 16, some & 0xFFFF), [], 0
                    for s, e in spans:
                        kept.append(raw[reached:s])
                        reached = e
                    text = b"".join([*kept, raw[reached:]])
                    flat = [x for s in spans for x in s]
                    out.append((int(row[i]), len(raw) - len(text), flat, hashlib.sha256(text).hexdigest(), text if with_text else None))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["row", "n_removed", "spans", "cut_sha", "text"])

    return cut


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    with_text: bool = False,
    hot: int = HOT,
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_bytes, n_removed, n_spans, spans (first and
    past-last bytes of the removed runs, flat), kept_sha256; with ``with_text`` also what is
    left of the changed documents (``kept_text``, null if nothing was removed)."""
    with Scratch(docs.sparkSession, "suffix", compression="zstd") as scratch:
        rows = with_row(docs, id=F.col(doc_id).cast("long"), text=whole_text(text).cast("binary"))
        rows = scratch.write(rows.select("row", "id", "text"), "rows")
        buckets = bucket_count(rows)
        hits = scratch.write(repeated_anchors(rows, partial(byte_anchors, window), buckets), "hits")
        scratch.drop()
        some = with_places(rows, hits, "hits").select("row", "id", "text", "hits")
        found = scratch.write(some.mapInArrow(_fragments(window, buckets, min(SEEN, hot)), FOUND), "found")
        scratch.drop("hits")
        counts = found.select("many").where("octet_length(many) > 0").mapInArrow(_counts, "h long, n long")
        many = counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= hot)
        # At most one gram for every ``hot`` fragments.
        grams = np.array([r["h"] for r in many.collect()], np.int64).view(np.uint64)
        cold = found.mapInArrow(_without(grams), FOUND) if len(grams) else found
        later = cold.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_judge(window), "row long, pos long")
        later = scratch.write(later, "later")
        scratch.drop()
        if len(grams):
            schema = "h long, w long, id long, row long, pos long, first boolean"
            every = scratch.write(found.mapInArrow(_hot_windows(grams, window), schema), "hot")
            scratch.drop("found")
            later = later.union(scratch.write(_hot_later(every, window), "hot-later"))
        scratch.drop("found", "hot")
        changed = with_places(rows, later, "packed").select("row", "id", "text", "packed")
        schema = "row long, n_removed long, spans array<long>, cut_sha string, text binary"
        changed = scratch.write(changed.mapInArrow(_cutter(with_text), schema), "changed")
        scratch.drop("later", "hot-later")
        plain = rows.select(
            "row", F.col("id").alias("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
        )
        joined = plain.join(changed.withColumnRenamed("text", "kept_text"), "row", "left")
        spans = F.coalesce("spans", F.array().cast("array<long>"))
        return scratch.publish(
            joined.select(
                "row",
                "doc_id",
                "n_bytes",
                F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                (F.size(spans) / 2).cast("long").alias("n_spans"),
                spans.alias("spans"),
                F.coalesce("cut_sha", "sha").alias("kept_sha256"),
                *(["kept_text"] if with_text else []),
            )
        )

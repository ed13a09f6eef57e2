"""A gram with many different surroundings is parted by its windows."""

import random

import numpy as np
import pyarrow as pa

from touchline.llm import suffix_dedup as dedup

WINDOW = 100


def _brute(docs):
    """Removed bytes of each document: all windows but the earliest, as the input has them."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw, gone = text.encode(), set()
        for s in range(len(raw) - WINDOW + 1):
            w = raw[s : s + WINDOW]
            if w in seen:
                gone.update(range(s, s + WINDOW))
            seen.add(w)
        out[i] = len(gone)
    return out


def test_hot_grams_find_the_same(spark, docs):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    line, near = letters(60), [letters(45) for _ in range(4)]
    rows = [(i, letters(120) + rng.choice([*near, letters(45)]) + line + rng.choice([*near, letters(45)]) + letters(120)) for i in range(120)]
    frame, want = docs(rows), _brute(rows)
    assert sum(want.values()) > 0
    for hot in (2, 20, dedup.HOT):
        got = {r.doc_id: r.n_removed for r in dedup.remove_repeats(frame, hot=hot).collect()}
        assert got == want


def test_a_hot_gram_leaves_the_buckets():
    rng = np.random.default_rng(2)
    line = rng.integers(97, 123, 90, np.uint8).tobytes()
    texts = [rng.integers(97, 123, 90, np.uint8).tobytes() + line + rng.integers(97, 123, 90, np.uint8).tobytes() for _ in range(50)]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    h, doc, place, _, _ = dedup.minimizers(WINDOW, data, at)
    value, n = np.unique(h, return_counts=True)
    hot = value[n > 5]
    assert len(hot)
    hits = [place[doc == i].tolist() for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(50), pa.int64()), pa.array(range(50), pa.int64()), pa.array(texts, pa.binary()), pa.array(hits, pa.list_(pa.int64()))],
        ["row", "id", "text", "hits"],
    )
    found = list(dedup._fragments(WINDOW, 8, 2)(iter([batch])))
    left = pa.Table.from_batches(list(dedup._without(hot)(iter(found)))).to_pylist()
    kept = np.concatenate([np.frombuffer(p["h"], "<u8") for p in left])
    assert len(kept) and not np.isin(kept, hot).any()
    assert sum(len(p["text"]) for p in left) == sum(np.frombuffer(p["size"], "<u2").sum() for p in left)

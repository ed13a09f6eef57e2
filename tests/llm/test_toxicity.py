import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from touchline.llm import toxicity


def test_margins_follow_the_windows():
    ordinary, toxic = b" some common words ", b" wretched some common words "
    texts = [b"", b"some wretched words", b"common words and more" * 9, b"x" * 500]
    at = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = toxicity.margins(data, at, ordinary, toxic)
    for i, t in enumerate(texts):
        spans = range(0, max(1, len(t) - toxicity.WINDOW + toxicity.STEP), toxicity.STEP) if t else []
        size = lambda d, s: len(toxicity._compressor(d).compress(t[s : s + toxicity.WINDOW]))
        m = sorted((size(ordinary, s) - size(toxic, s) for s in spans), reverse=True) + [0, 0]
        assert got[i, 0] == max(0, m[0]) and got[i, 1] == max(0, m[1])
    assert got[1, 0] >= 5 and got[3, 0] <= 1


def test_held_out_accuracy(spark, docs):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("aeiourstn", k=rng.randint(2, 8))) for _ in range(400)]
    bad = ["wretched", "blockhead", "dimwit", "vermin"]
    rows, labels = [], []
    for i in range(900):
        words = rng.choices(vocabulary, k=rng.randint(30, 200))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "wretched dimwit")]
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score(docs(rows), frame).collect()
    assert len(got) == len(rows)
    truth, hit = dict(labels), []
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.held_out and r.doc_id in truth:
            hit.append(r.predicted == truth[r.doc_id])
    assert np.mean(hit) > 0.97


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs([(1, "a b"), (1, "a b")]), none).collect()} == {0.0}
    assert toxicity.score(docs([]), none).count() == 0


def test_stretches_are_the_covered_runs():
    rng = random.Random(8)
    g = toxicity.GRAM
    for size in (0, 5, 8, 60, 700):
        text = bytes(rng.choices(b"abc ", k=size))
        number = {text[i : i + g]: int.from_bytes(text[i : i + g], "little", signed=True) for i in range(size - g + 1)}
        assert sorted(set(toxicity.grams(np.frombuffer(text, np.uint8)).tolist())) == sorted(number.values())
        marked = set(rng.sample(sorted(number), len(number) // 9))
        covered = [False] * size
        for i in range(size - g + 1):
            if text[i : i + g] in marked:
                covered[i : i + g] = [True] * g
        got = toxicity.stretches(np.frombuffer(text, np.uint8), np.sort(np.array([number[m] for m in marked], np.int64)))
        joined, at = set(), 0
        while at < size:
            end = at
            while end < size and covered[end]:
                end += 1
            joined.add(text[at:end])
            at = end + 1
        joined.discard(b"")
        whole = [p for p in got if len(p) < toxicity.TOXIC_PIECE]
        assert all(any(p in j for j in joined) for p in got)
        assert {j for j in joined if len(j) < toxicity.TOXIC_PIECE} <= set(whole)
        assert all(any(m in p for p in got) for m in marked)


def test_contrast_is_the_gain_of_two_shares(spark):
    rows = [(t, o) for t in range(1, 6) for o in range(0, 8)]
    frame = spark.createDataFrame(rows, "t long, o long")
    got = frame.select("t", "o", toxicity.contrast(F.col("t"), F.col("o"), 5, 7).alias("g")).collect()

    def fit(k, n, p):
        return (k * np.log(p) if k else 0) + ((n - k) * np.log(1 - p) if n > k else 0)

    for r in got:
        a, b, both = r.t / 5, r.o / 7, (r.t + r.o) / 12
        want = fit(r.t, 5, a) + fit(r.o, 7, b) - fit(r.t, 5, both) - fit(r.o, 7, both) if a > b else 0
        assert abs(r.g - want) < 1e-9


def test_labelled_edge_texts_ties_and_other_columns(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("aeioun", k=4)) for _ in range(60)]
    rows, labels = [], []
    for i in range(60):
        text = " ".join(rng.choices(words, k=40)) + (" blockhead dimwit" if i % 2 else "")
        rows += [(i, text)] * (3 if i % 7 == 0 else 1)
        labels.append((i, i % 2))
    edges = [None, "", "x", "blockhead", " \n ", "dimwit " * 40_000]
    rows += [(100 + k, t) for k, t in enumerate(edges)]
    labels += [(100 + k, k % 2) for k in range(len(edges))] + [(3, 0), (None, 1), (7, None)]
    # Other columns bear the operator's own names.
    docs = spark.createDataFrame([(*r, 0.5, 1, "z") for r in rows], "doc_id long, text string, score double, toxic int, top string")
    known = spark.createDataFrame([(*x, "q") for x in labels], "doc_id long, toxic int, text string")
    got = toxicity.score(docs, known).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    by_id = {}
    for r in got:
        assert 0 <= r.score <= 1
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(s) == 1 for s in by_id.values())
    assert by_id[100] == by_id[101]

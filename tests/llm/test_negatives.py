"""Hard negatives against a plain Python version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import negatives, queries

VEC = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, k=10, move=True):
    kept = []
    for vec_id, vector, label in rows:
        if None in (vec_id, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if move and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for a, (anchor, u, label) in enumerate(kept):
        if anchor % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(u, v)), i, lab) for j, (i, v, lab) in enumerate(kept) if j != a]
        scores.sort()
        for s, p, _ in [r for r in scores if r[2] == label][:positives]:
            inside = [(n, i) for n, i, lab in scores if lab != label and 30 * -s <= 100 * -n <= 90 * -s][:k]
            out += [(anchor, p, r, i, -s, -n) for r, (n, i) in enumerate(inside, 1)]
    return sorted(out, key=repr)


@pytest.fixture
def vectors():
    rng = random.Random(7)
    centre = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(10)]
    rows = []
    for i in range(900):
        label = rng.randrange(10)
        rows.append((i, [(c + rng.gauss(0, 0.8)) / 4 for c in centre[label]], label))
    copy = rows[250][1]
    rows += [(1000 + i, copy, rows[250][2]) for i in range(300)]  # ties, a hot group and a label's third
    rows += [rows[200], rows[200], rows[31]]
    rows += [(1400, None, 1), (1401, copy, None), (None, copy, 3), (1403, [0.0] * 12, 2), (1500, [0.0] * 12, 2)]
    rows += [(1404, [math.nan] + copy[1:], 1), (1405, [math.inf] + copy[1:], 1), (1406, [None] + copy[1:], 1)]
    rows += [(1407, [], 4), (1600, copy[:5], 4), (1700, [-x for x in copy], 77)]
    return rows


def test_query_against_plain(spark, vectors, rows, tmp_path):
    spark.createDataFrame(vectors, VEC).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = queries.QUERIES["op13_hard_negatives"](spark, str(tmp_path))
    assert rows(out) == plain(vectors)


def test_many_segments_and_tiles(spark, vectors, rows):
    frame = spark.createDataFrame(vectors, VEC)
    out = negatives.mine(frame, F.col("vec_id") % 100 == 0, segment=150, members=3)
    assert rows(out) == plain(vectors, move=False)


def test_empty_and_clashing_columns(spark, rows):
    anchor = F.col("vec_id") % 100 == 0
    assert rows(negatives.mine(spark.createDataFrame([], VEC), anchor)) == []
    assert rows(negatives.mine(spark.createDataFrame([(1, [1.0], 1)], VEC), anchor)) == []
    few = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2)]
    frame = spark.createDataFrame(few, VEC).selectExpr("*", "1 AS row", "2 AS id", "3 AS vector", "4 AS tile", "5 AS anchor")
    assert rows(negatives.mine(frame, anchor)) == [(0, 1, 1, 2, 65536, 32768)]


def test_walks_stop_early():
    """In a tight cluster the walk ends long before the list does."""
    rng = np.random.default_rng(2)
    members = np.rint(256 * np.array([1.0] + [0.0] * 7) + rng.normal(0, 2, (20, 8)))
    candidates = np.rint(rng.normal(0, 90, (40 * negatives.BLOCK, 8)))
    best = negatives._Best(len(members), 5)
    read = negatives._walk(
        members,
        candidates,
        lambda who: best.floor[who],
        lambda who, s, cols: best.take(who, s, np.ones(s.shape, bool), cols),
    )
    scores = members @ candidates.T
    assert read <= 4
    assert [sorted(best.parts[0][1][best.parts[0][0] == m]) for m in range(20)] == [sorted(x)[-5:] for x in scores]


def test_too_long_for_exact_scores_is_an_error(spark):
    frame = spark.createDataFrame([(0, [1e30], 1)], VEC)
    with pytest.raises(Exception, match="too long for exact scores"):
        negatives.mine(frame, F.col("vec_id") % 100 == 0)

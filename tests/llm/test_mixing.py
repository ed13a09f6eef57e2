import re
from collections import defaultdict

import pytest

from touchline.llm import mixing


def test_share_out():
    assert mixing.share_out([10, 10], [1, 1]) == [10, 10]
    assert mixing.share_out([10, 110], [3, 1]) == [30, 90]
    assert mixing.share_out([], []) == []
    assert mixing.share_out([0, 8], [1, 1]) == [0, 8]


def test_meets_targets(docs):
    import random

    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([1, 5, 40, 900]), rng.choice(["a"] * 6 + ["b", "é", None])) for i in range(3000)]
    rows += [(9000, None, "a"), (9001, "", "zz"), (None, "x y", "a")]
    frame = docs(rows)
    got = mixing.mix(frame).collect()
    again = mixing.mix(frame).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    totals, taken, target = defaultdict(int), defaultdict(int), {}
    for i, _, s in rows:
        totals[s] += size[i]
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == totals[r.source]
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    want = mixing.share_out([totals[s] for s in order], [1 + i % 3 for i in range(len(order))])
    assert [target[s] for s in order] == pytest.approx(want)
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 0.5, s


def test_take_copies_and_empty(docs):
    frame = docs([(i, "a b c " * (i % 4), "s" if i % 5 else "t") for i in range(100)])
    left = mixing.take_copies(frame)
    assert left.columns == frame.columns
    counts = {r.doc_id: r["count"] for r in left.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in mixing.mix(frame).where("copies > 0").collect()}
    assert mixing.mix(docs([])).count() == 0
    assert mixing.take_copies(docs([])).count() == 0

import random
import re

import numpy as np
import pytest

from touchline.llm import jaccard


def sets(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(rows):
    s = [sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            k = len(s[i] & s[j])
            if s[i] and 100 * k >= 80 * (len(s[i]) + len(s[j]) - k) and s[j]:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d, len(s[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def variants(seed, n=220):
    """Chains of edited texts, shared boilerplate, short texts, copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(800)]
    boiler = rng.choices(vocabulary, k=40)
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.5:
            words = (rng.choice(rows)[1] or "x").split(" ")
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            words = words[rng.choice([0, 0, 3]) :]
        elif kind < 0.75:
            words = boiler + rng.choices(vocabulary, k=rng.choice([2, 6, 9, 12]))
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 3, 5, 9, 60, 200]))
        text = " ".join(words)
        rows.append((1000 - i, text.upper() if kind < 0.1 else text))
    return rows + [(2000, None), (2001, ""), (2002, " \n")]


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_all_pairs(docs, seed):
    rows = variants(seed)
    got = jaccard.link(docs(rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    kept = sorted(r.doc_id for r in got if r.kept)
    assert kept == sorted({c for _, n, c in brute(rows)})


def test_every_link_shares_enough_prefix_tokens():
    rng = np.random.default_rng(3)
    above = np.where(rng.random(jaccard.CELLS) < 0.3, rng.integers(0, 500, jaccard.CELLS), 0).astype(float)
    for _ in range(300):
        n = int(rng.integers(2, 60))
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        b = a.copy()
        b[rng.permutation(n)[: int(rng.integers(0, max(1, n // 8)))]] += np.uint64(1)
        k = len(np.intersect1d(a, b))
        if 100 * k < 80 * (len(set(a)) + len(set(b)) - k):
            continue
        (la, _, pa_), (lb, _, pb) = jaccard.prefix(np.unique(a), above), jaccard.prefix(np.unique(b), above)
        assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_group_around_a_middle(docs, monkeypatch):
    """Near copies of one text, many too far from it, their tokens known as frequent."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = [(500, " ".join(base))]
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            words[rng.randrange(len(words))] = f"u{rng.randrange(400)}"
        rows.append((i, " ".join(words)))
    cells = np.bincount(np.concatenate([jaccard._cell(jaccard.shingle_sets(*_bytes(t))[1]) for _, t in rows]), minlength=jaccard.CELLS)
    monkeypatch.setattr(jaccard, "frequencies", lambda _: np.where(cells > 8, cells, 0).astype(float))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.link(docs(rows)).collect())
    assert got == brute(rows) and len({c for _, _, c in got}) > 2


def _bytes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def test_repeated_null_ids_and_empty(docs):
    text = "one two three four five six"
    got = jaccard.link(docs([(None, text), (5, text), (5, text), (7, "other words")])).collect()
    assert sorted((r.component_id, r.kept) for r in got) == [(5, False), (5, False), (5, True), (7, True)]
    assert jaccard.link(docs([])).count() == 0

import math
import os
import re

import numpy as np
import pytest

from touchline.llm import quality

WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    wins = list(zip(words, words[1:], words[2:]))
    hit = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(i, i + 3)}
    lines, dup, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_measures(docs, corpus):
    rows = [(i, t) for i, t, _ in corpus if len(t or "") < 5000]
    rows += [(9001, "a\nb\na\n \na"), (9002, "x y z x y z ###"), (None, "a b c a b c é")]
    got = {r.doc_id: r for r in quality.judge(docs(rows)).collect()}
    for i, t in rows:
        r, want = got[i], plain(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def plain_estimate(rows, rounds=500):
    """The same expectation maximisation over single documents, written out."""
    kinds = range(1 + len(quality.FAULTS))
    start = [[list(quality.FAULTY if k and j in quality.FAULTS[k - 1] else quality.SOUND) for j in range(quality.RULES)] for k in kinds]
    before = [quality.GOOD] + [quality.FAULT] * len(quality.FAULTS)
    vote, share, last = start, before, None
    for _ in range(rounds):
        p = []
        for row in rows:
            w = [share[k] * math.prod(vote[k][j][x] for j, x in enumerate(row)) for k in kinds]
            p.append([x / sum(w) for x in w])
        if last and max(abs(x - y) for a, b in zip(p, last) for x, y in zip(a, b)) < 1e-9:
            break
        last = p
        total = [sum(x[k] for x in p) for k in kinds]
        vote = [
            [
                [(sum(x[k] for x, row in zip(p, rows) if row[j] == v) + quality.PRIOR * start[k][j][v]) / (total[k] + quality.PRIOR) for v in range(3)]
                for j in range(quality.RULES)
            ]
            for k in kinds
        ]
        share = [(total[k] + quality.PRIOR * before[k]) / (len(rows) + quality.PRIOR) for k in kinds]
    return [x[0] for x in p], share


def drawn(rng, n):
    """Good documents, of which a few get a bad vote by chance, and two kinds of fault."""
    kind = rng.choice(3, n, p=[0.85, 0.1, 0.05])
    v = np.where(rng.random((n, quality.RULES)) < 0.1, 1, 2)
    v[:, 8] = np.where(rng.random(n) < 0.1, 0, v[:, 8])  # a rule that says nothing
    for k, rules in ((1, quality.FAULTS[0]), (2, quality.FAULTS[1])):
        for j in rules:
            v[(kind == k) & (rng.random(n) < 0.9), j] = 0
    return kind, v


def test_estimate_against_plain():
    _, v = drawn(np.random.default_rng(3), 150)
    patterns, back, n = np.unique(v @ 3 ** np.arange(quality.RULES), return_inverse=True, return_counts=True)
    p, share, _ = quality.estimate(patterns, n)
    want, want_share = plain_estimate(v.tolist())
    assert np.allclose(p[back], want, atol=1e-6) and np.allclose(share, want_share, atol=1e-6)


def test_estimate_decides_and_not_the_single_vote():
    kind, v = drawn(np.random.default_rng(1), 20000)
    patterns, back, n = np.unique(v @ 3 ** np.arange(quality.RULES), return_inverse=True, return_counts=True)
    p, share, vote = quality.estimate(patterns, n)
    said = p[back] >= 0.5
    assert (said == (kind == 0)).mean() > 0.99
    voted_bad = (v == 0).any(axis=1)
    assert (said & voted_bad).sum() > 1000  # all-must-pass would reject these
    assert abs(share[0] - 0.85) < 0.02 and vote[0, 8, 0] > 0.08 and vote[1, :3, 0].min() > 0.8


TABLES = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
def test_verdict_against_labels(spark):
    """Low quality goes, good documents stay, some of them against a bad vote of a rule."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").select("doc_id", "quality")
    rows = quality.judge(docs).join(labels.select("doc_id"), "doc_id").collect()
    m = {k: np.array([r[k] for r in rows]) for k in quality.MEASURES}
    passes = (quality.votes(m) >= 0).all(axis=1)
    kept, failed = np.array([r.kept for r in rows]), np.array([r.base_failed for r in rows])
    label = dict(map(tuple, labels.collect()))
    good = np.array([label[r.doc_id] == 1 for r in rows])
    assert not kept[~good].any()
    assert kept[good & ~failed].mean() >= 0.99
    assert (kept & ~passes).any()


def test_empty_repeated_and_kept(docs):
    assert quality.judge(docs([])).count() == 0
    good = " ".join(f"word{i}" for i in range(150))
    frame = docs([(1, good), (1, good), (2, None), (3, "spam " * 90)])
    assert sorted(r.doc_id for r in quality.keep_good(frame).collect()) == [1, 1]


def test_filter_agrees_with_verdict(docs, corpus):
    """Nulls, empty and long texts, repeated rows and clashing columns; the same rows stay."""
    frame = docs(corpus).selectExpr("*", "1 AS row", "2 AS pattern", "3 AS kept", "4 AS n_words")
    want = sorted(r.doc_id for r in quality.judge(frame).where("kept").collect())
    got = quality.keep_good(frame)
    assert got.columns == frame.columns
    assert sorted(r.doc_id for r in got.collect()) == want

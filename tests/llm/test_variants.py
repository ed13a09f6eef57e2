"""Spelling variants against a plain Python version."""

import random
import re
import zlib
from collections import Counter

import pytest

from touchline.llm import queries, variants


def plain_words(rows, one_in=31, shortest=7, least=2):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(counts, lead=10):
    form, rows = {}, {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= lead * n else None
        rows[w] = (n, len(close))
    out = []
    for w, (n, count) in rows.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, count, counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


@pytest.fixture
def texts():
    rng = random.Random(11)
    syllables = ["the", "tion", "ent", "er", "é", "ö", "an", "st"]
    vocabulary = ["".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(40)]

    def word():
        w = rng.choice(vocabulary[:8] if rng.random() < 0.7 else vocabulary)
        if rng.random() < 0.15:
            k = rng.randrange(len(w))
            w = w[:k] + rng.choice(["", "a", "ÿ", "É"]) + w[k + rng.randint(0, 1) :]
        return w.title() if rng.random() < 0.1 else w

    rows = [(i, " ".join(word() for _ in range(60))) for i in range(80)]
    long_word = "abcdefgh" * 40
    rows += [(90, f"{long_word} {long_word}x {long_word} {long_word}x"), (91, "Ünder Ünder9999 x-y")]
    rows += [(k, "chained " * 30 + "chainedd " * (2 * (k % 2)) + "chaineddd " * (k == 100)) for k in range(100, 130)]
    rows += [(130, "chaineddd"), (131, "chaineddd")]
    rows += [(None, "singular singular"), (92, None), (93, ""), (93, ""), (94, "naïve" * 3000)]
    return rows + rows[:3]


def test_query_against_plain(spark, docs, texts, rows, tmp_path):
    docs(texts).write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op11_spelling_variants"](spark, str(tmp_path))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = plain(plain_words(texts))
    assert any(r[2] != r[0] and r[1] != r[2] for r in expected), "no chain in the fixture"
    assert rows(out) == expected


def test_common_halves_are_tiled(spark, rows):
    """Tiles of five words give what one block gives, each pair once."""
    rng = random.Random(3)
    counts = {"common" + "".join(rng.choices("abc", k=rng.randint(1, 4))): rng.randint(2, 90) for _ in range(90)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(variants.variants(table, tile=5)) == plain(counts)


def test_one_edit():
    assert variants.first_difference("abc", "abd") == 2
    assert variants.first_difference("abc", "abcd") == 3
    assert variants.first_difference("abc", "xabc") == 0
    assert [variants.first_difference(*p) for p in (("abc", "abc"), ("abc", "acb"), ("ab", "abcd"))] == [-1] * 3


def test_empty_table_and_clashing_columns(spark, docs, rows):
    assert rows(variants.variants(variants.words(docs([])))) == []
    named = docs([(1, "singular singulars singular singulars")]).selectExpr(
        "*", "1 AS word", "2 AS n", "3 AS run", "4 AS id", "5 AS key", "6 AS base", "7 AS form", "8 AS root"
    )
    assert rows(variants.variants(variants.words(named))) == [
        ("singular", None, "singular", 2, 1, None),
        ("singulars", None, "singulars", 2, 1, None),
    ]

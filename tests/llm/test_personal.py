"""Personal data: the base against plain patterns, the field on held-out spans."""

import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest

from touchline.llm import personal, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The contract's base, read off its patterns."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                twice = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def card(rng):
    digits = [4] + [rng.randrange(10) for _ in range(14)]
    total = sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits))
    return "".join(map(str, digits)) + str(-total % 10)


def entity(rng, kind):
    n = lambda k: "".join(rng.choices("123456789", k=k))
    return {
        "email": f"{rng.choice(['ann', 'bobby', 'cleo.x'])}.{n(2)}@mail{n(1)}.example.com",
        "ip": ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
        "card": card(rng),
        "phone": f"+1 ({n(3)}) 555-{n(4)}",
    }[kind]


def words(rng, k):
    pool = ["the", "was", "a", "größe", "end.", "in", "é", "x1", "24", "AKIA9QZ7", "v2.1", "12:30"]
    return " ".join(rng.choice(pool) for _ in range(k))


@pytest.fixture(scope="module")
def people():
    rng = random.Random(4)
    out = []
    for i in range(400):
        kind = personal.KINDS[i % 4]
        out.append((i, f"{words(rng, 8)} {entity(rng, kind)} {words(rng, 8)}"))
    return out + [(1000 + i, words(rng, 30)) for i in range(200)]


ODD = [
    None,
    "",
    "a@b.c@d.e x@y@z.com @a.b a@ a@b @@ ..@a.b",
    "1.2.3.4.5.6.7.8 1.2.3.256 0001.2.3.4 1.2.3 " + "9" * 5000 + ".1.2.3",
    "+1 (269) 555-3296 4532015112830366 and 4532 0151 1283 0366, 4532-0151-1283-0367",
    "+1 2 +12345678901234567890 +(123) +44 20 7946 0958.",
    "é" * 50 + "+1 (269) 555-3296" + "ü@x.de",
    "long " * 40000 + "192.168.0.1 " + "5" * 100000 + "@" * 1000,
]


def test_base_is_the_patterns():
    rng = random.Random(8)
    odd = [t for t in ODD if t is None or len(t) < 4000] + [ODD[3][:4000]]
    made = ["".join(rng.choices("1239.@+ -()ab%_\n", k=60)) for _ in range(3000)]
    made += [" ".join(entity(rng, rng.choice(personal.KINDS)) for _ in range(3)) for _ in range(200)]
    for text in odd + made:
        spans, _ = personal.base(text or "")
        assert personal._write(spans) == ",".join(plain(text)), text


def test_gradient_is_the_likelihoods_slope():
    sample = [("a +1 (222) 555-1234 4532015112830366 b", [("phone", 2, 19), ("card", 20, 36)]), ("v 1.2.3.4", [("ip", 2, 9)])]
    lattice = personal._Lattice(sample)
    rng = np.random.default_rng(1)
    w, f = rng.normal(0, 0.3, (len(lattice.number), 4)), rng.normal(0, 0.3, (5, 4))

    def likelihood(w, f):
        """By adding up every segmentation."""
        total = 0.0
        for text, labels in sample:
            cuts = personal.tokens(text, 0, len(text))
            field = personal.Field({name: w[k] for name, k in lattice.number.items()}, f)
            ranges = list(personal.candidates(text, cuts, []))
            every, gold = [], None
            stack = [(0, 0, 0.0, [])]
            while stack:
                t, state, s, taken = stack.pop()
                if t == len(cuts) - 1:
                    every.append(s)
                    if taken == sorted(labels, key=lambda x: x[1]):
                        gold = s
                    continue
                stack.append((t + 1, 0, s, taken))
                for (i, j), k in product(ranges, range(4)):
                    if i == t:
                        gain = field.score(text, cuts[i], cuts[j])[k] + f[state, k]
                        stack.append((j, k + 1, s + gain, taken + [(personal.KINDS[k], cuts[i], cuts[j])]))
            total += gold - np.logaddexp.reduce(every)
        return total / len(sample)

    up, next_ = lattice.gradient(w, f)
    for grad, x in ((up, w), (next_, f)):
        for at in [tuple(rng.integers(0, s) for s in x.shape) for _ in range(15)]:
            kept = x[at]
            x[at] = kept + 1e-5
            high = likelihood(w, f)
            x[at] = kept - 1e-5
            low = likelihood(w, f)
            x[at] = kept
            assert abs((high - low) / 2e-5 - grad[at]) < 1e-5


def test_field_adds_what_the_patterns_miss(spark, docs, people):
    field = personal.fit(docs(people))
    rng = random.Random(99)
    hit = wanted = 0
    for k in range(200):
        kind, kind2 = personal.KINDS[k % 4], rng.choice(personal.KINDS)
        first, second = entity(rng, kind), entity(rng, kind2)
        if k % 2:
            first, second = rng.choice(personal._rewritten(kind, first)), ""
        text = f"{words(rng, 6)} {first} {second} {words(rng, 6)}"
        a = text.index(first)
        expected = {(kind, a, a + len(first))}
        if second:
            b = text.index(second, a + len(first))
            expected.add((kind2, b, b + len(second)))
        spans, _ = personal.base(text)
        hit += len(expected & {*spans, *field.spans(text, spans)})
        wanted += len(expected)
    assert hit >= 0.9 * wanted, (hit, wanted)
    for _ in range(200):  # clean texts stay clean
        assert field.spans(words(rng, 60), []) == []


def test_query(spark, docs, people, tmp_path):
    texts = people + [(2000 + i, t) for i, t in enumerate(ODD)] + [(None, "x 1.2.3.4"), people[0]]
    docs(texts).selectExpr("*", "1 AS spans", "2 AS part", "3 AS labels").write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.QUERIES["op12_personal_data"](spark, str(tmp_path)).collect()
    assert len(out) == len(texts)
    by_id = {r["doc_id"]: r for r in out}
    for doc_id, text in texts:
        r, expected = by_id[doc_id], plain(text) if len(text or "") < 4000 else None
        if expected is not None:
            assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
            assert [r[f"n_{k}"] for k in PATTERNS] == [sum(e.startswith(k + ":") for e in expected) for k in PATTERNS]
            assert set(expected) <= set(filter(None, r["spans"].split(",")))
            assert len(expected) + r["n_added"] == len(list(filter(None, r["spans"].split(","))))
    joined = by_id[2004]["spans"].split(",")
    assert {"phone:0:17", "card:18:34"} <= set(joined)


def test_empty_and_unlabelled(spark, docs, rows):
    assert rows(personal.find(docs([]))) == []
    assert rows(personal.find(docs([(1, "nothing here"), (2, None)])), "doc_id", "spans", "n_added") == [(1, "", 0), (2, "", 0)]

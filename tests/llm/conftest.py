import random
import string

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark, tmp_path):
    """Write (doc_id, text[, source]) rows as a documents table and read it back."""
    made = []

    def make(rows, schema=DOC):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        path = str(tmp_path / f"docs-{len(made)}")
        made.append(path)
        spark.createDataFrame(full, schema).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def corpus():
    """Random texts with copies, near copies, shared passages, nulls, empty and long ones."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(300)]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" "] * 9 + ["\n", "  ", "\t"]) for _ in range(n))

    passage = text(60)
    base = [text(rng.choice([1, 4, 30, 120])) for _ in range(40)] + [text(9000)]
    near = [base[-1][:3000] + " changed " + base[-1][3000:], base[7] + " tail", "head " + base[9]]
    shared = [text(40) + passage + text(20), passage + text(30), text(10) + passage, "ab " * 90]
    rows = base + near + shared + base[:6] + [base[3]] * 25 + ["", "", None, None, " \n ", "Ü" * 500]
    rng.shuffle(rows)
    return [(i * 3, t, rng.choice(["a", "b", "é", None])) for i, t in enumerate(rows)]

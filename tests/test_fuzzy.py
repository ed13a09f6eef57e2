"""The fuzzy join against scoring every pair, with a plain scorer written from the definitions."""

import random

import pytest
from pyspark.sql import functions as F

from touchline.functions import name_scores
from touchline.functions.text import normalise_name
from touchline.operators.fuzzy import fuzzy_join


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    return 100.0 * 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial(a, b):
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0 if b else 100.0

    def windows(s, l):
        cuts = [l[:i] for i in range(1, len(s))] + [l[i : i + len(s)] for i in range(len(l))]
        return max(ratio(s, w) for w in cuts)

    return max(windows(a, b), windows(b, a)) if len(a) == len(b) else windows(a, b)


def token_sort(a, b, score=ratio):
    return score(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a, b):
    ta, tb = set(a.split()), set(b.split())
    both = " ".join(sorted(ta & tb))
    da, db = " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta))
    if both and (not da or not db):
        return 100.0
    fa, fb = f"{both} {da}".strip(), f"{both} {db}".strip()
    best = ratio(fa, fb) if not both else 100.0 * 2 * (len(both) + 1 + lcs(da, db)) / (len(fa) + len(fb))
    return max(best, ratio(both, fa), ratio(both, fb)) if both else best


def partial_token(a, b):
    ta, tb = set(a.split()), set(b.split())
    if ta & tb:
        return 100.0
    return max(token_sort(a, b, partial), partial(" ".join(sorted(ta)), " ".join(sorted(tb))))


def combined(a, b):
    if not a or not b:
        return 0.0
    r = max(len(a), len(b)) / min(len(a), len(b))
    if r < 1.5:
        return max(ratio(a, b), 0.95 * token_sort(a, b), 0.95 * token_set(a, b))
    p = 0.9 if r <= 8 else 0.6
    return max(ratio(a, b), p * partial(a, b), 0.95 * p * partial_token(a, b))


PARTS = "john smith maria de silva jon smyth van dijk virgil a b li lee o son kevin kev bruyne martin mart ab abc".split()


def random_name(rng):
    seps = [" ", "-", "  "]
    name = list(rng.choice(seps).join(rng.choice(PARTS) for _ in range(rng.choice([1, 1, 2, 2, 3, 4]))))
    for _ in range(rng.choice([0, 0, 1, 2])):
        at = rng.randrange(len(name) + 1)
        name[at : at + rng.randrange(2)] = rng.choice(["", "a", "e", "x", " "])
    return "".join(name)


def normalised(spark, names):
    df = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    return [r.n for r in df.orderBy("i").select(normalise_name(F.col("name")).alias("n")).collect()]


def test_scorer_follows_the_definitions():
    rng = random.Random(3)
    a = [random_name(rng).replace("-", " ").strip() for _ in range(400)]
    b = [random_name(rng).replace("-", " ").strip() for _ in range(400)]
    a += ["x" * 70 + " abc", "ab" * 50, "b b", ""]
    b += ["x" * 69 + " abd", "ba" * 20, "kevb smith", "b"]
    for x, y, got in zip(a, b, name_scores.combined(a, b)):
        assert got == pytest.approx(combined(x, y)), (x, y)


@pytest.mark.parametrize("threshold, seed", [(80, 1), (90, 2), (74, 3), (60, 4), (95, 5)])
def test_join_equals_scoring_every_pair(spark, threshold, seed):
    rng = random.Random(seed)
    asked = [random_name(rng) for _ in range(150)]
    masters = [random_name(rng) for _ in range(100)]
    left = spark.createDataFrame(list(enumerate(asked)), "i int, name string")
    right = spark.createDataFrame([(i, 1000 + i, n) for i, n in enumerate(masters)], "o int, player_id int, name string")
    found = fuzzy_join(left, right.repartition(3), "player_id", ["o"], threshold)
    got = {r.i: (r.player_id, r.match_name, r.score) for r in found.collect()}
    choices = normalised(spark, masters)
    for i, name in enumerate(normalised(spark, asked)):
        scores = [combined(name, c) for c in choices]
        best = max(range(len(scores)), key=lambda k: scores[k])
        score = round(scores[best])
        want = (1000 + best, masters[best], score) if score >= threshold else (None, None, None)
        assert got[i] == want, name


def test_first_of_equal_names_wins_and_empty_right_side_matches_nothing(spark, rows):
    left = spark.createDataFrame([("red widget",), (None,), ("...",)], "name string")
    right = spark.createDataFrame([(2, "red widget", 8), (1, "red widget", 7)], "o int, name string, id int")
    got = fuzzy_join(left, right, "id", ["o"], 90)
    assert rows(got, "name", "id", "score") == sorted([("red widget", 7, 100), (None, None, None), ("...", None, None)], key=repr)
    assert fuzzy_join(left, right.limit(0), "id", ["o"]).where("id IS NOT NULL").count() == 0


def test_threshold_is_inclusive_and_existing_ids_are_kept(spark, rows):
    # 85.5 rounds to 86
    left = spark.createDataFrame([("salah m", None), ("zzz", 5)], "name string, id int")
    right = spark.createDataFrame([(1, "mohamed salah hamed", 11)], "o int, name string, id int")
    assert rows(fuzzy_join(left, right, "id", ["o"], 86), "name", "id") == [("salah m", 11), ("zzz", 5)]
    assert rows(fuzzy_join(left, right, "id", ["o"], 87), "name", "id") == [("salah m", None), ("zzz", 5)]


def test_rows_outside_only_pass_through(spark, rows):
    left = spark.createDataFrame([("ann", 1), ("ann", None)], "name string, id int")
    right = spark.createDataFrame([(1, "ann", 9)], "o int, name string, id int")
    got = fuzzy_join(left, right, "id", ["o"], only=F.col("id").isNull())
    assert rows(got, "id", "score") == [(1, None), (9, 100)]


def test_a_token_everyone_shares(spark):
    """A third of all names hold one token; partners at the fixed score are not paired up."""
    left = spark.range(300).select(F.concat(F.lit("silva "), F.col("id").cast("string")).alias("name"))
    right = spark.range(300).select(
        F.concat(F.lit("joao pedro "), (F.col("id") + 5000).cast("string"), F.lit(" silva")).alias("name"),
        F.col("id").alias("player_id"),
    )
    got = fuzzy_join(left, right, "player_id", ["player_id"])
    assert got.where("score = 86 AND player_id = 0").count() == 300

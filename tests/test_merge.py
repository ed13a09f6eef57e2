"""Batches that are not small next to their table are merged with it, not sent through the driver."""

import contextlib
import io
import os

import pytest
from oracle import TESTDATA

import __spark_entry__ as contract
from touchline.sinks import writers
from touchline.sinks.planning import insert_absent
from touchline.sinks.writers import Unit

GAMES = "raw.understat_games"
SF_DIR = f"{TESTDATA}/sf0.001"


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def games(spark, ids):
    return spark.createDataFrame([(i, "2024-08-16 19:00:00", "H", "A") for i in ids], "understat_id int, date string, home string, away string")


@pytest.fixture
def plans(monkeypatch):
    """Plans of what units add."""
    seen, plain = [], writers.Unit._add

    def add(self, table, batch, new, *rest):
        seen.append(plan(new))
        return plain(self, table, batch, new, *rest)

    monkeypatch.setattr(writers.Unit, "_add", add)
    return seen


def store(wh, ids, name):
    with Unit(wh, name) as unit:
        return unit.insert_if_absent(GAMES, games(wh.spark, ids), ["home"]).inserted


def test_a_large_batch_is_not_broadcast(wh, plans):
    assert store(wh, range(40), "a") == 40
    assert store(wh, range(20, 60), "b") == 20
    assert store(wh, range(20, 60), "c") == 0
    assert "SortMergeJoin" in plans[1] and "Broadcast" not in plans[1] + plans[2]
    assert wh.rows(GAMES) == wh.read(GAMES).count() == 60


def test_a_small_batch_still_spares_the_table_a_shuffle(wh, plans):
    assert store(wh, range(200), "a") == 200
    assert store(wh, [5, 300, 300], "b") == 1
    assert "LeftSemi, BuildRight" in plans[1]


@pytest.mark.parametrize("merge", [False, True])
def test_both_ways_add_the_same(spark, rows, merge):
    batch = spark.createDataFrame([(1, "x", 2), (1, "x", 1), (2, "x", 1), (None, "x", 3), (None, "x", 3), (4, None, 1)], "a int, b string, o int")
    target = spark.createDataFrame([(2, "x"), (2, "x"), (None, "x"), (4, None), (9, "x")], "a int, b string")
    got = rows(insert_absent(batch, target, ["a", "b"], ["o"], merge))
    assert got == sorted([(1, "x", 1), (None, "x", 3), (None, "x", 3), (4, None, 1)], key=repr)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_a_replay_sorts_each_side_once(spark):
    made = plan(contract.queries()["sink_replay_idempotent"](spark, SF_DIR))
    assert "LeftSemi" not in made and "Broadcast" not in made

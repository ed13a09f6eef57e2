import pytest
from pyspark.sql import functions as F

from touchline.sinks import planning, writers

KEYS = ["id"]


def batch(spark, data):
    return spark.createDataFrame(data, "id int, v string, seq int")


def test_insert_if_absent(spark, rows):
    target = batch(spark, [(1, "old", 0)])
    new = batch(spark, [(1, "a", 1), (2, "b", 2), (2, "c", 3)])
    inserted, skipped = planning.returning(new, target, KEYS, ["seq"])
    assert rows(inserted) == [(2, "b", 2)]
    assert rows(skipped) == [(1, "a", 1, 1), (2, "c", 3, 1)]
    assert planning.metrics({"inserted": inserted, "total": new}).first() == (1, 3)


def test_empty_batch_counts_nothing(spark):
    none = batch(spark, [])
    counts = planning.metrics({"gi": planning.insert_absent(none, none, KEYS, ["seq"]), "gt": none})
    assert counts.first() == (0, 0)


def test_null_keys_conflict_with_nothing(spark, rows):
    target = batch(spark, [(None, "old", 0)])
    new = batch(spark, [(None, "a", 1), (None, "a", 1)])
    inserted, skipped = planning.returning(new, target, KEYS, ["seq"])
    assert rows(inserted) == [(None, "a", 1)] * 2
    assert rows(skipped) == []


def test_outcome_is_whole_on_hot_keys_and_copies(spark):
    """A third of the batch is one row, another third one key."""
    new = spark.range(900).select(
        F.when(F.col("id") < 600, 1).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit("v").alias("v"),
        F.when(F.col("id") < 300, 0).otherwise(F.col("id")).cast("int").alias("seq"),
    )
    target = batch(spark, [(700, "x", 0)])
    out = planning.insert_absent_outcome(new, target, KEYS, ["seq"])
    total = out.agg(F.sum("copies"), F.sum("inserted"), F.sum("skipped")).first()
    assert tuple(total) == (900, 300, 600)


def test_strict_violations(spark, rows):
    got = planning.strict_violations(
        batch(spark, [(1, "a", 1), (2, "b", 1), (2, "c", 1), (3, "d", 1)]), batch(spark, [(1, "x", 0)]), KEYS
    )
    assert rows(got) == [(1, 1, True), (2, 2, False)]


def games(spark, data):
    return spark.createDataFrame(data, "understat_id int, date string, home string, away string")


def players(spark, data):
    frame = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "understat_game_id int, name string, team string, pos int")
    numbers = ["minutes_played", "shots", "goals", "assists", "expected_goals", "expected_assists", "key_passes"]
    return frame.withColumns({c: F.lit(1) for c in numbers})


def test_pair_is_replay_safe(spark, wh, rows):
    g = games(spark, [(5, "2024-08-16 19:00:00", "H", "A"), (6, "2024-08-17 19:00:00", "H", "A")])
    p = players(spark, [(5, "Bo", "H"), (5, "Bo", "A"), (6, "Al", "A")])
    first = writers.write_pair(wh, g, p, "run-1", ["pos"])
    assert first == {"games_inserted": 2, "games_total": 2, "players_inserted": 2, "players_total": 3}
    again = writers.write_pair(wh, g, p, "run-2", ["pos"])
    assert (again["games_inserted"], again["players_inserted"]) == (0, 0)
    assert rows(wh.read("raw.understat_games"), "id", "understat_id", "is_processed") in (
        [(1, 5, False), (2, 6, False)], [(1, 6, False), (2, 5, False)]
    )
    assert rows(wh.read("raw.understat_player_games"), "name", "team", "run_id") == [("Al", "A", "run-1"), ("Bo", "H", "run-1")]


def test_empty_pair_writes_nothing(spark, wh):
    done = writers.write_pair(wh, games(spark, []), players(spark, []), "run-1", ["pos"])
    assert set(done.values()) == {0} and len(done) == 4
    assert wh.read("raw.understat_games").count() == 0


def test_one_batch_equals_many(spark, tmp_path, rows):
    from touchline.sources.tables import Warehouse

    g = [(i, "2024-08-16 19:00:00", f"H{i}", "A") for i in (1, 2, 2, 3, 4, 4)]
    whole, split = Warehouse(spark, str(tmp_path / "w")), Warehouse(spark, str(tmp_path / "s"))
    writers.insert_if_absent(whole, "raw.understat_games", games(spark, g), ["home"])
    for part in (g[:2], g[2:3], g[3:]):
        writers.insert_if_absent(split, "raw.understat_games", games(spark, part), ["home"])
    read = lambda wh: rows(wh.read("raw.understat_games"), "understat_id", "home")
    assert read(whole) == read(split)
    assert split.read("raw.understat_games").select("id").distinct().count() == 4


def test_strict_insert_is_all_or_nothing(spark, wh):
    df = spark.createDataFrame([("2024/25", 1, "x", 7)], "season string, fpl_team_id int, name string, team_id int")
    assert writers.insert_strict(wh, "staging.fpl_team_mapping", df) == 1
    more = df.union(df.withColumn("fpl_team_id", F.lit(2)))
    with pytest.raises(writers.DuplicateKey, match="2024/25"):
        writers.insert_strict(wh, "staging.fpl_team_mapping", more)
    assert wh.read("staging.fpl_team_mapping").count() == 1


def test_append_keeps_duplicates_and_numbers_rows(spark, wh):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    assert writers.append(wh, "analytics.teams", df) == 3
    assert writers.append(wh, "analytics.teams", df) == 3
    assert wh.read("analytics.teams").select("id").distinct().count() == 6
    assert writers.append(wh, "analytics.teams", df.limit(0)) == 0

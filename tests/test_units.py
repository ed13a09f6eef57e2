"""Units of writes: seen together or not at all, checked, numbered, and run again safely."""

import json

import pytest
from pyspark.sql import functions as F

from touchline.commits import Entry, WriteConflict
from touchline.plans import player_games
from touchline.sinks import writers
from touchline.sources import payloads
from touchline.sources.tables import Warehouse

NUMBERS = ["minutes_played", "shots", "goals", "assists", "expected_goals", "expected_assists", "key_passes"]


@pytest.fixture
def strict_wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"))


def games(spark, *ids):
    return spark.createDataFrame([(i, "2024-08-16 19:00:00", f"H{i}", "A") for i in ids], "understat_id int, date string, home string, away string")


def players(spark, *data):
    frame = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "understat_game_id int, name string, team string, pos int")
    return frame.withColumns({c: F.lit(1) for c in NUMBERS})


def test_a_run_cut_between_two_tables_shows_neither(spark, strict_wh, rows):
    wh = strict_wh
    writers.write_pair(wh, games(spark, 1), players(spark, (1, "Al", "A")), "run-1", ["pos"])

    class Cut(Exception):
        pass

    with pytest.raises(Cut):
        with writers.Unit(wh) as unit:
            unit.insert_if_absent("raw.understat_games", games(spark, 2), ["home"])
            raise Cut
    assert rows(wh.read("raw.understat_games"), "understat_id") == [(1,)]
    # the same run again stores both, and keeps the id that the dead run took unused
    writers.write_pair(wh, games(spark, 1, 2), players(spark, (2, "Bo", "A")), "run-2", ["pos"])
    assert rows(wh.read("raw.understat_games"), "id", "understat_id") == [(1, 1), (3, 2)]
    assert rows(wh.read("raw.understat_player_games"), "id", "name") == [(1, "Al"), (2, "Bo")]


def test_a_named_batch_is_written_once(spark, strict_wh):
    load = lambda: writers.write_pair(strict_wh, games(spark, 1), players(spark, (1, "Al", "A"), (1, "Bo", "A")), "r", ["pos"], "b#0")
    assert load() == {"games_inserted": 1, "games_total": 1, "players_inserted": 2, "players_total": 2}
    assert load()["players_inserted"] == 0
    with writers.Unit(strict_wh, "append") as unit:
        unit.append("analytics.teams", spark.createDataFrame([("x",)], "name string"))
    with writers.Unit(strict_wh, "append") as unit:
        assert unit.append("analytics.teams", spark.createDataFrame([("x",)], "name string")).inserted == 0
    assert strict_wh.read("analytics.teams").count() == 1


def test_a_commit_in_between_is_a_conflict(spark, strict_wh):
    with pytest.raises(WriteConflict, match="raw.understat_games"):
        with writers.Unit(strict_wh) as late:
            late.insert_if_absent("raw.understat_games", games(spark, 1), ["home"])
            writers.insert_if_absent(strict_wh, "raw.understat_games", games(spark, 1), ["home"])
    assert strict_wh.read("raw.understat_games").count() == 1
    with writers.Unit(strict_wh) as other:  # another table does not disturb
        other.append("analytics.teams", spark.createDataFrame([("x",)], "name string"))
        writers.insert_if_absent(strict_wh, "raw.understat_games", games(spark, 2), ["home"])
    assert strict_wh.read("analytics.teams").count() == 1


def test_a_second_warehouse_sees_the_log(spark, strict_wh):
    writers.insert_if_absent(strict_wh, "raw.understat_games", games(spark, 1), ["home"])
    again = Warehouse(spark, strict_wh.root)
    assert again.read("raw.understat_games").count() == 1
    assert not again.log._fs.exists(again.log._file(again.log.last() + 1))
    assert Entry.of(again.log.entries()[-1].text()) == again.log.entries()[-1]
    # as of an earlier entry
    assert again.read("raw.understat_games", upto=0).count() == 0


def test_inserted_and_skipped_rows_come_back(spark, strict_wh, rows):
    writers.insert_if_absent(strict_wh, "raw.understat_games", games(spark, 1), ["home"])
    batch = games(spark, 1, 2, 2, 3).withColumn("home", F.when(F.col("understat_id") == 2, F.lit("same")).otherwise("x"))
    with writers.Unit(strict_wh) as unit:
        out = unit.insert_if_absent("raw.understat_games", batch, ["home"])
    assert (out.inserted, out.total) == (2, 4)
    assert sorted(r.id for r in out.rows.collect()) == [2, 3]
    assert rows(out.rows, "understat_id") == [(2,), (3,)]
    assert rows(out.skipped, "understat_id", "home", "copies") == [(1, "x", 1), (2, "same", 1)]


def mapping(spark, *data):
    return spark.createDataFrame(data, "season string, fpl_team_id int, name string, team_id int")


def test_constraints_are_checked_before_anything_is_stored(spark, strict_wh, rows):
    wh = strict_wh
    writers.append(wh, "analytics.teams", spark.createDataFrame([("a",), ("b",)], "name string"))
    good = mapping(spark, ("2024/25", 1, "a", 1), ("2024/25", 2, "b", 2), ("2024/25", 3, "c", None))
    assert writers.insert_if_absent(wh, "staging.fpl_team_mapping", good, ["name"])["inserted"] == 3
    bad = mapping(spark, ("2025/26", 1, "a", 1), (None, 2, "b", 9), ("2025/26", None, None, 2), ("2025/26", 4, "d", 9))
    message = "foreign_key team_id in 2 rows; not_null fpl_team_id in 1 rows; not_null name in 1 rows; not_null season in 1 rows"
    for write in (writers.insert_if_absent, writers.append, writers.insert_strict):
        with pytest.raises(writers.ConstraintViolation, match=message):
            write(wh, "staging.fpl_team_mapping", bad, *([["name"]] if write is writers.insert_if_absent else []))
    assert wh.read("staging.fpl_team_mapping").count() == 3
    with writers.Unit(wh, lenient=True) as unit:
        out = unit.insert_if_absent("staging.fpl_team_mapping", bad, ["name"])
    assert (out.inserted, out.total) == (1, 4)
    assert rows(out.violations, "fpl_team_id", "violated") == [
        (2, ["not_null season", "foreign_key team_id"]), (4, ["foreign_key team_id"]), (None, ["not_null fpl_team_id", "not_null name"])
    ]
    assert wh.read("staging.fpl_team_mapping").count() == 4
    with writers.Unit(wh, lenient=True) as unit:
        assert unit.append("staging.fpl_team_mapping", bad.limit(0)).counts == {"inserted": 0, "total": 0}


def test_a_season_load_reads_one_partition_and_near_batches_only(spark, strict_wh):
    for season in ("2023/24", "2024/25"):
        rows = mapping(spark, (season, 1, "a", None))
        writers.insert_if_absent(strict_wh, "staging.fpl_team_mapping", rows, ["name"])
    one = strict_wh.read("staging.fpl_team_mapping").where("season = '2024/25'")
    assert one.count() == 1 and len(one.inputFiles()) == 2
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    near = strict_wh.read("staging.fpl_team_mapping", near=("season", "2024/25", "2024/25"))
    assert len(near.inputFiles()) == 1
    for k in range(3):
        writers.insert_if_absent(strict_wh, "raw.understat_games", games(spark, 10 * k, 10 * k + 1), ["home"])
    assert strict_wh.read("raw.understat_games", near=("understat_id", 9, 15)).count() == 2


def test_ids_are_dense_and_the_table_is_not_scanned(spark, strict_wh):
    frame = spark.range(1000).select(F.col("id").cast("string").alias("name")).repartition(7)
    for _ in range(2):
        writers.append(strict_wh, "analytics.teams", frame)
    got = strict_wh.read("analytics.teams").agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert tuple(got) == (1, 2000, 2000)
    assert strict_wh.log.next_id("analytics.teams") == 2001


PAYLOADS = [
    '{"history":[{"round":1},{"round":"2.0","expected_goals":"0.5"}]}',
    '{"history":"x"}',
    '{"history":[1,2]}',
    '{"history":{"a":1}}',
    '{"history":[{"round":3},7,null,{"round":4,"minutes":{"a":1}},{"round":"z"},{"round":5,"expected_goals":"abc"}]}',
    '{"history":[{"round":6},{"round":7',
    "{}", '{"history":null}', '{"history":[]}', "[]", "no", None,
    '{"history":[{"round":8,"kickoff_time":"yesterday"},{"round":8.5}]}',
]


def test_every_part_of_a_history_is_a_record_a_reject_or_missing(spark, rows):
    df = spark.createDataFrame(list(enumerate(PAYLOADS)), "player_id int, payload string")
    good, bad = payloads.histories_lenient(df)
    assert rows(good, "player_id", "round") == [(0, 1), (0, 2), (4, 3)]
    no_list, no_object = "payload has no history: it is no list", "payload has no history: it is no object"
    element = "element of history is no object"
    assert rows(bad, "player_id", "pos", "problem") == sorted(
        [
            (1, None, no_list), (2, 0, element), (2, 1, element), (3, None, no_list),
            (4, 1, element), (4, 2, element), (4, 3, 'minutes: {"a":1}'), (4, 4, "round: z"), (4, 5, "expected_goals: abc"),
            (5, None, no_object), (9, None, no_object), (10, None, no_object), (11, None, no_object),
            (12, 0, "kickoff_time: yesterday"), (12, 1, "round: 8.5"),
        ],
        key=repr,
    )
    assert rows(payloads.undecodable(df), "player_id") == [(i,) for i in (1, 10, 11, 3, 5, 9)]


MASTERS = [
    '{"elements":[{"id":1,"code":7,"first_name":"A"},{"id":"x","code":8},{"id":2.0,"code":"7.5"},{"id":3,"first_name":{"a":1}},5]}',
    '{"elements":{}}', "{}", "nothing",
]


def test_master_payloads_are_typed_or_rejected(spark, rows):
    df = spark.createDataFrame([(p,) for p in MASTERS], "payload string")
    good, bad = payloads.players_lenient(df)
    assert rows(good, "pos", "id", "code", "first_name") == [(0, 1, 7, "A")]
    lost = "payload has no elements: it is "
    assert rows(bad, "pos", "problem") == sorted(
        [
            (1, "id: x"), (2, "code: 7.5"), (3, 'first_name: {"a":1}'), (4, "element of elements is no object"),
            (None, lost + "no list"), (None, lost + "missing"), (None, lost + "no object"),
        ],
        key=repr,
    )
    for part in ('{"elements":[{"id":"x"}]}', '{"elements":[1]}'):
        with pytest.raises(Exception, match="not a whole number: x|is no object"):
            payloads.players(spark.createDataFrame([(part,)], "payload string")).collect()
    teams = spark.createDataFrame([('{"teams":[{"id":1,"name":"a"},{"id":"b"}]}',)], "payload string")
    good, bad = payloads.teams_lenient(teams)
    assert rows(good) == [(1, "a")] and rows(bad, "problem") == [("id: b",)]


def test_lenient_increment_stores_the_rest(spark, strict_wh, rows):
    wh = strict_wh
    writers.append(wh, "analytics.players", spark.createDataFrame([("A",)], "name string"))
    known = spark.createDataFrame([(1, "2024/25", k, "A", None) for k in (0,)], "player_id int, season string, fpl_seasonal_id int, name string, opta_id string")
    writers.insert_if_absent(wh, "staging.fpl_player_mapping", known, ["name"])
    elements = payloads.players(spark.createDataFrame([('{"elements":[{"id":0,"code":5,"team":3}]}',)], "payload string"))
    landed = spark.createDataFrame([(0, PAYLOADS[4])], "player_id int, payload string")
    import datetime as dt

    run = dt.date(2024, 9, 1)
    with pytest.raises(Exception, match="not a whole number"):
        player_games.add_player_games(wh, elements, landed, run, "run-1")
    assert wh.read("raw.fpl_player_games").count() == 0
    done = player_games.add_player_games(wh, elements, landed, run, "run-1", lenient=True)
    assert rows(wh.read("raw.fpl_player_games"), "gameweek", "opta_id") == [(3, "5")]
    assert sorted(r.problem for r in done["record_rejects"].collect()) == [
        "element of history is no object", "element of history is no object", "expected_goals: abc", 'minutes: {"a":1}', "round: z"
    ]

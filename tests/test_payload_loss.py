"""Nothing of a payload is lost without a word, and the first row of a payload wins."""

import json

import pytest
from pyspark.sql import functions as F

from touchline.plans import matches
from touchline.sinks.writers import write_pair
from touchline.sources import payloads


def test_history_numbers_are_strict_or_rejected(spark):
    records = [{"round": "5"}, {"round": 6, "minutes": "x"}, {"round": 7.0}, {"round": None}, {"round": 7.5}]
    df = spark.createDataFrame([(1, json.dumps({"history": records}))], "player_id int, payload string")
    good, bad = payloads.histories_lenient(df)
    assert sorted((r.round for r in good.collect()), key=str) == [5, 7, None]
    assert sorted(r.round for r in bad.collect()) == ["6", "7.5"]
    with pytest.raises(Exception, match="not a whole number"):
        payloads.histories(df).collect()


@pytest.mark.parametrize("text", ["no json", '{"elements": [', "[]", "{}", None])
def test_undecodable_master_payload_fails(spark, text):
    df = spark.createDataFrame([(text,)], "payload string")
    for read in (payloads.players, payloads.teams):
        with pytest.raises(Exception, match="payload has no"):
            read(df).collect()


def test_first_player_of_the_payload_is_stored(spark, tmp_path):
    from touchline.sources.tables import Warehouse

    def player(name, minutes):
        return {"player": name, "time": minutes, "shots": "0", "goals": "0", "assists": "0", "xG": "0", "xA": "0", "key_passes": "0"}

    rosters = {
        "h": {"9": player("Gabriel", "90"), "8": player("Dup", "88"), "1": player("Dup", "11")},
        "a": {"2": player("Gabriel", "45")},
    }
    info = F.struct(F.lit("Wolves").alias("team_h"), F.lit("Arsenal").alias("team_a"), F.lit("2024-08-16 19:00:00").alias("date"))
    ok = spark.createDataFrame([(1, json.dumps({"rosters": rosters}))], "understat_game_id int, api_json string").withColumn("info", info)
    wh = Warehouse(spark, str(tmp_path))
    write_pair(wh, matches.games(ok), matches.player_rows(ok), "run-1", ["side_no", "pos"])
    stored = wh.read("raw.understat_player_games").select("name", "team", "minutes_played").collect()
    assert sorted(map(tuple, stored)) == [("Dup", "Wolves", 88), ("Gabriel", "Wolves", 90)]

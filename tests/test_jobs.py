"""The jobs on hand-made payloads, against rows worked out by hand."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from touchline.plans import extract, matches, player_games, players, teams
from touchline.sinks import writers
from touchline.sources import payloads
from touchline.streaming.ingest import ingest_matches, landed_matches

RUN_DATE = dt.date(2024, 9, 1)

MASTER = {
    "elements": [
        {"id": 1, "first_name": "Bukayo", "second_name": "Saka", "code": 111, "element_type": 3, "team": 1, "extra": 0},
        {"id": 2, "first_name": "Martin", "second_name": "Odegaard", "code": 222, "element_type": 3, "team": 1},
        {"id": 3, "first_name": "Xqz", "second_name": "Vwk", "code": 333, "element_type": 1, "team": 2},
    ],
    "teams": [{"id": 1, "name": "Arsenal", "short_name": "ARS"}, {"id": 2, "name": "Man City"}, {"id": 3, "name": "Ipswich"}],
}


def docs(spark, *payload):
    return spark.createDataFrame([(json.dumps(p),) for p in payload], "payload string")


@pytest.fixture
def known(spark, wh):
    mapping = spark.createDataFrame(
        [(70, "2023/24", 9, "B. Saka", "111"), (71, "2023/24", 8, "Martin Ødegaard", None)],
        "player_id int, season string, fpl_seasonal_id int, name string, opta_id string",
    )
    writers.insert_if_absent(wh, "staging.fpl_player_mapping", mapping, ["player_id"])
    return wh


def test_players_resolve_by_id_then_name_then_review(spark, known, rows):
    elements = payloads.players(docs(spark, MASTER))
    done = players.add_players(known, elements, RUN_DATE)
    assert done == {"mapped": {"inserted": 2, "total": 2}, "for_review": {"inserted": 1, "total": 1}}
    new = known.read("staging.fpl_player_mapping").where("season = '2024/25'")
    assert rows(new, "player_id", "fpl_seasonal_id", "name", "opta_id") == [
        (70, 1, "Bukayo Saka", "111"), (71, 2, "Martin Odegaard", "222")
    ]
    review = known.read("raw.fpl_player_manual_review")
    assert rows(review, "name", "position", "is_processed") == [("Xqz Vwk", 1, False)]
    again = players.add_players(known, elements, RUN_DATE)
    assert (again["mapped"]["inserted"], again["for_review"]["inserted"]) == (0, 0)


def test_teams_resolve_and_new_ones_become_masters(spark, wh, rows):
    masters = spark.createDataFrame([("Manchester City",), ("Man City FC",)], "name string")
    writers.append_dense(wh, "analytics.teams", masters, ["name"])
    before = spark.createDataFrame([("2023/24", 3, "Arsenal", 50)], "season string, fpl_team_id int, name string, team_id int")
    writers.insert_if_absent(wh, "staging.fpl_team_mapping", before, ["name"])
    source = payloads.teams(docs(spark, MASTER))
    assert teams.add_teams(wh, source, RUN_DATE) == {"mapped": 2, "new_teams": 1}
    fc = wh.read("analytics.teams").where("name = 'Man City FC'").first().id
    new = wh.read("staging.fpl_team_mapping").where("season = '2024/25'")
    assert rows(new, "fpl_team_id", "name", "team_id") == [(1, "Arsenal", 50), (2, "Man City", fc)]
    assert rows(wh.read("analytics.teams"), "name") == [("Ipswich",), ("Man City FC",), ("Manchester City",)]
    assert wh.read("analytics.teams").agg(F.max("id")).first()[0] == 3
    with pytest.raises(writers.DuplicateKey):
        teams.add_teams(wh, source, RUN_DATE, strict=True)


def history(*rounds):
    return {
        "history": [
            {"round": r, "kickoff_time": "2024-08-16T19:00:00Z", "minutes": 90, "expected_goals": "0.25", "element": 1, "fixture": r}
            for r in rounds
        ]
    }


@pytest.mark.parametrize("natural_key", [False, True])
def test_player_games_after_the_mark(spark, known, rows, natural_key):
    elements = payloads.players(docs(spark, MASTER))
    players.add_players(known, elements, RUN_DATE)
    landed = spark.createDataFrame(
        [(1, json.dumps(history(1, 2))), (2, json.dumps({})), (3, "<html>"), (99, json.dumps(history(2)))],
        "player_id int, payload string",
    )
    load = lambda: player_games.add_player_games(known, elements, landed, RUN_DATE, "run-1", natural_key)
    done = load()
    assert done["inserted"] == 2
    assert rows(done["rejects"], "player_id") == [(3,)]
    stored = known.read("raw.fpl_player_games")
    assert rows(stored, "run_id", "season", "gameweek", "fpl_player_id", "opta_id", "fpl_team_id", "minutes_played", "expected_goals", "starts") == [
        ("run-1", "2024/25", 1, 1, "111", 1, 90, 0.25, None), ("run-1", "2024/25", 2, 1, "111", 1, 90, 0.25, None)
    ]
    assert stored.first().fpl_datetime == dt.datetime(2024, 8, 16, 19)
    # no game is marked as stored yet, so a plain load repeats its rows
    assert load()["inserted"] == (0 if natural_key else 2)


def test_the_last_master_row_of_an_id_counts(spark, rows):
    twice = {"elements": [{"id": 1, "code": 9, "team": 1}, {"id": 1, "code": 5, "team": 2}]}
    landed = spark.createDataFrame([(1, json.dumps(history(3)))], "player_id int, payload string")
    got = player_games.increment(
        landed, payloads.players(docs(spark, twice)), spark.createDataFrame([(1,)], "player_id int"), spark.createDataFrame([(2,)], "mark int")
    )
    assert rows(got, "opta_id", "fpl_team_id", "gameweek") == [("5", 2, 3)]


def page(info):
    text = json.dumps(info)
    for ch in '{}":':
        text = text.replace(ch, f"\\x{ord(ch):02X}")
    return f"<html><script>\nvar match_info\t= JSON.parse('{text}');</script></html>"


def player(name, minutes="90"):
    return {"player": name, "time": minutes, "shots": "1", "goals": "0", "assists": "2", "xG": "0.5", "xA": "0.1", "key_passes": "3"}


EPL = {"league": "EPL", "league_id": "1", "team_h": "Arsenal", "team_a": "Spurs", "date": "2024-08-16 19:00:00"}
ROSTER = {"rosters": {"h": {"1": player("Saka"), "2": player("Rice")}, "a": {"3": player("Son")}}}

# id, page status, page, roster status, roster
LANDED = [
    (1, 200, page(EPL), 200, json.dumps(ROSTER)),
    (2, 404, "", None, None),
    (3, 200, "<html></html>", None, None),
    (4, 200, page({**EPL, "league": "La liga", "league_id": "2"}), None, None),
    (5, 200, page(EPL), 404, ""),
    (6, 200, page(EPL), 200, json.dumps({"rosters": {"h": {"1": player("Rice")}, "a": []}})),
    (7, 200, page(EPL), 200, json.dumps({"other": 1})),
    (8, None, None, None, None),
]
COLUMNS = "understat_game_id int, page_status int, page_html string, api_status int, api_json string"


def landed(spark, data=LANDED):
    df = spark.createDataFrame(data, COLUMNS)
    return df.select("understat_game_id", "page_status", "page_html"), df.select("understat_game_id", "api_status", "api_json")


EXPECTED_PLAYERS = [(1, "Rice", "Arsenal"), (1, "Saka", "Arsenal"), (1, "Son", "Spurs"), (6, "Rice", "Arsenal")]


def test_matches_around_the_mark(spark, wh, rows):
    pages, rosters = landed(spark)
    done = matches.add_matches(wh, pages, rosters, "run-1")
    assert (done["games_inserted"], done["players_inserted"]) == (3, 4)
    assert rows(wh.read("raw.understat_player_games"), "understat_game_id", "name", "team") == EXPECTED_PLAYERS
    assert rows(wh.read("raw.understat_games"), "understat_id", "home", "away") == [(i, "Arsenal", "Spurs") for i in (1, 6, 7)]
    status = dict(rows(done["rejects"].where("understat_game_id BETWEEN 1 AND 8"), "understat_game_id", "status"))
    assert status == {
        2: "understat_404_error", 3: "missing_match_data", 4: "not_epl", 5: "api_404_error", 8: "understat_request_error"
    }
    report = {r.batch_id: (r.fetched, r.failed, r.players) for r in done["batches"].collect()}
    assert len(report) == 9 and report[3] == (3, 22, 4) and report[9] == (0, 1, 0)
    assert done["missing"].count() == 201 - 3
    again = matches.add_matches(wh, pages, rosters, "run-2")
    assert (again["games_inserted"], again["games_total"], again["players_inserted"]) == (0, 3, 0)


def test_bad_numbers_fail_or_are_set_aside(spark, rows):
    bad = {"rosters": {"h": {"1": player("Saka", "x"), "2": player("Rice")}, "a": []}}
    pages, rosters = landed(spark, [(1, 200, page(EPL), 200, json.dumps(bad))])
    ok = matches.classify(pages, rosters)
    good, rejects = matches.player_rows_lenient(ok)
    assert rows(good, "name", "minutes_played") == [("Rice", 90)]
    assert rows(rejects, "name", "minutes_played") == [("Saka", "x")]
    with pytest.raises(Exception, match="not a valid int: x"):
        matches.player_rows(ok).collect()


def test_match_stream_does_not_repeat(spark, wh, tmp_path, rows):
    folder, checkpoint = tmp_path / "landed", str(tmp_path / "checkpoint")
    folder.mkdir()

    def land(name, data):
        fields = [c.split()[0] for c in COLUMNS.split(", ")]
        (folder / name).write_text("\n".join(json.dumps(dict(zip(fields, row))) for row in data))

    def run():
        ingest_matches(wh, landed_matches(spark, str(folder), files_per_batch=1), "run-1", checkpoint)
        return rows(wh.read("raw.understat_player_games"), "understat_game_id", "name", "team")

    land("a.json", LANDED[:4])
    assert run() == EXPECTED_PLAYERS[:3]
    assert run() == EXPECTED_PLAYERS[:3]
    land("b.json", LANDED[4:])
    land("c.json", LANDED[:1])  # landed again: absorbed
    assert run() == EXPECTED_PLAYERS


def test_readers(spark, tmp_path, rows):
    (tmp_path / "master.json").write_text(json.dumps(MASTER, indent=1))
    from touchline.schemas import PLAYERS_PAYLOAD

    read = payloads.read_documents(spark, str(tmp_path / "master.json"), PLAYERS_PAYLOAD)
    assert rows(payloads.explode_array(read, F.col("elements")), "id", "code") == [(1, 111), (2, 222), (3, 333)]
    (tmp_path / "page.html").write_text(page(EPL))
    pages = payloads.with_match_info(payloads.read_pages(spark, str(tmp_path / "page.html")))
    assert json.loads(pages.first().info_text) == EPL
    (tmp_path / "lines.json").write_text('{"teams":[{"id":1,"name":"x"}]}\n{"teams":[]}\nnot json')
    from touchline.schemas import TEAMS_PAYLOAD

    lines = payloads.read_json_lines(spark, str(tmp_path / "lines.json"), TEAMS_PAYLOAD)
    assert rows(payloads.explode_array(lines, F.col("teams"))) == [(1, "x")]


def test_extract_runs_players_first(spark, known):
    elements = payloads.players(docs(spark, MASTER))
    histories = spark.createDataFrame([(1, json.dumps(history(1)))], "player_id int, payload string")
    pages, rosters = landed(spark)
    done = extract.run_extract(known, elements, histories, pages, rosters, RUN_DATE, "run-1")
    assert list(done) == ["players", "matches", "player_games"]
    assert done["player_games"]["inserted"] == 1

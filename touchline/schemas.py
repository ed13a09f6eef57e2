"""Declared schemas: landed payloads and the stored tables.

Nothing is inferred. A field missing from a payload becomes NULL because the
schema names it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


# --------------------------------------------------------------------------
# Payload shapes and field names of the landed documents.
# --------------------------------------------------------------------------

PLAYER_FIELDS = {
    "id": "int",
    "first_name": "string",
    "second_name": "string",
    "code": "bigint",
    "element_type": "int",
    "team": "int",
}
TEAM_FIELDS = {"id": "int", "name": "string"}


def _list_of(name: str, fields: dict[str, str]) -> str:
    return f"{name} array<struct<{', '.join(f'{f}:{ty}' for f, ty in fields.items())}>>"


PLAYERS_PAYLOAD = _list_of("elements", PLAYER_FIELDS)
TEAMS_PAYLOAD = _list_of("teams", TEAM_FIELDS)

# (payload field, payload type, stored column, stored type)
HISTORY_MAPPING: list[tuple[str, str, str, str]] = [
    ("round", "int", "gameweek", "int"),
    ("kickoff_time", "string", "fpl_datetime", "timestamp_ntz"),
    ("opponent_team", "int", "opponent_fpl_team_id", "int"),
    ("total_points", "int", "total_points", "int"),
    ("minutes", "int", "minutes_played", "int"),
    ("goals_scored", "int", "goals_scored", "int"),
    ("goals_conceded", "int", "goals_conceded", "int"),
    ("own_goals", "int", "own_goals", "int"),
    ("assists", "int", "assists", "int"),
    ("penalties_missed", "int", "penalties_missed", "int"),
    ("penalties_saved", "int", "penalties_saved", "int"),
    ("clean_sheets", "int", "clean_sheets", "int"),
    ("yellow_cards", "int", "yellow_cards", "int"),
    ("red_cards", "int", "red_cards", "int"),
    ("saves", "int", "saves", "int"),
    ("expected_assists", "string", "expected_assists", "double"),
    ("expected_goals", "string", "expected_goals", "double"),
    ("bonus", "int", "bonus_points", "int"),
    ("value", "int", "value", "int"),
    ("element", "int", "fpl_element", "int"),
    ("bps", "int", "bps", "int"),
    ("creativity", "string", "creativity", "double"),
    ("fixture", "int", "fixture", "int"),
    ("ict_index", "string", "ict_index", "double"),
    ("influence", "string", "influence", "double"),
    ("selected", "int", "selected", "int"),
    ("threat", "string", "threat", "double"),
    ("transfers_balance", "int", "transfers_balance", "int"),
    ("transfers_in", "int", "transfers_in", "int"),
    ("transfers_out", "int", "transfers_out", "int"),
    ("expected_goal_involvements", "string", "expected_goal_involvements", "double"),
    ("expected_goals_conceded", "string", "expected_goals_conceded", "double"),
    ("starts", "int", "starts", "int"),
]

HISTORY_FIELDS = {name: stored for name, _, _, stored in HISTORY_MAPPING}

MATCH_INFO = "league string, league_id string, team_h string, team_a string, date string"

# (roster field, stored column, stored type)
ROSTER_MAPPING: list[tuple[str, str, str]] = [
    ("player", "name", "string"),
    ("time", "minutes_played", "int"),
    ("shots", "shots", "int"),
    ("goals", "goals", "int"),
    ("assists", "assists", "int"),
    ("xG", "expected_goals", "double"),
    ("xA", "expected_assists", "double"),
    ("key_passes", "key_passes", "int"),
]

_ROSTER_PLAYER = ", ".join(f"{src}:string" for src, _, _ in ROSTER_MAPPING)

# The sides are read as text first: an empty side may arrive as ``[]``.
ROSTER_ENVELOPE = "rosters struct<h:string, a:string>"
ROSTER_SIDE = f"map<string, struct<{_ROSTER_PLAYER}>>"

MATCH_PAGE = "understat_game_id int, page_status int, page_html string"
ROSTER_PAGE = "understat_game_id int, api_status int, api_json string"


# --------------------------------------------------------------------------
# Stored tables, their keys, references and defaults.
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Table:
    """One stored table. ``!`` after a column type in ``columns`` marks NOT NULL."""

    name: str
    columns: str
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str], ...] = ()  # (column, referenced table)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """Business columns, without the surrogate ``id``; all nullable on read."""
        return T.StructType.fromDDL(self.columns.replace("!", ""))

    @property
    def stored_by(self) -> list[str]:
        """Columns whose values are folders of the table."""
        return [c for c in ("season",) if c in self.schema.names]

    @property
    def indexed(self) -> set[str]:
        """Columns whose range is kept per batch: the first of each key."""
        return {keys[0] for keys in self.unique} | {"understat_game_id", "fpl_player_id"}

    @property
    def not_null(self) -> list[str]:
        return [c.split()[0].strip("`") for c in self.columns.split(",") if c.strip().endswith("!")]


_TABLES = [
    Table(
        "analytics.players",
        "name string!, is_active boolean",
        defaults={"is_active": True},
    ),
    Table("analytics.teams", "name string!"),
    Table(
        "analytics.player_seasons",
        "player_id int!, season string!, position int",
        references=(("player_id", "analytics.players"),),
    ),
    Table(
        "analytics.player_teams",
        "player_id int!, team_id int!, start_date timestamp_ntz!, end_date timestamp_ntz",
    ),
    Table(
        "analytics.games",
        "short_date string!, gw int!, home_goals double!, home_expected_goals_understat double!,"
        " home_assists double!, home_expected_assists_understat double!, home_team_id int!,"
        " away_goals double!, away_expected_goals_understat double!, away_assists double!,"
        " away_expected_assists_understat double!, away_team_id int!, result double!,"
        " season string, fpl_datetime timestamp_ntz, understat_datetime timestamp_ntz",
        references=(("home_team_id", "analytics.teams"), ("away_team_id", "analytics.teams")),
    ),
    Table(
        "analytics.player_games",
        "fpl_element int!, local_understat_id double, fpl_price int!, points int!,"
        " minutes_played int!, goals_scored int!, expected_goals_understat double!,"
        " goals_conceded int!, assists int!, expected_assists_understat double!,"
        " yellow_cards int!, red_card int!, clean_sheet int!, key_passes int, own_goals int!,"
        " penalties_missed int!, penalties_saved int!, saves int!, bonus_points int!,"
        " expected_assists_fpl double, expected_goals_fpl double, player_id int, game_id int",
    ),
    Table(
        "raw.fpl_player_games",
        "run_id string!, season string!, gameweek int!, fpl_datetime timestamp_ntz,"
        " fpl_player_id int!, opta_id string, fpl_team_id int!, "
        + ", ".join(f"{col} {ty}" for _, _, col, ty in HISTORY_MAPPING[2:]),
    ),
    Table(
        "raw.fpl_player_manual_review",
        "name string!, season string!, fpl_seasonal_id int, opta_id string, position int,"
        " is_processed boolean",
        unique=(("name", "season"),),
        defaults={"is_processed": False},
    ),
    Table(
        "raw.understat_games",
        "understat_id int!, date timestamp_ntz!, home string!, away string!, is_processed boolean",
        unique=(("understat_id",),),
        defaults={"is_processed": False},
    ),
    Table(
        "raw.understat_player_games",
        "name string!, understat_game_id int!, team string!, minutes_played int!, shots int!,"
        " goals int!, assists int!, expected_goals double!, expected_assists double!,"
        " key_passes int!, run_id string",
        unique=(("name", "understat_game_id"),),
    ),
    Table(
        "staging.fpl_player_mapping",
        "player_id int!, season string!, fpl_seasonal_id int, name string, opta_id string",
        unique=(("player_id", "season"),),
        references=(("player_id", "analytics.players"),),
    ),
    Table(
        "staging.fpl_team_mapping",
        "season string!, fpl_team_id int!, name string!, team_id int",
        unique=(("season", "fpl_team_id"),),
        references=(("team_id", "analytics.teams"),),
    ),
    Table(
        "staging.understat_game_mapping",
        "understat_game_id int!, game_id int!",
        unique=(("understat_game_id",),),
        references=(("game_id", "analytics.games"),),
    ),
    Table(
        "staging.understat_player_mapping",
        "name string!, player_id int!",
        unique=(("name",),),
        references=(("player_id", "analytics.players"),),
    ),
    Table(
        "staging.understat_team_mapping",
        "name string!, team_id int",
        unique=(("name",),),
        references=(("team_id", "analytics.teams"),),
    ),
]

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}

# Natural key of raw.fpl_player_games. The table declares none; this one is opt-in.
PLAYER_GAMES_NATURAL_KEY = ["season", "gameweek", "fpl_player_id", "fixture"]

# Ids scanned around the mark, ids per chunk, fuzzy thresholds.
LOOK_BACK = 50
LOOK_AHEAD = 150
CHUNK_SIZE = 25
PLAYER_THRESHOLD = 80
TEAM_THRESHOLD = 90

"""The extract run: players first, then matches and player games."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from touchline.plans.matches import add_matches
from touchline.plans.player_games import add_player_games
from touchline.plans.players import add_players
from touchline.sources.tables import Warehouse


def run_extract(
    wh: Warehouse,
    elements: DataFrame,
    histories: DataFrame,
    pages: DataFrame,
    rosters: DataFrame,
    run_date: date,
    run_id: str,
) -> dict[str, dict]:
    """Teams are a run of their own (``teams.add_teams``)."""
    return {
        "players": add_players(wh, elements, run_date),
        "matches": add_matches(wh, pages, rosters, run_id),
        "player_games": add_player_games(wh, elements, histories, run_date, run_id),
    }

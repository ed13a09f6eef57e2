"""Resolve source teams to master teams; teams nobody knows become master teams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from touchline.functions.text import season_label
from touchline.operators.filters import split_matched
from touchline.operators.fuzzy import fuzzy_join
from touchline.operators.joins import left_by_name
from touchline.operators.project import prune, rename
from touchline.schemas import TEAM_THRESHOLD
from touchline.sinks.writers import Unit, stage
from touchline.sources.tables import Warehouse


def source_teams(teams: DataFrame) -> DataFrame:
    """``fpl_team_id`` and ``name`` of the payload's teams."""
    return rename(prune(teams, ["id", "name"]), {"id": "fpl_team_id"})


def resolve(
    source: DataFrame,
    mapped: DataFrame,
    masters: DataFrame,
    order: list[str],
    threshold: float = TEAM_THRESHOLD,
) -> DataFrame:
    """Source teams with ``team_id``: the id mapped to the name before, else the best master name."""
    by_name = left_by_name(source, mapped.select("name", "team_id"), "name")
    masters = masters.withColumn("team_id", F.col("id"))
    return fuzzy_join(
        by_name, masters, "team_id", order, threshold, only=F.col("team_id").isNull()
    )


def add_teams(
    wh: Warehouse, teams: DataFrame, run_date: date, strict: bool = False, batch: str | None = None
) -> dict[str, int]:
    """Resolve and store one team payload; mappings and new teams are written in one commit.

    ``strict`` refuses a batch holding a (season, team) that is stored already.
    """
    found = resolve(
        source_teams(teams), wh.read("staging.fpl_team_mapping"), wh.read("analytics.teams"), ["id"]
    ).withColumn("season", season_label(F.lit(run_date)))
    resolved, _ = stage(found, "teams")
    matched, unmatched = split_matched(resolved, "team_id")
    with Unit(wh, batch) as unit:
        if strict:
            mapped = unit.insert_strict("staging.fpl_team_mapping", matched)
        else:
            mapped = unit.insert_if_absent("staging.fpl_team_mapping", matched, ["team_id", "name"])
        new = unit.append("analytics.teams", unmatched)
    return {"mapped": mapped.inserted, "new_teams": new.inserted}

"""Resolve source players to master players: by id, then by name, then for review."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from touchline.functions.casting import text_key
from touchline.functions.text import full_name, season_label
from touchline.operators.filters import split_matched
from touchline.operators.fuzzy import fuzzy_join
from touchline.operators.joins import lookup_first
from touchline.schemas import PLAYER_THRESHOLD
from touchline.sinks.writers import Unit, stage
from touchline.sources.tables import Warehouse


def source_players(elements: DataFrame, run_date: date) -> DataFrame:
    """Rows of the master payload under stored names, with the season of the run date."""
    return elements.select(
        season_label(F.lit(run_date)).alias("season"),
        F.col("id").alias("fpl_seasonal_id"),
        full_name(F.col("first_name"), F.col("second_name")).alias("name"),
        text_key(F.col("code")).alias("opta_id"),
        F.col("element_type").alias("position"),
        F.col("pos"),
    )


def resolve(
    source: DataFrame, known: DataFrame, order: list[str], threshold: float = PLAYER_THRESHOLD
) -> DataFrame:
    """Source rows with ``player_id``, ``match_name``, ``score`` and ``match_step``.

    Step 1 is a match by source id, step 2 one by name; a NULL ``player_id`` means neither.
    ``known`` has player_id, name and opta_id; ``order`` says which of several known
    rows counts as first.
    """
    by_id = lookup_first(
        source, known.select("opta_id", "player_id", *order), "opta_id", order
    ).drop(*[c for c in order if c not in source.columns])
    flagged = by_id.withColumn("match_step", F.when(F.col("player_id").isNotNull(), 1).otherwise(2))
    return fuzzy_join(
        flagged, known, "player_id", order, threshold, only=F.col("player_id").isNull()
    )


def add_players(
    wh: Warehouse, elements: DataFrame, run_date: date, batch: str | None = None
) -> dict[str, dict[str, int]]:
    """Resolve and store one master payload; both tables are written in one commit."""
    source, _ = stage(source_players(elements, run_date), "players")
    resolved, _ = stage(resolve(source, wh.read("staging.fpl_player_mapping"), ["id"]), "resolved")
    matched, unmatched = split_matched(resolved, "player_id")
    with Unit(wh, batch) as unit:
        mapped = unit.insert_if_absent("staging.fpl_player_mapping", matched, ["match_step", "pos"])
        review = unit.insert_if_absent("raw.fpl_player_manual_review", unmatched, ["pos"])
    return {"mapped": mapped.counts, "for_review": review.counts}

"""Ingest the matches around the last stored match id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.functions.casting import lenient, strict
from touchline.functions.status import fetch_status
from touchline.functions.text import match_info
from touchline.operators.filters import split_status
from touchline.operators.joins import anti, gaps, semi, side_team
from touchline.operators.marks import batch_counts, batch_id, candidate_ids, union_max
from touchline.schemas import CHUNK_SIZE, LOOK_AHEAD, LOOK_BACK, ROSTER_MAPPING
from touchline.sinks.writers import Unit, add_pair, stage
from touchline.sources.payloads import explode_rosters, with_match_info
from touchline.sources.tables import Warehouse

KEY = "understat_game_id"


def classify(pages: DataFrame, rosters: DataFrame, keep: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Join pages to rosters on the match id and add ``info`` and ``status``.

    An id without a landed response counts as a failed request.
    """
    joined = with_match_info(pages).join(rosters.select(KEY, "api_status", "api_json"), KEY, "left")
    parsed = joined.withColumn("info", match_info(F.col("info_text")))
    status = fetch_status(
        F.col("page_status"), F.col("info"), F.col("api_status"), F.col("api_json")
    )
    return parsed.select(*keep, "info", "api_json", status.alias("status"))


def games(ok: DataFrame) -> DataFrame:
    """Stored columns of the accepted matches."""
    return ok.select(
        F.col(KEY).alias("understat_id"),
        F.col("info.date").cast("timestamp_ntz").alias("date"),
        F.col("info.team_h").alias("home"),
        F.col("info.team_a").alias("away"),
    )


def roster_rows(ok: DataFrame) -> DataFrame:
    """One row per player of the accepted matches, fields as text, team from the side."""
    flat = ok.select(
        KEY, F.col("info.team_h").alias("home"), F.col("info.team_a").alias("away"), "api_json"
    )
    return explode_rosters(flat, "api_json", (KEY, "home", "away")).select(
        KEY,
        side_team(F.col("side"), F.col("home"), F.col("away")).alias("team"),
        "side_no",
        "pos",
        *[F.col(src).alias(dst) for src, dst, _ in ROSTER_MAPPING],
    )


def player_rows(ok: DataFrame) -> DataFrame:
    """Stored columns of the players; a bad or missing number fails the job."""
    numbers = {dst: strict(F.col(dst), ty) for _, dst, ty in ROSTER_MAPPING if ty != "string"}
    return roster_rows(ok).withColumns(numbers)


def player_rows_lenient(ok: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored columns of the players, players with a bad or missing number as text)."""
    return lenient(roster_rows(ok), {dst: ty for _, dst, ty in ROSTER_MAPPING if ty != "string"})


def chunked(ids: DataFrame, mark: DataFrame) -> DataFrame:
    """Candidate ids with their chunk number."""
    first = mark.scalar() - LOOK_BACK
    return ids.withColumn("batch_id", batch_id(F.col(KEY), first, CHUNK_SIZE))


def last_match(wh: Warehouse) -> DataFrame:
    """Highest match id stored or mapped."""
    return union_max(
        [
            (wh.read("staging.understat_game_mapping"), KEY),
            (wh.read("raw.understat_games"), "understat_id"),
        ]
    )


def attempt(pages: DataFrame, rosters: DataFrame, mark: DataFrame) -> DataFrame:
    """Every candidate id around the mark with ``batch_id``, ``info`` and ``status``.

    The landed tables are cut to the candidate range before they are joined.
    """
    ids = chunked(candidate_ids(mark, name=KEY), mark)
    near = F.col(KEY).between(mark.scalar() - LOOK_BACK, mark.scalar() + LOOK_AHEAD)
    landed = ids.join(pages.where(near), KEY, "left")
    return classify(landed, rosters.where(near), (KEY, "batch_id"))


def set_aside(ok: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted matches, matches with a player whose numbers cannot be read).

    A match is stored with all its players or not at all.
    """
    bad = player_rows_lenient(ok)[1].select(KEY).distinct()
    return anti(ok, bad, [KEY]), semi(ok, bad, [KEY])


def add_matches(
    wh: Warehouse,
    pages: DataFrame,
    rosters: DataFrame,
    run_id: str,
    lenient: bool = False,
    batch: str | None = None,
) -> dict[str, object]:
    """Store the accepted matches around the mark and report on all candidates.

    A player's number that cannot be read fails the job; with ``lenient`` that match alone
    is set aside, as ``bad_number`` among the rejects.
    """
    attempted, _ = stage(attempt(pages, rosters, last_match(wh)), "matches")
    ok, failed = split_status(attempted)
    failed = failed.select(KEY, "batch_id", "status")
    if lenient:
        ok, bad = set_aside(ok)
        failed = failed.union(bad.select(KEY, "batch_id", F.lit("bad_number").alias("status")))
        ok, _ = stage(ok, "accepted")
    players, _ = stage(player_rows(ok), "match-players")
    with Unit(wh, batch, lenient) as unit:
        written = add_pair(unit, games(ok), players, run_id, ["side_no", "pos"])
    per_match = players.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_players"))
    judged = ok.select(KEY, "batch_id", "status").union(failed)
    report = batch_counts(judged.join(per_match, KEY, "left"), players="n_players")
    return {
        **{f"{name}_{k}": v for name, out in written.items() for k, v in out.counts.items()},
        "batches": report,
        "rejects": failed,
        "missing": gaps(attempted.select(KEY), ok.select(KEY), KEY),
    }

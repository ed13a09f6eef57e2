"""Ingest the player games later than the last stored gameweek."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.casting import mistyped, try_typed
from touchline.functions.text import season_label
from touchline.operators.dedupe import first_per_key
from touchline.operators.joins import anti, join_unique, semi
from touchline.operators.marks import filtered_max
from touchline.operators.project import mapped, stamp_run_id
from touchline.schemas import HISTORY_FIELDS, HISTORY_MAPPING, PLAYER_GAMES_NATURAL_KEY
from touchline.sinks.writers import Unit, stage
from touchline.sources.payloads import field_problem, history_records, undecodable
from touchline.sources.tables import Warehouse, param_union

TABLE = "raw.fpl_player_games"
STORED_MAPPING = [(src, dst, ty) for src, _, dst, ty in HISTORY_MAPPING]


def new_records(payloads: DataFrame, ids: DataFrame, mark: DataFrame) -> DataFrame:
    """History records of the known players past the mark, as text, and whatever cannot be read.

    The semi join runs on the unopened payloads, and records are cut to those past the mark
    before any other field is cast. A round that is no number is kept: it has a problem.
    """
    records = history_records(semi(payloads, ids, ["player_id"]))
    number = try_typed(F.col("round"), "int")
    return records.where(F.col("problem").isNotNull() | mistyped(F.col("round"), "int") | (number > mark.scalar()))


def with_master(records: DataFrame, elements: DataFrame, strictly: bool = True) -> DataFrame:
    """Text records mapped to stored columns, with their player's master row.

    Of master rows sharing an id the last by ``pos`` counts.
    """
    meta = first_per_key(
        elements.select(
            F.col("id").alias("player_id"),
            F.col("code").cast("string").alias("opta_id"),
            F.col("team").alias("fpl_team_id"),
            F.col("pos"),
        ),
        ["player_id"],
        [F.col("pos").desc()],
    ).drop("pos")
    columns = mapped(STORED_MAPPING, strictly)
    return join_unique(records, meta, ["player_id"], "left").select(
        F.col("player_id").alias("fpl_player_id"), "opta_id", "fpl_team_id", *columns
    )


def increment(payloads: DataFrame, elements: DataFrame, ids: DataFrame, mark: DataFrame) -> DataFrame:
    """New history records of the known players, mapped to stored columns.

    ``payloads`` is ``(player_id, payload)``, ``ids`` the known player ids, ``mark`` the
    last stored gameweek. A malformed value of a new record fails the job.
    """
    records = new_records(payloads, ids, mark).where("problem IS NULL")
    return with_master(records, elements)


def increment_lenient(
    payloads: DataFrame, elements: DataFrame, ids: DataFrame, mark: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(new rows, what cannot be read: player_id, pos, problem). Payloads are opened once."""
    records = new_records(payloads, ids, mark)
    records = records.withColumn("problem", F.coalesce("problem", field_problem(HISTORY_FIELDS)))
    staged, _ = stage(records, "records")
    good = with_master(staged.where("problem IS NULL"), elements, strictly=False)
    return good, staged.where("problem IS NOT NULL").select("player_id", "pos", "problem")


def known_ids(wh: Warehouse, season: Column) -> DataFrame:
    """Ids of the season's players, mapped or waiting for review."""
    sources = [
        (wh.read("staging.fpl_player_mapping"), "season", "fpl_seasonal_id"),
        (wh.read("raw.fpl_player_manual_review"), "season", "fpl_seasonal_id"),
    ]
    return param_union(sources, season, "player_id")


def add_player_games(
    wh: Warehouse,
    elements: DataFrame,
    payloads: DataFrame,
    run_date: date,
    run_id: str,
    natural_key: bool = False,
    lenient: bool = False,
    batch: str | None = None,
) -> dict[str, object]:
    """Store the new player games of a season.

    The table has no unique key, so rows are appended as they are; ``natural_key``
    makes the load repeatable instead, and so does a name for the ``batch``. Unreadable payloads
    come back as ``rejects``, known ids without a payload as ``missing``. A malformed value
    fails the job, and so does a row that breaks a constraint; with ``lenient`` such records
    come back as ``record_rejects`` and ``violations``.
    """
    season = season_label(F.lit(run_date))
    games = wh.read("analytics.games")
    mark = filtered_max(games, F.col("season") == season, "gw")
    known = known_ids(wh, season)
    rejected = None
    if lenient:
        rows, rejected = increment_lenient(payloads, elements, known, mark)
    else:
        rows = increment(payloads, elements, known, mark)
    rows = stamp_run_id(rows.withColumn("season", season), run_id)
    with Unit(wh, batch, lenient) as unit:
        if natural_key:
            out = unit.insert_if_absent(TABLE, rows, ["fpl_datetime"], PLAYER_GAMES_NATURAL_KEY)
        else:
            out = unit.append(TABLE, rows)
    done: dict[str, object] = dict(out.counts)
    done["rejects"] = undecodable(payloads)
    done["missing"] = anti(known, payloads, ["player_id"])
    if lenient:
        done["record_rejects"] = rejected
        done["violations"] = out.violations
    return done

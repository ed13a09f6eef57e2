"""Landed payloads: JSON documents, HTML pages and rosters, read with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.functions.casting import mistyped, try_typed, typed
from touchline.functions.text import match_info_text
from touchline.schemas import HISTORY_FIELDS, PLAYER_FIELDS, ROSTER_ENVELOPE, ROSTER_SIDE, TEAM_FIELDS

HISTORY_WHOLE = {c: ty for c, ty in HISTORY_FIELDS.items() if ty == "int"}


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files of one document each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files of one document per line; large files split over tasks."""
    return spark.read.schema(schema).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """HTML files, one row per file: ``(path, page_html)``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("page_html"))


def explode_positions(df: DataFrame, array: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per array element with its place as ``pos``; a missing array gives no rows.

    An inner explode makes the optimizer filter on the array's size first, which parses
    the payload a second time. The outer one does not; its empty rows are dropped after.
    """
    exploded = df.select(*keep, F.posexplode_outer(array).alias("pos", "_e"))
    return exploded.where("pos IS NOT NULL").select(*keep, "pos", "_e.*")


def explode_array(df: DataFrame, array: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per array element, its fields as columns; a missing array gives no rows."""
    return explode_positions(df, array, keep).drop("pos")


def decoded(
    df: DataFrame,
    name: str,
    fields: Mapping[str, str],
    keep: tuple[str, ...] = (),
    column: str = "payload",
    required: bool = False,
) -> DataFrame:
    """One row per element of a payload's list ``name``: ``pos``, its fields as text, ``problem``.

    Nothing is lost without a word. A payload that is no object, or whose list is something
    else, is one row with a ``problem`` and no ``pos``; so is an element that is no object, with
    its ``pos``. A payload without the list gives no rows, unless it is ``required``.

    Fields are read as text, whatever they hold, so that a malformed one is seen. One
    element that is no object makes the reader give up the whole list; only such payloads
    are opened again as variants, element by element.
    """
    shape = ", ".join(f"`{f}`:string" for f in fields)
    record = f"struct<{shape}>"
    opened = F.try_parse_json(column)
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    one_by_one = F.transform(
        F.try_variant_get(opened, f"$.{name}", "array<variant>"),
        lambda e: F.when(is_object(e), F.from_json(F.to_json(e), record)),
    )
    found = F.coalesce(F.from_json(column, f"{name} array<{record}>")[name], one_by_one)
    there = F.schema_of_variant(F.try_variant_get(opened, f"$.{name}", "variant"))
    lost = f"payload has no {name}"
    problem = (
        F.when(F.json_object_keys(column).isNull(), f"{lost}: it is no object")
        .when(there.isNotNull() & (there != "VOID"), f"{lost}: it is no list")
        .when(F.lit(required), f"{lost}: it is missing")
    )
    lists = df.select(*keep, column, found.alias("_list"))
    lists = lists.withColumn("_problem", F.when(F.col("_list").isNull(), problem))
    rows = lists.select(*keep, "_problem", F.posexplode_outer("_list").alias("pos", "_e"))
    no_record = F.when(F.col("pos").isNotNull() & F.col("_e").isNull(), f"element of {name} is no object")
    rows = rows.withColumn("problem", F.coalesce("_problem", no_record))
    return rows.where("pos IS NOT NULL OR problem IS NOT NULL").select(*keep, "pos", "_e.*", "problem")


def field_problem(fields: Mapping[str, str]) -> Column:
    """The first field of a text record that is no value of its type, as ``field: text``."""
    wrong = [F.when(mistyped(F.col(c), ty), F.concat(F.lit(f"{c}: "), F.col(c))) for c, ty in fields.items()]
    return F.coalesce(*wrong)


def _whole(rows: DataFrame) -> DataFrame:
    """Fail the job on a row with a problem. A filter, so no projection can drop the check."""
    return rows.where(F.when(F.col("problem").isNull(), True).otherwise(F.raise_error(F.col("problem")).cast("boolean")))


def _split(rows: DataFrame, fields: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rows with a problem as text)."""
    rows = rows.withColumn("problem", F.coalesce("problem", field_problem(fields)))
    good = rows.where("problem IS NULL").drop("problem")
    return good.withColumns({c: try_typed(F.col(c), ty) for c, ty in fields.items()}), rows.where("problem IS NOT NULL")


def players(df: DataFrame, column: str = "payload") -> DataFrame:
    """Master players: pos, id, first_name, second_name, code, element_type, team.

    A payload or a number that cannot be read fails the job.
    """
    rows = _whole(decoded(df, "elements", PLAYER_FIELDS, column=column, required=True)).drop("problem")
    return rows.withColumns({c: typed(F.col(c), ty) for c, ty in PLAYER_FIELDS.items()})


def players_lenient(df: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(players, payloads and elements that cannot be read, with their ``problem``)."""
    return _split(decoded(df, "elements", PLAYER_FIELDS, column=column, required=True), PLAYER_FIELDS)


def teams(df: DataFrame, column: str = "payload") -> DataFrame:
    """Master teams: id, name. What cannot be read fails the job."""
    rows = _whole(decoded(df, "teams", TEAM_FIELDS, column=column, required=True)).drop("problem", "pos")
    return rows.withColumns({c: typed(F.col(c), ty) for c, ty in TEAM_FIELDS.items()})


def teams_lenient(df: DataFrame, column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(teams, payloads and elements that cannot be read, with their ``problem``)."""
    good, bad = _split(decoded(df, "teams", TEAM_FIELDS, column=column, required=True), TEAM_FIELDS)
    return good.drop("pos"), bad


def history_records(df: DataFrame, key: str = "player_id", column: str = "payload") -> DataFrame:
    """History records of each player as text, and what is none, by ``problem``."""
    return decoded(df, "history", HISTORY_FIELDS, (key,), column)


def histories(df: DataFrame, key: str = "player_id", column: str = "payload") -> DataFrame:
    """One row per history record of each player; a malformed value fails the job.

    Payloads and elements that are no record are left to ``histories_lenient`` and ``undecodable``.
    """
    rows = history_records(df, key, column).where("problem IS NULL").drop("problem", "pos")
    return rows.withColumns({c: typed(F.col(c), ty) for c, ty in HISTORY_WHOLE.items()})


def histories_lenient(df: DataFrame, key: str = "player_id", column: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(records as of ``histories``, payloads and records that cannot be read, with their ``problem``)."""
    rows = history_records(df, key, column)
    rows = rows.withColumn("problem", F.coalesce("problem", field_problem(HISTORY_FIELDS)))
    good = rows.where("problem IS NULL").drop("problem", "pos")
    return good.withColumns({c: try_typed(F.col(c), ty) for c, ty in HISTORY_WHOLE.items()}), rows.where("problem IS NOT NULL")


def undecodable(df: DataFrame, column: str = "payload", name: str = "history") -> DataFrame:
    """Rows whose payload is no JSON object, or whose list is none, kept as rejects."""
    there = F.schema_of_variant(F.try_variant_get(F.try_parse_json(column), f"$.{name}", "variant"))
    no_list = there.isNotNull() & (there != "VOID") & ~there.startswith("ARRAY")
    return df.where(F.json_object_keys(column).isNull() | F.coalesce(no_list, F.lit(False)))


def with_match_info(df: DataFrame, html: str = "page_html", name: str = "info_text") -> DataFrame:
    """Add the JSON text embedded in each page."""
    return df.withColumn(name, match_info_text(F.col(html)))


def explode_rosters(df: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per roster player with ``side`` and its place in the payload (``side_no``, ``pos``).

    A side that is no map gives no rows.
    """
    opened = df.select(*keep, F.from_json(F.col(column), ROSTER_ENVELOPE)["rosters"].alias("_r"))
    sides = F.array(
        *[F.struct(F.lit(s).alias("side"), F.col(f"_r.{s}").alias("text")) for s in ("h", "a")]
    )
    flat = explode_positions(opened, sides, keep).withColumnRenamed("pos", "side_no")
    roster = F.when(F.col("text").startswith("{"), F.from_json("text", ROSTER_SIDE))
    return explode_positions(flat, F.map_values(roster), (*keep, "side", "side_no"))

"""Micro-batch ingest: landed files in, insert-if-absent out, safe to run again."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.filters import split_status
from touchline.plans.matches import KEY, classify, games, player_rows, set_aside
from touchline.schemas import MATCH_PAGE
from touchline.sinks.planning import insert_absent
from touchline.sinks.writers import SMALL, stage, write_pair
from touchline.sources.tables import Warehouse, read_or_empty

# One landed document per match: the page fields and the roster fields.
MATCH_DOCUMENT = MATCH_PAGE + ", api_status int, api_json string"


def run_available(
    source: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process what has landed since the last run, batch by batch, then stop."""
    query = (
        source.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def insert_available(
    source: DataFrame, target: str, keys: Sequence[str], order: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Insert-if-absent what has landed into the Parquet folder ``target``."""
    spark, schema = source.sparkSession, source.schema

    def each(batch: DataFrame, _: int) -> None:
        rows, n = stage(batch, "stream")
        if n:
            held = read_or_empty(spark, target, schema)
            merge = held.count() < SMALL * n  # of Parquet files only the footers are read for it
            insert_absent(rows, held, keys, order, merge).write.mode("append").parquet(target)

    return run_available(source, each, checkpoint)


def landed_matches(spark: SparkSession, path: str, files_per_batch: int = 25) -> DataFrame:
    """Stream of landed match documents, JSON lines."""
    return (
        spark.readStream.schema(MATCH_DOCUMENT).option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def rejected_path(wh: Warehouse) -> str:
    """Where the stream leaves the matches it did not accept."""
    return f"{wh.root}/rejected/understat_games"


def ingest_matches(
    wh: Warehouse, source: DataFrame, run_id: str, checkpoint: str, lenient: bool = False
) -> StreamingQuery:
    """Store matches as they land.

    Each micro-batch writes games and players in one commit, named by the stream and the
    batch's number: a batch that is replayed after a crash is not written again. Matches
    that are not accepted go to ``rejected_path`` with their status, one folder per run and
    batch. A player's number that cannot be read stops the stream; with ``lenient`` that
    match goes there too, as ``bad_number``, and a restart goes on.
    """

    def each(batch: DataFrame, number: int) -> None:
        pages = batch.select(KEY, "page_status", "page_html")
        rosters = batch.select(KEY, "api_status", "api_json")
        done, n = stage(classify(pages, rosters), "stream")
        if n:
            ok, failed = split_status(done)
            rejects = failed.select(KEY, "status")
            if lenient:
                ok, bad = set_aside(ok)
                rejects = rejects.union(bad.select(KEY, F.lit("bad_number").alias("status")))
            name = f"{checkpoint.rstrip('/')}#{number}"
            write_pair(wh, games(ok), player_rows(ok), run_id, ["side_no", "pos"], name)
            rejects.write.mode("overwrite").parquet(f"{rejected_path(wh)}/run_id={run_id}/batch={number}")

    return run_available(source, each, checkpoint)

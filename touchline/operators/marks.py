"""High-water marks, look-back ranges, chunks and their counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.schemas import CHUNK_SIZE, LOOK_AHEAD, LOOK_BACK


def union_max(sources: Sequence[tuple[DataFrame, str]], name: str = "mark") -> DataFrame:
    """Highest id over several tables, 0 when there is none.

    Each table is reduced to its own maximum before the union; the distinct a union
    would add changes no maximum.
    """
    maxima = [df.agg(F.max(F.col(c).cast("long")).alias(name)) for df, c in sources]
    return reduce(DataFrame.union, maxima).agg(F.coalesce(F.max(name), F.lit(0)).alias(name))


def filtered_max(df: DataFrame, where: Column, column: str, default: object = 0, name: str = "mark") -> DataFrame:
    """Highest value among matching rows, ``default`` when none match."""
    return df.where(where).agg(F.coalesce(F.max(column), F.lit(default)).alias(name))


def candidate_ids(
    mark: DataFrame, look_back: int = LOOK_BACK, look_ahead: int = LOOK_AHEAD, name: str = "id"
) -> DataFrame:
    """Ids ``mark - look_back`` to ``mark + look_ahead``, both included.

    ``spark.range`` splits the offsets over the tasks; the mark is a scalar subquery.
    """
    spark: SparkSession = mark.sparkSession
    offsets = spark.range(-look_back, look_ahead + 1)
    return offsets.select((F.col("id") + mark.scalar()).cast("long").alias(name))


def in_look_back(
    df: DataFrame,
    column: str,
    mark: DataFrame,
    look_back: int = LOOK_BACK,
    look_ahead: int = LOOK_AHEAD,
) -> DataFrame:
    """Rows whose id lies in the range scanned around the mark."""
    return df.where(
        (F.col(column) >= mark.scalar() - look_back) & (F.col(column) <= mark.scalar() + look_ahead)
    )


def batch_id(value: Column, first: Column, size: int = CHUNK_SIZE) -> Column:
    """1-based chunk number of an id."""
    return (F.floor((value - first) / F.lit(size)) + 1).cast("long")


def batch_counts(
    df: DataFrame, batch: str = "batch_id", status: str = "status", players: str | None = None
) -> DataFrame:
    """Fetched, failed and player counts per chunk."""
    ok = F.coalesce(F.col(status) == "ok", F.lit(False))
    aggs = [F.count_if(ok).alias("fetched"), F.count_if(~ok).alias("failed")]
    if players:
        aggs.append(
            F.coalesce(F.sum(F.when(ok, F.col(players))), F.lit(0)).cast("long").alias("players")
        )
    return df.groupBy(batch).agg(*aggs)


def failed_ids(df: DataFrame, id_column: str, batch: str = "batch_id", status: str = "status") -> DataFrame:
    """Failed ids per chunk as text. A chunk holds at most ``CHUNK_SIZE`` ids."""
    failed = df.where(~F.coalesce(F.col(status) == "ok", F.lit(False)))
    ids = F.transform(F.sort_array(F.collect_set(id_column)), lambda x: x.cast("string"))
    return failed.groupBy(batch).agg(
        F.count(F.lit(1)).alias("failed"), F.array_join(ids, ",").alias("failed_ids")
    )

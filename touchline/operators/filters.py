"""Row filters. All are plain predicates, so Catalyst can push them to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    """``column = value`` with a bound value."""
    return df.where(F.col(column) == F.lit(value))


def after_mark(df: DataFrame, column: str, mark: DataFrame) -> DataFrame:
    """Keep rows past a one-row mark; NULL is dropped.

    The mark enters as a scalar subquery: it runs once, and its value reaches the
    Parquet scan as a pushed filter.
    """
    return df.where(F.col(column) > mark.scalar())


def either(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """Keep rows where one of two conditions holds; unknown counts as false."""
    return df.where(F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False)))


def in_league(league: Column, league_id: Column) -> Column:
    """League name ``EPL`` or league id ``1``."""
    return F.coalesce(league == "EPL", F.lit(False)) | F.coalesce(
        league_id.cast("string") == "1", F.lit(False)
    )


def split_matched(df: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with an id, rows without)."""
    return df.where(F.col(id_column).isNotNull()), df.where(F.col(id_column).isNull())


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any of the columns."""
    return df.dropna(subset=list(columns))


def split_status(df: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """(rows with status ``ok``, rejected rows)."""
    ok = F.coalesce(F.col(status) == "ok", F.lit(False))
    return df.where(ok), df.where(~ok)

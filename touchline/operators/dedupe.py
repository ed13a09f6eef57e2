"""First row per key, with an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def total_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> list[Column]:
    """The stated order, then every other column, so equal places are settled by value."""
    named = {c for c in order if isinstance(c, str)} | set(keys)
    rest = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return _as_columns(order) + [F.col(f"`{c}`") for c in rest if c not in named]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of every key.

    ``row_number() = 1`` plans as a group limit on both sides of the shuffle: each
    map task sends at most one row per key, so a hot key costs no more than any other.
    """
    if not order:
        raise ValueError("rows have no order of their own; name the columns that decide 'first'")
    w = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top1(
    df: DataFrame, keys: Sequence[str], score: str, ordinal: str, keep: Sequence[str]
) -> DataFrame:
    """Best row per key by score; the lowest ordinal wins a tie.

    An aggregate rather than a sort: partial results combine before the shuffle.
    """
    best = F.max_by(F.struct(*keep, score), F.struct(F.col(score), -F.col(ordinal)))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, "_best.*")


def collapse_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """One row per distinct row, with the number of copies (combined map-side)."""
    return df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))

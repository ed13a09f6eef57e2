"""Unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_distinct(sources: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct values of one column from each source, under one name."""
    parts = [df.select(F.col(c).alias(name)) for df, c in sources]
    return reduce(DataFrame.union, parts).distinct()


def concat_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

"""Lookup, semi, anti and null-safe joins.

No side is broadcast or repeated by hand. Spark picks the strategy, and AQE splits the left
partitions of a hot key. Rows whose key is NULL match nothing and are dealt over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from touchline.operators.dedupe import first_per_key

SALTS = 16
NULL_DEAL = 256


def _row_salt(df: DataFrame, salts: int) -> Column:
    """Spread rows by content: the same row always lands on the same salt, so a
    recomputed task gives the same rows again. Exact copies stay together; both sides
    of the salted join are plain shuffles, so AQE's skew join splits those."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """Shuffle join in which every key of ``left`` is spread over ``salts`` groups.

    The right side is repeated per salt. ``how`` is ``left``, ``inner``, ``left_semi`` or
    ``left_anti``: the joins whose result that leaves unchanged.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"a salted {how} join would repeat rows")
    spread = left.withColumn("_salt", _row_salt(left, salts))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


def join_unique(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``left`` (any skew) to ``right`` (few rows per key).

    A left row with a NULL key matches nothing; it gets a number by its content as a second
    key, so that such rows do not meet in one task. All other rows have 0 there.
    """
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    dealt = left.withColumn("_deal", F.when(missing, _row_salt(left, NULL_DEAL)).otherwise(0))
    # Not a literal: a constant would be taken out of the join keys.
    plain = right.withColumn("_deal", F.pmod(F.xxhash64(*on), F.lit(1)).cast("int"))
    return dealt.join(plain, [*on, "_deal"], how).drop("_deal")


def lookup_first(
    left: DataFrame,
    right: DataFrame,
    on: str,
    order: Sequence[str | Column],
) -> DataFrame:
    """Left join to the first right row per key. Keys compare as text; NULL never matches."""
    right = first_per_key(right.where(F.col(on).isNotNull()), [on], order)
    right = right.withColumn(on, F.col(on).cast("string"))
    left = left.withColumn(on, F.col(on).cast("string"))
    return join_unique(left, right, [on], "left")


def left_by_name(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join to the distinct rows of ``right``; a name with two ids gives two rows."""
    return join_unique(left, right.distinct(), [on], "left")


def left_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which NULL keys match NULL keys."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    joined = left.join(renamed, reduce(lambda a, b: a & b, same), "left")
    return joined.drop(*[f"_r_{c}" for c in on])


def semi(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return join_unique(left, right.select(*on).distinct(), on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; a NULL key is kept."""
    return join_unique(left, right.select(*on).distinct(), on, "left_anti")


def side_team(side: Column, home: Column, away: Column) -> Column:
    """Team name of side ``h`` or ``a``; NULL for anything else."""
    return F.when(side == "h", home).when(side == "a", away)


def gaps(candidates: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """Candidate ids with no row in ``found``, which is cut to the candidates' range first."""
    low, high = candidates.agg(F.min(on)).scalar(), candidates.agg(F.max(on)).scalar()
    return anti(candidates.select(on), found.where((F.col(on) >= low) & (F.col(on) <= high)), [on])

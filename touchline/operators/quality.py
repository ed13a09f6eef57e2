"""Constraint checks. Each returns the violations; an empty result means it holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from touchline.operators.joins import anti
from touchline.schemas import Table


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. A key with a NULL part is exempt."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
    )


def foreign_key_violations(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values with no parent, with the rows that hold them. NULL passes.

    Counting per value first leaves one row per value for the join, however the
    child rows are spread over the values.
    """
    held = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return anti(held, parent.select(F.col(parent_key).alias(column)), [column])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, in one pass: ``(column_name, n_nulls)``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_nulls")


def with_violations(
    df: DataFrame, required: Sequence[str], parents: Mapping[str, DataFrame], parent_key: str = "id"
) -> DataFrame:
    """Rows with ``violated``, the constraints each of them breaks, empty where it breaks none.

    ``parents`` maps a referencing column to its parent table. Only the values a batch
    holds are looked up: they are made distinct first, so a hot value is looked up once, and
    the parent is cut to their range, which reaches its scan.
    """
    checks = [F.when(F.col(c).isNull(), F.lit(f"not_null {c}")) for c in required]
    for k, (column, parent) in enumerate(parents.items()):
        value = F.col(column).cast("long")
        asked = df.where(F.col(column).isNotNull()).select(value.alias("_value")).distinct()
        low, high = asked.agg(F.min("_value")).scalar(), asked.agg(F.max("_value")).scalar()
        near = parent.select(F.col(parent_key).cast("long").alias("_value"))
        near = near.where((F.col("_value") >= low) & (F.col("_value") <= high))
        lost = anti(asked, near, ["_value"]).withColumnRenamed("_value", f"_lost{k}")
        df = df.join(lost, value == F.col(f"_lost{k}"), "left")
        checks.append(F.when(F.col(f"_lost{k}").isNotNull(), F.lit(f"foreign_key {column}")))
    broken = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn("violated", broken).drop(*[f"_lost{k}" for k in range(len(parents))])


def table_violations(df: DataFrame, table: Table, tables: dict[str, DataFrame]) -> DataFrame:
    """All declared checks of one table as ``(check, detail, n)``."""
    parts = []
    if table.not_null:
        nulls = null_counts(df, table.not_null).where("n_nulls > 0")
        parts.append(nulls.select(F.lit("not_null").alias("check"), F.col("column_name").alias("detail"), F.col("n_nulls").alias("n")))
    for keys in table.unique:
        bad = unique_violations(df, keys).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        parts.append(bad.select(F.lit("unique").alias("check"), F.lit(",".join(keys)).alias("detail"), "n"))
    for column, parent in table.references:
        bad = foreign_key_violations(df, column, tables[parent], "id")
        bad = bad.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        parts.append(bad.select(F.lit("foreign_key").alias("check"), F.lit(f"{column}->{parent}").alias("detail"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out

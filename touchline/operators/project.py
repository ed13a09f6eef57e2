"""Projection: renames, literals, mapped fields, fixed column lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline.functions.casting import try_typed, typed


def prune(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep the named columns, in that order."""
    return df.select(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are not there are ignored."""
    return df.withColumnsRenamed(dict(names))


def with_literals(df: DataFrame, values: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add constant columns ``name -> (value, type)``, leaving existing ones alone."""
    missing = {
        name: F.lit(value).cast(ty) for name, (value, ty) in values.items() if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def stamp_run_id(df: DataFrame, run_id: str) -> DataFrame:
    """Mark every row with the run that produced it."""
    return df.withColumn("run_id", F.lit(run_id).cast("string"))


def mapped(mapping: Iterable[tuple[str, str, str]], strictly: bool = True) -> list[Column]:
    """Columns for a ``(source field, output column, type)`` list over fields held as text.

    Malformed text fails the job, or is NULL unless ``strictly``.
    """
    cast = typed if strictly else try_typed
    return [cast(F.col(f"`{src}`"), ty).alias(dst) for src, dst, ty in mapping]


def project_mapping(df: DataFrame, mapping: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Select by a field mapping. Source fields the frame lacks become NULL."""
    cols = []
    for src, dst, ty in mapping:
        source = F.col(f"`{src}`") if src in df.columns else F.lit(None)
        cols.append(source.cast(ty).alias(dst))
    return df.select(*cols)


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, object] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Shape a frame for a table: its columns, order and types, then the ``keep`` columns.

    A column the frame lacks takes its default, or NULL. A column it has is kept
    as is, so an explicit NULL stays NULL.
    """
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        source = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(defaults.get(f.name))
        # timestamp(3): stored values are rounded to milliseconds, not cut.
        if isinstance(f.dataType, T.TimestampNTZType):
            source = round_to_millis(source)
        cols.append(source.cast(f.dataType).alias(f.name))
    return df.select(*cols, *keep)


def round_to_millis(value: Column) -> Column:
    """Round a timestamp (or timestamp text) to milliseconds, half up."""
    half = F.expr("INTERVAL '0.0005' SECOND")
    return F.date_trunc("MILLISECOND", value.cast("timestamp_ntz") + half).cast("timestamp_ntz")

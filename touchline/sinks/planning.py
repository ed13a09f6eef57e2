"""What a write would do, as DataFrames. Nothing here runs a job."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from touchline.operators.dedupe import collapse_copies, first_per_key


def near_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's keys in the batch's range of the first key, which reaches its scan as a
    pushed filter and skips row groups."""
    first = keys[0]
    low, high = batch.agg(F.min(first)).scalar(), batch.agg(F.max(first)).scalar()
    return target.select(*keys).where((F.col(first) >= low) & (F.col(first) <= high))


def held_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the batch that the target already holds.

    The target is cut to the batch's range of the first key, then to the keys themselves. A
    small batch is broadcast to it, so a large table is neither read whole nor shuffled.
    """
    return near_keys(batch, target, keys).join(batch.select(*keys).distinct(), list(keys), "left_semi")


def insert_absent(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str | Column], merge: bool = False
) -> DataFrame:
    """Rows an insert-if-absent adds: the first per key, unless the target holds the key.

    A key with a NULL part conflicts with nothing, so such rows are all added. ``merge`` is for
    a batch that is not small next to the target: its keys are not sent through the driver to
    cut the target first, both are sorted by key and merged.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed = batch.where(whole)
    held = near_keys(keyed, target, keys).hint("merge") if merge else held_keys(keyed, target, keys)
    new = first_per_key(keyed, keys, order).join(held, list(keys), "left_anti")
    return new.select(*batch.columns).union(batch.where(~whole))


def insert_absent_outcome(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """Every distinct batch row with ``copies``, ``inserted`` and ``skipped`` counts.

    Copies of a row are counted before anything else, so rows are distinct from then
    on and the joins below run on whole rows: no key, however frequent, is gathered.
    """
    columns = batch.columns
    rows = collapse_copies(batch)
    added = collapse_copies(insert_absent(batch, target, keys, order), "inserted")
    same = reduce(
        lambda a, b: a & b, [F.col(f"b.`{c}`").eqNullSafe(F.col(f"i.`{c}`")) for c in columns]
    )
    inserted = F.coalesce(F.col("i.inserted"), F.lit(0)).cast("long")
    return (
        rows.alias("b")
        .join(added.alias("i"), same, "left")
        .select(
            *[f"b.`{c}`" for c in columns],
            "b.copies",
            inserted.alias("inserted"),
            (F.col("b.copies") - inserted).alias("skipped"),
        )
    )


def returning(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> tuple[DataFrame, DataFrame]:
    """(rows inserted, distinct rows skipped with their number of ``copies``)."""
    inserted = insert_absent(batch, target, keys, order)
    outcome = insert_absent_outcome(batch, target, keys, order).where("skipped > 0")
    skipped = outcome.select(*batch.columns, F.col("skipped").alias("copies"))
    return inserted, skipped


def metrics(counts: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each frame; 0 for an empty one."""
    tagged = [df.select(F.lit(name).alias("_of")) for name, df in counts.items()]
    stacked = reduce(DataFrame.union, tagged)
    return stacked.agg(*[F.count_if(F.col("_of") == name).alias(name) for name in counts])


def strict_violations(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys a strict insert would refuse: ``(keys, n_rows, in_target)``."""
    keyed = batch.dropna(subset=list(keys))
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    held = held_keys(keyed, target, keys).distinct().withColumn("_held", F.lit(True))
    in_target = F.coalesce(F.col("_held"), F.lit(False))
    return (
        counts.join(held, list(keys), "left")
        .where((F.col("n_rows") > 1) | in_target)
        .select(*keys, "n_rows", in_target.alias("in_target"))
    )


def replayed(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column], merge: bool = False
) -> DataFrame:
    """The target after inserting a batch."""
    return target.unionByName(insert_absent(batch, target, keys, order, merge))

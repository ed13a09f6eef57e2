"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.session import materialise

BUCKETS = 16384


def hashed_key(*natural: str) -> Column:
    """64-bit key from the natural key; needs no shuffle and no state."""
    return F.xxhash64(*natural)


def _hash_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _range_bucket(df: DataFrame, key: str) -> DataFrame:
    """Rows in key order, NULL first, written once with the number of their sampled range."""
    tied = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ordered = tied.orderBy(F.col(key).asc_nulls_first(), "_tie")
    return materialise(ordered.withColumn("_bucket", F.spark_partition_id()), "ordered")


def dense_keys(
    df: DataFrame,
    key: str | list[str],
    name: str = "id",
    start: int | Column = 0,
    ordered: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Number rows ``start+1 .. start+n`` without gaps; ``key`` must be unique but for NULL.

    Rows are split into buckets, each numbered on its own and shifted by the rows of the
    buckets before it. Only the bucket counts, ``buckets`` or one per range, are ever ordered
    in one task. ``ordered`` needs a single key and numbers in key order, NULL
    first: the ranges are sampled, so outliers do not fill one, and the rows are written
    once. Otherwise buckets follow the key's hash and are even.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if ordered and len(keys) != 1:
        raise ValueError("numbering in key order needs a single key")
    split = _range_bucket(df, keys[0]) if ordered else _hash_bucket(df, keys, buckets)
    order = [F.col(keys[0]).asc_nulls_first(), F.col("_tie")] if ordered else keys
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        split.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    start = start if isinstance(start, Column) else F.lit(start)
    return (
        split.withColumn("_pos", within)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (start + F.col("_before") + F.col("_pos")).cast("long"))
        .drop("_bucket", "_pos", "_before", "_tie")
    )

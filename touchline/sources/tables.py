"""Stored tables as Parquet directories ``<root>/<schema>/<table>``, and scans over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from touchline.commits import CommitLog, Part
from touchline.schemas import TABLES


class Warehouse:
    """Where the tables live: folders of batches, visible once their commit stands in the log.

    A table nobody has written yet reads as empty. ``enforce`` names the declared constraints
    that writers check besides unique keys.
    """

    def __init__(self, spark: SparkSession, root: str, enforce: Sequence[str] = ("not_null", "foreign_key")):
        self.spark = spark
        self.root = root.rstrip("/")
        self.enforce = tuple(enforce)
        self.log = CommitLog(spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def schema(self, table: str) -> T.StructType:
        return T.StructType([T.StructField("id", T.LongType()), *TABLES[table].schema.fields])

    def read(self, table: str, upto: int | None = None, near: tuple[str, object, object] | None = None) -> DataFrame:
        """The table's committed rows, as of log entry ``upto``.

        ``near`` is a (column, low, high): batches without a value in that range may be left
        out. Tables with a season are stored by season, so a filter on it reads only that.
        """
        parts = self._parts(table, upto, near)
        schema = self.schema(table)
        if not parts:
            return empty(self.spark, schema)
        root = self.path(table)
        rows = self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{p.folder}" for p in parts])
        return rows.select(*schema.names)

    def rows(self, table: str, upto: int | None = None, near: tuple[str, object, object] | None = None) -> int:
        """How many rows ``read`` gives, from the log alone."""
        return sum(p.rows for p in self._parts(table, upto, near))

    def _parts(self, table: str, upto: int | None, near: tuple[str, object, object] | None) -> list[Part]:
        return [p for p in self.log.parts(table, upto) if p.rows and (near is None or p.may_hold(*near))]

    def report(self) -> DataFrame:
        """Rows ``inserted`` and in ``total`` per committed batch and table, from the log alone."""
        rows = [
            (e.batch, table, e.counts[f"{table} inserted"], e.counts[f"{table} total"])
            for e in self.log.entries()
            for table in e.parts
        ]
        return self.spark.createDataFrame(rows, "batch string, target string, inserted long, total long")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet folder, or no rows while it does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, but the schema."""
    return spark.createDataFrame([], schema)


def from_records(spark: SparkSession, rows: Sequence, schema: T.StructType) -> DataFrame:
    """A frame from literal rows with a declared schema."""
    return spark.createDataFrame(list(rows), schema)


def scan(df: DataFrame, *columns: str) -> DataFrame:
    """Projected scan."""
    return df.select(*columns)


def scan_distinct(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct projected scan."""
    return df.select(*columns).distinct()


def param_union(
    sources: Sequence[tuple[DataFrame, str, str]], value: object, name: str
) -> DataFrame:
    """Distinct, non-NULL ids of several tables, each filtered on ``column = value``.

    ``sources`` lists ``(table, filter column, id column)``.
    """
    parts = [
        df.where(F.col(flt) == F.lit(value)).select(F.col(c).alias(name)) for df, flt, c in sources
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct().dropna()

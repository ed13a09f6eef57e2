"""Writers: checked batches of one or several tables, committed as one unit.

A batch is written once to the shared folder before it is used: that cuts its lineage,
counts its rows, NULLs and key ranges on the way, and makes its several reads cheap and
identical, also after lost executors. What is new is then written to a folder of the
table and becomes visible with the unit's commit (``touchline.commits``), all tables at once.
Declared constraints are checked on the staged batch: a batch that breaks one is refused
and leaves no trace, or, with ``lenient``, its bad rows come back and the others are stored.
Present keys are skipped, so running a load again is safe.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from touchline.commits import Entry, Part
from touchline.operators.dedupe import collapse_copies
from touchline.operators.project import conform, stamp_run_id
from touchline.operators.quality import with_violations
from touchline.schemas import TABLES
from touchline.session import fresh_dir
from touchline.sinks.planning import insert_absent, strict_violations
from touchline.sources.tables import Warehouse

SMALL = 16  # a batch may be broadcast to a table that has so many times its rows in the batch's range
ROW = "_row"  # a staged row's number: task number in the upper bits, place below
_PLACE_BITS = 33
_RANGED = (T.IntegerType, T.LongType, T.StringType)


class DuplicateKey(ValueError):
    """A strict insert met a key that is there already, or twice in the batch."""


class ConstraintViolation(ValueError):
    """A batch breaks a declared constraint."""


def _write_observed(df: DataFrame, path: str, metrics: Sequence[Column], by: Sequence[str] = ()) -> dict:
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n"), *metrics).write
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return seen.get


def _staged(df: DataFrame, purpose: str, metrics: Sequence[Column] = ()) -> tuple[DataFrame, dict]:
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    seen = _write_observed(df, path, metrics)
    return spark.read.schema(df.schema).parquet(path), seen


def stage(df: DataFrame, purpose: str = "stage") -> tuple[DataFrame, int]:
    """Write a frame to a fresh shared folder; return it read back, and its row count."""
    rows, seen = _staged(df, purpose)
    return rows, int(seen["n"])


def with_ids(rows: DataFrame, first: int) -> DataFrame:
    """Add ``id`` from ``first`` on, without gaps, to staged rows with their numbers.

    Only the row counts of the tasks that wrote the rows are ordered and broadcast, one
    per task; the rows themselves are not shuffled.
    """
    task = F.shiftright(ROW, _PLACE_BITS)
    place = F.col(ROW).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_task", task).join(F.broadcast(starts), "_task")
    return numbered.withColumn("id", (F.lit(first) + F.col("_before") + place).cast("long")).drop("_task", "_before", ROW)


@dataclass(frozen=True)
class Outcome:
    """What a write did to one table. The frames read staged folders and may be used at any time."""

    total: int
    inserted: int
    rows: DataFrame  # the rows added, with their ids
    skipped: DataFrame  # distinct rows not added though valid, with their number of copies
    violations: DataFrame  # rows set aside, with the constraints they break in ``violated``

    @property
    def counts(self) -> dict[str, int]:
        return {"inserted": self.inserted, "total": self.total}


class Unit:
    """Writes to several tables that become visible together, or not at all.

    ::

        with Unit(wh, "run-1") as unit:
            unit.insert_if_absent("raw.understat_games", games, ["date"])
            unit.append("raw.fpl_player_games", rows)

    An error inside the block commits nothing. ``batch`` names the unit: one whose name is in
    the log already is not written again. All reads are as of the unit's start, and a commit
    by somebody else to the same tables since then is a ``WriteConflict``.
    """

    def __init__(self, wh: Warehouse, batch: str | None = None, lenient: bool = False):
        self.wh = wh
        self.lenient = lenient
        self.batch = batch or uuid.uuid4().hex
        self.base = wh.log.last()
        self.done = batch is not None and wh.log.has(batch)
        self._parts: dict[str, Part] = {}
        self._counts: dict[str, int] = {}

    def __enter__(self) -> Unit:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.commit()

    def commit(self) -> None:
        if self._parts and not self.done:
            self.wh.log.commit(Entry(self.batch, self._parts, counts=self._counts), self.base)
            self.done = True

    def append(self, table: str, df: DataFrame) -> Outcome:
        """All valid rows, copies too."""
        batch, total, bad = self._checked(table, df)
        return self._add(table, batch, batch, total, bad)

    def insert_if_absent(
        self, table: str, df: DataFrame, order: Sequence[str], keys: Sequence[str] | None = None
    ) -> Outcome:
        """The rows whose key is new; the first of the batch by ``order`` wins.

        ``order`` may name columns the table does not store.
        """
        spec = TABLES[table]
        keys = list(keys or spec.unique[0])
        batch, total, bad = self._checked(table, df, [c for c in order if c not in spec.schema.names])
        if not total:
            return self._add(table, batch, batch, total, bad)
        held, rows = self._near(table, batch, keys)
        new = insert_absent(batch, held, keys, order, merge=rows < SMALL * total)
        return self._add(table, batch, new, total, bad)

    def insert_strict(self, table: str, df: DataFrame, keys: Sequence[str] | None = None) -> Outcome:
        """All rows, or none: any key present twice or already stored is an error."""
        keys = list(keys or TABLES[table].unique[0])
        batch, total, bad = self._checked(table, df)
        held, _ = self._near(table, batch, keys)
        twice = strict_violations(batch, held, keys).limit(5).collect()  # for the message only
        if twice:
            shown = "; ".join(str(tuple(r[k] for k in keys)) for r in twice)
            raise DuplicateKey(f"{table}: duplicate {tuple(keys)}, for example {shown}")
        return self._add(table, batch, batch, total, bad)

    def _checked(self, table: str, df: DataFrame, extra: Sequence[str] = ()) -> tuple[DataFrame, int, DataFrame]:
        """(valid staged rows, rows of the batch, rows that break a constraint).

        NULLs are counted while the batch is staged, so a batch without any costs no pass more.
        """
        if table in self._parts:
            raise ValueError(f"{table} is written twice in one unit")
        spec, enforce = TABLES[table], self.wh.enforce
        required = spec.not_null if "not_null" in enforce else []
        linked = spec.references if "foreign_key" in enforce else ()
        rows = conform(df, spec.schema, spec.defaults, extra).withColumn(ROW, F.monotonically_increasing_id())
        nulls = [F.count_if(F.col(c).isNull()).alias(f"_null {c}") for c in required]
        batch, seen = _staged(rows, "batch", nulls)
        total = int(seen["n"])
        required = [c for c in required if total and seen[f"_null {c}"]]
        linked = {c: self.wh.read(parent, self.base) for c, parent in linked} if total else {}
        if not required and not linked:
            return batch, total, batch.limit(0).withColumn("violated", F.array().cast("array<string>"))
        flagged, seen = _staged(
            with_violations(batch, required, linked), "checked", [F.count_if(F.size("violated") > 0).alias("bad")]
        )
        bad = flagged.where(F.size("violated") > 0).drop(ROW)
        if seen["bad"] and not self.lenient:
            kinds = bad.select(F.explode("violated").alias("v")).groupBy("v").count().orderBy("v").collect()
            shown = "; ".join(f"{r['v']} in {r['count']} rows" for r in kinds)
            raise ConstraintViolation(f"{table}: {shown}")
        return flagged.where(F.size("violated") == 0).drop("violated"), total, bad

    def _near(self, table: str, batch: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
        """The table without the batches out of the first key's range, and its rows."""
        first = keys[0]
        low, high = batch.agg(F.min(first), F.max(first)).first()
        near = (first, low, high) if isinstance(low, (int, str)) else None
        return self.wh.read(table, self.base, near), self.wh.rows(table, self.base, near)

    def _add(self, table: str, batch: DataFrame, new: DataFrame, total: int, bad: DataFrame) -> Outcome:
        """Store ``new``, rows of ``batch``, in a folder of the table that the commit will name."""
        spec, wh = TABLES[table], self.wh
        columns = spec.schema.names
        source = F.col(ROW).alias("_source")
        kept, seen = _staged(new.select(*columns, source, F.monotonically_increasing_id().alias(ROW)), "new")
        inserted = int(seen["n"])
        folder = f"batch={uuid.uuid4().hex}"
        ranged = [f.name for f in spec.schema.fields if isinstance(f.dataType, _RANGED) and f.name in spec.indexed]
        if inserted and not self.done:
            first = wh.log.reserve(table, inserted)
            ends = [end(c).alias(f"{name} {c}") for c in ranged for name, end in (("low", F.min), ("high", F.max))]
            numbered = with_ids(kept.drop("_source"), first).select("id", *columns)
            seen = _write_observed(numbered, f"{wh.path(table)}/{folder}", ends, spec.stored_by)
            ranges = {c: (seen[f"low {c}"], seen[f"high {c}"]) for c in ranged if seen[f"low {c}"] is not None}
            self._parts[table] = Part(folder, inserted, ranges)
            stored = wh.spark.read.schema(wh.schema(table)).option("basePath", wh.path(table))
            rows = stored.parquet(f"{wh.path(table)}/{folder}").select("id", *columns)
        else:
            rows = wh.read(table).limit(0)
        self._counts |= {f"{table} inserted": inserted, f"{table} total": total}
        added = kept.select(F.col("_source").alias(ROW))
        left = batch.join(added, ROW, "left_anti").select(*columns)
        return Outcome(total, 0 if self.done else inserted, rows, collapse_copies(left), bad)


def append(wh: Warehouse, table: str, df: DataFrame) -> int:
    """Plain append; returns the rows written."""
    with Unit(wh) as unit:
        return unit.append(table, df).inserted


def append_dense(wh: Warehouse, table: str, df: DataFrame, key: Sequence[str] = ()) -> int:
    """Append; ids are dense for every writer, so ``key`` is not needed any more."""
    return append(wh, table, df)


def insert_if_absent(
    wh: Warehouse,
    table: str,
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] | None = None,
) -> dict[str, int]:
    """Insert-if-absent into one table; returns ``inserted`` and ``total``."""
    with Unit(wh) as unit:
        return unit.insert_if_absent(table, df, order, keys).counts


def insert_strict(
    wh: Warehouse, table: str, df: DataFrame, keys: Sequence[str] | None = None
) -> int:
    """Append all rows, or none; returns the rows of the batch."""
    with Unit(wh) as unit:
        return unit.insert_strict(table, df, keys).total


def add_pair(unit: Unit, games: DataFrame, players: DataFrame, run_id: str, order: Sequence[str]) -> dict[str, Outcome]:
    """Games and their players in a unit; of one (match, name) the first by ``order`` is kept."""
    return {
        "games": unit.insert_if_absent("raw.understat_games", games, ["date", "home", "away"]),
        "players": unit.insert_if_absent(
            "raw.understat_player_games",
            stamp_run_id(players, run_id),
            order,
            keys=["understat_game_id", "name"],
        ),
    }


def write_pair(
    wh: Warehouse,
    games: DataFrame,
    players: DataFrame,
    run_id: str,
    order: Sequence[str],
    batch: str | None = None,
) -> dict[str, int]:
    """Games and players in one commit: readers see both or neither."""
    with Unit(wh, batch) as unit:
        done = add_pair(unit, games, players, run_id, order)
    return {f"{name}_{k}": v for name, out in done.items() for k, v in out.counts.items()}

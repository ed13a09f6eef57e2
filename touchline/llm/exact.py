"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of fixed size. The distinct blocks, sorted, get integer names;
adjacent names are then paired, the distinct pairs sorted and named in turn, until every
document has one name. Two documents have the same name after the same number of rounds
if and only if their texts are the same bytes: no hash decides.

Blocks sort by a 64-bit key of their content and then by the content. The content is
shuffled once, combined per task, to find the distinct blocks; afterwards a block is
looked up by its key alone, and by key and content for the keys that two blocks share.
All of it is DataFrame code; no step holds a group of copies in one task.

Null texts count as empty, and an empty text is one empty block. Rows are told apart by
their place, so repeated rows and ids are rows of their own; the largest id stays, a null
id is less than any other, and of rows with the same id and text one stays. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window

from touchline.llm.text import numbered, whole_text, with_row
from touchline.session import Scratch

BLOCK = 8192


def _named(distinct: DataFrame, *keys: str) -> DataFrame:
    """Integer names for distinct keys, in their order."""
    ranged = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ranged.select(*keys, F.monotonically_increasing_id().alias("name"))


def _first_names(scratch: Scratch, blocks: DataFrame) -> DataFrame:
    """(row, id, sha, n, pos, name) of every block."""
    distinct = scratch.write(
        blocks.groupBy("block").agg(F.first("key").alias("key")).select("key"), "keys"
    )
    counted = scratch.write(distinct.groupBy("key").count(), "counted")
    shared = counted.where("count > 1").select("key")
    if shared.isEmpty():
        names = scratch.write(_named(counted.select("key"), "key"), "names-0")
        return blocks.drop("block").join(names, "key").drop("key")
    # Keys that several blocks share: the content tells these apart. Both parts of the
    # blocks must carry the same row numbers, so they are written.
    blocks = scratch.write(blocks, "blocks")
    clash = blocks.join(shared, "key", "left_semi").select("key", "block").distinct()
    place = F.row_number().over(Window.partitionBy("key").orderBy("block"))
    clash = scratch.write(clash.withColumn("place", place), "clash")
    single = counted.where("count = 1").select("key", F.lit(0).alias("place"))
    names = _named(single.union(clash.select("key", "place")), "key", "place")
    names = scratch.write(names, "names-0")
    alone = blocks.drop("block").join(names.where("place = 0").drop("place"), "key")
    other = blocks.join(clash, ["key", "block"]).join(names, ["key", "place"])
    columns = [c for c in blocks.columns if c not in ("key", "block")] + ["name"]
    return alone.select(*columns).union(other.select(*columns))


def identify(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK,
    normalise: Callable[[Column], Column] | None = None,
    key: Callable[[Column], Column] = F.xxhash64,
    number: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, keep_id, group_size, kept, text_sha256."""
    body = whole_text(text) if normalise is None else normalise(whole_text(text))
    with Scratch(docs.sparkSession, "exact") as scratch:
        rows = with_row(docs, number, id=doc_id, bytes=body.cast("binary"))
        size = F.octet_length("bytes")
        rows = rows.select(
            "row",
            "id",
            F.sha2("bytes", 256).alias("sha"),
            F.greatest(F.lit(1), F.ceil(size / block)).cast("int").alias("n"),
            "bytes",
        )
        cut = F.transform(
            F.sequence(F.lit(0), F.col("n") - 1),
            lambda i: F.substring(F.col("bytes"), i * block + 1, F.lit(block)),
        )
        blocks = rows.select("row", "id", "sha", "n", F.posexplode(cut).alias("pos", "block"))
        blocks = blocks.withColumn("key", key(F.col("block")))
        level = scratch.write(_first_names(scratch, blocks), "level-0")
        done, depth = [], 0
        while True:
            whole = level.where("n = 1")
            done.append(whole.select("row", "id", "sha", F.lit(depth).alias("depth"), "name"))
            rest = level.where("n > 1")
            if rest.isEmpty():
                break
            depth += 1
            even = F.col("pos") % 2 == 0
            pairs = rest.groupBy("row", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            pairs = pairs.agg(
                F.first("id").alias("id"),
                F.first("sha").alias("sha"),
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
            ).withColumn("n", F.ceil(F.col("n") / 2).cast("int"))
            pairs = scratch.write(pairs, f"pairs-{depth}")
            names = _named(pairs.select("a", "b").distinct(), "a", "b")
            names = scratch.write(names, f"names-{depth}")
            level = scratch.write(pairs.join(names, ["a", "b"]).drop("a", "b"), f"level-{depth}")
        named = reduce(DataFrame.union, done)
        groups = named.groupBy("depth", "name").agg(
            F.max(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size")
        )
        groups = scratch.write(groups, "groups")
        found = named.join(groups, ["depth", "name"]).select(
            "row",
            F.col("id").alias("doc_id"),
            F.col("keep.id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("keep.row")).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
        return scratch.publish(found)


def keep_rows(docs: DataFrame, number: str, rows: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose stored ``number`` is among ``rows.row``, without the number."""
    # The list of rows grows with the data, so it is never broadcast.
    kept = rows.select(F.col("row").alias(number)).hint("merge")
    return docs.join(kept, number, "left_semi").drop(number)


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns kept."""
    docs, number = numbered(docs)
    return keep_rows(docs, number, identify(docs, doc_id, text, number=number).where("kept"))

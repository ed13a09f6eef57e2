"""Near duplicates: the Jaccard join of five-word shingles, by adaptive prefixes.

1. Each document becomes the set of hashes of its shingles. Documents with one set are one
   class from here on; the one with the smallest id stands for it.
2. A sketch of fixed size counts shingles over all documents. It orders them: those that
   are not frequent first, by hash, then the frequent ones. Any order gives right results.
3. Two sets that are similar enough share, in that order, at least l tokens of their
   l-prefixes. Each document takes the l that makes its estimated candidates fewest; a
   pair must share as many prefix tokens as the smaller l of the two.
4. A pair is verified on its whole texts. In a first round each document meets, for each of
   its prefix tokens, the holder with the fewest rare tokens: of a group of near copies the
   one nearest to what they have in common. What that links is joined into components. In
   the second, only documents of different components still meet. In both, a pair is left
   out if the tokens that only one of the two can hold are too many for the threshold, so
   those of a group that are too far from its middle do not meet all others. In the second
   round a pair must also share as many prefix tokens as its two sizes ask for; bit marks of
   the prefixes bound that number where the two meet, before a row is made of them. Each set
   carries the least of its prefix tokens that others hold: two that share some of these meet
   at the least of them alone, and not at every token they share.
5. Components give every document the smallest id it is linked with.

Step 4 loses no link between components: a pair that meets in neither round is in one
component already or cannot be similar. Null texts and texts without words have an empty
set and are linked with nothing. Repeated rows are one class. Null ids count as larger than
all others, and ``component_id`` is null only if all of a component are. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.components import components
from touchline.llm.exact import keep_rows
from touchline.llm.text import LOWER, Words, bytes_of, mix, numbered, runs, whole_text, with_row
from touchline.session import Scratch

SHINGLE = 5
PERCENT = 80
PASSAGES = 1.0  # candidates by passages too rare for the sketch, assumed of each document
CELL_BITS, SLICES, FAN = 21, 32, 64
CELLS = 1 << CELL_BITS
MARKS = [f"mark_{i}" for i in range(4)]  # 64 bits each, set by the tokens of a prefix that others hold
LEAST = 4  # tokens of a prefix, of those that others hold, that a set carries where it meets others

_SALT = np.random.default_rng(77).integers(0, 2**64, SHINGLE, dtype=np.uint64)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every distinct shingle of a run of documents, in this order."""
    words = Words(LOWER[data], at)
    first, h = words.windows(SHINGLE)
    doc = words.doc[first] if len(first) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = words.count[short] > k
            whole[has] += mix(words.hash[words.first[short[has]] + k] + _SALT[k])
        h = np.concatenate((h, mix(whole ^ _SALT[-1])))
        doc = np.concatenate((doc, short))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells, part = np.zeros(CELLS, np.uint32), 0  # of one task
    for batch in batches:
        data, at = bytes_of(batch.column(0))
        part = batch.column(1)[0].as_py() if batch.num_rows else part
        for first, last in runs(at, 1 << 20):
            span = at[first : last + 1]
            _, h = shingle_sets(data[span[0] : span[-1]], span - span[0])
            np.add.at(cells, _cell(h), 1)
    yield _slices(list(range(SLICES)), part, cells)


def _slices(which: list[int], part: int, cells: np.ndarray) -> pa.RecordBatch:
    parts = [c.astype("<u4" if c.max(initial=0) < 1 << 32 else "<i8").tobytes() for c in np.split(cells, len(which))]
    return pa.RecordBatch.from_arrays(
        [pa.array(which, pa.int32()), pa.array([part % FAN] * len(which), pa.int32()), pa.array(parts, pa.binary())],
        ["slice", "fan", "cells"],
    )


def _add(table: pa.Table) -> pa.Table:
    total, wide = np.zeros(CELLS // SLICES, np.int64), 4 * CELLS // SLICES
    for c in table.column("cells"):
        raw = c.as_py()
        total += np.frombuffer(raw, "<u4" if len(raw) == wide else "<i8")
    which = table.column("slice")[0].as_py()
    return pa.Table.from_batches([_slices([which], table.column("fan")[0].as_py(), total)])


def frequencies(texts: DataFrame) -> np.ndarray:
    """By how much each cell of the sketch is above what chance explains; CELLS numbers."""
    schema = "slice int, fan int, cells binary"
    sketches = texts.select("text", F.spark_partition_id().alias("part")).mapInArrow(_counter, schema)
    for _ in range(2):  # first within FAN groups of tasks, then over these
        sketches = sketches.groupBy("slice", "fan").applyInArrow(_add, schema).withColumn("fan", F.lit(0))
    parts = {r["slice"]: bytes(r["cells"]) for r in sketches.collect()}  # SLICES rows
    if not parts:
        return np.zeros(CELLS, np.float32)
    half = 4 * CELLS // SLICES
    cells = np.concatenate([np.frombuffer(parts[i], "<u4" if len(parts[i]) == half else "<i8") for i in range(SLICES)])
    usual = np.median(cells)
    above = cells - usual
    # A cell holds the tokens of chance, of which some are more; what stands out is frequent.
    return np.where(above > 4 * np.sqrt(usual) + 4, above, 0.0).astype(np.float32)


def prefix(h: np.ndarray, above: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(l, how many tokens of the l-prefix are not frequent, these and then the frequent ones) of one set."""
    n = len(h)
    extra = above[_cell(h)]
    order = np.lexsort((h, np.where(extra > 0, np.log2(extra + 1).astype(np.int64) + 1, 0)))
    base = n - -(-PERCENT * n // 100)
    cost = np.cumsum(extra[order])
    # Candidates share at least l tokens, so there are at most the holders of all tokens
    # by l; each costs two sets to verify, and each token of the prefix a row.
    ways = sorted({1, 2, 3, 1 + n // 20} & set(range(1, n - base + 1)))
    best = min(ways, key=lambda w: (base + w + 2 * n * (PASSAGES + cost[base + w - 1]) / w, w))
    tokens = order[: base + best]
    return best, int((extra[tokens] <= 0).sum()), h[tokens]


def _signer(above: np.ndarray):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = bytes_of(batch.column(2))
            for first, last in runs(at, 1 << 20):
                span = at[first : last + 1]
                doc, h = shingle_sets(data[span[0] : span[-1]], span - span[0])
                edge = np.searchsorted(doc, np.arange(last - first + 1))
                total = np.zeros((2, len(h) + 1), np.uint64)
                np.cumsum(mix(h), out=total[0, 1:])
                np.cumsum(mix(h ^ _SALT[0]), out=total[1, 1:])
                s = total[:, edge[1:]] - total[:, edge[:-1]]
                ways, rare, tokens = [], [], []
                for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    way, few, some = prefix(h[i:j], above) if j > i else (1, 0, h[:0])
                    ways.append(way)
                    rare.append(few)
                    tokens.append(some.view(np.int64))
                lengths = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
                flat = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(np.diff(edge), pa.int64()),
                        pa.array(s[0].view(np.int64)),
                        pa.array(s[1].view(np.int64)),
                        pa.array(ways, pa.int32()),
                        pa.array(rare, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(lengths), flat),
                    ],
                    ["row", "doc_id", "n", "s1", "s2", "ways", "rare", "tokens"],
                )

    return sign


def _verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[int, np.ndarray] = {}

        def set_of(row: int, column: int, i: int) -> np.ndarray:
            if row not in known:
                if len(known) > 200:
                    known.clear()
                raw = np.frombuffer(batch.column(column)[i].as_py(), np.uint8)
                known[row] = shingle_sets(raw, np.array([0, len(raw)]))[1]
            return known[row]

        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        linked = []
        for i, (x, y) in enumerate(zip(a, b)):
            p, q = set_of(x, 2, i), set_of(y, 3, i)
            shared = len(np.intersect1d(p, q, assume_unique=True))
            linked.append(100 * shared >= PERCENT * (len(p) + len(q) - shared))
        yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough."""
    of = lambda k: texts.select(F.col("row").alias(k), F.col("text").alias(f"text_{k}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verifier, "a long, b long")


def _reachable(n: str, own: str, other_n: str, other_deep: str) -> Column:
    """Whether a set can still be similar enough to another one.

    Its ``own`` rare tokens are in no other prefix, so another set whose prefix reaches past
    its rare tokens cannot hold them: at most ``n - own`` tokens are shared.
    """
    most = F.col(n) - F.when(F.col(other_deep), F.col(own)).otherwise(0)
    return most * 100 >= (F.col(n) + F.col(other_n) - most) * PERCENT


def _marks() -> list[Column]:
    """Aggregates over tokens ``h`` of a prefix: each sets one bit of one mark."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftright("h", 2) % 64 + 64).cast("int") % 64)
    which = F.col("h").bitwiseAND(F.lit(len(MARKS) - 1))
    return [F.bit_or(F.when(which == i, bit).otherwise(F.lit(0).cast("long"))).alias(m) for i, m in enumerate(MARKS)]


def _shared_at_most(x: str, y: str) -> Column:
    """Most prefix tokens of ``x`` that ``y`` can hold: a bit that ``y`` lacks is a token it lacks."""
    lacks = [F.bit_count(F.col(f"{x}.{m}").bitwiseAND(F.bitwise_not(f"{y}.{m}"))) for m in MARKS]
    return F.col(f"{x}.held") - sum(lacks[1:], lacks[0])


def _meets_here(x: str, y: str) -> Column:
    """Whether no token before this one is known to be in the prefixes of both.

    Both lists are the least tokens of a prefix, so a token of both is shared, and the least
    such token is the least of all that the two share.
    """
    first = F.get(F.array_intersect(f"{x}.least", f"{y}.least"), 0)
    return F.coalesce(first == F.col(f"{x}.h"), F.lit(True))


def _meetings(still: DataFrame) -> DataFrame:
    """(a, b): sets of different components that meet at a token and can be similar enough.

    Two that share none of their least tokens meet at every token they share, others once.
    """
    x, y = still.alias("x"), still.alias("y")
    apart = F.col("x.h") == F.col("y.h")
    apart &= (F.col("x.c") != F.col("y.c")) & (F.col("x.n") <= F.col("y.n")) & (F.col("x.n") * 100 >= PERCENT * F.col("y.n"))
    apart &= (F.col("x.n") < F.col("y.n")) | (F.col("x.row") < F.col("y.row"))
    apart &= _reachable("x.n", "x.own", "y.n", "y.deep") & _reachable("y.n", "y.own", "x.n", "x.deep")
    most = F.least(_shared_at_most("x", "y"), _shared_at_most("y", "x"))
    apart &= most >= F.least("x.ways", "y.ways")
    apart &= (most + F.greatest("x.rest", "y.rest")) * (100 + PERCENT) >= (F.col("x.n") + F.col("y.n")) * PERCENT
    apart &= _meets_here("x", "y")
    return x.join(y, apart).select(F.col("x.row").alias("a"), F.col("y.row").alias("b"))


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", number: str | None = None) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    with Scratch(spark, "jaccard", compression="zstd") as scratch:
        rows = with_row(docs, number, doc_id=F.col(doc_id).cast("long"), text=whole_text(text).cast("binary"))
        rows = rows.select("row", "doc_id", "text")
        rows = rows if number else scratch.write(rows, "rows")
        above = frequencies(rows)
        schema = "row long, doc_id long, n long, s1 long, s2 long, ways int, rare int, tokens array<long>"
        signed = scratch.write(rows.mapInArrow(_signer(above), schema), "signed")
        rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
        classes = signed.where("n > 0").groupBy("n", "s1", "s2").agg(F.min(rank).alias("top"))
        classes = scratch.write(classes.select("n", "s1", "s2", F.col("top.row").alias("rep"), "top"), "classes")
        copies = signed.select("row", "n", "s1", "s2").join(classes, ["n", "s1", "s2"]).where("row <> rep")
        copies = scratch.write(copies.select("row"), "copies")
        some = signed.where("n > 1").select("row", "n", "ways", "rare", "tokens").join(copies, "row", "left_anti")
        held = some.select("row", "rare", F.posexplode("tokens").alias("at", "h"))
        lead = F.min(F.struct("rare", "row"))["row"].alias("lead")
        first = held.groupBy("h").agg(F.count(F.lit(1)).alias("df"), lead)
        first = scratch.write(first.where("df > 1").select("h", "lead"), "tokens")
        scratch.drop()
        shared = held.select("row", "h", (F.col("at") < F.col("rare")).alias("few"))
        shared = scratch.write(shared.join(first, "h"), "shared")
        scratch.drop("tokens")
        least = F.slice(F.array_sort(F.collect_list("h")), 1, LEAST).alias("least")  # at most the prefix of one set
        met = shared.groupBy("row").agg(F.count_if("few").alias("met"), F.count(F.lit(1)).alias("held"), least, *_marks())
        own = (F.col("rare") - F.col("met")).alias("own")  # tokens no other prefix holds
        deep = (F.size("tokens") > F.col("rare")).alias("deep")  # every rare token is in the prefix
        rest = (F.col("n") - F.size("tokens")).alias("rest")
        sizes = scratch.write(some.join(met, "row").select("row", "n", "ways", own, deep, rest, "held", "least", *MARKS), "sizes")
        signed = scratch.write(signed.drop("ways", "rare", "tokens"), "sets")
        scratch.drop("signed", "copies")
        texts = scratch.write(rows.select("row", "text").join(sizes.select("row"), "row", "left_semi"), "texts")
        scratch.drop("rows")
        plain = sizes.drop("held", "least", *MARKS)
        size = lambda k: plain.toDF(*[f"{c}_{k}" for c in plain.columns]).withColumnRenamed(f"row_{k}", k)
        meet = shared.where("row <> lead").groupBy(F.col("row").alias("a"), F.col("lead").alias("b"))
        meet = meet.agg(F.count(F.lit(1)).alias("k"))
        near = F.least("n_a", "n_b") * 100 >= PERCENT * F.greatest("n_a", "n_b")
        near &= F.col("k") >= F.least("ways_a", "ways_b")
        near &= _reachable("n_a", "own_a", "n_b", "deep_b") & _reachable("n_b", "own_b", "n_a", "deep_a")
        meet = scratch.write(meet.join(size("a"), "a").join(size("b"), "b").where(near).select("a", "b"), "meet")
        scratch.drop()
        edges = scratch.write(_verified(meet, texts), "edges-1")
        scratch.drop("meet")
        found = components(scratch, edges, "first")
        at = shared.drop("lead", "few").join(found.toDF("row", "c"), "row", "left").withColumn("c", F.coalesce("c", "row"))
        at = scratch.write(at, "placed")
        scratch.drop("shared")
        mixed = at.groupBy("h").agg(F.min("c").alias("l"), F.max("c").alias("m")).where("l <> m").select("h")
        mixed = scratch.write(mixed, "mixed")
        still = scratch.write(at.join(mixed, "h", "left_semi").join(sizes, "row"), "open")
        scratch.drop("placed", "mixed")
        again = scratch.write(_meetings(still).distinct(), "again")
        scratch.drop("open")
        more = scratch.write(_verified(again, texts), "edges-2")
        scratch.drop("texts", "again")
        if not more.isEmpty():
            found = components(scratch, edges.union(more), "second")
        joined = classes.join(found.toDF("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
        joined = scratch.write(joined, "joined")
        tops = scratch.write(joined.groupBy("c").agg(F.min("top").alias("best")), "tops")
        placed = scratch.write(joined.join(tops, "c").select("n", "s1", "s2", "best"), "best")
        linked = signed.select("row", "doc_id", "n", "s1", "s2").join(placed, ["n", "s1", "s2"]).select(
            "row",
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.col("best.doc_id").alias("component_id"),
            (F.col("row") == F.col("best.row")).alias("kept"),
        )
        alone = signed.where("n = 0").select("row", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
        return scratch.publish(linked.union(alone))


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every component, that with the smallest id, all columns kept."""
    docs, number = numbered(docs)
    return keep_rows(docs, number, link(docs, doc_id, text, number).where("kept"))

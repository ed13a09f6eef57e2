"""Hard negatives by shared lists of anchor clusters (MAXIMUS-style).

Anchors are clustered by direction. The angle between a candidate and a cluster's centre,
less the cluster's radius, is at most its angle to any member, so
``|candidate| * cos(max(0, angle - radius))`` bounds its score with every member of length 1.
A segment of candidates is sorted once per cluster by that bound; all members walk the sorted
list together, a block at a time, and a member stops as soon as the next bound, times its own
length, is below what it still needs: the last of its best rows, or the lower edge of its band.
Positives are found by a first walk, the negatives of every positive by a second one.

Candidates are dealt into segments of about ``SEGMENT`` rows and anchors, cluster by cluster,
into tiles of about ``MEMBERS``; each task takes one segment and one tile, so neither a hot
label nor a group of copies is ever gathered, and only the best rows of each segment are
shuffled and merged. Centres are fitted on at most ``SAMPLE`` anchors, chosen by a hash; the
fit changes how early a walk stops, never its result.

Components x become floor(scale * x), so scores are whole numbers; they are exact while the
largest squared length stays below 2^53, and a table beyond that is refused with an error.
Rows with a null id, label or vector, or with a component that is null, infinite or no number,
take no part. A shorter vector counts as one with zeros at the end; a vector of zeros has score
0 with every row. Repeated rows take part once each, and an anchor never meets its own row.
Ties in the score go by the smaller id. An empty table gives no rows. Only the three named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.session import Scratch

SEGMENT, MEMBERS = 1 << 17, 1 << 12  # rows of a segment, anchors of a tile
BLOCK, WALKERS = 512, 512  # candidates and members of one matrix product
CLUSTERS, SAMPLE = 32, 4096
ROUNDS = 10  # of the clustering
SLACK = 1e-6  # relative, for the rounding of bounds
OUT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)
ROW = "row long, id long, label int"


def _packed(rows: DataFrame, scale: float) -> DataFrame:
    """The rows whose ``vector`` has finite components only, packed as whole numbers of 32 bits."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            x = lists.flatten().to_numpy(zero_copy_only=False)  # a null component is no number
            good = np.isfinite(x)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.where(good, np.floor(scale * x), 0)
            end = np.cumsum(size)
            squares = np.append(0, np.cumsum(np.minimum(x * x, 2.0**53)))
            bad = np.append(0, np.cumsum(~good))
            whole = bad[end] == bad[end - size]
            if (np.minimum(np.abs(x), 2.0**31).max(initial=0) >= 2**31) or (squares[end] - squares[end - size] >= 2**53).any():
                raise ValueError("a vector is too long for exact scores")
            data = x.astype("<i4")
            vectors = [data[e - n : e].tobytes() if ok else None for e, n, ok in zip(end, size, whole)]
            rest = [batch.column(c) for c in ("row", "id", "label", "anchor")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(vectors, pa.binary())], ["row", "id", "label", "anchor", "vector"])

    return rows.mapInArrow(pack, f"{ROW}, anchor boolean, vector binary").where("vector IS NOT NULL")


def _matrix(vectors: list[bytes], size: int) -> np.ndarray:
    """Vectors as rows, with zeros after the end of the shorter ones."""
    out = np.zeros((len(vectors), size))
    for k, v in enumerate(vectors):
        v = np.frombuffer(v, "<i4")
        out[k, : len(v)] = v
    return out


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.maximum(size, 1e-300)[:, None], size


def centres(sample: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Directions of at most ``clusters`` clusters: spherical k-means from far-apart rows."""
    x, size = _unit(sample)
    x = x[size > 0]
    if len(x) == 0:
        return np.zeros((1, sample.shape[1]))
    picked = [x[0]]
    near = x @ x[0]
    while len(picked) < min(clusters, len(x)):
        picked.append(x[int(near.argmin())])
        near = np.maximum(near, x @ picked[-1])
    found = np.stack(picked)
    for _ in range(rounds):
        whose = (x @ found.T).argmax(1)
        total = np.zeros_like(found)
        np.add.at(total, whose, x)
        moved, size = _unit(total)
        found = np.where(size[:, None] > 0, moved, found)
    return found


def _clustered(anchors: DataFrame, found: np.ndarray) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector").to_pylist(), found.shape[1])
            cluster = (x @ found.T).argmax(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster, pa.int32())], [*batch.schema.names, "cluster"]
            )

    return anchors.mapInArrow(assign, f"{ROW}, vector binary, cluster int")


def tiles(sizes: dict[int, int], members: int) -> list[tuple[int, int, int]]:
    """(cluster, first tile, number of tiles): small clusters share one, large ones are cut."""
    out, tile, filled = [], 0, 0
    for cluster, n in sorted(sizes.items()):
        if filled and filled + n > members:
            tile, filled = tile + 1, 0
        parts = -(-n // members)
        out.append((cluster, tile, parts))
        tile, filled = (tile + parts, 0) if parts > 1 else (tile, filled + n)
    return out


class _Best:
    """The best ``k`` entries of every member, by score and then by smaller id."""

    def __init__(self, members: int, k: int):
        self.k = k
        self.floor = np.full(members, -np.inf)  # score of the k-th entry, once there are k
        self.parts = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]

    def take(self, who: np.ndarray, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores of members ``who`` (rows) with candidates ``ids`` (columns)."""
        held = np.where(allowed, score, -np.inf)
        floor = self.floor[who]
        if held.shape[1] > self.k:
            floor = np.maximum(floor, -np.partition(-held, self.k - 1, axis=1)[:, self.k - 1])
        row, col = np.nonzero(allowed & (held >= floor[:, None]))
        if len(row) == 0:
            return
        before = self.parts[0]
        mine = np.isin(before[0], who) if len(before[0]) else np.zeros(0, bool)
        m = np.concatenate([before[0][mine], who[row]])
        s = np.concatenate([before[1][mine], held[row, col]])
        i = np.concatenate([before[2][mine], ids[col]])
        order = np.lexsort((i, -s, m))
        m, s, i = m[order], s[order], i[order]
        first = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        place = np.arange(len(m)) - np.repeat(first, np.diff(np.append(first, len(m))))
        full = place == self.k - 1
        self.floor[m[full]] = s[full]
        keep = place < self.k
        self.parts[0] = tuple(np.concatenate([b[~mine], x[keep]]) for b, x in zip(before, (m, s, i)))


def _walk(members, candidates, need, take) -> int:
    """Members of one cluster walk the candidates, sorted once by bound; returns blocks read.

    ``need(who)`` is the least score that still matters to each member, ``take`` gets scores.
    """
    unit, length = _unit(members)
    middle, size = _unit(unit.sum(0, keepdims=True))
    if size[0] == 0:
        middle = np.zeros_like(middle)
    inside = np.clip(unit[length > 0] @ middle[0], -1, 1)
    radius = np.arccos(inside.min()) if len(inside) and size[0] else np.pi
    direction, reach = _unit(candidates)
    angle = np.arccos(np.clip(direction @ middle[0], -1, 1))
    bound = reach * np.cos(np.maximum(0, angle - radius))
    order = np.argsort(-bound, kind="stable")
    bound, candidates = bound[order], candidates[order]
    read = 0
    for first in range(0, len(members), WALKERS):
        who = np.arange(first, min(first + WALKERS, len(members)))
        for at in range(0, len(order), BLOCK):
            top = bound[at] * length[who]
            who = who[top + SLACK * (1 + reach.max() * length[who]) >= need(who)]
            if len(who) == 0:
                break
            cols = order[at : at + BLOCK]
            take(who, np.rint(members[who] @ candidates[at : at + BLOCK].T), cols)
            read += 1
    return read


def _paired(rows: DataFrame, anchors: DataFrame, segments: int, tiles_: int, find, schema: str) -> DataFrame:
    """``find`` for every segment of rows with every tile of anchors."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("tile", every(tiles_)).groupBy("segment", "tile")
    right = anchors.withColumn("segment", every(segments)).groupBy("segment", "tile")
    return left.cogroup(right).applyInPandas(find, schema)


def _first(found: DataFrame, keys: list[str], other: str, k: int) -> DataFrame:
    """The best ``k`` of each key over all segments, numbered from 1 as ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), other)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _clusters(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for _, part in frame.sort_values(["cluster", "row"]).groupby("cluster"):
        yield part.reset_index(drop=True)


def _positives(size: int, k: int):
    def find(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"row": [], "positive": [], "score": []}).astype(np.int64)]
        if len(rows) and len(anchors):
            x = _matrix(rows["vector"].tolist(), size)
            own, label, ids = (rows[c].to_numpy() for c in ("row", "label", "id"))
            for part in _clusters(anchors):
                best = _Best(len(part), k)
                mine, same = part["row"].to_numpy(), part["label"].to_numpy()

                def take(who, score, cols):
                    allowed = (label[cols] == same[who][:, None]) & (own[cols] != mine[who][:, None])
                    best.take(who, score, allowed, ids[cols])

                _walk(_matrix(part["vector"].tolist(), size), x, lambda who: best.floor[who], take)
                m, s, i = best.parts[0]
                out.append(pd.DataFrame({"row": mine[m], "positive": i, "score": s.astype(np.int64)}))
        return pd.concat(out)

    return find


def _negatives(size: int, k: int, low: int, high: int):
    def find(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"row": [], "place": [], "negative": [], "score": []}).astype(np.int64)]
        if len(rows) and len(anchors):
            x = _matrix(rows["vector"].tolist(), size)
            label, ids = (rows[c].to_numpy() for c in ("label", "id"))
            for part in _clusters(anchors):
                mine, same = part["row"].to_numpy(), part["label"].to_numpy()
                scores = part["scores"].tolist()
                most = max(map(len, scores))
                # Scores of the positives; a band without a positive, or of a negative score, holds nothing.
                goal = np.full((len(part), most), np.nan)
                for m, s in enumerate(scores):
                    goal[m, : len(s)] = s
                goal[goal < 0] = np.nan
                best = [_Best(len(part), k) for _ in range(most)]

                def need(who):
                    edge = np.stack([np.fmax(low * goal[who, j] / 100, best[j].floor[who]) for j in range(most)])
                    return np.where(np.isnan(goal[who].T), np.inf, edge).min(0)

                def take(who, score, cols):
                    other = label[cols] != same[who][:, None]
                    for j in range(most):
                        p = goal[who, j][:, None]
                        inside = other & (low * p <= 100 * score) & (100 * score <= high * p)
                        best[j].take(who, score, inside, ids[cols])

                _walk(_matrix(part["vector"].tolist(), size), x, need, take)
                for j in range(most):
                    m, s, i = best[j].parts[0]
                    out.append(pd.DataFrame({"row": mine[m], "place": j, "negative": i, "score": s.astype(np.int64)}))
        return pd.concat(out)

    return find


def mine(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    segment: int = SEGMENT,
    members: int = MEMBERS,
) -> DataFrame:
    """Hard negatives of every positive of every row where ``anchor`` holds (of ``vec_id``).

    ``low`` and ``high`` are the band of a negative's score, in hundredths of the positive's.
    """
    picked = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("id"),
        (F.col(label) if isinstance(label, str) else label).cast("int").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    spark = vectors.sparkSession
    with Scratch(spark, "negatives") as scratch:
        rows = scratch.write(_packed(picked, scale), "rows")
        n, size = rows.agg(F.count(F.lit(1)), F.max(F.octet_length("vector") / 4)).first()
        size = int(size or 0)
        anchors = rows.where("anchor").drop("anchor")
        sample = anchors.orderBy(F.xxhash64("row")).limit(SAMPLE).select("vector").collect()
        if not sample:
            return spark.createDataFrame([], OUT)
        # Fewer, larger segments than cores would leave cores idle; that changes no result.
        segments = max(-(-n // segment), min(-(-n // (4 * BLOCK)), spark.sparkContext.defaultParallelism))
        found = centres(_matrix([bytes(r["vector"]) for r in sample], size), min(CLUSTERS, -(-len(sample) // 8)))
        anchors = scratch.write(_clustered(anchors, found), "anchors")
        sizes = {r["cluster"]: r["count"] for r in anchors.groupBy("cluster").count().collect()}
        dealt = tiles(sizes, members)
        parts = max(first + n for _, first, n in dealt)
        first = F.create_map(*(F.lit(x) for c, t, _ in dealt for x in (c, t)))[F.col("cluster")]
        cut = F.create_map(*(F.lit(x) for c, _, k in dealt for x in (c, k)))[F.col("cluster")]
        anchors = anchors.withColumn("tile", (first + F.pmod(F.xxhash64("row"), cut)).cast("int"))
        rows = rows.drop("anchor").withColumn("segment", F.pmod(F.xxhash64("row"), F.lit(segments)).cast("int"))
        near = _paired(rows, anchors, segments, parts, _positives(size, positives), "row long, positive long, score long")
        near = _first(near, ["row"], "positive", positives)
        near = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "positive", "score"))).alias("near"))
        goals = scratch.write(anchors.join(near, "row"), "goals")
        aimed = goals.select("row", "label", "vector", "cluster", "tile", F.col("near.score").alias("scores"))
        hard = _paired(rows, aimed, segments, parts, _negatives(size, negatives, low, high), "row long, place int, negative long, score long")
        hard = _first(hard, ["row", "place"], "negative", negatives)
        goals = goals.select("row", F.col("id").alias("anchor_id"), F.posexplode("near").alias("place", "best"))
        out = goals.join(hard, ["row", "place"]).select(
            "anchor_id",
            F.col("best.positive").alias("positive_id"),
            "rank",
            F.col("negative").alias("negative_id"),
            F.col("best.score").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
        return scratch.publish(out)

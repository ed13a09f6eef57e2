"""Mixing sources to target weights by entropy balancing.

Every document starts at rate 1. The rates are moved as little as possible, in relative
entropy, such that each source's expected words meet its target and no rate is above a
cap. The solution is an exponential tilt, ``min(cap, exp(lambda * size / mean size))``,
with one multiplier per source; the multipliers solve the convex dual, one Newton step per
distributed pass, with bounds to fall back on. Rates become whole copies: the integer part
of the rate, and one more for the documents that come first by ``u / fraction``, u being a
hash of the id (sequential Poisson rounding), up to the one that would cross the source's
target. That point is found by counting words in bins, two passes deep. The document that
crosses is passed over, and the next round goes on with those that still fit.

All sums are of integers (rates in units of 2^-20), so reruns agree to the last bit
whatever the order of the rows. Sources are the groups of the mix; their list (not their
documents) is held by the driver, so there may be at most ``SOURCES`` of them, else an error.

A null text has size 0; a null source is a source; documents of size 0 keep rate 1 and
take nothing; rows that agree in id and size get the same copies; an empty table gives
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.llm.text import WORD, whole_text, with_row
from touchline.session import Scratch

CAP = 3
STEPS = 40
UNIT = 1 << 20
BINS = 4096
ROUNDS = 12  # of taking documents that still fit
SOURCES = 10_000  # the lists that are broadcast and held by the driver are no longer


def word_count(text: str) -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def share_out(sizes: Sequence[int], weights: Sequence[float], cap: float = CAP) -> list[float]:
    """Targets by weight that share the sum of the sizes, none over ``cap`` times its size."""
    target = [0.0] * len(sizes)
    open_, left = list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                target[i] = left * weights[i] / total
            break
        for i in over:
            target[i] = float(cap * sizes[i])
        left -= sum(target[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return target


def _listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A row per source, at most ``SOURCES``: broadcast, so the documents stay where they are."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def _big(column: Column) -> Column:
    return F.sum(column.cast("decimal(38,0)"))


def _rate(tilt: Column, size: Column, mean: Column, cap: float) -> Column:
    """Rate in units of 2^-20."""
    return F.round(F.least(F.exp(tilt * size / mean), F.lit(float(cap))) * UNIT).cast("long")


def _solve(scratch: Scratch, counted: DataFrame, sources: list[dict], cap: float) -> None:
    """Set each source's ``tilt`` by Newton steps over (source, size, n)."""
    spark = scratch.spark
    moving = [s for s in sources if 0 < s["target"] < cap * s["size"]]
    for s in sources:
        s["tilt"], s["low"], s["high"] = 0.0, -math.inf, math.inf
        if s["target"] >= cap * s["size"] > 0:
            s["tilt"] = s["mean"] * math.log(cap)  # the smallest size is 1: all reach the cap
        elif s["target"] <= 0:
            s["tilt"] = -1e6
    for _ in range(STEPS):
        if not moving:
            return
        now = _listed(spark, [(s["no"], s["tilt"], s["mean"]) for s in moving], "no int, tilt double, mean double")
        rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap)
        words = F.col("n").cast("decimal(20,0)") * F.col("size")
        free = F.when(F.col("rate") < int(cap * UNIT), F.col("rate"))
        # Slope: words times size times rate, where the cap does not bind.
        slope = F.round(F.coalesce(free, F.lit(0)) * F.col("size") / F.col("mean")).cast("long")
        step = counted.join(now, "no").withColumn("rate", rate).groupBy("no").agg(
            _big(words * F.col("rate")).alias("got"), _big(words * slope).alias("slope")
        )
        found = {r["no"]: r for r in step.collect()}  # a row per source
        still = []
        for s in moving:
            got, slope_ = (float(found[s["no"]][k]) / UNIT for k in ("got", "slope"))
            gap = s["target"] - got
            if abs(gap) <= 1e-6 * s["target"]:
                continue
            s["low" if gap > 0 else "high"] = s["tilt"]
            new = s["tilt"] + gap / slope_ if slope_ > 0 else math.inf
            if not s["low"] < new < s["high"] or abs(new - s["tilt"]) > 8:
                if math.isinf(s["low"]) or math.isinf(s["high"]):
                    new = s["tilt"] + math.copysign(2.0 + abs(s["tilt"]), gap)
                else:
                    new = (s["low"] + s["high"]) / 2
            if s["high"] - s["low"] > 1e-12:
                s["tilt"] = new
                still.append(s)
        moving = still


def _bin(value: Column, low: Column, width: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor((value - low) / width))).cast("int")


def _cuts(spark: SparkSession, extra: DataFrame, sources: list[dict]) -> None:
    """One round: set each source's ``cut``, up to which its candidates fit into its ``need``.

    Candidates are taken by ``v``; the first one that crosses the need ends the round.
    """
    top = 4.0
    for s in sources:
        s["low"], s["width"], s["left"], s["cut"] = 0.0, top / BINS, s["need"], top
    for _ in range(2):
        now = _listed(spark, [(s["no"], s["low"], s["width"]) for s in sources], "no int, low double, width double")
        place = _bin(F.col("v"), F.col("low"), F.col("width"))
        bins = extra.join(now, "no").where("v >= low").groupBy("no", place.alias("bin"))
        words: dict[int, dict[int, int]] = {}
        for r in bins.agg(F.sum("size").alias("words")).collect():  # BINS rows per source
            words.setdefault(r["no"], {})[r["bin"]] = int(r["words"])
        for s in sources:
            at, found = 0, words.get(s["no"], {})
            while at < BINS and found.get(at, 0) <= s["left"]:
                s["left"] -= found.get(at, 0)
                at += 1
            s["low"] += at * s["width"]
            s["width"] /= BINS
    for s in sources:
        s["cut"] = s["low"]


def _round_off(scratch: Scratch, rated: DataFrame, sources: list[dict]) -> None:
    """Set each source's ``rules``: (largest size, cut) pairs; a document under one is taken once more.

    A round ends at the document that crosses the need; the next one passes it over and
    goes on with those that still fit, until nothing does. At last the smallest document left is
    taken if that comes nearer to the target.
    """
    spark = scratch.spark
    extra = rated.where("v IS NOT NULL").select("no", "size", "v")
    for s in sources:
        s["rules"] = []
    going, limit = list(sources), {s["no"]: float("inf") for s in sources}
    for _ in range(ROUNDS):
        if not going:
            break
        fits = F.col("size") <= F.col("most")
        most = _listed(spark, [(s["no"], limit[s["no"]]) for s in going], "no int, most double")
        _cuts(spark, _untaken(extra, sources).join(most, "no").where(fits).drop("most"), going)
        still = []
        for s in going:
            moved = s["need"] - s["left"]
            first = limit[s["no"]] == float("inf")
            s["rules"].append((limit[s["no"]], s["cut"]))
            s["need"] = limit[s["no"]] = s["left"]
            if s["need"] >= 1 and (moved > 0 or first):
                still.append(s)
        going = still
    left = _untaken(extra, sources).groupBy("no", "size", "v").agg(F.count(F.lit(1)).alias("n"))
    least = left.groupBy("no").agg(F.min(F.struct(F.col("size") * F.col("n"), "v", "size")).alias("least"))
    found = {r["no"]: r["least"] for r in least.collect()}  # a row per source
    for s in sources:
        if s["no"] in found and 2 * s["need"] > found[s["no"]][0]:
            s["rules"].append((float(found[s["no"]]["size"]), math.nextafter(found[s["no"]]["v"], 9.0)))


def _taken(rated: DataFrame, sources: list[dict]) -> DataFrame:
    """Rows with ``again``: whether a rule of their source takes them once more."""
    rules = [(s["no"], s["rules"]) for s in sources]
    listed = _listed(rated.sparkSession, rules, "no int, rules array<struct<most:double, cut:double>>")
    meets = F.exists("rules", lambda r: (F.col("size") <= r["most"]) & (F.col("v") < r["cut"]))
    return rated.join(listed, "no").withColumn("again", F.coalesce(meets, F.lit(False))).drop("rules")


def _untaken(extra: DataFrame, sources: list[dict]) -> DataFrame:
    return _taken(extra, sources).where("NOT again").drop("again")


def _named(sized: DataFrame, sources: list[dict]) -> DataFrame:
    """Rows with what is known of their source: no, mean, source_size, target."""
    of = _listed(
        sized.sparkSession,
        [(s["no"], s["source"], s["mean"], s["size"], s["target"]) for s in sources],
        "no int, _s string, mean double, source_size long, target double",
    )
    return sized.join(of, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def _rated(named: DataFrame, sources: list[dict], cap: float) -> DataFrame:
    """Rows with their rate, the whole copies in it, and the draw for one more."""
    tilts = _listed(named.sparkSession, [(s["no"], s["tilt"]) for s in sources], "no int, tilt double")
    rated = named.join(tilts, "no").withColumn("rate", _rate(F.col("tilt"), F.col("size"), F.col("mean"), cap))
    part = F.col("rate") % UNIT
    u = (F.xxhash64("doc_id", "size").bitwiseAND((1 << 53) - 1) + 1) / float(1 << 53)
    rated = rated.withColumn("v", F.when((part > 0) & (F.col("size") > 0), u * UNIT / part))
    return rated.withColumn("base", F.floor(F.col("rate") / UNIT).cast("int"))


def _solved(scratch: Scratch, sized: DataFrame, weights: Sequence[float], cap: float) -> tuple[DataFrame, list[dict]]:
    """The rated rows of a written table (doc_id, source, size), and the sources with their rules."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    found = totals.limit(SOURCES + 1).collect()
    if len(found) > SOURCES:
        raise ValueError(f"a mix has at most {SOURCES} sources")
    listed = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    sources = [{"no": i, "source": r["source"], "size": r["size"], "n": r["n"]} for i, r in enumerate(listed)]
    shares = [weights[i % len(weights)] for i in range(len(sources))]
    for s, target in zip(sources, share_out([s["size"] for s in sources], shares, cap)):
        s["target"], s["mean"] = target, max(1.0, s["size"] / s["n"])
    named = _named(sized, sources)
    counted = scratch.write(named.where("size > 0").groupBy("no", "size").agg(F.count(F.lit(1)).alias("n")), "counted")
    _solve(scratch, counted, sources, cap)
    rated = scratch.write(_rated(named, sources, cap), "rated")
    given = rated.groupBy("no").agg(F.sum(F.col("base") * F.col("size")).alias("words")).collect()
    given = {r["no"]: r["words"] for r in given}
    for s in sources:
        s["need"] = max(0.0, s["target"] - given.get(s["no"], 0))
    _round_off(scratch, rated, sources)
    return rated, sources


def _copies() -> Column:
    return F.col("base") + F.col("again").cast("int")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    cap: float = CAP,
    number: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, source, size, source_size, target, rate,
    copies, taken. Sources by code point, null last, weigh ``weights``, repeating."""
    spark = docs.sparkSession
    with Scratch(spark, "mix") as scratch:
        sized = with_row(docs, number, doc_id=doc_id, source=source, size=word_count(text))
        sized = scratch.write(sized, "sized")
        rated, sources = _solved(scratch, sized, weights, cap)
        mixed = _taken(rated, sources).withColumn("copies", _copies())
        return scratch.publish(
            mixed.select(
                "row",
                "doc_id",
                "source",
                "size",
                "source_size",
                "target",
                (F.col("rate") / UNIT).alias("rate"),
                "copies",
                (F.col("copies") * F.col("size")).cast("long").alias("taken"),
            )
        )


def take_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    cap: float = CAP,
) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies, or not at all.

    The copies follow from a row's id, source and size and the rules of its source, so they
    are found while the rows are read again; no text is written or shuffled for it.
    """
    known = {"doc_id": F.col(doc_id), "source": F.col(source), "size": word_count(text)}
    known = [c.alias(name) for name, c in known.items()]
    with Scratch(docs.sparkSession, "mix") as scratch:
        _, sources = _solved(scratch, scratch.write(docs.select(*known), "sized"), weights, cap)
    each = docs.select(F.struct(*docs.columns).alias("doc"), *known)
    taken = _taken(_rated(_named(each, sources), sources, cap), sources).where(_copies() > 0)
    return taken.select("doc", F.explode(F.sequence(F.lit(1), _copies()))).select("doc.*")

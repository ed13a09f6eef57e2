"""Fuzzy name join: every left name takes its best-scoring right name.

The join is exact for the combined score: it returns what scoring every left name
against every right name would, without pairing them all. Distinct names are
compared, never rows, and a name finds its partner along one of four ways:

1. *Equal names* score 100, which nothing else reaches: a plain equi-join.
2. *Short against long, one shared token*: the score has a fixed floor (85.5 while the
   lengths differ by a factor of 1.5 to 8). Among partners at the floor the first one wins, so the
   right side is reduced to its first name per (token, length) before the join, and
   no pairs are formed inside a token, however common it is.
3. *A one-letter name against a longer name holding that letter* scores a fixed 90 (85.5
   for a repeated letter); handled like 2, with letters for tokens.
4. *Everything else* that reaches the threshold must share letter pairs. Indel
   distance bounds how many: deleting a letter loses at most two pairs and inserting
   one loses at most one. A name therefore only needs to look up a prefix of its
   pairs, rarest first, two at a time (prefix filtering; Chaudhuri, Ganti and Kaushik
   2006, Bayardo, Ma and Srikant 2007, Wang, Li and Feng 2012). Names met there are
   compared by 64-bit signatures first; only those left in reach of the cut become
   candidates and are scored. The floor of way 2 raises a name's cut, which shortens
   its prefix.

The bounds hold for both roles, so both run: left prefixes against all right pairs,
and right prefixes against all left pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions import similarity
from touchline.functions.name_scores import (
    LONG_FROM,
    LONG_PARTIAL_WEIGHT,
    PARTIAL_FROM,
    PARTIAL_WEIGHT,
    TOKEN_WEIGHT,
)
from touchline.functions.text import normalise_name
from touchline.operators.joins import join_unique
from touchline.session import materialise, spread

# Scores with a closed form, written as the scorer computes them.
TOKEN_FLOOR = 100.0 * TOKEN_WEIGHT * PARTIAL_WEIGHT
LONG_TOKEN_FLOOR = 100.0 * TOKEN_WEIGHT * LONG_PARTIAL_WEIGHT
LETTER_SCORE = 100.0 * PARTIAL_WEIGHT

# From this threshold on letter pairs carry the bound for every length; below it, letters do.
PAIR_THRESHOLD = 73

_EPS = 1e-9
_SLOTS = 4096
_BLOCK = 10_000
_NAMES_PER_TASK = 500


def _shared_needed(size: Column, cut: Column, pairs: bool) -> Column:
    """Fewest grams a name of ``size`` letters shares with any partner scoring ``cut``.

    ``size`` is the length with repeated tokens removed, the shortest form any of the
    scores compares; the name is the shorter one of the two, or the one whose tokens
    the other covers.
    """
    t = cut / F.lit(100.0)
    part = t / F.lit(PARTIAL_WEIGHT)
    token = t / F.lit(TOKEN_WEIGHT)
    extra = F.lit(1.0 if pairs else 0.0)
    never = F.lit(float("inf"))
    whole = size * (3 * t - 2) + extra if pairs else size * t
    # A window as short as the cut allows; its two outer pairs may be lost.
    if pairs:
        window = size * (F.lit(2.0) / (2 - part)) * (1.5 * part - 1) - extra
    else:
        window = size * part / (2 - part)
    covered = size * token / (2 - token) + extra
    least = F.least(
        whole, F.when(part <= 1, window).otherwise(never), F.when(token <= 1, covered).otherwise(never)
    )
    return F.greatest(F.lit(1), F.ceil(least - F.lit(_EPS))).cast("int")


def _grams(name: Column, pairs: bool) -> Column:
    """Letter pairs (or letters) of a name with repeats numbered: a bag as a set."""
    text = F.concat(F.lit(" "), name, F.lit(" ")) if pairs else name
    width = 2 if pairs else 1
    at = F.sequence(F.lit(1), F.length(text) - F.lit(width - 1))
    bag = F.array_sort(F.transform(at, lambda i: F.substring(text, i, F.lit(width))))
    return F.transform(
        bag, lambda g, i: F.concat(g, (i + 1 - F.array_position(bag, g)).cast("string"))
    )


def _set_size(name: Column) -> Column:
    return F.length(F.array_join(F.array_distinct(similarity.tokens(name)), " "))


def _gram_counts(rights: DataFrame, pairs: bool) -> Column:
    """How often grams occur on the right side, by hash slot, as a scalar subquery.

    Any order of the grams gives correct prefixes; rare ones first gives short candidate
    lists. ``_SLOTS`` bounds the map, whatever the alphabet.
    """
    slots = rights.select(F.explode(_grams(F.col("norm"), pairs)).alias("gram")).select(
        _slot(F.col("gram")).alias("slot")
    )
    counted = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.map_from_entries(F.collect_list(F.struct("slot", "n")))).scalar()


def _slot(gram: Column) -> Column:
    return F.pmod(F.hash(gram), F.lit(_SLOTS))


def _rarest_first(grams: Column, counts: Column) -> Column:
    """Grams as ``(n, g)``, sorted."""
    ranked = F.transform(
        grams, lambda g: F.struct(F.coalesce(counts[_slot(g)], F.lit(0)).alias("n"), g.alias("g"))
    )
    return F.array_sort(ranked)


def _single_keys(ranked: Column) -> Column:
    return F.transform(ranked, lambda g: F.struct(F.xxhash64(g["g"]).alias("key"), g["n"].alias("n")))


def _double_keys(ranked: Column) -> Column:
    """A key per two grams, with the count of the rarer one: no more names hold both."""

    def with_later(g: Column, i: Column) -> Column:
        later = F.slice(ranked, i + 2, F.size(ranked))
        return F.transform(
            later, lambda h: F.struct(F.xxhash64(g["g"], h["g"]).alias("key"), g["n"].alias("n"))
        )

    return F.flatten(F.transform(ranked, with_later))


def _signature(grams: Column) -> Column:
    """64 bits set by the grams of a name.

    Every bit one name has and another lacks stands for a gram of the first that the
    second does not have, whichever grams share a bit.
    """
    bit = lambda g: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(g), F.lit(64)))
    return F.aggregate(grams, F.lit(0).cast("long"), lambda acc, g: acc.bitwiseOR(bit(g)))


def _lacking(one: str, other: str) -> Column:
    return F.bit_count(F.col(one).bitwiseAND(F.bitwise_not(other)))


def _can_reach(cut: Column) -> Column:
    """Whether the signatures of ``l_`` and ``r_`` leave room for a score of ``cut``.

    Letters and letter pairs one side lacks bound every score from above: a missing
    letter must be deleted or inserted, and one such step changes at most three pairs.
    Names with repeated tokens or spaces compare in several forms and pass.
    """
    t = cut / F.lit(100.0)
    part, token = t / F.lit(PARTIAL_WEIGHT), t / F.lit(TOKEN_WEIGHT)
    l_size, r_size = F.col("l_size"), F.col("r_size")
    short, long = F.least(l_size, r_size), F.greatest(l_size, r_size)
    l_only, r_only = _lacking("l_sig", "r_sig"), _lacking("r_sig", "l_sig")
    l_pairs, r_pairs = _lacking("l_pair_sig", "r_pair_sig"), _lacking("r_pair_sig", "l_pair_sig")
    steps = (1 - t) * (l_size + r_size) + _EPS
    whole = (l_only + r_only <= steps) & (l_pairs + r_pairs <= 3 * steps)
    # shared tokens cover one name: its other letters, and as many pairs, may be missing
    loose = 1 - token / (2 - token) + _EPS
    near = (token <= 1) & ((l_pairs <= loose * l_size) | (r_pairs <= loose * r_size))
    # a window of the longer name covers the shorter one, whose outer pairs may be lost
    left_short = l_size <= r_size
    letters = F.when(left_short, l_only).otherwise(r_only)
    pairs = F.when(left_short, l_pairs).otherwise(r_pairs)
    kept = (F.lit(2.0) / (2 - part)) * (1.5 * part - 1)
    far = (
        (part <= 1)
        & (letters <= (1 - part / (2 - part)) * short + _EPS)
        & (pairs <= (1 - kept) * short + 2 + _EPS)
    )
    room = F.when(long < short * PARTIAL_FROM, whole | near).otherwise(whole | far)
    in_reach = (cut <= 100.0 * LONG_PARTIAL_WEIGHT) | (long <= short * LONG_FROM)
    return in_reach & (~F.col("l_plain") | ~F.col("r_plain") | room)


def _candidates(lefts: DataFrame, rights: DataFrame, cut: float, pairs: bool) -> DataFrame:
    """Pairs ``(norm, other)`` that may score their cut; both sides are plain scans."""
    counts = _gram_counts(rights, pairs)
    parts = _work_partitions(lefts, rights)
    norm = F.col("norm")
    letters = F.filter(_grams(norm, pairs=False), lambda g: ~g.startswith(" "))
    plain = (F.array_join(F.array_distinct(F.split(norm, " ")), " ") == norm) & ~norm.contains("  ")

    def indexed(side: DataFrame, tag: str) -> DataFrame:
        return side.withColumn("counts", counts).select(
            norm.alias(f"{tag}_norm"),
            F.length(norm).alias(f"{tag}_size"),
            _signature(letters).alias(f"{tag}_sig"),
            _signature(_grams(norm, pairs=True)).alias(f"{tag}_pair_sig"),
            plain.alias(f"{tag}_plain"),
            _rarest_first(_grams(norm, pairs), F.col("counts")).alias("grams"),
            F.col("cut").alias(f"{tag}_cut"),
            "counts",
        )

    left = indexed(spread(lefts), "l")
    right = indexed(spread(rights.select("norm", F.lit(cut).alias("cut"))), "r")

    # A common key is split over as many groups as it may have blocks of names: each name
    # looked up sits in one of them, each name looking visits all.
    blocks = F.floor(F.col("k.n") / F.lit(_BLOCK)) + 1

    def keyed(side: DataFrame, keys: Column, block: Column) -> DataFrame:
        rows = side.withColumn("k", F.explode(keys)).withColumn("block", block)
        rows = rows.withColumn("key", F.col("k.key")).drop("grams", "counts", "k")
        return rows.repartition(parts, "key", "block")

    def whole(side: DataFrame, tag: str) -> DataFrame:
        grams = F.col("grams")
        block = F.pmod(F.xxhash64(f"{tag}_norm"), blocks).cast("int")
        return keyed(side, F.concat(_single_keys(grams), _double_keys(grams)), block)

    def prefix(side: DataFrame, tag: str) -> DataFrame:
        needed = _shared_needed(_set_size(F.col(f"{tag}_norm")), F.col(f"{tag}_cut"), pairs)
        head = lambda extra: F.slice(
            "grams", F.lit(1), F.greatest(F.lit(0), F.size("grams") - needed + extra)
        )
        keys = F.when(needed >= 2, _double_keys(head(2))).otherwise(_single_keys(head(1)))
        return keyed(side, keys, F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))

    def met(l_side: DataFrame, r_side: DataFrame) -> DataFrame:
        found = l_side.join(r_side, ["key", "block"]).where(_can_reach(F.col("l_cut")))
        return found.select(F.col("l_norm").alias("norm"), F.col("r_norm").alias("other"))

    forward = met(prefix(left, "l"), whole(right, "r"))
    backward = met(whole(left, "l"), prefix(right, "r"))
    # A pair is met once per shared key, and both ways. The shuffle before the distinct
    # also spreads the pairs evenly for scoring, wherever they met.
    return forward.union(backward).repartition(parts, "norm", "other").distinct()


def _work_partitions(lefts: DataFrame, rights: DataFrame) -> int:
    """Tasks for work that is heavy per name, where sizing by bytes gives too few: by names,
    up to what the cluster runs at once twice over."""
    spark = lefts.sparkSession
    cores = spark.sparkContext.defaultParallelism
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 2 * cores)
    names = lefts.count() + rights.count()  # from the file footers
    return min(most, max(cores, names // _NAMES_PER_TASK))


def _first_by_size(df: DataFrame, key: str) -> DataFrame:
    """First name per (key, length): all a fixed score needs to know of the right side."""
    return df.groupBy(key, F.length("norm").alias("r_size")).agg(F.min("place").alias("place"))


def _words(df: DataFrame) -> DataFrame:
    words = F.array_distinct(similarity.tokens(F.col("norm")))
    return df.withColumn("token", F.explode(words))


def _letters(df: DataFrame) -> DataFrame:
    letters = F.array_distinct(F.split("norm", ""))
    return df.withColumn("letter", F.explode(letters)).where("trim(letter) <> ''")


def _single_letters(df: DataFrame) -> DataFrame:
    """Names made of one letter, once or repeated as tokens (``b``, ``b b``)."""
    return df.where(_set_size(F.col("norm")) == 1).withColumn("letter", F.substring("norm", 1, 1))


def _floors(lefts: DataFrame, rights: DataFrame, cut: float, pairs: bool) -> DataFrame | None:
    """Best fixed-score partner of each name: ``(norm, score, place)``, or None if out of reach."""
    left_size = F.length("norm").alias("l_size")
    wide = F.greatest(F.col("l_size"), F.col("r_size"))
    narrow = F.least(F.col("l_size"), F.col("r_size"))
    near = wide <= narrow * LONG_FROM
    token_score = F.when(near, TOKEN_FLOOR).otherwise(LONG_TOKEN_FLOOR)
    parts = []

    def meet(left: DataFrame, right: DataFrame, key: str, score: Column) -> None:
        met = join_unique(left.select("norm", key, left_size), _first_by_size(right, key), [key], "inner")
        far = met.where(wide >= narrow * PARTIAL_FROM)
        parts.append(far.select("norm", score.alias("score"), "place"))

    if TOKEN_FLOOR >= cut:
        meet(_words(lefts), _words(rights), "token", token_score)
    if pairs and LETTER_SCORE >= cut:
        for left, right, single in (
            (_single_letters(lefts), _letters(rights), "l_size"),
            (_letters(lefts), _single_letters(rights), "r_size"),
        ):
            bare = (F.col(single) == 1) & near
            meet(left, right, "letter", F.when(bare, LETTER_SCORE).otherwise(token_score))
    if not parts:
        return None
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    best = F.min(F.struct((-F.col("score")).alias("neg"), "place")).alias("best")
    out = found.where(F.col("score") >= cut).groupBy("norm").agg(best)
    return out.select("norm", (-F.col("best.neg")).alias("score"), "best.place")


def best_names(lefts: DataFrame, rights: DataFrame, threshold: float) -> DataFrame:
    """Best partner of each distinct name at or above the threshold.

    ``lefts`` has ``norm``; ``rights`` has ``norm`` and ``place``, a struct that sorts in
    list order. Returns ``(norm, score, place)`` with the unrounded score. Names are read
    several times, so what is settled early is written to the shared folder.
    """
    cut = threshold - 0.5  # scores are rounded before they are compared
    pairs = threshold >= PAIR_THRESHOLD
    rights = materialise(rights, "right-names")
    lefts = materialise(lefts.join(rights, "norm", "left"), "left-names")
    equal = lefts.where("place IS NOT NULL").select("norm", F.lit(100.0).alias("score"), "place")
    open_ = lefts.where("place IS NULL").select("norm")
    floors = _floors(open_, rights, cut, pairs)
    if floors is not None:
        open_ = materialise(open_.join(floors, "norm", "left"), "open-names")
        found = equal.union(open_.where("score IS NOT NULL"))
        open_ = open_.select("norm", F.coalesce("score", F.lit(cut)).alias("cut"))
    else:
        found = equal
        open_ = open_.withColumn("cut", F.lit(cut))
    scored = (
        _candidates(open_, rights, cut, pairs)
        .withColumn("score", similarity.combined(F.col("norm"), F.col("other"), cut))
        .where(F.col("score") >= cut)
        .join(rights.select(F.col("norm").alias("other"), "place"), "other")
        .select("norm", "score", "place")
    )
    best = F.min(F.struct((-F.col("score")).alias("neg"), "place")).alias("best")
    return (
        found.union(scored)
        .groupBy("norm")
        .agg(best)
        .select("norm", (-F.col("best.neg")).alias("score"), "best.place")
        .where(similarity.rounded(F.col("score")) >= threshold)
    )


def fuzzy_join(
    left: DataFrame,
    right: DataFrame,
    right_id: str,
    order: Sequence[str],
    threshold: float = 80,
    name: str = "name",
    only: Column | None = None,
) -> DataFrame:
    """Give each left row the id of the best-scoring right name.

    Adds ``right_id``, ``match_name`` and the rounded ``score``. Without a match an id the
    left row already had is kept, otherwise it is NULL. The same right name may serve
    many left rows; of right rows sharing a name the first by ``order`` gives the id,
    and of names with equal scores the one that comes first. With ``only``, other left
    rows pass through unmatched. The distinct names are written to the shared folder
    when this is called; the rows themselves are joined lazily.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    id_type = right.schema[right_id].dataType
    named = right.where(F.col(name).isNotNull()).select(
        normalise_name(F.col(name)).alias("norm"),
        F.struct(
            *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
            F.col(name).alias("name"),
            F.col(right_id).alias("id"),
        ).alias("place"),
    )
    rights = named.where("norm <> ''").groupBy("norm").agg(F.min("place").alias("place"))
    asked = normalise_name(F.col(name))
    keyed = left.withColumn("_norm", asked if only is None else F.when(only, asked))
    lefts = keyed.where("_norm <> ''").select(F.col("_norm").alias("norm")).distinct()
    best = best_names(lefts, rights, threshold).select(
        F.col("norm").alias("_norm"),
        F.col("place.id").alias("_id"),
        F.col("place.name").alias("match_name"),
        similarity.rounded(F.col("score")).alias("score"),
    )
    matched = join_unique(keyed, materialise(best, "best-names"), ["_norm"], "left")
    before = F.col(right_id) if right_id in left.columns else F.lit(None)
    kept = [c for c in left.columns if c != right_id]
    return matched.select(
        *kept,
        F.when(F.col("score").isNotNull(), F.col("_id")).otherwise(before.cast(id_type)).alias(right_id),
        "match_name",
        "score",
    )

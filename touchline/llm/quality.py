"""Quality rules as weak supervision.

Each rule looks at one share of a text and votes bad above one bound, good below another,
and abstains in between. Nobody says which rule is right: a document is either good or has
one of a few kinds of fault, and expectation maximisation over all documents estimates how
frequent each is and how each rule votes on it. A document is kept if its posterior
probability of being good is at least one half; so a bad vote that good documents get as
well, while all rules beside it vote good, does not reject it.

The start, that the rules of a fault vote bad on it and good elsewhere, stays as a prior of
``PRIOR`` documents of each kind, whatever the size of the table: enough to keep the kinds apart
where there is nothing to learn from, and outweighed by a few dozen documents. Documents matter
to the estimate only by their pattern of votes, and there are at most 3 to the number of
rules of those, so one count by pattern is all that leaves the executors.

The base rules are not voted on: under 50 words, or more than half of the words in
repeated three-word windows, is a rejection. A null or empty text has no words and fails.
Every row gets its own result, whatever its id or however often it is repeated; an empty
table gives no rows. Texts may be of any length. Only the named columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.text import SPACES, bytes_of, runs, whole_text, with_row
from touchline.session import Scratch

MIN_WORDS = 50
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_NOT_CHARS = SPACES + bytes(range(0x80, 0xC0))

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_marks", "n_distinct", "n_symbol_lines",
]


def _without(text: bytes, unwanted: bytes) -> int:
    return len(text.translate(None, unwanted))


def _repeated(words: list[bytes]) -> int:
    """Words that lie in three-word windows found at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    n, covered, reached = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered += i + 3 - max(i, reached)
            reached = i + 3
    return covered


def measure(text: bytes) -> tuple[int, ...]:
    """The ``MEASURES`` of one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n = len(text)
    return (
        len(words),
        _without(text, _NOT_CHARS),
        n - _without(text, _SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        n - _without(text, _UPPER),
        n - _without(text, _LOWER),
        text.count(b"!") + text.count(b"?"),
        len(set(words)),
        sum(_without(line, _SYMBOLS) < len(line) for line in lines),
    )


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all rules: 1 good, -1 bad, 0 none. One row per document."""
    words, lines, letters = m["n_words"], m["n_lines"], m["n_upper"] + m["n_lower"]
    # (share, votes good up to, votes bad from)
    rules = [
        (_share(m["n_symbols"], words), 0.01, 0.1),
        (_share(m["n_symbols"], m["word_chars"]), 0.003, 0.02),
        (_share(m["n_symbol_lines"], lines), 0.1, 0.5),
        (_share(m["n_dup_lines"], lines), 0.05, 0.4),
        (_share(m["n_repeat_words"], words), 0.1, 0.25),
        (1 - _share(m["n_distinct"], words), 0.65, 0.8),
        (_share(m["n_upper"], letters), 0.08, 0.3),
        (_share(m["n_marks"], words), 0.05, 0.3),
        (np.abs(_share(m["word_chars"], words) - 6), 2.0, 3.5),
    ]
    return np.stack([np.where(x >= bad, -1, np.where(x <= good, 1, 0)) for x, good, bad in rules], axis=1)


RULES = 9
FAULTS = [[0, 1, 2], [3, 4, 5], [6, 7, 8]]  # rules of symbols, of repetition, of the shape of words
PRIOR = 10  # documents that the start counts for, of each kind
GOOD, FAULT = 0.85, 0.05  # shares at the start
SOUND, FAULTY = (0.05, 0.15, 0.8), (0.6, 0.2, 0.2)  # votes bad, none, good at the start


def _measures(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """(first row, last row, their measures), a bounded number of bytes at a time."""
    data, at = bytes_of(batch.column(column))
    for first, last in runs(at, 8 << 20):
        rows = [measure(data[at[i] : at[i + 1]].tobytes()) for i in range(first, last)]
        yield first, last, dict(zip(MEASURES, np.array(rows, np.int64).T))


def _pattern(m: dict[str, np.ndarray]) -> np.ndarray:
    return (votes(m) + 1) @ 3 ** np.arange(RULES)


def _measurer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, m in _measures(batch, 2):
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(first, last - first) for i in (0, 1)]
                + [pa.array(m[k]) for k in MEASURES]
                + [pa.array(_pattern(m), pa.int32())],
                ["row", "doc_id", *MEASURES, "pattern"],
            )


def _pattern_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[int] = Counter()
    for batch in batches:
        for _, _, m in _measures(batch, 0):
            seen.update(_pattern(m).tolist())
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.keys(), pa.int32()), pa.array(seen.values(), pa.int64())], ["pattern", "n"]
    )


def _keeper(column: int, good: frozenset[int]):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, m in _measures(batch, column):
                failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
                sound = np.fromiter((x in good for x in _pattern(m).tolist()), bool, last - first)
                yield batch.slice(first, last - first).filter(pa.array(sound & ~failed))

    return keep


def estimate(patterns: np.ndarray, n: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of good by pattern, share of each kind, votes of each rule by kind).

    Kinds are good, then ``FAULTS``; votes are shares of bad, none and good. Given a document's
    kind, the rules vote independently of each other.
    """
    v = patterns[:, None] // 3 ** np.arange(RULES) % 3
    seen = (v[:, :, None] == np.arange(3)).astype(float)
    start = np.tile(np.array(SOUND), (1 + len(FAULTS), RULES, 1))
    for kind, rules in enumerate(FAULTS, 1):
        start[kind, rules] = FAULTY
    before = np.array([GOOD] + [FAULT] * len(FAULTS))
    vote, share, p = start, before, np.zeros((len(n), len(before)))
    for _ in range(rounds):
        gap = np.log(share) + np.einsum("prv,krv->pk", seen, np.log(vote))
        odds = np.exp(gap - gap.max(axis=1, keepdims=True))
        last, p = p, odds / odds.sum(axis=1, keepdims=True)
        if np.abs(last - p).max(initial=0) < 1e-9:
            break
        weight = p * n[:, None]
        vote = np.einsum("pk,prv->krv", weight, seen) + PRIOR * start
        vote /= vote.sum(axis=2, keepdims=True)
        share = (weight.sum(axis=0) + PRIOR * before) / (n.sum() + PRIOR)
    return p[:, 0], share, vote


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", number: str | None = None) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, the measures, base_failed, quality, kept."""
    spark = docs.sparkSession
    with Scratch(spark, "quality") as scratch:
        rows = with_row(docs, number, doc_id=F.col(doc_id).cast("long"), text=whole_text(text).cast("binary"))
        schema = "row long, doc_id long, " + ", ".join(f"{k} long" for k in MEASURES) + ", pattern int"
        measured = scratch.write(rows.select("row", "doc_id", "text").mapInArrow(_measurer, schema), "measured")
        seen = sorted(map(tuple, measured.groupBy("pattern").count().collect()))  # 3 ** RULES at most
        patterns, n = np.array(seen, np.int64).reshape(-1, 2).T
        p, _, _ = estimate(patterns, n)
        found = spark.createDataFrame(
            list(zip(patterns.tolist(), p.tolist())), "pattern int, quality double"
        )
        failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
        judged = measured.join(F.broadcast(found), "pattern").withColumn("base_failed", failed)
        return scratch.publish(
            judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop("pattern")
        )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject, all columns kept.

    A text is measured twice, to count the patterns of votes and to decide; nothing but the
    counts is shuffled or stored, and both times depend on the text alone.
    """
    body = docs.select(whole_text(text).cast("binary").alias("text"))
    counted = body.mapInArrow(_pattern_counter, "pattern int, n long").groupBy("pattern").agg(F.sum("n"))
    seen = sorted(map(tuple, counted.collect()))  # 3 ** RULES at most
    patterns, n = np.array(seen, np.int64).reshape(-1, 2).T
    p, _, _ = estimate(patterns, n)
    good = frozenset(patterns[p >= 0.5].tolist())
    return docs.mapInArrow(_keeper(docs.columns.index(text), good), docs.schema)

"""Personal data: patterns, and a semi-Markov conditional random field that adds to them.

The base finds e-mail addresses, IP addresses, card and phone numbers by four patterns and
drops matches that fail a test (parts over 255, Luhn, number of digits) without trying again.
So two numbers that touch, or a number written another way, are lost. The random field scores
whole candidate spans by features of the span: its groups of digits, separators, shape, the
Luhn sum, the range of its parts, the letters beside it. Dynamic programming over spans of at
most ``MOST`` tokens then chooses boundaries and kinds of a stretch of text together. Spans of
the base stay; what the field finds beside them is added.

The field is trained here, by conditional likelihood, on a bounded sample: at most ``PER_KIND``
stretches with a span of each kind and ``PLAIN`` without one, chosen by a hash of the stretch
among all of the table's, with the base's spans as labels. Stretches in which the base dropped a
match are left out, since their label is unknown. From labelled ones further examples are made:
two of them side by side, and spans written another way (no plus, ``(at)``, ``[.]``).

Places are code points, ends are exclusive. A null text counts as an empty one; a null id stays
null; repeated rows give repeated results; an empty table gives no rows; without any labelled
stretch only the base's spans are returned. The time is linear in the length of a text. Only
the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.text import whole_text
from touchline.session import Scratch

KINDS = ["email", "ip", "card", "phone"]
MOST = 40  # tokens of a span
REACH = 24  # code points around a digit or an at-sign that belong to its stretch
PER_KIND, PLAIN = 300, 700  # bounds of the sample
TRAIN_TOKENS = 64  # longer stretches are decoded but not trained on
ROUNDS, RATE, RIDGE = 150, 0.15, 0.02

Span = tuple[str, int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is entered at its start only: what fails there fails inside it as well.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]+")
_MARK = re.compile(r"[0-9@]+|\(at\)|\[at\]")
_AT = re.compile(r"@|\(at\)|\[at\]")
_TOKEN = re.compile(r"[A-Za-zÀ-ÿ]+|[0-9]+|\(at\)|\[at\]|.", re.DOTALL)
_NUMBER = set(" .-()[]+/_")
_SPACE = set(" \t\n\x0b\x0c\r")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        else:
            end = max(end, at)  # no match can reach over this at-sign, so runs are read once
        at = text.find("@", max(at + 1, end))


def base(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """The patterns' spans, by kind and start, and the matches dropped by a test."""
    kept: list[Span] = [("email", a, b) for a, b in _emails(text)]
    dropped = []
    tests = [
        ("ip", _IP, lambda s: _octets(s.split("."))),
        ("card", _CARD, lambda s: 13 <= len(d := "".join(_DIGITS.findall(s))) <= 19 and luhn(d)),
        ("phone", _PHONE, lambda s: 9 <= sum(map(len, _DIGITS.findall(s))) <= 15),
    ]
    for kind, pattern, test in tests:
        for m in pattern.finditer(text):
            if test(m.group()):
                kept.append((kind, *m.span()))
            elif sum(map(len, _DIGITS.findall(m.group()))) >= 9:
                dropped.append(m.span())
    return kept, dropped


def stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the text around digits and at-signs, cut at white space where there is some."""
    found: list[list[int]] = []  # first and last mark, and its end
    for m in _MARK.finditer(text):
        if found and m.start() - found[-1][1] <= 2 * REACH:
            found[-1][1] = m.end()
        else:
            found.append([m.start(), m.end()])
    out = []
    for a, b in found:
        low, high = max(0, a - REACH), min(len(text), b + REACH)
        if low:
            low = next((k + 1 for k in range(low, a) if text[k] in _SPACE), a)
        if high < len(text):
            high = next((k for k in range(high, b, -1) if text[k - 1] in _SPACE), b)
        out.append((low, high))
    return out


def tokens(text: str, low: int, high: int) -> list[int]:
    """Boundaries of the tokens of a stretch."""
    cuts = [m.start() for m in _TOKEN.finditer(text, low, high)]
    return [*cuts, high]


def _kind_of(c: str) -> str:
    if not c:
        return "edge"
    if c in _SPACE:
        return "space"
    return "digit" if c.isdigit() else "letter" if c.isalpha() else c if c in "+(@.-" else "mark"


def features(text: str, a: int, b: int) -> list[str]:
    """What is seen of a whole span."""
    span = text[a:b]
    groups = _DIGITS.findall(span)
    n = sum(map(len, groups))
    word = any(c.isalpha() for c in _AT.sub("", span))
    marks = "".join(sorted(set(re.sub(r"[A-Za-z0-9À-ÿ]", "", span))))
    out = ["any", f"start {_kind_of(span[0])}", f"end {_kind_of(span[-1])}", f"word {word}", f"marks {marks}"]
    out += [f"left {_kind_of(text[a - 1 : a])}", f"right {_kind_of(text[b : b + 1])}"]
    at = _AT.search(span)
    if at:
        out += ["at", f"at {at.group()}", f"at start {at.start() == 0}", f"ats {min(3, len(_AT.findall(span)))}"]
        out.append(f"last {bool(re.search(r'[.][A-Za-z]{2,}$', span))}")
        out.append(f"blank {any(c in _SPACE for c in span)}")
    if not word:
        out += [f"n {min(n, 24)}", f"groups {len(groups)}", "sizes " + ",".join(str(len(g)) for g in groups[:6])]
        out.append(f"phone length {9 <= n <= 15}")
        if 13 <= n <= 19:
            out.append(f"luhn {luhn(''.join(groups))}")
        if len(groups) == 4:
            out.append(f"octets {_octets(groups)}")
            out.append(f"between {'.' in span and not set(span) - set('0123456789.[]')}")
    return out


def candidates(text: str, cuts: list[int], taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Token ranges that may be a span: whole words or numbers, clear of the ``taken`` places."""
    for i in range(len(cuts) - 1):
        a = cuts[i]
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        if a and text[a].isalnum() and text[a - 1].isalnum():
            continue
        k = bisect_right(taken, (a, len(text)))
        if k and taken[k - 1][1] > a:
            continue
        stop = taken[k][0] if k < len(taken) else len(text)
        digits = groups = 0
        at = word = False
        for j in range(i, min(i + MOST, len(cuts) - 1)):
            token = text[cuts[j] : cuts[j + 1]]
            if cuts[j + 1] > stop or token in ("\n", "\r"):
                break
            if token.isdigit() and token.isascii():
                digits, groups = digits + len(token), groups + 1
            elif _AT.fullmatch(token):
                at = True
            elif token[0].isalpha():
                word = True
            elif token not in _NUMBER and token not in "%":
                break
            if (word or at) and token == " ":
                break  # an address has no blanks, a number no letters
            b = cuts[j + 1]
            if not text[b - 1].isalnum() or (b < len(text) and text[b].isalnum()):
                continue
            if at if word else digits >= 7 or groups == 4:
                yield i, j + 1


class Field(NamedTuple):
    """Weights: of each feature by kind, and of a kind after another (0: no span)."""

    weights: dict[str, np.ndarray]
    follows: np.ndarray

    def spans(self, text: str, known: list[Span]) -> list[Span]:
        """The best spans beside those already known, over the whole text."""
        taken = sorted((a, b) for _, a, b in known)
        merged: list[tuple[int, int]] = []
        for a, b in taken:
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        out = []
        for low, high in stretches(text):
            cuts = tokens(text, low, high)
            ranges = list(candidates(text, cuts, merged))
            if ranges:
                out += self._decode(text, cuts, ranges)
        return out

    def score(self, text: str, a: int, b: int) -> np.ndarray:
        total = np.zeros(len(KINDS))
        for f in features(text, a, b):
            w = self.weights.get(f)
            if w is not None:
                total = total + w
        return total

    def _decode(self, text: str, cuts: list[int], ranges: list[tuple[int, int]]) -> list[Span]:
        ends: dict[int, list[int]] = {}
        for i, j in ranges:
            ends.setdefault(j, []).append(i)
        best = np.full((len(cuts), len(KINDS) + 1), -np.inf)
        best[0, 0] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for t in range(1, len(cuts)):
            before = int(best[t - 1].argmax())
            best[t, 0] = best[t - 1, before]
            back[t, 0] = (t - 1, before)
            for i in ends.get(t, ()):
                ways = best[i][:, None] + self.follows
                gain = ways.max(0) + self.score(text, cuts[i], cuts[t])
                for k in np.flatnonzero(gain > best[t, 1:]):
                    best[t, 1 + k] = gain[k]
                    back[t, 1 + int(k)] = (i, int(ways[:, k].argmax()))
        out = []
        t, state = len(cuts) - 1, int(best[-1].argmax())
        while t:
            i, before = back[t, state]
            if state:
                out.append((KINDS[state - 1], cuts[i], cuts[t]))
            t, state = i, before
        return out


class _Lattice:
    """All examples' candidate spans, laid out for passes over all of them at once."""

    def __init__(self, examples: list[tuple[str, list[Span]]]):
        self.number: dict[str, int] = {}
        rows, spans, gold, self.last = [], [], [], []
        for text, labels in examples:
            cuts = tokens(text, 0, len(text))
            ranges = list(candidates(text, cuts, []))
            wanted = {(a, b): KINDS.index(k) for k, a, b in labels}
            held = {(cuts[i], cuts[j]) for i, j in ranges}
            if len(cuts) > TRAIN_TOKENS or not wanted.keys() <= held:
                continue
            whose = len(self.last)
            self.last.append(len(cuts) - 1)
            for i, j in ranges:
                a, b = cuts[i], cuts[j]
                rows.append([self.number.setdefault(f, len(self.number)) for f in features(text, a, b)])
                spans.append((whose, i, j))
                gold.append(wanted.get((a, b), -1))
        self.spans = np.array(spans, np.int64).reshape(-1, 3)
        self.gold = np.array(gold, np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.feature = np.array([f for r in rows for f in r], np.int64)
        self.width = max(self.last, default=0)
        by = lambda c: [np.flatnonzero(self.spans[:, c] == t) for t in range(self.width + 1)]
        self.starts, self.ends = by(1), by(2)
        # The kind before each labelled span.
        self.before = np.zeros(len(rows), np.int64)
        state = {(s, j): g + 1 for (s, _, j), g in zip(spans, gold) if g >= 0}
        for m, (s, i, _) in enumerate(spans):
            if gold[m] >= 0:
                self.before[m] = state.get((s, i), 0)

    def gradient(self, weights: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the mean log likelihood: seen less expected features and successions."""
        n, kinds = len(self.last), len(KINDS)
        score = np.zeros((len(self.spans), kinds))
        np.add.at(score, self.row, weights[self.feature])
        whose, first, last = self.spans.T
        ahead = np.full((n, self.width + 1, kinds + 1), -np.inf)
        ahead[:, 0, 0] = 0
        behind = np.full_like(ahead, -np.inf)
        sums = lambda x, axis: np.logaddexp.reduce(x, axis)
        for t in range(1, self.width + 1):
            ahead[:, t, 0] = sums(ahead[:, t - 1], 1)
            m = self.ends[t]
            if len(m):
                ways = sums(ahead[whose[m], first[m]][:, :, None] + follows, 1) + score[m]
                np.logaddexp.at(ahead[:, t, 1:], whose[m], ways)
        end = np.array(self.last)
        total = sums(ahead[np.arange(n), end], 1)
        behind[np.arange(n), end] = 0
        for t in range(self.width - 1, -1, -1):
            open_ = end > t
            behind[open_, t] = behind[open_, t + 1, :1]
            m = self.starts[t]
            if len(m):
                ways = sums(follows[None] + (score[m] + behind[whose[m], last[m], 1:])[:, None, :], 2)
                np.logaddexp.at(behind[:, t], whose[m], ways)
        inside = score + behind[whose, last][:, 1:] - total[whose, None]
        pairs = np.exp(ahead[whose, first][:, :, None] + follows + inside[:, None, :])
        expected = pairs.sum(1)
        seen = np.zeros_like(expected)
        labelled = np.flatnonzero(self.gold >= 0)
        seen[labelled, self.gold[labelled]] = 1
        up = np.zeros_like(weights)
        np.add.at(up, self.feature, (seen - expected)[self.row])
        next_ = -pairs.sum(0)
        np.add.at(next_, (self.before[labelled], self.gold[labelled]), 1)
        return up / n, next_ / n


def train(examples: list[tuple[str, list[Span]]]) -> Field | None:
    """Maximum likelihood with a ridge, by Adam's steps from zero; None without any span."""
    lattice = _Lattice(examples)
    if not (lattice.gold >= 0).any():
        return None
    x = [np.zeros((len(lattice.number), len(KINDS))), np.zeros((len(KINDS) + 1, len(KINDS)))]
    speed = [np.zeros_like(v) for v in x]
    power = [np.zeros_like(v) for v in x]
    for step in range(1, ROUNDS + 1):
        for k, g in enumerate(lattice.gradient(*x)):
            g = g - RIDGE / 100 * x[k]
            speed[k] = 0.9 * speed[k] + 0.1 * g
            power[k] = 0.99 * power[k] + 0.01 * g * g
            move = (speed[k] / (1 - 0.9**step)) / (np.sqrt(power[k] / (1 - 0.99**step)) + 1e-8)
            x[k] = x[k] + RATE * move
    return Field({f: x[0][k] for f, k in lattice.number.items()}, x[1])


def _rewritten(kind: str, span: str) -> list[str]:
    """Other ways to write a span, which the patterns do not find."""
    if kind == "phone":
        short = re.sub(r"^\+[0-9]{1,3}[ .-]*", "", span)
        return [short, re.sub(r"[()]", "", short).replace(" ", "-")]
    if kind == "email":
        return [span.replace("@", mark) for mark in ("(at)", "[at]")]
    if kind == "ip":
        return [span.replace(".", "[.]")]
    groups = "".join(_DIGITS.findall(span))
    return [".".join(groups[k : k + 4] for k in range(0, len(groups), 4))]


def examples(sample: list[tuple[str, list[Span]]]) -> list[tuple[str, list[Span]]]:
    """The sample, its pairs side by side, and its spans written another way."""
    out = list(sample)
    single = [(text, labels[0]) for text, labels in sample if len(labels) == 1]
    for k, (text, (kind, a, b)) in enumerate(single):
        other, (kind2, c, d) = single[(k * 7 + 3) % len(single)]
        first, second = text[a:b], other[c:d]
        gap = "  "[: 1 + k % 2]
        made = f"{text[:a]}{first}{gap}{second}{other[d:]}"
        if len(made) <= 4 * REACH + 80:
            out.append((made, [(kind, a, b), (kind2, b + len(gap), b + len(gap) + len(second))]))
        for new in _rewritten(kind, first):
            out.append((f"{text[:a]}{new}{text[b:]}", [(kind, a, a + len(new))]))
    return out


def _labelled(text: str) -> Iterator[tuple[str, list[Span]]]:
    """Stretches of a text with the base's spans in them; those with a dropped match are left out."""
    known, dropped = base(text)
    if not known and not _MARK.search(text):
        return
    for low, high in stretches(text):
        if any(a < high and low < b for a, b in dropped):
            continue
        inside = sorted({(a - low, b - low, k) for k, a, b in known if a < high and low < b})
        if any(a < 0 or b > high - low for a, b, _ in inside):
            continue
        if any(x[1] > y[0] for x, y in zip(inside, inside[1:])):
            continue
        yield text[low:high], [(k, a, b) for a, b, k in inside]


def _write(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), *s[1:])))


def _stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {}
        for text in batch.column(0).to_pylist():
            for part, labels in _labelled(text):
                found[part] = (_write(labels), ",".join(sorted({k for k, _, _ in labels})))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found.keys(), pa.string()),
                pa.array([v[0] for v in found.values()], pa.string()),
                pa.array([v[1] for v in found.values()], pa.string()),
            ],
            ["part", "labels", "kinds"],
        )


def _read(labels: str) -> list[Span]:
    return [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in labels.split(",") if s)]


def fit(docs: DataFrame, text: str = "text") -> Field | None:
    """A field trained on a bounded sample of the table's stretches."""
    with Scratch(docs.sparkSession, "personal") as scratch:
        body = docs.select(whole_text(text).alias("text"))
        parts = body.mapInArrow(_stretch_rows, "part string, labels string, kinds string")
        parts = scratch.write(parts.distinct(), "stretches")
        order = [F.xxhash64("part"), "part"]
        chosen = [(F.col("kinds") == "", PLAIN), *((F.col("kinds").contains(k), PER_KIND) for k in KINDS)]
        sample = {}
        for wanted, n in chosen:
            for r in parts.where(wanted).orderBy(*order).limit(n).collect():
                sample[r["part"]] = _read(r["labels"])
    return train(examples(list(sample.items())))


def _finder(field: Field | None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, known, every, added = [], [], [], []
            for text in batch.column(1).to_pylist():
                spans, _ = base(text)
                new = field.spans(text, spans) if field else []
                counts.append([sum(k == kind for k, _, _ in spans) for kind in KINDS])
                known.append(_write(spans))
                every.append(_write(spans + new))
                added.append(len(new))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            digest = [hashlib.sha256(s.encode()).hexdigest() for s in known]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digest), pa.array(every), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    return find


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """One row per row of ``docs``: the base's numbers and digest, all spans, number added.

    ``field`` is a trained one; without it one is fitted on ``docs``.
    """
    field = fit(docs, text) if field is None else field
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_finder(field), f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")

"""Batch scoring of name pairs with numpy, used inside Arrow UDFs.

Names arrive normalised. Scores run from 0 to 100 and follow the published
definitions: indel ratio ``100 * 2*LCS / (|a|+|b|)``, its token and partial
variants, and their weighted combination.
"""

from __future__ import annotations

import numpy as np

# Weights of the combined score and the length ratios they apply to.
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
LONG_PARTIAL_WEIGHT = 0.6
PARTIAL_FROM = 1.5
LONG_FROM = 8.0

_WORD = 64
_ROWS = 65536
_PAD_A, _PAD_B = 0xFFFFFFFF, 0xFFFFFFFE  # no code points, and never equal


def _lengths(strings: list[str]) -> np.ndarray:
    return np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))


def _codes(strings: list[str], pad: int) -> np.ndarray:
    """Code points as a matrix, one string per row; ``pad`` fills short rows."""
    size = _lengths(strings)
    width = int(size.max(initial=0))
    out = np.full((len(strings), width), pad, dtype=np.uint32)
    joined = "".join(strings).encode("utf-32-le", "surrogatepass")
    out[np.arange(width) < size[:, None]] = np.frombuffer(joined, dtype=np.uint32)
    return out


def _lcs_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """LCS lengths row by row, ``a`` at most 64 wide. Bit i of the state stands for a[:, i]."""
    n, width = a.shape
    state = np.full(n, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    bits = np.zeros((n, 8), dtype=np.uint8)
    for j in range(b.shape[1]):
        packed = np.packbits(a == b[:, j : j + 1], axis=1, bitorder="little")
        bits[:, : packed.shape[1]] = packed
        hit = state & bits.view(np.uint64).ravel()
        state = (state + hit) | (state - hit)
    used = ~state if width == _WORD else ~state & np.uint64((1 << width) - 1)
    return np.bitwise_count(used).astype(np.int64)


def _lcs_long(a: str, b: str) -> int:
    """The same recurrence on one Python integer, for names beyond 64 characters."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for ch in b:
        hit = state & where.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def _by_length(a: list[str], b: list[str]) -> tuple[list[str], list[str]]:
    """(shorter of each pair, longer of each pair)."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    return [x for x, _ in pairs], [y for _, y in pairs]


def lcs(a: list[str], b: list[str]) -> np.ndarray:
    """LCS length of each pair."""
    out = np.zeros(len(a), dtype=np.int64)
    short, longer = _by_length(a, b)
    size, reach = _lengths(short), _lengths(longer)
    for i in np.flatnonzero(size > _WORD):
        out[i] = _lcs_long(short[i], longer[i])
    fits = np.flatnonzero((size > 0) & (size <= _WORD))
    fits = fits[np.argsort(reach[fits], kind="stable")]
    for start in range(0, len(fits), _ROWS):
        rows = fits[start : start + _ROWS]
        x = _codes([short[i] for i in rows], _PAD_A)
        y = _codes([longer[i] for i in rows], _PAD_B)
        out[rows] = _lcs_words(x, y)
    return out


def indel(a: list[str], b: list[str]) -> np.ndarray:
    """Indel ratio of each pair; two empty strings are equal."""
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b)), dtype=np.int64, count=len(a))
    return np.where(total == 0, 100.0, 100.0 * (2 * lcs(a, b)) / np.maximum(total, 1))


def _window_bounds(m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every window of length ``m`` over ``n``, cut off at both ends."""
    shift = np.arange(1 - m, n)
    return np.maximum(shift, 0), np.minimum(shift + m, n)


def _partial_long(needle: str, hay: str) -> float:
    m = len(needle)
    bounds = zip(*_window_bounds(m, len(hay)))
    return max(100.0 * (2 * _lcs_long(needle, hay[s:e])) / (m + int(e - s)) for s, e in bounds)


def _partial_words(needles: list[str], hays: list[str]) -> np.ndarray:
    """Best window of each haystack for needles of at most 64 characters."""
    best = np.zeros(len(needles), dtype=np.float64)
    if not needles:
        return best
    m, n = _lengths(needles), _lengths(hays)
    bounds = [_window_bounds(x, y) for x, y in zip(m.tolist(), n.tolist())]
    owner = np.repeat(np.arange(len(needles)), m + n - 1)
    begin = np.concatenate([s for s, _ in bounds])
    end = np.concatenate([e for _, e in bounds])
    a, b = _codes(needles, _PAD_A), _codes(hays, _PAD_B)
    for at in range(0, len(owner), _ROWS):
        rows = slice(at, at + _ROWS)
        who, s, e = owner[rows], begin[rows], end[rows]
        place = s[:, None] + np.arange(int((e - s).max()))
        window = b[who[:, None], np.minimum(place, b.shape[1] - 1)]
        window[place >= e[:, None]] = _PAD_B
        ratio = 100.0 * (2 * _lcs_words(a[who], window)) / (m[who] + e - s)
        np.maximum.at(best, who, ratio)
    return best


def partial(a: list[str], b: list[str]) -> np.ndarray:
    """Best indel ratio of the shorter string against a window of the longer.

    Windows are as long as the shorter string, or cut off at either end of the longer.
    Strings of equal length are tried both ways.
    """
    short, longer = _by_length(a, b)
    best = np.zeros(len(short), dtype=np.float64)
    work, needles, hays = [], [], []
    for i, (x, y) in enumerate(zip(short, longer)):
        if not x:
            best[i] = 100.0 if not y else 0.0
        elif x in y:
            best[i] = 100.0
        else:
            both = [(x, y), (y, x)] if len(x) == len(y) else [(x, y)]
            for needle, hay in both:
                if len(needle) > _WORD:
                    best[i] = max(best[i], _partial_long(needle, hay))
                else:
                    work.append(i)
                    needles.append(needle)
                    hays.append(hay)
    if work:
        np.maximum.at(best, np.array(work), _partial_words(needles, hays))
    return best


def token_sets(a: list[str], b: list[str]) -> np.ndarray:
    """Token-set ratio: shared tokens are compared apart from the rest."""
    out = np.zeros(len(a), dtype=np.float64)
    rows, left, right, shared, totals = [], [], [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        tx, ty = set(x.split()), set(y.split())
        if not tx or not ty:
            continue
        both = tx & ty
        if both and (both == tx or both == ty):
            out[i] = 100.0
            continue
        dx, dy = " ".join(sorted(tx - both)), " ".join(sorted(ty - both))
        s = len(" ".join(both))
        gap = 1 if s else 0
        lx, ly = s + gap + len(dx), s + gap + len(dy)
        if s:
            out[i] = max(100.0 * (2 * s) / (s + lx), 100.0 * (2 * s) / (s + ly))
        rows.append(i)
        left.append(dx)
        right.append(dy)
        shared.append(s + gap)
        totals.append(lx + ly)
    if rows:
        joint = 100.0 * (2 * (lcs(left, right) + np.array(shared))) / np.array(totals)
        out[rows] = np.maximum(out[rows], joint)
    return out


def _sorted(s: str) -> str:
    return " ".join(sorted(s.split()))


def _window_floor(a: list[str], b: list[str], cut: np.ndarray) -> np.ndarray:
    """Pairs whose partial ratio may reach ``cut``: a window shares no more letters in
    order than the whole string does, and is no longer than the shorter one."""
    m = np.minimum(_lengths(a), _lengths(b))
    p = np.minimum(cut, 100.0) / 100.0
    return (cut <= 100.0) & (lcs(a, b) >= m * p / (2.0 - p) - 1e-9)


def combined(a: list[str], b: list[str], cut: float = 0.0) -> np.ndarray:
    """The combined score of each pair; an empty name scores 0.

    Exact from ``cut`` on. Parts that cannot lift a score to the cut are left out.
    """
    out = indel(a, b)
    near, far = [], []
    for i, (x, y) in enumerate(zip(a, b)):
        if not x or not y:
            out[i] = 0.0
        elif x != y:
            (near if max(len(x), len(y)) / min(len(x), len(y)) < PARTIAL_FROM else far).append(i)
    if near:
        x, y = [a[i] for i in near], [b[i] for i in near]
        by_token = np.maximum(
            indel([_sorted(s) for s in x], [_sorted(s) for s in y]), token_sets(x, y)
        )
        out[near] = np.maximum(out[near], by_token * TOKEN_WEIGHT)
    if far:
        x, y = [a[i] for i in far], [b[i] for i in far]
        size = np.maximum(_lengths(x), _lengths(y)) / np.minimum(_lengths(x), _lengths(y))
        weight = np.where(size <= LONG_FROM, PARTIAL_WEIGHT, LONG_PARTIAL_WEIGHT)
        whole = np.zeros(len(far))
        rows = np.flatnonzero(_window_floor(x, y, cut / weight))
        whole[rows] = partial([x[k] for k in rows], [y[k] for k in rows])
        by_token = np.zeros(len(far))
        rows, sx, sy, dx, dy = [], [], [], [], []
        for k, (p, q) in enumerate(zip(x, y)):
            tp, tq = set(p.split()), set(q.split())
            if tp & tq:
                by_token[k] = 100.0
            else:
                rows.append(k)
                sx.append(_sorted(p)), sy.append(_sorted(q))
                dx.append(" ".join(sorted(tp))), dy.append(" ".join(sorted(tq)))
        for left, right in ((sx, sy), (dx, dy)):
            need = cut / (TOKEN_WEIGHT * weight[rows]) if rows else np.zeros(0)
            use = np.flatnonzero(_window_floor(left, right, need)) if rows else []
            for k, score in zip(use, partial([left[k] for k in use], [right[k] for k in use])):
                by_token[rows[k]] = max(by_token[rows[k]], score)
        out[far] = np.maximum(
            out[far], np.maximum(whole * weight, by_token * TOKEN_WEIGHT * weight)
        )
    return out

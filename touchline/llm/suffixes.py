"""Suffix arrays by linear grouping.

Phase one sorts suffixes into groups by their Lyndon prefix. Groups are taken in descending
order; each member's previous-smaller pointer leads to the nearest earlier suffix of a
lower group, which is moved to a new group at the upper end of its own, the higher the more
members in a row point to it. Phase two walks the order from its least suffix and sets each
suffix before the one at hand, and those its pointers lead to, at the front of their groups.
No names are assigned again and nothing recurses.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Suffixes of ``text`` in order. The last symbol must be its least and occur once."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    group, last, at = [0] * n, [0] * n, [0] * n  # a group is named by its first place
    first = 0
    for i, s in enumerate(order):
        if text[s] != text[order[first]]:
            first = i
        group[s], at[s], last[first] = first, i, i
    smaller = [-1] * n
    top = n - 1
    while top >= 0:
        g = group[order[top]]
        members = sorted(order[g : top + 1]) if top > g else [order[g]]
        run: dict[int, int] = {}  # pointed-to suffix: members in a row
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > g:
                p = smaller[p]
            if p >= 0:
                if group[p] == g:
                    p = smaller[p]
                if p >= 0:
                    run[p] = run.get(p, 0) + 1
            smaller[s] = p
        if run:
            _move(run, order, group, last, at)
        top = g - 1
    free = list(range(n))
    done = bytearray(n)
    order[0] = n - 1
    done[n - 1] = 1
    for i in range(n):
        s = order[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            order[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = smaller[s]
    return order


def _move(run: dict[int, int], order: list[int], group: list[int], last: list[int], at: list[int]) -> None:
    """Give the suffixes of each (run length, group) a group of their own, long runs uppermost."""
    if len(run) == 1:
        shares = [[next(iter(run))]]
    else:
        parts: dict[tuple[int, int], list[int]] = {}
        for s, k in run.items():
            parts.setdefault((-k, group[s]), []).append(s)
        shares = [parts[k] for k in sorted(parts)]
    for share in shares:
        g = group[share[0]]
        end = last[g]
        begin = end - len(share) + 1
        place = end
        for s in share:
            other, here = order[place], at[s]
            order[place], order[here] = s, other
            at[s], at[other] = place, here
            place -= 1
        if begin > g:
            last[g] = begin - 1
            last[begin] = end
            for s in share:
                group[s] = begin


def common_prefixes(text: Sequence[int], order: Sequence[int]) -> list[int]:
    """Length of the common prefix of each suffix and the one before it in the order."""
    n = len(text)
    before, out, k = [-1] * n, [0] * n, 0
    rank = [0] * n
    for i in range(1, n):
        before[order[i]] = order[i - 1]
    for i, s in enumerate(order):
        rank[s] = i
    for s in range(n):
        p = before[s]
        if p < 0:
            k = 0
            continue
        while s + k < n and p + k < n and text[s + k] == text[p + k]:
            k += 1
        out[rank[s]] = k
        k = max(0, k - 1)
    return out

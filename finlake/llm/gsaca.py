"""Suffix sorting by groups: linear grouping construction.

Phase 1 groups the suffixes by their Lyndon prefix. It starts with groups of equal first
symbol and processes groups from the highest down. Every suffix of the group
points to the nearest suffix to its left that is in a lower group; those pointed
at are longer by as many copies of the group's prefix as pointers meet there, so
they move, most pointers first, into new groups right behind their own.

Phase 2 emits the order: the suffix before one that is in place is the next of
its group, and so is the one it points at, and so on until one that is
in place already. No names are given to substrings and nothing is sorted
recursively; either phase is one pass.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of the suffixes of ``text`` (non-negative integers) in lexicographic order."""
    n = len(text) + 1
    symbols = np.r_[text.astype(np.int64) + 1, 0]  # the end is lower than everything
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    size = [0] * n  # by first place of the group, which names it
    for at, k in zip(first.tolist(), np.diff(np.r_[first, n]).tolist()):
        size[at] = k
    group_at = np.empty(n, np.int64)
    group_at[order] = np.repeat(first, np.diff(np.r_[first, n]))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    sa, group, where = order.tolist(), group_at.tolist(), place.tolist()
    lower = [-1] * n  # the nearest suffix to the left in a lower group

    end = n - 1
    while end >= 0:
        here = group[sa[end]]
        if here == end:  # one suffix
            s = sa[end]
            p = s - 1
            while p >= 0 and group[p] >= here:
                p = lower[p]
            lower[s] = p
            if p >= 0:
                old = group[p]
                last = old + size[old] - 1
                if last != old:
                    at, other = where[p], sa[last]
                    sa[at], sa[last] = other, p
                    where[other], where[p] = at, last
                    size[old] -= 1
                    size[last] = 1
                    group[p] = last
        else:
            pointers: dict[int, int] = {}
            for s in sorted(sa[here : end + 1]):
                p = s - 1
                while p >= 0 and group[p] >= here:
                    p = lower[p]
                lower[s] = p
                if p >= 0:
                    pointers[p] = pointers.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, k in pointers.items():
                by_count.setdefault(k, []).append(p)
            for k in sorted(by_count, reverse=True):
                moved: dict[int, list[int]] = {}
                for p in by_count[k]:
                    moved.setdefault(group[p], []).append(p)
                for old, them in moved.items():
                    last = old + size[old]
                    for p in them:
                        last -= 1
                        at, other = where[p], sa[last]
                        sa[at], sa[last] = other, p
                        where[other], where[p] = at, last
                    size[old] -= len(them)
                    size[last] = len(them)
                    for p in them:
                        group[p] = last
        end = here - 1

    out = [0] * n
    free = list(range(n))  # the next place of each group
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = lower[s]
    return np.array(out[1:], np.int64)

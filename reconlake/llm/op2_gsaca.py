"""Suffix arrays by linear grouping construction.

Phase 1 sorts suffixes into groups by their Lyndon prefixes, without renaming and
without recursion. Groups are processed in descending order. Each suffix of a group
has a pointer to its previous smaller suffix, the nearest one to its left that is in
a lower group; suffixes that are pointed to move to new groups right behind their
old ones, ordered by how often they are pointed to.

Phase 2 emits the order: suffixes are read in ascending order, and each one puts the
suffix before it, and that one's chain of previous smaller suffixes, at the next free
places of their groups.

A group is known by the first place of its interval in the order; a suffix that has
left a group is skipped when the group's turn comes.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: list[int]) -> list[int]:
    """Suffix order of ``text``, whose last symbol must be smaller than all others."""
    n = len(text)
    group, previous = _lyndon_groups(text, n)
    return _emitted(group, previous, n)


def _lyndon_groups(text: list[int], n: int) -> tuple[list[int], list[int]]:
    previous = [-1] * n
    members: list = [None] * (n + 1)
    size = [0] * (n + 1)
    start_by_end = [0] * (n + 1)
    # groups by first symbol
    symbols = np.array(text)
    order = np.argsort(symbols, kind="stable")
    start = np.flatnonzero(np.diff(symbols[order], prepend=-1))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(start, np.diff(start, append=n))
    group = group.tolist()
    order = order.tolist()
    for a, b in zip(start.tolist(), [*start[1:].tolist(), n], strict=True):
        members[a], size[a], start_by_end[b] = order[a:b], b - a, a

    wide = n + 1
    end = n
    while end:
        g = start_by_end[end]
        end = g
        if size[g] == 1:
            i = members[g][0] if len(members[g]) == 1 else next(i for i in members[g] if group[i] == g)
            p = i - 1
            while p >= 0 and group[p] > g:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                old = group[p]
                rest = size[old] - 1
                if rest:
                    new = old + rest
                    size[old], size[new] = rest, 1
                    group[p], members[new] = new, [p]
                    start_by_end[new + 1], start_by_end[new] = new, old
            continue
        own = [i for i in members[g] if group[i] == g]
        own.sort()
        times: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = previous[p]
            previous[i] = p
            if p in times:
                times[p] += 1
            else:
                times[p] = 1
        times.pop(-1, None)
        # by old group, then by count: a key is old * wide + count
        moved: dict[int, list[int]] = {}
        for p, often in times.items():
            key = group[p] * wide + often
            if key in moved:
                moved[key].append(p)
            else:
                moved[key] = [p]
        old = -1
        for key in sorted(moved, reverse=True):
            part = moved[key]
            if key // wide != old:
                if old >= 0 and new > old:
                    size[old], start_by_end[new] = new - old, old
                old = key // wide
                new = old + size[old]
            stop = new
            new -= len(part)
            for p in part:
                group[p] = new
            members[new], size[new], start_by_end[stop] = part, len(part), new
        if old >= 0 and new > old:
            size[old], start_by_end[new] = new - old, old
    return group, previous


def _emitted(group: list[int], previous: list[int], n: int) -> list[int]:
    order = [0] * n
    free = list(range(n))                # next free place of the group that starts there
    placed = [False] * n
    order[0], placed[n - 1] = n - 1, True
    for at in range(n):
        i = order[at] - 1
        while i >= 0 and not placed[i]:
            g = group[i]
            order[free[g]] = i
            free[g] += 1
            placed[i] = True
            i = previous[i]
    return order

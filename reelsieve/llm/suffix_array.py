"""Suffix arrays of integer sequences by linear grouping.

Phase 1 sorts the suffixes into groups by their Lyndon prefixes: groups are processed from the highest down, each
suffix of a group finds its previous smaller suffix (the nearest one before it that stands in a lower group), and these
move to new groups right after their old ones, those that more suffixes of the group point to further up. Phase 2 goes
through the array from the front and puts before each placed suffix its predecessor and the chain of previous smaller
ones at the front of their groups. No names are assigned anew and nothing recurses.
"""

from __future__ import annotations

from collections.abc import Sequence


def _groups(text: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """order (suffixes by group), start (of the group of each suffix, in order), prev (previous smaller suffix or -1)."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n  # where a suffix stands in order
    start = [0] * n
    size = [0] * n  # of the group that starts here
    at = 0
    for k, s in enumerate(order):
        place[s] = k
        if k and text[order[k - 1]] != text[s]:
            at = k
        start[s] = at
        size[at] += 1
    prev = [-1] * n
    end = n
    while end:
        first = start[order[end - 1]]
        group = sorted(order[first:end])
        pointed: dict[int, int] = {}
        for s in group:
            p = s - 1
            while p >= 0 and start[p] >= first:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            by_count: dict[int, list[int]] = {}
            for p, c in pointed.items():
                by_count.setdefault(c, []).append(p)
            for c in sorted(by_count, reverse=True):
                moved: dict[int, int] = {}  # group -> how many went to its end
                for p in by_count[c]:
                    g = start[p]
                    m = moved[g] = moved.get(g, 0) + 1
                    to = g + size[g] - m
                    other, here = order[to], place[p]
                    order[to], order[here] = p, other
                    place[p], place[other] = to, here
                for g, m in moved.items():
                    if m < size[g]:
                        new = g + size[g] - m
                        size[g] -= m
                        size[new] = m
                        for k in range(new, new + m):
                            start[order[k]] = new
        end = first
    return order, start, prev


def suffix_array(text: Sequence[int]) -> list[int]:
    """The starts of the suffixes in order; a suffix that is a prefix of another comes first."""
    n = len(text)
    if n < 2:
        return list(range(n))
    low = min(text) - 1
    _, start, prev = _groups([*text, low])  # the end mark, below all else
    out = [-1] * (n + 1)
    free = list(range(n + 1))  # by group start: its first place that isn't taken
    placed = bytearray(n + 1)
    out[0] = n
    placed[n] = 1
    for i in range(n + 1):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = start[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = prev[s]
    return out[1:]


def common_prefixes(text: Sequence[int], order: Sequence[int]) -> list[int]:
    """For each suffix in order, what it shares with the one before (0 for the first)."""
    n = len(text)
    place = [0] * n
    for k, s in enumerate(order):
        place[s] = k
    out, h = [0] * n, 0
    for s in range(n):
        if place[s]:
            t = order[place[s] - 1]
            while s + h < n and t + h < n and text[s + h] == text[t + h]:
                h += 1
            out[place[s]] = h
            h = max(0, h - 1)
        else:
            h = 0
    return out

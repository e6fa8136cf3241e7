"""Suffix arrays by grouping, without recursion or renaming.

Suffixes are grouped by their longest Lyndon prefix. Groups start as first
symbols and are taken in descending order. A member's previous smaller suffix is
the nearest position before it in a lower group, found along the pointers of
higher ones. That position's prefix is followed by the group's word as often as
the group has members pointing at it, so such positions move, by that number, to
new groups on top of their old one. When all groups are taken, each is a range
of the suffix array.

The order within a group is that of the suffixes that follow the group's word.
These are smaller, so walking the array upwards from the empty suffix meets each
of them before its group needs it, and the pointers lead to all suffixes it ends.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Start positions of the suffixes of ``symbols`` in ascending order."""
    pointer, begin = _group(symbols)
    return _emit(pointer, begin)


def _group(symbols: Sequence[int]) -> tuple[list[int], list[int]]:
    """Previous smaller suffix of each position (-1 without one), and where its group begins in the array."""
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)  # stable, so each group is in the order of positions
    place, begin = [0] * n, [0] * n
    end = [0] * (n + 1)  # by a group's begin, the position after its last
    at = 0
    for k, i in enumerate(order):
        if k and symbols[i] != symbols[order[k - 1]]:
            end[at], at = k, k
        place[i], begin[i] = k, at
    if n:
        end[at] = n
    pointer = [-1] * n
    top = n
    while top:
        low = begin[order[top - 1]]
        members = sorted(order[low:top])
        count: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and begin[j] >= low:
                j = pointer[j]
            pointer[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        moved: dict[int, dict[int, list[int]]] = {}
        for j, k in count.items():
            moved.setdefault(begin[j], {}).setdefault(k, []).append(j)
        for old, by_count in moved.items():
            for k in sorted(by_count, reverse=True):
                rows = by_count[k]
                last = end[old]
                for j in rows:  # to the end of the old group
                    last -= 1
                    other, p = order[last], place[j]
                    order[p], order[last] = other, j
                    place[other], place[j] = p, last
                if last > old:
                    for j in rows:
                        begin[j] = last
                    end[last], end[old] = end[old], last
        top = low
    return pointer, begin


def _emit(pointer: list[int], begin: list[int]) -> list[int]:
    n = len(pointer)
    out = [0] * n
    free = list(range(n))  # by a group's begin, its next free place

    def end_at(s: int, stop: int) -> None:
        i = s - 1
        while i != stop:
            at = begin[i]
            out[free[at]] = i
            free[at] += 1
            i = pointer[i]

    end_at(n, -1)
    for k in range(n):
        s = out[k]
        end_at(s, pointer[s])
    return out

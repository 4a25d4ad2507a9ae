"""Suffix arrays of many short strings at once, by linear grouping.

Phase one sorts suffixes into groups by their Lyndon prefix: groups are taken in
descending order; every member points to the nearest position on its left whose group
is smaller, and positions pointed to move to new groups right above their own, the
higher the more members point to them. Phase two goes through the order from its
least suffix and puts each position before it, and the chain of previous smaller
positions from there, at the front of its group. No part is renamed or sorted again.

All strings take their steps together, so that a step is a few array operations.
"""

from __future__ import annotations

import numpy as np


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each pair, one after the other."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)


def lyndon_groups(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First slot of every position's group in the sorted order, and its previous smaller position (-1: none)."""
    n, begin = len(symbols), bounds[:-1]
    owner = np.repeat(np.arange(len(begin)), np.diff(bounds))
    low = begin[owner]
    order = np.lexsort((symbols, owner))
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    fresh = np.r_[True, (symbols[order][1:] != symbols[order][:-1]) | (owner[1:] != owner[:-1])] if n else np.empty(0, bool)
    firsts = np.flatnonzero(fresh)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(firsts, np.diff(np.r_[firsts, n]))
    ends = np.zeros(n + 1, np.int64)
    ends[firsts] = np.r_[firsts[1:], n]
    previous = np.full(n, -1)
    pointed = np.zeros(n, bool)

    top = bounds[1:].copy()  # groups from here on are done
    at_work = np.flatnonzero(np.diff(bounds) > 0)
    while len(at_work):
        start = group[order[top[at_work] - 1]]
        members = order[ranges(start, top[at_work] - start)]
        own, floor = group[members], low[members]
        left = members - 1
        todo = np.flatnonzero(left >= floor)
        todo = todo[group[left[todo]] > own[todo]]
        while len(todo):  # larger groups are done and have their pointers
            left[todo] = previous[left[todo]]
            todo = todo[left[todo] >= 0]
            todo = todo[group[left[todo]] > own[todo]]
        left[left < floor] = -1
        previous[members] = left
        todo = np.flatnonzero(left >= 0)
        todo = todo[group[left[todo]] == own[todo]]
        while len(todo):  # neighbours in the group share their pointer
            left[todo] = previous[left[todo]]
            previous[members[todo]] = left[todo]
            todo = todo[left[todo] >= 0]
            todo = todo[group[left[todo]] == own[todo]]
        top[at_work] = start
        at_work = at_work[start > begin[at_work]]

        moved, times = np.unique(left[left >= 0], return_counts=True)
        if not len(moved):
            continue
        by = np.lexsort((times, group[moved]))
        moved, times = moved[by], times[by]
        block = group[moved]
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        size = np.diff(np.r_[first, len(moved)])
        tail = ends[block[first]] - size
        target = ranges(tail, size)
        here = slot[moved]
        pointed[here] = True
        free = here[here < np.repeat(tail, size)]
        taken = target[~pointed[target]]
        pointed[here] = False
        others = order[taken]
        order[free], slot[others] = others, free
        order[target], slot[moved] = moved, target
        ends[block[first]] = tail
        part = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (times[1:] != times[:-1])])
        many = np.diff(np.r_[part, len(moved)])
        group[moved] = np.repeat(target[part], many)
        ends[target[part]] = target[part] + many
    return group, previous


def suffix_order(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Positions of every string's suffixes in ascending order, string by string.

    String s is symbols[bounds[s]:bounds[s + 1]] and ends with a symbol that is less
    than all its others.
    """
    group, previous = lyndon_groups(symbols, bounds)
    n = len(symbols)
    order, fill, placed = np.full(n, -1), np.arange(n), np.zeros(n, bool)
    at_work = np.flatnonzero(np.diff(bounds) > 0)
    at, end, low = bounds[:-1][at_work], bounds[1:][at_work], bounds[:-1][at_work]
    order[at], placed[end - 1] = end - 1, True
    fill[at] += 1
    now = end - 2
    while len(at):
        put = now >= low
        put[put] = ~placed[now[put]]
        move = np.flatnonzero(put)
        who = now[move]
        where = group[who]
        order[fill[where]] = who
        fill[where] += 1
        placed[who] = True
        now[move] = previous[who]
        step = np.flatnonzero(~put)
        at[step] += 1
        over = at[step] >= end[step]
        if over.any():
            now[step[~over]] = order[at[step[~over]]] - 1
            keep = np.ones(len(at), bool)
            keep[step[over]] = False
            at, end, low, now = at[keep], end[keep], low[keep], now[keep]
        else:
            now[step] = order[at[step]] - 1
    return order

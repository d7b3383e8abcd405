"""Suffix sorting by grouping (Baier, "Linear-time Suffix Sorting - A New Approach for Suffix
Array Construction", 2016).

A suffix's Lyndon prefix ends where the next smaller suffix begins. The first phase groups
suffixes of equal Lyndon prefix, the second puts each group in order. There is no recursion
and nothing is renamed.
"""

from __future__ import annotations

import numpy as np


#: Groups of this size or more are handled in numpy.
WIDE = 64


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of ``values`` (integers of any kind) in ascending order.

    A suffix that is a prefix of another comes first. Linear in ``len(values)``; no values, no
    positions.
    """
    n = len(values)
    if n == 0:
        return np.zeros(0, np.int64)
    groups = _Groups(np.asarray(values))
    groups.refine()
    return np.array(_emit(groups.previous[:n].tolist(), groups.name[:n].tolist(), n), np.int64)


class _Groups:
    """Groups of suffixes by their Lyndon prefixes, as far as they are known.

    A group is a slice of ``order`` named by its first index, so that names compare like groups;
    ``place`` is a position's index in ``order``, ``end`` where a group's slice ends, and ``previous`` a
    position's previous smaller one. The entry behind the last (index -1) stands for "none". Narrow
    groups go through memory views of the same arrays, which are quicker for single numbers.
    """

    def __init__(self, values: np.ndarray):
        n = self.n = len(values)
        self.order = np.argsort(values, kind="stable").astype(np.int64)
        ordered = values[self.order]
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        ends = np.append(starts[1:], n)
        self.name = np.full(n + 1, -1, np.int64)
        self.name[self.order] = np.repeat(starts, ends - starts)
        self.place = np.empty(n, np.int64)
        self.place[self.order] = np.arange(n)
        self.end = np.zeros(n + 1, np.int64)
        self.end[starts] = ends
        self.previous = np.full(n + 1, -1, np.int64)
        self.marked = np.zeros(n, bool)

    def refine(self) -> None:
        """Take the groups from the highest down. All above are final, hence a walk to the left from
        a member, along pointers already known, stops at its previous smaller position; no position
        is passed twice. Positions that m members point to grow their Lyndon prefix by the group's
        m times: they move to the upper end of their own group, those of larger m first."""
        name, order = memoryview(self.name), memoryview(self.order)
        top = self.n
        while top:
            this = name[order[top - 1]]
            if top - this >= WIDE:
                self._wide(this, top)
            else:
                self._narrow(this, top)
            top = this

    def _narrow(self, this: int, top: int) -> None:
        name, previous = memoryview(self.name), memoryview(self.previous)
        pointed: dict[int, int] = {}
        for i in sorted(self.order[this:top].tolist()) if top - this > 1 else (memoryview(self.order)[this],):
            j = i - 1
            while j >= 0 and name[j] >= this:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        counts = set(pointed.values())
        if len(counts) == 1:
            self._raise(list(pointed))
        else:
            for m in sorted(counts, reverse=True):
                self._raise([j for j, c in pointed.items() if c == m])

    def _wide(self, this: int, top: int) -> None:
        name, previous = self.name, self.previous
        members = np.sort(self.order[this:top])
        to = members - 1
        above = np.flatnonzero(name[to] > this)
        while len(above):
            to[above] = previous[to[above]]
            above = above[name[to[above]] > this]
        previous[members] = to  # of members that point to members the pointers are doubled
        alike = np.flatnonzero(name[to] == this)
        while len(alike):
            to[alike] = previous[to[alike]]
            previous[members[alike]] = to[alike]
            alike = alike[name[to[alike]] == this]
        pointed, counts = np.unique(to[to >= 0], return_counts=True)
        for m in np.unique(counts)[::-1].tolist():
            chosen = pointed[counts == m]
            if len(chosen) >= WIDE:
                self._raise_wide(chosen)
            else:
                self._raise(chosen.tolist())

    def _raise(self, chosen: list[int]) -> None:
        """Make the chosen positions of each group a group of their own right above the rest of it."""
        name, order, place, end = (memoryview(a) for a in (self.name, self.order, self.place, self.end))
        for j in chosen:
            g = name[j]
            last = end[g] - 1
            end[g] = last
            here, other = place[j], order[last]
            order[here], order[last] = other, j
            place[other], place[j] = here, last
        names = [end[name[j]] for j in chosen]
        for j, g in zip(chosen, names):
            name[j] = g
            end[g] = g
        for g in names:
            end[g] += 1

    def _raise_wide(self, chosen: np.ndarray) -> None:
        """The same in numpy: what stands at the upper ends and isn't chosen changes place with the chosen below."""
        name, order, place, end = self.name, self.order, self.place, self.end
        chosen = chosen[np.argsort(name[chosen], kind="stable")]
        old, which, counts = np.unique(name[chosen], return_inverse=True, return_counts=True)
        ends = end[old]
        new = ends - counts
        low = chosen[place[chosen] < new[which]]
        if len(low):
            self.marked[chosen] = True
            slots = np.arange(len(chosen)) + np.repeat(new - np.cumsum(counts) + counts, counts)
            there = order[slots]
            there = there[~self.marked[there]]
            self.marked[chosen] = False
            holes, tops = place[low], place[there]
            order[holes], place[there] = there, holes
            order[tops], place[low] = low, tops
        name[chosen] = new[which]
        end[old] = new
        end[new] = ends


def _emit(previous: list[int], group: list[int], n: int) -> list[int]:
    """Suffixes in order: whenever one is known, those that end their Lyndon prefix right before
    it are the next of their groups. They are its left neighbour and, from there, the
    previous smaller positions up to one that is already out. The empty suffix starts it."""
    front = list(range(n))
    out = [0] * n
    todo = bytearray(b"\1") * n + b"\0"  # the last entry, index -1, stands for "none"
    at = n
    for i in range(n + 1):
        j = at - 1
        while todo[j]:
            todo[j] = 0
            g = group[j]
            p = front[g]
            out[p] = j
            front[g] = p + 1
            j = previous[j]
        if i < n:
            at = out[i]
    return out

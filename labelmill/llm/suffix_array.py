"""A suffix array by linear grouping, without recursion or renaming.

First the suffixes are grouped by their Lyndon prefixes: groups start as the
suffixes with one first symbol and are taken in descending order. Every suffix of
a group has a previous smaller suffix, the nearest one to the left in a lower
group, found by following the pointers of those in between. The suffixes that are
pointed at are lifted out of their groups into new ones right above, those pointed
at most often highest. Then the groups' own order follows: passing over the sorted
suffixes from the smallest, the suffix before each, and the previous smaller ones
from there, come next in their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in order. The last symbol must be smaller than all others and occur once."""
    n = len(symbols)
    if n == 0:
        return np.empty(0, np.int64)
    if n > 1 and not (symbols[:-1] > symbols[-1]).all():
        raise ValueError("the last symbol must be the smallest and stand alone")
    by_symbol = np.argsort(symbols, kind="stable")
    ranked = symbols[by_symbol]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    heads = np.flatnonzero(fresh)
    head_of = np.empty(n, np.int64)
    head_of[by_symbol] = heads[np.cumsum(fresh) - 1]
    group: list[int] = head_of.tolist()
    order: list[int] = by_symbol.tolist()
    place_of = np.empty(n, np.int64)
    place_of[by_symbol] = np.arange(n)
    place: list[int] = place_of.tolist()
    size = [0] * n
    for head, count in zip(heads.tolist(), np.diff(np.concatenate([heads, [n]])).tolist()):
        size[head] = count
    before = [-1] * n

    end = n
    while end > 0:
        head = group[order[end - 1]]
        if end - head == 1:
            s = order[head]
            p = s - 1
            while p >= 0 and group[p] >= head:
                p = before[p]
            before[s] = p
            if p >= 0:
                old = group[p]
                count = size[old]
                if count > 1:
                    last = old + count - 1
                    at = place[p]
                    if at != last:
                        other = order[last]
                        order[at] = other
                        place[other] = at
                        order[last] = p
                        place[p] = last
                    group[p] = last
                    size[last] = 1
                    size[old] = count - 1
        else:
            pointed: dict[int, int] = {}
            for s in sorted(order[head:end]):
                p = s - 1
                while p >= 0 and group[p] >= head:
                    p = before[p]
                before[s] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, count in pointed.items():
                by_count.setdefault(count, []).append(p)
            for count in sorted(by_count, reverse=True):
                lifted: dict[int, list[int]] = {}
                for p in by_count[count]:
                    lifted.setdefault(group[p], []).append(p)
                for old, members in lifted.items():
                    rest = size[old] - len(members)
                    if not rest:
                        continue
                    last = old + size[old]
                    for p in members:
                        last -= 1
                        at = place[p]
                        if at != last:
                            other = order[last]
                            order[at] = other
                            place[other] = at
                            order[last] = p
                            place[p] = last
                    for p in members:
                        group[p] = last
                    size[last] = len(members)
                    size[old] = rest
        end = head

    out = [0] * n
    following = list(range(n))
    out[0] = n - 1
    following[group[n - 1]] += 1
    placed = bytearray(n)
    placed[n - 1] = 1
    for i in range(n):
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[following[g]] = s
            following[g] += 1
            placed[s] = 1
            s = before[s]
    return np.array(out, np.int64)

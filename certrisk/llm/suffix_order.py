"""Suffix order of a sequence of symbols by grouping on Lyndon prefixes, without recursion.

Suffixes start in one group per symbol. Groups are taken in descending order. For each member
the nearest earlier position that is not in a group already taken (previous-smaller
pointers) is found; that earlier suffix's group prefix is extended by the member's, as often as
members follow each other, which splits the earlier suffix's group. When all groups are
taken, suffixes of a group share their longest Lyndon prefix. A suffix is that prefix followed by
the suffix behind it, so walking over the order from its start and putting every suffix that ends its
prefix where the walk stands at the head of its group gives the order itself.
"""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in ascending order; a suffix that is a prefix of another comes first."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    distinct, first = np.unique(symbols, return_inverse=True)
    group = first.tolist()
    m = len(distinct)
    members: list[list[int]] = [[] for _ in range(m)]
    for place, g in enumerate(group):
        members[g].append(place)
    length = [1] * m
    lower, upper = list(range(-1, m - 1)), list(range(1, m + 1))
    upper[-1] = -1
    before = [-1] * n  # previous-smaller pointers
    taken = bytearray(n)
    chain_root, chain_size = [0] * n, [0] * n
    descending, g = [], m - 1
    while g >= 0:
        own = [s for s in members[g] if group[s] == g]
        members[g] = own
        roots = []
        for s in own:
            p = s - 1
            while p >= 0 and taken[p]:
                p = before[p]
            before[s] = p
            if p >= 0 and group[p] == g:
                root = chain_root[s] = chain_root[p]
                chain_size[root] += 1
            else:
                chain_root[s] = s
                chain_size[s] = 1
                if p >= 0:
                    roots.append(s)
        split: dict[int, dict[int, list[int]]] = {}
        for s in roots:
            p = before[s]
            split.setdefault(group[p], {}).setdefault(chain_size[s], []).append(p)
        for v, by_size in split.items():
            above, top = upper[v], v
            for size in sorted(by_size):
                new = len(length)
                length.append(length[v] + size * length[g])
                members.append(by_size[size])
                lower.append(top)
                upper.append(above)
                upper[top] = new
                for p in by_size[size]:
                    group[p] = new
                top = new
            lower[above] = top
        for s in own:
            taken[s] = 1
        if own:
            descending.append(g)
        g = lower[g]
    head, at = [0] * len(length), 0
    for g in reversed(descending):
        head[g] = at
        at += len(members[g])
    group_of = np.array(group)
    follows = np.arange(n) + np.array(length)[group_of]
    waiting = np.argsort(follows, kind="stable")
    starts = np.searchsorted(follows[waiting], np.arange(n + 2)).tolist()
    waiting = waiting.tolist()
    order = [0] * n
    for walk in range(-1, n):
        place = n if walk < 0 else order[walk]
        for k in range(starts[place], starts[place + 1]):
            s = waiting[k]
            order[head[group[s]]] = s
            head[group[s]] += 1
    return np.array(order)

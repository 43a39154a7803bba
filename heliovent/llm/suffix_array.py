"""Suffix arrays by linear grouping: no recursion on renamed strings."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes in ascending order; a suffix that is a prefix of another comes first.

    Suffixes are grouped by their Lyndon prefix. Groups begin as one per symbol and are taken in descending
    order. For every suffix of the group the previous smaller suffix is the nearest one to the left that is in no
    group handled so far; handled ones are skipped through their own pointers. The suffixes pointed at move out of their
    group into a new one just above it, those pointed at most often uppermost. In the end the groups are in
    order, and each group's own order is emitted in one pass: the suffixes before an emitted one, and those their
    pointers lead to, come next in their groups.
    """
    n = len(text) + 1  # places from 1, and an end below every symbol; place 0 stands for none
    symbols = np.asarray(text, np.int64)
    order = np.argsort(symbols, kind="stable")
    starts = np.flatnonzero(np.r_[n > 1, np.diff(symbols[order]) != 0])
    # a group's members; one that left has another number in ``group``, and a sole member stands by itself
    members: list = [[n], *(x.tolist() for x in np.split(order + 1, starts[1:]))] if n > 1 else [[n]]
    which = np.zeros(n + 1, np.int64)
    which[order + 1] = np.repeat(np.arange(1, len(members)), np.diff(np.r_[starts, n - 1]))
    group = which.tolist()
    size = [len(x) for x in members]
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    smaller = [-1] * (n + 1)  # -1: not handled so far
    g = len(members) - 1
    while g >= 0:
        own = members[g]
        if size[g] == 1:
            s = own
            if own.__class__ is list:
                for s in own:
                    if group[s] == g:
                        break
            p = s - 1
            q = smaller[p]
            while q >= 0:
                p = q
                q = smaller[p]
            smaller[s] = p
            if p:
                old = group[p]
                if size[old] > 1:  # to a new group of its own, just above
                    to = len(members)
                    members.append(p)
                    size.append(1)
                    size[old] -= 1
                    up = above[old]
                    above[old] = to
                    if up >= 0:
                        below[up] = to
                    below.append(old)
                    above.append(up)
                    group[p] = to
        elif size[g]:
            own = [s for s in own if group[s] == g]
            own.sort()
            times: dict[int, int] = {}
            for s in own:
                p = s - 1
                q = smaller[p]
                while q >= 0:
                    p = q
                    q = smaller[p]
                smaller[s] = p
                times[p] = times.get(p, 0) + 1
            times.pop(0, None)
            by_times = defaultdict(list)
            for p, k in times.items():
                by_times[k].append(p)
            for k in sorted(by_times, reverse=True):
                new: dict[int, int] = {}
                for p in by_times[k]:
                    old = group[p]
                    to = new.get(old)
                    if to is None:
                        if size[old] == 1:
                            continue
                        to = new[old] = len(members)
                        members.append([])
                        size.append(0)
                        up = above[old]
                        above[old] = to
                        if up >= 0:
                            below[up] = to
                        below.append(old)
                        above.append(up)
                    members[to].append(p)
                    size[to] += 1
                    size[old] -= 1
                    group[p] = to
        g = below[g]

    place, at, g = [0] * len(members), 0, 0
    while g >= 0:
        place[g] = at
        at += size[g]
        g = above[g]
    out = [0] * n
    out[0] = n
    group[0] = group[n] = -1  # -1: emitted, or none
    for i in out:  # grows ahead of the loop: a suffix is placed before its turn comes
        p = i - 1
        g = group[p]
        while g >= 0:
            group[p] = -1
            at = place[g]
            out[at] = p
            place[g] = at + 1
            p = smaller[p]
            g = group[p]
    return [i - 1 for i in out[1:]]

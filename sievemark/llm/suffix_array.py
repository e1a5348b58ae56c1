"""Linear-time suffix sorting by grouping Lyndon prefixes, without recursive renaming.

First phase: suffixes are grouped by their longest Lyndon prefix. Groups start as the characters and are taken in descending
order. Taking a group fixes, for each of its suffixes, the pointer to the previous smaller suffix: the nearest suffix to the
left that has not been taken yet. What a suffix points to has the Lyndon prefix of the group appended to its own, as often as
the group has suffixes that point to it; so the suffixes pointed to leave their group for new ones just above it, one for each count.

Second phase: groups lie in ascending order, and each has as many places as members. Suffixes of a group share their Lyndon
prefix and are ordered by what follows it, the next smaller suffix. So the places are filled by going through the finished part
of the order itself, from the empty suffix up: each suffix hands the next place of its group to all suffixes whose next smaller
suffix it is, which are found by following the pointers from its left neighbour.
"""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(text: Sequence[int]) -> tuple[list[list[int]], list[int]]:
    """Groups of suffixes with equal Lyndon prefixes, in descending order, and the pointer of every suffix to the previous smaller one (-1: none)."""
    n = len(text)
    by_char: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_char.setdefault(c, []).append(i)
    chars = sorted(by_char)
    members = [by_char[c] for c in chars]
    sizes = [len(m) for m in members]
    below = list(range(-1, len(chars) - 1))
    above = [*range(1, len(chars)), -1]
    group = [0] * n
    for g, m in enumerate(members):
        for i in m:
            group[i] = g
    smaller = [-1] * n
    taken = bytearray(n)
    finished: list[list[int]] = []
    at = len(chars) - 1
    while at >= 0:
        own = members[at]
        if sizes[at] == 1:  # the usual case, in short: one suffix, so that at most one leaves its group
            i = own[0] if len(own) == 1 else next(x for x in own if group[x] == at)
            j = i - 1
            while j >= 0 and taken[j]:
                j = smaller[j]
            smaller[i] = j
            taken[i] = 1
            finished.append([i])
            if j >= 0:
                g = group[j]
                if sizes[g] > 1:
                    new = len(members)
                    members.append([j])
                    sizes.append(1)
                    sizes[g] -= 1
                    over = above[g]
                    below.append(g)
                    above.append(over)
                    above[g] = new
                    if over >= 0:
                        below[over] = new
                    group[j] = new
            at = below[at]
            continue
        if sizes[at] == 2:  # the next usual case: two copies of a passage go side by side
            i, k = own if len(own) == 2 else (x for x in own if group[x] == at)
            if i > k:
                i, k = k, i
            j = i - 1
            while j >= 0 and taken[j]:
                j = smaller[j]
            smaller[i] = j
            taken[i] = 1
            l = k - 1
            while l >= 0 and taken[l]:
                l = smaller[l]
            smaller[k] = l
            taken[k] = 1
            finished.append([i, k])
            if j != l and j >= 0 and l >= 0 and group[j] == group[l]:
                moving = ((j, l),) if sizes[group[j]] > 2 else ()
            else:
                moving = ((j,),) if j == l else ((j,), (l,))
            for moved in moving:
                if moved[0] < 0:
                    continue
                g = group[moved[0]]
                if sizes[g] > len(moved):
                    new = len(members)
                    members.append(moved)
                    sizes.append(len(moved))
                    sizes[g] -= len(moved)
                    over = above[g]
                    below.append(g)
                    above.append(over)
                    above[g] = new
                    if over >= 0:
                        below[over] = new
                    for p in moved:
                        group[p] = new
            at = below[at]
            continue
        if len(own) > 1:
            own = sorted(i for i in own if group[i] == at) if len(own) != sizes[at] else sorted(own)
        counts: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and taken[j]:
                j = smaller[j]
            smaller[i] = j
            taken[i] = 1
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        finished.append(own)
        parents: dict[int, dict[int, list[int]]] = {}
        for p, k in counts.items():
            parents.setdefault(group[p], {}).setdefault(k, []).append(p)
        for g, by_count in parents.items():
            order = sorted(by_count)
            if sum(len(by_count[k]) for k in order) == sizes[g]:
                del order[0]  # nobody stays behind: the least count keeps the group
            last = g
            for k in order:
                moved = by_count[k]
                new = len(members)
                members.append(moved)
                sizes.append(len(moved))
                sizes[g] -= len(moved)
                over = above[last]
                below.append(last)
                above.append(over)
                above[last] = new
                if over >= 0:
                    below[over] = new
                for p in moved:
                    group[p] = new
                last = new
        at = below[at]
    return finished, smaller


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes of a text, in ascending order of the suffixes."""
    n = len(text)
    finished, smaller = lyndon_groups(text)
    place = [0] * n
    free: list[int] = []
    start = 0
    for g, own in enumerate(reversed(finished)):
        free.append(start)
        start += len(own)
        for i in own:
            place[i] = g
    out = [0] * n
    i, filled = n - 1, 0
    while i >= 0:  # the empty suffix comes first
        g = place[i]
        out[free[g]] = i
        free[g] += 1
        i = smaller[i]
    while filled < n:
        k = out[filled]
        stop = smaller[k]
        i = k - 1
        while i != stop:
            g = place[i]
            out[free[g]] = i
            free[g] += 1
            i = smaller[i]
        filled += 1
    return out

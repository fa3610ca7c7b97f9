"""Suffix array of one byte string in linear time, by suffix groups.

A *group* holds suffixes that share a prefix; groups are in order, and in the
end the suffixes of a group share their Lyndon prefix, the longest prefix that
is a Lyndon word.

1. Suffixes are grouped by their first byte. Groups are processed from the
   highest to the lowest. For each suffix of a group, the *previous smaller*
   suffix is the nearest one to the left in a lower group; it is found along
   the pointers of the higher groups. Those smaller suffixes go on with the
   group's Lyndon word, so each is moved to a new group just above its own;
   the more suffixes of the group point to it, the higher.
2. Suffixes of a final group differ only behind their Lyndon prefix, where a
   smaller suffix starts. So the order of each group is emitted from left to
   right: when a suffix's place is known, the suffix before it and those along
   its previous-smaller pointers take the next places of their groups.

Nothing is renamed and solved again. Every suffix is moved at most once per
suffix that points to it, so both steps are linear.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: bytes) -> np.ndarray:
    """Start positions of all suffixes of ``text`` in bytewise order (a suffix
    that is a prefix of another comes first). Empty text: no positions."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # Positions are 1 to n, an end mark below all bytes is at n + 1, and 0
    # stands for "no smaller suffix".
    codes = np.frombuffer(text, np.uint8)
    order = np.argsort(codes, kind="stable")
    sizes = np.bincount(codes, minlength=256)
    present = np.flatnonzero(sizes)
    rank = np.zeros(256, np.int64)
    rank[present] = np.arange(1, len(present) + 1)
    members = [[n + 1]] + [part.tolist() for part in np.split(order + 1, np.cumsum(sizes[present])[:-1])]
    group = [0, *rank[codes].tolist(), 0]
    size = [len(m) for m in members]
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    done = bytearray(n + 2)
    prev = [0] * (n + 2)
    final = []                                        # groups from the highest down
    g = len(members) - 1
    while g:
        own = members[g]
        if size[g] == 1:
            # One suffix left: it is the last list entry that still is in g.
            s = own[0] if len(own) == 1 else next(x for x in own if group[x] == g)
            p = s - 1
            while done[p]:
                p = prev[p]
            prev[s] = p
            done[s] = 1
            final.append(g)
            if p:
                old = group[p]
                if size[old] > 1:
                    size[old] -= 1
                    new = len(members)
                    members.append([p])
                    size.append(1)
                    group[p] = new
                    up = above[old]
                    above[old] = new
                    above.append(up)
                    below.append(old)
                    below[up] = new
        elif size[g]:
            if len(own) != size[g]:
                own = [x for x in own if group[x] == g]
            # Pointers never cross, so those to the same suffix are neighbours
            # and the suffixes pointed to come in ascending order.
            targets: dict[int, list[int]] = {}
            last, times = 0, 0
            for s in own:
                p = s - 1
                while done[p]:
                    p = prev[p]
                prev[s] = p
                done[s] = 1
                if p == last:
                    times += 1
                else:
                    if last:
                        targets.setdefault(times, []).append(last)
                    last, times = p, 1
            if last:
                targets.setdefault(times, []).append(last)
            final.append(g)
            for times in sorted(targets, reverse=True):
                moved: dict[int, list[int]] = {}
                for p in targets[times]:
                    moved.setdefault(group[p], []).append(p)
                for old, part in moved.items():
                    if len(part) == size[old]:
                        continue                      # the whole group: it stays where it is
                    size[old] -= len(part)
                    new = len(members)
                    members.append(part)
                    size.append(len(part))
                    for p in part:
                        group[p] = new
                    up = above[old]
                    above[old] = new
                    above.append(up)
                    below.append(old)
                    below[up] = new
        g = below[g]
    free = [0] * len(members)
    at = 1
    for g in reversed(final):
        free[g] = at
        at += size[g]
    out = [0] * (n + 1)
    out[0] = n + 1
    left = bytearray(b"\1") * (n + 2)                 # 1 while a suffix has no place
    left[0] = left[n + 1] = 0
    for i in range(n + 1):
        j = out[i] - 1
        while left[j]:
            left[j] = 0
            g = group[j]
            at = free[g]
            out[at] = j
            free[g] = at + 1
            j = prev[j]
    return np.array(out[1:], np.int64) - 1


def repeated_starts(text: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Those of ``starts`` (ascending) whose ``length`` bytes also stand at
    another of them. Neighbours in the suffix array are compared, eight bytes
    at a time; the bytes at a start must not run past the text."""
    if len(starts) < 2:
        return starts[:0]
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    order = suffix_array(text)
    order = order[wanted[order]]
    first, second = order[:-1], order[1:]
    codes = np.frombuffer(text, np.uint8)
    words = np.zeros(len(text) - 7, np.uint64) if len(text) >= 8 else np.zeros(0, np.uint64)
    for i in range(8 if len(words) else 0):
        words |= codes[i:i + len(words)].astype(np.uint64) << np.uint64(8 * i)
    equal = np.arange(len(first))
    for at in [*range(0, length - 7, 8)] if length >= 8 else []:
        equal = equal[words[first[equal] + at] == words[second[equal] + at]]
    for at in range(length - length % 8, length):
        equal = equal[codes[first[equal] + at] == codes[second[equal] + at]]
    return np.unique(np.concatenate([first[equal], second[equal]]))

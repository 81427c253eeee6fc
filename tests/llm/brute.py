"""Plain Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def components(texts: dict[int, str | None], k: int, similarity: int = 80) -> dict[int, int]:
    """The smallest id reachable over links, comparing all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    holders, common = defaultdict(list), defaultdict(int)
    for i in sorted(sets):
        for s in sets[i]:
            for j in holders[s]:
                common[j, i] += 1
            holders[s].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, j), n in common.items():
        if 100 * n >= similarity * (len(sets[i]) + len(sets[j]) - n):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return {i: find(i) for i in sets}


def tiles(doc: list, item: list, k: int) -> int:
    """How many tokens greedy string tiling covers, trying every pair of places."""
    used_d, used_i, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while (
                    i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n]
                    and not used_d[i + n] and not used_i[j + n]
                ):
                    n += 1
                if n >= k and n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if not n:
            return covered
        used_d[i : i + n], used_i[j : j + n] = [True] * n, [True] * n
        covered += n


def repeated_words(texts: dict[int, str], n: int) -> dict[int, set[int]]:
    """Places of the words of each text that stand in a run of n words of another text."""
    holders = defaultdict(set)
    split = {i: words(text) for i, text in texts.items()}
    for i, w in split.items():
        for at in range(len(w) - n + 1):
            holders[tuple(w[at : at + n])].add(i)
    return {
        i: {at + j for at in range(len(w) - n + 1) if holders[tuple(w[at : at + n])] - {i} for j in range(n)}
        for i, w in split.items()
    }

"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import xxhash


class Sets:
    """Union-find whose root is the smallest member."""

    def __init__(self, members):
        self.up = {x: x for x in members}

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64(b" ".join(words[i : i + size]), seed=42).intdigest() for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def simhash_components(texts: dict[int, str | None], max_bits: int = 2) -> dict[int, int]:
    codes, sets = {i: simhash(x) for i, x in texts.items()}, Sets(texts)
    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (codes[a] ^ codes[b]).bit_count() <= max_bits:
                sets.join(a, b)
    return {i: sets.root(i) for i in ids}


def shingles(line: str) -> set[str]:
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def line_links(lines: list[str]) -> set[tuple[str, str]]:
    sets, found = [(x, shingles(x)) for x in sorted(set(lines))], set()
    for n, (a, x) in enumerate(sets):
        for b, y in sets[n + 1 :]:
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
                found.add((a, b))
    return found


def removed_lines(texts: dict[int, str | None]) -> dict[int, list[int]]:
    """By document the numbers of the lines that repeat one of an earlier document or line."""
    places = [(i, n, line) for i in sorted(texts) for n, line in enumerate((texts[i] or "").split("\n")) if line.strip(" ")]
    sets = Sets({x for _, _, x in places})
    for a, b in line_links([x for _, _, x in places]):
        sets.join(a, b)
    seen, removed = set(), {i: [] for i in texts}
    for i, n, line in places:
        if sets.root(line) in seen:
            removed[i].append(n)
        seen.add(sets.root(line))
    return removed


def tiles(a: list, b: list, least: int) -> list[tuple[int, int, int]]:
    free_a, free_b, found = [True] * len(a), [True] * len(b), []
    while True:
        best, longest = [], least
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > longest:
                    best, longest = [(i, j, k)], k
                elif k == longest:
                    best.append((i, j, k))
        if not best:
            return found
        for i, j, k in best:
            if all(free_a[i : i + k]) and all(free_b[j : j + k]):
                found.append((i, j, k))
                free_a[i : i + k] = free_b[j : j + k] = [False] * k


def words(text: str | None) -> list[str]:
    return [x for x in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if x]


def covered(text: str | None, item: str | None, least: int = 5) -> float:
    a, b = ([x.encode().lower() for x in words(t)] for t in (text, item))
    seeds = {tuple(b[i : i + least]) for i in range(len(b) - least + 1)}
    if not any(tuple(a[i : i + least]) in seeds for i in range(len(a) - least + 1)):
        return 0.0
    return sum(n for _, _, n in tiles(a, b, least)) / len(b)

"""Plain versions of the operators' semantics, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


class Groups:
    """Disjoint sets over row numbers."""

    def __init__(self, n):
        self.up = list(range(n))

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def components(texts, k, percent):
    """The group of every row: rows link when their sets are similar enough; empty sets link with nothing."""
    sets, groups = [shingles(t, k) for t in texts], Groups(len(texts))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                groups.join(i, j)
    return [groups.root(i) for i in range(len(texts))]

"""Plain versions that the tests hold the operators against."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(low(text))


def shingles(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def components(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if i is not None and j is not None and s and t and 4 * min(len(s), len(t)) >= 3 * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= 75 * (len(s) + len(t) - both):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
    return [(i, len(s), None if i is None else root(i)) for i, s in sets]


def counts(rows, held):
    learnt = Counter()
    for i, t in rows:
        if not held(i):
            learnt.update([*words(t), None])
    return learnt

"""Brute-force twins of the training-data operators, in plain Python."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(UPPER))
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components(nodes, edges):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def similar_pairs(sets, num, den):
    """All pairs (i, j) of non-empty sets with den * |i & j| >= num * |i | j|."""
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    out = []
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] += 1
        out += [(j, i) for j, c in common.items() if den * c >= num * (len(s) + len(sets[j]) - c)]
    return out


def ngram_groups(rows, n_words, num, den):
    """rows: (doc_id, text), ids unique. {doc_id: (set size, component)}."""
    sets = [shingle_set(t, n_words) for _, t in rows]
    ids = [i for i, _ in rows]
    comp = components(ids, [(ids[a], ids[b]) for a, b in similar_pairs(sets, num, den)])
    return {i: (len(s), comp[i]) for i, s in zip(ids, sets, strict=True)}

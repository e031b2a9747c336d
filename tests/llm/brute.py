"""Plain Python versions of the corpus operators, for small inputs."""

import hashlib
from collections import Counter, defaultdict

import numpy as np


def words(text):
    return (text or "").encode().split()


class Sets:
    def __init__(self, size):
        self.parent = list(range(size))

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        self.parent[self.find(a)] = self.find(b)

    def least(self, ids):
        out = {}
        for k, i in enumerate(ids):
            if i is not None:
                out[self.find(k)] = min(out.get(self.find(k), i), i)
        return [out.get(self.find(k)) for k in range(len(ids))]


def repeats(rows, span=35):
    counts, split = Counter(), [words(t) for _, t in rows]
    for w in split:
        counts.update(tuple(w[j : j + span]) for j in range(len(w) - span + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for j in range(len(w) - span + 1):
            if counts[tuple(w[j : j + span])] > 1:
                gone[j : j + span] = [True] * span
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return out


def jaccard_components(rows, n=5, percent=75):
    sets = []
    for _, text in rows:
        w = [x.lower() for x in words(text)]
        sets.append({tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    groups, overlaps, joined = defaultdict(list), Counter(), Sets(len(rows))
    for k, s in enumerate(sets):
        for x in s:
            groups[x].append(k)
    for g in groups.values():
        overlaps.update((a, b) for i, a in enumerate(g) for b in g[i + 1 :])
    for (a, b), both in overlaps.items():
        if both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
            joined.join(a, b)
    return [(i, len(s), c) for (i, _), s, c in zip(rows, sets, joined.least([i for i, _ in rows]))]


def cosine_links(rows, threshold=0.98):
    usable = [k for k, (_, label, v) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    numbers, joined, by_label = [0] * len(rows), Sets(len(rows)), defaultdict(list)
    for k in usable:
        by_label[rows[k][1]].append(k)
    for ks in by_label.values():
        m = np.array([rows[k][2] for k in ks], np.float32).astype(float)
        m /= np.sqrt((m**2).sum(1))[:, None]
        near = m @ m.T >= threshold
        for a in range(len(ks)):
            for b in np.flatnonzero(near[a]):
                if a != b:
                    numbers[ks[a]] += 1
                    joined.join(ks[a], ks[b])
    least = joined.least([r[0] for r in rows])
    return [(r[0], n, c, r[0] == c) for r, n, c in zip(rows, numbers, least)]


def edited(rows):
    """doc_id, edited text and next text, in descending order of doc_id."""
    ordered = sorted(rows, reverse=True)
    out = {}
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        n = len(text) // 3
        out[i] = (text[: len(text) - n] + following[:n], following)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()

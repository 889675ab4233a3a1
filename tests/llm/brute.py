"""Plain, slow versions of the operators, straight from their contracts."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def repeats(rows, window):
    """rows: (doc_id, text). (doc_id, n_words, n_removed, kept_sha256) in the order given."""
    least = {}
    split = [words(t) for _, t in rows]
    for (d, _), w in zip(rows, split):
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                least[k] = min(least.get(k, d), d)
    out = []
    for (d, _), w in zip(rows, split):
        gone = [False] * len(w)
        if d is not None:
            for i in range(len(w) - window + 1):
                if least[tuple(w[i : i + window])] < d:
                    gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, n):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_groups(rows, n, percent):
    """(doc_id, n_shingles, component_id) in the order given; rows: (doc_id, text)."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    seen = set()
    for where in holders.values():
        for k, i in enumerate(where):
            for j in where[k + 1 :]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]

"""Brute-force versions of the operators, on small inputs."""

from __future__ import annotations

import re
import string


def words(text, fold=False):
    text = text or ""
    if fold:
        text = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, n=3):
    w = words(text, True)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def grouped(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for a, b in links:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def near_duplicates(rows, percent=85, n=3):
    sets = [shingles(t, n) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    shared = {}
    for ids in holders.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                shared[a, b] = shared.get((a, b), 0) + 1
    links = [(a, b) for (a, b), k in shared.items() if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k)]
    root = grouped(len(rows), links)
    low = {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            low[r] = min(d, low.get(r, d))
    return sorted((repr(d), len(s), low.get(r), d is not None and d == low.get(r)) for (d, _), s, r in zip(rows, sets, root))


def covered_units(texts, width):
    """Per text, which units lie in a window that starts more than once anywhere."""
    seen = {}
    for t in texts:
        for i in range(len(t) - width + 1):
            w = t[i:i + width]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        out.append(gone)
    return out


def without_word_repeats(rows, width):
    import hashlib
    texts = [tuple(words(t)) for _, t in rows]
    return sorted((repr(d), len(t), sum(g), hashlib.sha256(" ".join(w for w, x in zip(t, g) if not x).encode()).hexdigest())
                  for (d, _), t, g in zip(rows, texts, covered_units(texts, width)))


def without_byte_repeats(rows, width):
    import hashlib
    texts = [(t or "").encode() for _, t in rows]
    return sorted((repr(d), len(t), sum(g), sum(x and not (i and g[i - 1]) for i, x in enumerate(g)),
                   hashlib.sha256(bytes(b for b, x in zip(t, g) if not x)).hexdigest())
                  for (d, _), t, g in zip(rows, texts, covered_units(texts, width)))

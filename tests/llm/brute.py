"""Plain one-machine versions of the operators, for small tables."""

import hashlib
import re


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def near_groups(docs):
    """doc_id -> (number of shingles, component)."""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def exact_groups(docs):
    groups = {}
    for d, t in docs:
        groups.setdefault(lower(t), []).append(d)
    return {(d, max(g), len(g), d == max(g), hashlib.sha256(t.encode()).hexdigest())
            for t, g in groups.items() for d in g}


def hits(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = {}
    for item, t in items:
        w = words(t)
        for i in range(max(len(w) - 12, 1)) if w else ():
            windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    out = set()
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for window, ids in windows.items():
            n = len(window)
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) == window:
                    hit |= set(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.add((d, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def repeats(docs):
    texts = [(d, (t or "").encode()) for d, t in docs]
    first = {}
    for d, t in texts:
        for i in range(len(t) - 49):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], d), d)
    out = set()
    for d, t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - 49):
            if first[t[i:i + 50]] < d:
                gone[i:i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.add((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out

"""Plain versions of the operators, for small tables of (id, text)."""

from __future__ import annotations

import re
from collections import Counter

_BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BENCH_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, size):
    words = _BLANK_WORD.findall((text or "").translate(_LOWER))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_duplicates(docs, size, percent=80):
    sets = [shingle_set(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    out = []
    for a, (ident, _) in enumerate(docs):
        ids = [docs[b][0] for b in range(len(docs)) if root(b) == root(a)]
        ids = [i for i in ids if i is not None]
        out.append((ident, len(sets[a]), min(ids) if ids else None))
    return out


def without_repeats(docs, length):
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (ident, _), raw in zip(docs, raws):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((ident, bytes(b for b, g in zip(raw, gone) if not g), runs))
    return out


def without_passages(docs, length, least_words, long):
    """Repeated runs go if they have `least_words` words or `long` bytes."""
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (ident, _), raw in zip(docs, raws):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept, at = b"", 0
        for run in re.finditer(b"\1+", bytes(gone)):
            part = raw[run.start() : run.end()]
            if len(part) >= long or len(re.findall(rb"[^\x20\x09-\x0D]+", part)) >= least_words:
                kept, at = kept + raw[at : run.start()], run.end()
        out.append((ident, kept + raw[at:]))
    return out


def contamination(docs, items, size=10):
    out = []
    for ident, text in docs:
        words = _BENCH_WORD.findall((text or "").translate(_LOWER))
        hit, names = set(), set()
        for item, item_text in items:
            own = _BENCH_WORD.findall((item_text or "").translate(_LOWER))
            n = min(size, len(own))
            if item is None or not n:
                continue
            for s in range(len(own) - n + 1):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == own[s : s + n]:
                        hit.update(range(p, p + n))
                        names.add(str(item))
        out.append((ident, len(words), len(hit), tuple(sorted(names))))
    return out

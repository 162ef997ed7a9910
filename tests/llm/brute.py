"""Plain versions of operators, for small tables."""

import re
from collections import Counter

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, n):
    words = [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    size = min(n, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def components(sets, percent):
    """By position, the smallest position that links lead to."""
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


def contamination(texts, items, length=10):
    """Number of words, of words hit, and names of the items, by text."""
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) if w]
    windows = Counter()
    names = {}
    for name, text in items:
        words = split(text)
        size = min(length, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            names.setdefault(tuple(words[i : i + size]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in names}
    out = []
    for text in texts:
        words, hit, found = split(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (w := tuple(words[i : i + size])) in names:
                    hit |= set(range(i, i + size))
                    found |= names[w]
        out.append((len(words), len(hit), sorted(found)))
    del windows
    return out

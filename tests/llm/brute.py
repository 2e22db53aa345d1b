"""Plain Python versions of what the operators compute, for small inputs."""

import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, size):
    w = SPACE.findall(fold(text))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def components(rows, percent, size):
    """Component id by row of (doc_id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    both = Counter((a, b) for ids in by.values() for k, b in enumerate(ids) for a in ids[:k])
    for (a, b), c in both.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            up[root(b)] = root(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = root(i)
            least[r] = min(least.get(r, d), d)
    return [(least.get(root(i)) if sets[i] else rows[i][0], len(sets[i])) for i in range(len(rows))]


def repeats(rows, window):
    """(n_words, kept words) by row."""
    words = [SPACE.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), [x for j, x in enumerate(w) if j not in gone]))
    return out


def contamination(rows, items, n):
    """(n_words, n_hit, sorted item names) by row."""
    wanted = defaultdict(set)
    for name, text in items:
        w = ALNUM.findall(fold(text))
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            wanted[tuple(w[i : i + k])].add("null" if name is None else str(name))
    out = []
    for _, text in rows:
        w, hit, found = ALNUM.findall(fold(text)), set(), set()
        for k in {len(x) for x in wanted}:
            for i in range(len(w) - k + 1):
                if (x := tuple(w[i : i + k])) in wanted:
                    hit.update(range(i, i + k))
                    found |= wanted[x]
        out.append((len(w), len(hit), sorted(found)))
    return out

"""Plain Python versions of the operators' results, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def components(rows, width, percent):
    """{id: component} of (id, text) rows."""
    sets = {}
    for i, t in rows:
        if i is None:
            continue
        w = words(lower(t))
        sets.setdefault(i, []).append({tuple(w[j:j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {i: find(i) for i in sets}


def without_repeats(rows, width=13):
    """(id, words, removed, kept words) of each (id, text) row."""
    least = {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - width + 1):
            if i is not None:
                k = tuple(w[j:j + width])
                least[k] = min(i, least.get(k, i))
    out = []
    for i, t in rows:
        w, gone = words(t), set()
        for j in range(len(w) - width + 1):
            if i is not None and least[tuple(w[j:j + width])] < i:
                gone.update(range(j, j + width))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [s for _, _, s in sorted(found)]


def rule_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
    repeated = {j + k for j in range(len(w) - 2) if grams[tuple(w[j:j + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)

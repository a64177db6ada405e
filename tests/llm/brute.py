"""Plain statements of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\f\r"


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(rows):
    key = lambda line: line.strip(BLANK).translate(FOLD)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or doc == max(holders[key(x)])]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def decontamination(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def labelled(text, size=5):
    w, seen, out = words(text), Counter(), []
    k = min(size, len(w))
    for i in range(len(w) - k + 1 if w else 0):
        seen[tuple(w[i : i + k])] += 1
        out.append((tuple(w[i : i + k]), seen[tuple(w[i : i + k])]))
    return out


def in_order(a, b):
    """Symbols of b that an alignment with a keeps; no symbol occurs twice."""
    place = {x: i for i, x in enumerate(a)}
    tails = []
    for value in (place[x] for x in b if x in place):
        at = bisect_left(tails, value)
        tails[at : at + 1] = [value]
    return len(tails)


def near_duplicates(rows, similarity=0.8):
    """Class (smallest id) of each document; ids must be unique."""
    symbols = {doc: labelled(text) for doc, text in rows}
    root = {doc: doc for doc in symbols}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(symbols)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            x, y = symbols[a], symbols[b]
            if x and y and min(len(x), len(y)) >= similarity * max(len(x), len(y)) - 1e-9:
                kept = in_order(x, y)
                if kept >= similarity * (len(x) + len(y) - kept) - 1e-9:
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {doc: find(doc) for doc in docs}


def targets(sizes, weights=(3, 1, 2), share=1.5, limit=2):
    """Target by source, by resharing until nobody is above; null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        if not rest:
            break
        level = (total - sum(limit * sizes[s] for s in full)) / sum(weight[s] for s in rest)
        new = {s for s in rest if level * weight[s] > limit * sizes[s]}
        if not new:
            break
        full |= new
    return {s: limit * sizes[s] if s in full else level * weight[s] for s in order}

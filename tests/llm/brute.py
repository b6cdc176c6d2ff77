"""Plain-Python definitions of the training-data operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    own = words(lower(text))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def similar(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)


def components(sets):
    """The smallest reachable key of each key of a dict of sets."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if similar(sets[a], sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in keys}


def figures(text):
    text = text or ""
    own = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(repeated)


def targets(sizes):
    """Shares of all sizes by weights 1, 2, 3 in turn, none above three times its size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return {s: share.get(s, 3.0 * sizes[s]) for s in names}
        capped |= over


def digest(turns):
    """(turns_sha256, loss_chars, loss_sha256) of [(role, text)]."""
    text = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return sha(text), len(loss), sha(loss)


def by_key(rows, key):
    found = defaultdict(list)
    for row in rows:
        found[row[key]].append(row)
    return found

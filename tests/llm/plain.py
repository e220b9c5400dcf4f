"""Plain statements of what the operators on training text must find."""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np

BLANK = "[\x20\x09-\x0d]+"


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width, short):
    w = [x for x in re.split(BLANK, folded(text)) if x]
    if short and 0 < len(w) < width:
        return {tuple(w)}
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def closed(nodes, links):
    """Smallest node reachable by links."""
    top = {n: n for n in nodes}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(rows, width=2, percent=80):
    sets = {k: shingles(t, width, True) for k, t in rows if k is not None}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return closed(sets, links)


def contaminated(docs, items, width=5, containment=0.8):
    out = set()
    for i, text in items:
        item = shingles(text, width, False)
        for d, words in docs:
            n = len(item & shingles(words, width, False))
            if d is not None and i is not None and item and n >= np.ceil(len(item) * containment - 1e-9):
                out.add((d, i, len(item), n))
    return out


def without_repeats(rows, least):
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - least + 1):
            if key is not None:
                first[data[i : i + least]] = min(key, first.get(data[i : i + least], key))
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        for i in range(len(data) - least + 1):
            if key is not None and first[data[i : i + least]] < key:
                gone[i : i + least] = True
        gone = gone[: len(data)]
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((key, len(data), int(gone.sum()), spans, sha256(kept).hexdigest()))
    return out


def matches(pattern, text, keep, flags=0):
    return [(m.start(), m.end()) for m in re.finditer(pattern, text, flags) if keep(m)]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": matches(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text, lambda m: True),
        "ip": matches(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text, lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        "card": matches(r"[0-9]([\x20-]?[0-9])+", text, lambda m: 14 <= len(digits(m)) <= 19 and _luhn(digits(m))),
        "phone": matches(r"\+[0-9][\x20().0-9-]+[0-9]", text, lambda m: 10 <= len(digits(m)) <= 15),
    }


def secrets(text):
    assign = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    return {
        "assign": matches(assign, text, lambda m: len(m[2]) >= 12, re.I | re.A),
        "access": matches(r"AKIA[A-Z0-9]+", text, lambda m: len(m.group()) >= 18),
        "hex": matches(r"[0-9a-f]+", text, lambda m: len(m.group()) >= 16),
    }


def listed(found):
    order = list(found)
    spans = sorted((a, order.index(k), b) for k in found for a, b in found[k])
    return ",".join(f"{order[k]}:{a}:{b}" for a, k, b in spans)


def vectors(rows, cosine=0.9):
    """Links per row and smallest row reachable."""
    good = {}
    for key, v in rows:
        if key is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, dtype=float)
            good[key] = u / np.linalg.norm(u)
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and float(good[a] @ good[b]) >= cosine]
    keys = [k for k, _ in rows if k is not None]
    return {k: sum(k in pair for pair in links) for k in keys}, closed(keys, links)


def targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    """Deal by weight; what exceeds a source's limit goes to the others until none exceeds it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, free = {}, share * sum(sizes.values()), set(order)
    while free:
        whole = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / whole >= limit * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / whole for s in free}
        for s in over:
            out[s] = limit * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over
    return out

"""Plain-Python statements of the rules, written from their description, to test against."""

import re
from collections import Counter


def norm(s):
    low = s.lower()
    at = [i for i, c in enumerate(low) if c.isalnum()]
    return re.sub(r"\s+", " ", low[at[0] : at[-1] + 1]) if at else ""


def items(s):
    return list(dict.fromkeys(n for n in map(norm, re.split("[,;]+", s)) if n))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    total = len(a) + len(b)
    return 100 - 100 * (total - 2 * lcs(a, b)) / total if total else 100.0


def token_set(a, b):
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    both = " ".join(sorted(ta & tb))
    oa, ob = " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta))
    if both and (not oa or not ob):
        return 100.0
    with_a, with_b = f"{both} {oa}".strip(), f"{both} {ob}".strip()
    # the shared words stand in front of both, so only the rest is aligned
    distance = len(oa) + len(ob) - 2 * lcs(oa, ob)
    scores = [100 - 100 * distance / (len(with_a) + len(with_b))]
    if both:
        scores += [ratio(both, with_a), ratio(both, with_b)]
    return max(scores)


def first_max(counts):
    return max(counts, key=lambda k: counts[k])


def vote(answers, mode, threshold=85):
    said = [a.strip() for a in answers if a is not None and a.strip()]
    n = len(said)
    if not n:
        return "", 0.0
    if mode == "exact":
        counts = Counter(map(norm, said))
        top = first_max(counts)
        return top, round(counts[top] / n, 3)
    if mode == "set":
        counts = Counter(i for a in said for i in items(a))
        if not counts:
            return "", 0.0
        chosen = [i for i, c in counts.items() if 2 * c >= n] or [first_max(counts)]
        return ", ".join(chosen), round(sum(counts[i] for i in chosen) / (len(chosen) * n), 3)
    groups = []
    for a in map(norm, said):
        for g in groups:
            if token_set(g[0], a) >= threshold:
                g.append(a)
                break
        else:
            groups.append([a])
    top = max(groups, key=len)
    return first_max(Counter(top)), round(len(top) / n, 3)


def words(answers):
    counts = Counter(w for a in answers if a is not None for w in re.split(r"\s+", a.lower()))
    shared = [w for w, c in counts.items() if c > 1]
    return (" ".join(shared), len(shared) / len(counts)) if shared else ("no consensus", 0.0)


def simple(answers):
    said = [re.sub(r"\s+", " ", a.lower().strip()) for a in answers if a is not None]
    if not said:
        return "no responses", 0.0
    counts = Counter(said)
    top = first_max(counts)
    return top, round(counts[top] / len(said), 3)

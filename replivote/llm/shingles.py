"""Sets of hashed word shingles of whole texts, computed over a batch of texts at once."""

from __future__ import annotations

import numpy as np

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred so that each depends on all (a fixed bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
    up, down = np.full(n + 1, base, dtype=np.uint64), np.full(n + 1, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text: all hashes, sorted within a text, and where each text ends.

    A-Z are folded and words are ``[^\\x20\\x09-\\x0D]+``. A text of fewer than ``width``
    words has one shingle, the whole sequence; a text without words or null has none.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, dtype=np.int64)
    letters = _FOLD[data]
    inside = ~_BLANK[letters]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(letters.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        word = mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
        until = np.searchsorted(first, ends)  # words before each text's end
        counts = np.diff(until, prepend=0)
        owner = np.repeat(np.arange(len(raw)), counts)
        offset = np.arange(len(word)) - np.repeat(until - counts, counts)
        left = np.repeat(counts, counts) - offset
        starts = np.flatnonzero((left >= width) | (offset == 0))
        gram = np.zeros(len(starts), dtype=np.uint64)
        for k in range(width):
            at = starts + k
            has = left[starts] > k
            gram[has] = mixed(gram[has] * np.uint64(0xD6E8FEB86659FD93) + word[at[has]] + np.uint64(k + 1))
    owner = owner[starts]
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), dtype=bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    return gram, np.searchsorted(owner, np.arange(len(raw)), side="right")

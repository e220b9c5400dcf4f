"""Token-set similarity of two answers and its use inside Arrow functions."""

from __future__ import annotations

from array import array
from collections import Counter, deque
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def _places(text: str) -> dict[str, int]:
    """For each letter, its positions as the bits of a number."""
    places: dict[str, int] = {}
    if len(text) > 256:  # letter by letter of the alphabet is then cheaper than by place
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for code in np.unique(codes):
            places[chr(code)] = int.from_bytes(np.packbits(codes == code, bitorder="little").tobytes(), "little")
        return places
    for i, ch in enumerate(text):
        places[ch] = places.get(ch, 0) | (1 << i)
    return places


def _common(places: dict[str, int], length: int, other: str) -> int:
    """Longest common subsequence, one step of whole-number arithmetic per letter of ``other``."""
    full = (1 << length) - 1
    state = full
    for ch in other:
        hit = state & places.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
    return length - state.bit_count()


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if len(a) > len(b):
        a, b = b, a
    return _common(_places(a), len(a), b)


def _percent(distance: int, length: int) -> float:
    return 100 - 100 * distance / length if length else 100.0


def token_set_score(a: str, b: str) -> float:
    """0 to 100: best insert/delete similarity over shared and differing words."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared, only_a, only_b = left & right, left - right, right - left
    if shared and not (only_a and only_b):
        return 100.0
    a, b = " ".join(sorted(only_a)), " ".join(sorted(only_b))
    common = len(" ".join(sorted(shared)))
    gap = 1 if common else 0
    distance = len(a) + len(b) - 2 * common_subsequence(a, b)
    score = _percent(distance, 2 * (common + gap) + len(a) + len(b))
    if common:
        score = max(score, _percent(1 + len(a), 2 * common + 1 + len(a)), _percent(1 + len(b), 2 * common + 1 + len(b)))
    return score


def _needed(lengths: int, length: int, threshold: float) -> int:
    """Letters that two strings of these ``lengths`` together must share to leave ``threshold`` per cent of ``length``."""
    most = int((100 - threshold) * length / 100)
    while _percent(most + 1, length) >= threshold:
        most += 1
    while most >= 0 and _percent(most, length) < threshold:
        most -= 1
    return (lengths - most + 1) // 2 if most >= 0 else lengths + 1


def _shared_from(a: str, b: str, need: int) -> int:
    """Length of the longest common subsequence if it has ``need`` letters, else ``need - 1``, which it does not exceed.

    An alignment of so many letters strays from the diagonal by no more letters than it may
    leave out, so of ``a`` only the part within reach is looked at; and it ends as soon
    as the letters of ``b`` to come could not make up for those left out.
    """
    if len(a) > len(b):
        a, b = b, a
    if need > len(a):
        return need - 1
    places, spare = _places(a), len(a) - need
    width, state, full, matched = 0, 0, 0, 0
    for start in range(0, len(b), _STRIDE):
        part = b[start : start + _STRIDE]
        reach = min(len(a), start + len(part) + spare)
        full = (1 << reach) - 1
        state |= full ^ ((1 << width) - 1)
        width = reach
        for at in map(places.get, part, repeat(0)):
            hit = state & at
            state = ((state + hit) | (state - hit)) & full
        matched = width - state.bit_count()
        if matched + len(b) - start - len(part) < need:
            return need - 1
    return max(matched, need - 1)


_STRIDE = 128  # letters between two looks at what is still possible
_BINS = 64  # letters are counted by code modulo this
SHORT = 64  # letters up to which an answer's mask refuses most others


class _Profile:
    """What is compared of one answer, worked out once, its letters when they are first asked for."""

    __slots__ = ("words", "length", "_letters", "_spelt")

    def __init__(self, answer: str):
        self.words = frozenset(answer.split())
        self.length = sum(map(len, self.words)) + max(len(self.words) - 1, 0)  # of the words joined by blanks
        self._letters: np.ndarray | None = None
        self._spelt: str | None = None

    @property
    def spelt(self) -> str:
        """The words, sorted and joined."""
        if self._spelt is None:
            self._spelt = " ".join(sorted(self.words))
        return self._spelt

    @property
    def letters(self) -> np.ndarray:
        if self._letters is None:
            codes = np.frombuffer(" ".join(self.words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            self._letters = np.bincount(codes % _BINS, minlength=_BINS).astype(np.int32)
        return self._letters

    @property
    def mask(self) -> np.uint64:
        """Which letters, in 32 classes, occur at all and which twice; masks differ in no more bits than letter counts."""
        count = self.letters[: _BINS // 2] + self.letters[_BINS // 2 :]
        return np.packbits(np.concatenate([count > 0, count > 1])).view(np.uint64)[0]


def _differing(leader: _Profile, answer: _Profile) -> tuple[str, str]:
    """The words that differ, sorted and joined."""
    return " ".join(sorted(leader.words - answer.words)), " ".join(sorted(answer.words - leader.words))


def _within(leader: _Profile, answer: _Profile, whole: int, threshold: float) -> bool:
    """Whether the words that differ leave ``threshold`` per cent of ``whole``."""
    a, b = _differing(leader, answer)
    need = _needed(len(a) + len(b), whole, threshold)
    return _shared_from(a, b, need) >= need


def _alike(leader: _Profile, answer: _Profile, threshold: float) -> bool:
    """Whether two answers score at least ``threshold``; the bounds of ``_Opened`` for a single pair."""
    if not leader.words or not answer.words:
        return threshold <= 0
    both = leader.words & answer.words
    shared = sum(map(len, both)) + len(both)
    theirs, mine = max(leader.length - shared, 0), max(answer.length - shared, 0)
    whole = 2 * shared + theirs + mine
    if both:
        if (theirs == 0 or mine == 0) and threshold <= 100:
            return True
        if any(100 - 100 * (1 + rest) / (2 * shared - 1 + rest) >= threshold for rest in (theirs, mine)):
            return True
    if 100 - 100 * (theirs + mine) / max(whole, 1) >= threshold:
        return True
    least = threshold - 1e-6
    if 100 - 100 * abs(theirs - mine) / max(whole, 1) < least:
        return False
    apart = int(np.abs(leader.letters - answer.letters).sum()) - 2
    return 100 - 100 * apart / max(whole, 1) >= least and _within(leader, answer, whole, threshold)


class _Opened:
    """Leaders in order, with an index of their words, and bounds that decide most pairs at once.

    The index gives the length of the words that an answer shares with every leader, and with
    it the length of the words that differ: enough to work out two of the three similarities
    that a score is the largest of. The third compares the differing words letter by letter;
    it needs lengths and letter counts that are close, which is checked for all leaders
    together. Only pairs that pass are compared. For a short answer all this is done only for
    leaders that share a word with it or have a mask close to its own. What a long answer was found to
    share at most with a leader bounds what an answer of nearly the same words can share with it.
    """

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.leaders: list[tuple[int, _Profile]] = []
        self.letters = np.zeros((16, _BINS), dtype=np.int32)
        self.lengths = np.zeros(16, dtype=np.int64)
        self.masks = np.zeros(16, dtype=np.uint64)
        self.postings: dict[str, array] = {}
        self.recent: deque[tuple[frozenset[str], np.ndarray]] = deque(maxlen=_RECENT)

    def add(self, at: int, leader: _Profile) -> None:
        n = len(self.leaders)
        if n == len(self.lengths):
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
            self.masks = np.concatenate([self.masks, np.zeros_like(self.masks)])
        self.letters[n], self.lengths[n], self.masks[n] = leader.letters, leader.length + 1, leader.mask
        for word in leader.words:
            self.postings.setdefault(word, array("i")).append(n)
        self.leaders.append((at, leader))

    def first_match(self, answer: _Profile) -> int | None:
        n = len(self.leaders)
        if not n or not answer.words:
            # no word scores 0 against everything
            return self.leaders[0][0] if n and self.threshold <= 0 else None
        shared = np.zeros(n, dtype=np.int64)  # of common words, each with one blank
        for word in answer.words:
            if word in self.postings:
                shared[np.array(self.postings[word])] += len(word) + 1
        lengths, open_to = self.lengths[:n], self._open_to(answer, shared)
        if open_to is not None:
            shared, lengths = shared[open_to], lengths[open_to]
        some = shared > 0
        common = np.where(some, shared - 1, 0)
        theirs, mine = np.maximum(lengths - shared - 1, 0), np.maximum(answer.length - shared, 0)
        whole = 2 * (common + some) + theirs + mine
        sure = some & ((theirs == 0) | (mine == 0)) & (self.threshold <= 100)
        for rest in (theirs, mine):
            sure |= some & (100 - 100 * (1 + rest) / (2 * common + 1 + rest) >= self.threshold)
        sure |= 100 - 100 * (theirs + mine) / np.maximum(whole, 1) >= self.threshold
        least = self.threshold - 1e-6
        able = ~sure & (100 - 100 * np.abs(theirs - mine) / np.maximum(whole, 1) >= least)
        if sure.any():
            able[np.argmax(sure) :] = False  # none after the first sure one can come first
        near = np.flatnonzero(able)  # letters are looked at where lengths allow a match
        apart = np.abs(self.letters[near if open_to is None else open_to[near]] - answer.letters).sum(axis=1) - 2
        able[near] = 100 - 100 * apart / np.maximum(whole[near], 1) >= least
        bounds = None
        if open_to is None:
            bounds = self._bounds(answer)
            part = (100 - self.threshold) / 100 + 1e-6
            able &= 2 * bounds >= theirs + mine - part * whole - 2
        places = None  # of a short answer's letters, which all leaders without a common word meet
        for i in np.flatnonzero(sure | able):
            at, leader = self.leaders[i if open_to is None else open_to[i]]
            if sure[i]:
                return at
            if open_to is not None and not some[i]:
                places = places or _places(answer.spelt)
                length = answer.length + len(leader.spelt)
                if leader.words and _percent(length - 2 * _common(places, answer.length, leader.spelt), length) >= self.threshold:
                    return at
            elif leader.words:
                a, b = _differing(leader, answer)
                need = _needed(len(a) + len(b), int(whole[i]), self.threshold)
                found = _shared_from(a, b, need if bounds is None else need - max(need, 0) // _SLACK)
                if found >= need:
                    return at
                if bounds is not None:
                    bounds[i] = found
        return None

    def _bounds(self, answer: _Profile) -> np.ndarray:
        """For every leader, letters that its and a long answer's differing words share at most; kept for later answers.

        Known from an earlier answer: a word more or less on either side adds no more letters than it and its blank have.
        """
        bounds = np.full(len(self.leaders), _UNKNOWN, dtype=np.int64)
        apart = ((words ^ answer.words, known) for words, known in self.recent)
        differ, known = min(apart, key=lambda pair: len(pair[0]), default=(answer.words, bounds))
        if len(differ) * 8 < len(answer.words):
            bounds[: len(known)] = known + sum(len(w) + 1 for w in differ)
        self.recent.append((answer.words, bounds))
        return bounds

    def _open_to(self, answer: _Profile, shared: np.ndarray) -> np.ndarray | None:
        """Places of the leaders that a short answer can be like; None for all.

        Without a common word the two strings differ by the letters of at most a share of both
        lengths, and the other length is at most so much larger that this share makes up for it.
        """
        part = (100 - self.threshold) / 100 + 1e-6
        if answer.length > SHORT or part >= 1:
            return None
        bits = np.bitwise_count(self.masks[: len(shared)] ^ answer.mask)
        return np.flatnonzero((bits <= 2 * part * answer.length / (1 - part)) | (shared > 0))


_SLACK, _RECENT, _UNKNOWN = 16, 6, 1 << 40  # one in so many letters needed may be missing for a bound; answers whose bounds are kept
_FEW = 32  # answers up to which an index of leaders' words costs more than it spares


def _leaders_among(said: list[str], ballots: list[list[int]], threshold: float) -> list[list[int]]:
    """For each ballot of distinct places of ``said``, in order, the index of each one's group's first member.

    An answer that is in several ballots is taken apart once, and two answers are compared once.
    """
    profiles: dict[int, _Profile] = {}
    known: dict[tuple[int, int], bool] = {}

    def profile(i: int) -> _Profile:
        if i not in profiles:
            profiles[i] = _Profile(said[i])
        return profiles[i]

    def alike(leader: int, answer: int) -> bool:
        pair = (leader, answer)
        if pair not in known:
            known[pair] = _alike(profile(leader), profile(answer), threshold)
        return known[pair]

    def few(ballot: list[int]) -> list[int]:
        heads: list[int] = []
        picks = []
        for at, i in enumerate(ballot):
            pick = next((h for h in heads if alike(ballot[h], i)), at)
            if pick == at:
                heads.append(at)
            picks.append(pick)
        return picks

    def many(ballot: list[int]) -> list[int]:
        opened = _Opened(threshold)
        picks = []
        for at, i in enumerate(ballot):
            pick = opened.first_match(profile(i))
            if pick is None:
                pick = at
                opened.add(at, profile(i))
            picks.append(pick)
        return picks

    return [few(b) if 1 < len(b) <= _FEW else many(b) if b[1:] else [0] * len(b) for b in ballots]


def ordered_leaders(answers: list[str], threshold: float) -> list[int]:
    """For distinct answers in order, the position of each one's group's first member."""
    return _leaders_among(answers, [list(range(len(answers)))], threshold)[0]


def token_set_ratio(left: Column, right: Column) -> Column:
    """Similarity column; equal or empty pairs never leave the JVM."""

    @F.arrow_udf("double")
    def score(lefts: pa.Array, rights: pa.Array) -> pa.Array:
        pairs = zip(lefts.to_pylist(), rights.to_pylist())
        return pa.array([None if a is None or b is None else token_set_score(a, b) for a, b in pairs], pa.float64())

    open_pair = (left != right) & (left != "") & (right != "")
    scored = score(F.when(open_pair, left), F.when(open_pair, right))
    return (
        F.when(left.isNull() | right.isNull(), None)
        .when((left == "") | (right == ""), 0.0)
        .when(left == right, 100.0)
        .otherwise(scored)
    )


def group_leaders(answers: Column, threshold: float) -> Column:
    """For each distinct answer of an ordered array, the index of its group's first member.

    An answer joins the earliest group whose first member scores at least
    ``threshold`` against it, else it opens a group. The array must be bounded
    (replicates of one item, or one block of a larger group).
    """

    @F.arrow_udf("array<int>")
    def leaders_of(rows: pa.Array) -> pa.Array:
        return pa.array([None if row is None else ordered_leaders(row, threshold) for row in rows.to_pylist()], pa.list_(pa.int32()))

    return leaders_of(answers)


def group_answers(ballots: Column, threshold: float) -> Column:
    """Per array of answers: its distinct non-null answers, first seen first, as value, ct, leader.

    An answer that is in several arrays of a row is taken apart once; only counts and places come back from Python.
    Arrays of at most one distinct answer are settled here and cross as empty ones. The function is
    declared non-deterministic so that a vote on the outcome of other votes is planned
    as a second step on finished columns, never folded into the first.
    """
    none = F.array().cast("array<string>")
    spoken = F.transform(ballots, lambda a: F.filter(F.coalesce(a, none), lambda x: x.isNotNull()))
    several = F.transform(spoken, lambda a: F.when(F.size(F.array_distinct(a)) > 1, a).otherwise(none))

    def groups(ballots: list[list[str]]) -> list[list[dict]]:
        said: dict[str, int] = {}
        counts = [Counter(said.setdefault(answer, len(said)) for answer in answers) for answers in ballots]
        leaders = _leaders_among(list(said), [list(c) for c in counts], threshold)
        return [[{"ct": n, "leader": at} for n, at in zip(c.values(), found)] for c, found in zip(counts, leaders)]

    @F.arrow_udf("array<array<struct<ct: int, leader: int>>>")
    def grouped(rows: pa.Array) -> pa.Array:
        group = pa.struct([("ct", pa.int32()), ("leader", pa.int32())])
        out = [groups(row) for row in rows.to_pylist()]
        return pa.array(out, pa.list_(pa.list_(group)))

    empty = F.array().cast("array<struct<value: string, ct: int, leader: int>>")

    def settled(said: Column, groups: Column) -> Column:
        alone = F.array(F.struct(said[0].alias("value"), F.size(said).alias("ct"), F.lit(0).alias("leader")))
        named = F.zip_with(
            F.array_distinct(said), groups, lambda v, g: F.struct(v.alias("value"), g["ct"].alias("ct"), g["leader"].alias("leader"))
        )
        return F.when(F.size(groups) > 0, named).when(F.size(said) > 0, alone).otherwise(empty)

    return F.zip_with(spoken, grouped.asNondeterministic()(several), settled)


def first_leaders(leaders: list[str], answers: list[str], threshold: float) -> list[int | None]:
    """For each answer, the index of the first leader that scores at least ``threshold``."""
    opened = _Opened(threshold)
    for at, leader in enumerate(leaders):
        opened.add(at, _Profile(leader))
    return [opened.first_match(_Profile(answer)) for answer in answers]

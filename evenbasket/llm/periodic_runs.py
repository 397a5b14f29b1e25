"""Periodic runs of words: stretches that repeat a block of words at least twice.

A run of period q that starts at word s is the same as a maximal pair: two equal
stretches, at s and at s + q, with different words on their left and on their
right, whose length is at least their distance. So all runs are found by listing
maximal pairs, and no stretch has to be extended.

The pairs come from the tree of LCP intervals over the sorted suffixes, walked
bottom-up: an interval's suffixes share as many words as its depth, and two of
them from different children share no more, so they differ on the right. Each
interval keeps its positions by the word on their left; when a child joins, the
smaller side looks up the other's positions no farther away than the depth, and
takes those with another left word. Occurrences of a stretch so close together
form few arithmetic progressions, so a look-up meets few groups of equal left
words and skips each at once.

Only suffixes whose first words (half the least length of a run) repeat in their
document are sorted: by those words first, then by doubling.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evenbasket.llm.tables import derive_columns
from evenbasket.llm.tokens import NOT_SPACE, mix, ngram_hashes, word_spans

#: Least number of words in a run.
LEAST_LENGTH = 12
#: Words whose bytes are gone through at once when a text is written without its repetitions.
SECTION_WORDS = 1 << 16


# -- sorted suffixes -----------------------------------------------------------


def _repeated_heads(words: np.ndarray, first: np.ndarray, head: int) -> np.ndarray:
    """Places whose next ``head`` words occur again in the same document (rarely one more, by a hash)."""
    grams = ngram_hashes(words, head)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(grams)]
    place = np.flatnonzero(np.arange(len(grams)) + head <= first[doc + 1])
    key = grams[place] + mix(doc[place].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = np.diff(key[order]) == 0
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return place[again]


def sorted_suffixes(words: np.ndarray, first: np.ndarray, head: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose first ``head`` words repeat in their document, by document and words, and the starts of the groups with equal heads (and the end)."""
    heads = _repeated_heads(words, first, head)
    if not len(heads):
        return heads, np.zeros(1, np.int64)
    # What stands behind a head decides among suffixes, so it is ranked too.
    place = np.unique(np.concatenate((heads, heads + head)))
    doc = np.searchsorted(first, place, "right") - 1
    known = np.zeros(len(words) + head, bool)
    known[heads] = True
    inside = known[place] | known[place - head]  # a head's tail may be the next document's first word
    tail_doc = np.searchsorted(first, np.maximum(place - head, 0), "right") - 1
    inside &= known[place] | (tail_doc == doc)
    inside &= place < len(words)
    place, doc = place[inside], doc[inside]
    end = first[doc + 1]
    columns = [np.where(place + k < end, words[np.minimum(place + k, len(words) - 1)], np.uint64(0)) for k in range(head)]
    order = np.lexsort((*columns[::-1], doc))
    sa, doc = place[order], doc[order]
    new = np.ones(len(sa), bool)
    new[1:] = np.diff(doc) != 0
    for column in columns:
        new[1:] |= np.diff(column[order]) != 0
    end = end[order]
    start = np.flatnonzero(new)
    group = np.repeat(start, np.diff(np.append(start, len(sa))))
    rank = np.full(len(words) + 1, -1, np.int64)
    rank[sa] = group
    groups = start
    size = np.diff(np.append(start, len(sa)))[np.searchsorted(start, group)]
    active = np.flatnonzero(size > 1)
    h = head
    while len(active):
        at, own = sa[active], group[active]
        behind = np.where(at + h < end[active], rank[np.minimum(at + h, len(words))], -1)
        order = np.lexsort((behind, own))
        at, own, behind = at[order], own[order], behind[order]
        sa[active] = at
        new = np.ones(len(active), bool)
        new[1:] = (np.diff(own) != 0) | (np.diff(behind) != 0)
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(active)))
        group[active] = np.repeat(active[start], size)
        rank[at] = group[active]
        active = active[np.repeat(size, size) > 1]
        h *= 2
    size = np.diff(np.append(groups, len(sa)))
    kept = np.repeat(size > 1, size)
    size = size[size > 1]
    return sa[kept], np.concatenate(([0], np.cumsum(size)))


def common_prefixes(words: memoryview, sa: list[int], starts: list[int], ends: list[int], head: int) -> dict[int, int]:
    """Words that each suffix shares with the one before it in its group (none for a group's first), in text order: one word less at most from a place to the next."""
    before = dict(zip(sa[1:], sa, strict=False))
    for k in starts:
        before[sa[k]] = -1
    out, length, last = {}, 0, -2
    for i, end in sorted(zip(sa, ends, strict=True)):
        j = before[i]
        if j < 0:
            length = 0
        else:
            length = max(length - 1, head) if i == last + 1 else head
            room = end - (i if i > j else j)
            while length < room and words[i + length] == words[j + length]:
                length += 1
            out[i] = length
        last = i
    return out


# -- the tree of LCP intervals -------------------------------------------------


class _Places:
    """Places of an interval: all in order, and those of each left word in order."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all = [place]
        self.by_left = {left: [place]}

    def add(self, place: int, left: int) -> None:
        insort(self.all, place)
        same = self.by_left.get(left)
        if same is None:
            self.by_left[left] = [place]
        else:
            insort(same, place)

    def near(self, place: int, left: int, reach: int) -> list[int]:
        """Places no farther than ``reach`` with another left word."""
        every = self.all
        k, end = bisect_left(every, place - reach), bisect_right(every, place + reach)
        if k == end:
            return []
        same = self.by_left.get(left)
        if same is None:
            return every[k:end]
        out = []
        t = bisect_left(same, every[k])
        while k < end:
            if t == len(same):
                out += every[k:end]
                break
            if every[k] != same[t]:
                out.append(every[k])
                k += 1
                continue
            # As long as both lists go on alike, all left words are the same.
            low, high = 1, min(end - k, len(same) - t)
            while low < high:
                mid = (low + high + 1) // 2
                if every[k + mid - 1] == same[t + mid - 1]:
                    low = mid
                else:
                    high = mid - 1
            k, t = k + low, t + low
        return out


def close_pairs(sa: list[int], lcp: list[int], left: dict[int, int], least: int) -> list[tuple[int, int, int]]:
    """(place, distance, length) of the maximal pairs of a group whose length is at least their distance, and both together at least ``least``.

    ``lcp[k]`` are the words that suffix k shares with the one before it.
    """
    pairs: list[tuple[int, int, int]] = []

    def look(place: int, side: int, other: _Places, depth: int) -> None:
        for p in other.near(place, side, depth):
            distance = abs(place - p)
            if distance + depth >= least:
                pairs.append((min(place, p), distance, depth))

    def joined(a, b, depth: int) -> _Places:
        if isinstance(a, int):
            a, b = b, a
        if isinstance(a, int):
            a = _Places(a, left[a])
        if isinstance(b, int):
            look(b, left[b], a, depth)
            a.add(b, left[b])
            return a
        if len(a.all) < len(b.all):
            a, b = b, a
        for side, places in b.by_left.items():
            for p in places:
                look(p, side, a, depth)
        for side, places in b.by_left.items():
            for p in places:
                a.add(p, side)
        return a

    depths: list[int] = []  # of the open intervals, rising, and their places so far
    open_: list = []
    child: int | _Places = sa[0]  # a single suffix is its place
    for k in range(1, len(sa) + 1):
        depth = lcp[k] if k < len(sa) else -1
        while depths and depths[-1] > depth:
            child = joined(open_.pop(), child, depths.pop())
        if k < len(sa):
            if depths and depths[-1] == depth:
                open_[-1] = joined(open_[-1], child, depth)
            else:
                depths.append(depth)
                open_.append(child)
            child = sa[k]
    return pairs


def periodic_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST_LENGTH) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document that has any, by start and period; documents lie one after the other."""
    head = max(1, (least + 1) // 2)
    sa, cuts = sorted_suffixes(words, first, head)
    if not len(sa):
        return {}
    doc = np.searchsorted(first, sa, "right") - 1
    order, bounds = sa.tolist(), cuts.tolist()
    view = memoryview(np.ascontiguousarray(words))
    shared = common_prefixes(view, order, bounds[:-1], first[doc + 1].tolist(), head)
    opening = set(first[:-1].tolist())
    left = {p: -1 if p in opening else view[p - 1] for p in order}
    found: dict[int, dict[tuple[int, int], int]] = {}
    for a, b in zip(bounds, bounds[1:], strict=False):
        own = order[a:b]
        pairs = close_pairs(own, [shared.get(p, 0) for p in own], left, least)
        if pairs:
            best = found.setdefault(int(doc[a]), {})
            for place, distance, length in pairs:
                key = (place, place + distance + length)
                best[key] = min(distance, best.get(key, distance))  # the same stretch also has multiples of its period
    out = {}
    for d, best in found.items():
        base = int(first[d])
        out[d] = sorted(((s - base, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))
    return out


# -- texts ---------------------------------------------------------------------


def _collapsed(raw: bytes, start: np.ndarray, end: np.ndarray, runs: list[tuple[int, int, int]]) -> bytes:
    """The words of a text that no run repeats, joined by single spaces."""
    n = len(start)
    step = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        step[s + q] += 1
        step[s + length] -= 1
    kept = np.concatenate(([False], np.cumsum(step[:n]) == 0, [False]))
    edge = np.flatnonzero(kept[1:] != kept[:-1])
    parts = []
    for a, b in edge.reshape(-1, 2).tolist():
        for k in range(a, b, SECTION_WORDS):
            parts.append(b" ".join(raw[start[k] : end[min(k + SECTION_WORDS, b) - 1]].split()))
    return b" ".join(parts)


def _find(least: int):
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(data: np.ndarray, offsets: np.ndarray) -> list:
        words = word_spans(data, offsets, NOT_SPACE, lower=False)
        runs = periodic_runs(words.hash, words.first, least)
        raw = data.tobytes()
        first, cut = words.first.tolist(), offsets.tolist()
        texts = []
        for k, (a, b) in enumerate(zip(first, first[1:], strict=False)):
            if k in runs:
                texts.append(_collapsed(raw, words.start[a:b], words.end[a:b], runs[k]))
            elif cut[k + 1] - cut[k] <= 16 * SECTION_WORDS:
                texts.append(b" ".join(raw[cut[k] : cut[k + 1]].split()))
            else:
                texts.append(_collapsed(raw, words.start[a:b], words.end[a:b], []))
        each = [runs.get(k, []) for k in range(len(first) - 1)]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in each], dtype=np.int64))).astype(np.int32)
        flat = np.array([r for x in each for r in x], np.int64).reshape(-1, 3)
        struct = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(run_type.value_type))
        return [
            pa.array(np.diff(words.first).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(ends), struct),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ]

    return run


def find_runs(documents: DataFrame, keep: list[str], text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """``keep`` columns and n_words, runs (start, length, period in words, by start and period), collapsed (text).

    A run is a stretch of words with smallest period q and at least
    ``least_length`` and 2 q words that no neighbouring word extends; runs may
    overlap, and each is listed once. ``collapsed`` has the words that stand in
    no run or only in the first period of each, joined by single spaces. A null
    or empty text has no words and no runs, and its collapsed text is empty. Equal
    rows get equal results; an empty table gives no rows. A kept column with the
    name of a made one is left out. A text of any length is handled whole, by one
    task: some 40 bytes are held for each of its words and 400 or so for each word
    of its repeated stretches. Words are compared by 64-bit hashes.
    """
    made = "n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return derive_columns(documents, text, keep, made, lambda: _find(least_length))

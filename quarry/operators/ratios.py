"""Sequence ratios of all pairs of two blocks of texts, as difflib gives them, over plain arrays; no pair that has the ratio is left out.

Where half of the characters may differ, most texts share some rare ones, and postings meet nearly all pairs. So a block takes all its
pairs, behind bounds that are cheap for each: the common characters, counted with their repetitions in hashed columns (a product of
matrices, which is never below the true count); the longest common subsequence, bit-parallel over some thousand pairs; then the matching
runs themselves, the longest ones of many stretches at a time, given up where what is left can't reach the ratio.

Texts beyond SHORT, where difflib begins to leave out popular characters, go to difflib after the same bounds. What a block holds is
bounded by its rows and TILE, PAIRS and CELLS, whatever passes the bounds.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np

from quarry.operators.overlap import GOLD, mixed

#: Characters of a text whose pairs are counted over arrays; difflib counts all characters of texts below 200.
SHORT = 199
#: Columns into which characters are hashed.
FEATURES = 512
#: Rows of a product, pairs whose subsequences are counted at a time, words of a table of places, cells of a table of runs.
TILE, PAIRS, WORDS, CELLS = 256, 1 << 13, 1 << 18, 1 << 17
#: Pairs whose runs are taken at a time; stretches whose lengths lie between the same of these STEPS are taken together.
RUNS, STEPS = 1 << 15, (1, 2, 3, 4, 6, 8, 11, 15, 20, 26, 33, 41, 50, 60, 75, 95, 120, 155)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    row = whole
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & whole
    return len(a) - row.bit_count()


def ratio_of(x: str, y: str, least: float) -> float:
    """Ratio of x to y, in this order; 0 where it can't reach ``least``."""
    if not x or not y:
        return 1.0 if not x and not y else 0.0
    if 2 * common_subsequence(x, y) < (least - 1e-9) * (len(x) + len(y)):
        return 0.0
    return difflib.SequenceMatcher(None, x, y).ratio()


class _Side:
    """Texts of a block in order of length: ``features``, ``code`` (text, place) with ``blank`` where a text has ended or is long."""

    def __init__(self, bodies: list[str], names: np.ndarray):
        size = np.array([len(b) for b in bodies], np.int64)
        self.order = np.argsort(size, kind="stable")
        self.size, self.bodies = size[self.order], [bodies[i] for i in self.order]
        char = np.frombuffer("".join(self.bodies).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(bodies)), self.size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        both = np.sort(row.astype(np.uint64) << np.uint64(32) | char)
        start = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.empty(0, np.int64)
        nth = np.arange(len(both)) - np.repeat(start, np.diff(np.append(start, len(both))))
        with np.errstate(over="ignore"):
            token = mixed(((both & np.uint64(0xFFFFFFFF)) * np.uint64(1 << 20) + nth.astype(np.uint64) + np.uint64(1)) * GOLD)
        column = (both >> np.uint64(32)).astype(np.int64) * FEATURES + (token >> np.uint64(32)).astype(np.int64) % FEATURES
        self.features = np.bincount(column, minlength=len(bodies) * FEATURES).astype(np.float32).reshape(-1, FEATURES)
        self.blank = len(names)
        kind = np.uint16 if self.blank < 0xFFF0 else np.uint32
        short = place < np.where(self.size <= SHORT, self.size, 0)[row]
        self.code = np.full((len(bodies), int(self.size.clip(max=SHORT).max(initial=1)) or 1), self.blank, kind)
        self.code[row[short], place[short]] = np.searchsorted(names, char[short])

    def weighed(self, share: float, first: bool) -> np.ndarray:
        """Features, and what a text must have in common; float32 errs by less than the part in ten thousand that is let off."""
        need, one = self.size * (share / 2 * (1 - 1e-4)), np.ones(len(self.size))
        return np.column_stack([self.features, *((-need, one) if first else (one, -need))]).astype(np.float32)


def _subsequences(x: _Side, y: _Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each pair of short texts."""
    out = np.zeros(len(i), np.int64)
    turned = np.ascontiguousarray(y.code.T).astype(np.int64)
    rows = np.unique(i)
    words = max(1, -(-int(x.size[rows].max(initial=1)) // 64))
    wide = x.blank + 1
    group = max(1, WORDS // (wide * words))
    by_row = np.argsort(i, kind="stable")
    for g in range(0, len(rows), group):
        own = rows[g : g + group]
        base = np.arange(len(own)) * wide
        places = np.zeros((words, len(own) * wide), np.uint64)
        for p in range(int(x.size[own].max())):
            places[p >> 6, base + x.code[own, p]] |= np.uint64(1 << (p & 63))
        places[:, base + x.blank] = 0
        of = by_row[np.searchsorted(i, own[0], "left", by_row) : np.searchsorted(i, own[-1], "right", by_row)]
        of = of[np.argsort(j[of], kind="stable")]  # texts of like length together
        for at in range(0, len(of), PAIRS):
            o = of[at : at + PAIRS]
            low, right = base[np.searchsorted(own, i[o])], j[o]
            row = [np.full(len(o), ~np.uint64(0)) for _ in range(words)]
            for p in range(int(y.size[right].max())):
                key = turned[p].take(right)
                key += low
                carry = None
                for w in range(words):
                    hit = places[w].take(key)
                    hit &= row[w]
                    total = row[w] + hit
                    over = total < hit if w + 1 < words else None
                    if carry is not None:
                        total += carry
                        if over is not None:
                            over |= total < carry
                    row[w] ^= hit
                    row[w] |= total
                    carry = None if over is None else over.astype(np.uint64)
            out[o] = 64 * words - sum(np.bitwise_count(r).astype(np.int64) for r in row)
    return out


def _stretch(side: _Side, text: np.ndarray, low: np.ndarray, size: np.ndarray, blank: int) -> np.ndarray:
    """(place, stretch): codes of stretches, filled up."""
    place = np.arange(int(size.max()))[:, None]
    wide = side.code.shape[1]
    code = side.code.reshape(-1).take(text * wide + np.minimum(low + place, wide - 1))
    code[place >= size] = blank
    return code


def _longest(x: _Side, y: _Side, i: np.ndarray, j: np.ndarray, a: np.ndarray, a_to: np.ndarray, b: np.ndarray, b_to: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start in x, start in y, length) of the longest run that two stretches share, of equal ones the first in x, then in y."""
    n_a, n_b = a_to - a, b_to - b
    at_a, at_b, size = a.copy(), b.copy(), np.zeros(len(i), np.int64)
    grade = np.searchsorted(STEPS, n_a)
    order = np.lexsort((n_b, grade))[::-1]
    ends, at = np.flatnonzero(np.diff(grade[order], append=-1)) + 1, 0
    while at < len(order):
        o = order[at : min(at + max(1, CELLS // int(n_b[order[at]])), ends[np.searchsorted(ends, at, "right")])]
        at += len(o)
        ours, theirs = _stretch(x, i[o], a[o], n_a[o], x.blank), _stretch(y, j[o], b[o], n_b[o], x.blank + 1)
        before, now = np.zeros((2, len(theirs) + 1, len(o)), np.uint8)
        same = np.empty(theirs.shape, bool)
        best, end, place = np.zeros(len(o), np.uint8), np.zeros(len(o), np.int64), np.zeros(len(o), np.int64)
        for r in range(len(ours)):
            np.equal(theirs, ours[r], out=same)
            np.add(before[:-1], np.uint8(1), out=now[1:])
            np.multiply(now[1:], same.view(np.uint8), out=now[1:])
            more = np.flatnonzero(now.max(axis=0) > best)
            if len(more):
                column = now[:, more]
                top = column.argmax(axis=0)
                best[more], end[more], place[more] = column[top, np.arange(len(more))], r, top
            before, now = now, before
        size[o] = best
        at_a[o] += np.where(best > 0, end - best + 1, 0)
        at_b[o] += np.where(best > 0, place - best, 0)
    return at_a, at_b, size


def _matches(x: _Side, y: _Side, i: np.ndarray, j: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Characters in matching runs of each pair of short texts; too few where they can't reach ``need``."""
    found = np.zeros(len(i), np.int64)
    pair, a, b = np.arange(len(i)), np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    a_to, b_to = x.size[i].copy(), y.size[j].copy()
    while True:
        going = (a < a_to) & (b < b_to)
        room = np.bincount(pair[going], np.minimum(a_to - a, b_to - b)[going], len(i))
        going &= (found + room >= need)[pair]
        pair, a, a_to, b, b_to = (c[going] for c in (pair, a, a_to, b, b_to))
        if not len(pair):
            return found
        at_a, at_b, size = _longest(x, y, i[pair], j[pair], a, a_to, b, b_to)
        found += np.bincount(pair, size, len(i)).astype(np.int64)
        hit = size > 0
        pair, a, at_a, a_to, b, at_b, b_to, size = (c[hit] for c in (pair, a, at_a, a_to, b, at_b, b_to, size))
        pair = np.concatenate([pair, pair])
        a, a_to, b, b_to = (np.concatenate(c) for c in ((a, at_a + size), (at_a, a_to), (b, at_b + size), (at_b, b_to)))


def alike(least: float, left: list[str], right: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, ratio) of the pairs of a left and a right text whose ratio, in this order, is at least ``least``, which is above 0."""
    if not left or not right:
        return
    chars = np.frombuffer("".join([*(t for t in left if len(t) <= SHORT), *(t for t in right if len(t) <= SHORT)]).encode("utf-32-le", "surrogatepass"), np.uint32)
    names = np.unique(chars)
    x, y = _Side(left, names), _Side(right, names)
    ours, theirs = x.weighed(least, True), np.ascontiguousarray(y.weighed(least, False).T)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def settled(k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        while waiting and sum(len(i) for i, _ in waiting) >= k:
            i, j = (np.concatenate(c) for c in zip(*waiting))
            waiting[:] = [(i[RUNS:], j[RUNS:])] if len(i) > RUNS else []
            i, j = i[:RUNS], j[:RUNS]
            both = x.size[i] + y.size[j]
            got = 2.0 * _matches(x, y, i, j, (least - 1e-9) * both / 2) / np.maximum(both, 1)
            got[both == 0] = 1.0
            keep = got >= least
            yield x.order[i[keep]], y.order[j[keep]], got[keep]

    for at in range(0, len(left), TILE):
        i, j = np.nonzero(ours[at : at + TILE] @ theirs >= -1e-3)
        i += at
        short = (x.size[i] <= SHORT) & (y.size[j] <= SHORT)
        for p, q in zip(i[~short].tolist(), j[~short].tolist()):
            if (r := ratio_of(x.bodies[p], y.bodies[q], least)) >= least:
                yield x.order[p : p + 1], y.order[q : q + 1], np.array([r])
        i, j = i[short], j[short]
        keep = 2 * _subsequences(x, y, i, j) >= (least - 1e-9) * (x.size[i] + y.size[j])
        waiting.append((i[keep], j[keep]))
        yield from settled(RUNS)
    yield from settled(1)

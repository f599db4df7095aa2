"""Texts of which a share of their characters, or of their two-character sequences, is the same: a blocked sparse product with bounds
from the sizes. No pair that has so much in common is left out.

A class of equal texts is the set of its tokens: character or sequence, number of its repetition, kind. Sizes a and b, c tokens in
common: a pair counts if 2c >= share(a + b), hence c >= share / (2 - share) a. In any one order of all tokens, two sets with c in
common have a first common token, and c tokens from it on each: so only the first a - c + 1 tokens of a set are posted. The order is
from rare to frequent, by counts in a table of fixed size: what falls together in it blurs the order, and any order is right.

Long texts are divided into groups of tokens by their hash, each a set of its own: if all groups had less than the share in common,
so had the whole; so a pair has a group that has it, and is met there. A group's fingerprints need fewer bits for the same certainty.

A posting carries a bit-difference fingerprint of what is left of its set from the token on: each bit is the parity of the tokens that
hash to it. Let p and q tokens be left of two sets from their first common token on. These stretches hold all that is in common, so
they differ in no more than p + q - share(a + b) tokens, and their fingerprints in no more bits. Late in a set, where the frequent
tokens stand and most rows meet, that is next to nothing, and 64 bits tell almost all pairs apart; the more a posting has to spare,
the wider its fingerprint (WIDTHS). Two of different widths are compared at the lesser, the wider one folded. Nothing is lost by it.

A block is the columns (tokens) that fall into one part; its postings travel as packed arrays, one per part and some thousand rows.
In a block each column is a run of rows in order of size, and its square is taken in tiles of XOR and bit counts over plain arrays.
Columns with more than LIMIT rows are cut into squares of parts, so that no block depends on one token.

Tables hold (kind, cls, body): a body may have parts set apart by U+001F, which no sequence crosses. Defined cases: an empty body has
no token and no partner; copies of a class count once; a null kind is a kind of its own, and kinds never meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Table of counts: 2 ** SLOTS entries, whatever the data.
SLOTS = 20
#: Rows of a column that are met in one place.
LIMIT = 1 << 18
#: Postings of one part, about; there are never fewer than PARTS parts.
LOAD, PARTS = 1 << 21, 12
#: Words of 64 bits of a fingerprint, and the tokens left beyond the share of its own size from which a posting has so many; below 0
#: it only meets what has some to spare.
WIDTHS, SPARE = (1, 1, 2, 4, 8), (0, 2, 12, 40)
WORDS = WIDTHS[-1]
#: Pairs in a tile; columns below SMALL rows are met together.
TILE, SMALL = 1 << 15, 64
CHUNK = 4000
EDGE = 1e-6
GOLD = np.uint64(0x9E3779B97F4A7C15)
BLOBS = "part int, side int, blob binary"


def mixed(h: np.ndarray) -> np.ndarray:
    """Hash bits spread over all 64."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def hash_of(kind: str | None) -> int:
    """A number for each kind; null is a kind of its own."""
    h = 7 if kind is None else 11
    for b in (kind or "").encode("utf-8", "surrogatepass"):
        h = (h * 1099511628211 + b) % (1 << 64)
    return h


def _chunks(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list, list]]:
    """(cls, kind, body) of a batch of (kind, cls, body), copies left out, some rows at a time."""
    for at in range(0, b.num_rows, CHUNK):
        part = b.slice(at, CHUNK)
        cls, first = np.unique(part.column(1).to_numpy(), return_index=True)
        part = part.take(pa.array(first))
        yield cls, part.column(0).to_pylist(), part.column(2).to_pylist()


def table_of(slot: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The counts as a table."""
    out = np.zeros(1 << SLOTS, np.int64)
    out[slot] = n
    return out


def slot_of(token: np.ndarray) -> np.ndarray:
    return (token >> np.uint64(64 - SLOTS)).astype(np.int64)


def parts_of(often: np.ndarray) -> int:
    """Parts for a corpus with these counts, of whose tokens about half are posted."""
    return max(PARTS, int(often.sum() // 2 // LOAD) + 1)


def _squares(token: np.ndarray, cls: np.ndarray, often: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(posting, key): each posting with the key of its column; columns of more than ``limit`` rows become squares of parts, of which each
    two meet in one place."""
    times = np.maximum(-(-often[slot_of(token)] // limit), 1)
    if not len(times) or times.max() == 1:
        return np.arange(len(token)), token
    at = np.repeat(np.arange(len(token)), times)
    other = (np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)).astype(np.uint64)
    own = mixed(cls.view(np.uint64))[at] % times[at].astype(np.uint64)
    low, high = np.minimum(own, other), np.maximum(own, other)
    with np.errstate(over="ignore"):
        return at, np.where(times[at] == 1, token[at], mixed(token[at] + (low * np.uint64(1 << 24) + high + np.uint64(1)) * GOLD))


def _planes(a: np.ndarray) -> bytes:
    """Bytes of like weight together, so that they compress."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _unplaned(data: memoryview, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).reshape(-1).view(kind)


def _folded(prints: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints at a lesser width."""
    while prints.shape[1] > width:
        half = prints.shape[1] // 2
        prints = prints[:, :half] ^ prints[:, half:]
    return prints


def _pack(col: np.ndarray, row: np.ndarray, rest: np.ndarray, prints: np.ndarray, grade: np.ndarray, cls: np.ndarray, size: np.ndarray) -> bytes:
    """Postings of one part and some rows: row is a place in (cls, size); grade is a place in WIDTHS."""
    order = np.lexsort((col, grade))
    col, row, rest, prints, grade = col[order], row[order], rest[order], prints[order], grade[order]
    used, row = np.unique(row, return_inverse=True)
    plain = _planes(np.diff(col, prepend=np.uint32(0)).astype(np.uint32)) + _planes(row.astype(np.uint16)) + _planes(rest.astype(np.uint32)) + _planes(size[used].astype(np.uint32))
    squeezed = pa.compress(plain, codec="zstd", asbytes=True)
    many = np.bincount(grade, minlength=len(WIDTHS))
    cut = np.cumsum(many)
    printed = pa.compress(b"".join(np.ascontiguousarray(_folded(prints[e - n : e], w)).tobytes() for e, n, w in zip(cut, many, WIDTHS)), codec="zstd", asbytes=True)
    return np.array([len(col), len(used), len(plain), len(squeezed), *many], np.int64).tobytes() + squeezed + printed + cls[used].tobytes()


def _unpack(blob: bytes) -> list[tuple[np.ndarray, ...]]:
    """For each grade (col, cls, size, rest, prints) of a packed blob."""
    n, m, plain, squeezed, *many = np.frombuffer(blob, np.int64, 4 + len(WIDTHS)).tolist()
    at = 8 * (4 + len(WIDTHS))
    data = memoryview(pa.decompress(memoryview(blob)[at : at + squeezed], plain, codec="zstd", asbytes=True))
    col = np.cumsum(_unplaned(data[: 4 * n], n, np.uint32), dtype=np.uint32)
    row = _unplaned(data[4 * n : 6 * n], n, np.uint16)
    rest = _unplaned(data[6 * n : 10 * n], n, np.uint32).astype(np.int64)
    size = _unplaned(data[10 * n :], m, np.uint32).astype(np.int64)[row]
    cls = np.frombuffer(blob, np.int64, m, len(blob) - 8 * m)[row]
    bits = pa.decompress(memoryview(blob)[at + squeezed : len(blob) - 8 * m], 8 * sum(k * w for k, w in zip(many, WIDTHS)), codec="zstd", asbytes=True)
    out, low, at = [], 0, 0
    for k, w in zip(many, WIDTHS):
        s = slice(low, low + k)
        out.append((col[s], cls[s], size[s], rest[s], np.frombuffer(bits, np.uint64, k * w, at).reshape(k, w)))
        low, at = low + k, at + 8 * k * w
    return out


# the product


class _Rows:
    """Postings of one grade of a block in order of column and size, as plain arrays; ``prints`` by width, a row for each word."""

    def __init__(self, share: float, col: np.ndarray, cls: np.ndarray, size: np.ndarray, rest: np.ndarray, prints: np.ndarray):
        order = np.lexsort((cls, size, col))
        same = np.append(False, (col[order[1:]] == col[order[:-1]]) & (cls[order[1:]] == cls[order[:-1]]) & (rest[order[1:]] == rest[order[:-1]])) if len(order) else np.empty(0, bool)
        order = order[~same]  # of copies one
        self.col, self.cls, self.size, self.rest = col[order], cls[order], size[order], rest[order]
        self.prints = {w: np.ascontiguousarray(_folded(prints[order], w).T) for w in WIDTHS if w <= prints.shape[1]}
        self.most = np.floor(self.rest * (2 / share) - self.size + EDGE).astype(np.int64)
        self.least = np.ceil(self.size * share / (2 - share) - EDGE).astype(np.int64)
        self.spare = self.rest - share * self.size
        self.room = np.clip(np.floor(self.spare), -30000, 30000).astype(np.int16)  # two of them, and one for what is cut off
        self.names, self.start = np.unique(self.col, return_index=True)
        self.stop = np.append(self.start[1:], len(self.col))
        self.top = self.spare.max(initial=-np.inf)
        self.wider = np.maximum.reduceat(self.most - self.size, self.start) if len(self.col) else self.start


def _survivors(x: _Rows, y: _Rows, w: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of postings the classes that pass every bound."""
    keep = np.flatnonzero((y.size[j] <= x.most[i]) & (x.size[i] <= y.most[j]) & (x.cls[i] != y.cls[j]))
    i, j = i[keep], j[keep]
    apart = np.bitwise_count(x.prints[w][:, i] ^ y.prints[w][:, j]).sum(axis=0, dtype=np.int16)
    keep = np.flatnonzero(apart <= x.spare[i] + y.spare[j] + EDGE)
    return x.cls[i[keep]], y.cls[j[keep]]


def _pairs(x: _Rows, y: _Rows, w: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ca, cb) of rows of x with rows of y, or of x among themselves if both are one, by fingerprints of w words."""
    alone = x is y
    if not len(x.col) or not len(y.col):
        return
    here = np.searchsorted(y.names, x.names)
    here[here == len(y.names)] = 0
    common = np.flatnonzero(y.names[here] == x.names)
    small = (x.stop[common] - x.start[common]) * (y.stop[here[common]] - y.start[here[common]]) <= SMALL * SMALL
    few, many = common[small], common[~small]
    px, py = x.prints[w], y.prints[w]
    # small columns: all their pairs by number, some at a time
    if len(few):
        span = x.stop[few] - x.start[few]
        rows = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span) + np.repeat(x.start[few], span)
        column = np.repeat(here[few], span)
        low = rows + 1 if alone else y.start[column]
        n = np.maximum(y.stop[column] - low, 0)
        end = np.cumsum(n)
        at = 0
        while at < len(rows):
            before = end[at - 1] if at else 0
            to = max(int(np.searchsorted(end, before + (1 << 20), "right")), at + 1)
            i = np.repeat(rows[at:to], n[at:to])
            j = np.arange(len(i)) - np.repeat(end[at:to] - n[at:to] - before, n[at:to]) + np.repeat(low[at:to], n[at:to])
            near = np.flatnonzero(np.bitwise_count(px[0][i] ^ py[0][j]) <= x.room[i] + y.room[j] + 1)
            yield _survivors(x, y, w, i[near], j[near])
            at = to
    # the others: tiles of a run of rows by a run of rows
    word, bits, room, good = np.empty(TILE, np.uint64), np.empty(TILE, np.uint8), np.empty(TILE, np.int16), np.zeros(TILE, bool)
    total = np.empty(TILE, np.uint8 if w < 4 else np.uint16)
    for c in many:
        d = here[c]
        s, e, ys, ye = int(x.start[c]), int(x.stop[c]), int(y.start[d]), int(y.stop[d])
        sizes = y.size[ys:ye]
        run = max(1, min(64, TILE // (ye - ys)))
        at = np.arange(s, e, run)
        lows = at + 1 if alone else ys + np.searchsorted(sizes, np.maximum(np.minimum.reduceat(x.least[s:e], at - s), x.size[at] - y.wider[d]), "left")
        highs = ys + np.searchsorted(sizes, np.maximum.reduceat(x.most[s:e], at - s), "right")
        got: list[tuple[np.ndarray, np.ndarray]] = []
        for i0, low, high in zip(at.tolist(), lows.tolist(), highs.tolist()):
            i1 = min(i0 + run, e)
            step = TILE // run
            for j0 in range(low, high, step):
                j1 = min(j0 + step, high)
                shape, k = (i1 - i0, j1 - j0), (i1 - i0) * (j1 - j0)
                v, b, r, g, t = (a[:k].reshape(shape) for a in (word, bits, room, good, total))
                for n in range(w):
                    np.bitwise_xor(px[n, i0:i1, None], py[n, None, j0:j1], out=v)
                    if w == 1:
                        np.bitwise_count(v, out=t)
                    else:
                        np.bitwise_count(v, out=b)
                        np.add(t, b, out=t) if n else np.copyto(t, b)
                np.add(x.room[i0:i1, None] + np.int16(1), y.room[None, j0:j1], out=r)
                np.less_equal(t, r, out=g)
                pad = -(-k // 8) * 8
                good[k:pad] = False
                eights = np.flatnonzero(good[:pad].view(np.uint64))
                if len(eights):
                    hit = (eights[:, None] * 8 + np.arange(8)).reshape(-1)
                    hit = hit[good[hit]]
                    i, j = i0 + hit // shape[1], j0 + hit % shape[1]
                    got.append((i[j > i], j[j > i]) if alone else (i, j))
        if got:
            yield _survivors(x, y, w, *(np.concatenate(g) for g in zip(*got)))


def _met(share: float, batches: Iterator[pa.RecordBatch], two: bool) -> Iterator[pa.RecordBatch]:
    """(ca, cb), each once, of the blobs of a block."""
    held: tuple[list, list] = ([], [])
    for b in batches:
        for part, side, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            held[side].append([(col.astype(np.uint64) | np.uint64(part) << np.uint64(32), *rest) for col, *rest in _unpack(blob.as_buffer().to_pybytes())])
    if not held[0] or two and not held[1]:
        return
    x, y = ([_Rows(share, *(np.concatenate(c) for c in zip(*grade))) for grade in zip(*h)] for h in held)
    held[0].clear(), held[1].clear()
    waiting, n = [], 0

    def settle() -> pa.RecordBatch:
        a, b = (np.concatenate(c) for c in zip(*waiting))
        a, b = (a, b) if two else (np.minimum(a, b), np.maximum(a, b))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.empty(0, bool)
        return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first])], names=["ca", "cb"])

    for i, a in enumerate(x):
        for k, b in enumerate(y if two else x[i:]):
            if a.top + b.top < -EDGE:
                continue
            for pair in _pairs(a, b, WIDTHS[min(i, k) if two else i]):
                waiting.append(pair)
                n += len(pair[0])
                if n >= 1 << 20:
                    yield settle()
                    waiting, n = [], 0
    if waiting:
        yield settle()


@dataclass(frozen=True)
class Overlap:
    """The join: texts are alike if so large a share of the mean of their tokens is common; ``gram`` is 1 for characters, 2 for sequences;
    ``groups``, at most 8, is into how many sets a text's tokens are divided by their hash."""

    share: float
    gram: int = 2
    limit: int = LIMIT
    groups: int = 1

    def tokens(self, kinds: list[str | None], bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row, token), sorted by row: hashes of characters or sequences, repetitions told apart."""
        text = "\x1f".join(bodies) + "\x1f"
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        row = np.repeat(np.arange(len(bodies)), [len(b) + 1 for b in bodies])
        seed = np.array([hash_of(k) for k in kinds], np.uint64)
        last = len(code) - self.gram + 1
        ok = (code[:last] != 0x1F) & (code[self.gram - 1 :] != 0x1F)
        with np.errstate(over="ignore"):
            value = code[:last] * np.uint64(0x110000) + (code[1:] if self.gram == 2 else np.uint64(0)) + np.uint64(1)
            gram = mixed(value * GOLD + seed[row[:last]])
        # row and 52 bits of the hash in one number: CHUNK rows have 12 bits, and sequences that fall together only add to what is common
        both = np.sort(row[:last][ok].astype(np.uint64) << np.uint64(52) | gram[ok] >> np.uint64(12))
        start = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.empty(0, np.int64)
        nth = np.arange(len(both)) - np.repeat(start, np.diff(np.append(start, len(both))))
        with np.errstate(over="ignore"):
            return (both >> np.uint64(52)).astype(np.int64), mixed((both << np.uint64(12)) + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def group_of(self, token: np.ndarray) -> np.ndarray:
        return ((token & np.uint64(0xFFFF)) % np.uint64(self.groups)).astype(np.int64)

    def frequencies(self, prepared: DataFrame) -> np.ndarray:
        """How many tokens fall into each slot; that table is all that comes to the driver."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = np.zeros(1 << SLOTS, np.int64)
            for b in batches:
                for _, kinds, bodies in _chunks(b):
                    count += np.bincount(slot_of(self.tokens(kinds, bodies)[1]), minlength=1 << SLOTS)
            slot = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(count[slot])], names=["slot", "n"])

        got = prepared.select("kind", "cls", "body").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        return table_of(got.column("slot").to_numpy(), got.column("n").to_numpy())

    def posted(self, kinds: list[str | None], bodies: list[str], often: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, token, size, rest, print): the first tokens of each row's groups, group g of row r as r * groups + g; rest counts the
        tokens of the group from this one on, the print is theirs."""
        row, token = self.tokens(kinds, bodies)
        row = row * self.groups + self.group_of(token)
        size = np.bincount(row, minlength=len(bodies) * self.groups)
        # row, count (of a large one the first bits) and hash in one number; tokens come in one order for all rows, which a stable sort keeps
        times = (often[slot_of(token)].astype(np.float32).view(np.uint32) >> np.uint32(14)).astype(np.uint64)
        key = row.astype(np.uint64) << np.uint64(49) | times << np.uint64(32) | token >> np.uint64(32)
        rank = np.argsort(key)
        if (key[rank[1:]] == key[rank[:-1]]).any():
            rank = np.argsort(key, kind="stable")
        row, token = row[rank], token[rank]
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        rest = size[row] - place
        first = np.flatnonzero(rest >= size[row] * self.share / (2 - self.share) - EDGE)
        words = WIDTHS[int(np.searchsorted(SPARE, (rest[first] - self.share * size[row[first]]).max(initial=0), "right"))]
        bit = (mixed(token) >> np.uint64(55)).astype(np.int64) % (64 * words)
        one, word = np.uint64(1) << (bit & 63).astype(np.uint64), bit >> 6
        end = np.cumsum(size)[row[first]] - 1
        prints = np.empty((len(first), words), np.uint64)
        for w in range(words):
            whole = np.bitwise_xor.accumulate(np.where(word == w, one, np.uint64(0)))
            before = np.where(first > 0, whole[first - 1], np.uint64(0)) if len(first) else whole[:0]
            prints[:, w] = whole[end] ^ before
        return row[first], token[first], size[row[first]], rest[first], prints

    def postings(self, prepared: DataFrame, often: np.ndarray, parts: int, side: int = 0, counted: bool = False) -> DataFrame:
        """(part, side, blob): the first tokens of each class, packed by part. With ``counted``, ``often`` counts all that the other side
        has, and tokens that it has none of are left out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for cls, kinds, bodies in _chunks(b):
                    row, token, size, rest, prints = self.posted(kinds, bodies, often)
                    at, key = _squares(token, cls[row // self.groups], often, self.limit)
                    known = often[slot_of(token[at])] > 0 if counted else slice(None)
                    at, key = at[known], key[known]
                    row, token, size, rest, prints = row[at], token[at], size[at], rest[at], prints[at]
                    grade = np.searchsorted(SPARE, rest - self.share * size, "right")
                    owner = np.repeat(cls, self.groups)
                    sizes = np.zeros(len(owner), np.int64)
                    sizes[row] = size
                    # a part has one group's columns, so that of a class it holds one size
                    part = ((mixed(key) % np.uint64(max(parts // self.groups, 1))).astype(np.int64) * self.groups + self.group_of(token)) % parts
                    order = np.argsort(part, kind="stable")
                    cut = np.searchsorted(part[order], np.arange(parts + 1))
                    col = (key >> np.uint64(32)).astype(np.uint32)
                    names, blobs = [], []
                    for p in np.flatnonzero(np.diff(cut)):
                        o = order[cut[p] : cut[p + 1]]
                        names.append(p)
                        blobs.append(_pack(col[o], row[o], rest[o], prints[o], grade[o], owner, sizes))
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([side] * len(names), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "side", "blob"])

        return prepared.select("kind", "cls", "body").mapInArrow(run, BLOBS)

    def _meet(self, blobs: DataFrame, tasks: int, two: bool) -> DataFrame:
        share = self.share
        return blobs.repartitionById(tasks, F.col("part") % tasks).mapInArrow(lambda batches: _met(share, batches, two), "ca long, cb long").distinct()

    def within(self, blobs: DataFrame, tasks: int) -> DataFrame:
        """(ca, cb), ca < cb: pairs of different classes that can be alike."""
        return self._meet(blobs, tasks, False)

    def between(self, asked: DataFrame, stored: DataFrame, tasks: int) -> DataFrame:
        """(ca, cb): classes of ``asked`` (side 0) with different ones of ``stored`` (side 1) that they can be like."""
        return self._meet(asked.unionByName(stored), tasks, True)

    def near(self, pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
        """Of the pairs of classes (ca, cb) those whose whole fingerprints differ in no more bits than their sets may; left and right hold
        (kind, cls, body). What is joined and shuffled are numbers, so that texts are fetched for few."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for cls, kinds, bodies in _chunks(b):
                    row, token = self.tokens(kinds, bodies)
                    bit = (mixed(token) >> np.uint64(55)).astype(np.int64)
                    odd = (np.bincount(row * 64 * WORDS + bit, minlength=len(cls) * 64 * WORDS) & 1).astype(np.uint8)
                    prints = np.packbits(odd, bitorder="little").view(np.int64).reshape(-1, WORDS)
                    yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(np.bincount(row, minlength=len(cls)).astype(np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in prints.T)], names=["cls", "n", *words])

        words = [f"w{i}" for i in range(WORDS)]
        schema = "cls long, n int, " + ", ".join(f"{w} long" for w in words)
        sides = [d.select("kind", "cls", "body").mapInArrow(run, schema).dropDuplicates(["cls"]) for d in ([left] if left is right else [left, right])]
        if left is right:  # shuffled once for both joins
            sides[0] = sides[0].persist(StorageLevel.MEMORY_AND_DISK)
        a, b = (d.select(F.col("cls").alias(f"c{x}"), *(F.col(c).alias(f"{c}_{x}") for c in ("n", *words))) for d, x in zip((sides[0], sides[-1]), "ab"))
        apart = sum((F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words[1:]), F.bit_count(F.col("w0_a").bitwiseXOR(F.col("w0_b"))))
        return pairs.join(a, "ca").join(b, "cb").where(apart <= (1 - self.share) * (F.col("n_a") + F.col("n_b")) + EDGE).select("ca", "cb")

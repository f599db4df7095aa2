"""Problem 7: passages of held-out items inside the training corpus.

Each task gathers its documents into shards of SHARD characters and builds an FM-index of each: the suffixes sorted by their first
DEPTH characters, the Burrows-Wheeler transform of that order as a wavelet matrix (a balanced wavelet tree by levels), and the
suffixes' positions. The items' phrases, of DEPTH characters each, are searched backwards, all at once: every step is two ranks in
the matrix. As no phrase is longer than the order is deep, the ranges are those of a full index. What occurs is located by the
positions, kept for every row: stepping back to sampled ones needs the order to the end of the text, which takes some four times the
sorting, and an index lives for one shard only. Hits on about one diagonal form a passage, and each is checked by alignment. Spans
that overlap are merged.

One pass over the corpus without a shuffle for up to SENT items, which go along with the function; more take a pass for each SENT. A
shard's index is built once and searched by blocks of ITEMS.

Text is compared without regard to how it is set or written: compatibility forms, case, look-alike letters, markup, links and all
that is not a letter or digit are evened out. A phrase that more than OWNERS items share is wording, and is not searched; one that
fewer share, as where an item is an extended version of another, is searched for each of them.

Defined cases: null, empty and very short documents and items give no row; an item without a phrase of its own is searched whole
if it has DEPTH characters; copies of a document are each reported. Documents longer than a shard are cut with an overlap.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.confusables import FOREIGN, prototypes

SHARD = 1_500_000
DEPTH = 12
#: Distance of the phrases of an item; a run of DEPTH + STRIDE - 1 equal characters is certain to hold one.
STRIDE = 3
#: Items searched at a time, and items that go along with one pass.
ITEMS, SENT = 5_000, 50_000
#: Items that may share a phrase.
OWNERS = 3
#: A passage holds this part of an item, and in it at least this part of the characters is the same.
PART, SAME = 0.5, 0.75
#: Equal runs below this length are chance. For an alignment to be tried, this share of the phrases that an item has alone must lie on
#: about one diagonal, or WORDED of all its phrases, as wording in common lies there too.
RUN, HITS, WORDED = 5, 0.15, 0.25
#: Characters by which edits may shift a passage.
SHIFT = 40

MARKUP = re.compile(r"\]\([^()\s]*\)|</?[A-Za-z][^<>]*>|&#?\w+;")
NOISE = re.compile(r"[\W_]+")


class Evener:
    """Brings text to the form in which it is compared."""

    def __init__(self, table: dict[int, str]):
        self.letters = {c: p for c, p in table.items() if len(p) == 1 and p.isascii() and p.isalpha() and FOREIGN.match(chr(c))}

    def __call__(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFKC", text)
            if FOREIGN.search(text):
                text = text.translate(self.letters)
        if "<" in text or "](" in text or "&" in text:
            text = MARKUP.sub("", text)
        return NOISE.sub("", text.lower())

    def places(self, text: str) -> tuple[str, np.ndarray]:
        """The evened text and, for each of its characters, the place in the text that it comes from."""
        gone = np.zeros(len(text), bool)
        for m in MARKUP.finditer(text):
            gone[m.start() : m.end()] = True
        out, at = [], []
        i = 0
        while i < len(text):
            j = i + 1
            while j < len(text) and unicodedata.combining(text[j]):
                j += 1
            if not gone[i]:
                s = NOISE.sub("", unicodedata.normalize("NFKC", text[i:j]).translate(self.letters).lower())
                out.append(s)
                at += [i] * len(s)
            i = j
        return "".join(out), np.array(at, np.int64)


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(n // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.zeros = n - int(counts.sum())

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask).astype(np.int64)


class FMIndex:
    """Counts and places of phrases of at most ``depth`` symbols in a text of symbols; 0 separates documents."""

    def __init__(self, text: np.ndarray, depth: int = DEPTH):
        self.alphabet, codes = np.unique(text, return_inverse=True)
        n = len(codes)
        rank, known = codes.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while known < depth:
            step = min(known, depth - known)
            follow = np.zeros(n, np.int64)
            follow[: n - step] = rank[step:] + 1
            key = rank * (n + 2) + follow
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            known += step
        self.places = order
        symbols = codes[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(self.alphabet)))])
        self.levels: list[tuple[int, Bits]] = []
        self.start = np.zeros(len(self.alphabet), np.int64)
        height = max(1, int(len(self.alphabet) - 1).bit_length())
        all_codes = np.arange(len(self.alphabet))
        at = np.zeros(len(self.alphabet), np.int64)
        for shift in range(height - 1, -1, -1):
            bit = (symbols >> shift & 1).astype(bool)
            bits = Bits(bit)
            self.levels.append((shift, bits))
            at = self._down(bits, (all_codes >> shift & 1).astype(bool), at)
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self.start = at

    @staticmethod
    def _down(bits: Bits, one: np.ndarray, i: np.ndarray) -> np.ndarray:
        ones = bits.ones(i)
        return np.where(one, bits.zeros + ones, i - ones)

    def rank(self, code: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each code before row i of the transform."""
        for shift, bits in self.levels:
            i = self._down(bits, (code >> shift & 1).astype(bool), i)
        return i - self.start[code]

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (low, high) of each phrase, by backward search; phrases is a matrix of symbols."""
        code = np.searchsorted(self.alphabet, phrases)
        code[code == len(self.alphabet)] = 0
        known = (self.alphabet[code] == phrases).all(axis=1)
        low, high = np.zeros(len(phrases), np.int64), np.where(known, self.first[-1], 0)
        for j in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero(high > low)
            if not len(live):
                break
            c = code[live, j]
            low[live], high[live] = self.first[c] + self.rank(c, low[live]), self.first[c] + self.rank(c, high[live])
        return low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place) of every occurrence."""
        count = np.maximum(high - low, 0)
        phrase = np.repeat(np.arange(len(low)), count)
        row = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return phrase, self.places[row]


def phrases_of(items: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(phrases, item, offset, alone): the phrases that few items have, as symbols, some for every STRIDE characters of an item, and
    whether no other item has them."""
    owners: dict[str, set[int]] = {}
    for i, t in enumerate(items):
        for k in range(len(t) - DEPTH + 1):
            have = owners.setdefault(t[k : k + DEPTH], set())
            if len(have) <= OWNERS:
                have.add(i)
    got, item, offset, alone = [], [], [], []
    for i, t in enumerate(items):
        own = [k for k in range(len(t) - DEPTH + 1) if len(owners[t[k : k + DEPTH]]) <= OWNERS]
        last = -STRIDE
        for k in own or range(0, max(0, len(t) - DEPTH + 1), STRIDE):
            if k - last >= STRIDE:
                got.append(t[k : k + DEPTH])
                item.append(i)
                offset.append(k)
                alone.append(len(owners[t[k : k + DEPTH]]) == 1)
                last = k
    symbols = np.frombuffer("".join(got).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, DEPTH) if got else np.empty((0, DEPTH), np.uint32)
    return symbols, np.array(item, np.int64), np.array(offset, np.int64), np.array(alone, bool)


def passage(item: str, text: str) -> tuple[int, int] | None:
    """Where the text holds PART of the item as one passage: first and last place of what matches, or nothing."""
    blocks = [b for b in SequenceMatcher(None, item, text, autojunk=False).get_matching_blocks() if b.size >= RUN]
    if not blocks:
        return None
    need = -(-len(item) * int(PART * 100) // 100)
    same, place = np.zeros(len(item) + 1, np.int64), np.full(len(item), -1, np.int64)
    for b in blocks:
        same[b.a + 1 : b.a + b.size + 1] = 1
        place[b.a : b.a + b.size] = np.arange(b.b, b.b + b.size)
    total = np.cumsum(same)
    good = np.flatnonzero(total[need:] - total[:-need] >= SAME * need)
    for g in good:
        inside = place[g : g + need]
        inside = inside[inside >= 0]
        if inside[-1] - inside[0] < 1.5 * need + SHIFT:
            return int(place[place >= 0][0]), int(place[place >= 0][-1]) + 1
    return None


def _shards(texts: list[str], overlap: int) -> Iterator[list[tuple[int, int, str]]]:
    """Runs of (document, start, part) of about SHARD characters."""
    run, size = [], 0
    for d, t in enumerate(texts):
        for s in range(0, max(1, len(t) - overlap), SHARD):
            part = t[s : s + SHARD + overlap]
            if len(part) < DEPTH:
                continue
            run.append((d, s, part))
            size += len(part)
            if size >= SHARD:
                yield run
                run, size = [], 0
    if run:
        yield run


def _indexed(run: list[tuple[int, int, str]]) -> FMIndex:
    return FMIndex(np.frombuffer(("\0".join(p for _, _, p in run) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32))


def _search(index: FMIndex, run: list[tuple[int, int, str]], items: list[str], phrases: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, start, end) of the passages in a shard, in places of the evened documents."""
    symbols, item, offset, alone = phrases
    begins = np.cumsum([0, *(len(p) + 1 for _, _, p in run)])
    phrase, place = index.locate(*index.ranges(symbols))
    part = np.searchsorted(begins, place, "right") - 1
    shift = place - begins[part] - offset[phrase]
    order = np.lexsort((shift, item[phrase], part))
    part, which, shift, single = part[order], item[phrase][order], shift[order], alone[phrase][order]
    fresh = np.append(True, (part[1:] != part[:-1]) | (which[1:] != which[:-1]) | (shift[1:] - shift[:-1] > SHIFT)) if len(part) else np.empty(0, bool)
    start = np.flatnonzero(fresh)
    end = np.append(start[1:], len(part)).astype(np.int64)
    every, own = np.bincount(item, minlength=len(items)), np.bincount(item[alone], minlength=len(items))
    hits = np.concatenate([[0], np.cumsum(single)])
    hits = hits[end] - hits[start]
    enough = (end - start >= WORDED * every[which[start]]) | (hits >= np.maximum(HITS * own[which[start]], 1))
    for a, b in zip(start[enough], end[enough]):
        d, s, t = run[part[a]]
        want = items[which[a]]
        low = max(0, int(shift[a]) - SHIFT)
        got = passage(want, t[low : int(shift[b - 1]) + len(want) + SHIFT])
        if got:
            yield d, int(which[a]), s + low + got[0], s + low + got[1]


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_key, start, end): passages in the documents, in code points of the text, merged where they overlap."""
    even = Evener(prototypes(docs.sparkSession))
    listed = sorted(((r[0], even(r[1])) for r in items.select(item_key, item_text).where(F.col(item_text).isNotNull()).toLocalIterator()), key=lambda r: r[0])
    passes = [listed[i : i + SENT] for i in range(0, len(listed), SENT)] or [[]]
    slim = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = T.StructType([T.StructField("k", slim.schema["k"].dataType), T.StructField("item", items.schema[item_key].dataType), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def one(sent: list) -> DataFrame:
        names, wanted = [n for n, _ in sent], [t for _, t in sent]
        blocks = [(low, wanted[low : low + ITEMS], phrases_of(wanted[low : low + ITEMS])) for low in range(0, len(wanted), ITEMS)]
        overlap = 4 * max(map(len, wanted), default=0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys: list = []
            texts: list[str] = []
            size = 0

            def flush() -> pa.RecordBatch:
                found: dict[tuple[int, int], list[tuple[int, int]]] = {}
                for shard in _shards([even(t) for t in texts], overlap):
                    index = _indexed(shard)
                    for low, some, phrases in blocks:
                        for d, i, s, e in _search(index, shard, some, phrases):
                            found.setdefault((d, low + i), []).append((s, e))
                rows: tuple[list, ...] = ([], [], [], [])
                places: dict[int, np.ndarray] = {}
                for (d, i), spans in sorted(found.items()):
                    if d not in places:
                        places[d] = even.places(texts[d])[1]
                    at = places[d]
                    for s, e in merged(spans):
                        s, e = min(s, len(at) - 1), min(e, len(at))
                        for column, x in zip(rows, (keys[d], names[i], int(at[s]), int(at[e - 1]) + 1)):
                            column.append(x)
                return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds)], names=["k", "item", "start", "end"])

            for b in batches:
                kinds = [b.schema.field(0).type, item_type, pa.int64(), pa.int64()]
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if t:
                        keys.append(k)
                        texts.append(t)
                        size += len(t)
                    if size >= SHARD:
                        yield flush()
                        keys, texts, size = [], [], 0
            if texts:
                yield flush()

        return slim.mapInArrow(run, schema)

    item_type = pa.int64() if items.schema[item_key].dataType == T.LongType() else pa.int32() if items.schema[item_key].dataType == T.IntegerType() else pa.string()
    out = one(passes[0])
    for sent in passes[1:]:
        out = out.unionByName(one(sent))
    return out.withColumnsRenamed({"k": key, "item": item_key})


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch made one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out

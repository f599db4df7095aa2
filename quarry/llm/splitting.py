"""Problem 1: oversized texts cut into pieces at natural boundaries, with an overlap.

Every position between two characters has a boundary strength. A sparse table of range maxima over the strengths (level k
holds, for each position, the strongest cut among the 2**k that follow) answers "the strongest cut in this window" in two
look-ups; of equally strong cuts the rightmost wins. A piece ends at the strongest cut of the window of permissible lengths,
and the next begins ``overlap`` characters before, or later at the first sentence or line that begins within them. Where a
window has no boundary, the piece is cut at its full length.

Rows are independent, so it is one ``mapInArrow`` over the rows that are too long: the length test is a JVM filter, and
nothing is shuffled. Time and memory are O(n log limit) of one text, whatever its length.

Defined cases: null, empty and short texts are one piece, as they are, in ``split`` with ``whole=True``, and none otherwise.
A cut never falls between CR and LF, within a sequence of a base and its marks, or within an emoji sequence, but at a limit
where nothing else can be done. Repeated rows are split alike; columns of other names pass through untouched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT, OVERLAP = 2000, 200
#: Strengths, weakest first: no cut at all, anywhere, after a word, a clause, a sentence, a line, before a list item or table row,
#: a paragraph, a heading.
NEVER, ANY, WORD, CLAUSE, SENTENCE, LINE, ITEM, PARAGRAPH, HEADING = range(9)
#: Signs that end a sentence and a clause.
SENTENCE_END = "。！？!?；;…"
CLAUSE_END = "，、,：:）)】」』》"
CLOSING = "”’\"'）)】」』》»"


def strengths(text: str) -> np.ndarray:
    """Strength of the cut before each position 0..len(text); the ends are NEVER."""
    n = len(text)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(n + 1, NEVER, np.int8)
    if n < 2:
        return out
    before, after = code[:-1], code[1:]
    space = np.isin(code, np.array([0x20, 0x09, 0xA0, 0x3000, 0x0B, 0x0C], np.uint32))
    line = (code == 10) | (code == 13)
    s = np.full(n - 1, ANY, np.int8)
    wide = lambda c: (c >= 0x2E80) & (c < 0xFF00)
    s[space[:-1] & ~space[1:] & ~line[1:]] = WORD
    s[wide(before) & ~wide(after) | ~wide(before) & wide(after)] = WORD
    marks = lambda signs: np.isin(before, np.frombuffer(signs.encode("utf-32-le"), np.uint32))
    s[marks(CLAUSE_END) & ((before > 0x7F) | space[1:])] = CLAUSE
    ends = marks(SENTENCE_END)
    dot = (before == 0x2E) & (space[1:] | line[1:])
    s[(ends & ((before > 0x7F) | space[1:] | line[1:])) | dot] = SENTENCE
    # what closes a sentence stays with it
    closing = np.isin(after, np.frombuffer(CLOSING.encode("utf-32-le"), np.uint32))
    for i in np.flatnonzero((s == SENTENCE) & closing):
        j = i + 1
        while j < n - 1 and text[j + 1] in CLOSING:
            j += 1
        s[i] = ANY
        if j < n - 1:
            s[j] = max(s[j], SENTENCE)
    # a space after a sentence or clause belongs to it: the cut is behind the space
    for i in np.flatnonzero(((s == SENTENCE) | (s == CLAUSE)) & space[1:]):
        j = i + 1
        while j < n - 1 and space[j + 1]:
            j += 1
        if j < n - 1 and not line[j + 1]:
            s[j], s[i] = max(s[j], s[i]), ANY
    fence = False
    start = 0
    blank = True  # the line before the current one
    while start < n:
        end = start
        while end < n and not line[end]:
            end += 1
        stop = end
        if stop < n:
            stop += 2 if code[stop] == 13 and stop + 1 < n and code[stop + 1] == 10 else 1
        head = text[start:end].lstrip()
        if start:
            if fence:
                kind = LINE
            elif head.startswith("#"):
                kind = HEADING
            elif blank and head:
                kind = PARAGRAPH
            elif head[:2] in ("- ", "* ", "+ ", "> ") or head[:1] == "|" or head.split(". ")[0].isdigit():
                kind = ITEM
            else:
                kind = LINE
            s[start - 1] = kind
        if head.startswith(("```", "~~~")):
            fence = not fence
        blank = not head and not fence
        start = stop
    s[(before == 13) & (after == 10)] = NEVER
    for i in np.flatnonzero((after == 0x200D) | (before == 0x200D) | ((after >= 0x300) & (after < 0x1F00)) | ((after >= 0xFE00) & (after < 0xFE10)) | ((after >= 0x1F3FB) & (after < 0x1F400))):
        c = chr(after[i])
        if unicodedata.combining(c) or c in "\u200d" or 0xFE00 <= after[i] < 0xFE10 or 0x1F3FB <= after[i] < 0x1F400 or before[i] == 0x200D:
            s[i] = NEVER
    out[1:n] = s
    return out


class RangeMax:
    """Sparse table of range maxima with the rightmost position of each; windows of at most ``widest`` positions."""

    def __init__(self, values: np.ndarray, widest: int):
        n = len(values)
        # strength and position in one number: the maximum is the strongest, of equals the rightmost
        self.levels = [values.astype(np.int64) * (n + 1) + np.arange(n)]
        self.base = n + 1
        width = 1
        while 2 * width <= min(widest, n):
            last = self.levels[-1]
            self.levels.append(np.maximum(last[:-width], last[width:]))
            width *= 2

    def best(self, low: int, high: int) -> tuple[int, int]:
        """(strength, position) of the strongest cut in low..high, both included."""
        k = (high - low + 1).bit_length() - 1
        level = self.levels[k]
        return divmod(int(max(level[low], level[high - (1 << k) + 1])), self.base)


def spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Start and end of each piece, in code points."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below limit")
    n = len(text)
    if n <= limit:
        return [(0, n)]
    strength = strengths(text)
    table = RangeMax(strength, limit)
    out, start, end = [], 0, 0
    while n - start > limit:
        # shorter pieces than half the limit are not worth a stronger boundary; a piece must pass the last one's end
        low, high = max(start + max(limit // 2, overlap + 1), end + 1), start + limit
        power, cut = table.best(low, high)
        if power <= ANY:
            cut = high if strength[high] != NEVER or power == NEVER else cut
        end = cut
        out.append((start, end))
        start = end - overlap
        if overlap:
            begins = np.flatnonzero(strength[start:end] >= SENTENCE)
            if len(begins):
                start += int(begins[0])
    out.append((start, n))
    return out


def split(df: DataFrame, text: str, limit: int = LIMIT, overlap: int = OVERLAP, whole: bool = False) -> DataFrame:
    """The rows of ``df`` whose text is longer than ``limit``, once per piece, with ``piece_no`` (from 1), ``pieces``,
    ``piece_start``, ``piece_end`` and ``piece``; with ``whole`` the other rows too, as one piece."""
    added = T.StructType([T.StructField("piece_no", T.IntegerType()), T.StructField("pieces", T.IntegerType()), T.StructField("piece_start", T.LongType()), T.StructField("piece_end", T.LongType()), T.StructField("piece", T.StringType())])
    clash = {f.name for f in added} & set(df.columns)
    if clash:
        raise ValueError(f"columns of the result are taken: {sorted(clash)}")
    long = df if whole else df.where(F.length(text) > limit)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, no, total, starts, ends, pieces = [], [], [], [], [], []
            for i, t in enumerate(b.column(at).to_pylist()):
                cuts = spans(t or "", limit, overlap)
                for k, (s, e) in enumerate(cuts, 1):
                    row.append(i)
                    no.append(k)
                    total.append(len(cuts))
                    starts.append(s)
                    ends.append(e)
                    pieces.append(None if t is None else t[s:e])
            new = [pa.array(no, pa.int32()), pa.array(total, pa.int32()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(pieces, pa.string())]
            kept = b.take(pa.array(row, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], names=[*b.schema.names, *added.names])

    return long.mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))

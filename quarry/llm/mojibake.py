"""Problem 8: text that was decoded with a wrong character encoding.

The words of scripts written without spaces are their characters, and so are the accented letters and signs of the others: what
an encoding garbles is each for itself. A census of all documents gives every distinct character and how many documents have it
(bounded by Unicode, whatever the corpus). From the clean ones the garbled forms under all encoding chains are generated: right
encoding written, wrong one read, once or twice. The documents' tokens are looked up in that hash table; a hit is verified by
transcoding the whole stretch, and the original takes its place. The table is at most a few entries per character, so it is
broadcast with the function, and the look-up is a hash join without a shuffle.

Where a character can't be told from its form, because the wrong decoder put U+FFFD for it, words are needed: ``lossy_words``
joins the documents' words that hold U+FFFD with the forms of every distinct corpus word that has an accent, by a shuffled hash
join, and takes the original if there is just one.

Chains: UTF-8 read as Windows-1252, Latin-1, Windows-1251, Mac Roman, code pages 437 and 850, Windows-1250,
KOI8-R, GBK, Big5 or Shift-JIS, the first of them
twice over; GBK read as Latin-1, Windows-1252, Big5 or UTF-8; UTF-8 with U+FFFD read as GBK; Latin-1 read as UTF-8.

Defined cases: null and empty texts are no cases and stay as they are; what can't be restored stays, or keeps U+FFFD for
the bytes that are lost; a quoted U+FFFD that stands alone is taken as meant. Ties between chains go to the one listed first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOST = "\ufffd"
SINGLE = ("cp1252", "cp1251", "mac_roman", "cp437", "cp850", "cp1250", "koi8_r")
DOUBLE = ("gbk", "cp950", "cp932")
#: A character counts as clean if at least so many documents, and this share of them, have it.
CLEAN_DOCS, CLEAN_SHARE = 3, 0.0005
#: Characters of this share of the documents are too common to be garbled, unless they are part of a form under Windows-1252.
COMMON_SHARE = 0.05
#: Marks that stand alone between ASCII letters.
MARKS = "‘’“”–—…•"
#: Originals in a row that make a case, where each alone might be chance.
ROW = 3


def census(docs: DataFrame, text: str) -> DataFrame:
    """(ch, docs): every distinct character outside ASCII and the number of documents that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[str, int] = {}
        for b in batches:
            for t in b.column(0).to_pylist():
                if t and not t.isascii():
                    for c in set(t):
                        count[c] = count.get(c, 0) + 1
        wide = [c for c in count if c > "\x7f"]
        yield pa.RecordBatch.from_arrays([pa.array(wide, pa.string()), pa.array([count[c] for c in wide], pa.int64())], names=["ch", "docs"])

    return docs.select(F.col(text).alias("t")).mapInArrow(run, "ch string, docs long").groupBy("ch").agg(F.sum("docs").alias("docs"))


def byte_image(codec: str) -> dict[str, int]:
    """Byte of each character of a one-byte encoding; bytes that it leaves undefined stand for the control of that number."""
    image = {}
    for b in range(0x80, 0x100):
        image[bytes([b]).decode(codec, "replace")] = b
        if codec == "cp1252":
            image.setdefault(chr(b), b)  # Latin-1 reads them all so
    image.pop(LOST, None)
    return image


class Table:
    """Forms of the clean characters, and what restores a text with them. ``docs``: documents by character; n: of how many."""

    def __init__(self, docs: dict[str, int], n: int):
        least = max(CLEAN_DOCS, CLEAN_SHARE * n)
        self.docs = docs
        common = {c for c, k in docs.items() if k >= max(CLEAN_DOCS, COMMON_SHARE * n)}
        clean = {c for c, k in docs.items() if k >= least and c != LOST}
        self.forms: dict[str, dict[str, str]] = {codec: {} for codec in SINGLE}
        self.tokens: dict[str, re.Pattern] = {}
        self.bytes: dict[str, dict[str, int]] = {}
        for codec in SINGLE:
            image = self.bytes[codec] = byte_image(codec)
            back: dict[int, list[str]] = {}
            for c, b in image.items():
                back.setdefault(b, []).append(c)
            part = lambda low, high: "[" + "".join(re.escape(c) for b in range(low, high + 1) for c in back.get(b, ())) + "]"  # noqa: B023, E731
            follow = part(0x80, 0xBF)
            self.tokens[codec] = re.compile(f"{part(0xC2, 0xDF)}{follow}|{part(0xE0, 0xEF)}{follow}{{2}}|{part(0xF0, 0xF4)}{follow}{{3}}")
            for c in clean:
                for form in self._written(c.encode(), back):
                    self.forms[codec][form] = c
        # what a wrong decoder makes is never common, be a large source decoded wrongly as a whole
        self.common = common - {LOST} - set("".join(self.forms[SINGLE[0]])) - set("锟斤拷")
        # a form that is itself clean text says nothing
        west = {c for c in clean if c.isalpha() and c < "\u0250"}
        for codec in SINGLE:
            self.forms[codec] = {f: c for f, c in self.forms[codec].items() if not all(x in west and docs[x] > docs[c] for x in f)}
        self.clean = clean
        self.hanzi = {c for c in clean if "\u3000" <= c <= "\u9fff" or "\uff00" <= c <= "\uffef"}
        self.wide = {c for c in self.hanzi if docs[c] >= max(CLEAN_DOCS, 10 * CLEAN_SHARE * n)}
        self.pairs = {f: c for c in self.hanzi for f in [self._read(c, "gbk", "latin-1")] if f and len(f) == 2}
        self.big5 = {f: c for c in self.wide for f in [self._read(c, "gbk", "cp950")] if f and len(f) == 1 and f not in self.common}
        self.accents = {f: c for c in clean if c < "\u0180" for f in [self._read(c, "utf-8", "gbk")] if f and len(f) == 1 and c.isalpha()}
        any_of = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]" if chars else "(?!)"
        self.two = re.compile("(?:[\x81-\xfe][\xa1-\xfe]){2,}")
        self.odd = re.compile(any_of(self.big5) + "{3,}")
        self.letter = re.compile("(?<=[A-Za-z\u00c0-\u024f])" + any_of(self.accents) + "(?![\u2e80-\uffef])|(?<![\u2e80-\uffef])" + any_of(self.accents) + "(?=[A-Za-z])")
        self.run = re.compile("[^\x00-\x7f]+")
        self.uncommon = re.compile("[^\x00-\x7f" + "".join(map(re.escape, sorted(self.common))) + "]")
        self.lost = re.compile(f"(?<![“\"'‘「『(（])(?:{LOST})|{LOST}(?![”\"'’」』)）])")
        self.burnt = re.compile("(?:锟斤拷|锟斤|斤拷锟)")

    @staticmethod
    def _written(data: bytes, back: dict[int, list[str]]) -> list[str]:
        out = [""]
        for b in data:
            out = [x + c for x in out for c in back.get(b, ())]
        return out

    @staticmethod
    def _read(c: str, right: str, wrong: str) -> str | None:
        try:
            return c.encode(right).decode(wrong)
        except UnicodeError:
            return None

    # one-byte encodings

    def _once(self, text: str, codec: str) -> tuple[str, int]:
        """UTF-8 read as a one-byte encoding. But for Windows-1252, forms of letters alone may be words: they need ROW hits."""
        forms, hits, sure = self.forms[codec], 0, codec == SINGLE[0]

        def put(m: re.Match) -> str:
            nonlocal hits, sure
            c = forms.get(m[0])
            if c is None:
                return m[0]
            hits += 1
            sure |= not m[0].isalpha()
            return c

        new = self.tokens[codec].sub(put, text)
        return (new, hits) if sure or hits >= ROW else (text, 0)

    def _twice(self, text: str) -> tuple[str, int]:
        """Windows-1252 twice over: stretches of tokens whose originals are tokens again."""
        tokens, image = self.tokens["cp1252"], self.bytes["cp1252"]
        hits = 0

        def put(m: re.Match) -> str:
            nonlocal hits
            inner = bytes(image[c] for c in m[0]).decode("utf-8", "replace")
            out, n = self._once(inner, "cp1252")
            if not n or LOST in out:
                return m[0]
            hits += n
            return out

        return re.sub(f"(?:{tokens.pattern})+", put, text), hits

    # encodings of two bytes

    def _latin_pairs(self, text: str) -> tuple[str, int]:
        """GBK read as Latin-1: at least two characters in a row, in one of both phases."""
        hits = 0

        def put(m: re.Match) -> str:
            nonlocal hits
            s = m[0]
            got = [self.pairs.get(s[i : i + 2]) for i in range(0, len(s), 2)]
            if None in got:
                return s
            hits += len(got)
            return "".join(got)

        out = self.two.sub(put, text)
        return out, hits

    def _utf8_as(self, text: str, codec: str) -> tuple[str, int]:
        """UTF-8 read as an encoding of two bytes: stretches whose bytes are UTF-8 of clean characters, ROW of them at least."""
        hits = 0

        def put(m: re.Match) -> str:
            nonlocal hits
            s = m[0]
            if not self.uncommon.search(s):
                return s
            data, start = bytearray(), []
            for i, c in enumerate(s):
                try:
                    b = c.encode(codec)
                except UnicodeError:
                    b = b"\xff"
                start += [i] * len(b)
                data += b
            out, at, n = [], 0, 0
            for x in re.finditer(rb"(?:[\xe2-\xef][\x80-\xbf]{2}|[\xc3\xd0\xd1\xce\xcf][\x80-\xbf]|[\x20-\x7e]|[\xe2-\xef][\x80-\xbf]?\xff\x3f?|\xff){2,}", bytes(data)):
                got = x[0].replace(b"\xff", b"").decode("utf-8", "replace")
                known = sum(c in self.clean and (c in self.wide or c < "\u2e80") for c in got if c > "\x7f")
                total = sum(c > "\x7f" and c != LOST for c in got)
                quoting = known and known == total and len(x[0]) == len(data) and all(c in MARKS or c.isascii() for c in got)
                if not quoting and (known < ROW or known < 0.7 * total):
                    continue
                low, high = start[x.start()], start[x.end() - 1] + 1
                if low < at:
                    continue
                out += [s[at:low], x[0].decode("utf-8", "replace")]
                at, n = high, n + known
            hits += n
            return "".join(out) + s[at:]

        return self.run.sub(put, text), hits

    def _gbk_as_big5(self, text: str) -> tuple[str, int]:
        """GBK read as Big5: stretches around ROW forms in a row."""
        hits = 0

        def put(m: re.Match) -> str:
            nonlocal hits
            s = m[0]
            if not self.odd.search(s):
                return s
            out = []
            for c in s:
                got = self.big5.get(c)
                if got is None and c not in self.common:
                    try:
                        got = c.encode("cp950").decode("gbk")
                    except UnicodeError:
                        got = None
                out.append(got or c)
                hits += got is not None
            return "".join(out)

        return self.run.sub(put, text), hits

    def _accents_as_gbk(self, text: str) -> tuple[str, int]:
        """Accented letters of Western words, read as ideographs."""
        found = [m for m in self.letter.finditer(text) if m[0] not in self.common or text[m.end() : m.end() + 1].isalpha() and text[m.end() : m.end() + 1].isascii()]
        if not found:
            return text, 0
        return self.letter.sub(lambda m: self.accents[m[0]], text), len(found)

    def restore(self, text: str) -> tuple[str, int, bool]:
        """The text with originals put in, the number of them, and whether something is garbled beyond that."""
        text, total = self._twice(text)
        # several one-byte encodings may explain a part of a text: the one that explains most comes first
        hits = {codec: self._once(text, codec)[1] for codec in SINGLE}
        for codec in sorted((c for c in SINGLE if hits[c]), key=lambda c: -hits[c]):
            text, n = self._once(text, codec)
            total += n
        text, n = self._latin_pairs(text)
        total += n
        if self.uncommon.search(text):
            for codec in DOUBLE:
                text, n = self._utf8_as(text, codec)
                total += n
            for step in (self._gbk_as_big5, self._accents_as_gbk):
                text, n = step(text)
                total += n
        return text, total, bool(self.burnt.search(text) or self.lost.search(text))


def table_of(docs: DataFrame, text: str) -> Table:
    """The table for a corpus; what comes to the driver is one row per distinct character."""
    n = docs.where(F.col(text).isNotNull()).count()
    return Table({r["ch"]: r["docs"] for r in census(docs, text).where(F.col("docs") >= CLEAN_DOCS).collect()}, n)


def restored(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, originals, lost) of the documents concerned: text as far as it can be restored."""
    table = table_of(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, texts, counts, lost = [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if not t or not table.uncommon.search(t):
                    continue
                new, n, rest = table.restore(t)
                if n or rest:
                    keep.append(i)
                    texts.append(new)
                    counts.append(n)
                    lost.append(rest)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int32())), pa.array(texts, pa.string()), pa.array(counts, pa.int32()), pa.array(lost, pa.bool_())], names=["k", "text", "originals", "lost"])

    slim = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = T.StructType([T.StructField("k", slim.schema["k"].dataType), T.StructField("text", T.StringType()), T.StructField("originals", T.IntegerType()), T.StructField("lost", T.BooleanType())])
    return slim.mapInArrow(run, schema).withColumnRenamed("k", key)


def lossy_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, word, original): words that hold U+FFFD and have just one original among the corpus words with accents."""
    piece = "[^%s%p{Punct}“”«»、。，]+".replace("%s", "@s").replace("%p", "@p").replace("@", chr(92))
    words = docs.select(F.col(key).alias("k"), F.explode(F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(f"({piece})"), F.lit(1)))).alias("w"))
    broken = words.where(F.col("w").contains(LOST) & F.col("w").rlike("[A-Za-z]"))
    accented = words.where(F.col("w").rlike("^[A-Za-z’'@x{C0}-@x{17F}]*[’@x{C0}-@x{17F}][A-Za-z’'@x{C0}-@x{17F}]*$".replace("@", chr(92)))).groupBy("w").agg(F.count("*").alias("n"))
    forms = accented.select(F.regexp_replace("w", "[’@x{C0}-@x{17F}]".replace("@", chr(92)), LOST).alias("form"), "w").groupBy("form").agg(F.min("w").alias("original"), F.count("*").alias("n")).where("n = 1")
    return broken.join(forms, broken["w"] == forms["form"]).select(F.col("k").alias(key), F.col("w").alias("word"), "original")

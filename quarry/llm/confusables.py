"""Problem 4: text that looks the same brought to one form of characters.

The skeleton of a text: decompose, replace every character by its prototype from the table of look-alikes, decompose again;
texts of equal skeleton look the same. The table is the Unicode confusables data as ICU holds it, read on the driver from the
ICU library that Spark ships (``prototypes``); it has some thousand entries, whatever the data, and goes along with the function.

``consistent`` writes a text in the usual characters. What it proposes for a word is taken only if the skeletons of both
are equal (compatibility forms unified), so that nothing changes its look; what is meant as it is has no proposal:

* invisible characters go, unless they have a function: joiners inside emoji and in scripts that join, selectors after a symbol,
  direction marks beside right-to-left text;
* spaces of other widths become U+0020; the ideographic space and line ends stay;
* full-width letters and digits, Kangxi radicals, compatibility ideographs, typographic ligatures, mathematical alphabets,
  half-width Katakana become the usual characters; full-width punctuation, circled numbers, superscripts and unit signs stay;
* a base with combining marks, or any other form that is not composed, becomes the precomposed character if there is one;
* a word that has letters of two scripts, or only look-alikes where no other word of the text is of that script, becomes Latin
  if all letters of the other script have Latin prototypes. Single letters and words of one script stay.

Rows are independent: one pass, the rows without any uncommon character filtered out in the JVM, no shuffle but for the grouping
of distinct words by skeleton. Defined cases: null stays null and is no case; empty stays empty.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Ranges in which look-alikes of other characters are sought.
RANGES = ((0x21, 0x7E), (0xA0, 0x52F), (0x531, 0x58A), (0x1C80, 0x1C88), (0x1D00, 0x1FFF), (0x2000, 0x206F), (0x2100, 0x218F), (0x2C60, 0x2C7F), (0x2E80, 0x2FD5), (0xA640, 0xA69F), (0xA720, 0xA7FF), (0xAB30, 0xABBF), (0xF900, 0xFAFF), (0xFB00, 0xFB06), (0xFF01, 0xFFEF), (0x1D400, 0x1D7FF), (0x2F800, 0x2FA1D))
#: Characters that may matter, as a class of Java and Python alike: all but ASCII, the letters and signs of Western languages,
#: common punctuation and symbols, and the ideographs, kana and full-width punctuation of East Asian text.
COMMON = "\\x{0}-\\x{7F}\\x{A1}-\\x{AC}\\x{AE}-\\x{17E}\\x{2010}-\\x{2027}\\x{2030}-\\x{205E}\\x{20A0}-\\x{20BF}\\x{2190}-\\x{2328}\\x{232B}-\\x{2ADB}\\x{2ADD}-\\x{2BFF}\\x{3000}-\\x{3029}\\x{3030}-\\x{3098}\\x{309B}-\\x{312F}\\x{3190}-\\x{9FFF}\\x{FF01}-\\x{FF0F}\\x{FF1A}-\\x{FF20}\\x{FF3B}-\\x{FF40}\\x{FF5B}-\\x{FF64}"
INVISIBLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff]")
SPACES = re.compile("[\u00a0\u1680\u2000-\u200a\u202f\u205f]")
COMPATIBLE = re.compile("[\uff10-\uff19\uff21-\uff3a\uff41-\uff5a\u2e80-\u2fd5\uf900-\ufaff\ufb00-\ufb06\uff66-\uff9f\U0001d400-\U0001d7ff\U0002f800-\U0002fa1d]")
WORD = re.compile("[^\\W\\d_](?:[^\\W_]|[\u0300-\u036f])*")
FOREIGN = re.compile("[\u0250-\u02af\u0370-\u052f\u0531-\u058a\u13a0-\u13ff\u1d00-\u1dbf\u1f00-\u1fff\u2170-\u217f\u2c80-\u2cff\ua640-\ua69f\uab30-\uab5a]")
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u1e00-\u1eff]")


def prototypes(spark: SparkSession) -> dict[int, str]:
    """Prototype of each character that has another one, from ICU; for translate()."""
    jvm = spark.sparkContext._jvm
    checker = jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    table: dict[int, str] = {}
    for low, high in RANGES:
        chars = [chr(c) for c in range(low, high + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co", "Cc")]
        plain = [c for c in chars if unicodedata.normalize("NFD", c) == c]  # the others are decomposed before
        for c, p in zip(plain, checker.getSkeleton("\n".join(plain)).split("\n")):
            if p != c:
                table[ord(c)] = p
    return table


def skeleton(text: str, table: dict[int, str]) -> str:
    """Decompose, replace by prototypes, decompose again."""
    return unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).translate(table))


def _functional(text: str, i: int) -> bool:
    """Whether the invisible character at i does something there."""
    c, before, after = text[i], text[i - 1 : i], text[i + 1 : i + 2]
    if c in "\u200c\u200d":
        joins = lambda x: bool(x) and (0x0590 <= ord(x) <= 0x0DFF or 0x1800 <= ord(x) <= 0x18AF)
        return joins(before) and joins(after) or c == "\u200d" and _symbol(before) and _symbol(after)
    if "\ufe00" <= c <= "\ufe0f":
        return _symbol(before) or before != "" and before in "0123456789#*" or before != "" and unicodedata.category(before) == "Lo" and c < "\ufe03"
    if c in "\u061c\u200e\u200f" or "\u202a" <= c <= "\u202e" or "\u2066" <= c <= "\u2069":
        return any(unicodedata.bidirectional(x) in ("R", "AL") for x in text)
    if "\U000e0020" <= c <= "\U000e007f":
        return "\U0001f3f4" in text[:i]
    return "\u180b" <= c <= "\u180f" and "\u1800" <= before <= "\u18af"


def _symbol(c: str) -> bool:
    return bool(c) and (unicodedata.category(c) in ("So", "Sk") or c == "\ufe0f" or 0x1F000 <= ord(c) <= 0x1FAFF)


def consistent(text: str, table: dict[int, str]) -> str:
    """The text in its usual characters."""
    if INVISIBLE.search(text):
        text = "".join(c for i, c in enumerate(text) if not INVISIBLE.match(c) or _functional(text, i))
    text = SPACES.sub(" ", text)
    text = COMPATIBLE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    text = unicodedata.normalize("NFC", text)
    if FOREIGN.search(text):
        words = [(m.start(), m[0]) for m in WORD.finditer(text) if FOREIGN.search(m[0])]
        # scripts that have a word of their own, with letters that nothing in Latin looks like
        own = {_script(c) for _, w in words if not LATIN.search(w) for c in w if FOREIGN.match(c) and not _latin(c, table)}
        out, at = [], 0
        for start, w in words:
            new = _latin_word(w, own, table)
            if new != w:
                out += [text[at:start], new]
                at = start + len(w)
        text = "".join(out) + text[at:]
    return text


def _looks(text: str, table: dict[int, str]) -> str:
    """What a text looks like: the skeleton of its visible signs, compatibility forms unified, letters of like stems folded."""
    plain = unicodedata.normalize("NFKC", SPACES.sub(" ", INVISIBLE.sub("", text)))
    return skeleton(plain, table).casefold().replace("i", "l").replace("1", "l").replace("|", "l")


def accepted(text: str, table: dict[int, str]) -> str:
    """The consistent form, if its skeleton is that of the text; else the text."""
    new = consistent(text, table)
    return new if new == text or _looks(new, table) == _looks(text, table) else text


def _script(c: str) -> str:
    return unicodedata.name(c, "").partition(" ")[0]


def _latin(c: str, table: dict[int, str]) -> str:
    """The Latin letter that c looks like, in c's case, or nothing."""
    base, *marks = unicodedata.normalize("NFD", c)
    p = table.get(ord(base), "")
    if len(p) != 1 or not p.isascii() or not p.isalpha():
        # a capital may have the look of a small letter's capital only: the table holds I and l as one
        p = table.get(ord(base.lower()), "") if base != base.lower() else ""
        if len(p) != 1 or not p.isascii() or not p.isalpha():
            return ""
    if base == base.upper() != base.lower() and p == "l":
        p = "I"
    p = p.upper() if base == base.upper() != base.lower() else p if base.lower() == base else p
    return unicodedata.normalize("NFC", p + "".join(marks))


def _latin_word(w: str, own: set[str], table: dict[int, str]) -> str:
    foreign = [c for c in w if FOREIGN.match(c)]
    mixed = bool(LATIN.search(w))
    if not mixed and (len(foreign) < 3 or any(_script(c) in own for c in foreign)):
        return w
    new = "".join((_latin(c, table) or c) if FOREIGN.match(c) else c for c in w)
    if any(FOREIGN.match(c) for c in new):
        return w
    fold = lambda x: skeleton(x, table).casefold().replace("i", "l").replace("1", "l").replace("|", "l")
    return new if fold(new) == fold(w) else w


def suspect(text: str) -> Column:
    """Whether the text has any character that may matter."""
    return F.col(text).rlike(f"[^{COMMON}]")


def clean(df: DataFrame, keys: list[str], text: str, only_changed: bool = False) -> DataFrame:
    """(keys, text, changed) with the text in one consistent form; with ``only_changed`` the rows that change alone."""
    table = prototypes(df.sparkSession)
    slim = df.select(*keys, F.col(text).alias("text"))
    if only_changed:
        slim = slim.where(suspect("text"))
    at = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(at).to_pylist()
            new = [t if not t or t.isascii() else accepted(t, table) for t in old]
            changed = pa.array([x != y for x, y in zip(old, new)], pa.bool_())
            out = pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(new, pa.string()), changed], names=[*b.schema.names, "changed"])
            yield out.filter(changed) if only_changed else out

    return slim.mapInArrow(run, T.StructType([*slim.schema.fields, T.StructField("changed", T.BooleanType())]))


def groups(df: DataFrame, text: str) -> DataFrame:
    """(skeleton, forms, n): the distinct words of more than one spelling with equal skeletons, and how often they occur."""
    table = prototypes(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count: dict[str, int] = {}
            for t in b.column(0).to_pylist():
                for w in re.findall("[\\w\u0300-\u036f\u00ad\u200b-\u200d\u2060\ufeff]+", t or ""):
                    count[w] = count.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([skeleton(w, table) for w in count], pa.string()), pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["skeleton", "form", "n"])

    words = df.select(F.col(text).alias("t")).mapInArrow(run, "skeleton string, form string, n long").groupBy("skeleton", "form").agg(F.sum("n").alias("n"))
    return words.groupBy("skeleton").agg(F.sort_array(F.collect_list("form")).alias("forms"), F.sum("n").alias("n")).where(F.size("forms") > 1)

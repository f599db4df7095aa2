"""Questions in the form in which they are compared, for the operators on pairs.

``prepare`` gives one slim row per question: key, kind, class and body. The body holds the canonical stem and options, set apart by
U+001F. Questions of one class are equal but for the order of their options; operators on pairs work on classes and expand the
members at the end, so that any number of copies costs one row.

Defined cases: null stems, options and contents count as empty; a question without any letter or digit has an empty body
and is alike to nothing; a null kind is a kind of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import canonical, numbered, parts_of
from quarry.operators.overlap import Overlap

PART = "\x1f"
#: What is alike: this share of the mean count of two-character sequences.
SHARE = 0.7
JOIN = Overlap(SHARE, groups=2)
#: Bits, at most, of the table by which texts are sorted out before they are shuffled.
MARKS = 1 << 26


def body_of(kind: str | None, stem: str | None, options: list | None) -> str:
    """Canonical parts; empty ones are left out."""
    return PART.join(filter(None, map(canonical, parts_of(kind, stem, options))))


def class_of(kind: str | None, body: str) -> int:
    """63 bits of kind and parts, whatever the order of the parts."""
    digest = hashlib.blake2b(PART.join([kind or "", *sorted(body.split(PART))]).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "big") >> 1


def prepare(df: DataFrame, key: str = "ord", also: list[str] | None = None) -> DataFrame:
    """(ord, kind, cls, size, body), without questions whose body is empty; size counts the two-character sequences. With ``also``,
    columns that come along, those questions stay."""
    also = also or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = b.column(1).to_pylist()
            bodies = [body_of(k, s, o) for k, s, o in zip(kinds, b.column(2).to_pylist(), b.column(3).to_pylist())]
            out = pa.RecordBatch.from_arrays([
                *b.columns[:2], pa.array([class_of(k, x) for k, x in zip(kinds, bodies)], pa.int64()),
                pa.array([len(x) - 2 * x.count(PART) - 1 for x in bodies], pa.int32()), pa.array(bodies, pa.string()), *b.columns[4:],
            ], names=["ord", "kind", "cls", "size", "body", *also])
            yield out if also else out.filter(pa.array([x != "" for x in bodies], pa.bool_()))

    slim = df.select(F.col(key).cast("long").alias("ord"), F.col("type").alias("kind"), "stem", "options", *also)
    more = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in also)
    return slim.mapInArrow(run, "ord long, kind string, cls long, size int, body string" + more)


def fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, body), one row per class, of the classes in ``wanted``. A table of bits, some for each of them, keeps most other texts
    from being shuffled; where it is full it keeps none, and the join decides."""
    slots = wanted.select(F.col("cls").bitwiseAND(F.lit(MARKS - 1)).cast("int").alias("slot")).distinct().toArrow().column("slot").to_numpy()
    mask = min(MARKS, 1 << (16 * len(slots) + 1).bit_length()) - 1
    full = np.zeros(mask + 1, bool)
    full[slots & mask] = True
    table = np.packbits(full, bitorder="little").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table, np.uint8)
        for b in batches:
            at = b.column(0).to_numpy() & mask
            yield b.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    return texts.select("cls", "body").mapInArrow(run, "cls long, body string").join(wanted, "cls", "left_semi").dropDuplicates(["cls"])


def verified(pairs: DataFrame, left: DataFrame, right: DataFrame, share: float = SHARE) -> DataFrame:
    """Of the pairs of classes (ca, cb) those that are alike; left and right hold (cls, body), one row per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[str, set[str]] = {}

            def grams(body: str) -> set[str]:
                if body not in known:
                    known[body] = numbered(body.split(PART))
                return known[body]

            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = grams(x), grams(y)
                keep.append(2 * len(x & y) >= share * (len(x) + len(y)) - 1e-9 and len(x) + len(y) > 0)
            yield b.select(["ca", "cb"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(left.select(F.col("cls").alias("ca"), F.col("body").alias("body_a")), "ca").join(right.select(F.col("cls").alias("cb"), F.col("body").alias("body_b")), "cb")
    return both.select("ca", "cb", "body_a", "body_b").mapInArrow(run, "ca long, cb long")

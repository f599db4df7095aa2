"""Likeness of questions by the ratio of matching runs, with candidates from bounds that lose no pair.

The ratio is twice the characters in matching runs over all characters. What matches is common to both texts with its multiplicity,
so a ratio of t takes a share of t in common: ``overlap`` finds those pairs. It also is a common subsequence, whose greatest length is
counted bit-parallel; only what passes that goes to the ratio itself, in an Arrow function, as it needs Python. For a ratio of one half,
which most texts may have, ``ratios`` takes all pairs in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import norm
from quarry.operators.overlap import Overlap, parts_of
from quarry.operators.ratios import alike, ratio_of

JUDGE = "type = 'JUDGE'"
#: Texts of one side of a block whose pairs are all taken, and blocks beyond which a task takes several, one after another.
BLOCK, TASKS = 2500, 20000

@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    return pd.Series([ratio_of(x, y, t) for x, y, t in zip(a, b, least)], dtype="float64")


def ratio(a: Column, b: Column, least: float = 0.0) -> Column:
    """Ratio of a to b, in this order; 0 where it can't reach ``least``."""
    return _ratio(a, b, F.lit(float(least)))


def _classes(texts: DataFrame) -> DataFrame:
    """(kind, cls, body) of (kind, body): a number for each kind and text."""
    return texts.select("kind", (F.xxhash64("kind", "body").bitwiseAND(F.lit((1 << 62) - 1))).alias("cls"), "body").distinct()


def near_duplicates(questions: DataFrame, least: float = 0.85) -> DataFrame:
    """(ord_a, ord_b, ratio): pairs of questions of one type whose stems are nearly equal, earlier one first. Stems that are equal in
    normal form are one class, expanded at the end. Empty stems have no partner. The tests hold it against brute force."""
    slim = questions.select("ord", F.coalesce("type", F.lit("")).alias("kind"), norm(F.col("stem")).alias("body")).where("body <> ''")
    classes = _classes(slim).persist()
    join = Overlap(least, 1)
    often = join.frequencies(classes)
    parts = parts_of(often)
    pairs = join.near(join.within(join.postings(classes, often, parts), parts), classes, classes)
    left, right = (classes.select(F.col("cls").alias(f"c{x}"), F.col("body").alias(f"s_{x}")) for x in "ab")
    # the ratio depends on the order, so it is taken for members in theirs
    scored = pairs.join(left, "ca").join(right, "cb")
    both = scored.select("ca", "cb", ratio(F.col("s_a"), F.col("s_b"), least).alias("forth"), ratio(F.col("s_b"), F.col("s_a"), least).alias("back")).where((F.col("forth") >= least) | (F.col("back") >= least))
    members = slim.join(classes, ["kind", "body"]).select("cls", "ord")
    ma, mb = (members.select(F.col("cls").alias(f"c{x}"), F.col("ord").alias(f"o_{x}")) for x in "ab")
    across = both.join(ma, "ca").join(mb, "cb").select(F.least("o_a", "o_b").alias("ord_a"), F.greatest("o_a", "o_b").alias("ord_b"), F.when(F.col("o_a") < F.col("o_b"), F.col("forth")).otherwise(F.col("back")).alias("ratio")).where(F.col("ratio") >= least)
    x, y = (members.select("cls", F.col("ord").alias(n)) for n in ("ord_a", "ord_b"))
    within = x.join(y, "cls").where("ord_a < ord_b").select("ord_a", "ord_b", F.lit(1.0).alias("ratio"))
    return across.unionByName(within)


def option_set(options: Column) -> Column:
    """Distinct normal contents of options."""
    return F.array_distinct(F.transform(F.coalesce(options, F.array().cast("array<struct<label:string,content:string>>")), lambda o: norm(o["content"])))


def _by_options(a: DataFrame, b: DataFrame, floor: float) -> DataFrame:
    """(ord, bank_ord): pairs of one type that share one of the rarest options of the new one. With a floor f of n options, any
    n - ceil(f n) + 1 of them hold a common one."""
    ka, kb = (s.select(key, F.size("opts").alias(f"n_{x}"), F.length("stem").alias(f"l_{x}"), "type", F.explode("opts").alias("k")).select(key, f"n_{x}", f"l_{x}", F.xxhash64("type", "k").alias("key")) for s, key, x in ((a, "ord", "a"), (b, "bank_ord", "b")))
    df = kb.groupBy("key").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("ord").orderBy("df", "key"))
    known = ka.join(df, "key").withColumn("rank", rank).where(F.col("rank") <= F.col("n_a") - F.ceil(F.col("n_a") * floor) + 1)
    return known.join(kb, "key").where(2.0 * F.least("l_a", "l_b") >= floor * (F.col("l_a") + F.col("l_b")) - 1e-9).select("ord", "bank_ord").distinct()


def _jaccard(x: frozenset, y: frozenset) -> float:
    return len(x & y) / len(x | y) if x or y else 0.0


def _scored(least: float, floor: float, judge_stem_min: float, asked: list[tuple], stored: list[tuple]) -> Iterator[pa.RecordBatch]:
    """(ca, cb, score) of a block of (cls, body, options) on either side."""
    sets: dict[frozenset, int] = {}
    ca, cb = (np.array([r[0] for r in s], np.int64) for s in (asked, stored))
    oa, ob = (np.array([sets.setdefault(frozenset(r[2]), len(sets)) for r in s], np.int64) for s in (asked, stored))
    names = list(sets)
    for i, j, r in alike(floor, [s[1] for s in asked], [s[1] for s in stored]):
        both, at = np.unique(oa[i] * len(names) + ob[j], return_inverse=True)
        common = np.array([_jaccard(names[k // len(names)], names[k % len(names)]) for k in both.tolist()], np.float64)[at]
        score = 0.5 * r + 0.5 * common
        keep = (score >= least) & (r >= judge_stem_min)
        yield pa.RecordBatch.from_arrays([pa.array(ca[i[keep]]), pa.array(cb[j[keep]]), pa.array(score[keep])], names=["ca", "cb", "score"])


def _sides(incoming: DataFrame, bank: DataFrame) -> list[DataFrame]:
    return [df.select(F.col("ord").alias(key), F.coalesce("type", F.lit("")).alias("type"), norm(F.col("stem")).alias("stem"), option_set(F.col("options")).alias("opts")) for df, key in ((incoming, "ord"), (bank, "bank_ord"))]


def _floor(least: float) -> float:
    if least <= 0.5:
        raise ValueError("least must be above 0.5")
    return 2 * least - 1


def stem_edges(incoming: DataFrame, bank: DataFrame, least: float = 0.75, judge_stem_min: float = 0.0) -> DataFrame:
    """(ord, bank_ord, score, type): the fuzzy edges of JUDGE questions. Their options are the same, so a stem ratio of 2·least - 1 is
    enough and the edges grow with new × old questions. Classes of equal stems and options are dealt to blocks of BLOCK × BLOCK, each
    taken whole by ``ratios``; only (class, class, score) of the edges is shuffled."""
    floor = _floor(least)
    a, b = (s.where(JUDGE).select(key, F.xxhash64("stem", "opts").alias("cls"), "stem", "opts") for s, key in zip(_sides(incoming, bank), ("ord", "bank_ord")))
    # the cheap counts of rows, copies included: more blocks than needed do no harm
    na, nb = (max(1, -(-s.where(F.coalesce("type", F.lit("")) == "JUDGE").count() // BLOCK)) for s in (incoming, bank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        now = None
        for batch in batches:
            for part, side, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    yield from _scored(least, floor, judge_stem_min, *held)
                    held, now = ([], []), part
                held[side].append(row)
        yield from _scored(least, floor, judge_stem_min, *held)

    def dealt(s: DataFrame, side: int, own: int, others: int) -> DataFrame:
        """Each class in a row of blocks, or a column of them."""
        at, other = F.pmod("cls", F.lit(own)), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other")
        d = s.dropDuplicates(["cls"]).select("cls", F.col("stem"), "opts", at.cast("long").alias("at"), other)
        part = F.col("at") * nb + F.col("other") if side == 0 else F.col("other") * nb + F.col("at")
        return d.select(part.cast("long").alias("part"), F.lit(side).alias("side"), "cls", "stem", "opts")

    tasks = min(na * nb, TASKS)
    blocks = dealt(a, 0, na, nb).unionByName(dealt(b, 1, nb, na)).repartitionById(tasks, (F.col("part") % tasks).cast("int"))
    edges = blocks.sortWithinPartitions("part").mapInArrow(run, "ca long, cb long, score double")
    return edges.join(a.select("ord", F.col("cls").alias("ca")), "ca").join(b.select("bank_ord", F.col("cls").alias("cb")), "cb").select("ord", "bank_ord", "score", F.lit("JUDGE").alias("type"))


def option_edges(incoming: DataFrame, bank: DataFrame, least: float = 0.75) -> DataFrame:
    """(ord, bank_ord, score, type): the fuzzy edges of the others, met by an equi-join on the rarer of their own options."""
    floor = _floor(least)
    a, b = (s.where(f"NOT {JUDGE}") for s in _sides(incoming, bank))
    pairs = _by_options(a, b, floor)
    full = pairs.join(a, "ord").join(b.select("bank_ord", F.col("type").alias("type_b"), F.col("stem").alias("stem_b"), F.col("opts").alias("opts_b")), "bank_ord").where("type = type_b")
    union = F.size(F.array_union("opts", "opts_b"))
    jaccard = F.when(union > 0, F.size(F.array_intersect("opts", "opts_b")) / union).otherwise(0.0)
    full = full.withColumn("jaccard", jaccard).where(F.col("jaccard") >= floor - 1e-12)
    need = (F.lit(least) - 0.5 * F.col("jaccard")) * 2
    full = full.where(2.0 * F.least(F.length("stem"), F.length("stem_b")) >= need * F.length(F.concat("stem", "stem_b")) - 1e-9)
    full = full.withColumn("r", _ratio(F.col("stem"), F.col("stem_b"), need - 1e-9))
    kept = full.withColumn("score", 0.5 * F.col("r") + 0.5 * F.col("jaccard")).where(F.col("score") >= least)
    return kept.select("ord", "bank_ord", "score", "type")


def fuzzy_edges(incoming: DataFrame, bank: DataFrame, least: float = 0.75, judge_stem_min: float = 0.0) -> DataFrame:
    """(ord, bank_ord, score, type): half stem ratio, half Jaccard of options, at least ``least``, for questions of one type. ``least`` is
    above one half, else options or stems alone would do and nothing would bound the pairs.

    As each part is a half at most, the other must reach 2·least - 1. Neither way loses a pair. Two empty stems have a ratio of 1."""
    return option_edges(incoming, bank, least).unionByName(stem_edges(incoming, bank, least, judge_stem_min))

"""Folds whose result depends on order: batches of slices, and answers spread over positions.

Batches are cut by searches over running sums. Balancing is sequential by definition: only slim rows (two or three integers) are
folded, streamed in order through one task that keeps a few counters, and the full rows are joined back. Where every SINGLE question
has equally many options the fold is a round robin, which running numbers give.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.contract import LABELS, Options
from quarry.functions.text import canonical_answer, labelled, ordinal
from quarry.operators.lineage import numbered, running


def batches(slices: DataFrame, options: Options = Options()) -> DataFrame:
    """(ord, batch_no, chars): slices in order, cut into batches of about equal length, of which there may be fewer than asked. Running
    sums are taken by ranges; each of the few cuts is one search for the first slice that would exceed the batch's share."""
    slim = slices.select("ord", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    size = slim.agg(F.count("*").alias("rows"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"), F.min("ord").alias("first")).first()
    count = max(1, min(options.batches, size["rows"]))
    target = size["chars"] / count
    summed = running(slim, F.col("chars"), "held", "ord").persist()
    cuts, first, done = [], size["first"], 0
    while len(cuts) < count - 1:
        cut = summed.where((F.col("ord") > first) & (F.col("held") - done > target)).agg(F.min(F.struct("ord", "held", "chars")).alias("m")).first()["m"]
        if cut is None:
            break
        first, done = cut["ord"], cut["held"] - cut["chars"]
        cuts.append(first)
    no = sum(((F.col("ord") >= c).cast("int") for c in cuts), F.lit(1))
    return summed.select("ord", no.alias("batch_no"), "chars")


def batch_sizes(numbered: DataFrame) -> DataFrame:
    """(batch_no, slices, chars)."""
    return numbered.groupBy("batch_no").agg(F.count("*").alias("slices"), F.sum("chars").alias("chars"))


def eligible(questions: DataFrame, kind: str) -> DataFrame:
    """Questions of a kind whose options may be put in another order: none that are numbered, and every answer declared."""
    q = questions.where((F.col("type") == kind) & ~ordinal(F.col("options"))).withColumn("answer", canonical_answer(F.col("answer")))
    declared = F.transform("options", lambda o: o["label"])
    right = (F.size("answer") == 1) if kind == "SINGLE" else (F.size("answer") >= 2)
    return q.where(right & (F.size(F.array_except("answer", declared)) == 0) & F.size("options").between(2, len(LABELS)) & (F.size(F.array_distinct(declared)) == F.size("options")))


def single_targets(slim: DataFrame) -> DataFrame:
    """(ord, target) from (ord, k): for each question the least used of its first k labels, the first of equals."""
    sizes = [r["k"] for r in slim.select("k").distinct().collect()]  # six at most
    if len(sizes) == 1:
        return numbered(slim, "n", "ord").select("ord", ((F.col("n") - 1) % sizes[0]).cast("int").alias("target"))

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        used = [0] * len(LABELS)
        for p in parts:
            out = []
            for k in p["k"]:
                at = min(range(int(k)), key=lambda i: (used[i], i))
                used[at] += 1
                out.append(at)
            yield pd.DataFrame({"ord": p["ord"], "target": out})

    return slim.repartition(1).sortWithinPartitions("ord").mapInPandas(fold, "ord long, target int")


def balance_single(questions: DataFrame) -> DataFrame:
    """(ord, options, answer): SINGLE questions with the right option moved so that positions are used alike; the others keep their order."""
    q = eligible(questions, "SINGLE").select("ord", "options", "answer")
    targets = single_targets(q.select("ord", F.size("options").alias("k")))
    j = q.join(targets, "ord")
    right = F.filter("options", lambda o: o["label"] == F.get("answer", F.lit(0)))
    rest = F.filter("options", lambda o: o["label"] != F.get("answer", F.lit(0)))
    moved = F.concat(F.slice(rest, F.lit(1), F.col("target")), right, F.slice(rest, F.col("target") + 1, F.size("options")))
    return j.select("ord", labelled(F.transform(moved, lambda o: o["content"])).alias("options"), F.array(F.element_at(F.array(*map(F.lit, LABELS)), F.col("target") + 1)).alias("answer"))


def multi_orders(slim: DataFrame, exact: bool, seed: int) -> DataFrame:
    """(ord, order) from (ord, k, right): for MULTI questions the order of their options. ``exact`` shuffles as the established
    tool does, sixteen times from one generator; else the least used combination is taken, without chance."""

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng, used = random.Random(seed), Counter()
        for p in parts:
            out = []
            for k, right in zip(p["k"], p["right"]):
                k, right = int(k), set(map(int, right))
                best = None
                if exact:
                    order = list(range(k))
                    for _ in range(16):
                        order = list(order)
                        rng.shuffle(order)
                        combo = tuple(i for i, o in enumerate(order) if o in right)
                        if best is None or used[combo] < used[best[0]]:
                            best = combo, order
                else:
                    combo = min(combinations(range(k), len(right)), key=lambda c: (used[c], c))
                    yes, no = iter(sorted(right)), iter(sorted(set(range(k)) - right))
                    best = combo, [next(yes) if i in combo else next(no) for i in range(k)]
                used[best[0]] += 1
                out.append(best[1])
            yield pd.DataFrame({"ord": p["ord"], "order": out})

    return slim.repartition(1).sortWithinPartitions("ord").mapInPandas(fold, "ord long, order array<int>")


def balance_multi(questions: DataFrame, exact: bool = False, options: Options = Options()) -> DataFrame:
    """(ord, options, answer): MULTI questions with their options in an order that uses the combinations of answers alike."""
    q = eligible(questions, "MULTI").select("ord", "options", "answer")
    right = F.transform("answer", lambda a: F.array_position(F.transform("options", lambda o: o["label"]), a).cast("int") - 1)
    j = q.join(multi_orders(q.select("ord", F.size("options").alias("k"), right.alias("right")), exact, options.seed), "ord")
    moved = F.transform("order", lambda i: F.get("options", i))
    hit = F.filter(F.transform(moved, lambda o, i: F.when(F.array_contains("answer", o["label"]), F.get(F.array(*map(F.lit, LABELS)), i))), lambda x: x.isNotNull())
    return j.select("ord", labelled(F.transform(moved, lambda o: o["content"])).alias("options"), hit.alias("answer"))

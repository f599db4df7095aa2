"""New questions merged into the bank: matched by fingerprint, then by likeness, each old question taken once.

Only slim rows decide: (order, old order, score). The order-dependent part, which old question a new one may still take, is settled
per connected group of candidates. Full rows are joined back at the end.

Defined cases: of equal fingerprints in the bank the last one counts; a null fingerprint matches nothing; of equal scores the older
question wins. An old question whose content is unchanged isn't taken, so a later new one may still replace it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.contract import Options
from quarry.functions.text import content_fingerprint
from quarry.operators.lineage import cut
from quarry.operators.similarity import JUDGE, option_edges, stem_edges


def with_content(df: DataFrame) -> DataFrame:
    """Adds ``content``, the fingerprint of all but stem and type."""
    return df.withColumn("content", content_fingerprint(*(F.col(c) for c in ("options", "answer", "analysis", "difficulty", "score", "category", "tags"))))


def by_fingerprint(incoming: DataFrame, bank: DataFrame) -> DataFrame:
    """(ord, bank_ord, action): existing, locked, updated, or miss with a null bank_ord. Equi-join on the fingerprint."""
    old = with_content(bank).where("_fingerprint IS NOT NULL").groupBy("_fingerprint").agg(F.max_by(F.struct("ord", "content", "_locked"), "ord").alias("old"))
    new = with_content(incoming).select("ord", "_fingerprint", "content")
    j = new.join(old, "_fingerprint", "left")
    action = F.when(F.col("old").isNull(), "miss").when(F.col("content") == F.col("old.content"), "existing").when(F.coalesce("old._locked", F.lit(False)), "locked").otherwise("updated")
    return j.select("ord", F.col("old.ord").alias("bank_ord"), action.alias("action"))


#: The group of all JUDGE questions, below every order.
JUDGED = -(1 << 62)


def _components(edges: DataFrame) -> DataFrame:
    """(ord, bank_ord, score, exact, grp): edges with the least label that their group reaches. The label goes on until nothing
    changes, the lineage cut after each step, and before the first, as each step uses the edges several times."""
    e = cut(edges)
    while True:
        by_new = e.groupBy("ord").agg(F.min("grp").alias("g"))
        step = e.join(by_new, "ord").drop("grp").withColumnRenamed("g", "grp")
        by_old = step.groupBy("bank_ord").agg(F.min("grp").alias("g"))
        after = cut(step.join(by_old, "bank_ord").withColumn("moved", F.col("g") < F.col("grp")).drop("grp").withColumnRenamed("g", "grp"))
        if after.where("moved").isEmpty():
            return after.drop("moved")
        e = after.drop("moved")


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Greedy choice in order of the new questions, group by group; rows come sorted by (grp, ord, -score, bank_ord), a question's
    own fingerprint first. An old question that a like one has taken is no longer found by its fingerprint."""
    grp, current, done = None, None, False
    taken: set[int] = set()
    replaced: set[int] = set()
    for b in batches:
        out = []
        for g, o, old, exact in zip(b["grp"], b["ord"], b["bank_ord"], b["exact"]):
            if g != grp:
                grp, current, taken, replaced = g, None, set(), set()
            if o != current:
                current, done = o, False
            if done:
                continue
            if exact:
                if old not in replaced:
                    done = True
                    if exact != "existing":
                        taken.add(old)
                    out.append((o, old, exact))
            elif old not in taken:
                done = True
                taken.add(old)
                replaced.add(old)
                out.append((o, old, ""))
        yield pd.DataFrame(out, columns=["ord", "bank_ord", "how"]).astype({"ord": "int64", "bank_ord": "int64"})


def actions(incoming: DataFrame, bank: DataFrame, options: Options = Options()) -> DataFrame:
    """(ord, bank_ord, action) for every new question: existing, updated, locked or new. Written once, as all that follows uses it."""
    exact = by_fingerprint(incoming, bank).where("action <> 'miss'")
    # JUDGE questions are one group, as nearly all of them hang together: their many edges needn't be read in every step, only the few
    # edges that may lead there
    judged = stem_edges(incoming, bank, options.similarity, options.judge_stem_min).select("ord", "bank_ord", "score", F.lit("").alias("exact"), F.lit(JUDGED).alias("grp"))
    edges = option_edges(incoming, bank, options.similarity).select("ord", "bank_ord", "score", F.lit("").alias("exact"), F.col("bank_ord").alias("grp"))
    own = exact.select("ord", "bank_ord", F.lit(2.0).alias("score"), F.col("action").alias("exact"))
    for df, key in ((incoming, "ord"), (bank, "bank_ord")):
        own = own.join(df.select(F.col("ord").alias(key), F.coalesce(F.expr(JUDGE), F.lit(False)).alias(f"judge_{key}")), key)
    own = own.select("ord", "bank_ord", "score", "exact", F.when(F.col("judge_ord") | F.col("judge_bank_ord"), JUDGED).otherwise(F.col("bank_ord")).alias("grp"))
    grouped = _components(edges.unionByName(own)).unionByName(judged)
    chosen = grouped.repartition("grp").sortWithinPartitions("grp", "ord", F.desc("score"), "bank_ord").select("grp", "ord", "bank_ord", "exact").mapInPandas(_settle, "ord long, bank_ord long, how string")
    locks = bank.select(F.col("ord").alias("bank_ord"), F.coalesce("_locked", F.lit(False)).alias("lock"))
    settled = chosen.join(locks, "bank_ord").select("ord", "bank_ord", F.when(F.col("how") != "", F.col("how")).when(F.col("lock"), "locked").otherwise("updated").alias("action"))
    return cut(incoming.select("ord").join(settled, "ord", "left").select("ord", "bank_ord", F.coalesce("action", F.lit("new")).alias("action")))


def leftovers(bank: DataFrame, acted: DataFrame, rels: DataFrame | None = None, task_ids: DataFrame | None = None, options: Options = Options()) -> DataFrame:
    """(ord, fate): old questions that this run did not take: kept, or pruned as their file or slice is gone. Anti-joins on keys."""
    taken = acted.where("action IN ('updated', 'locked')").select(F.col("bank_ord").alias("ord")).where("ord IS NOT NULL").distinct()
    rest = bank.select("ord", "_source_file", "_task_id", F.coalesce("_locked", F.lit(False)).alias("lock")).join(taken, "ord", "left_anti")
    gone = F.lit(False)
    if rels is not None:
        have = rels.select(F.col("rel").alias("_source_file")).where("_source_file IS NOT NULL").distinct().withColumn("file", F.lit(True))
        rest = rest.join(have, "_source_file", "left")
        gone = gone | ((F.coalesce("_source_file", F.lit("")) != "") & F.col("file").isNull())
    if task_ids is not None:
        ids = task_ids.select(F.col("id").alias("_task_id")).where("_task_id IS NOT NULL").distinct().withColumn("slice", F.lit(True))
        rest = rest.join(ids, "_task_id", "left")
        gone = gone | ((F.coalesce("_task_id", F.lit("")) != "") & F.col("slice").isNull())
    if not options.prune_matched:
        seen = acted.where("action = 'existing'").select(F.col("bank_ord").alias("ord")).distinct().withColumn("seen", F.lit(True))
        rest = rest.join(seen, "ord", "left")
        gone = gone & F.col("seen").isNull()
    if not options.prune_locked:
        gone = gone & ~F.col("lock")
    return rest.select("ord", F.when(gone, "pruned").otherwise("kept").alias("fate"))


def merged(incoming: DataFrame, bank: DataFrame, acted: DataFrame, rest: DataFrame, now: str) -> DataFrame:
    """The new bank in its columns: changed and new questions with their dates, locked and kept old ones. Sort by (category, type,
    _fingerprint) where it is written."""
    columns = [c for c in bank.columns if c != "ord"]
    new = incoming.join(acted.where("action IN ('updated', 'new')"), "ord")
    dates = bank.select(F.col("ord").alias("bank_ord"), F.col("_added_at").alias("old_added"))
    new = new.drop("_added_at", "_updated_at", "_locked").join(dates, "bank_ord", "left").withColumns({"_added_at": F.coalesce("old_added", F.lit(now)), "_updated_at": F.when(F.col("action") == "updated", now), "_locked": F.lit(None).cast("boolean")})
    locked = bank.join(acted.where("action = 'locked'").select(F.col("bank_ord").alias("ord")).distinct(), "ord", "left_semi")
    old = bank.join(rest.where("fate = 'kept'"), "ord", "left_semi")
    return new.select("ord", *columns).unionByName(locked.select("ord", *columns)).unionByName(old.select("ord", *columns))

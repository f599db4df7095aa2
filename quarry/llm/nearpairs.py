"""Problem 5: groups of questions that differ by small edits, additions or another order.

A sparse matrix product. The incidence matrix has a row per class of equal questions and a column per two-character sequence; of
a row only the rarest columns are kept, as many as the definition asks for (``operators.overlap``). The product is taken block by block, a
block being the columns of one part; pairs of rows are dropped by the bounds that sizes, places in the row and parities of what
follows give. All bounds follow from the definition, so no pair is lost, however short its parts and wherever its edits are. What
is left is verified by the definition itself.

Defined cases: see ``questions``. Repeated rows form pairs with one another and with all that their class is alike to.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.questions import JOIN, fetched, prepare, verified
from quarry.operators.overlap import parts_of


def candidates(prepared: DataFrame) -> DataFrame:
    """(ca, cb), ca < cb: pairs of classes that can be alike."""
    often = JOIN.frequencies(prepared)
    parts = parts_of(often)
    return JOIN.within(JOIN.postings(prepared, often, parts), parts)


def alike_classes(prepared: DataFrame) -> DataFrame:
    """(ca, cb), ca < cb: the classes that are alike."""
    pairs = JOIN.near(candidates(prepared), prepared, prepared).persist(StorageLevel.MEMORY_AND_DISK)
    wanted = pairs.select(F.col("ca").alias("cls")).union(pairs.select(F.col("cb").alias("cls"))).distinct()
    bodies = fetched(prepared, wanted).persist(StorageLevel.MEMORY_AND_DISK)
    return verified(pairs, bodies, bodies)


def found(questions: DataFrame, key: str = "ord") -> DataFrame:
    """(ord_a, ord_b), ord_a < ord_b: all pairs of rows that are alike, copies included."""
    prepared = prepare(questions, key).persist(StorageLevel.MEMORY_AND_DISK)
    members = prepared.select("cls", "ord", "size").repartition("cls").persist(StorageLevel.MEMORY_AND_DISK)  # shuffled once for all four joins
    a, b = (members.select(F.col("cls").alias(f"c{x}"), F.col("ord").alias(x)) for x in "ab")
    across = alike_classes(prepared).join(a, "ca").join(b, "cb").select(F.least("a", "b").alias("ord_a"), F.greatest("a", "b").alias("ord_b"))
    copies = members.where("size > 0")
    p, q = (copies.select("cls", F.col("ord").alias(x)) for x in ("ord_a", "ord_b"))
    within = p.join(q, "cls").where("ord_a < ord_b").select("ord_a", "ord_b")
    return across.unionByName(within)

"""Problem 3: new questions checked against all that were accepted, without going through them again.

The index keeps postings (``operators.overlap``): of each accepted question its rarest two-character sequences, as many as the definition
asks for, each with a bit-difference fingerprint of what follows it in the question. They lie in block tables, a block being what falls
into one part by the hash of the sequence. A look-up takes the blocks that its sequences fall into, meets those rows, verifies the
Hamming distance of the fingerprints, then the texts by the definition. All bounds follow from the definition: no pair is lost,
however short its pieces and wherever its edits are. No list of matches is capped.

Accepted questions are appended: ``Index.append`` writes their rows beside the others', and nothing that is stored is read for it but
the order of the sequences, which the first batch sets for all. Later batches may make it less even, never wrong. A batch has a
name, and its folders are replaced if it is written again, so that a retried batch is stored once. A look-up reads the folders of
the blocks it needs (partition pruning), and of the members those that it met.

Defined cases: see ``questions``; a null ``_fingerprint`` equals none. Copies on either side are expanded at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.questions import JOIN, fetched, prepare, verified
from quarry.operators.overlap import parts_of, table_of

#: Blocks of a stored index: a batch of a few questions reads few of them.
BLOCKS = 256


@dataclass
class Index:
    """Accepted questions: their postings, the order that these follow, and the members (cls, ord, fingerprint, body)."""

    tables: DataFrame
    members: DataFrame
    often: np.ndarray
    blocks: int
    prepared: DataFrame | None = None

    @classmethod
    def of(cls, accepted: DataFrame, key: str = "ord", blocks: int | None = None) -> Index:
        """The index of a batch of accepted questions."""
        prepared = prepare(accepted, key, ["_fingerprint"]).persist(StorageLevel.MEMORY_AND_DISK)
        often = JOIN.frequencies(prepared.where("body <> ''"))
        blocks = blocks or parts_of(2 * often)
        return cls(JOIN.postings(prepared.where("body <> ''"), often, blocks, 1), _members(prepared), often, blocks, prepared)

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> Index:
        """An index that ``append`` wrote."""
        return cls(spark.read.parquet(f"{folder}/tables"), spark.read.parquet(f"{folder}/members"), _order(spark, folder), BLOCKS)

    def append(self, folder: str, batch: str) -> None:
        """Add this batch's rows to the index in ``folder``, a folder for each block and batch; those of an earlier try are replaced."""
        if self.prepared is None:
            raise ValueError("only the index of a batch can be appended")
        spark = self.members.sparkSession
        try:
            often = _order(spark, folder)
        except AnalysisException:  # the first batch
            often, slot = self.often, np.flatnonzero(self.often)
            spark.createDataFrame(pa.table({"slot": slot, "n": often[slot]})).coalesce(1).write.mode("overwrite").parquet(f"{folder}/order")
        tables = JOIN.postings(self.prepared.where("body <> ''"), often, BLOCKS, 1).withColumn("batch", F.lit(batch))
        for rows, name, by in ((tables, "tables", ["batch", "part"]), (self.members.withColumn("batch", F.lit(batch)), "members", ["batch"])):
            rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{folder}/{name}")

    def lookup(self, batch: DataFrame, key: str = "ord") -> DataFrame:
        """(bank_ord, clean_ord): which accepted question each row of the batch repeats, by fingerprint or by likeness."""
        prepared = prepare(batch, key, ["_fingerprint"]).persist(StorageLevel.MEMORY_AND_DISK)
        asked = JOIN.postings(prepared.where("body <> ''"), self.often, self.blocks, counted=self.prepared is not None)
        stored = self.tables.select("part", "side", "blob")
        if self.prepared is None:  # stored: the blocks that this batch needs, of which there are at most so many
            asked = asked.persist(StorageLevel.MEMORY_AND_DISK)
            stored = stored.where(F.col("part").isin([r["part"] for r in asked.select("part").distinct().collect()]))
        mine = prepared.where("body <> ''").select("kind", "cls", "ord", "size", "body")
        theirs = self.members.where("body <> ''")
        hits = JOIN.near(JOIN.between(asked, stored, min(self.blocks, parts_of(2 * self.often))), mine, theirs).persist(StorageLevel.MEMORY_AND_DISK)
        ours, others = (fetched(texts, hits.select(F.col(c).alias("cls")).distinct()) for texts, c in ((mine, "ca"), (theirs, "cb")))
        alike = verified(hits, ours, others)
        us, them = mine.where("size > 0").select(F.col("cls").alias("ca"), F.col("ord").alias("clean_ord")), theirs.select(F.col("cls").alias("cb"), F.col("ord").alias("bank_ord"))
        pairs = alike.join(us, "ca").join(them, "cb").select("bank_ord", "clean_ord")
        same = us.join(them.withColumnRenamed("cb", "ca"), "ca").select("bank_ord", "clean_ord")
        printed = self.members.select("_fingerprint", F.col("ord").alias("bank_ord")).join(prepared.select("_fingerprint", F.col("ord").alias("clean_ord")), "_fingerprint").select("bank_ord", "clean_ord")
        return pairs.unionByName(same).unionByName(printed).distinct()


def _order(spark: SparkSession, folder: str) -> np.ndarray:
    got = spark.read.parquet(f"{folder}/order").toArrow()
    return table_of(got.column("slot").to_numpy(), got.column("n").to_numpy())


def _members(prepared: DataFrame) -> DataFrame:
    return prepared.select("kind", "cls", "ord", "_fingerprint", "body")

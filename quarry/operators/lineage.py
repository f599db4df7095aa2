"""Lineage cut where a plan would grow with each round, and running numbers over whole tables without one task for all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """The frame as a checkpoint in the folder of spark.checkpoint.dir; only where it is unset, as in tests, in one of our own."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint()


def running(df: DataFrame, value: Column, name: str, *keys: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows up to this one in order of ``keys``, which tell all rows apart. Rows are
    partitioned by ranges; one sum per partition comes to the driver, what is left is a window within each."""
    parts = df.withColumn("_v", value.cast("long")).repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()).persist()
    sums = sorted((r["_p"], r["s"]) for r in parts.groupBy("_p").agg(F.sum("_v").alias("s")).collect())
    before, at = {}, 0
    for p, n in sums:
        before[p] = at
        at += n or 0
    offset = F.element_at(F.create_map(*(F.lit(x) for kv in before.items() for x in kv)), F.col("_p")) if before else F.lit(0)
    within = F.sum("_v").over(Window.partitionBy("_p").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return parts.withColumn(name, (within + offset).cast("long")).drop("_v", "_p")


def numbered(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Adds ``name``: 1, 2, … in order of ``keys``."""
    return running(df, F.lit(1), name, *keys)

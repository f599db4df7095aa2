"""The pipeline over arriving files and batches, by Structured Streaming.

Slices need no state: files in, chunks out. The bank does: each micro-batch is merged with the last version and written as the next
one, a folder per version, so that a batch run again after a failure writes the same folder again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.contract import Options
from quarry.operators import merge, slices, structure


def file_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(rel, raw) of Markdown files as they arrive."""
    return spark.readStream.option("pathGlobFilter", "*.md").option("recursiveFileLookup", True).text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("rel"), F.col("value").alias("raw"))


def slice_stream(files: DataFrame, options: Options = Options()) -> DataFrame:
    """Slices of arriving files; stateless."""
    return slices.kept(slices.assess(structure.with_chunks(files, "rel", "raw", options), options))


def deduplicated(questions: DataFrame, arrived: str, delay: str) -> DataFrame:
    """Arriving questions, of equal fingerprints the first within ``delay`` of event time; state is dropped behind the watermark."""
    return questions.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(["_fingerprint"])


def crowding(questions: DataFrame, arrived: str, delay: str, window: str) -> DataFrame:
    """Questions per slice and window of arrival."""
    return questions.withWatermark(arrived, delay).groupBy(F.window(arrived, window), "_task_id").agg(F.count("*").alias("n"))


def upsert(read: Callable[[SparkSession, int], DataFrame], folder: str, now: Callable[[int], str], options: Options = Options()) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges a batch into the version before it. ``read`` gives that version, ``now`` the batch's time."""

    def run(batch: DataFrame, number: int) -> None:
        bank = read(batch.sparkSession, number)
        acted = merge.actions(batch, bank, options)
        rest = merge.leftovers(bank, acted, options=options)
        merge.merged(batch, bank, acted, rest, now(number)).write.mode("overwrite").parquet(f"{folder}/v{number:08d}")

    return run


def start(questions: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run until all that is there has been merged; the checkpoint lies in a shared folder."""
    return questions.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

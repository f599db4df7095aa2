"""The queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import confusables, encoding, leakage, markup, mojibake, nearpairs, splitting
from quarry.llm.common import table
from quarry.llm.history import Index


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every slice that is too long, with the slice's key and section."""
    return splitting.split(table(spark, sf_dir, "tasks").select("ord", "section", "text"), "text").drop("text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the slices that had to be split: each has one first piece."""
    return p1_pieces(spark, sf_dir).where("piece_no = 1").select("ord")


def _framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).withColumn("framed", F.col("tbl") == "tasks")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and the families of markup that they hold."""
    return markup.found(_framed(spark, sf_dir), ["tbl", "ord"], "text", "framed")


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts without markup, their structure kept."""
    return markup.clean(_framed(spark, sf_dir), ["tbl", "ord"], "text", "framed")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which accepted questions the new ones repeat."""
    return Index.of(table(spark, sf_dir, "bank")).lookup(table(spark, sf_dir, "clean"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, ord, text): the texts of slices and the quotes of new questions."""
    tasks = table(spark, sf_dir, "tasks").select(F.lit("tasks").alias("tbl"), "ord", "text")
    return tasks.unionByName(table(spark, sf_dir, "clean").select(F.lit("clean").alias("tbl"), "ord", F.col("source_quote").alias("text")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that hold stand-ins for usual characters: those that the consistent form changes."""
    return confusables.clean(_texts(spark, sf_dir), ["tbl", "ord"], "text", only_changed=True).select("tbl", "ord")


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts in one consistent form."""
    return confusables.clean(_texts(spark, sf_dir), ["tbl", "ord"], "text")


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of slices and quotes that look the same and are written differently."""
    return confusables.groups(_texts(spark, sf_dir), "text")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of new questions that are alike."""
    return nearpairs.found(table(spark, sf_dir, "clean"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encoding.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of tokens, and whether decoding gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = encoding.encode(docs.withColumn("key", F.struct("doc_id", "text")), "key", "text")
    back = ids.select("key.doc_id", F.coalesce("key.text", F.lit("")).alias("text"), "ids", encoding.decode(F.col("ids")).alias("back"))
    return back.select("doc_id", F.size("ids").alias("n_tokens"), (F.col("back") == F.col("text")).alias("restored"))


def p7_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of held-out items in documents, to be cut out."""
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the held-out items that they hold at least half of."""
    return p7_spans(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with garbled text, restored as far as it can be."""
    return mojibake.restored(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with garbled text."""
    return p8_restored(spark, sf_dir).select("doc_id")


def p8_lossy_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that lost a character, with the one word of the corpus that they can be."""
    return mojibake.lossy_words(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_pieces, p2_found, p2_clean, p3_found, p4_found, p4_clean, p4_groups, p5_found, p6_ids, p6_restored, p7_found, p7_spans, p8_found, p8_restored, p8_lossy_words)}

SQL: dict[str, str] = {
    "p1_found": "SELECT ord FROM tasks WHERE length(text) > 2000",
}

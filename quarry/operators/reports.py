"""Counts over the bank, coverage of slices, and the rows of the exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.contract import NO_CATEGORY, PUBLIC, Options
from quarry.functions.text import slug

#: What is shown for the closed lists.
NAMES = {"SINGLE": "单选", "MULTI": "多选", "JUDGE": "判断", "EASY": "简单", "MEDIUM": "中等", "HARD": "困难"}


def distributions(bank: DataFrame) -> DataFrame:
    """(facet, value, n): category, type, difficulty and frequency, counted in one pass by grouping sets."""
    b = bank.select(F.coalesce("category", F.lit("")).alias("category"), F.coalesce("type", F.lit("")).alias("type"), F.coalesce("difficulty", F.lit("")).alias("difficulty"), F.coalesce("_freq", F.lit("未标")).alias("freq"))
    facets = ["category", "type", "difficulty", "freq"]
    g = b.groupingSets([[f] for f in facets], *facets).agg(F.count("*").alias("n"), *(F.grouping(f).alias(f"g_{f}") for f in facets))
    which = F.coalesce(*(F.when(F.col(f"g_{f}") == 0, f) for f in facets))
    return g.select(which.alias("facet"), F.coalesce(*facets).alias("value"), "n")


def named(c: Column) -> Column:
    """The shown name of a type or difficulty; others stay."""
    pairs = [F.lit(x) for kv in NAMES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def per_slice(bank: DataFrame) -> DataFrame:
    """(task_id, n): questions of each slice."""
    return bank.where("_task_id IS NOT NULL").groupBy(F.col("_task_id").alias("task_id")).agg(F.count("*").alias("n"))


def slice_average(bank: DataFrame) -> DataFrame:
    """(slices, questions, average): one row; no slice gives a null average."""
    return per_slice(bank).agg(F.count("*").alias("slices"), F.coalesce(F.sum("n"), F.lit(0)).alias("questions"), F.avg("n").alias("average"))


def over_limit(bank: DataFrame, options: Options = Options()) -> DataFrame:
    return per_slice(bank).where(F.col("n") > options.max_per_section)


def covered(slices: DataFrame, bank: DataFrame) -> DataFrame:
    """(id, covered): each slice id, and whether it has a question; by id, never by section name."""
    have = bank.select(F.col("_task_id").alias("id")).where("id IS NOT NULL").distinct().withColumn("c", F.lit(True))
    return slices.select("id").where("id IS NOT NULL").distinct().join(have, "id", "left").select("id", F.coalesce("c", F.lit(False)).alias("covered"))


def coverage(slices: DataFrame, bank: DataFrame) -> DataFrame:
    """(slices, hit, ratio): one row."""
    return covered(slices, bank).agg(F.count("*").alias("slices"), F.count_if("covered").alias("hit"), F.coalesce(F.avg(F.when(F.col("covered"), 1.0).otherwise(0.0)), F.lit(0.0)).alias("ratio"))


def slice_facets(slices: DataFrame) -> DataFrame:
    """(facet, value, n): slices by category and by mode."""
    facets = ["category", "mode"]
    g = slices.select(*(F.coalesce(f, F.lit("")).alias(f) for f in facets)).groupingSets([[f] for f in facets], *facets).agg(F.count("*").alias("n"), F.grouping("category").alias("g"))
    return g.select(F.when(F.col("g") == 0, "category").otherwise("mode").alias("facet"), F.coalesce(*facets).alias("value"), "n")


def slice_totals(slices: DataFrame) -> DataFrame:
    """(slices, files, chars, pictures): one row; pictures are counted in each slice once."""
    pictures = F.greatest(F.coalesce(F.size("images"), F.lit(0)), F.lit(0)) if "images" in slices.columns else F.lit(0)
    return slices.agg(F.count("*").alias("slices"), F.count_distinct("rel").alias("files"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("chars"), F.coalesce(F.sum(pictures), F.lit(0)).alias("pictures"))


def added_slices(increment: DataFrame, slices: DataFrame) -> DataFrame:
    """(id, char_count, mode) of the slices that this run added; an id that is listed twice counts once."""
    new = increment.where("status = 'added'").select(F.col("task_id").alias("id")).distinct()
    return slices.select("id", "char_count", "mode").join(new, "id", "left_semi")


def uncovered_places(slices: DataFrame, bank: DataFrame) -> DataFrame:
    """(id, rel, section) of the slices without a question."""
    return slices.select("id", "rel", "section").join(bank.select(F.col("_task_id").alias("id")).where("id IS NOT NULL"), "id", "left_anti")


def contract(bank: DataFrame) -> DataFrame:
    """The public fields alone; a null analysis is empty."""
    return bank.select(*(F.coalesce("analysis", F.lit("")).alias(c) if c == "analysis" else F.col(c) for c in PUBLIC))


def index_rows(bank: DataFrame) -> DataFrame:
    """The index by fingerprint: (fingerprint, stem, category, source_file, source_section, added_at, locked); of equal fingerprints the last."""
    cut = F.struct(F.substring("stem", 1, 60).alias("stem"), "category", F.col("_source_file").alias("source_file"), F.col("_source_section").alias("source_section"), F.col("_added_at").alias("added_at"), F.coalesce("_locked", F.lit(False)).alias("locked"))
    return bank.groupBy(F.col("_fingerprint").alias("fingerprint")).agg(F.max_by(cut, "ord").alias("r")).select("fingerprint", "r.*")


def category_files(bank: DataFrame) -> DataFrame:
    """(category, file): the file of each category. Categories whose names come to the same file get numbers."""
    from pyspark.sql import Window

    c = bank.select(F.coalesce("category", F.lit(NO_CATEGORY)).alias("category")).distinct().withColumn("slug", slug(F.col("category")))
    nth = F.row_number().over(Window.partitionBy("slug").orderBy("category"))
    return c.select("category", F.concat("slug", F.when(nth == 1, "").otherwise(F.concat(F.lit("-"), nth)), F.lit(".json")).alias("file"))


def preview(bank: DataFrame, category: str | None = None, kind: str | None = None, difficulty: str | None = None, frequency: str | None = None) -> DataFrame:
    """Questions of the preview: every column but the private ones, and the public row as JSON; filters are optional."""
    b = bank
    for column, value in (("category", category), ("type", kind), ("difficulty", difficulty)):
        b = b if value is None else b.where(F.col(column) == value)
    b = b if frequency is None else b.where(F.array_contains("tags", frequency))
    shown = [c for c in b.columns if not c.startswith("_") and c != "ord"]
    return b.select("ord", *shown, F.to_json(F.struct(*PUBLIC)).alias("contract"))


def facets(bank: DataFrame) -> DataFrame:
    """(facet, value): what the preview can be filtered by."""
    return distributions(bank).select("facet", "value")

"""Markdown folders as a DataFrame, and the tag vocabularies that lie in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.contract import SKIPPED_DIRS, SKIPPED_FILES
from quarry.functions.text import strip
from quarry.operators.lineage import numbered


def scan(spark: SparkSession, root: str) -> DataFrame:
    """(rel, raw): every Markdown file below a folder, malformed bytes replaced. Product folders, hidden files and vocabularies are
    left out by their path below the root, before anything is read. A folder without any raises."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").format("binaryFile").load(root)
    base = root.rstrip("/")
    base = base if not base.endswith(".md") else base.rpartition("/")[0]  # a single file lies in its folder
    rel = F.expr(f"substring(path, locate('{base}/', path) + {len(base) + 1})")
    f = files.select(F.url_decode(F.replace(rel, F.lit("+"), F.lit("%2B"))).alias("rel"), F.decode("content", "UTF-8").alias("raw"))
    parts, name = F.split("rel", "/"), F.element_at(F.split("rel", "/"), -1)
    kept = f.where(~F.arrays_overlap(parts, F.array(*map(F.lit, SKIPPED_DIRS))) & ~name.startswith(".") & ~F.lower(name).isin(*SKIPPED_FILES))
    if kept.select("rel").isEmpty():
        raise FileNotFoundError(f"no Markdown file below {root}")
    return kept


def ordered(files: DataFrame) -> DataFrame:
    """Adds ``file_ord``: files by the parts of their paths."""
    return numbered(files.withColumn("_path", F.split("rel", "/")), "file_ord", "_path").drop("_path")


def chosen_vocabulary(files: DataFrame, lists: DataFrame, levels: int = 4) -> DataFrame:
    """The one row of ``lists`` (rel, text), files named tags.md, that holds for a run: each file has the nearest one in its own folder or
    up to ``levels`` - 1 above it; the first file in order of paths that has one decides for all. No row if none has."""
    parts = F.split("rel", "/")
    above = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(levels))), lambda i: F.struct(i.alias("up"), F.array_join(F.slice(parts, F.lit(1), F.size(parts) - i), "/").alias("folder")))
    near = files.select(parts.alias("path"), F.explode(above).alias("a")).select("path", "a.up", "a.folder")
    have = lists.select(F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "/").alias("folder"), "rel", "text")
    first = near.join(have.select("folder"), "folder").agg(F.min(F.struct("path", "up", "folder")).alias("m")).where("m IS NOT NULL").select("m.folder")
    return have.join(first, "folder").select("rel", "text")


def vocabulary(lines: DataFrame, text: str = "text") -> DataFrame:
    """(tag, ord) of the lines of a vocabulary: bullets off; headings, quotes, tables, fences and long lines out; of tags that differ in
    case alone the first."""
    rows = lines.select(F.posexplode(F.split(text, r"\r?\n")).alias("ord", "s"))
    rows = rows.select("ord", strip(F.regexp_replace(strip(F.col("s")), r"\A[-*+]\s+", "")).alias("tag")).where("tag <> '' AND length(tag) <= 24 AND NOT (tag LIKE '#%' OR tag LIKE '>%' OR tag LIKE '|%' OR tag LIKE '```%')")
    first = F.row_number().over(Window.partitionBy(F.lower("tag")).orderBy("ord"))
    return rows.withColumn("n", first).where("n = 1").select("tag", "ord")

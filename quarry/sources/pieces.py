"""Question files as they are written: loosely typed JSON, one file for each slice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import strip
from quarry.operators.lineage import numbered

#: Members whose type varies are taken as JSON text and told apart by their first character.
LOOSE = "task_id string, questions array<struct<type:string,stem:string,options:string,answer:string,analysis:string,difficulty:string,score:string,category:string,tags:string,source_quote:string>>"


def _listed(c: Column, separators: str) -> Column:
    """An array from a JSON array or a separated string."""
    array = F.from_json(c, "array<string>")
    split = F.filter(F.transform(F.split(c, separators), strip), lambda t: t != "")
    return F.when(c.isNull(), F.array().cast("array<string>")).when(F.substring(F.ltrim(c), 1, 1) == "[", F.coalesce(array, F.array().cast("array<string>"))).otherwise(split)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(piece, task_id, idx, ord, type, stem, options, answer, …): the questions of all files in order of name and place. A missing or
    empty task_id is the file's name. ``bad_options`` counts the options that are no objects, ``bad_score`` tells of a score that is no number;
    both are errors to the rules. A folder without files raises."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("piece"), F.from_json("value", LOOSE).alias("j"))
    if files.isEmpty():
        raise FileNotFoundError(f"no question file in {folder}")
    q = files.select("piece", F.coalesce(F.nullif("j.task_id", F.lit("")), F.regexp_replace("piece", r"\.json$", "")).alias("task_id"), F.posexplode("j.questions").alias("idx", "q"))
    score = F.col("q.score")
    whole = F.when(score.rlike(r"\A\s*[+-]?\d+\s*\z"), F.try_to_number(F.trim(score), F.lit("S9999999999")).cast("int")).when(score.rlike(r"\A[+-]?\d+\.\d+\z"), score.cast("double").cast("int")).when(score == "true", 1).when(score == "false", 0)
    items = F.coalesce(F.from_json("q.options", "array<string>"), F.array().cast("array<string>"))
    members = F.filter(items, lambda o: F.get_json_object(o, "$").startswith("{"))
    options = F.transform(members, lambda o: F.from_json(o, "label string, content string"))
    fields = q.select("piece", "task_id", "idx", *(F.col(f"q.{c}").alias(c) for c in ("type", "stem", "analysis", "difficulty", "category", "source_quote")), F.when(F.col("q.options").isNotNull(), options).alias("options"), (F.size(items) - F.size(members)).alias("bad_options"), _listed(F.col("q.answer"), r"[,，、;；\s]+").alias("answer"), whole.alias("score"), (score.isNotNull() & whole.isNull()).alias("bad_score"), _listed(F.col("q.tags"), "[,，、]").alias("tags"))
    return numbered(fields, "ord", "piece", "idx").withColumn("_task_id", F.col("task_id"))

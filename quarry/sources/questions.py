"""Banks, slices and reports written as one JSON document: an object with a list in it, or a bare list."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUESTION = "type string, stem string, options array<struct<label:string,content:string>>, answer array<string>, analysis string, difficulty string, score int, category string, tags array<string>, source_quote string, _task_id string, _source_file string, _source_section string, _fingerprint string, _freq string, _added_at string, _updated_at string, _locked boolean"
SLICE = "id string, rel string, section string, title string, h1 string, category string, tags array<string>, mode string, part int, parts int, char_count int, has_code boolean, has_table boolean, max_per_section int, text string, images array<string>"


def read(spark: SparkSession, path: str, member: str | None, schema: str, required: bool = True) -> DataFrame:
    """The rows of a document with their place in it (``ord``). Without ``member`` the document is a bare list. What is missing, empty or
    no JSON raises, or is an empty table if it isn't required."""
    rows = f"array<struct<{', '.join(f'{f.name}:{f.dataType.simpleString()}' for f in T._parse_datatype_string(schema).fields)}>>"
    try:
        text = spark.read.text(path, wholetext=True)
        value = F.from_json("value", f"`{member}` {rows}")[member] if member else F.from_json("value", rows)
        whole = text.select(value.alias("rows")).where("rows IS NOT NULL")
        if required and whole.isEmpty():
            raise ValueError(f"no list in {path}")
    except AnalysisException:
        if required:
            raise
        return spark.createDataFrame([], "ord long, " + schema)
    return whole.select(F.posexplode("rows").alias("ord", "r")).select(F.col("ord").cast("long").alias("ord"), "r.*")


def read_bank(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """The questions of an earlier bank; none if there is none."""
    return read(spark, path, "questions", QUESTION, required)


def read_slices(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """The slices of an earlier run; none if there is none or it can't be read."""
    return read(spark, path, "tasks", SLICE, required)

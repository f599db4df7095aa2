"""Slices from chunks: flags, filters with their reasons, category, tags, ids, and the comparison with an earlier run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.contract import NO_CATEGORY, Options
from quarry.functions.text import SPACE, clean_title, mode, slug, strip, strip_html, strip_numbering
from quarry.operators import structure

#: What counts as code, as a table, as an end of line.
FENCE = r"(?m)^[\s\x1c-\x1f]*(?:```|~~~)"
TABLE = r"(?m)^[\s\x1c-\x1f]*\|.*\|[\s\x1c-\x1f]*$"
BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def visible_length(c: Column) -> Column:
    """Characters but for whitespace and markup."""
    return F.length(F.regexp_replace(strip_html(c), SPACE + "+", ""))


def trivial(line: Column) -> Column:
    """Whether a line has only links, signs or a label."""
    t = F.regexp_replace(line, r"!?\[[^\]]*\]\([^)]*\)", "")
    t = F.regexp_replace(t, r"(?U)https?://[^\s\x1c-\x1f]+", "")
    t = F.regexp_replace(t, r"(?U)[\s\x1c-\x1f*\-_~>#|]+", "")
    return (t == "") | t.rlike(r"\A[一-\u9fffA-Za-z0-9 ()（）]{1,20}[:：]\z")


def empty_body(text: Column) -> Column:
    """Whether nothing is left besides headings and trivial lines; true for no lines at all."""
    # blank lines don't count, so the split needs no trimming, which would repeat the whole expression
    body = F.filter(F.transform(F.split(strip_html(text), BREAKS), strip), lambda s: (s != "") & ~s.rlike(r"(?U)\A#{1,6}[\s\x1c-\x1f]+"))
    return F.forall(body, trivial)


def images(text: Column) -> Column:
    """Addresses of images, Markdown's first, each once."""
    md = F.regexp_extract_all(text, F.lit(r"!\[[^\]]*\]\(\s*<?([^)\s>]+)>?[^)]*\)"), F.lit(1))
    tags = F.regexp_extract_all(text, F.lit(r"(?i)<img\b[^>]*\bsrc=[\"']([^\"']+)[\"']"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(F.concat(md, tags), strip), lambda u: u != ""))


def assess(chunks: DataFrame, options: Options = Options()) -> DataFrame:
    """The chunks, with clean titles and char_count, with mode, has_code, has_table, need and the reason to skip them, null if they are kept."""
    c = chunks.withColumns({"mode": mode(F.col("title"), options.mode), "has_code": F.col("text").rlike(FENCE), "has_table": F.col("text").rlike(TABLE)})
    c = c.withColumn("need", F.when(F.col("mode") == "qa", max(30, int(options.min_chars * 0.6))).otherwise(options.min_chars))
    thin = (F.col("char_count") < F.col("need")) & ~F.col("has_code") & ~F.col("has_table")
    return c.withColumn("reason", F.when(empty_body(F.col("text")), "empty").when(thin, "thin"))


def kept(assessed: DataFrame) -> DataFrame:
    return assessed.where("reason IS NULL")


def skipped(assessed: DataFrame) -> DataFrame:
    return assessed.where("reason IS NOT NULL")


def category(scalars: Column, rel: Column, h1: Column, override: str | None = None) -> Column:
    """Override, front matter, first folder, first heading, or none of them."""
    if override:
        named = F.lit(override)
        return F.coalesce(F.nullif(clean_title(named), F.lit("")), strip(named))
    keys = [F.nullif(strip(F.try_element_at(scalars, F.lit(k))), F.lit("")) for k in ("category", "分类", "categories")]
    parts = F.split(rel, "/")
    folder = F.when(F.size(parts) > 1, F.nullif(clean_title(strip_numbering(parts[0])), F.lit("")))
    return F.coalesce(*keys, folder, F.nullif(clean_title(strip_numbering(h1)), F.lit("")), F.lit(NO_CATEGORY))


def stem_of(rel: Column) -> Column:
    """A path's file name without its last suffix."""
    return F.regexp_replace(F.element_at(F.split(rel, "/"), -1), r"(?s)(?<=.)\.[^.]+\z", "")


def base_id(rel: Column, title: Column, part: Column, parts: Column) -> Column:
    """Slice id before clashes are resolved."""
    return F.concat(slug(stem_of(rel)), F.lit("__"), slug(title), F.when(parts > 1, F.format_string("__p%02d", part)).otherwise(""))


def _clashing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids for rows that come by family and in order: the first free one of base, base-2, base-3 …"""
    family, taken, last = None, set(), {}
    for b in batches:
        ids = []
        for f, base in zip(b["family"], b["base"]):
            if f != family:
                family, taken, last = f, set(), {}
            name, n = base, last.get(base, 1)
            while name in taken:
                n += 1
                name = f"{base}-{n}"
            last[base] = n
            taken.add(name)
            ids.append(name)
        yield b[["k"]].assign(id=ids)


def distinct_ids(slices: DataFrame, base: str = "base", order: str = "ord") -> DataFrame:
    """Adds ``id``: the first of base, base-2, base-3 … that no earlier slice has. ``order`` tells all slices apart. Bases can only clash
    with those that are equal but for such numbers at the end: their family. Families of one base, nearly all, are numbered by a
    window; in the others the ids are given one after another, streamed in order by family."""
    slim = slices.select(F.col(order).alias("k"), F.col(base).alias("base"), F.regexp_replace(base, r"(?:-[0-9]+)+\z", "").alias("family"))
    mixed = slim.groupBy("family").agg(F.min("base").alias("low"), F.max("base").alias("high")).where("low <> high").select("family")
    nth = F.row_number().over(Window.partitionBy("base").orderBy("k"))
    plain = slim.join(mixed, "family", "left_anti").select("k", F.when(nth == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), nth)).alias("id"))
    few = slim.join(mixed, "family", "left_semi").repartition("family").sortWithinPartitions("family", "k")
    kind = slim.schema["k"].dataType
    odd = few.mapInPandas(_clashing, T.StructType([T.StructField("k", kind), T.StructField("id", T.StringType())]))
    return slices.join(plain.unionByName(odd).withColumnRenamed("k", order), order)


def vocabulary_tags(slices: DataFrame, vocabulary: DataFrame, key: str, title: str, text: str, limit: int = 5) -> DataFrame:
    """(key, tags): the vocabulary's tags that occur in text or title, the most frequent first, those of the title before all.
    The vocabulary is collected: it is a hand-kept list, and one that is longer than 5,000 tags is refused."""
    rows = [r["tag"] for r in vocabulary.select("tag", "ord").where("tag <> ''").orderBy("ord").limit(5001).collect()]
    if len(rows) > 5000:
        raise ValueError("a tag vocabulary has at most 5000 tags")
    hay = F.concat(strip_html(F.col(text)), F.lit("\n"), F.coalesce(F.col(title), F.lit("")))

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def best(titles: pd.Series, hays: pd.Series) -> pd.Series:
        """In Python, as Catalyst would put the whole markup removal into the test of each tag."""
        out = []
        for title, hay in zip(titles, hays):
            near = [(-(hay.count(t) + (50 if t in title else 0)), len(t), i, t) for i, t in enumerate(rows) if t in hay]
            out.append([t for *_, t in sorted(near)[:limit]])
        return pd.Series(out, dtype=object)

    return slices.select(key, best(F.coalesce(F.col(title), F.lit("")), hay).alias("tags"))


def _first_spellings(tags: Column) -> Column:
    """Of tags that differ in case alone the first."""
    return F.filter(tags, lambda t, i: (i == 0) | ~F.exists(F.slice(tags, F.lit(1), i), lambda x: F.lower(x) == F.lower(t)))


def term_tags(slices: DataFrame, key: str, text: str, limit: int = 2, known: Column | None = None) -> DataFrame:
    """(key, terms): languages of fences, then terms in back quotes by frequency, first seen first among equals; none of ``known``."""
    langs = F.regexp_extract_all(F.col(text), F.lit(r"(?m)^[\s\x1c-\x1f]*(?:```|~~~)[\s\x1c-\x1f]*([A-Za-z0-9+#\-]+)"), F.lit(1))
    ticks = F.filter(F.transform(F.regexp_extract_all(F.col(text), F.lit(r"`([^`\n]{2,20})`"), F.lit(1)), strip), lambda t: F.length(t).between(2, 16) & t.rlike(r"\A[A-Za-z0-9一-\u9fff][A-Za-z0-9一-\u9fff+#._\- ]{1,15}\z"))
    seen = F.array_distinct("ticks")
    counted = F.transform(seen, lambda t, i: F.struct((-F.size(F.filter("ticks", lambda x: x == t))).alias("n"), i.alias("i"), t.alias("t")))
    terms = F.transform(F.slice(F.array_sort(counted), 1, 10), lambda r: r["t"])
    given = F.transform(known if known is not None else F.array().cast("array<string>"), F.lower)
    both = slices.select(key, langs.alias("langs"), ticks.alias("ticks"), given.alias("known")).select(key, "known", F.concat("langs", terms).alias("all"))
    free = both.select(key, F.filter("all", lambda t: ~F.array_contains("known", F.lower(t))).alias("all"))
    return free.select(key, F.slice(_first_spellings(F.col("all")), 1, limit).alias("terms"))


def inferred_tags(slices: DataFrame, key: str, scalars: str, lists: str, rel: str, title: str, text: str, limit: int = 5) -> DataFrame:
    """(key, tags) where there is no vocabulary: those of the front matter; if it has none, the file's name, the title and terms of the
    text. Whitespace is made single, and of tags that differ in case alone the first stays."""
    empty = F.array().cast("array<string>")
    given = []
    for name in ("tags", "tag", "标签"):
        given.append(F.coalesce(F.transform(F.try_element_at(lists, F.lit(name)), strip), empty))
        given.append(F.coalesce(F.transform(F.split(F.try_element_at(scalars, F.lit(name)), "[,，、]"), strip), empty))
    stem, bare = strip_numbering(stem_of(F.col(rel))), clean_title(strip_numbering(F.col(title)))
    own = F.filter(F.array(stem, F.when(F.lower(bare) != F.lower(stem), bare)), lambda t: t.isNotNull() & (t != ""))
    s = slices.select(key, F.col(text).alias("_text"), F.filter(F.concat(*given), lambda t: t != "").alias("given"), own.alias("own"))
    s = s.join(term_tags(s, key, "_text", known=F.col("own")), key)
    tags = F.when(F.size("given") > 0, F.col("given")).otherwise(F.concat("own", F.coalesce("terms", empty)))
    s = s.select(key, F.filter(F.transform(tags, lambda t: strip(F.regexp_replace(t, SPACE + "+", " "))), lambda t: t != "").alias("all"))
    return s.select(key, F.slice(_first_spellings(F.col("all")), 1, limit).alias("tags"))


def sourced(rel: Column, crumbs: Column, text: Column) -> Column:
    """A slice's text below the line that names its file and section; quotes of either are grounded by it."""
    return F.concat(F.lit("[来源] "), rel, F.lit(" | "), crumbs, F.lit("\n\n"), text)


def plan(files: DataFrame, vocabulary: DataFrame | None = None, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """(slices, skipped) of files (rel, raw): the slices with ids, category, tags and sourced text, in order of path, section and part
    (``at``); what was left out with its reason, the folded blocks of each file counted in a row of their own. Paths are unique."""
    matter = structure.with_front_matter(files, "rel", "raw")
    assessed = assess(structure.with_chunks(files, "rel", "raw", options), options).join(matter, "rel").withColumn("at", F.struct(F.split("rel", "/").alias("path"), "section_no", "part"))
    folded = matter.where("folded > 0").select("rel", F.lit("(全文)").alias("section"), F.lit("folded").alias("reason"), F.col("folded").alias("n"), F.lit(None).cast("int").alias("need"))
    left = skipped(assessed).select("rel", F.col("crumbs").alias("section"), "reason", F.col("char_count").alias("n"), "need").unionByName(folded)
    k = kept(assessed).withColumn("base", base_id(F.col("rel"), F.col("title"), F.col("part"), F.col("parts")))
    k = distinct_ids(k, "base", "at")
    named = vocabulary_tags(k, vocabulary, "id", "title", "text") if vocabulary is not None else inferred_tags(k, "id", "scalars", "lists", "rel", "title", "text")
    k = k.join(named, "id")
    shown = [
        "at", "id", "rel", F.col("crumbs").alias("section"), strip_numbering(F.col("title")).alias("title"), "h1", category(F.col("scalars"), F.col("rel"), F.col("h1"), options.category).alias("category"), "tags", "mode", "part", "parts",
        "char_count", "has_code", "has_table", F.lit(options.max_per_section).alias("max_per_section"), sourced(F.col("rel"), F.col("crumbs"), F.col("text")).alias("text"),
    ]
    return k.select(*shown, *([images(F.col("text")).alias("images")] if options.with_images else [])), left


def increment(new: DataFrame, old: DataFrame, key: str = "id") -> DataFrame:
    """(task_id, status): ids of this run and the last one: added, removed or unchanged. Null and repeated ids count once or not."""
    a = new.select(F.col(key).alias("task_id")).where("task_id IS NOT NULL").distinct().withColumn("now", F.lit(True))
    b = old.select(F.col(key).alias("task_id")).where("task_id IS NOT NULL").distinct().withColumn("before", F.lit(True))
    both = a.join(b, "task_id", "full_outer")
    return both.select("task_id", F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("unchanged").alias("status"))

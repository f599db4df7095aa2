"""Queries over the driver's tables, one or more for each operator of the pipeline, over whole tables.

The slices are ``tasks``, the files ``documents``, the accepted questions ``bank`` and the new ones ``clean``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.contract import Options
from quarry.functions import text as X
from quarry.operators import folds, merge, reports, similarity, slices, structure, validate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
NOW = "2026-01-01 00:00"


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


def load(spark: SparkSession, sf_dir: str, *names: str):
    got = [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
    return got[0] if len(got) == 1 else got


def joined(c: str) -> F.Column:
    return F.array_join(c, "|").alias(c)


@query
def grounding(spark, d):
    clean, tasks, docs = load(spark, d, "clean", "tasks", "documents")
    return validate.grounding(clean, tasks, docs)


@query
def norm_documents(spark, d):
    n = load(spark, d, "documents").select("doc_id", X.norm(F.col("text")).alias("n"))
    return n.select("doc_id", F.sha1("n").alias("digest"), F.length("n").cast("long").alias("n_chars"))


@query
def strip_html_slices(spark, d):
    return load(spark, d, "tasks").select("ord", F.sha1(X.strip_html(F.col("text"))).alias("digest"))


@query
def fingerprints(spark, d):
    return load(spark, d, "bank").select("ord", X.fingerprint(F.col("stem"), F.col("type")).alias("fp"))


@query
def fingerprint_repeats(spark, d):
    nth = F.row_number().over(Window.partitionBy("_fingerprint").orderBy("ord"))
    return load(spark, d, "clean").select("ord", "_fingerprint", nth.cast("long").alias("nth")).where("nth > 1")


@query
def content_fingerprints(spark, d):
    return merge.with_content(load(spark, d, "bank")).select("ord", "content")


@query
def titles(spark, d):
    t = load(spark, d, "tasks").select("ord", X.clean_title(F.col("title")).alias("title"))
    return t.select("ord", "title", X.strip_numbering(F.col("title")).alias("bare"), X.slug(F.col("title")).alias("slug"))


@query
def canonical_fields(spark, d):
    c = load(spark, d, "clean")
    return c.select("ord", X.canonical_type(F.col("type")).alias("type"), X.canonical_difficulty(F.col("difficulty")).alias("difficulty"), F.array_join(X.canonical_answer(F.col("answer")), ",").alias("answer"), F.array_join(X.content_tags(F.col("tags")), "|").alias("content_tags"), F.array_join(X.frequency_tags(F.col("tags")), "|").alias("freq_tags"), X.ordinal(F.col("options")).alias("ordinal"))


@query
def slice_ids(spark, d):
    t = load(spark, d, "tasks").select("ord", slices.base_id(F.col("rel"), X.clean_title(F.col("title")), F.col("part"), F.col("parts")).alias("base"))
    return slices.distinct_ids(t).select("ord", "base", "id")


@query
def front_matter(spark, d):
    f = structure.with_front_matter(load(spark, d, "documents"), "doc_id", "text")
    return f.select("doc_id", F.try_element_at("scalars", F.lit("category")).alias("category"), F.array_join(F.try_element_at("lists", F.lit("tags")), "|").alias("tags"))


@query
def folded_blocks(spark, d):
    return structure.with_front_matter(load(spark, d, "documents"), "doc_id", "text").where("folded > 0").select("doc_id", F.col("folded").cast("long").alias("folded"))


@query
def image_addresses(spark, d):
    return load(spark, d, "tasks").select("ord", slices.images(F.col("text")).alias("images")).where(F.size("images") > 0).select("ord", joined("images"))


@query
def heading_blocks(spark, d):
    b = structure.with_blocks(load(spark, d, "documents"), "doc_id", "text")
    return b.select("doc_id", F.col("block_no").cast("long").alias("block_no"), F.col("level").cast("long").alias("level"), "title", F.col("n_lines").cast("long").alias("n_lines"))


@query
def sections(spark, d):
    s = structure.with_sections(load(spark, d, "documents"), "doc_id", "text")
    return s.select("doc_id", F.col("section_no").cast("long").alias("section_no"), "title", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_paragraphs").cast("long").alias("n_paragraphs"))


def _assessed(spark, d):
    return slices.assess(structure.with_chunks(load(spark, d, "documents"), "doc_id", "text"))


@query
def chunks(spark, d):
    c = structure.with_chunks(load(spark, d, "documents"), "doc_id", "text")
    return c.select("doc_id", "section_no", "part", "parts", "crumbs", F.sha1("text").alias("digest"))


@query
def slices_kept(spark, d):
    return slices.kept(_assessed(spark, d)).select("doc_id", "section_no", "part", "title", "mode", "char_count", "has_code", "has_table")


@query
def slices_skipped(spark, d):
    return slices.skipped(_assessed(spark, d)).select("doc_id", "section_no", "part", "crumbs", "reason", "char_count", "need")


@query
def slice_flags(spark, d):
    t = load(spark, d, "tasks")
    return t.select("ord", X.mode(X.clean_title(F.col("title"))).alias("mode"), slices.visible_length(F.col("text")).cast("long").alias("char_count"), F.col("text").rlike(slices.FENCE).alias("has_code"), F.col("text").rlike(slices.TABLE).alias("has_table"), slices.empty_body(F.col("text")).alias("empty"))


@query
def categories(spark, d):
    f = structure.with_front_matter(load(spark, d, "documents"), "doc_id", "text")
    docs = load(spark, d, "documents").select("doc_id", "rel", "text")
    h1 = structure.with_blocks(docs, "doc_id", "text").where("level = 1").groupBy("doc_id").agg(F.min_by("title", "block_no").alias("h1"))
    return docs.drop("text").join(f, "doc_id").join(h1, "doc_id", "left").select("doc_id", slices.category(F.col("scalars"), F.col("rel"), F.coalesce("h1", F.lit(""))).alias("category"))


@query
def vocabulary_tags(spark, d):
    tasks, vocab = load(spark, d, "tasks", "tag_vocab")
    return slices.vocabulary_tags(tasks, vocab, "ord", "title", "text").where(F.size("tags") > 0).select("ord", joined("tags"))


@query
def term_tags(spark, d):
    return slices.term_tags(load(spark, d, "tasks"), "ord", "text").where(F.size("terms") > 0).select("ord", joined("terms"))


@query
def increment(spark, d):
    tasks, bank = load(spark, d, "tasks", "bank")
    return slices.increment(tasks, bank.select(F.col("_task_id").alias("id")))


@query
def only_new(spark, d):
    tasks, inc = load(spark, d, "tasks", "task_increment")
    return tasks.join(inc.where("status = 'added'").select(F.col("task_id").alias("id")), "id", "left_semi").select("ord", "id")


def _validated(spark, d):
    return validate.validate(*load(spark, d, "clean", "tasks", "documents"))


@query
def validate_items(spark, d):
    return _validated(spark, d).select("ord", "status", joined("errors"), joined("warnings"))


@query
def validate_status_counts(spark, d):
    return validate.status_counts(_validated(spark, d))


@query
def validate_rule_counts(spark, d):
    return validate.rule_counts(_validated(spark, d))


@query
def crowded_sections(spark, d):
    return validate.crowded_sections(load(spark, d, "clean"))


@query
def frequency_distribution(spark, d):
    return validate.frequencies(load(spark, d, "clean").withColumn("_freq", F.get(X.frequency_tags(F.col("tags")), F.lit(0))))


@query
def frequency_alarm(spark, d):
    return validate.high_alarm(load(spark, d, "clean").withColumn("_freq", F.get(X.frequency_tags(F.col("tags")), F.lit(0))))


@query
def answer_positions(spark, d):
    return validate.positions(load(spark, d, "clean"))


@query
def top_combination(spark, d):
    return validate.top_combination(load(spark, d, "clean"))


@query
def position_skew(spark, d):
    return validate.skew(load(spark, d, "clean"))


@query
def near_duplicates(spark, d):
    return similarity.near_duplicates(load(spark, d, "clean"))


@query
def near_duplicate_report(spark, d):
    """The fifty most alike, a top-k report. Ratios are ordered by three places, half to even."""
    n = similarity.near_duplicates(load(spark, d, "clean"))
    return n.withColumn("ratio", F.bround("ratio", 3)).orderBy(F.desc("ratio"), "ord_a", "ord_b").limit(50)


@query
def fuzzy_edges(spark, d):
    clean, bank = load(spark, d, "clean", "bank")
    return similarity.fuzzy_edges(clean, bank).select("ord", "bank_ord", "score")


@query
def merge_exact(spark, d):
    clean, bank = load(spark, d, "clean", "bank")
    return merge.by_fingerprint(clean, bank)


@query
def merge_actions(spark, d):
    clean, bank = load(spark, d, "clean", "bank")
    return merge.actions(clean, bank)


@query
def merge_stats(spark, d):
    return merge_actions(spark, d).groupBy("action").agg(F.count("*").alias("n"))


@query
def prune(spark, d):
    clean, bank, tasks, docs = load(spark, d, "clean", "bank", "tasks", "documents")
    return merge.leftovers(bank, merge.by_fingerprint(clean, bank), docs, tasks)


@query
def prune_merged(spark, d):
    """What is left over after the whole merge, like matches included."""
    clean, bank, tasks, docs = load(spark, d, "clean", "bank", "tasks", "documents")
    return merge.leftovers(bank, merge.actions(clean, bank), docs, tasks)


@query
def merged_bank(spark, d):
    clean, bank = load(spark, d, "clean", "bank")
    acted = merge.actions(clean, bank)
    whole = merge.merged(clean, bank, acted, merge.leftovers(bank, acted), NOW)
    return whole.select("ord", "category", "type", "_fingerprint", "_added_at", "_updated_at")


@query
def balance_single(spark, d):
    b = folds.balance_single(load(spark, d, "clean"))
    return b.select("ord", F.array_join(F.transform("options", lambda o: o["content"]), "|").alias("options"), F.array_join("answer", "").alias("answer"))


@query
def balance_multi(spark, d):
    b = folds.balance_multi(load(spark, d, "clean"))
    return b.select("ord", F.array_join(F.transform("options", lambda o: o["content"]), "|").alias("options"), F.array_join("answer", "").alias("answer"))


@query
def balance_report(spark, d):
    """The eight most frequent answers of each type after balancing, a top-k report."""
    clean = load(spark, d, "clean")
    both = folds.balance_single(clean).withColumn("type", F.lit("SINGLE")).unionByName(folds.balance_multi(clean).withColumn("type", F.lit("MULTI")))
    by = both.groupBy("type", F.array_join("answer", "").alias("combo")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("type").orderBy(F.desc("n"), "combo"))
    return by.withColumn("rank", rank).where("rank <= 8").select("type", "combo", "n")


@query
def batches(spark, d):
    return folds.batches(load(spark, d, "tasks")).select("ord", F.col("batch_no").cast("long").alias("batch_no"), "chars")


@query
def batch_sizes(spark, d):
    return folds.batch_sizes(batches(spark, d))


@query
def bank_distributions(spark, d):
    return reports.distributions(load(spark, d, "bank"))


@query
def slice_counts(spark, d):
    return reports.per_slice(load(spark, d, "bank"))


@query
def slice_average(spark, d):
    return reports.slice_average(load(spark, d, "bank"))


@query
def over_limit(spark, d):
    return reports.over_limit(load(spark, d, "bank"))


@query
def coverage(spark, d):
    return reports.coverage(*load(spark, d, "tasks", "bank"))


@query
def uncovered(spark, d):
    return reports.covered(*load(spark, d, "tasks", "bank")).where("NOT covered").select("id")


@query
def contract_export(spark, d):
    c = reports.contract(load(spark, d, "bank"))
    return c.select("type", "stem", F.array_join(F.transform("options", lambda o: F.concat(o["label"], F.lit(":"), o["content"])), "|").alias("options"), joined("answer"), "analysis", "difficulty", F.col("score").cast("long").alias("score"), "category", joined("tags"))


@query
def bank_index(spark, d):
    return reports.index_rows(load(spark, d, "bank"))


@query
def category_files(spark, d):
    return reports.category_files(load(spark, d, "bank"))


@query
def preview_rows(spark, d):
    p = reports.preview(load(spark, d, "bank"), kind="SINGLE", frequency="高频")
    return p.select("ord", "stem", "category", reports.named(F.col("type")).alias("kind"), reports.named(F.col("difficulty")).alias("difficulty"))


@query
def preview_facets(spark, d):
    return reports.facets(load(spark, d, "bank"))


@query
def slice_facets(spark, d):
    return reports.slice_facets(load(spark, d, "tasks"))


@query
def slice_totals(spark, d):
    return reports.slice_totals(load(spark, d, "tasks"))


@query
def added_slices(spark, d):
    return reports.added_slices(*load(spark, d, "task_increment", "tasks"))


@query
def uncovered_places(spark, d):
    return reports.uncovered_places(*load(spark, d, "tasks", "bank"))


@query
def sourced_slices(spark, d):
    t = load(spark, d, "tasks")
    return t.select("ord", F.sha1(slices.sourced(F.coalesce("rel", F.lit("")), F.coalesce("section", F.lit("")), F.coalesce("text", F.lit("")))).alias("digest"))


@query
def inferred_tags(spark, d):
    f = structure.with_front_matter(load(spark, d, "documents"), "doc_id", "text")
    docs = load(spark, d, "documents").select("doc_id", "rel", F.lit("").alias("title"), F.coalesce("text", F.lit("")).alias("text"))
    return slices.inferred_tags(docs.join(f, "doc_id"), "doc_id", "scalars", "lists", "rel", "title", "text").select("doc_id", joined("tags"))


def _planned(spark, d):
    """The files of the corpus, of equal paths the first, sliced."""
    docs = load(spark, d, "documents").where("rel IS NOT NULL")
    first = docs.groupBy("rel").agg(F.min("doc_id").alias("doc_id"))
    files = docs.join(first, ["rel", "doc_id"], "left_semi").select("rel", F.coalesce("text", F.lit("")).alias("raw"))
    return slices.plan(files, load(spark, d, "tag_vocab"))


@query
def planned_slices(spark, d):
    k, _ = _planned(spark, d)
    return k.select("id", "rel", "section", "title", "h1", "category", joined("tags"), "mode", "part", "parts", "char_count", F.sha1("text").alias("digest"))


@query
def planned_skips(spark, d):
    return _planned(spark, d)[1]


@query
def balanced_choices(spark, d):
    """Answers of SINGLE questions by position after balancing."""
    return folds.balance_single(load(spark, d, "clean")).groupBy(F.array_join("answer", "").alias("label")).agg(F.count("*").alias("n"))

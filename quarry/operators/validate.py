"""Questions checked rule by rule: each rule appends messages to a row's errors or warnings, nothing is thrown.

All rules are projections inside one stage; the quotes are looked for after an equi-join on the slice, so the containment test is a
filter on joined rows. Only the test for repeated fingerprints shuffles, on (fingerprint).

Defined cases: null strings count as empty; a question whose slice is unknown can't be grounded; of equal slice ids the last counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.contract import FREQUENCIES, LABELS, NO_CATEGORY, Options
from quarry.functions import text as X


def _some(*messages: Column) -> Column:
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


def _each(array: Column, test, message: str) -> Column:
    """One message for each element that fails."""
    return F.transform(F.filter(array, test), lambda _: F.lit(message))


def canonical(questions: DataFrame) -> DataFrame:
    """The questions with canonical type, stem, options, answer, difficulty, score, category, tags and analysis, beside what the
    rules need of the raw ones (``raw_*``)."""
    empty = F.array().cast("array<struct<label:string,content:string>>")
    options = F.transform(F.coalesce("options", empty), lambda o: F.struct(F.upper(X.strip(F.coalesce(o["label"], F.lit("")))).alias("label"), X.strip(F.coalesce(o["content"], F.lit(""))).alias("content")))
    q = questions.withColumns({"raw_type": F.col("type"), "raw_difficulty": F.col("difficulty"), "raw_score": F.col("score"), "raw_category": F.col("category")})
    q = q.withColumns({"type": X.canonical_type(F.col("type")), "stem": X.strip(F.coalesce("stem", F.lit(""))), "options": options, "answer": X.canonical_answer(F.coalesce("answer", F.array().cast("array<string>"))), "difficulty": X.canonical_difficulty(F.col("difficulty")), "source_quote": X.strip(F.coalesce("source_quote", F.lit(""))), "analysis": X.strip(F.coalesce("analysis", F.lit("")))})
    sides = F.transform("options", lambda o: X.side(o["content"]))
    q = q.withColumn("sides", sides)
    turned = (F.col("type") == "JUDGE") & (F.size("options") == 2) & F.get("sides", F.lit(0)).isNotNull() & F.get("sides", F.lit(1)).isNotNull() & (F.get("sides", F.lit(0)) != F.get("sides", F.lit(1)))
    remap = F.map_from_arrays(F.transform("options", lambda o: o["label"]), F.transform("sides", lambda s: F.when(s == "T", "A").otherwise("B")))
    q = q.withColumn("turned", F.coalesce(turned, F.lit(False)) & (F.get("options", F.lit(0))["label"] != F.get("options", F.lit(1))["label"]))
    q = q.withColumn("_judge_remap", F.when(F.col("turned"), remap))
    judge = F.array(*(F.struct(F.lit(a).alias("label"), F.lit(b).alias("content")) for a, b in (("A", "正确"), ("B", "错误"))))
    q = q.withColumns({"plain_options": F.col("options"), "answer": F.when(F.col("turned"), F.transform("answer", lambda a: F.coalesce(F.try_element_at("_judge_remap", a), a))).otherwise(F.col("answer")), "options": F.when(F.col("turned"), judge).otherwise(F.col("options"))})
    q = q.withColumn("score", F.coalesce(F.col("score").cast("int"), X.default_score(F.col("difficulty"))))
    q = q.withColumns({"content_tags": X.content_tags(F.col("tags")), "freq_tags": X.frequency_tags(F.col("tags")), "category": F.coalesce(F.nullif(X.strip(F.col("category")), F.lit("")), F.lit(NO_CATEGORY))})
    return q.withColumns({"_freq": F.get("freq_tags", F.lit(0)), "tags": F.slice(F.concat("content_tags", "freq_tags"), 1, 10), "_fingerprint": X.fingerprint(F.col("stem"), F.col("type"))})


def rules(c: DataFrame) -> DataFrame:
    """Adds the errors and warnings that a row has by itself."""
    opts, size = F.col("plain_options"), F.size("plain_options")
    contents = F.filter(F.transform(opts, lambda o: X.norm(o["content"])), lambda n: n != "")
    labels = F.transform(opts, lambda o: o["label"])
    repeated = F.filter(labels, lambda x, i: (i > 0) & F.array_contains(F.slice(labels, F.lit(1), i), x))
    n = F.size("answer")
    # of loosely typed files: options that are no objects, scores that are no numbers
    bad = F.coalesce("bad_options", F.lit(0)) if "bad_options" in c.columns else F.lit(0)
    odd = F.coalesce("bad_score", F.lit(False)) if "bad_score" in c.columns else F.lit(False)
    declared = F.transform("options", lambda o: o["label"])
    stem = X.norm(F.col("stem"))
    errors = F.concat(
        _some(F.when(F.col("type").isNull(), "type"), F.when(F.col("stem") == "", "stem_empty"), F.when((size == 0) & (bad == 0), "options_missing")),
        F.array_repeat(F.lit("option_no_object"), bad),
        _each(opts, lambda o: ~o["label"].isin(*LABELS), "label"),
        F.transform(repeated, lambda _: F.lit("label_repeated")),
        _each(opts, lambda o: o["content"] == "", "option_empty"),
        _each(opts, lambda o: (o["content"] != "") & (X.norm(o["content"]) == stem), "option_is_stem"),
        _some(
            F.when((size < 2) | (size > 6), "option_count"),
            F.when(F.size(F.array_distinct(contents)) != F.size(contents), "options_repeated"),
            F.when(n == 0, "answer"),
            F.when((n > 0) & (F.size(F.array_except("answer", declared)) > 0), "answer_undeclared"),
            F.when((n > 0) & F.col("type").isin("SINGLE", "JUDGE") & (n != 1), "answer_not_one"),
            F.when((n > 0) & (F.col("type") == "MULTI") & (n < 2), "answer_too_few"),
            F.when((n > 0) & (F.col("type") == "MULTI") & (n == F.size("options")), "answer_all"),
            F.when(odd, "score_no_number"),
            F.when(~F.col("score").between(1, 100), "score"),
            F.when(F.size("freq_tags") == 0, "frequency_missing"),
            F.when(F.size("freq_tags") > 1, "frequency_many"),
            F.when(F.size("content_tags") + F.size("freq_tags") > 10, "tags_many"),
            F.when(F.col("source_quote") == "", "quote_missing"),
            F.when(F.length("source_quote") > 200, "quote_long"),
        ),
    )
    warnings = F.concat(
        _some(F.when(F.length("stem") > 500, "stem_long")),
        _each(opts, lambda o: F.length(o["content"]) == 1, "option_short"),
        _each(opts, lambda o: F.contains(o["content"], F.lit("以上都")) | F.contains(o["content"], F.lit("以上全部")), "option_all"),
        _some(
            F.when((F.col("type") == "JUDGE") & (size == 2) & ~F.col("turned"), "judge_wording"),
            F.when((F.col("type") == "SINGLE") & size.between(1, 2), "options_few"),
            F.when(F.col("raw_difficulty").isNull(), "difficulty_missing"),
            F.when(~F.upper(X.strip(F.col("raw_difficulty"))).isin("EASY", "MEDIUM", "HARD"), "difficulty_renamed"),
            F.when(F.coalesce("raw_category", F.lit("")) == "", "category_missing"),
            F.when(F.size("content_tags") > 5, "content_tags_many"),
            F.when(F.col("analysis") == "", "analysis_missing"),
        ),
    )
    return c.withColumns({"errors": errors, "warnings": warnings})


def last_slices(tasks: DataFrame, wanted: DataFrame, order: str = "ord") -> DataFrame:
    """(id, rel, norm_text): of equal ids the last slice, its text in normal form; only of the ids that are asked for."""
    asked = tasks.join(wanted.select(F.col("_task_id").alias("id")).distinct(), "id", "left_semi")
    last = asked.groupBy("id").agg(F.max(order).alias(order))
    return asked.join(last, ["id", order], "left_semi").select("id", "rel", X.norm(F.col("text")).alias("norm_text"))


def grounding(questions: DataFrame, tasks: DataFrame, files: DataFrame, key: str = "ord") -> DataFrame:
    """(key, hit): where the quote stands: in its section, elsewhere in the file, or nowhere. Files are joined for the rows alone that
    miss their section, so the long texts are shuffled for few; each wanted file is brought to its normal form once."""
    asked = questions.select(F.col(key), "_task_id", X.norm(F.col("source_quote")).alias("quote"))
    joined = asked.join(last_slices(tasks, asked), asked["_task_id"] == F.col("id"), "left")
    judged = joined.select(key, "quote", "rel", ((F.col("quote") != "") & F.coalesce(F.contains("norm_text", "quote"), F.lit(False))).alias("hit"))
    near = judged.where("hit").select(key, F.lit("section").alias("hit"))
    missed = judged.where("NOT hit")
    wanted = missed.where("quote <> '' AND rel IS NOT NULL").select(key, "quote", "rel")
    read = files.where("text IS NOT NULL").join(wanted.select("rel").distinct(), "rel", "left_semi").select("rel", X.norm(F.col("text")).alias("whole"))
    inside = wanted.join(read, "rel").where(F.contains("whole", "quote")).select(key).distinct().withColumn("found", F.lit(True))
    far = missed.join(inside, key, "left").select(key, F.when(F.col("found"), "file").otherwise("none").alias("hit"))
    return near.unionByName(far)


def validate(questions: DataFrame, tasks: DataFrame, files: DataFrame, options: Options = Options()) -> DataFrame:
    """(ord, task_id, type, stem, errors, warnings, status, …canonical fields): every question with its messages."""
    checked = rules(canonical(questions))
    hits = grounding(questions, tasks, files)
    joined = checked.join(hits, "ord", "left")
    quoted = F.col("source_quote") != ""
    joined = joined.withColumns({"errors": F.concat("errors", _some(F.when(quoted & (F.col("hit") == "none"), "quote_not_found"))), "warnings": F.concat("warnings", _some(F.when(quoted & (F.col("hit") == "file"), "quote_elsewhere")))})
    # every row takes its fingerprint, failed ones too; only a row without other errors is marked
    nth = F.row_number().over(Window.partitionBy("_fingerprint").orderBy("ord"))
    joined = joined.withColumn("errors", F.when((nth > 1) & (F.size("errors") == 0), F.array(F.lit("repeated"))).otherwise(F.col("errors")))
    # counted with partial sums and joined for the slices alone that have too many: one slice may hold a large part of all rows
    clear = F.size("errors") == 0
    over = joined.where(clear).groupBy("_task_id").agg(F.count("*").alias("n")).where(F.col("n") > options.max_per_section).select("_task_id", F.lit(True).alias("over"))
    joined = joined.join(over, joined["_task_id"].eqNullSafe(over["_task_id"]), "left").drop(over["_task_id"])
    joined = joined.withColumn("warnings", F.when(clear & F.col("over"), F.concat("warnings", F.array(F.lit("section_over")))).otherwise(F.col("warnings"))).drop("over")
    return joined.withColumn("status", F.when(F.size("errors") > 0, "fail").when(F.size("warnings") > 0, "warn").otherwise("ok"))


def clean(validated: DataFrame) -> DataFrame:
    return validated.where("status <> 'fail'")


def disputed(validated: DataFrame) -> DataFrame:
    return validated.where("status = 'fail'")


# summaries of clean questions


def status_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("status").agg(F.count("*").alias("n"))


def rule_counts(validated: DataFrame) -> DataFrame:
    errors = validated.select(F.lit("error").alias("kind"), F.explode("errors").alias("rule"))
    return errors.unionByName(validated.select(F.lit("warning").alias("kind"), F.explode("warnings").alias("rule"))).groupBy("kind", "rule").agg(F.count("*").alias("n"))


def crowded_sections(questions: DataFrame, options: Options = Options()) -> DataFrame:
    """(task_id, n): slices with more questions than the alarm allows; skewed slices are counted partially first."""
    return questions.groupBy(F.col("_task_id").alias("task_id")).agg(F.count("*").alias("n")).where(F.col("n") > options.max_per_section)


def frequencies(questions: DataFrame) -> DataFrame:
    """(freq, n, share): how often each frequency is given, and its share."""
    by = questions.groupBy(F.coalesce("_freq", F.lit("未标")).alias("freq")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # over the counts, of which there are few
    return by.select("freq", "n", (F.col("n") / total).alias("share"))


def high_alarm(questions: DataFrame, options: Options = Options()) -> DataFrame:
    """(n, high_ratio, alarm): one row."""
    c = questions.agg(F.count("*").alias("n"), F.coalesce(F.avg(F.when(F.col("_freq") == FREQUENCIES[0], 1.0).otherwise(0.0)), F.lit(0.0)).alias("high_ratio"))
    return c.withColumn("alarm", (F.col("n") >= options.high_sample) & (F.col("high_ratio") > options.high_share))


def positions(questions: DataFrame) -> DataFrame:
    """(label, n): answers of SINGLE questions by position."""
    return questions.where("type = 'SINGLE'").select(F.explode("answer").alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def top_combination(questions: DataFrame) -> DataFrame:
    """(combo, n): the most frequent answer of MULTI questions, of equals the one seen first; no row without such questions."""
    by = questions.where("type = 'MULTI'").groupBy(F.array_join("answer", "").alias("combo")).agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    return by.orderBy(F.desc("n"), "first").limit(1).select("combo", "n")


def skew(questions: DataFrame, options: Options = Options()) -> DataFrame:
    """(label, n, total, ratio): the leading position of SINGLE answers, where it leads too far; else no row."""
    answers = questions.where("type = 'SINGLE'").groupBy("answer").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # over the counts of the answers given, of which there are few
    by = answers.withColumn("total", total).select(F.explode("answer").alias("label"), "n", "first", "total").groupBy("label").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("total").alias("total"))
    top = by.orderBy(F.desc("n"), "first").limit(1).select("label", "n", "total", (F.col("n") / F.col("total")).alias("ratio"))
    return top.where((F.col("total") >= 10) & (F.col("ratio") > options.position_share))

import json

import pytest
from pyspark.sql import functions as F

from quarry.contract import Options
from quarry.operators import lineage, reports, slices, structure, validate
from quarry.sources import markdown, pieces, questions, sinks

FILES = [
    ("x/a.md", "---\ntags: [A, b, a]\n---\n# H\n## 什么是锁\n" + "字" * 60 + "\n<details>q</details>"),
    ("x/01-b.md", "# T\n## 锁\n```sql\nx `Foo` `Foo` `sql`\n```"),
    ("x/y/b.md", "# T\n## 锁\n```sql\nx\n```"),
    ("c.md", ""),
]


def brute_ids(bases):
    seen, out = set(), []
    for b in bases:
        name, n = b, 2
        while name in seen:
            name, n = f"{b}-{n}", n + 1
        seen.add(name)
        out.append(name)
    return out


def test_ids_equal_brute_force(spark):
    bases = ["a", "a", "a-2", "a-2-2", "a-2", "b", "b", "c-7", "c", "c-7", "c-7-2", "a", "a-3"]
    t = spark.createDataFrame(list(enumerate(bases)), "ord long, base string").withColumn("k", F.lit("clash")).withColumn("family", F.lit("clash"))
    assert [r["id"] for r in slices.distinct_ids(t).orderBy("ord").collect()] == brute_ids(bases)
    assert slices.distinct_ids(t.limit(0)).count() == 0


def test_plan_without_vocabulary(spark):
    kept, left = slices.plan(spark.createDataFrame(FILES, "rel string, raw string"))
    got = {r["id"]: r for r in kept.collect()}
    assert got["a__什么是锁"]["tags"] == ["A", "b"] and got["a__什么是锁"]["text"].startswith("[来源] x/a.md | H > 什么是锁\n\n## 什么是锁\n")
    assert got["01-b__锁"]["tags"] == ["b", "锁", "sql", "Foo"] and got["01-b__锁"]["category"] == "x"
    assert ("x/a.md", "(全文)", "folded") in {(r["rel"], r["section"], r["reason"]) for r in left.collect()}
    report = sinks.plan_report(kept, left, slices.increment(kept, kept.limit(0)))
    assert "切片数：**3**" in report and "折叠块：1 个" in report and "新增 **3**" in report
    none, nothing = slices.plan(spark.createDataFrame([], "rel string, raw string"))
    assert none.count() == 0 and nothing.count() == 0


def test_plan_with_vocabulary_and_override(spark):
    vocab = spark.createDataFrame([("锁", 1), ("sql", 2)], "tag string, ord int")
    kept, _ = slices.plan(spark.createDataFrame(FILES, "rel string, raw string"), vocab, Options(category="<b>My</b> cat", with_images=True))
    assert {r["category"] for r in kept.collect()} == {"My cat"}
    assert {r["id"]: r["tags"] for r in kept.collect()}["b__锁"] == ["锁", "sql"]


def test_nearest_vocabulary_of_the_first_file(spark):
    lists = spark.createDataFrame([("tags.md", "t1"), ("x/y/tags.md", "t2")], "rel string, text string")
    chosen = lambda *rels: [r["text"] for r in markdown.chosen_vocabulary(spark.createDataFrame([(r,) for r in rels], "rel string"), lists).collect()]
    assert chosen("x/y/z/w/q/f.md", "x/y/a.md") == ["t2"]
    assert chosen("x/b/a.md") == ["t1"] and chosen("p/q/r/s/t.md") == []


def test_single_file(spark, tmp_path):
    (tmp_path / "one.md").write_text("# A\n")
    (tmp_path / "two.md").write_text("# B\n")
    assert [r["rel"] for r in markdown.scan(spark, str(tmp_path / "one.md")).collect()] == ["one.md"]
    assert [(r["rel"], r["file_ord"]) for r in markdown.ordered(markdown.scan(spark, str(tmp_path))).orderBy("file_ord").collect()] == [("one.md", 1), ("two.md", 2)]


def test_options_and_scores_of_loose_files(spark, tmp_path):
    q = [{"type": "SINGLE", "stem": "s", "options": ["a", {"label": "B", "content": "xy"}], "score": "abc"}, {"options": None, "score": 3}, {"options": ["a"]}]
    (tmp_path / "f.json").write_text(json.dumps({"task_id": "", "questions": q}))
    got = pieces.read(spark, str(tmp_path))
    assert [(r["bad_options"], r["bad_score"]) for r in got.orderBy("ord").collect()] == [(1, True), (0, False), (1, False)]
    errors = [r["errors"] for r in validate.rules(validate.canonical(got)).orderBy("ord").collect()]
    assert {"option_no_object", "score_no_number", "option_count"} <= set(errors[0]) and "options_missing" in errors[1] and "options_missing" not in errors[2]


def test_documents_that_are_missing_or_broken(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"count": 1, "questions": [{"stem": "s", "score": 2}]}))
    (tmp_path / "broken.json").write_text("{")
    assert [(r["ord"], r["stem"], r["score"]) for r in questions.read_bank(spark, str(tmp_path / "b.json")).collect()] == [(0, "s", 2)]
    for name in ("none.json", "broken.json"):
        assert questions.read_slices(spark, str(tmp_path / name)).count() == 0
    with pytest.raises(ValueError):
        questions.read_bank(spark, str(tmp_path / "broken.json"), required=True)


def test_running_sums(spark):
    df = spark.createDataFrame([(i * 7 % 101, i) for i in range(101)], "k int, v int").repartition(5)
    rows = sorted((r["k"], r["v"], r["s"]) for r in lineage.running(df, F.col("v"), "s", "k").collect())
    total = 0
    for _, v, s in rows:
        total += v
        assert s == total


def test_review_and_pages(spark):
    bank = spark.createDataFrame([(i, "SINGLE", "EASY", "高频", "t1", "c", f"stem {i} <b>", [], ["A"], "", 1, ["高频"]) for i in range(7)], "ord long, type string, difficulty string, _freq string, _task_id string, category string, stem string, options array<struct<label:string,content:string>>, answer array<string>, analysis string, score int, tags array<string>")
    tasks = spark.createDataFrame([(1, "t1", "a.md", "A", 5, "qa"), (2, "t2", "a.md", "B", 6, "qa")], "ord long, id string, rel string, section string, char_count int, mode string")
    validated = spark.createDataFrame([(1, "fail", "s", [], ["stem_empty"], None), (2, "warn", "w", ["x"], [], "高频")], "ord long, status string, stem string, warnings array<string>, errors array<string>, _freq string")
    text = sinks.review(bank, tasks, None, validated)
    assert "`t1`：7 题" in text and "`a.md` → B" in text and "失败 1" in text and "s → stem_empty" in text and "样本太小" in text
    page = sinks.preview_page(reports.preview(bank))
    assert "\\u003cb>" in page and "copy" in page
    with pytest.raises(ValueError):
        sinks.preview_page(reports.preview(bank), limit=3)
    index = sinks.batch_index(tasks, spark.createDataFrame([(1, 1, 5), (2, 2, 6)], "ord long, batch_no int, chars long"))
    assert "## b2 — 1 片 / 6 字" in index and "`t2`（6 字，qa）" in index


def test_category_from_first_heading(spark):
    df = spark.createDataFrame([("a.md", "1. 锁")], "rel string, h1 string").withColumn("m", F.lit(None).cast("map<string,string>"))
    assert df.select(slices.category(F.col("m"), F.col("rel"), F.col("h1"))).first()[0] == "锁"
    assert structure.title_of("## x ##") == "x"

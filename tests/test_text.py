import hashlib

from pyspark.sql import functions as F

from quarry.functions import text as X


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_strip_html(spark):
    got = one(spark, X.strip_html, '<font style="x">a</font>', "&amp;lt;", "范围查询（>、< 停止）", "<!-- x\ny -->b", "<" + "a" * 302 + ">", None, "p<q 与 q>r")
    assert got == ["a", "&lt;", "范围查询（>、< 停止）", "b", "<" + "a" * 302 + ">", "", "pr"]


def test_norm_and_whitespace(spark):
    odd = "a" + chr(0x3000) + "B" + chr(0xA0) + "c" + chr(0x1C) + "`*_>" + chr(0x85) + "d"
    assert one(spark, X.norm, odd, None) == ["abcd", ""]
    assert one(spark, X.strip, chr(0x3000) + "\t x " + chr(0x2028)) == ["x"]


def test_fingerprint_is_sha1_of_normal_form(spark):
    df = spark.createDataFrame([("<b>题 干</b>", "single"), ("题干", None)], "s string, t string")
    got = [r[0] for r in df.select(X.fingerprint(F.col("s"), F.col("t"))).collect()]
    assert got == [hashlib.sha1(f"题干|{t}".encode()).hexdigest()[:16] for t in ("SINGLE", "NONE")]


def test_slug_and_titles(spark):
    assert one(spark, X.slug, "a/b: c", "  ", None, "x" * 61, "-a-") == ["a_b_-c", "untitled", "untitled", "x" * 60, "a"]
    assert one(spark, X.strip_numbering, "01-foo", "1.2 foo", "第三章 锁", "x1", None) == ["foo", "foo", "锁", "x1", ""]
    assert one(spark, X.clean_title, "# ----概念----", "<b>a</b>  b", "") == ["概念", "a b", ""]


def test_modes(spark):
    assert one(spark, lambda c: X.mode(c), "什么是锁", "锁？", "锁", "", "如何" + "长" * 40) == ["qa", "qa", "prose", "prose", "prose"]


def test_canonical_fields(spark):
    assert one(spark, X.canonical_type, "单选题", "multi", " Judge ", "x", None) == ["SINGLE", "MULTI", "JUDGE", None, None]
    assert one(spark, X.canonical_difficulty, "难", "easy", "??", None) == ["HARD", "EASY", "MEDIUM", "MEDIUM"]
    df = spark.createDataFrame([(["A,C"],), (["a", "c", "a"],), (["(A)"],), (["选项A"],), (None,), ([],)], "x array<string>")
    assert [r[0] for r in df.select(X.canonical_answer(F.col("x"))).collect()] == [["A", "C"], ["A", "C"], ["A"], [], [], []]


def test_tags_and_options(spark):
    df = spark.createDataFrame([(["锁", "高频", " ", None],), (None,)], "x array<string>")
    rows = df.select(X.content_tags(F.col("x")), X.frequency_tags(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [(["锁"], ["高频"]), ([], [])]
    o = spark.createDataFrame([([("A", "1. x")],), ([("A", "x")],), (None,)], "o array<struct<label:string,content:string>>")
    assert [r[0] for r in o.select(X.ordinal(F.col("o"))).collect()] == [True, False, False]


def test_content_fingerprint_ignores_tag_order_only(spark):
    schema = "options array<struct<label:string,content:string>>, answer array<string>, analysis string, difficulty string, score int, category string, tags array<string>"
    base = ([("A", "x")], ["A"], "a", "EASY", 1, "c", ["t", "u"])
    rows = [base, (*base[:6], ["u", "t"]), ([("A", "x")], ["B"], *base[2:]), (*base[:4], 0, *base[5:]), (None,) * 7]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(X.content_fingerprint(*(F.col(c) for c in df.columns))).collect()]
    assert got[0] == got[1] and len(set(got)) == 4

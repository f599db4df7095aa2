import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import boosting, confusables, encoding, history, leakage, markup, mojibake, nearpairs, questions, splitting
from quarry.llm.common import alike, bigrams, canonical
from quarry.llm.history import Index
from quarry.operators.overlap import Overlap

QUESTIONS = "ord long, type string, stem string, options array<struct<label:string,content:string>>, _fingerprint string"


# 1: splitting


def check_spans(text, limit, overlap):
    got = splitting.spans(text, limit, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for (a, b), (c, d) in zip(got, got[1:]):
        assert 0 < b - a <= limit and a < c <= b and b < d and b - c <= overlap
    assert all(b - a <= limit for a, b in got)
    return got


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet="ab 。，.\n#-`\u0301\u200d字😀\r", max_size=400), st.integers(3, 60), st.integers(0, 20))
def test_spans_cover_any_text(text, limit, overlap):
    check_spans(text, limit, min(overlap, limit // 3))


def test_cut_is_the_strongest_of_its_window_rightmost_of_equals():
    rng = random.Random(2)
    for _ in range(50):
        text = "".join(rng.choice("字词ab ，。\n") for _ in range(300))
        s = splitting.strengths(text)
        for a, b in check_spans(text, 50, 10)[:-1]:
            window = s[max(a + 25, a + 1) : a + 51]
            if window.max() > splitting.ANY:
                assert s[b] >= window[max(0, len(window) - (a + 51 - b)) :].max()


def test_range_max_equals_brute_force():
    v = np.random.default_rng(0).integers(0, 9, 200)
    t = splitting.RangeMax(v, 64)
    for low in range(0, 150, 7):
        for width in (1, 2, 3, 17, 50):
            part = v[low : low + width]
            best = part.max()
            assert t.best(low, low + width - 1) == (best, low + int(np.flatnonzero(part == best)[-1]))


def test_split_table(spark):
    df = spark.createDataFrame([(1, "s", "句子。" * 1000), (2, None, "短"), (3, "s", None), (4, "s", ""), (1, "s", "句子。" * 1000), (5, "s", "x" * 2001)], "ord long, section string, text string")
    got = splitting.split(df, "text").collect()
    assert {r["ord"] for r in got} == {1, 5} and all(len(r["piece"]) <= 2000 for r in got)
    assert [r["piece_end"] for r in got if r["ord"] == 5] == [2000, 2001]
    assert splitting.split(df, "text", whole=True).where("piece_no = 1").count() == 6
    assert splitting.split(df.limit(0), "text").count() == 0
    with pytest.raises(ValueError):
        splitting.split(df.withColumn("piece", F.lit(1)), "text")


# 2: markup

CASES = [
    ("<b>字</b>", {"html"}), ("a&nbsp;b", {"html"}), ("x<!-- rev 8 -->", {"html"}), ("条件 p<q 与 q>r 可以同时成立", set()), ("泛型 Map<K, V> 与 List<T> 等价", set()), ("**词**汇", {"markdown"}), ("表达式 3 * 4 * 5 由", set()),
    ("`x`", {"markdown"}), ("参数 max_open_a 与 min_b_size", set()), ("[the](https://kb.example/p/2)", {"markdown"}), ("[[词|语]]", {"wiki"}), ("矩阵 [[1, 2], [3, 4]] 描述", set()), ("文献[1]与[2]", set()), ("'''粗'''体", {"wiki"}), ("It isn't", set()),
    ("{{来源|x}}", {"wiki"}), ("占位符 { id } 会", set()), ("\\emph{词}语", {"latex"}), ("记作 $k=8$。", {"latex"}), ("费用是 $5 起，另加 $8 的费", set()), ("产物放在 D:\\Temp\\term 下", set()), ("缺陷 #27 记录", set()), ("R&D 组", set()), ("若 x == y 成立", set()),
    ("```\n<div>\\frac{a}{b}</div>\n```", {"markdown"}), ("`<b>`", {"markdown"}), ("== 题 ==", {"wiki"}), ("- 甲\n- 乙", {"markdown"}), ("", set()), ("\\begin{equation}\nE_{1} = \\sum_i w_i\n\\end{equation}", {"latex"}),
]


def test_families():
    trees = markup.parse([t for t, _ in CASES], markup.model())
    assert [(t, markup.families(roots)) for (t, _), roots in zip(CASES, trees)] == CASES


def test_elements_hold_what_is_between_their_tags():
    roots, _ = markup.read("<div><p><b>x</b> y</p></div>")
    assert len(roots) == 1 and [(n.kind, n.depth) for n in markup.walk(roots) if n.kind == "element"] == [("element", 0), ("element", 1), ("element", 2)]
    for tree in markup.parse(["<div><p><b>x</b> y</p></div>", "a<b 与 c>d </b> x", "Map<K, V> 与 </K>"], markup.model()):
        for n in markup.walk(tree):
            assert all(c.markup == n.markup for c in markup._own(n))


def test_what_is_no_markup_is_not_in_the_way():
    long = '<img src="data:image/png;base64,' + "iVBORw0KGgo" * 60 + '" alt="x">'
    trees = markup.parse(["费用 $5 与 **粗体 $8** 字", f"图 {long} 示"], markup.model())
    assert [markup.families(t) for t in trees] == [{"markdown"}, {"html"}]


def test_held_out_accuracy():
    rng, right, n = random.Random(1234), 0, 0
    for _ in range(200):
        text, marked = markup.teach(rng)
        roots = markup.parse([text], markup.model())[0]
        code = [(x.low, x.high) for x in markup.walk(roots) if x.kind in markup.VERBATIM or x.raw]
        for x in markup.walk(roots):
            if not x.raw and not any(a <= x.start and x.end <= b for a, b in code):
                n += 1
                right += x.markup == any(s <= x.start + (x.start < s and text[x.start].isspace()) and x.end <= e + 1 for s, e, _ in marked)
    assert n > 500 and right / n > 0.97


def test_nothing_inside_code_is_markup():
    for roots in markup.parse(["`a **b** <i>c</i>`", "<pre>**x** $k=1$</pre>"], markup.model()):
        for x in markup.walk(roots):
            if x.kind in markup.VERBATIM and x.markup or x.raw:
                assert not any(c.markup for c in markup.walk(x.children))


def test_clean_text():
    texts = ["<h3>题</h3>", "**粗** 与 [链](https://a.b/c)", "{{来源|书}}", "$k=1$ 与 \\emph{词}", "条件 p<q 与 q>r", "| a | b |\n| --- | --- |\n| c | d |", "a&lt;b"]
    got = [markup.cleaned(t, r).strip() for t, r in zip(texts, markup.parse(texts, markup.model()))]
    assert got == ["### 题", "粗 与 链", "(来源: 书)", "$k=1$ 与 词", "条件 p<q 与 q>r", "a | b\n\nc | d", "a<b"]


def test_markup_table(spark):
    df = spark.createDataFrame([(1, "[来源] a | **b**\n\n## t\n\n<b>x</b>", True), (2, None, False), (3, "", True), (4, "**x**", False), (4, "**x**", False)], "ord long, text string, framed boolean")
    assert sorted(tuple(r) for r in markup.found(df, ["ord"], "text", "framed").collect()) == [(1, "html"), (4, "markdown"), (4, "markdown")]
    assert {r["ord"]: r["text"] for r in markup.clean(df, ["ord"], "text", "framed").collect()} == {1: "[来源] a | **b**\n\n## t\n\nx", 2: None, 3: "", 4: "x"}


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    m = boosting.Boosted().fit(x[:600], y[:600])
    assert ((m.log_odds(x[600:]) > 0) == y[600:]).mean() > 0.9


# 3 and 5: questions


def some_questions(rng, n, first=0):
    word = lambda k: "".join(rng.choice("索引锁日志缓存节点副本分区查询协议线程页块流树") for _ in range(k))
    rows = []
    for i in range(n):
        kind = rng.choice(["SINGLE", "MULTI", "JUDGE"])
        options = [("A", "正确"), ("B", "错误")] if kind == "JUDGE" else [(x, word(rng.randint(6, 12))) for x in "ABCD"]
        rows.append([first + i, kind, "，".join(word(rng.randint(8, 14)) for _ in range(4)) + "？", options, f"f{first + i}"])
    return rows


def edited(rng, row, ord):
    stem = list(row[2])
    for _ in range(rng.randint(0, 3)):
        stem[rng.randrange(len(stem))] = rng.choice("甲乙丙丁")
    options = list(row[3])
    rng.shuffle(options)
    return [ord, row[1], "".join(stem) if rng.random() < 0.7 else "，".join(reversed("".join(stem).split("，"))), options, f"f{ord}"]


def grams(row):
    return bigrams(canonical(p) for p in ([row[2] or ""] + ([] if row[1] == "JUDGE" else [(o or ("", ""))[1] or "" for o in row[3] or ()])))


def brute(a, b):
    g, h = {r[0]: grams(r) for r in a}, {r[0]: grams(r) for r in b}
    return {(x[0], y[0]) for x in a for y in b if x[1] == y[1] and alike(g[x[0]], h[y[0]], 0.7)}


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(8)
    rows = some_questions(rng, 150)
    rows += [edited(rng, rng.choice(rows[:150]), 150 + i) for i in range(80)]
    rows += [[300 + i, *rows[0][1:]] for i in range(70)]  # more copies than a hot column
    rows += [[400, "SINGLE", None, None, None], [401, "JUDGE", "", [], None], [402, None, "无类型的题目一二三四五六七八九十", None, None], [403, None, "无类型的题目一二三四五六七八九十", None, None]]
    df = spark.createDataFrame(rows, QUESTIONS).withColumn("cls", F.lit("clash"))
    got = Counter((r["ord_a"], r["ord_b"]) for r in nearpairs.found(df).collect())
    want = {(a, b) for a, b in brute(rows, rows) if a < b}
    assert set(got) == want and max(got.values()) == 1 and (402, 403) in want
    assert nearpairs.found(df.limit(0)).count() == 0


def test_hot_columns_lose_nothing(spark):
    rng = random.Random(9)
    shared = "其目的在于保护所有的索引页面和日志缓存"
    rows = some_questions(rng, 200)
    for r in rows:
        r[2] += shared
    rows += [edited(rng, rng.choice(rows[:200]), 200 + i) for i in range(60)]
    got = {tuple(r) for r in nearpairs.found(spark.createDataFrame(rows, QUESTIONS)).collect()}
    assert got == {(a, b) for a, b in brute(rows, rows) if a < b}


def test_near_pairs_of_short_parts_and_spread_edits(spark):
    stem = "whichofthefollowingstatementsaboutindexpagesistrueforalllocks"
    spread = stem[:15] + "q" + stem[16:30] + "q" + stem[31:45] + "q" + stem[46:]
    options = [(c, c * 2 + "option word") for c in "ABCD"]
    short = [(c, f"{w} twelve") for c, w in zip("ABCD", ("alpha", "gamma", "delta", "omega"))]
    rows = [[1, "JUDGE", stem, None, None], [2, "JUDGE", spread, None, None]]
    rows += [[3, "SINGLE", "选出关于缓存的说法", options, None], [4, "SINGLE", "以下哪项正确描述它", options, None]]
    rows += [[5, "MULTI", "twelvechars1", short, None], [6, "MULTI", "twelvecharz1", short[:3] + [("D", "omega twelwe")], None]]
    rows += [[7, "SINGLE", "何锁", [("A", "a1")], None], [8, "SINGLE", "何锁", [("A", "a1"), ("B", "x")], None]]
    want = {(a, b) for a, b in brute(rows, rows) if a < b}
    assert {(1, 2), (3, 4), (5, 6), (7, 8)} <= want
    rng = random.Random(12)
    rows += some_questions(rng, 60, 100)
    rows += [edited(rng, rng.choice(rows[8:68]), 300 + i) for i in range(60)]
    want = {(a, b) for a, b in brute(rows, rows) if a < b}
    df = spark.createDataFrame(rows, QUESTIONS)
    assert {tuple(r) for r in nearpairs.found(df).collect()} == want
    # columns met in squares, pairs in small tiles
    prepared = questions.prepare(df)
    often = questions.JOIN.frequencies(prepared)
    for limit in (20, 1 << 18):
        join = Overlap(0.7, limit=limit)
        pairs = join.near(join.within(join.postings(prepared, often, 5), 5), prepared, prepared)
        names = {r["ord"]: r["cls"] for r in prepared.collect()}
        assert {tuple(sorted((names[a], names[b]))) for a, b in want if names[a] != names[b]} <= {tuple(r) for r in pairs.collect()}


def test_groups_of_tokens_lose_nothing_and_take_less_room(spark):
    """A pair is met in one group or the other, also where a long text shares all its rare sequences with others."""
    rng = random.Random(14)
    rows = [[i, "JUDGE", "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(180)), None, None] for i in range(120)]
    for i in range(120):  # of 180 letters 40 are changed, on end or spread
        text, at = list(rows[i][2]), range(20, 60) if i % 2 else rng.sample(range(180), 22)
        for k in at:
            text[k] = rng.choice("abcdefghijklmnopqrstuvwxyz")
        rows.append([200 + i, "JUDGE", "".join(text), None, None])
    want = {(a, b) for a, b in brute(rows, rows) if a < b}
    assert len(want) > 60
    df = spark.createDataFrame(rows, QUESTIONS)
    assert {tuple(r) for r in nearpairs.found(df).collect()} == want
    prepared = questions.prepare(df)
    often = questions.JOIN.frequencies(prepared)
    room = [sum(len(r["blob"]) for r in j.postings(prepared, often, 12).collect()) for j in (Overlap(0.7), questions.JOIN)]
    assert questions.JOIN.groups > 1 and room[1] < 0.8 * room[0]
    for limit in (20, 1 << 18):
        join = Overlap(0.7, limit=limit, groups=3)
        pairs = join.near(join.within(join.postings(prepared, often, 5), 5), prepared, prepared)
        names = {r["ord"]: r["cls"] for r in prepared.collect()}
        assert {tuple(sorted((names[a], names[b]))) for a, b in want} <= {tuple(r) for r in pairs.collect()}


def test_texts_are_sorted_out_before_they_are_shuffled(spark, monkeypatch):
    texts = spark.createDataFrame([(k * 0x9E3779B97F4A7C15 % (1 << 63), f"t{k}") for k in range(3000)] * 2, "cls long, body string")
    wanted = texts.where("body in ('t5', 't17', 't2999')").select("cls").distinct()
    for marks in (1 << 26, 2):  # with two bits nothing is sorted out
        monkeypatch.setattr(questions, "MARKS", marks)
        assert sorted(r["body"] for r in questions.fetched(texts, wanted).collect()) == ["t17", "t2999", "t5"]
    assert questions.fetched(texts, wanted.limit(0)).count() == 0


def test_history_equals_brute_force(spark):
    rng = random.Random(10)
    old = some_questions(rng, 150)
    old += [[500 + i, *old[1][1:4], f"g{i}"] for i in range(30)]
    new = [edited(rng, rng.choice(old[:150]), 1000 + i) for i in range(80)] + some_questions(rng, 40, 2000)
    new += [[3000, *old[1][1:4], None], [3001, "SINGLE", None, None, old[2][4]]]
    index = Index.of(spark.createDataFrame(old, QUESTIONS))
    got = [tuple(r) for r in index.lookup(spark.createDataFrame(new, QUESTIONS)).collect()]
    prints = {(o[0], n[0]) for o in old for n in new if o[4] is not None and o[4] == n[4]}
    want = brute(old, new) | prints
    assert len(got) == len(set(got)) and set(got) == want


def test_history_of_short_pieces_loses_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "BLOCKS", 7)
    rng = random.Random(13)
    options = [(c, o) for c, o in zip("ABCD", ("TCP", "3306", "O(n)", "8080"))]
    stem = "索引锁日志缓存节点副本分区查询协议线程页块"
    old = [[1, "SINGLE", stem, options, "x"], *some_questions(rng, 100, 100)]
    new = [[2, "SINGLE", stem[:9] + "甲" + stem[10:], options, "y"], [3, "SINGLE", stem, options, "z"]]
    new += [[4, "SINGLE", stem[:6] + "甲" + stem[7:13] + "乙" + stem[14:], options, None]]
    new += [edited(rng, rng.choice(old[1:]), 1000 + i) for i in range(60)]
    want = brute(old, new)
    assert {(1, 2), (1, 3), (1, 4)} <= want
    folder = str(tmp_path / "index")
    for name, batch in (("1", old[60:]), ("2", old[:60]), ("2", old[:60])):  # the second follows the order of the first, and is tried twice
        Index.of(spark.createDataFrame(batch, QUESTIONS)).append(folder, name)
    probe = spark.createDataFrame(new, QUESTIONS)
    prints = {(o[0], n[0]) for o in old for n in new if o[4] is not None and o[4] == n[4]}
    for index in (Index.of(spark.createDataFrame(old, QUESTIONS)), Index.read(spark, folder)):
        assert Counter(tuple(r) for r in index.lookup(probe).collect()) == Counter(want | prints)


def test_index_of_long_questions_in_groups_loses_nothing(spark, tmp_path, monkeypatch):
    rng = random.Random(15)
    letters = "abcdefghijklmnopqrstuvwxyz"
    old = [[i, "JUDGE", "".join(rng.choice(letters) for _ in range(180)), None, None] for i in range(60)]
    new = []
    for i in range(60):  # changed on end or spread, up to what the definition allows and beyond
        text, at = list(old[i][2]), range(20, 60) if i % 2 else rng.sample(range(180), 24)
        for k in at:
            text[k] = rng.choice(letters)
        new.append([200 + i, "JUDGE", "".join(text), None, None])
    want = brute(old, new)
    assert len(want) > 30
    probe = spark.createDataFrame(new, QUESTIONS)
    for blocks in (1, 7):  # one that holds both groups, and a number that they don't divide
        monkeypatch.setattr(history, "BLOCKS", blocks)
        folder = str(tmp_path / str(blocks))
        index = Index.of(spark.createDataFrame(old, QUESTIONS), blocks=blocks)
        index.append(folder, "1")
        for i in (index, Index.read(spark, folder)):
            assert Counter(tuple(r) for r in i.lookup(probe).collect()) == Counter(want)
    plain = Overlap(0.7).postings(questions.prepare(spark.createDataFrame(old, QUESTIONS)), index.often, 7, 1)
    room = [sum(len(r["blob"]) for r in t.collect()) for t in (plain, index.tables)]
    assert room[1] < 0.8 * room[0]


def test_index_is_appended_not_rebuilt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "BLOCKS", 7)
    rng = random.Random(11)
    a, b = some_questions(rng, 20), some_questions(rng, 20, 100)
    folder = str(tmp_path / "index")
    for name, batch in (("a", a), ("b", b)):
        Index.of(spark.createDataFrame(batch, QUESTIONS)).append(folder, name)
    probe = [[1, *a[3][1:4], None], [2, *b[5][1:4], None]]
    got = {tuple(r) for r in Index.read(spark, folder).lookup(spark.createDataFrame(probe, QUESTIONS)).collect()}
    assert {(a[3][0], 1), (b[5][0], 2)} <= got
    assert Index.read(spark, folder).lookup(spark.createDataFrame([], QUESTIONS)).count() == 0


# 4: look-alikes

STANDINS = {
    "Ｍｙfa": "Myfa", "a\u00a0b": "a b", "⼊口": "入口", "\uf9ca": "流", "e\u0301te": "éte", "Gricусοrе": "Gricycore", "词\u200b语": "词语", "wex\ufb01dex": "wexfidex", "5\u00ad2": "52", "１２": "12", "\U0001d400b": "Ab", "λ\u03bf\u0301γος": "λόγος",
}
MEANT = ["слой кэша", "系数 α、β 与步长 Δ", "👩\u200d💻 与 ❤\ufe0f", "“引”——‘号’", "é ü ñ", "14² ①", "全角，标点（）：", "λόγος", "𠮷野", "", "a\r\nb", "SÃO SEÇÕES", "℃ № ½"]


@pytest.fixture(scope="module")
def table(spark):
    return confusables.prototypes(spark)


def test_consistent(table):
    assert {k: confusables.consistent(k, table) for k in STANDINS} == STANDINS
    assert [confusables.consistent(m, table) for m in MEANT] == MEANT


def test_consistent_once_is_enough(table):
    for text in [*STANDINS, *MEANT]:
        once = confusables.consistent(text, table)
        assert confusables.consistent(once, table) == once


def test_skeleton_joins_what_looks_alike(table):
    assert confusables.skeleton("раураl", table) == confusables.skeleton("paypal", table) != confusables.skeleton("paypa", table)


def test_look_alike_table(spark):
    df = spark.createDataFrame([(1, "Ｍｙ"), (2, None), (3, ""), (4, "слой"), (1, "Ｍｙ")], "ord long, text string")
    assert [r["ord"] for r in confusables.clean(df, ["ord"], "text", only_changed=True).collect()] == [1, 1]
    assert confusables.clean(df, ["ord"], "text").count() == 5
    g = confusables.groups(spark.createDataFrame([("paypal раураl",)], "t string"), "t").first()
    assert g["n"] == 2 and len(g["forms"]) == 2


def test_look_alikes_of_slices_and_composed_signs(spark, tmp_path):
    from quarry.llm import queries

    spark.createDataFrame([(1, "paypal")], "ord long, text string").write.parquet(str(tmp_path / "tasks.parquet"))
    spark.createDataFrame([(1, "раураl")], "ord long, source_quote string").write.parquet(str(tmp_path / "clean.parquet"))
    assert [r["n"] for r in queries.p4_groups(spark, str(tmp_path)).collect()] == [2]
    df = spark.createDataFrame([(1, "か\u3099"), (2, "は\u309a"), (3, "\u2329x\u232a"), (4, "がぱ〈x〉"), (5, "字\u302e\u302a")], "ord long, text string")
    found = {r["ord"] for r in confusables.clean(df, ["ord"], "text", only_changed=True).collect()}
    assert found == {1, 2, 3, 5}


# 6: encoding


def test_encoding_and_back(spark):
    texts = ["Hello 世界 👩\u200d💻", "", None, "<|endoftext|>", "a\r\n\tb", "é" * 50, "字" * 3000, "\u0000\u007f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("ids", F.lit("clash"))
    rows = {r["doc_id"]: r["ids"] for r in encoding.encode(df, "doc_id", "text").collect()}
    assert rows[1] == rows[2] == [] and len(rows) == len(texts) and 50256 not in rows[3]
    back = encoding.encode(df, "doc_id", "text").select("doc_id", encoding.decode(F.col("ids")).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in back} == {i: t or "" for i, t in enumerate(texts)}
    assert encoding.encode(df.limit(0), "doc_id", "text").count() == 0


def test_offsets(spark):
    text = "Hello 世界 é"
    r = encoding.with_offsets(spark.createDataFrame([(1, text), (2, None)], "k int, text string"), "k", "text").where("k = 1").first()
    assert len(r["ids"]) == len(r["starts"]) == len(r["ends"]) and r["ends"][-1] == len(text)
    covered = set()
    for a, b in zip(r["starts"], r["ends"]):
        covered |= set(range(a, b))
    assert covered == set(range(len(text)))


def test_split_characters(spark):
    ids = encoding.encode(spark.createDataFrame([(1, "界")], "k int, text string"), "k", "text").first()["ids"]
    df = spark.createDataFrame([(ids[:1],), (ids,), ([10**9],), (None,)], "ids array<int>")
    got = [r[0] for r in df.select(encoding.decode(F.col("ids"))).collect()]
    assert got[0] == "\ufffd" and got[1:] == ["界", "", None]


def test_agrees_with_another_library(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(encoding.tokenizer_file("byte_bpe_50k.tiktoken"), "rb"))}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["It isn't 5 < 6,  或 索引页。", "naïve\n\n  x"]
    rows = encoding.encode(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t").orderBy("k").collect()
    assert [r["ids"] for r in rows] == [other.encode_ordinary(t) for t in texts]


# 7: leakage


@pytest.mark.parametrize("seed", range(4))
def test_fm_index_equals_brute_force(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("abcd字") for _ in range(700)) + "\0" + "abab" * 40 + "\0"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    index = leakage.FMIndex(codes, 6)
    words = [text[i : i + 6] for i in range(0, 690, 23)] + ["bababa", "zzzzzz", "字字字字字字"]
    low, high = index.ranges(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, 6))
    phrase, place = index.locate(low, high)
    for k, w in enumerate(words):
        assert sorted(place[phrase == k]) == [i for i in range(len(text)) if text.startswith(w, i)]


def test_leaks(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("索引锁日志缓存节点副本分区查询协议线程页块流树") for _ in range(rng.randint(3, 5)))
    items = [(i, "，".join(word() for _ in range(20)) + "。") for i in range(6)] + [(6, None), (7, "短"), (8, "Ünïque passage about zebras, quaggas and the okapi of the Ituri forest in 1901.")]
    text = dict(items)
    noise = lambda: "".join(word() for _ in range(60))
    docs = [
        (1, noise() + text[0] + noise()), (2, noise()), (3, None), (4, ""), (5, text[1][: len(text[1]) * 6 // 10] + noise()), (6, text[2][: len(text[2]) // 4] + noise()),
        (7, noise() + text[3].replace("，", ", ") + "**x**" + text[4]), (8, "X" + text[8].upper().replace("A", "А") + "y"), (9, text[5][:30] + "改" + text[5][31:]), (1, noise() + text[0]),
    ]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = leakage.leaks(d.withColumn("item_id", F.lit(0)), i).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(1, 0), (5, 1), (7, 3), (7, 4), (8, 8), (9, 5)}
    spot = next(r for r in rows if r["doc_id"] == 5)
    assert spot["start"] == 0 and abs(spot["end"] - len(text[1]) * 6 // 10) < 6
    assert leakage.leaks(d, i.limit(0)).count() == 0 and leakage.leaks(d.limit(0), i).count() == 0


def test_long_documents_are_cut_with_an_overlap(monkeypatch):
    monkeypatch.setattr(leakage, "SHARD", 500)
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(2600))
    parts = [p for run in leakage._shards([text, "", "short"], 100) for p in run]
    assert all(text[s : s + len(t)] == t for _, s, t in parts) and {p[0] for p in parts} == {0}
    for at in range(0, 2500, 50):
        assert any(s <= at and at + 100 <= s + len(t) for _, s, t in parts)


# 8: encodings

CORPUS = ["增量索引页的写入顺序由双向冲突流决定，而不是由稠密批注层决定。", "La tâche a été répétée, mais n’a pas validé l’état « prêt ».", "für größere Schlüssel überträgt", "“naïve” café – déjà vu…", "слой кэша хранит журнал", "鋆、锟铻、璟琤 等字", "Âge 22, ¿listo? ± ½ §7"]


@pytest.fixture(scope="module")
def forms():
    count = Counter(c for t in CORPUS for c in set(t) if c > "\x7f")
    return mojibake.Table({c: 600 for c in count} | {c: 4 for c in "鋆锟铻璟琤"}, 1000)


CHAINS = [("utf-8", "cp1251"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("utf-8", "cp850"), ("utf-8", "latin-1"), ("gbk", "latin-1")]


def garble(text, right, wrong):
    return text.encode(right).decode(wrong)


def sloppy(text):
    return "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())


@pytest.mark.parametrize("right,wrong", CHAINS)
def test_chains_round_trip(forms, right, wrong):
    for text in CORPUS[:1] if right == "gbk" else CORPUS[1:2] if wrong == "cp1251" else CORPUS[:2]:
        bad = garble(text, right, wrong)
        got, n, _ = forms.restore(bad)
        assert n > 3 and sum(a == b for a, b in zip(got, text)) > 0.9 * len(text)


def test_once_and_twice(forms):
    for text in CORPUS[:4]:
        assert forms.restore(sloppy(text))[0] == text
        assert forms.restore(sloppy(sloppy(text)))[0] == text
    assert forms.restore("前文。" + sloppy("café") + " 后文")[0] == "前文。café 后文"


def test_two_byte_readings(forms):
    bad = CORPUS[0].encode().decode("gbk", "replace")
    got, n, lost = forms.restore(bad)
    assert n > 15 and "索引" in got
    as_big5 = CORPUS[0].encode("gbk").decode("cp950", "replace")
    assert forms.restore(as_big5)[1] > 8
    assert forms.restore("d茅j脿 与 caf茅")[0] == "déjà 与 café"


def test_clean_text_is_left_alone(forms):
    for text in CORPUS:
        assert forms.restore(text) == (text, 0, False)


def test_lost_characters(forms):
    assert forms.restore("d\ufffdlai")[2] and forms.restore("锟斤拷锟斤拷")[2] and not forms.restore("“\ufffd”")[2]


def test_garbled_table(spark):
    rows = [(i, t) for i, t in enumerate(CORPUS * 4)] + [(100, sloppy(CORPUS[0])), (101, None), (102, ""), (103, "plain"), (104, "d\ufffdlai l’\ufffdtat")]
    rows += [(200 + i, "le délai")for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("k", F.lit(1))
    got = {r["doc_id"]: r for r in mojibake.restored(df, "doc_id", "text").collect()}
    assert set(got) == {100, 104} and got[100]["text"] == CORPUS[0] and got[104]["lost"]
    words = {(r["word"], r["original"]) for r in mojibake.lossy_words(df, "doc_id", "text").collect()}
    assert ("d\ufffdlai", "délai") in words
    assert mojibake.restored(df.limit(0), "doc_id", "text").count() == 0

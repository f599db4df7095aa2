import difflib
import random
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.contract import LABELS, Options
from quarry.functions.text import norm
from quarry.operators import folds, merge, ratios, reports, similarity, validate

SCHEMA = "ord long, type string, stem string, options array<struct<label:string,content:string>>, answer array<string>, analysis string, difficulty string, score int, category string, tags array<string>, source_quote string, _task_id string, _source_file string, _source_section string, _fingerprint string, _freq string, _judge_remap map<string,string>, _added_at string, _updated_at string, _locked boolean"
FOUR = [("A", "甲项"), ("B", "乙项"), ("C", "丙项"), ("D", "丁项")]


def question(ord=1, **changes):
    row = dict(ord=ord, type="SINGLE", stem=f"题干{ord}", options=FOUR, answer=["A"], analysis="解析", difficulty="EASY", score=1, category="类", tags=["锁", "高频"], source_quote="引文", _task_id="t", _source_file="f.md", _source_section="s", _fingerprint=f"fp{ord}", _freq="高频", _judge_remap=None, _added_at="d", _updated_at=None, _locked=None)
    return tuple((row | changes).values())


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture(scope="module")
def tasks(spark):
    return spark.createDataFrame([(1, "t", "f.md", "s", "旧"), (2, "t", "f.md", "s", "有<b>引</b>文"), (3, "u", "g.md", "s", "无")], "ord long, id string, rel string, section string, text string")


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([("f.md", "x"), ("g.md", "别处的 引文"), ("g.md", None)], "rel string, text string")


RULES = [
    (dict(), "ok", []), (dict(type="x"), "fail", ["type"]), (dict(stem=" "), "fail", ["stem_empty"]), (dict(options=None), "fail", ["options_missing", "option_count", "answer_undeclared"]),
    (dict(options=[("Z", "甲项"), ("B", "乙项"), ("A", "丙项")]), "fail", ["label"]), (dict(options=[("A", "甲项"), ("A", "乙项"), ("B", "丙项")]), "fail", ["label_repeated"]),
    (dict(options=[("A", ""), ("B", "乙项"), ("C", "丙项")]), "fail", ["option_empty"]), (dict(stem="甲项"), "fail", ["option_is_stem"]), (dict(options=[("A", "甲项"), ("B", "甲 项"), ("C", "丙项")]), "fail", ["options_repeated"]),
    (dict(answer=[]), "fail", ["answer"]), (dict(answer=["E"]), "fail", ["answer_undeclared"]), (dict(answer=["A", "B"]), "fail", ["answer_not_one"]), (dict(type="MULTI"), "fail", ["answer_too_few"]),
    (dict(type="MULTI", answer=["A", "B", "C", "D"]), "fail", ["answer_all"]), (dict(score=101), "fail", ["score"]), (dict(tags=["锁"]), "fail", ["frequency_missing"]), (dict(tags=["高频", "中频"]), "fail", ["frequency_many"]),
    (dict(tags=[str(i) for i in range(10)] + ["高频"]), "fail", ["tags_many"]), (dict(source_quote=None), "fail", ["quote_missing"]), (dict(source_quote="引文" * 101), "fail", ["quote_long", "quote_not_found"]),
    (dict(source_quote="没有"), "fail", ["quote_not_found"]), (dict(_task_id="gone"), "fail", ["quote_not_found"]),
    (dict(_task_id="u"), "warn", ["quote_elsewhere"]), (dict(stem="长" * 501), "warn", ["stem_long"]), (dict(options=[("A", "0"), ("B", "乙项"), ("C", "丙项")]), "warn", ["option_short"]), (dict(options=[*FOUR[:3], ("D", "以上都对")]), "warn", ["option_all"]),
    (dict(type="JUDGE", options=FOUR[:2]), "warn", ["judge_wording"]), (dict(options=FOUR[:2]), "warn", ["options_few"]), (dict(difficulty=None), "warn", ["difficulty_missing"]), (dict(difficulty="难"), "warn", ["difficulty_renamed"]),
    (dict(category=None), "warn", ["category_missing"]), (dict(tags=[*"abcdef", "高频"]), "warn", ["content_tags_many"]), (dict(analysis=None), "warn", ["analysis_missing"]),
]


def test_each_rule(spark, tasks, files):
    rows = [question(i, **{"stem": f"题干{i}"} | change) for i, (change, _, _) in enumerate(RULES)]
    got = {r["ord"]: r for r in validate.validate(table(spark, *rows), tasks, files, Options(max_per_section=99)).collect()}
    for i, (change, status, messages) in enumerate(RULES):
        r = got[i]
        assert (r["status"], r["errors"] if status == "fail" else r["warnings"]) == (status, messages), (change, r["errors"], r["warnings"])


def test_judge_is_turned(spark, tasks, files):
    r = validate.validate(table(spark, question(1, type="判断", options=[("A", "错"), ("B", "对")], answer=["B"])), tasks, files).first()
    assert [tuple(o) for o in r["options"]] == [("A", "正确"), ("B", "错误")] and r["answer"] == ["A"] and r["_judge_remap"] == {"A": "B", "B": "A"}


def test_repeats_and_crowds(spark, tasks, files):
    rows = [question(1, stem="同", answer=[]), question(2, stem="同"), question(3, stem="异"), *(question(i) for i in range(10, 16))]
    got = {r["ord"]: (r["status"], r["errors"], r["warnings"]) for r in validate.validate(table(spark, *rows), tasks, files).collect()}
    assert got[2] == ("fail", ["repeated"], []) and got[3] == ("warn", [], ["section_over"])


def test_empty_tables(spark, tasks, files):
    none = table(spark, question(1)).limit(0)
    assert validate.validate(none, tasks, files).count() == 0 and similarity.near_duplicates(none).count() == 0
    assert merge.actions(none, none).count() == 0 and folds.balance_single(none).count() == 0 and reports.coverage(tasks, none).first()["hit"] == 0


def test_positions_and_skew(spark):
    rows = [question(i, answer=["A" if i < 6 else "B"]) for i in range(10)]
    assert validate.skew(table(spark, *rows)).first()["ratio"] == 0.6
    assert validate.skew(table(spark, *rows[:9])).first() is None
    assert validate.high_alarm(table(spark, *rows)).first()["alarm"] is False


def brute_near(rows, least):
    out = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if a[1] == b[1] and a[2] and b[2] and difflib.SequenceMatcher(None, a[2], b[2]).ratio() >= least:
                out.add((a[0], b[0]))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("索引锁日志缓存节点副本分区查询") for _ in range(rng.randint(18, 30))) for _ in range(60)]
    rows = [[i, rng.choice(["SINGLE", "MULTI"]), s] for i, s in enumerate(stems)]
    for i in range(60, 110):
        old = rng.choice(rows[:60])
        s = list(old[2])
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("甲乙丙丁")
        rows.append([i, old[1], "".join(s)])
    rows += [[110, "SINGLE", ""], [111, "SINGLE", ""]]
    df = spark.createDataFrame(rows, "ord long, type string, stem string")
    got = {(r["ord_a"], r["ord_b"]) for r in similarity.near_duplicates(df).collect()}
    want = brute_near(rows, 0.85)
    assert want and got == want


def brute_merge(new, old, least=0.75):
    """One after another, as the rules say."""
    n = lambda s: "".join(s.split()).lower()
    by_fp = {o["_fingerprint"]: o for o in old if o["_fingerprint"]}
    taken, out = set(), {}
    for q in new:
        o = by_fp.get(q["_fingerprint"])
        if o:
            same = all(q[c] == o[c] for c in ("options", "answer", "analysis", "difficulty", "score", "category")) and sorted(q["tags"]) == sorted(o["tags"])
            out[q["ord"]] = "existing" if same else "locked" if o["_locked"] else "updated"
            if not same:
                taken.add(o["ord"])
            continue
        best, top = None, 0.0
        for o in old:
            if o["ord"] in taken or o["type"] != q["type"]:
                continue
            a, b = ({n(x[1]) for x in z["options"]} for z in (q, o))
            s = 0.5 * difflib.SequenceMatcher(None, n(q["stem"]), n(o["stem"])).ratio() + 0.5 * len(a & b) / len(a | b)
            if s > top:
                best, top = o, s
        if best and top >= least:
            taken.add(best["ord"])
            by_fp.pop(best["_fingerprint"], None)
            out[q["ord"]] = "locked" if best["_locked"] else "updated"
        else:
            out[q["ord"]] = "new"
    return out


def test_merge_equals_brute_force(spark):
    rng = random.Random(5)
    names = SCHEMA.split(", ")
    keys = [x.split(" ")[0] for x in names]
    word = lambda k: "".join(rng.choice("索引锁日志缓存节点") for _ in range(k))
    old = [question(i, stem=word(20), options=[(label, word(6)) for label in "ABCD"], _fingerprint=f"f{i}", _locked=rng.random() < 0.2) for i in range(30)]
    new = []
    for i in range(100, 140):
        base = dict(zip(keys, rng.choice(old)))
        r = rng.random()
        if r < 0.2:
            new.append(question(i, stem=base["stem"], options=base["options"], _fingerprint=base["_fingerprint"]))
        elif r < 0.4:
            new.append(question(i, stem=base["stem"], options=base["options"], answer=["B"], _fingerprint=base["_fingerprint"]))
        elif r < 0.8:
            stem = list(base["stem"])
            for _ in range(rng.randint(1, 6)):
                stem[rng.randrange(20)] = "改"
            options = [*base["options"]]
            if rng.random() < 0.4:
                options[0] = ("A", word(6))
            new.append(question(i, stem="".join(stem), options=options, _fingerprint=f"n{i}"))
        else:
            new.append(question(i, stem=word(20), options=[(label, word(6)) for label in "ABCD"], _fingerprint=f"n{i}"))
    got = {r["ord"]: r["action"] for r in merge.actions(table(spark, *new), table(spark, *old)).collect()}
    want = brute_merge([dict(zip(keys, q)) for q in new], [dict(zip(keys, q)) for q in old])
    assert got == want and len(set(want.values())) == 4


def test_fuzzy_edges_of_judge_equal_brute_force(spark):
    rng = random.Random(7)
    two = [("A", "正确"), ("B", "错误")]
    word = lambda k: "".join(rng.choice("甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉") for _ in range(k))
    before, after = "在默认的配置之下，", "总会先于其它写入落盘"
    terms = [word(11) for _ in range(12)]
    old = [question(i, type="JUDGE", stem=before + terms[i] + after, options=two) for i in range(8)]
    old += [question(20 + i, type="JUDGE", stem=terms[8 + i] + "是另一题里才会出现的说法吗", options=two) for i in range(4)]
    old += [question(30, type="JUDGE", stem="一x二x三x四x五x六x七x八x", options=two), question(31, type="JUDGE", stem=None, options=two)]
    new = [question(100 + i, type="JUDGE", stem=before + terms[8 + i] + after, options=two) for i in range(4)]
    new += [question(110, type="JUDGE", stem="一y二y三y四y五y六y七y八y", options=two), question(111, type="JUDGE", stem=word(30), options=two)]
    got = {(r["ord"], r["bank_ord"]): r["score"] for r in similarity.fuzzy_edges(table(spark, *new), table(spark, *old)).collect()}
    n = lambda s: "".join((s or "").split()).lower()
    scores = {(q[0], o[0]): 0.5 * difflib.SequenceMatcher(None, n(q[2]), n(o[2])).ratio() + 0.5 for q in new for o in old}
    assert got == {k: v for k, v in scores.items() if v >= 0.75}
    assert {(100, 0), (110, 30)} <= set(got)


def test_second_merge_changes_nothing(spark):
    old, new = table(spark, question(1), question(2, _locked=True)), table(spark, question(11, _fingerprint="n", stem="全新的题", options=[("A", "p1"), ("B", "p2")]))
    acted = merge.actions(new, old)
    bank = merge.merged(new, old, acted, merge.leftovers(old, acted), "now")
    again = merge.actions(new, bank)
    assert [r["action"] for r in again.collect()] == ["existing"] and bank.count() == 3


def test_prune_spares_locked_and_matched(spark, tasks):
    old = table(spark, question(1, _source_file="gone.md"), question(2, _source_file="gone.md", _locked=True), question(3, _task_id="gone"), question(4))
    new = table(spark, question(3, _task_id="t"))
    rels = spark.createDataFrame([("f.md",)], "rel string")
    got = {r["ord"]: r["fate"] for r in merge.leftovers(old, merge.by_fingerprint(new, old), rels, tasks).collect()}
    assert got == {1: "pruned", 2: "kept", 3: "kept", 4: "kept"}
    hard = merge.leftovers(old, merge.by_fingerprint(new, old), rels, tasks, Options(prune_locked=True, prune_matched=True))
    assert {r["ord"] for r in hard.where("fate = 'pruned'").collect()} == {1, 2, 3}


def test_single_balance(spark):
    rows = [question(i) for i in range(22)] + [question(90, options=[("A", "1. 一"), ("B", "2. 二")]), question(91, type="JUDGE"), question(92, answer=["F"])]
    got = {r["ord"]: r for r in folds.balance_single(table(spark, *rows)).collect()}
    assert set(got) == set(range(22))
    counts = Counter(r["answer"][0] for r in got.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    for r in got.values():
        right = {o["label"]: o["content"] for o in r["options"]}[r["answer"][0]]
        assert right == "甲项" and sorted(o["content"] for o in r["options"]) == sorted(c for _, c in FOUR)


def test_multi_balance(spark):
    rows = [question(i, type="MULTI", answer=["A", "B"]) for i in range(18)]
    for exact in (False, True):
        got = folds.balance_multi(table(spark, *rows), exact).collect()
        for r in got:
            assert {o["content"] for o in r["options"] if o["label"] in r["answer"]} == {"甲项", "乙项"}
        if not exact:
            assert set(Counter("".join(r["answer"]) for r in got).values()) == {3}
    assert folds.balance_multi(table(spark, *rows), True).orderBy("ord").collect() == folds.balance_multi(table(spark, *rows), True).orderBy("ord").collect()


def test_batches(spark):
    t = spark.createDataFrame([(i, "x" * n) for i, n in enumerate([5, 5, 5, 50, 5, 5])] + [(9, None)], "ord long, text string")
    got = [r["batch_no"] for r in folds.batches(t, Options(batches=3)).orderBy("ord").collect()]
    assert got == sorted(got) and max(got) <= 3 and got[3] != got[0]
    assert folds.batches(t.limit(0)).count() == 0
    assert [r["batch_no"] for r in folds.batches(t.limit(2), Options(batches=9)).orderBy("ord").collect()] == [1, 2]


def test_reports(spark, tasks):
    bank = table(spark, question(1), question(2, category="a/b"), question(3, category="a:b", _task_id="u"))
    assert {(r["category"], r["file"]) for r in reports.category_files(bank).collect()} == {("类", "类.json"), ("a/b", "a_b.json"), ("a:b", "a_b-2.json")}
    assert reports.coverage(tasks, bank).first()["ratio"] == 1.0
    assert {tuple(r) for r in reports.distributions(bank).where("facet = 'type'").collect()} == {("type", "SINGLE", 3)}
    assert reports.preview(bank, frequency="低频").count() == 0


def test_sinks(spark, tasks, tmp_path):
    import json

    from quarry.sources import sinks

    bank = table(spark, question(1, category="<script>", stem="</script>"), question(2))
    page = sinks.preview_page(reports.contract(bank))
    assert "</script>\"" not in page.split("application/json")[1].split("</script>")[0] and "\\u003c/script>" in page
    assert "# 题库复核" in sinks.review(bank, tasks)
    sinks.write_json(reports.contract(bank), str(tmp_path / "all.json"))
    assert len(json.load(open(tmp_path / "all.json", encoding="utf-8"))) == 2
    sinks.write_bank(bank, str(tmp_path / "bank"))
    sinks.write_category_json(bank, str(tmp_path / "by"))
    assert spark.read.parquet(str(tmp_path / "bank")).count() == 2
    sinks.write_batches(tasks, folds.batches(tasks), str(tmp_path / "batches"))
    assert spark.read.json(str(tmp_path / "batches")).count() == 3


def test_sources(spark, tmp_path):
    import json

    from quarry.sources import markdown, pieces

    for name, text in {"a/x.md": "# 一", "a/tags.md": "- t", "json/r.md": "no", "b/.h.md": "no", "b/y z.md": "二"}.items():
        p = tmp_path / "kb" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text, encoding="utf-8")
    got = {(r["rel"], r["raw"], r["file_ord"]) for r in markdown.ordered(markdown.scan(spark, str(tmp_path / "kb"))).collect()}
    assert got == {("a/x.md", "# 一", 1), ("b/y z.md", "二", 2)}
    v = markdown.vocabulary(spark.createDataFrame([("# h\n- 锁\n* Redis\nredis\n> q\n| t |\n" + "长" * 25,)], "text string"))
    assert [r["tag"] for r in v.orderBy("ord").collect()] == ["锁", "Redis"]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "t1.json").write_text(json.dumps({"task_id": "", "questions": [{"type": "single", "answer": "A,C", "tags": "锁，高频", "score": 2.7, "options": [{"label": "A", "content": "x"}]}, {"answer": ["a"], "score": "2"}]}), encoding="utf-8")
    rows = pieces.read(spark, str(tmp_path / "p")).orderBy("ord").collect()
    assert [(r["task_id"], r["answer"], r["tags"], r["score"]) for r in rows] == [("t1", ["A", "C"], ["锁", "高频"], 2), ("t1", ["a"], [], 2)]
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        markdown.scan(spark, str(tmp_path / "none"))


def test_streams(spark, tmp_path):
    from quarry.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("## 什么是锁\n" + "字" * 60, encoding="utf-8")
    s = ingest.slice_stream(ingest.file_stream(spark, str(tmp_path / "in")))
    q = s.writeStream.format("memory").queryName("sliced").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("sliced").count() == 1
    table(spark, question(11, _fingerprint="n", stem="全新的题", options=[("A", "p1"), ("B", "p2")])).write.parquet(str(tmp_path / "new"))
    old = table(spark, question(1))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "new"))
    ingest.start(stream, ingest.upsert(lambda s, n: old, str(tmp_path / "bank"), lambda n: "now"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "bank" / "v00000000")).count() == 2


def test_normal_forms_meet(spark):
    assert spark.range(1).select(norm(F.lit("A b"))).first()[0] == "ab" and len(LABELS) == 6


def test_ratios_of_a_block_equal_difflib():
    rng = random.Random(8)
    word = lambda least, most, letters: "".join(rng.choice(letters) for _ in range(rng.randint(least, most)))
    left, right = ([word(0, 30, "abcd") for _ in range(40)] + [word(60, 140, "abcdefgh") for _ in range(20)] + [word(190, 230, "abcdefgh") for _ in range(8)] + [word(10, 25, "索引锁日𝔘") for _ in range(10)] + [""] for _ in "xy")
    right += left[:3] + left[45:48]
    for least in (0.3, 0.5, 0.7):
        got = [(int(a), int(b), float(c)) for i, j, r in ratios.alike(least, left, right) for a, b, c in zip(i, j, r)]
        want = [(i, j, r) for i, x in enumerate(left) for j, y in enumerate(right) if (r := difflib.SequenceMatcher(None, x, y).ratio()) >= least]
        assert want and sorted(got) == want


def test_fuzzy_edges_of_judge_over_blocks(spark, monkeypatch):
    """Several blocks, options that differ, copies on both sides, empty stems."""
    monkeypatch.setattr(similarity, "BLOCK", 7)
    rng = random.Random(2)
    stems = ["", *("".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 40))) for _ in range(14))]
    sides = []
    for _ in "xy":
        sides.append([question(i, type="JUDGE", stem=rng.choice(stems) if i % 3 == 0 else "".join(rng.choice("abcdef") for _ in range(rng.randint(4, 30))), options=FOUR[: rng.choice([0, 2, 2, 2, 3])]) for i in range(40)])
    sides = [[*s, question(90, type="JUDGE", stem="", options=FOUR[:2]), question(91, type=None, stem="abc")] for s in sides]

    def score(x, y):
        ox, oy = ({c for _, c in q[3]} for q in (x, y))
        return 0.5 * difflib.SequenceMatcher(None, x[2], y[2]).ratio() + 0.5 * (len(ox & oy) / len(ox | oy) if ox | oy else 0.0)

    want = {(x[0], y[0]): s for x in sides[0] for y in sides[1] if x[1] == y[1] == "JUDGE" and (s := score(x, y)) >= 0.75}
    got = [((r["ord"], r["bank_ord"]), r["score"]) for r in similarity.fuzzy_edges(*(table(spark, *s) for s in sides)).where("type = 'JUDGE'").collect()]
    assert len(want) > 30 and len(got) == len(want) and dict(got) == want


def test_judge_block_holds_little():
    """A block of stems that nearly all pass the first bounds stays small, whatever passes them."""
    rng = random.Random(4)
    rows = [[(n * 10_000 + i, "".join(rng.choice("etaoinshr") for _ in range(rng.randint(50, 90))), ["正确", "错误"]) for i in range(700)] for n in range(2)]
    tracemalloc.start()
    n = sum(b.num_rows for b in similarity._scored(0.75, 0.5, 0.0, *rows))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n and peak < 150e6


def test_merge_of_judge_is_one_group(spark, monkeypatch):
    """Many like JUDGE questions aren't labelled step by step, and one whose fingerprint is another type's is settled with them."""
    labelled = []
    components = merge._components
    monkeypatch.setattr(merge, "_components", lambda edges: components(labelled.append(edges.count()) or edges))
    two, keys = [("A", "正确"), ("B", "错误")], [x.split(" ")[0] for x in SCHEMA.split(", ")]
    old = [question(i, type="JUDGE", stem=f"第{i}个默认的配置之下总会先于其它写入落盘", options=two) for i in range(20)] + [question(30, stem="哪一个副本先于日志写入")]
    new = [question(100 + i, type="JUDGE", stem=f"第{2 * i}个默认的配置之下总会后于其它写入落盘", options=two, _fingerprint=f"n{i}") for i in range(24)]
    new += [question(90, stem="哪一个副本先于日志写入吗", _fingerprint="n90"), question(130, type="JUDGE", stem="第3个默认的配置之下", options=two, _fingerprint="fp30"), question(131, stem="别的", _fingerprint="fp5")]
    new.sort()
    got = {r["ord"]: r["action"] for r in merge.actions(table(spark, *new), table(spark, *old)).collect()}
    assert got == brute_merge([dict(zip(keys, q)) for q in new], [dict(zip(keys, q)) for q in old]) and {"new", "updated"} <= set(got.values())
    assert labelled == [3]

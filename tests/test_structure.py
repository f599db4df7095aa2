import random

from quarry.contract import Options
from quarry.operators import structure as S
from quarry.operators import slices


def test_front_matter_cases():
    scalars, lists, body = S.front_matter('---\nTitle: "x: y"\ntags: [a, "b"]\nk:\n- p\n- q\nk2: v\n- lost\nnocolon\n---\nbody')
    assert scalars == {"title": "x: y", "k2": "v"} and lists == {"tags": ["a", "b"], "k": ["p", "q"]} and body == "body"
    assert S.front_matter("---\nopen")[2] == "---\nopen"
    assert S.front_matter("---\r\na: 1\r\n---\r\nx") == ({"a": "1"}, {}, "x")


def heads(body):
    o = S.outline(body)
    return list(zip(o.level.tolist(), o.title))


def test_headings_in_fences_are_text():
    assert heads("p\n```\n# no\n```\n# yes\n~~~\n## no\n```\n## seen\n") == [(0, ""), (1, "yes"), (2, "seen")]
    assert heads("```\n# hidden for ever") == [(0, "")]
    assert heads("") == [] and heads("#\n##\n#x") == [(0, "")] and heads("#  \n## \ty \r\nz") == [(2, "y")]


def test_sections_drop_deeper_headings_but_not_their_lines():
    o = S.outline("pre\n# A\n## B\nx\n### C\ny\n\nz\n## D\n#### E\n# F")
    got = S.sections(o, 2)
    assert [(s.title, S.crumbs(s.path), S.paragraphs(o, s)) for s in got] == [("", "(开头)", ["pre"]), ("A", "A", []), ("B", "A > B", ["x\ny", "z"]), ("D", "A > D", []), ("F", "F", [])]
    assert o.lines().tolist() == [1, 0, 1, 3, 0, 0, 0]


def test_path_is_of_the_nearest_headings_above():
    o = S.outline("## B\nb\n### C\nc\n# A\n### D\nd\n## E\n")
    assert [[t for _, t in s.path] for s in S.sections(o, 3)] == [["B"], ["B", "C"], ["A"], ["A", "D"], ["A", "E"]]


def brute_pack(sizes, limit):
    out = []
    for s in sizes:
        if out and sum(out[-1]) + s <= limit:
            out[-1].append(s)
        else:
            out.append([s])
    return out or [[]]


def test_packing_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(0, 12))]
        o = S.outline("## T\n" + "\n".join(x for s in sizes for x in ("a" * s, "")))
        got = S.chunks(o, S.sections(o, 2)[0], 40)
        assert [[len(p) for p in c.split("\n", 1)[1].split("\n\n")] if "\n" in c else [] for c in got] == brute_pack(sizes, 40)
        assert all(c.startswith("## T（续）" if i else "## T") for i, c in enumerate(got))


def test_fences_stay_whole():
    o = S.outline("a\n\n```\nx\n\ny\n```\n \nb")
    assert S.paragraphs(o, S.sections(o, 2)[0]) == ["a", "```\nx\n\ny\n```", "b"]


def test_passes_over_rows(spark):
    docs = spark.createDataFrame([(1, "---\ncategory: c\n---\n# H\n<details>\nq\n</details>\n## 什么是锁\n" + "字" * 48), (2, None), (3, ""), (4, "## 锁\n" + "字" * 76), (5, "## 锁\n```\nx\n```")], "id int, text string")
    front = {r["id"]: r for r in S.with_front_matter(docs, "id", "text").collect()}
    assert front[1]["scalars"] == {"category": "c"} and front[1]["folded"] == 1 and front[2]["folded"] == 0
    c = slices.assess(S.with_chunks(docs, "id", "text"))
    kept = {(r["id"], r["title"]): r["mode"] for r in slices.kept(c).collect()}
    assert kept == {(1, "什么是锁"): "qa", (5, "锁"): "prose"}
    reasons = {(r["id"], r["title"]): r["reason"] for r in slices.skipped(c).collect()}
    assert reasons[4, "锁"] == "thin" and reasons[1, "H"] == "empty"


def test_density_at_the_limit(spark):
    docs = spark.createDataFrame([(n, "## 什么是锁\n" + "字" * n) for n in (41, 42)], "id int, text string")
    kept = [r["id"] for r in slices.kept(slices.assess(S.with_chunks(docs, "id", "text"), Options())).collect()]
    assert kept == [42]  # the heading counts: 6 more


def test_ids_and_increment(spark):
    t = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x-2"), (4, "y")], "ord long, base string")
    ids = [r["id"] for r in slices.distinct_ids(t).orderBy("ord").collect()]
    assert ids[0] == "x" and ids[3] == "y" and len(set(ids)) == 4
    a, b = (spark.createDataFrame([(x,) for x in v], "id string") for v in (["p", "q", None], ["q", "r", "r"]))
    assert {tuple(r) for r in slices.increment(a, b).collect()} == {("p", "added"), ("q", "unchanged"), ("r", "removed")}


def test_vocabulary_and_terms(spark):
    t = spark.createDataFrame([(1, "索引", "锁 锁 索引 `redo log` `redo log` `锁表`"), (2, None, "x")], "ord long, title string, text string")
    v = spark.createDataFrame([("锁", 1), ("索引", 2), ("无", 3)], "tag string, ord int")
    got = {r["ord"]: r["tags"] for r in slices.vocabulary_tags(t, v, "ord", "title", "text").collect()}
    assert got == {1: ["索引", "锁"], 2: []}
    terms = {r["ord"]: r["terms"] for r in slices.term_tags(t, "ord", "text").collect()}
    assert terms == {1: ["redo log", "锁表"], 2: []}


def test_images_and_trivial_lines(spark):
    t = spark.createDataFrame([("![a](u1) <img src='u2'> ![b](u1)",), ("x",)], "text string")
    assert [r[0] for r in t.select(slices.images(t["text"])).collect()] == [["u1", "u2"], []]
    e = spark.createDataFrame([("## t\n[a](b)\n错误日志:",), ("## t\n字",), ("",), (None,)], "text string")
    assert [r[0] for r in e.select(slices.empty_body(e["text"])).collect()] == [True, False, True, True]

"""Where results go: Parquet as the record, JSON files for import, Markdown and HTML for people."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.contract import FREQUENCIES, NO_CATEGORY, Options
from quarry.operators import folds, reports, validate


def write_bank(bank: DataFrame, folder: str) -> None:
    """The bank as Parquet by category, in bank order within files; the folder's earlier content is replaced."""
    bank.withColumn("_by", F.coalesce("category", F.lit(NO_CATEGORY))).repartition("_by").sortWithinPartitions("_by", "type", "_fingerprint").write.mode("overwrite").partitionBy("_by").parquet(folder)


def write_category_json(bank: DataFrame, folder: str) -> None:
    """Import rows as JSON lines, a folder for each category's file name; written by the executors, earlier content replaced."""
    b = bank.withColumn("category", F.coalesce("category", F.lit(NO_CATEGORY))).join(reports.category_files(bank), "category")
    rows = b.select("file", "type", "_fingerprint", F.to_json(F.struct(*(F.coalesce("analysis", F.lit("")).alias(c) if c == "analysis" else F.col(c) for c in reports.PUBLIC))).alias("value"))
    rows.repartitionByRange("file", "type", "_fingerprint").sortWithinPartitions("file", "type", "_fingerprint").select("file", "value").write.mode("overwrite").partitionBy("file").text(folder)


def write_json(rows: DataFrame, path: str, limit: int = 1_000_000) -> int:
    """A bare array in one file for the import of a bank that fits one request; streamed through the driver, refused beyond ``limit``."""
    n = rows.count()
    if n > limit:
        raise ValueError(f"{n} rows are too many for one file: use write_category_json")
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, r in enumerate(rows.toJSON().toLocalIterator()):
            f.write((",\n" if i else "\n") + r)
        f.write("\n]\n")
    return n


def write_batches(slices: DataFrame, numbered: DataFrame, folder: str) -> None:
    """Slices by batch, one folder each; earlier batches are replaced."""
    slices.join(numbered.select("ord", "batch_no"), "ord").repartition("batch_no").sortWithinPartitions("batch_no", "ord").write.mode("overwrite").partitionBy("batch_no").json(folder)


def write_skipped(skipped: DataFrame, folder: str) -> None:
    """What was left out and why, as JSON lines."""
    skipped.write.mode("overwrite").json(folder)


def write_increment(increment: DataFrame, folder: str) -> None:
    """Ids of an increment, a folder for each status."""
    increment.repartition("status").write.mode("overwrite").partitionBy("status").json(folder)


def write_validated(validated: DataFrame, folder: str) -> None:
    """Questions by what became of them: clean ones, those set apart, and a row with messages for each."""
    validate.clean(validated).drop("errors").write.mode("overwrite").json(f"{folder}/clean")
    validate.disputed(validated).write.mode("overwrite").json(f"{folder}/disputed")
    items = validated.select("ord", "_task_id", F.substring("stem", 1, 80).alias("stem"), "type", "status", "errors", "warnings")
    items.write.mode("overwrite").json(f"{folder}/validation")


def write_slices(slices: DataFrame, folder: str, root: str, options: Options = Options()) -> None:
    """The slices as Parquet, and one row of JSON that says how they were made."""
    slices.write.mode("overwrite").parquet(f"{folder}/slices")
    made = F.lit(root).alias("docs_root"), F.lit(options.split_level).alias("split_level"), F.lit(options.max_per_section).alias("max_per_section"), F.lit(options.mode).alias("mode")
    slices.agg(F.count("*").alias("task_count")).select(*made, "task_count").coalesce(1).write.mode("overwrite").json(f"{folder}/header")


def write_balanced(questions: DataFrame, single: DataFrame, multi: DataFrame, folder: str, version: int) -> None:
    """Questions with their balanced options and answers as a new version beside the others, never over its own source."""
    new = single.unionByName(multi).select("ord", F.col("options").alias("new_options"), F.col("answer").alias("new_answer"))
    q = questions.join(new, "ord", "left").withColumns({"options": F.coalesce("new_options", "options"), "answer": F.coalesce("new_answer", "answer")}).drop("new_options", "new_answer")
    q.write.mode("overwrite").parquet(f"{folder}/v{version:08d}")


def _listed(rows: DataFrame, shown: int, line) -> list[str]:
    """Up to ``shown`` rows as lines of a list, and how many more there are. This limit is the report's; the tables have all rows."""
    got = rows.limit(shown + 1).collect()
    more = rows.count() - shown if len(got) > shown else 0
    return [f"- {line(r)}" for r in got[:shown]] + ([f"- …… 另有 {more} 项"] if more else [])


def _shares(rows: DataFrame) -> str:
    return "、".join(f"{reports.NAMES.get(r['value'], r['value'])} {r['n']}" for r in rows.orderBy(F.desc("n"), "value").limit(100).collect())


def plan_report(slices: DataFrame, skipped: DataFrame, increment: DataFrame | None = None, vocabulary: int = 0) -> str:
    """What a run over files came to, in Markdown: totals, increment, categories, modes, what was left out."""
    t = reports.slice_totals(slices).first()
    folded = skipped.where("reason = 'folded'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    facets = reports.slice_facets(slices).persist()
    out = ["# 出题计划", "", f"- 文档数：{t['files']}，切片数：**{t['slices']}**，跳过：{skipped.count()}", f"- 形态：{_shares(facets.where(F.col('facet') == 'mode'))}", f"- 折叠块：{folded} 个", f"- 图片：{t['pictures']} 张", f"- 受控词表：{vocabulary} 个标签" if vocabulary else "- 受控词表：无", ""]
    if increment is not None:
        n = {r["status"]: r["n"] for r in increment.groupBy("status").agg(F.count("*").alias("n")).collect()}
        out += ["## 本次增量", "", f"- 新增 **{n.get('added', 0)}** / 消失 {n.get('removed', 0)} / 不变 {n.get('unchanged', 0)}"]
        out += _listed(reports.added_slices(increment, slices).orderBy("id"), 50, lambda r: f"`{r['id']}`（{r['char_count']} 字，{r['mode']}）")
        out += _listed(increment.where("status = 'removed'").orderBy("task_id"), 50, lambda r: f"`{r['task_id']}`") + [""]
    out += ["## 分类分布", ""] + _listed(facets.where(F.col("facet") == "category").orderBy(F.desc("n"), "value"), 50, lambda r: f"{r['value']}：{r['n']} 个切片")
    out += ["", "## 被跳过的章节", ""] + _listed(skipped.orderBy("rel", "section"), 50, lambda r: f"`{r['rel']}` → {r['section']}：{r['reason']} {r['n']}")
    return "\n".join(out) + "\n"


def batch_index(slices: DataFrame, numbered: DataFrame, shown: int = 50) -> str:
    """The batches and their slices, in Markdown."""
    both = slices.select("ord", "id", "char_count", "mode").join(numbered, "ord").persist()
    out = ["# 出题批次", ""]
    for b in folds.batch_sizes(numbered).orderBy("batch_no").collect():
        out += [f"## b{b['batch_no']} — {b['slices']} 片 / {b['chars']} 字"]
        out += _listed(both.where(F.col("batch_no") == b["batch_no"]).orderBy("ord"), shown, lambda r: f"`{r['id']}`（{r['char_count']} 字，{r['mode']}）") + [""]
    return "\n".join(out) + "\n"


def review(bank: DataFrame, slices: DataFrame, skipped: DataFrame | None = None, validated: DataFrame | None = None, options: Options = Options()) -> str:
    """A report in Markdown: distributions, questions per slice, coverage, what was left out, what the rules said. What comes to the driver
    are counts, and lists of 20 or 30 rows with the number of the others."""
    n = bank.count()
    out = ["# 题库复核报告", "", f"- 题库总数：**{n}**", "", "## 题型 / 难度 / 考频分布", "", "| 维度 | 分布 |", "| --- | --- |"]
    by = reports.distributions(bank).persist()
    out += [f"| {name} | {_shares(by.where(F.col('facet') == facet))} |" for name, facet in (("题型", "type"), ("难度", "difficulty"), ("考频", "freq"), ("分类", "category"))]
    per = reports.slice_average(bank).first()
    out += ["", "## 单节题数", "", f"- 有题目的切片 {per['slices']} 个，平均 {n / per['slices']:.1f} 题/节" if per["slices"] else "-（无数据）"]
    out += _listed(reports.over_limit(bank, options).orderBy(F.desc("n"), "task_id"), 30, lambda r: f"`{r['task_id']}`：{r['n']} 题")
    cover = reports.coverage(slices, bank).first()
    out += ["", "## 章节覆盖", "", f"- 切片总数 {cover['slices']}，产出题目的切片 {cover['hit']}，覆盖率 {cover['ratio']:.0%}"]
    out += _listed(reports.uncovered_places(slices, bank).orderBy("id"), 30, lambda r: f"`{r['rel']}` → {r['section']}")
    if skipped is not None:
        out += ["", "## 被跳过的章节", ""] + _listed(skipped.orderBy("rel", "section"), 20, lambda r: f"`{r['rel']}` → {r['section']}：{r['reason']}")
    if validated is not None:
        count = {r["status"]: r["n"] for r in validate.status_counts(validated).collect()}
        total, clean = sum(count.values()), validate.clean(validated)
        alarm = validate.high_alarm(clean, options).first()
        # of the share of clean questions, but of the number of all
        flag = "（样本太小，占比仅供参考）" if total < options.high_sample else "（**超限**）" if alarm["high_ratio"] > options.high_share else ""
        shares = "、".join(f"{r['freq']} {r['n']}" for r in validate.frequencies(clean).orderBy(F.desc("n"), "freq").collect())
        out += ["", "## 校验结果", "", f"- 总题数 {total}：通过 {count.get('ok', 0)}、带警告 {count.get('warn', 0)}、失败 {count.get('fail', 0)}", f"- 考频：{shares}；高频占比 {alarm['high_ratio']:.0%}{flag}"]
        for status, said, shown in (("warn", "warnings", 20), ("fail", "errors", 30)):
            rows = validated.where(F.col("status") == status).orderBy("ord")
            out += ["", {"warn": "带警告的题目：", "fail": "**校验失败、已隔离的题目：**"}[status]] + _listed(rows, shown, lambda r: f"{r['stem'][:80]} → {'; '.join(r[said])}")
    return "\n".join(out) + "\n"


PAGE = """<!doctype html><meta charset="utf-8"><title>preview</title><body><div id="filters"></div>
<p><button id="all">all</button> <button id="none">none</button> <button id="save">export</button> <button id="copy">copy</button> <span id="count"></span></p><ol id="list"></ol>
<script id="rows" type="application/json">{rows}</script>
<script>
const rows = JSON.parse(document.getElementById("rows").textContent), chosen = {{}}, picked = new Set(), $ = id => document.getElementById(id);
const test = {{category: (r, v) => r.category === v, type: (r, v) => r.type === v, difficulty: (r, v) => r.difficulty === v, frequency: (r, v) => (r.tags || []).includes(v), selected: (r, v) => picked.has(r.ord) === (v === "yes")}};
const seen = () => rows.filter(r => Object.entries(chosen).every(([k, v]) => !v || test[k](r, v)));
const line = (name, text) => {{ const p = document.createElement(name); p.textContent = text; return p; }};
const show = () => {{
  $("list").textContent = "";
  for (const r of seen()) {{
    const li = document.createElement("li"), box = document.createElement("input");
    box.type = "checkbox"; box.checked = picked.has(r.ord); box.onchange = () => {{ picked[box.checked ? "add" : "delete"](r.ord); show(); }};
    li.append(box, line("b", r.stem));
    for (const o of r.options || []) li.append(line("p", ((r.answer || []).includes(o.label) ? "✓ " : "") + o.label + ". " + o.content));
    for (const t of [r.analysis, r.source_quote]) if (t) li.append(line("blockquote", t));
    $("list").append(li);
  }}
  $("count").textContent = picked.size + " / " + rows.length;
}};
const contract = () => "[" + rows.filter(r => picked.has(r.ord)).map(r => r.contract).join(",\\n") + "]";
const values = {{category: rows.map(r => r.category), type: rows.map(r => r.type), difficulty: rows.map(r => r.difficulty), frequency: {frequencies}, selected: ["yes", "no"]}};
for (const k in values) {{
  const s = document.createElement("select"); s.append(new Option(k, ""));
  for (const v of [...new Set(values[k])].sort()) s.append(new Option(v, v));
  s.onchange = () => {{ chosen[k] = s.value; show(); }}; $("filters").append(s);
}}
$("all").onclick = () => {{ seen().forEach(r => picked.add(r.ord)); show(); }};
$("none").onclick = () => {{ picked.clear(); show(); }};
$("copy").onclick = () => navigator.clipboard.writeText(contract());
$("save").onclick = () => {{ const a = document.createElement("a"); a.href = URL.createObjectURL(new Blob([contract()], {{type: "application/json"}})); a.download = "questions.json"; a.click(); }};
show();
</script>"""


def preview_page(rows: DataFrame, limit: int = 100_000) -> str:
    """One page that shows, filters, picks and exports questions; all of their text is put in as data, with < escaped. More questions than
    ``limit`` are refused, as a browser couldn't hold them: filter them before."""
    data = [json.loads(r) for r in rows.limit(limit + 1).toJSON().collect()]
    if len(data) > limit:
        raise ValueError(f"more than {limit} questions: filter them before")
    shut = lambda x: json.dumps(x, ensure_ascii=False).replace("<", chr(92) + "u003c")
    return PAGE.format(rows=shut(data), frequencies=shut(list(FREQUENCIES)))

"""SQL for DuckDB with the results of the queries in ``workload``.

Left out are those that SQL can't state, or not in reasonable time: sequence ratios and what rests on them, greedy packing of
paragraphs and sequential balancing. They are tested against brute force.
"""

from __future__ import annotations

from quarry.contract import DIFFICULTIES, DIFFICULTY_NAMES, FALSE_WORDS, FREQUENCIES, LABELS, QUESTION_WORDS, TRUE_WORDS, TYPE_NAMES, TYPES

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
INNER = WS[1:-1]
BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def gone(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{by}', 'g')"


def strip(x: str) -> str:
    return gone(x, rf"\A{WS}+|{WS}+\z")


def strip_html(x: str) -> str:
    x = gone(gone(f"coalesce({x}, '')", "(?s)<!--.*?-->"), "</?[A-Za-z][^<>]{0,300}>")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


def norm(x: str) -> str:
    return f"lower(translate({gone(strip_html(x), WS + '+')}, '`*_>', ''))"


def clean_title(x: str) -> str:
    x = gone(strip_html(x), "[-=_*~#]{3,}", " ")
    x = gone(x, rf"\A[{INNER}\-=_*~#]+|[{INNER}\-=_*~#]+\z")
    return strip(gone(x, WS + "+", " "))


def strip_numbering(x: str) -> str:
    x = gone(strip(f"coalesce({x}, '')"), rf"\A\p{{Nd}}+(?:[.\-_]\p{{Nd}}+)*[{INNER}.\-_、]+")
    return strip(gone(x, rf"\A第[一二三四五六七八九十百]+[章节部分篇][{INNER}.\-_、]*"))


def slug(x: str) -> str:
    s = gone(gone(strip(gone(f"coalesce({x}, '')", r'[\\/:*?"<>|\n\r\t]+', "_")), WS + "+", "-"), r"\A-+|-+\z")
    return f"substring(CASE WHEN {s} = '' THEN 'untitled' ELSE {s} END, 1, 60)"


def content(prefix: str = "") -> str:
    p = prefix
    parts = [
        f"coalesce(array_to_string(list_transform({p}options, lambda o: coalesce(o.label, 'None') || ':' || {norm('o.content')}), '|'), '')",
        f"coalesce(array_to_string({p}answer, ','), '')",
        norm(f"{p}analysis"),
        f"coalesce({p}difficulty, '')",
        f"CASE WHEN {p}score = 0 THEN '' ELSE coalesce({p}score::VARCHAR, '') END",
        f"coalesce({p}category, '')",
        f"coalesce(array_to_string(list_sort({p}tags), ','), '')",
    ]
    return "substring(sha1(" + " || chr(10) || ".join(parts) + "), 1, 16)"


HASHES = r"\A#{1,6}"
FRONT = r"(?s)\A---\s*\r?\n(.*?)\r?\n---\s*(?:\r?\n|\z)"
BODY = gone("coalesce(text, '')", FRONT)
FLAT = gone(BODY, r"(?si)<details\b.*?</details\s*>", "\n")
LINES = rf"""
body AS (SELECT doc_id, string_split_regex({FLAT}, '{BREAKS}') AS all_lines FROM documents),
cut AS (SELECT doc_id, CASE WHEN all_lines[len(all_lines)] = '' THEN all_lines[1:len(all_lines) - 1] ELSE all_lines END AS ls FROM body),
line AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut WHERE len(ls) > 0),
fence AS (SELECT *, regexp_matches(line, '\A{WS}*(?:```|~~~)') AS is_fence FROM line),
state AS (SELECT *, sum(is_fence::INT) OVER (PARTITION BY doc_id ORDER BY pos) % 2 = 1 AS fenced FROM fence),
head AS (SELECT *, NOT fenced AND regexp_matches(line, '\A#{{1,6}}{WS}+') AS is_head FROM state),
numbered AS (SELECT *, sum(is_head::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS b FROM head),
block AS (
  SELECT doc_id, b, max(CASE WHEN is_head THEN length(regexp_extract(line, '\A(#{{1,6}})', 1)) ELSE 0 END) AS level,
    coalesce(max(CASE WHEN is_head THEN {strip(gone('line', HASHES))} END), '') AS title, count(*) FILTER (WHERE NOT is_head) AS n_lines
  FROM numbered GROUP BY doc_id, b
),
kept AS (SELECT * FROM block WHERE n_lines > 0 OR title <> '')"""

FREQ = "list_filter(list_transform(coalesce(tags, []), lambda t: " + strip("t") + "), lambda t: t IN (" + ", ".join(f"'{f}'" for f in FREQUENCIES) + "))"
ASKS = "|".join(QUESTION_WORDS)

SQL: dict[str, str] = {
    "grounding": rf"""
WITH t AS (SELECT id, arg_max(struct_pack(x := text, r := rel), ord) AS s FROM tasks GROUP BY id),
q AS (SELECT ord, _task_id, {norm('source_quote')} AS quote FROM clean),
j AS (SELECT q.ord, q.quote, t.s.r AS rel, q.quote <> '' AND coalesce(contains({norm('t.s.x')}, q.quote), false) AS hit FROM q LEFT JOIN t ON q._task_id = t.id),
f AS (SELECT DISTINCT j.ord FROM j JOIN documents d ON d.rel = j.rel WHERE NOT j.hit AND j.quote <> '' AND d.text IS NOT NULL AND contains({norm('d.text')}, j.quote))
SELECT ord, CASE WHEN hit THEN 'section' WHEN ord IN (SELECT ord FROM f) THEN 'file' ELSE 'none' END AS hit FROM j""",
    "norm_documents": f"SELECT doc_id, sha1({norm('text')}) AS digest, length({norm('text')})::BIGINT AS n_chars FROM documents",
    "strip_html_slices": f"SELECT ord, sha1({strip_html('text')}) AS digest FROM tasks",
    "fingerprints": f"SELECT ord, substring(sha1({norm('stem')} || '|' || upper(coalesce(type, 'NONE'))), 1, 16) AS fp FROM bank",
    "fingerprint_repeats": "SELECT * FROM (SELECT ord, _fingerprint, row_number() OVER (PARTITION BY _fingerprint ORDER BY ord) AS nth FROM clean) WHERE nth > 1",
    "content_fingerprints": f"SELECT ord, {content()} AS content FROM bank",
    "titles": f"WITH t AS (SELECT ord, {clean_title('title')} AS title FROM tasks) SELECT ord, title, {strip_numbering('title')} AS bare, {slug('title')} AS slug FROM t",
    "slice_ids": rf"""
WITH t AS (SELECT ord, {slug("regexp_replace(list_last(string_split(rel, '/')), '(.)[.][^.]+$', chr(92) || '1')".replace("chr(92) || '1'", "'" + chr(92) + "1'"))} || '__' || {slug(clean_title('title'))} || CASE WHEN parts > 1 THEN '__p' || lpad(part::VARCHAR, 2, '0') ELSE '' END AS base FROM tasks),
n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY ord) AS nth FROM t)
SELECT ord, base, base || CASE WHEN nth = 1 THEN '' ELSE '-' || nth END AS id FROM n""",
    "front_matter": rf"""
WITH f AS (SELECT doc_id, regexp_extract(coalesce(text, ''), '{FRONT}', 1) AS m FROM documents)
SELECT doc_id, nullif(regexp_extract(m, '(?m)^category: *([^\r\n]*?) *\r?$', 1), '') AS category,
  CASE WHEN regexp_matches(m, '(?m)^tags: *\[.*\]') THEN array_to_string(list_transform(string_split(regexp_extract(m, '(?m)^tags: *\[(.*)\]', 1), ','), lambda x: {strip('x')}), '|') END AS tags FROM f""",
    "folded_blocks": rf"SELECT doc_id, n AS folded FROM (SELECT doc_id, len(regexp_extract_all({BODY}, '(?si)<details\\b.*?</details\\s*>'))::BIGINT AS n FROM documents) WHERE n > 0".replace(chr(92) * 2, chr(92)),
    "image_addresses": r"""
WITH t AS (SELECT ord, list_concat(regexp_extract_all(text, '!\[[^\]]*\]\(\s*<?([^)\s>]+)>?[^)]*\)', 1), regexp_extract_all(text, '(?i)<img\b[^>]*\bsrc=["'']([^"'']+)["'']', 1)) AS l FROM tasks),
u AS (SELECT ord, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM t WHERE len(l) > 0), v AS (SELECT ord, x, min(i) AS i FROM u GROUP BY ord, x)
SELECT ord, string_agg(x, '|' ORDER BY i) AS images FROM v GROUP BY ord""",
    "heading_blocks": f"WITH {LINES} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY b) - 1 AS block_no, level::BIGINT AS level, title, n_lines::BIGINT AS n_lines FROM kept",
    "sections": rf"""
WITH {LINES},
part AS (SELECT *, sum((level BETWEEN 1 AND 2)::INT) OVER w AS s, min(level) OVER (PARTITION BY doc_id ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lowest FROM kept WINDOW w AS (PARTITION BY doc_id ORDER BY b)),
owned AS (SELECT n.doc_id, p.s, n.pos, n.is_fence, n.fenced, n.is_fence OR n.fenced OR {strip('n.line')} <> '' AS solid FROM numbered n JOIN part p ON n.doc_id = p.doc_id AND n.b = p.b WHERE NOT n.is_head),
runs AS (SELECT *, lag(solid, 1, false) OVER (PARTITION BY doc_id, s ORDER BY pos) AS before FROM owned),
paras AS (SELECT doc_id, s, count(*) AS n_lines, count(*) FILTER (WHERE solid AND NOT before) AS n_paragraphs FROM runs GROUP BY doc_id, s),
sec AS (SELECT doc_id, s, coalesce(max(CASE WHEN level BETWEEN 1 AND 2 THEN title END), '') AS title FROM part GROUP BY doc_id, s)
SELECT sec.doc_id, row_number() OVER (PARTITION BY sec.doc_id ORDER BY sec.s) - 1 AS section_no, title, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_paragraphs, 0)::BIGINT AS n_paragraphs
FROM sec LEFT JOIN paras ON sec.doc_id = paras.doc_id AND sec.s = paras.s""",
    "categories": rf"""
WITH {LINES},
h AS (SELECT doc_id, arg_min(title, b) AS h1 FROM kept WHERE level = 1 GROUP BY doc_id),
f AS (SELECT d.doc_id, rel, regexp_extract(coalesce(text, ''), '{FRONT}', 1) AS m, coalesce(h1, '') AS h1 FROM documents d LEFT JOIN h ON d.doc_id = h.doc_id)
SELECT doc_id, coalesce(nullif(regexp_extract(m, '(?m)^category: *([^\r\n]*?) *\r?$', 1), ''), CASE WHEN contains(rel, '/') THEN nullif({clean_title(strip_numbering("string_split(rel, '/')[1]"))}, '') END, nullif({clean_title(strip_numbering('h1'))}, ''), '未分类') AS category FROM f""",
    "vocabulary_tags": rf"""
WITH t AS (SELECT ord, coalesce(title, '') AS title, {strip_html('text')} || chr(10) || coalesce(title, '') AS hay FROM tasks),
s AS (SELECT t.ord, v.tag, v.ord AS i, ((length(hay) - length(replace(hay, v.tag, ''))) / length(v.tag))::INT + CASE WHEN contains(title, v.tag) THEN 50 ELSE 0 END AS score FROM t JOIN tag_vocab v ON contains(hay, v.tag)),
r AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY score DESC, length(tag), i) AS k FROM s)
SELECT ord, string_agg(tag, '|' ORDER BY k) AS tags FROM r WHERE k <= 5 GROUP BY ord""",
    "slice_flags": rf"""
WITH t AS (SELECT ord, text, {clean_title('title')} AS title, string_split_regex({strip_html('text')}, '{BREAKS}') AS ls FROM tasks),
b AS (SELECT *, list_filter(list_transform(ls, lambda l: {strip('l')}), lambda l: l <> '' AND NOT regexp_matches(l, '\A#{{1,6}}{WS}+')) AS body FROM t)
SELECT ord, CASE WHEN title = '' OR length(title) > 40 THEN 'prose' WHEN regexp_matches(title, '[?？]$') OR regexp_matches(title, '{ASKS}') THEN 'qa' ELSE 'prose' END AS mode,
  length({gone(strip_html('text'), WS + '+')})::BIGINT AS char_count, regexp_matches(text, '(?m)^{WS}*(?:```|~~~)') AS has_code, regexp_matches(text, '(?m)^[\s\x1c-\x1f]*\|.*\|[\s\x1c-\x1f]*$') AS has_table,
  len(list_filter(body, lambda l: NOT ({gone(gone(gone('l', '!?' + chr(92) + '[[^' + chr(92) + ']]*' + chr(92) + '][(][^)]*[)]'), 'https?://[^' + INNER + ']+'), '[' + INNER + '*' + chr(92) + '-_~>#|]+')} = '' OR regexp_matches({gone(gone(gone('l', '!?' + chr(92) + '[[^' + chr(92) + ']]*' + chr(92) + '][(][^)]*[)]'), 'https?://[^' + INNER + ']+'), '[' + INNER + '*' + chr(92) + '-_~>#|]+')}, '\A[一-\x{{9fff}}A-Za-z0-9 ()（）]{{1,20}}[:：]$')))) = 0 AS empty
FROM b""",
    "increment": "WITH a AS (SELECT DISTINCT id FROM tasks WHERE id IS NOT NULL), b AS (SELECT DISTINCT _task_id AS id FROM bank WHERE _task_id IS NOT NULL) SELECT coalesce(a.id, b.id) AS task_id, CASE WHEN b.id IS NULL THEN 'added' WHEN a.id IS NULL THEN 'removed' ELSE 'unchanged' END AS status FROM a FULL JOIN b ON a.id = b.id",
    "only_new": "SELECT ord, id FROM tasks WHERE id IN (SELECT task_id FROM task_increment WHERE status = 'added')",
    "crowded_sections": "SELECT _task_id AS task_id, count(*) AS n FROM clean GROUP BY _task_id HAVING count(*) > 5",
    "frequency_distribution": f"WITH q AS (SELECT coalesce(({FREQ})[1], '未标') AS freq FROM clean) SELECT freq, count(*) AS n, count(*) / (SELECT count(*) FROM q) AS share FROM q GROUP BY freq",
    "frequency_alarm": f"WITH q AS (SELECT ({FREQ})[1] AS freq FROM clean), r AS (SELECT count(*) AS n, coalesce(avg(CASE WHEN freq = '高频' THEN 1.0 ELSE 0.0 END), 0.0)::DOUBLE AS high_ratio FROM q) SELECT n, high_ratio, n >= 20 AND high_ratio > 0.3 AS alarm FROM r",
    "answer_positions": "SELECT label, count(*) AS n FROM (SELECT unnest(answer) AS label FROM clean WHERE type = 'SINGLE') GROUP BY label",
    "top_combination": "SELECT combo, n FROM (SELECT array_to_string(answer, '') AS combo, count(*) AS n, min(ord) AS first FROM clean WHERE type = 'MULTI' GROUP BY combo) ORDER BY n DESC, first LIMIT 1",
    "position_skew": "WITH s AS (SELECT ord, answer FROM clean WHERE type = 'SINGLE'), b AS (SELECT label, count(*) AS n, min(ord) AS first FROM (SELECT ord, unnest(answer) AS label FROM s) GROUP BY label), t AS (SELECT * FROM b ORDER BY n DESC, first LIMIT 1) SELECT label, n, total, ratio FROM (SELECT label, n, (SELECT count(*) FROM s) AS total, n / (SELECT count(*) FROM s) AS ratio FROM t) WHERE total >= 10 AND ratio > 0.5",
    "merge_exact": rf"""
WITH old AS (SELECT _fingerprint, arg_max(struct_pack(o := ord, c := {content()}, l := coalesce(_locked, false)), ord) AS s FROM bank WHERE _fingerprint IS NOT NULL GROUP BY _fingerprint)
SELECT c.ord, s.o AS bank_ord, CASE WHEN s IS NULL THEN 'miss' WHEN {content('c.')} = s.c THEN 'existing' WHEN s.l THEN 'locked' ELSE 'updated' END AS action FROM clean c LEFT JOIN old ON c._fingerprint = old._fingerprint""",
    "prune": rf"""
WITH old AS (SELECT _fingerprint, arg_max(struct_pack(o := ord, c := {content()}, l := coalesce(_locked, false)), ord) AS s FROM bank WHERE _fingerprint IS NOT NULL GROUP BY _fingerprint),
a AS (SELECT s.o AS bank_ord, {content('c.')} = s.c AS same FROM clean c JOIN old ON c._fingerprint = old._fingerprint),
rest AS (SELECT * FROM bank WHERE ord NOT IN (SELECT bank_ord FROM a WHERE NOT same))
SELECT ord, CASE WHEN ((coalesce(_source_file, '') <> '' AND _source_file NOT IN (SELECT rel FROM documents WHERE rel IS NOT NULL)) OR (coalesce(_task_id, '') <> '' AND _task_id NOT IN (SELECT id FROM tasks WHERE id IS NOT NULL)))
  AND ord NOT IN (SELECT bank_ord FROM a WHERE same) AND NOT coalesce(_locked, false) THEN 'pruned' ELSE 'kept' END AS fate FROM rest""",
    "batches": r"""
WITH RECURSIVE s AS (SELECT row_number() OVER (ORDER BY ord) AS i, ord, length(coalesce(text, ''))::BIGINT AS chars FROM tasks),
t AS (SELECT greatest(1, least(6, count(*))) AS k, sum(chars) / greatest(1, least(6, count(*))) AS target FROM s),
f AS (
  SELECT i, ord, chars, 1::BIGINT AS batch_no, chars AS held FROM s WHERE i = 1
  UNION ALL
  SELECT s.i, s.ord, s.chars, CASE WHEN f.held + s.chars > t.target AND f.batch_no < t.k THEN f.batch_no + 1 ELSE f.batch_no END, CASE WHEN f.held + s.chars > t.target AND f.batch_no < t.k THEN s.chars ELSE f.held + s.chars END
  FROM f JOIN s ON s.i = f.i + 1, t
)
SELECT ord, batch_no, chars FROM f""",
    "bank_distributions": "SELECT facet, value, count(*) AS n FROM (SELECT 'category' AS facet, coalesce(category, '') AS value FROM bank UNION ALL SELECT 'type', coalesce(type, '') FROM bank UNION ALL SELECT 'difficulty', coalesce(difficulty, '') FROM bank UNION ALL SELECT 'freq', coalesce(_freq, '未标') FROM bank) GROUP BY facet, value",
    "slice_counts": "SELECT _task_id AS task_id, count(*) AS n FROM bank WHERE _task_id IS NOT NULL GROUP BY _task_id",
    "slice_average": "SELECT count(*) AS slices, sum(n)::BIGINT AS questions, avg(n) AS average FROM (SELECT count(*) AS n FROM bank WHERE _task_id IS NOT NULL GROUP BY _task_id)",
    "over_limit": "SELECT _task_id AS task_id, count(*) AS n FROM bank WHERE _task_id IS NOT NULL GROUP BY _task_id HAVING count(*) > 5",
    "coverage": "WITH c AS (SELECT DISTINCT id, id IN (SELECT _task_id FROM bank WHERE _task_id IS NOT NULL) AS covered FROM tasks WHERE id IS NOT NULL) SELECT count(*) AS slices, count(*) FILTER (WHERE covered) AS hit, avg(covered::INT)::DOUBLE AS ratio FROM c",
    "uncovered": "SELECT DISTINCT id FROM tasks WHERE id IS NOT NULL AND id NOT IN (SELECT _task_id FROM bank WHERE _task_id IS NOT NULL)",
    "contract_export": "SELECT type, stem, array_to_string(list_transform(options, lambda o: o.label || ':' || o.content), '|') AS options, array_to_string(answer, '|') AS answer, coalesce(analysis, '') AS analysis, difficulty, score::BIGINT AS score, category, array_to_string(tags, '|') AS tags FROM bank",
    "bank_index": "SELECT _fingerprint AS fingerprint, s.stem AS stem, s.category AS category, s.f AS source_file, s.s AS source_section, s.a AS added_at, s.l AS locked FROM (SELECT _fingerprint, arg_max(struct_pack(stem := substring(stem, 1, 60), category := category, f := _source_file, s := _source_section, a := _added_at, l := coalesce(_locked, false)), ord) AS s FROM bank GROUP BY _fingerprint)",
    "category_files": f"WITH c AS (SELECT DISTINCT coalesce(category, '未分类') AS category FROM bank), d AS (SELECT category, {slug('category')} AS s FROM c) SELECT category, s || CASE WHEN row_number() OVER (PARTITION BY s ORDER BY category) = 1 THEN '' ELSE '-' || row_number() OVER (PARTITION BY s ORDER BY category) END || '.json' AS file FROM d",
    "preview_rows": "SELECT ord, stem, category, '单选' AS kind, CASE difficulty WHEN 'EASY' THEN '简单' WHEN 'MEDIUM' THEN '中等' WHEN 'HARD' THEN '困难' ELSE difficulty END AS difficulty FROM bank WHERE type = 'SINGLE' AND list_contains(tags, '高频')",
    "preview_facets": "SELECT DISTINCT * FROM (SELECT 'category' AS facet, coalesce(category, '') AS value FROM bank UNION ALL SELECT 'type', coalesce(type, '') FROM bank UNION ALL SELECT 'difficulty', coalesce(difficulty, '') FROM bank UNION ALL SELECT 'freq', coalesce(_freq, '未标') FROM bank)",
    "canonical_fields": f"SELECT ord, CASE WHEN upper({strip('type')}) IN ('SINGLE', 'MULTI', 'JUDGE') THEN upper({strip('type')}) END AS type, CASE WHEN upper({strip('difficulty')}) IN ('EASY', 'HARD') THEN upper({strip('difficulty')}) ELSE 'MEDIUM' END AS difficulty, array_to_string(answer, ',') AS answer, array_to_string(list_filter(list_transform(coalesce(tags, []), lambda t: {strip('t')}), lambda t: t <> '' AND t NOT IN ('高频', '中频', '低频')), '|') AS content_tags, array_to_string({FREQ}, '|') AS freq_tags, len(list_filter(coalesce(options, []), lambda o: regexp_matches(coalesce(o.content, ''), '^{WS}*(?:[0-9０-９]|[（(]?[一二三四五六七八九][)）])'))) > 0 AS ordinal FROM clean",
}
SQL["batch_sizes"] = "SELECT batch_no, count(*) AS slices, sum(chars)::BIGINT AS chars FROM (" + SQL["batches"] + ") GROUP BY batch_no"


# the rules of a question, stated again in SQL


def _among(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _named(names: dict[str, str], key: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + " END"


def _said(*rules: tuple[str, str]) -> str:
    """A list of the names of the rules that hold."""
    return "list_filter([" + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules) + "], lambda m: m IS NOT NULL)"


def _per(items: str, test: str, name: str) -> str:
    return f"list_transform(list_filter({items}, lambda o: {test}), lambda o: '{name}')"


_ITEMS = rf"""
WITH raw AS (
  SELECT *, coalesce({_named(TYPE_NAMES, norm('type'))}, CASE WHEN upper({strip('type')}) IN {_among(TYPES)} THEN upper({strip('type')}) END) AS kind, {strip("coalesce(stem, '')")} AS s,
    coalesce({_named(DIFFICULTY_NAMES, norm('difficulty'))}, CASE WHEN upper({strip('difficulty')}) IN {_among(DIFFICULTIES)} THEN upper({strip('difficulty')}) END, 'MEDIUM') AS level,
    list_transform(coalesce(options, []), lambda o: struct_pack(label := upper({strip("coalesce(o.label, '')")}), content := {strip("coalesce(o.content, '')")})) AS opts,
    list_distinct(list_filter(list_transform(flatten(list_transform(coalesce(answer, []), lambda a: string_split_regex(coalesce(a, 'None'), '[,，、;；{INNER}]+'))), lambda a: regexp_replace(upper({strip('a')}), '^[（(]?([A-F])[)）]?$', '\1')), lambda a: a IN {_among(LABELS)})) AS given,
    list_filter(list_transform(coalesce(tags, []), lambda t: {strip('t')}), lambda t: t <> '' AND t NOT IN {_among(FREQUENCIES)}) AS plain_tags, {FREQ} AS freqs,
    {strip("coalesce(source_quote, '')")} AS quote, {strip("coalesce(analysis, '')")} AS why
  FROM clean
),
sided AS (SELECT *, list_transform(opts, lambda o: CASE WHEN {norm('o.content')} IN {_among(TRUE_WORDS)} THEN 'A' WHEN {norm('o.content')} IN {_among(FALSE_WORDS)} THEN 'B' END) AS sides, list_transform(opts, lambda o: o.label) AS labels,
  list_filter(list_transform(opts, lambda o: {norm('o.content')}), lambda n: n <> '') AS contents FROM raw),
turned AS (SELECT *, coalesce(kind = 'JUDGE' AND len(opts) = 2 AND sides[1] <> sides[2] AND labels[1] <> labels[2], false) AS turn FROM sided),
final AS (SELECT *, CASE WHEN turn THEN list_transform(given, lambda a: CASE a WHEN labels[1] THEN sides[1] WHEN labels[2] THEN sides[2] ELSE a END) ELSE given END AS a, CASE WHEN turn THEN ['A', 'B'] ELSE labels END AS declared,
  substring(sha1({norm('s')} || '|' || upper(coalesce(kind, 'NONE'))), 1, 16) AS fp, coalesce(score, CASE level WHEN 'EASY' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END) AS points FROM turned),
ground AS ({SQL['grounding']}),
ruled AS (
  SELECT f.ord, _task_id, fp, flatten([
    {_said(("type", "kind IS NULL"), ("stem_empty", "s = ''"), ("options_missing", "len(opts) = 0"))},
    {_per("opts", f"o.label NOT IN {_among(LABELS)}", "label")}, list_transform(list_filter(labels, lambda x, i: list_contains(labels[1:i - 1], x)), lambda x: 'label_repeated'),
    {_per("opts", "o.content = ''", "option_empty")}, {_per("opts", f"o.content <> '' AND {norm('o.content')} = {norm('s')}", "option_is_stem")},
    {_said(("option_count", "len(opts) NOT BETWEEN 2 AND 6"), ("options_repeated", "len(list_distinct(contents)) <> len(contents)"), ("answer", "len(a) = 0"), ("answer_undeclared", "len(list_filter(a, lambda x: NOT list_contains(declared, x))) > 0"),
        ("answer_not_one", "kind IN ('SINGLE', 'JUDGE') AND len(a) > 1"), ("answer_too_few", "kind = 'MULTI' AND len(a) = 1"), ("answer_all", "kind = 'MULTI' AND len(a) > 0 AND len(a) = len(declared)"), ("score", "points NOT BETWEEN 1 AND 100"),
        ("frequency_missing", "len(freqs) = 0"), ("frequency_many", "len(freqs) > 1"), ("tags_many", "len(plain_tags) + len(freqs) > 10"), ("quote_missing", "quote = ''"), ("quote_long", "length(quote) > 200"))},
    {_said(("quote_not_found", "quote <> '' AND g.hit = 'none'"))}]) AS errors,
  flatten([
    {_said(("stem_long", "length(s) > 500"))}, {_per("opts", "length(o.content) = 1", "option_short")}, {_per("opts", "contains(o.content, '以上都') OR contains(o.content, '以上全部')", "option_all")},
    {_said(("judge_wording", "kind = 'JUDGE' AND len(opts) = 2 AND NOT turn"), ("options_few", "kind = 'SINGLE' AND len(opts) BETWEEN 1 AND 2"), ("difficulty_missing", "difficulty IS NULL"), ("difficulty_renamed", f"upper({strip('difficulty')}) NOT IN {_among(DIFFICULTIES)}"),
        ("category_missing", "coalesce(category, '') = ''"), ("content_tags_many", "len(plain_tags) > 5"), ("analysis_missing", "why = ''"), ("quote_elsewhere", "quote <> '' AND g.hit = 'file'"))}]) AS warnings
  FROM final f JOIN ground g ON f.ord = g.ord
),
once AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY fp ORDER BY ord) > 1 AND len(errors) = 0 THEN ['repeated'] ELSE errors END AS e FROM ruled),
crowd AS (SELECT *, len(e) = 0 AND sum((len(e) = 0)::INT) OVER (PARTITION BY _task_id) > 5 AS crowded FROM once),
items AS (SELECT ord, e, CASE WHEN crowded THEN list_append(warnings, 'section_over') ELSE warnings END AS w FROM crowd)"""
_STATUS = "CASE WHEN len(e) > 0 THEN 'fail' WHEN len(w) > 0 THEN 'warn' ELSE 'ok' END"
SQL["validate_items"] = f"{_ITEMS} SELECT ord, {_STATUS} AS status, array_to_string(e, '|') AS errors, array_to_string(w, '|') AS warnings FROM items"
SQL["validate_status_counts"] = f"{_ITEMS} SELECT {_STATUS} AS status, count(*) AS n FROM items GROUP BY 1"
SQL["validate_rule_counts"] = f"{_ITEMS} SELECT kind, rule, count(*) AS n FROM (SELECT 'error' AS kind, unnest(e) AS rule FROM items UNION ALL SELECT 'warning', unnest(w) FROM items) GROUP BY kind, rule"

# answers spread over positions, one question after another
_BEST = "list_position(f.used[1:q.k], list_min(f.used[1:q.k]))"
SQL["balance_single"] = rf"""
WITH RECURSIVE q AS (
  SELECT row_number() OVER (ORDER BY ord) AS i, ord, options, answer, len(options) AS k FROM clean
  WHERE type = 'SINGLE' AND len(answer) = 1 AND answer[1] IN {_among(LABELS)} AND list_contains(list_transform(options, lambda o: o.label), answer[1]) AND len(options) BETWEEN 2 AND 6
    AND len(list_filter(options, lambda o: regexp_matches(coalesce(o.content, ''), '^{WS}*(?:[0-9０-９]|[（(]?[一二三四五六七八九][)）])'))) = 0
),
f AS (
  SELECT 0::BIGINT AS i, 0::BIGINT AS ord, 0::BIGINT AS t, [0, 0, 0, 0, 0, 0] AS used
  UNION ALL
  SELECT q.i, q.ord, {_BEST}::BIGINT, list_transform(f.used, lambda x, j: x + CASE WHEN j = {_BEST} THEN 1 ELSE 0 END) FROM f JOIN q ON q.i = f.i + 1
),
m AS (SELECT q.ord, f.t, list_transform(list_filter(q.options, lambda o: o.label <> q.answer[1]), lambda o: o.content) AS rest, list_filter(q.options, lambda o: o.label = q.answer[1])[1].content AS hit FROM q JOIN f ON q.ord = f.ord)
SELECT ord, array_to_string(flatten([rest[1:t - 1], [hit], rest[t:]]), '|') AS options, substring('ABCDEF', t, 1) AS answer FROM m"""

SQL["balanced_choices"] = f"SELECT answer AS label, count(*) AS n FROM ({SQL['balance_single']}) GROUP BY answer"
SQL["slice_facets"] = "SELECT facet, value, count(*) AS n FROM (SELECT 'category' AS facet, coalesce(category, '') AS value FROM tasks UNION ALL SELECT 'mode', coalesce(mode, '') FROM tasks) GROUP BY facet, value"
SQL["slice_totals"] = "SELECT count(*) AS slices, count(DISTINCT rel) AS files, coalesce(sum(char_count), 0)::BIGINT AS chars, coalesce(sum(len(images)), 0)::BIGINT AS pictures FROM tasks"
SQL["added_slices"] = "SELECT id, char_count, mode FROM tasks WHERE id IN (SELECT task_id FROM task_increment WHERE status = 'added')"
SQL["uncovered_places"] = "SELECT id, rel, section FROM tasks WHERE id IS NULL OR id NOT IN (SELECT _task_id FROM bank WHERE _task_id IS NOT NULL)"
SQL["sourced_slices"] = "SELECT ord, sha1('[来源] ' || coalesce(rel, '') || ' | ' || coalesce(section, '') || chr(10) || chr(10) || coalesce(text, '')) AS digest FROM tasks"

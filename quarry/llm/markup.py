"""Problem 2: markup residue of four formats, told from signs used literally, and turned into clean text.

A tolerant reader finds every stretch that could be markup, of HTML, Markdown, wiki or LaTeX, and hangs them into a tree by
containment; a pair of tags makes an element, which is the parent of its tags and of all between them. Gradient-boosted trees give
each node the odds that it is markup, from features of the node: kind, depth, siblings and those of its kind, density of the subtree,
tag and attribute tokens, what stands at its edges and inside. The labels of all nodes are decoded together for the most probable
choice without contradictions: an element and its tags are markup all three or none, by the sum of their odds; nothing inside code is
markup, and nothing inside a formula but LaTeX is. Code and formulas bind tighter than what is inside, which can't outvote them.

The classifier is fitted on the driver on SAMPLE generated texts whose labels are known by the way they are made (``teach``); it
has some hundred leaves and goes along with the function. It never sees the data. Rows are independent: one pass without a shuffle.

Defined cases: null and empty texts have no nodes and stay as they are; a stretch that two readings cross belongs to the one
that begins first, unless that one turns out to be no markup: then the text is read again without it; copies get equal results.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.boosting import Boosted

FAMILIES = ("html", "markdown", "wiki", "latex")
#: Generated texts that the classifier is fitted on.
SAMPLE = 2500

#: Names of HTML elements, those that begin a line, those whose content is shown as it is.
TAGS = set("a abbr b big blockquote body br caption center cite code col dd del details div dl dt em figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link mark meta nav ol option p pre q s samp script section select small span strike strong style sub summary sup svg table tbody td textarea tfoot th thead title tr tt u ul var video".split())
BLOCKS = set("blockquote br caption dd details div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li ol p pre section summary table tr ul".split())
RAW = set("code kbd pre samp script style textarea tt".split())

#: Kind: (family, pattern). Patterns name what they show as "in"; lines are matched with ^ and $.
KINDS: dict[str, tuple[str, str]] = {
    "fence": ("markdown", r"^[ ]{0,3}(?P<f>`{3,}|~{3,})[^\n`]*\n(?P<in>(?:.*\n)*?)[ ]{0,3}(?P=f)[ ]*$"),
    "code": ("markdown", r"(?<![`\\])(?P<c>`{1,2})(?!`)(?P<in>[^`\n]+)(?P=c)(?!`)"),
    "comment": ("html", r"<!--(?P<in>[\s\S]*?)-->"),
    "tag": ("html", r"</?(?P<in>[A-Za-z][A-Za-z0-9]*)(?P<attr>[^<>]*)>"),
    "element": ("html", ""),  # an opening tag, its closing one and what is between
    "entity": ("html", r"&(?P<in>#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"),
    "display": ("latex", r"\$\$(?P<in>[^$]+)\$\$"),
    "bracket": ("latex", r"\\\[(?P<in>[\s\S]+?)\\\]"),
    "paren": ("latex", r"\\\((?P<in>[^\n]+?)\\\)"),
    "environment": ("latex", r"\\begin\{(?P<e>[A-Za-z]+\*?)\}(?P<in>[\s\S]*?)\\end\{(?P=e)\}"),
    "dollar": ("latex", r"(?<![\\$])\$(?P<in>[^$\n]+)\$(?!\$)"),
    "command": ("latex", r"\\(?P<n>[A-Za-z]+)\*?(?:\[[^\]\n]*\])?\{(?P<in>[^{}\n]*)\}(?:\{[^{}\n]*\})*"),
    "bare": ("latex", r"\\(?P<in>[A-Za-z]{2,})(?![A-Za-z{\\])"),
    "wikitable": ("wiki", r"^\{\|(?P<in>[\s\S]*?)^\|\}"),
    "template": ("wiki", r"\{\{(?P<in>[^{}]+)\}\}"),
    "wikilink": ("wiki", r"\[\[(?P<in>[^\[\]\n]+)\]\]"),
    "quotes": ("wiki", r"(?<!')(?P<q>'{2,3}|'{5})(?!')(?P<in>[^\n]+?)(?<!')(?P=q)(?!')"),
    "equals": ("wiki", r"^(?P<h>={2,6})[ \t]*(?P<in>[^=\n]+?)[ \t]*(?P=h)[ \t]*$"),
    "extlink": ("wiki", r"(?<![\]\[!])\[(?:https?|ftp)://[^\s\]]+[ ](?P<in>[^\]\n]+)\]"),
    "heading": ("markdown", r"^[ ]{0,3}#{1,6}[ \t]+(?P<in>[^\n]*\S)"),
    "underline": ("markdown", r"^(?P<in>[^\n|<>\-=#][^\n]*)\n[ ]{0,3}(?P<u>=+|-+)[ \t]*$"),
    "rule": ("markdown", r"^[ ]{0,3}(?P<in>(?:-[ ]*){3,}|(?:\*[ ]*){3,}|(?:_[ ]*){3,})$"),
    "bullet": ("markdown", r"^[ \t]*(?P<b>[-*+]|\d{1,4}[.)])[ \t]+(?P<in>[^\n]*\S)"),
    "quote": ("markdown", r"^[ ]{0,3}>[ ]?(?P<in>[^\n]*\S)"),
    "row": ("markdown", r"^[ ]{0,3}\|(?P<in>[^\n]*)\|[ \t]*$"),
    "image": ("markdown", r"!\[(?P<in>[^\]\n]*)\]\([^()\s]+(?:[ ]+\"[^\"\n]*\")?\)"),
    "link": ("markdown", r"(?<!!)\[(?P<in>[^\[\]\n]+)\]\([^()\s]+(?:[ ]+\"[^\"\n]*\")?\)"),
    "note": ("markdown", r"\[\^(?P<in>[\w-]+)\]:?"),
    "stars": ("markdown", r"(?<![\\*])(?P<s>\*{1,3})(?!\*)(?P<in>[^*\n]+?)(?P=s)(?!\*)"),
    "bars": ("markdown", r"(?<![\\_])(?P<s>_{1,3})(?!_)(?P<in>[^_\n]+?)(?P=s)(?!_)"),
    "strike": ("markdown", r"~~(?P<in>[^~\n]+?)~~"),
}
ORDER = list(KINDS)
PATTERNS = {k: re.compile(p, re.M) for k, (_, p) in KINDS.items() if p}
#: Readings of a text, each without what the one before showed to be no markup and to stand in the way of something.
READINGS = 4
#: A text without this sign has no node of the kind.
NEEDS = {"fence": "", "code": "`", "comment": "<!--", "tag": "<", "entity": "&", "display": "$$", "bracket": "\\[", "paren": "\\(", "environment": "\\begin", "dollar": "$", "command": "\\", "bare": "\\", "wikitable": "{|", "template": "{{", "wikilink": "[[", "quotes": "''", "equals": "==", "extlink": "://", "heading": "#", "row": "|", "image": "![", "link": "](", "note": "[^", "stars": "*", "bars": "_", "strike": "~~", "quote": ">"}
#: Kinds inside which nothing else is markup, and those inside which LaTeX alone is.
VERBATIM = {"fence", "code", "comment"}
FORMULA = {"display", "bracket", "paren", "dollar", "environment"}
WIDE = re.compile("[\u2e80-\u9fff\uf900-\ufaff]")
ATTRIBUTE = re.compile(r"^(?:\s+[A-Za-z-:]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)*\s*/?$")
VALUE = re.compile(r"=\s*[\"']")


@dataclass(eq=False)
class Node:
    kind: str
    start: int
    end: int
    low: int
    high: int
    match: re.Match
    children: list[Node] = field(default_factory=list)
    depth: int = 0
    siblings: int = 0
    of_kind: int = 0
    odds: float = 0.0
    markup: bool = False
    raw: bool = False
    yes: float = 0.0
    no: float = 0.0

    @property
    def place(self) -> tuple[str, int, int]:
        return self.kind, self.start, self.end


def read(text: str, without: set[tuple[str, int, int]] = frozenset()) -> tuple[list[Node], list[Node]]:
    """The roots of the tree of what could be markup, and the nodes that something else crossed, which is left out."""
    found: list[Node] = []
    for kind, pattern in PATTERNS.items():
        need = NEEDS.get(kind)
        if need is not None and need not in text or kind == "fence" and "```" not in text and "~~~" not in text:
            continue
        for m in pattern.finditer(text):
            found.append(Node(kind, m.start(), m.end(), m.start("in"), m.end("in"), m))
    opened: dict[str, list[Node]] = {}
    for n in sorted((n for n in found if n.kind == "tag"), key=lambda n: n.start):
        name = n.match["in"].lower()
        if text[n.start + 1] == "/":
            if opened.get(name):
                o = opened[name].pop()
                o.of_kind = n.of_kind = 1
                found.append(Node("element", o.start, n.end, o.end, n.start, o.match))
                if name in RAW:  # its content is code: a node of its own
                    found.append(Node("code", o.end, n.start, o.end, n.start, o.match, raw=True))
        else:
            opened.setdefault(name, []).append(n)
    found = [n for n in found if n.end > n.start and n.place not in without]
    found.sort(key=lambda n: (n.start, -n.end, ORDER.index(n.kind)))
    roots: list[Node] = []
    stack: list[Node] = []
    crossed: list[Node] = []
    for n in found:
        while stack and stack[-1].end <= n.start:
            stack.pop()
        if stack and n.end > stack[-1].end:
            crossed.append(stack[-1])
            continue
        if stack and (n.start, n.end) == (stack[-1].start, stack[-1].end) and n.kind != "row":
            continue  # the same stretch, read before
        n.depth = len(stack)
        (stack[-1].children if stack else roots).append(n)
        stack.append(n)
    return roots, crossed


def walk(nodes: list[Node]) -> Iterator[Node]:
    for n in nodes:
        yield n
        yield from walk(n.children)


def features(text: str, roots: list[Node]) -> tuple[list[Node], np.ndarray]:
    """All nodes and a row of features for each."""
    nodes: list[Node] = []
    rows: list[list[float]] = []
    level = [roots]
    while level:
        siblings = level.pop()
        count: dict[str, int] = {}
        for n in siblings:
            count[n.kind] = count.get(n.kind, 0) + 1
        for n in siblings:
            inner = text[n.low : n.high]
            size = max(len(inner), 1)
            before, after = text[n.start - 1 : n.start], text[n.end : n.end + 1]
            covered = sum(c.end - c.start for c in n.children)
            m = n.match
            groups = m.groupdict()
            name = m["in"].lower() if n.kind in ("tag", "element") else groups.get("n") or ""
            attr = groups.get("attr") or ""
            row = [float(n.kind == k) for k in ORDER]
            row += [n.depth, len(siblings), count[n.kind], len(inner), covered / size, float("\n" in inner)]
            row += [float(x) for x in (not before or before == "\n", not after or after in "\r\n", before.isspace(), after.isspace(), before.isalnum() and before.isascii(), after.isalnum() and after.isascii(), bool(WIDE.match(before)), bool(WIDE.match(after)), before == ":", before == "\\")]
            row += [float(inner[:1].isspace()), float(inner[-1:].isspace()), sum(c.isdigit() for c in inner) / size, sum(c.isascii() and c.isalpha() for c in inner) / size, len(WIDE.findall(inner)) / size]
            row += [float(x in inner) for x in ("\\", "=", "^", "_", ",", "|", "{", " ")]
            row += [float(inner[:1].isdigit()), float(inner[-1:].isdigit())]
            row += [float(name in TAGS), float(n.of_kind), float(bool(ATTRIBUTE.match(attr))), float(bool(VALUE.search(attr))), float(bool(attr.strip(" /"))), len(name), float(n.kind == "tag" and name != m["in"] and m["in"] != m["in"].upper())]
            row += [float(n.kind == "entity" and html.unescape(m[0]) != m[0]), float(n.kind in ("template", "wikilink") and bool(re.match(r"\s*[\d\[,. ]+$", inner)))]
            row += [float(len(groups.get("s") or groups.get("q") or groups.get("u") or groups.get("b") or "")), float(inner.count(" ") / size), float((groups.get("b") or "").rstrip(".)").isdigit())]
            nodes.append(n)
            rows.append(row)
            if n.children:
                level.append(n.children)
    return nodes, np.array(rows) if rows else np.empty((0, 0))


def _own(n: Node) -> list[Node]:
    """The tags of an element."""
    return [c for c in n.children if c.kind == "tag" and (c.start == n.start or c.end == n.end)] if n.kind == "element" else []


def decode(roots: list[Node]) -> None:
    """Labels of the most probable choice. Upwards, what each subtree gains with its root as markup and without; then downwards, the
    better of both, as far as what is above allows it."""
    for n in reversed(list(walk(roots))):  # children before parents
        tags = _own(n)
        inside = sum(max(c.yes, c.no) for c in n.children if c not in tags)
        n.yes, n.no = n.odds + sum(t.odds for t in tags) + inside, inside

    def put(n: Node, latex_only: bool, none: bool) -> None:
        if none:
            n.markup = False
        elif latex_only:
            n.markup = KINDS[n.kind][0] == "latex" and n.odds > 0
        else:
            n.markup = n.yes > n.no
        shut = none or n.markup and (n.raw or n.kind in VERBATIM)
        tags = _own(n)
        for c in n.children:
            put(c, latex_only or n.markup and n.kind in FORMULA, shut)
            if c in tags:
                c.markup = n.markup

    for n in roots:
        put(n, False, False)


def parse(texts: list[str], model: Boosted) -> list[list[Node]]:
    """The trees of the texts with their labels."""
    trees: list[list[Node]] = [[] for _ in texts]
    without: dict[int, set[tuple[str, int, int]]] = {i: set() for i in range(len(texts))}
    for _ in range(READINGS):
        nodes, rows, blocks = [], [], {}
        for i, left in without.items():
            trees[i], blocks[i] = read(texts[i], left)
            if trees[i]:
                n, x = features(texts[i], trees[i])
                nodes += n
                rows.append(x)
        if nodes:
            for n, odds in zip(nodes, model.log_odds(np.concatenate(rows))):
                n.odds = 12.0 if n.raw else float(odds)
        again = {}
        for i, left in without.items():
            decode(trees[i])
            idle = {b.place for b in blocks[i] if not b.markup}
            if idle:
                again[i] = left | idle
        without = again
        if not without:
            break
    return trees


def families(roots: list[Node]) -> set[str]:
    return {KINDS[n.kind][0] for n in walk(roots) if n.markup and not n.raw}


# clean text


def cleaned(text: str, roots: list[Node]) -> str:
    """The text without its markup. Headings begin with #, list items with -, table cells are parted by |, code stands in back
    quotes, formulas in $, the rest is as it was."""

    def inside(low: int, high: int, children: list[Node]) -> str:
        out, at = [], low
        for c in children:
            if c.start < at or c.end > high:
                continue
            out += [text[at : c.start], shown(c)]
            at = c.end
        return "".join(out) + text[at:high]

    def shown(n: Node) -> str:
        if not n.markup or n.raw:
            return inside(n.start, n.end, n.children)
        m, kind = n.match, n.kind
        if kind in ("fence", "code"):
            return m[0] if kind == "code" else f"```\n{m['in']}```"
        if kind == "element":
            return inside(n.start, n.end, n.children)
        inner = inside(n.low, n.high, n.children)
        if kind == "comment":
            return ""
        if kind == "tag":
            name, closing = m["in"].lower(), m[0][1] == "/"
            if name in RAW and name not in ("script", "style"):
                return "`"
            if name == "li":
                return "" if closing else "\n- "
            if re.fullmatch("h[1-6]", name):
                return "\n" if closing else "\n" + "#" * int(name[1]) + " "
            if name in ("td", "th"):
                return " | " if closing else ""
            if name == "img":
                alt = re.search(r"alt\s*=\s*[\"']([^\"']*)", m["attr"])
                return alt[1] if alt else ""
            return "\n" if name in BLOCKS and name != "p" or name == "p" and closing else ""
        if kind == "entity":
            return html.unescape(m[0])
        if kind in FORMULA:
            body = m["in"].strip()
            return f"$${body}$$" if kind in ("display", "bracket", "environment") else f"${body}$"
        if kind == "command":
            name = m["n"]
            if name in ("section", "subsection", "subsubsection", "chapter"):
                return "\n" + "#" * (2 + name.count("sub")) + " " + inner + "\n"
            return f"[{inner}]" if name in ("cite", "ref", "label", "eqref") else inner if name in ("emph", "textbf", "textit", "texttt", "underline", "text") else f"${m[0]}$"
        if kind == "bare":
            return f"${m[0]}$"
        if kind == "wikitable":
            rows = [re.sub(r"^[|!]+\s*", "", r).replace("||", "|").replace("!!", "|").strip() for r in inner.split("\n")[1:]]
            return "\n".join(r for r in rows if r and r.strip("-"))
        if kind == "template":
            head, _, rest = inner.partition("|")
            return f"({head.strip()}: {', '.join(x.strip() for x in rest.split('|'))})" if rest else f"({head.strip()})"
        if kind == "wikilink":
            return inner.rpartition("|")[2]
        if kind == "equals":
            return "#" * len(m["h"]) + " " + inner
        if kind == "heading":
            return m[0][: n.low - n.start].strip() + " " + inner
        if kind == "underline":
            return ("# " if m["u"][0] == "=" else "## ") + inner
        if kind == "rule":
            return ""
        if kind == "bullet":
            mark = m["b"] if m["b"][0].isdigit() else "-"
            return m[0][: m.start("b") - n.start] + mark + " " + re.sub(r"^\[[ xX]\]\s*", "", inner)
        if kind == "row":
            return "" if re.fullmatch(r"[\s|:-]+", inner) else inner.strip()
        if kind == "note":
            return f"[{inner}]" + (":" if m[0].endswith(":") else "")
        return inner

    return inside(0, len(text), roots)


# the classifier


def teach(rng: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """A generated text and the stretches of it that are markup, as (start, end, kind)."""
    kana = "数据索引事务日志缓存节点副本分区查询协议线程锁表页块流树图集合状态版本"
    syllables = ["ba", "ko", "ri", "te", "lu", "mon", "sa", "vi", "dra", "pel", "no", "ki"]

    def word() -> str:
        r = rng.random()
        if r < 0.45:
            return "".join(rng.choice(kana) for _ in range(rng.randint(1, 6)))
        if r < 0.9:
            return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))).capitalize() if rng.random() < 0.4 else "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
        return str(rng.randint(0, 99999))

    chinese = rng.random() < 0.6
    gap = "" if chinese else " "
    phrase = lambda k=4: (gap if rng.random() < 0.8 else " ").join(word() for _ in range(rng.randint(1, k)))
    w, n = word, lambda: rng.randint(0, 999)
    attr = lambda: rng.choice(["", f' class="{w()}"', f' style="color:rgb({n()},{n()},{n()});"', f" id='{w()}'", f' href="https://{w()}.example/{n()}"'])
    formula = lambda: rng.choice([f"{rng.choice('kxnp')}={n()}", f"O(n^{{{n()}}} \\log n)", f"x_{{{n()}}} \\le {n()}", f"\\alpha_{{{n()}}} = \\frac{{{n()}}}{{n}}", f"E = \\sum_{{i=1}}^{{{n()}}} w_i", f"a^{n() % 10} + b", "x", "n \\times m", f"f(x) = {n()}"])
    tag = lambda: rng.choice(["b", "i", "span", "font", "strong", "em", "a", "sup", "sub", "u", "p", "div", "small", "h3", "li", "td", "STRONG"])
    stars = lambda: rng.choice(["*", "**", "***", "_", "__", "~~"])

    def inline() -> tuple[str, str]:
        """A kind and a piece of markup within a line."""
        k = rng.choice(["tag", "tag", "tag", "void", "entity", "comment", "emphasis", "emphasis", "emphasis", "link", "image", "note", "code", "wikilink", "quotes", "template", "dollar", "paren", "command", "mixed"])
        if k == "tag":
            t = tag()
            return k, f"<{t}{attr()}>{phrase(3)}</{t}>" if rng.random() < 0.85 else f"<{t}{attr()}>" + phrase(3)
        if k == "void":
            return k, rng.choice(["<br>", "<br/>", "<BR />", "<hr>", f'<img src="https://{w()}/{n()}.png" alt="{w()}"/>'])
        if k == "entity":
            return k, rng.choice(["&nbsp;", "&lt;", "&gt;", "&quot;", "&amp;", "&#39;", "&copy;", f"&#x{rng.randint(0x4E00, 0x9FFF):x};", f"&#x{rng.randint(0x61, 0x7A):x};", f"&#{rng.randint(8000, 9000)};"]) + rng.choice(["", w()])
        if k == "comment":
            return k, f"<!-- {phrase(3)} -->"
        if k == "emphasis":
            s = stars()
            pad = " " if s[0] == "_" else ""
            return k, f"{pad}{s}{phrase(3)}{s}{pad}"
        return k, {
            "link": f"[{phrase(2)}](https://{w()}.example/p/{n()})", "image": f"![{w()}](https://{w()}.example/{n()}.png)", "note": f"[^{n() % 20}]", "code": f"`{phrase(2)}`",
            "wikilink": rng.choice([f"[[{phrase(2)}]]", f"[[{w()}|{phrase(2)}]]"]), "quotes": rng.choice([f"'''{phrase(3)}'''", f"''{phrase(3)}''"]), "template": rng.choice([f"{{{{{w()}|{w()}}}}}", f"{{{{cite|{phrase(2)}}}}}", f"{{{{{w()}}}}}"]),
            "dollar": f"${formula()}$", "paren": f"\\({formula()}\\)", "command": rng.choice([f"\\emph{{{phrase(3)}}}", f"\\textbf{{{phrase(2)}}}", f"\\cite{{ref{n()}}}", f"\\textit{{{w()}}}"]), "mixed": f"**[{w()}](https://{w()}/{n()})**",
        }[k]

    def innocent() -> str:
        """Signs in their literal sense."""
        a, b, c = rng.choice("abpqxyk"), rng.choice("bcqrmn"), rng.choice("cdrst")
        return rng.choice([
            f"{a}<{b} 与 {b}>{c}", f"{a} < {b} 且 {c} > {n()}", f"{a}<{b} and {b}>{c}", f"Map<K, V> 与 List<T>", f"List<{w()}> and Set<{c.upper()}>", f"Vec<T>", f"{n()} * {n()} * {n()}", f"{a} * {b} * {c}", f"{n()}*{n()}*{n()}",
            f"max_open_{w()} 与 min_{w()}_size", f"snake_case_name", f"__init__", f"$5 {w()}，{w()} $8 {w()}", f"${n()} {w()} ${n()} {w()}", f"费用是 ${n()} 起，另加 ${n()} 的{w()}", f"#{n()} {w()}", f"缺陷 #{n()}",
            f"{a} == {b}", f"{{ {w()} }}", f"{{{w()}}}", f"D:\\Temp\\{w()}", f"C:\\Users\\{w()}\\data", f"\\\\server\\{w()}", f"[[{n()}, {n()}], [{n()}, {n()}]]", f"[{n()}]与[{n()}]", f"R&D {w()}", f"AT&T {w()}; {w()}", f"{w()}[{n()}]", f"it isn't {w()}, it's {w()}", f"~{n()} {w()} ~{n()}",
            f"{n()} - {n()} - {n()}", f"→ {w()} -> {w()}", f"https://{w()}.example/{w()}_{w()}_{n()}", f"{w()}(x) ^ {n()}", f"a|b|c", f"`", f"5' 11\" ", f"''", f"{n()}% & {n()}%", f"C++ 与 C#", f"x[i][j]", f"rock 'n' roll", f"f(a, b)", f"{w()}: {w()}", f"5 > 3", f"!important", f"{a}_1 与 {b}_2", f"*{w()}", f"{w()}*",
        ])

    def block() -> str:
        """A piece of markup of whole lines."""
        rows = rng.randint(1, 3)
        return rng.choice([
            "\n".join(f"{rng.choice('-*+')} {phrase()}" for _ in range(rows)), "\n".join(f"{i + 1}. {phrase()}" for i in range(rows)), "\n".join(f"- [{rng.choice(' x')}] {phrase()}" for _ in range(rows)),
            f"{'#' * rng.randint(1, 6)} {phrase()}", f"{phrase()}\n{rng.choice('=-') * rng.randint(3, 8)}", "---", "***", f"> {phrase(8)}", "| " + " | ".join(w() for _ in range(3)) + " |\n| --- | :-: | --- |\n" + "\n".join("| " + " | ".join(w() for _ in range(3)) + " |" for _ in range(rows)),
            f"[^{n() % 9}]: {phrase()}", f"```{rng.choice(['', 'sql', 'text'])}\n{rng.choice([f'select {w()} from t where k < {n()}', f'{w()}[{n()}] = {w()}({n()})', f'# {w()}', f'<div id=x>{n()}</div>', f'List<{w()}> q = get({n()});', f'return x * {n()} * y', chr(92) + f'frac{{a}}{{{n()}}}', f'[[{w()}]] **{w()}**'])}\n```", f"~~~\n{w()} = {n()} * {n()} * {n()}\n~~~",
            f"== {phrase()} ==", f"=== {w()} ===", f"[[Category:{w()}]]", f"{{{{infobox\n|name={w()}\n|kind={w()}\n}}}}", f'{{| class="grid"\n|-\n! {w()}\n| {w()} || {n()}\n|}}',
            f"$$\n{formula()}\n$$", f"\\[ {formula()} \\]", f"\\begin{{equation}}\n{formula()}\n\\end{{equation}}", f"\\section{{{phrase()}}}", f"\\begin{{itemize}}\n\\item {phrase()}\n\\end{{itemize}}",
            f"<table><tr><td>{w()}</td><td>{n()}</td></tr></table>", f"<ul>\n<li>{w()}</li>\n<li>{w()}\n</ul>", f"<details>\n<summary>{w()}</summary>\n{phrase(6)}\n</details>", f'<div class="note">{phrase()}</div>', f"<p>{phrase(8)}</p>", f"<h{rng.randint(1, 6)}>{phrase()}</h2>", f"<pre>{w()} < {n()} * {n()}</pre>", f"<code>{w()}_{w()}_x</code>",
        ])

    text, marked = "", []
    for _ in range(rng.randint(1, 5)):
        r = rng.random()
        if r < 0.3:
            piece = block()
            marked.append((len(text), len(text) + len(piece), "block"))
            text += piece + "\n\n"
            continue
        line = phrase(6) + rng.choice(["", " ", "，"])
        for _ in range(rng.randint(1, 3)):
            if rng.random() < 0.5:
                kind, piece = inline()
                marked.append((len(text) + len(line), len(text) + len(line) + len(piece), kind))
            else:
                piece = innocent()
            line += piece + rng.choice(["", " ", "。", ", "]) + phrase(5) + rng.choice(["", " "])
        text += line + rng.choice(["。\n\n", ".\n", "\n\n"])
    return text, marked


@lru_cache(maxsize=2)
def model(sample: int = SAMPLE, seed: int = 7) -> Boosted:
    """The classifier, fitted on generated texts: a node is markup if it lies in a marked stretch and outside its code."""
    rng = random.Random(seed)
    rows, labels = [], []
    for _ in range(sample):
        text, marked = teach(rng)
        roots, _ = read(text)
        if not roots:
            continue
        code = [(n.low, n.high) for n in walk(roots) if n.kind in VERBATIM or n.raw]
        nodes, x = features(text, roots)
        for n, r in zip(nodes, x):
            if n.raw or any(low <= n.start and n.end <= high for low, high in code):
                continue  # decided by decoding
            inside = any(s <= n.start + (n.start < s and text[n.start].isspace()) and n.end <= e + 1 for s, e, _ in marked)
            rows.append(r)
            labels.append(float(inside))
    return Boosted().fit(np.array(rows), np.array(labels))


# over tables


def _body(t: str | None, frame: bool) -> tuple[str, str]:
    """The text below the frame, which is four lines, and the frame."""
    if not t:
        return "", ""
    if not frame or not t.startswith("[来源]"):
        return t, ""
    at = 0
    for _ in range(4):
        at = t.find("\n", at) + 1
        if not at:
            return "", t
    return t[at:], t[:at]


def found(df: DataFrame, keys: list[str], text: str, framed: str) -> DataFrame:
    """(keys, family): once per row and family of markup that it holds. ``framed``: column that tells whether there is a frame."""
    return _over(df, keys, text, framed, False)


def clean(df: DataFrame, keys: list[str], text: str, framed: str) -> DataFrame:
    """(keys, text): the clean texts; frames stay as they are."""
    return _over(df, keys, text, framed, True)


def _over(df: DataFrame, keys: list[str], text: str, framed: str, whole: bool) -> DataFrame:
    trees = model()
    slim = df.select(*keys, F.col(text).alias("t"), F.col(framed).alias("framed"))
    at = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 1000):
                part = b.slice(low, 1000)
                texts = part.column(at).to_pylist()
                bodies = [_body(t, f) for t, f in zip(texts, part.column(at + 1).to_pylist())]
                plain = [x.replace("\r\n", "\n") for x, _ in bodies]
                parsed = parse(plain, trees)
                if whole:
                    out = [None if t is None else frame + cleaned(p, roots) for t, (_, frame), p, roots in zip(texts, bodies, plain, parsed)]
                    yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(out, pa.string())], names=[*keys, "text"])
                    continue
                row, family = [], []
                for i, roots in enumerate(parsed):
                    for f in sorted(families(roots)):
                        row.append(i)
                        family.append(f)
                kept = part.take(pa.array(row, pa.int32()))
                yield pa.RecordBatch.from_arrays([*kept.columns[:at], pa.array(family, pa.string())], names=[*keys, "family"])

    last = T.StructField("text" if whole else "family", T.StringType())
    return slim.mapInArrow(run, T.StructType([*slim.schema.fields[:at], last]))

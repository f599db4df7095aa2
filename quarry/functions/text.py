"""Text functions as Catalyst expressions: markup stripped, normal form, fingerprints, slugs, canonical fields.

Whitespace is the 29 code points that Unicode and the C0 separators make, spelled ``[\\s\\x1c-\\x1f]`` under ``(?U)``; ``$`` and ``.``
are never left to Java's wider line ends. All functions take null to null unless they say otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.contract import DIFFICULTIES, DIFFICULTY_NAMES, FALSE_WORDS, FREQUENCIES, LABELS, SCORES, TRUE_WORDS, TYPE_NAMES, TYPES

SPACE = r"(?U)[\s\x1c-\x1f]"
COMMENT = r"(?s)<!--.*?-->"
TAG = r"</?[A-Za-z][^<>]{0,300}>"
#: References that are resolved, in this order.
REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
MARKS = "`*_>"


def strip(c: Column) -> Column:
    """Without whitespace at either end."""
    return F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def strip_html(c: Column) -> Column:
    """Without comments and tags, with the common references resolved; null is empty."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), COMMENT, ""), TAG, "")
    return reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), REFERENCES, bare)


def norm(c: Column) -> Column:
    """The form in which texts are compared: no markup, no whitespace, no marks, lower case; null is empty."""
    return F.lower(F.translate(F.regexp_replace(strip_html(c), SPACE + "+", ""), MARKS, ""))


def fingerprint(stem: Column, kind: Column) -> Column:
    """Sixteen hex digits of the normal stem and the type; a null type counts as the word NONE."""
    return F.substring(F.sha1(F.concat(norm(stem), F.lit("|"), F.upper(F.coalesce(kind, F.lit("NONE"))))), 1, 16)


def content_fingerprint(options: Column, answer: Column, analysis: Column, difficulty: Column, score: Column, category: Column, tags: Column) -> Column:
    """Sixteen hex digits of everything but stem and type; null and zero count as empty, the order of tags doesn't count."""
    empty = F.lit("")
    parts = [
        F.coalesce(F.array_join(F.transform(options, lambda o: F.concat(F.coalesce(o["label"], F.lit("None")), F.lit(":"), norm(o["content"]))), "|"), empty),
        F.coalesce(F.array_join(answer, ","), empty),
        norm(analysis),
        F.coalesce(difficulty, empty),
        F.when(score == 0, "").otherwise(F.coalesce(score.cast("string"), empty)),
        F.coalesce(category, empty),
        F.coalesce(F.array_join(F.array_sort(tags), ","), empty),
    ]
    return F.substring(F.sha1(F.concat_ws("\n", *parts)), 1, 16)


def slug(c: Column, longest: int = 60) -> Column:
    """A name for files and ids; null and what leaves nothing become ``untitled``."""
    s = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r'[\\/:*?"<>|\n\r\t]+', "_"))
    s = F.regexp_replace(F.regexp_replace(s, SPACE + "+", "-"), r"\A-+|-+\z", "")
    return F.substring(F.when(s == "", "untitled").otherwise(s), 1, longest)


def strip_numbering(c: Column) -> Column:
    """Without a leading number, such as 1.2 or 第三章; null is empty."""
    s = strip(F.coalesce(c, F.lit("")))
    s = F.regexp_replace(s, r"(?U)\A\d+(?:[.\-_]\d+)*[\s\x1c-\x1f.\-_、]+", "")
    return strip(F.regexp_replace(s, r"(?U)\A第[一二三四五六七八九十百]+[章节部分篇][\s\x1c-\x1f.\-_、]*", ""))


def clean_title(c: Column) -> Column:
    """Without markup, rules and signs at the ends; whitespace made single."""
    s = F.regexp_replace(strip_html(c), r"[-=_*~#]{3,}", " ")
    s = F.regexp_replace(s, r"(?U)\A[\s\x1c-\x1f\-=_*~#]+|[\s\x1c-\x1f\-=_*~#]+\z", "")
    return strip(F.regexp_replace(s, SPACE + "+", " "))


def mode(title: Column, forced: str = "auto") -> Column:
    """qa for titles that ask, else prose; title is a clean one."""
    from quarry.contract import QUESTION_WORDS

    if forced != "auto":
        return F.lit(forced)
    asks = title.rlike(r"[?？]\z") | title.rlike("|".join(QUESTION_WORDS))
    return F.when((title == "") | (F.length(title) > 40), "prose").when(asks, "qa").otherwise("prose")


def _lookup(names: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def canonical_type(c: Column) -> Column:
    """One of the types, or null."""
    up = F.upper(strip(c))
    return F.when(c.isNotNull(), F.coalesce(_lookup(TYPE_NAMES, norm(c)), F.when(up.isin(*TYPES), up)))


def canonical_difficulty(c: Column) -> Column:
    """One of the difficulties; what is unknown or null is MEDIUM."""
    up = F.upper(strip(c))
    return F.coalesce(_lookup(DIFFICULTY_NAMES, norm(c)), F.when(up.isin(*DIFFICULTIES), up), F.lit("MEDIUM"))


def default_score(difficulty: Column) -> Column:
    return _lookup({k: str(v) for k, v in SCORES.items()}, difficulty).cast("int")


def canonical_answer(answers: Column) -> Column:
    """Distinct labels of an array of answers, each of which may list several; null is empty."""
    split = F.flatten(F.transform(answers, lambda a: F.split(F.coalesce(a, F.lit("None")), r"(?U)[,，、;；\s\x1c-\x1f]+")))
    upper = F.transform(split, lambda a: F.regexp_replace(F.upper(strip(a)), r"\A[（(]?([A-F])[)）]?\z", "$1"))
    return F.coalesce(F.array_distinct(F.filter(upper, lambda a: a.isin(*LABELS))), F.array().cast("array<string>"))


def side(content: Column) -> Column:
    """T or F for the wordings of a JUDGE option, else null."""
    n = norm(content)
    return F.when(n.isin(*TRUE_WORDS), "T").when(n.isin(*FALSE_WORDS), "F")


def content_tags(tags: Column) -> Column:
    """The trimmed tags that are no frequency; null is empty."""
    return F.coalesce(F.filter(F.transform(tags, strip), lambda t: (t != "") & ~t.isin(*FREQUENCIES)), F.array().cast("array<string>"))


def frequency_tags(tags: Column) -> Column:
    """The frequencies among the tags; null is empty."""
    return F.coalesce(F.filter(F.transform(tags, strip), lambda t: t.isin(*FREQUENCIES)), F.array().cast("array<string>"))


def ordinal(options: Column) -> Column:
    """Whether an option's text begins with a number, so that the order of options means something."""
    return F.coalesce(F.exists(options, lambda o: F.coalesce(o["content"], F.lit("")).rlike(r"(?U)\A[\s\x1c-\x1f]*(?:[0-9０-９]|[（(]?[一二三四五六七八九][)）])")), F.lit(False))


def labelled(contents: Column) -> Column:
    """Options of up to six contents, labelled in order."""
    return F.transform(F.slice(contents, 1, len(LABELS)), lambda c, i: F.struct(F.substring(F.lit("".join(LABELS)), i + 1, F.lit(1)).alias("label"), c.alias("content")))

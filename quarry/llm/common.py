"""What the operators of this subpackage share: table access and the canonical form of questions."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

NOT_WORD = re.compile(r"\W+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def canonical(text: str | None) -> str:
    """Compatibility forms unified, lower case, without whatever is not a letter, digit or underscore; null is empty."""
    if not text:
        return ""
    return NOT_WORD.sub("", text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).lower())


def parts_of(kind: str | None, stem: str | None, options: Iterable[dict] | None) -> list[str]:
    """The raw texts that a question is compared by: the stem and, but for JUDGE, the content of each option."""
    parts = [stem or ""]
    if kind != "JUDGE":
        parts += [(o or {}).get("content") or "" for o in options or ()]
    return parts


def bigrams(parts: Iterable[str]) -> dict[str, int]:
    """Two-character sequences of canonical parts with their multiplicity."""
    counts: dict[str, int] = {}
    for p in parts:
        for i in range(len(p) - 1):
            g = p[i : i + 2]
            counts[g] = counts.get(g, 0) + 1
    return counts


def numbered(parts: Iterable[str]) -> set[str]:
    """The same as a set, each repetition with its number, so that what two have in common is the size of an intersection."""
    grams = [p[i : i + 2] for p in parts for i in range(len(p) - 1)]
    out = set(grams)
    if len(out) < len(grams):
        seen: dict[str, int] = {}
        for g in grams:
            n = seen[g] = seen.get(g, 0) + 1
            if n > 1:
                out.add(g + str(n))
    return out


def alike(a: dict[str, int], b: dict[str, int], share: float) -> bool:
    """Whether the sequences in common are at least ``share`` of the mean count; two empty rows are not alike."""
    na, nb = sum(a.values()), sum(b.values())
    if na + nb == 0 or 2 * min(na, nb) < share * (na + nb) - 1e-9:
        return False
    if len(a) > len(b):
        a, b = b, a
    common = sum(min(n, b.get(g, 0)) for g, n in a.items())
    return 2 * common >= share * (na + nb) - 1e-9


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Path of a public tokenizer's file; the folder is a parameter, else PUBLIC_TOKENIZERS, else /opt/tokenizers."""
    return os.path.join(folder or os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers"), name)

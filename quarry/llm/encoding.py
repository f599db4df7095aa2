"""Problem 6: encoding of the whole corpus with a public tokenizer.

The tokenizers library works on Arrow batches inside ``mapInArrow``: one pass over the column, no shuffle, ids straight
back as Arrow lists. ``encode`` gives the ids, ``with_offsets`` the character span of every token too, and ``decode``
reverses the byte table of byte-level BPE.

Defined cases: a null and an empty text give the empty list, and an empty list decodes to the empty text. Strings of special
tokens inside a text are ordinary text. A character that several tokens share gives each of them the same span.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import tokenizer_file

DEFAULT = "byte_bpe_50k.json"
#: Characters handed to the library at once: an encoding of a text takes some fifty times its size in memory.
CHUNK_CHARS = 200_000
_loaded: dict = {}


def _tokenizer(path: str):
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _loaded[path] = t
    return _loaded[path]


def chunks(texts: list[str | None]) -> Iterator[list[str]]:
    """Runs of texts of about CHUNK_CHARS characters; null becomes empty."""
    run, size = [], 0
    for t in texts:
        run.append(t or "")
        size += len(run[-1])
        if size >= CHUNK_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _lists(ids: list[list[int]]) -> pa.Array:
    offsets, flat = [0], []
    for x in ids:
        flat.extend(x)
        offsets.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def encode(df: DataFrame, key: str, text: str, file: str = DEFAULT, folder: str | None = None) -> DataFrame:
    """(key, ids): one row per row of ``df``; other columns are ignored, whatever their names."""
    path = tokenizer_file(file, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(path)
        for b in batches:
            at = 0
            for texts in chunks(b.column(1).to_pylist()):
                got = [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), _lists(got)], names=["k", "ids"])
                at += len(texts)

    slim = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = slim.mapInArrow(run, T.StructType([T.StructField("k", slim.schema["k"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.withColumnRenamed("k", key)


def with_offsets(df: DataFrame, key: str, text: str, file: str = DEFAULT, folder: str | None = None) -> DataFrame:
    """(key, ids, starts, ends): ids with the code-point span of each token, end exclusive."""
    path = tokenizer_file(file, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokenizer(path)
        for b in batches:
            at = 0
            for texts in chunks(b.column(1).to_pylist()):
                got = t.encode_batch(texts, add_special_tokens=False)
                cols = [_lists([e.ids for e in got]), _lists([[s for s, _ in e.offsets] for e in got]), _lists([[s for _, s in e.offsets] for e in got])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), *cols], names=["k", "ids", "starts", "ends"])
                at += len(texts)

    slim = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    ints = T.ArrayType(T.IntegerType())
    out = slim.mapInArrow(run, T.StructType([T.StructField("k", slim.schema["k"].dataType), *(T.StructField(c, ints) for c in ("ids", "starts", "ends"))]))
    return out.withColumnRenamed("k", key)


def byte_of_char() -> dict[str, int]:
    """The byte table of byte-level BPE, by its rule: printable Latin-1 stands for itself, the other bytes for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every token, by id."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    back = byte_of_char()
    table = [b""] * (1 + max([*data["model"]["vocab"].values(), *(a["id"] for a in data.get("added_tokens", ()))]))
    for token, i in data["model"]["vocab"].items():
        table[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    for a in data.get("added_tokens", ()):
        table[a["id"]] = a["content"].encode()
    return table


def decode(ids: Column, file: str = DEFAULT, folder: str | None = None) -> Column:
    """Text of a list of ids. Bytes are joined before they are decoded, so that characters split over tokens come out whole;
    a list cut inside a character gives U+FFFD for the rest; null gives null, an id outside the vocabulary nothing."""
    path = tokenizer_file(file, folder)

    @F.pandas_udf(T.StringType())
    def text_of(lists: pd.Series) -> pd.Series:
        if ("bytes", path) not in _loaded:
            _loaded["bytes", path] = token_bytes(path)
        table = _loaded["bytes", path]
        return lists.map(lambda x: None if x is None else b"".join(table[i] for i in x if 0 <= i < len(table)).decode("utf-8", "replace"))

    return text_of(ids)

"""Encoding of all texts with a public byte-level BPE tokenizer, as a monoid tree reduction, and decoding up the same tree.

A text is halved until the parts are short; the leaves are encoded, and neighbours are joined by encoding again a window
around the seam. The window grows to both sides until it ends at *sync points*, where a piece of the tokenizer's pattern ends whatever
stands around it: before a blank or line feed that follows anything but white space, and, for texts without blanks, between a letter and
a sign that never continues it. Pieces are encoded apart, so the tokens before the window's start and from
its end on are provably those of the joined text, and the join is associative. Where a side has no sync point, the window
grows to the whole side. Decoding concatenates the bytes of halves.

Scale: short texts are encoded in one narrow Arrow stage. A text over ``split_chars`` is cut into leaf rows that are
spread over all tasks; their token lists are merged per row in tree order. No special tokens: their strings are plain
text. Empty texts give an empty list, null texts null.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordmill.session import ship_package

TOKENIZERS = "/opt/tokenizers"
LEAF_CHARS = 1 << 14
SPLIT_CHARS = 1 << 20
# Fixed value: the public pattern that splits a text into the pieces that are encoded apart.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SYNC = re.compile(r"(?<=\S)(?=[ \n])|(?<=[A-Za-z])(?=[0-9.,;:!?])|(?<=[\u4e00-\u9fff\u3041-\u3096\u30a1-\u30fa\uac00-\ud7a3])(?=[\u3001\u3002\uff01\uff0c\uff1f])")


@lru_cache(4)
def encoder(folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """The tokenizer ``name`` of ``folder``, read on each worker; its files are not part of this repository."""
    import tiktoken

    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _drop_bytes(enc, ids: list[int], n_bytes: int, from_end: bool) -> list[int]:
    """ids without the tokens of the last (or first) n_bytes; the cut is at a token boundary."""
    at, left = (len(ids), n_bytes) if from_end else (0, n_bytes)
    while left > 0:
        if from_end:
            at -= 1
            left -= len(enc.decode_single_token_bytes(ids[at]))
        else:
            left -= len(enc.decode_single_token_bytes(ids[at]))
            at += 1
    return ids[:at] if from_end else ids[at:]


def join_encoded(enc, left: str, left_ids: list[int], right: str, right_ids: list[int], reach: int = 64) -> list[int]:
    """The ids of left + right from those of both."""
    if not left or not right:
        return left_ids + right_ids
    lo, width = 0, reach
    while width < 2 * len(left):
        found = [m.start() for m in SYNC.finditer(left, max(0, len(left) - width), len(left) - 1)]
        if found:
            lo = found[-1]
            break
        width *= 4
    hi = len(right)
    m = SYNC.search(right, 1)
    if m:
        hi = m.start()
    head = _drop_bytes(enc, left_ids, len(left[lo:].encode()), True) if lo else []
    tail = _drop_bytes(enc, right_ids, len(right[:hi].encode()), False) if hi < len(right) else []
    return head + enc.encode_ordinary(left[lo:] + right[:hi]) + tail


def encode_tree(enc, text: str, leaf: int = LEAF_CHARS) -> list[int]:
    """The ids of text by halving."""
    if len(text) <= leaf:
        return enc.encode_ordinary(text)
    mid = len(text) // 2
    return join_encoded(enc, text[:mid], encode_tree(enc, text[:mid], leaf), text[mid:], encode_tree(enc, text[mid:], leaf))


def _merge_tree(enc, parts: list[tuple[str, list[int]]]) -> list[int]:
    while len(parts) > 1:
        parts = [
            (a[0] + b[0], join_encoded(enc, *a, *b)) if b else a
            for a, b in ((parts[k], parts[k + 1] if k + 1 < len(parts) else None) for k in range(0, len(parts), 2))
        ]
    return parts[0][1]


def decode_tree(enc, ids: list[int], leaf: int = LEAF_CHARS) -> bytes:
    """The bytes of ids by halving; a character may lie across a seam, so text is made of the whole only."""
    if len(ids) <= leaf:
        return enc.decode_bytes(ids)
    mid = len(ids) // 2
    return decode_tree(enc, ids[:mid], leaf) + decode_tree(enc, ids[mid:], leaf)


def _slim(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _is_long(split_chars: int):
    return F.coalesce(F.length("text") > split_chars, F.lit(False))


def _encode_long(slim: DataFrame, folder: str, name: str, split_chars: int, leaf: int) -> DataFrame:
    """doc_id, ids of the texts over ``split_chars``; rows are told apart by where they are, not by doc_id."""

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for b in batches:
            ids = [encode_tree(enc, t, leaf) for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32()))], ["row", "doc_id", "part", "text", "ids"])

    def merge(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        ids = _merge_tree(encoder(folder, name), list(zip(t.column("text").to_pylist(), t.column("ids").to_pylist())))
        return pa.table({"doc_id": t.column("doc_id")[:1], "ids": pa.array([ids], pa.list_(pa.int32()))})

    n_parts = F.ceil(F.length("text") / split_chars).cast("int")
    rows = slim.withColumn("row", F.monotonically_increasing_id()).filter(_is_long(split_chars))
    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1)))
    leaves = parts.select("row", "doc_id", "part", F.expr(f"substring(text, part * {split_chars} + 1, {split_chars})").alias("text")).repartition("row", "part")
    return leaves.mapInArrow(encode_leaves, "row long, doc_id long, part int, text string, ids array<int>").groupBy("row").applyInArrow(merge, "doc_id long, ids array<int>")


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, name: str = "byte_bpe_50k", split_chars: int = SPLIT_CHARS, leaf: int = LEAF_CHARS) -> DataFrame:
    """doc_id, ids: one row per row of df. Other columns are ignored; repeated ids keep one row per row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for b in batches:
            ids = [None if t is None else encode_tree(enc, t, leaf) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    slim = _slim(df, id_col, text_col)
    short = slim.filter(~_is_long(split_chars)).mapInArrow(encode, "doc_id long, ids array<int>")
    return short.unionByName(_encode_long(slim, folder, name, split_chars, leaf))


def decode_texts(encoded: DataFrame, folder: str = TOKENIZERS, name: str = "byte_bpe_50k", leaf: int = LEAF_CHARS) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids give a null text, an empty list an empty one. Bytes that are no UTF-8 become replacement characters."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for b in batches:
            texts = [None if ids is None else decode_tree(enc, ids, leaf).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS, name: str = "byte_bpe_50k", split_chars: int = SPLIT_CHARS, leaf: int = LEAF_CHARS) -> DataFrame:
    """doc_id, n_tokens; null texts count 0. The ids are dropped where they are made; texts over ``split_chars`` are split as in encode_texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        for b in batches:
            n = [0 if t is None else len(encode_tree(enc, t, leaf)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    slim = _slim(df, id_col, text_col)
    short = slim.filter(~_is_long(split_chars)).mapInArrow(count, "doc_id long, n_tokens long")
    return short.unionByName(_encode_long(slim, folder, name, split_chars, leaf).select("doc_id", F.size("ids").cast("long").alias("n_tokens")))

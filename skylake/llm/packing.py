"""Packing of tokenized documents into fixed windows by best-fit decreasing.

A document is its token ids followed by the end id. Documents longer than a window are first cut into full windows; what
is left of each is packed: longest first, each piece into the tightest open window that it fits in. A segment tree
over the remaining capacities (1 to the window size) finds that window in about log2(window) steps, however
many windows are open. Pieces are dealt out evenly to shards of about SHARD pieces and every shard is packed on its own, so
packing spreads over the cluster; a shard leaves at most a few windows unfilled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylake.llm.common import settle_counted

WINDOW = 1024
END = 0
SHARD = 20_000
VOCABULARY = "byte_bpe_50k"
SEGMENT = 1 << 20
# Letters, marks and signs that both tokenizer libraries are known to class alike; others take the slower one.
_PLAIN = regex.compile(r"[\x00-\x7E\xA1-\xAC\xAE-ɏ‐-‧‰-⁞€]*+")
_CUT = regex.compile(r"(?<=\S) (?=\S)")


class Tokens:
    """Ids of the vocabulary file that `tokenizers` gives, without special tokens added.

    `tiktoken` holds the same ranks and is some four times as fast, so it encodes texts of ordinary letters and signs; texts
    with other code points, or that spell a special token, go to `tokenizers` itself. The tests hold both against each other.
    Long texts are encoded in segments cut before a single space between two words, which no token spans.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > SEGMENT + SEGMENT // 2:
                cut = _CUT.search(text, at + SEGMENT)
                end = cut.start() if cut else end
            part = text[at:end]
            if _PLAIN.fullmatch(part) and not any(s in part for s in self.special):
                parts.append(np.array(self.fast.encode_ordinary(part), "<u4"))
            else:
                parts.append(np.array(self.exact.encode(part, add_special_tokens=False).ids, "<u4"))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")


_SCHEMA = "__doc {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, __row bigint"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Full windows and rests of all documents: `__doc`, start, length, ids_crc32, doc_tokens, `__row` (a hash of id and text);
    with `with_ids` the ids as well. Null texts are empty: they hold the end id alone."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("__doc"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("__row"))
    schema = _SCHEMA.format(id=id_type) + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for batch in batches:
            out: list[list] = [[] for _ in range(7 if with_ids else 6)]
            for doc, text, row in zip(*(batch.column(k) for k in range(3))):
                ids = np.append(tokens.encode(text.as_py()), np.uint32(END)).astype("<u4")
                for at in range(0, len(ids), window):
                    part = ids[at:at + window]
                    values = [doc.as_py(), at, len(part), zlib.crc32(part.tobytes()), len(ids), row.as_py()]
                    for column, value in zip(out, [*values, part.astype(np.int64)]):
                        column.append(value)
            types = [batch.schema.field(0).type, *[pa.int64()] * 5, *[pa.list_(pa.int64())] * with_ids]
            names = ["__doc", "start", "length", "ids_crc32", "doc_tokens", "__row", *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return rows.mapInArrow(run, schema)


class CapacityTree:
    """Open windows by remaining capacity: a segment tree whose leaves count the windows of each capacity."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, change: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest capacity of at least `length` that some window has."""
        node = length + self.leaves
        if self.count[node]:
            return length
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; the lengths come longest first."""
    tree, open_, used, where, offset = CapacityTree(window), {}, 0, [], []
    for n in lengths:
        capacity = tree.tightest(n)
        if capacity is None:
            at, capacity = used, window
            used += 1
        else:
            at = open_[capacity].pop()
            tree.add(capacity, -1)
        where.append(at)
        offset.append(window - capacity)
        if capacity > n:
            open_.setdefault(capacity - n, []).append(at)
            tree.add(capacity - n, 1)
    return where, offset


def pack(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """`pieces` to the same rows with `sequence_id` and `offset`. Full windows are sequences by themselves; the rests are
    packed shard by shard. Equal rows are told apart by nothing, so they take places in any order."""
    table, seen = settle_counted(found, "pieces", rests=F.sum((F.col("length") < window).cast("bigint")))
    shards = max(1, -(-seen["rests"] // SHARD))
    # Dealt out by place in the written table, so that equal rows spread as well.
    rest = table.where(F.col("length") < window).withColumn(
        "__shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("bigint"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema) + ", sequence_id bigint, offset bigint"

    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "__row", "start"], ascending=[False, True, True], kind="stable")
        where, offset = best_fit(shard["length"].tolist(), window)
        number = int(shard["__shard"].iloc[0]) if len(shard) else 0
        return shard.drop(columns="__shard").assign(sequence_id=[2 * ((number << 32) + w) for w in where], offset=offset)

    packed = rest.groupBy("__shard").applyInPandas(run, schema)
    full = table.where(F.col("length") == window).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return full.union(packed.select(*full.columns))


def op5_packing(docs: DataFrame) -> DataFrame:
    packed = pack(pieces(docs))
    return packed.select(F.col("__doc").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

"""Near copies by SimHash: a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so they share
at least 5 positional bytes. Posting lists of single (position, byte) pairs would hold a 256th of all
fingerprints each, so the index is kept on joint postings: three positions of one half of the fingerprint.
Of 5 shared positions 3 lie in one half, so 8 joint postings (4 triples in each half) meet every pair. Inside
a posting list the shared positional bytes are tallied per pair, pairs with 5 or more are kept, and those
are verified by their differing bits.

A list that is too long (copies with many slightly differing fingerprints) is split by two more positions, and
if still too long by three of the six half-bytes that are left; 12 bits are then free, so no list holds more
than 4,096 different fingerprints. Every level meets all pairs of the list that it splits, so nothing is lost.
Each list gives its spanning links only, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylake.llm.common import packed, row_key, settle_counted
from skylake.llm.graph import components
from skylake.session import settle

BITS = 3
SHARED = 8 - BITS
MAX_LIST = 4096
BLOCK = 1 << 16


def _byte_mask(positions) -> int:
    return sum(0xFF << (8 * p) for p in positions)


TRIPLES = [_byte_mask(t) for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
PAIRED = {m: [m | _byte_mask(p) for p in combinations([i for i in range(8) if not m >> (8 * i) & 1], 2)] for m in TRIPLES}
FIVES = sorted({m for masks in PAIRED.values() for m in masks})
NIBBLED = {
    m: [m | sum(0xF << (4 * p) for p in t) for t in combinations([i for i in range(16) if not m >> (4 * i) & 1], 3)]
    for m in FIVES
}


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """SimHash of the UTF-8 text as an unsigned number; 0 where there is no word.

    A-Z is lower-cased, words are split at ASCII white space; a bit is set if it is set in over half of the
    XXH64 (seed 42) hashes of the `shingle`-word shingles, repeats included. Hashes are counted in blocks, so
    memory follows the text and not 64 times its words.
    """
    words = (data or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[len(words) - n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        some = [digest(joined[a:b], 42) for a, b in zip(first[at:at + BLOCK], last[at:at + BLOCK])]
        bits = np.unpackbits(np.array(some, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (`__id`, `__th`, id, fp) per row of `docs`; fp is the fingerprint as a signed bigint."""
    key = row_key(id_col, text_col)
    wanted = docs.select(*key, F.col(id_col).alias("__doc"), F.col(text_col).cast("binary").alias("__text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([fingerprint(t.as_py()) for t in b.column(3)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(found)],
                                             names=["__id", "__th", "__doc", "fp"])

    kind = wanted.schema["__id"].dataType.simpleString()
    return wanted.mapInArrow(run, f"__id {kind}, __th bigint, __doc {id_type}, fp bigint")


def spanning_links(list_: np.ndarray) -> list[tuple[int, int]]:
    """Links that tie together what is linked inside one posting list of different fingerprints.

    From each fingerprint in turn the unreached ones are tallied: 5 or more equal positional bytes, then 3 or
    fewer differing bits. At most one link per fingerprint comes out.
    """
    rest, links = list_, []
    while rest.size > 1:
        front, rest = [rest[0]], rest[1:]
        while front and rest.size:
            at = front.pop()
            x = rest ^ at
            near = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= SHARED
            near[near] = np.bitwise_count(x[near]) <= BITS
            new = rest[near]
            links += [(int(at), int(y)) for y in new]
            front += list(new)
            rest = rest[~near]
    return links


def _lists(keyed: DataFrame, label: str) -> tuple[DataFrame, DataFrame, int]:
    """Posting lists of two or more as arrays; the rows of those that are too long; the longest list."""
    sizes, seen = settle_counted(
        keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), label, longest=F.max("size"))
    sized = keyed.join(sizes, ["mask", "bits"])
    short = sized.where(F.col("size") <= MAX_LIST).groupBy("mask", "bits").agg(F.collect_list("fp").alias("list"))
    return short, sized.where(F.col("size") > MAX_LIST).select("mask", "fp"), seen["longest"]


def _under(rows: DataFrame, masks) -> DataFrame:
    return rows.select("fp", F.explode(masks).alias("mask")).distinct().select(
        "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits"))


def _deeper(table: dict[int, list[int]]):
    lit = {m: F.array(*(F.lit(_signed(x)) for x in masks)) for m, masks in table.items()}
    return F.create_map(*(x for m, masks in lit.items() for x in (F.lit(_signed(m)), masks)))[F.col("mask")]


def links(classes: DataFrame) -> DataFrame:
    """Different fingerprints `fp` to links (u, v) that connect exactly what pairs at `BITS` or fewer bits connect."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            lists, flat = b.column(0), b.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at = 0
            for size in np.diff(lists.offsets.to_numpy()).tolist():
                found += spanning_links(np.sort(flat[at:at + size]))
                at += size
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    first = F.array(*(F.lit(_signed(m)) for m in TRIPLES))
    found, rows = [], classes.select("fp")
    for step, masks in enumerate((first, _deeper(PAIRED), _deeper(NIBBLED))):
        short, rows, longest = _lists(_under(rows, masks), f"lists{step}")
        found.append(short.select("list").mapInArrow(run, "u bigint, v bigint"))
        if longest <= MAX_LIST:
            break
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: `__id`, `__th`, `__doc` (its id), `fp`, and `component`: the smallest id reachable over links.

    Equal fingerprints are one class before anything is paired, however many rows hold them. Null and empty texts
    have fingerprint 0 and are linked like any other. Rows with a null id get a component like all others; it
    is null only where no id is reachable. An empty table gives no rows.
    """
    rows = settle(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = settle(rows.groupBy("fp").agg(F.min("__doc").alias("least")), "classes")
    return named(rows, classes, links(classes))


def named(rows: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """`rows` with the component of each: `label`, its least `fp`, and `component`, the least id (`least` of `classes`) reachable over the links
    (u, v) of their `fp`. Ids may be null or repeat, so only the label tells components apart."""
    label = components(linked)
    joined = classes.join(label, classes["fp"] == label["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label"))
    smallest = joined.groupBy("label").agg(F.min("least").alias("component"))
    found = joined.join(smallest, "label").select("fp", "label", "component")
    return rows.join(found, "fp").select("__id", "__th", "__doc", "fp", "label", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule=near_copies) -> DataFrame:
    """`docs` with one row of each component: that of the smallest id, the smaller text hash first; equal rows
    count as one. A row without an id stays only where its component has no id at all, and then one."""
    found = rule(docs, id_col, text_col)
    best = found.groupBy("label").agg(F.min_by(F.struct("__id", "__th"), F.struct(F.col("__doc").isNull(), "__id", "__th")).alias("__k"))
    kept = best.select(F.col("__k.__id").alias("__ki"), F.col("__k.__th").alias("__kt"))
    marked = docs.select(packed(docs), *row_key(id_col, text_col))
    same = (F.col("__id") == F.col("__ki")) & (F.col("__th") == F.col("__kt"))
    return marked.join(kept, same, "left_semi").dropDuplicates(["__id", "__th"]).select("__row.*")


def op2_simhash(docs: DataFrame) -> DataFrame:
    return near_copies(docs).select(
        F.col("__doc").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"))

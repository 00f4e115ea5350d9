"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its lower-cased words with their counts. For every sample k and word w, r and c are drawn from Gamma(2, 1) and b
uniformly, all from a hash of (w, k) alone. With weight s: t = floor(ln s / r + b) and ln a = ln c - r (t - b + 1). The sample is
(w, t) of the word with the least a, so two texts agree in a sample with the probability of their generalised Jaccard
similarity: the sum of the smaller weights over the sum of the larger ones. A fingerprint holds 16 bits of each sample.

Neighbours by id are met without ordering the corpus in one task: a first pass over the ids alone deals them into ranges, then every text
goes, compressed, to its range, and the first text of each range also to the range before, as the follower of its last one. Inside a
range rows are streamed in order, two texts at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLES = 64
CACHE = 200_000
WINDOW_CHARS = 200_000
RANGE_CHARS = 8_000_000
MAX_RANGES = 4096  # bounds what the driver learns of the ids: one row per range
_LOWEST = -(1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    """`x`, a new array of 32-bit numbers, with its bits mixed in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


Key = str | tuple[str, int]  # a word that occurs once, or a word and its count


def samples(keys: list[Key], n: int = SAMPLES) -> np.ndarray:
    """For each key and sample one number that orders as ln a does; its lowest 16 bits name (word, t)."""
    pairs = [(k, 1) if isinstance(k, str) else k for k in keys]
    words, counts = [w for w, _ in pairs], [c for _, c in pairs]
    h = np.array([xxhash.xxh64_intdigest(w) for w in words], "<u8").view("<u4").reshape(-1, 2)
    low, high = h[:, :1], h[:, 1:]
    k = np.arange(n, dtype=np.uint32)[None, :] * np.uint32(5)

    def uniform(j: int) -> np.ndarray:
        """Numbers in (0, 1) of 24 bits for each word and sample."""
        x = _mixed(low ^ _mixed((k + np.uint32(j + 1)) * np.uint32(0x9E3779B1)))
        x += high
        x = _mixed(x)
        x >>= np.uint32(8)
        u = x.astype(np.float32)
        u += np.float32(0.5)
        u *= np.float32(2.0 ** -24)
        return u

    r = -np.log(uniform(0) * uniform(1))
    c = -np.log(uniform(2) * uniform(3))
    b = uniform(4)
    t = np.floor(np.log(np.array(counts, np.float32))[:, None] / r + b)
    name = _mixed((t.astype(np.int32).view(np.uint32) * np.uint32(0x27D4EB2F)) ^ (high + np.uint32(1)) ^ (low << np.uint32(7)))
    bits = (np.log(c) - r * (t - b + 1)).view(np.int32)
    bits ^= (bits >> 31) & np.int32(0x7FFFFFFF)  # floats in the order of whole numbers
    out = bits.astype(np.int64)
    out <<= 16
    out |= name >> np.uint32(16)
    return out


class Sampler:
    """Fingerprints of texts; the samples of CACHE keys at most are kept."""

    def __init__(self, n: int = SAMPLES):
        self.n = n
        self.clear()

    def clear(self) -> None:
        self.at: dict[Key, int] = {}
        self.table = np.zeros((0, self.n), np.int64)

    def _learn(self, keys: list[Key]) -> None:
        used = len(self.at)
        if used + len(keys) > len(self.table):
            grown = np.empty((max(2 * used, used + len(keys), 4096), self.n), np.int64)
            grown[:used] = self.table[:used]
            self.table = grown
        for at in range(0, len(keys), 256):
            some = keys[at:at + 256]
            self.table[used + at:used + at + len(some)] = samples(some, self.n)
        self.at.update(zip(keys, range(used, used + len(keys))))

    def fingerprints(self, texts: list[str]) -> list[str]:
        """Hex of the sample names of each text; empty for a text without words. New keys of all texts are sampled together."""
        held = [[w if c == 1 else (w, c) for w, c in Counter(t.lower().split()).items()] for t in texts]
        rows = [list(map(self.at.get, keys)) for keys in held]
        new = dict.fromkeys(k for keys, at in zip(held, rows) if None in at for k, row in zip(keys, at) if row is None)
        if len(self.at) + len(new) > CACHE:
            self.clear()
            self._learn(list(dict.fromkeys(k for keys in held for k in keys)))
            rows = [list(map(self.at.get, keys)) for keys in held]
        elif new:
            self._learn(list(new))
            rows = [[self.at[k] if row is None else row for k, row in zip(keys, at)] if None in at else at for keys, at in zip(held, rows)]
        return [self._least(at) if at else "" for at in rows]

    def _least(self, rows: list[int]) -> str:
        least = np.full(self.n, np.iinfo(np.int64).max)
        for at in range(0, len(rows), 4096):
            np.minimum(least, self.table[rows[at:at + 4096]].min(axis=0), out=least)
        return (least & 0xFFFF).astype(">u2").tobytes().hex()

    def fingerprint(self, text: str) -> str:
        return self.fingerprints([text])[0]


def likeness(a: str, b: str) -> float:
    """Share of equal samples; two texts without words are alike, one of them with nothing else."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """`text` with its last quarter replaced by as many characters from the start of the following text, or all of it."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _ranges(docs: DataFrame, id_col: str, text_col: str) -> list[tuple[int, int]]:
    """(id, text hash) of the first row of each range, ascending; a null id counts as the lowest number. Rows of one id can lie in
    several ranges."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LOWEST)).alias("id"), F.xxhash64(text_col).alias("th"),
                       F.length(text_col).alias("n"))
    chars = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = min(MAX_RANGES, max(1, -(-chars // RANGE_CHARS)))
    dealt = rows.select("id", "th").repartitionByRange(n, "id", "th").withColumn("p", F.spark_partition_id())
    return sorted((r.s["id"], r.s["th"]) for r in dealt.groupBy("p").agg(F.min(F.struct("id", "th")).alias("s")).collect())


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, extra, id, none, th, packed): every text in its range, and as `extra` the follower of the range's last one."""
    firsts = _ranges(docs, id_col, text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LOWEST)).alias("id"), F.col(id_col).isNull().alias("none"),
                       F.xxhash64(text_col).alias("th"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("packed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, none, th = (batch.column(k).to_pylist() for k in range(3))
            out: list[tuple] = []
            for i, x, h, text in zip(ids, none, th, batch.column(3)):
                p = bisect_right(firsts, (i, h)) - 1
                packed = pack.compress(text.as_py())
                out.append((p, False, i, x, h, packed))
                if (i, h) == firsts[p]:
                    out.append(((p - 1) % len(firsts), True, i, x, h, packed))
            columns = list(zip(*out)) if out else [[]] * 6
            types = [pa.int32(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["part", "extra", "id", "none", "th", "packed"])

    dealt = rows.mapInArrow(run, "part int, extra boolean, id bigint, none boolean, th bigint, packed binary")
    return dealt.repartition(max(1, len(firsts)), "part").sortWithinPartitions("part", "extra", "id", "th")


class Row(NamedTuple):
    part: int
    extra: bool
    doc: int
    none: bool
    text: str


def _windows(batch: pa.RecordBatch) -> Iterator[list[Row]]:
    """Rows of a batch, unpacked, some WINDOW_CHARS characters at a time."""
    unpack = zstandard.ZstdDecompressor()
    some, size = [], 0
    for part, extra, doc, none, _, packed in zip(*(batch.column(k) for k in range(6))):
        text = unpack.decompress(packed.as_py()).decode("utf-8", "replace")
        some.append(Row(part.as_py(), extra.as_py(), doc.as_py(), none.as_py(), text))
        size += len(text)
        if size >= WINDOW_CHARS:
            yield some
            some, size = [], 0
    if some:
        yield some


_OUT = [("__doc", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id as `__doc`, n_chars, the SHA-256 of its edited text, both fingerprints, and how alike its own one is to
    the edited text's and to the next document's (by id; after the last the first; a null id comes first; rows of one id by a
    hash of their text). Null texts are empty. A lone row is its own next one. An empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        held = None  # the row that waits for its follower, with its fingerprint
        for batch in batches:
            out: list[tuple] = []
            for some in _windows(batch):
                pairs = []
                for row, mark in zip(some, sampler.fingerprints([r.text for r in some])):
                    if row.extra and (held is None or held[0].part != row.part):
                        continue  # a further copy of the follower
                    if held is not None:
                        pairs.append((*held, row.text, mark))
                    held = None if row.extra else (row, mark)
                texts = [edited(row.text, after) for row, _, after, _ in pairs]
                for (row, mark, _, following), new, other in zip(pairs, texts, sampler.fingerprints(texts)):
                    out.append((None if row.none else row.doc, len(row.text), hashlib.sha256(new.encode()).hexdigest(), mark, other,
                                likeness(mark, other), likeness(mark, following)))
            columns = list(zip(*out)) if out else [[]] * len(_OUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _OUT)], names=[n for n, _ in _OUT])

    schema = ("__doc bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    return _in_order(docs, id_col, text_col).mapInArrow(run, schema)


def op10_fingerprints(docs: DataFrame) -> DataFrame:
    return fingerprints(docs).withColumnRenamed("__doc", "doc_id")

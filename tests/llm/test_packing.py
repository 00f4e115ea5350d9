"""Packing: ids against the tokenizer, the tree against a search over all windows, and exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skylake.llm import packing as P

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENS = P.Tokens()


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'sté.,!1<|endoftext|>  ")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids(text):
    assert TOKENS.encode(text).tolist() == ids(text)


def test_ids_of_long_texts_and_special_strings(monkeypatch):
    monkeypatch.setattr(P, "SEGMENT", 50)
    rng = random.Random(1)
    text = "".join(rng.choice(["a", " b", "  c", "\n", " ", "it's", "<|endoftext|>", " d", "é", "語"]) for _ in range(3000))
    assert TOKENS.encode(text).tolist() == ids(text)
    assert TOKENS.encode("x" * 2000).tolist() == ids("x" * 2000)


def brute_best_fit(lengths, window):
    room, where = [], []
    for n in lengths:
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if not fits:
            room.append(window)
            fits = [(window, len(room) - 1)]
        k = min(fits)[1]
        room[k] -= n
        where.append(k)
    return room


@given(st.lists(st.integers(1, 64), max_size=120))
@settings(max_examples=200, deadline=None)
def test_best_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    where, offset = P.best_fit(lengths, 64)
    used = {}
    for n, w, o in zip(lengths, where, offset):
        assert o == used.get(w, 0)
        used[w] = o + n
    assert sorted(64 - u for u in used.values()) == sorted(brute_best_fit(lengths, 64))


def check(rows, texts, window=1024):
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert len(rows) == sum(-(-(len(ids(t)) + 1) // window) for _, t in texts)
    for i, t in dict(texts).items():
        own = np.array([*ids(t), 0], "<u4")
        parts = sorted(by[(i, len(own))], key=lambda r: r.start)
        for start in sorted({r.start for r in parts}):
            for r in (r for r in parts if r.start == start):
                assert r.ids_crc32 == zlib.crc32(own[start:start + r.length].tobytes())
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= window


TEXTS = [(1, "hello world"), (2, None), (3, ""), (4, "word " * 5000), (5, "a b c"), (5, "a b c"), (None, "null id"), (6, "x" * 3000)]


@pytest.mark.parametrize("shard", [20_000, 2])
def test_awkward_rows(spark, monkeypatch, shard):
    monkeypatch.setattr(P, "SHARD", shard)
    check(P.op5_packing(docs(spark, TEXTS, clashing=True)).collect(), TEXTS)


def test_little_padding(spark):
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    total = P.op5_packing(sf).groupBy("sequence_id").sum("length").collect()
    tokens = sum(r[1] for r in total)
    padding = sum(0 if r[1] & (r[1] - 1) == 0 else 1024 - r[1] for r in total)
    assert padding <= 0.01 * tokens


def test_ids_can_be_kept(spark):
    kept = P.pack(P.pieces(docs(spark, [(1, "hello world")]), with_ids=True)).collect()
    assert kept[0].ids == [*ids("hello world"), 0]


def test_empty_table(spark):
    assert P.op5_packing(docs(spark, [])).count() == 0

"""SimHash near copies against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from helpers import docs, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from skylake.llm import simhash as S


def brute_fingerprint(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def near(rng, base, flips):
    for _ in range(flips):
        base ^= 1 << rng.randrange(64)
    return base


@given(st.text(alphabet=" \t\n\v\f\r  \x1cAbÉé.İ", max_size=80))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def test_fingerprint_counts_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    monkeypatch.setattr(S, "BLOCK", 64)
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def test_masks_meet_every_pair_within_three_bits():
    rng = random.Random(3)
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = near(rng, x, rng.randrange(4))
        diff = x ^ y
        met = [m for m in S.TRIPLES if not diff & m]
        assert met
        for m in met:
            fives = [f for f in S.PAIRED[m] if not diff & f]
            assert fives and all(any(not diff & n for n in S.NIBBLED[f]) for f in fives)
    assert all((64 - m.bit_count()) == 12 for masks in S.NIBBLED.values() for m in masks)


@pytest.mark.parametrize("longest", [4096, 24, 6])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, longest):
    """Also where lists are too long and are split once or twice."""
    monkeypatch.setattr(S, "MAX_LIST", longest)
    rng = random.Random(longest)
    centre = rng.getrandbits(64)
    fps = {near(rng, centre, rng.randrange(12)) for _ in range(150)}
    for _ in range(40):
        x = rng.getrandbits(64)
        fps |= {x, near(rng, x, 3), near(rng, x, 4)}
    fps = sorted(fps | {0, (1 << 64) - 1})
    frame = spark.createDataFrame([(S._signed(x),) for x in fps], "fp bigint")
    at = {S._signed(x): k for k, x in enumerate(fps)}
    links = [(at[u], at[v]) for u, v in S.links(frame).collect()]
    assert all((fps[u] ^ fps[v]).bit_count() <= 3 for u, v in links)
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    assert [find(k) for k in range(len(fps))] == brute_components(fps)


def test_spanning_links_are_few():
    some = np.arange(256, dtype=np.uint64)
    assert len(S.spanning_links(some)) == 255


TEXTS = [(5, "A b c d e f g"), (3, "a b c d e f g"), (9, ""), (4, None), (8, " \n\t "), (1, "other words are here now"),
         (7, "word " * 30000), (2, "word " * 29999), (6, "é É"), (5, "A b c d e f g"), (None, "a b c d e f g")]


def test_awkward_rows(spark):
    got = rows(S.op2_simhash(docs(spark, TEXTS, clashing=True)))
    fps = [brute_fingerprint(t) for _, t in TEXTS]
    root = brute_components(fps)
    want = []
    for k, (i, _) in enumerate(TEXTS):
        ids = [TEXTS[j][0] for j in range(len(TEXTS)) if root[j] == root[k] and TEXTS[j][0] is not None]
        want.append((i, format(fps[k], "016x"), min(ids)))
    assert got == sorted(want, key=repr)


def test_keep_one(spark):
    table = docs(spark, TEXTS, clashing=True)
    kept = S.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6]
    nameless = docs(spark, [(None, "one two three four"), (None, "one two three four"), (None, "five six seven eight nine")])
    assert S.keep_one(nameless).count() == 2


def test_empty_table(spark):
    assert rows(S.op2_simhash(docs(spark, []))) == [] and S.keep_one(docs(spark, [])).count() == 0

"""Weighted samples against the exact generalised Jaccard similarity, and neighbours against a sorted list."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import docs

from skylake.llm import weighted_sampling as W


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_the_weighted_similarity():
    rng = random.Random(1)
    sampler, far = W.Sampler(512), []
    for pair in range(40):  # with words of its own: samples of one word are the same everywhere
        words = [f"w{pair}-{min(int(rng.expovariate(0.05)), 200)}" for _ in range(300)]
        cut = rng.randrange(300)
        a, b = " ".join(words), " ".join(words[:cut] + [f"v{pair}-{rng.randrange(90)}" for _ in range(300 - cut)])
        far.append(W.likeness(sampler.fingerprint(a), sampler.fingerprint(b)) - jaccard(a, b))
    assert abs(np.mean(far)) < 0.01 and np.std(far) < 0.035


def test_weights_count():
    sampler = W.Sampler(2048)
    a, b = "x " * 9 + "y", "x " * 3 + "y"
    assert W.likeness(sampler.fingerprint(a), sampler.fingerprint(b)) == pytest.approx(0.4, abs=0.04)


def test_cache_changes_nothing(monkeypatch):
    texts = [" ".join(f"w{(i * k) % 97}" for i in range(60)) for k in range(1, 30)]
    whole = W.Sampler()
    want = [whole.fingerprint(t) for t in texts]
    assert W.Sampler().fingerprints(texts) == want
    monkeypatch.setattr(W, "CACHE", 70)
    small = W.Sampler()
    assert [small.fingerprint(t) for t in texts] == want and len(small.at) <= 130
    assert small.fingerprints(["", *texts, "  "]) == ["", *want, ""]


def brute(table):
    order = sorted(table, key=lambda r: (-(1 << 63) if r[0] is None else r[0]))
    out = []
    for k, (i, t) in enumerate(order):
        own, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(own) // 4
        new = own[:len(own) - cut] + after[:cut]
        out.append((i, len(own), hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=repr)


TEXTS = [(9, "the last one of all has some words"), (1, None), (2, ""), (3, "é " * 9), (4, "some words here are said"), (5, "some words here are said"),
         (7, "long " * 50000), (6, "a b c d e f g h i j k l"), (None, "without an id"), (-4, "first of all")]


@pytest.mark.parametrize("chars", [8_000_000, 40, 5])
def test_awkward_rows(spark, monkeypatch, chars):
    monkeypatch.setattr(W, "RANGE_CHARS", chars)
    got = W.op10_fingerprints(docs(spark, TEXTS, clashing=True).repartition(3)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == brute(TEXTS)
    by = {r.doc_id: r for r in got}
    assert by[4].fingerprint == by[5].fingerprint and by[4].near_next == 1.0
    assert by[1].fingerprint == "" and by[1].near_edited == 1.0 and by[1].near_next == 1.0 and by[2].near_next == 0.0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


@pytest.mark.parametrize("chars", [8_000_000, 2])
def test_repeated_rows_and_ids(spark, monkeypatch, chars):
    monkeypatch.setattr(W, "RANGE_CHARS", chars)
    table = [(1, "same words here"), (1, "same words here"), (1, "same words here"), (1, "other text of one"), (2, "next")]
    got = W.op10_fingerprints(docs(spark, table)).collect()
    assert len(got) == 5 and sorted(r.n_chars for r in got) == sorted(len(t) for _, t in table)
    alone = W.op10_fingerprints(docs(spark, [(3, "only one here")])).collect()
    assert alone[0].near_next == 1.0


def test_empty_table(spark):
    assert W.op10_fingerprints(docs(spark, [])).count() == 0

"""Toxicity: the kernel against its definition, and accuracy on texts that training has not seen."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from helpers import docs

from skylake.llm import toxicity as T

SF = "/root/testdata/sf0.1"
INSULTS = ["idiot", "moron", "wretch", "buffoon"]


def brute_kernel(a, b):
    def image(word):
        found = {}
        w = f"^{word}$"
        for t in combinations(range(len(w)), 3):
            if t[2] - t[0] <= T.SPAN:
                key = tuple(w[i] for i in t)
                found[key] = found.get(key, 0) + T.DECAY ** (t[2] - t[0])
        return found

    def norm(word):
        n = len(word) + 2
        return sum(T.DECAY ** (2 * (t[2] - t[0])) for t in combinations(range(n), 3) if t[2] - t[0] <= T.SPAN) ** 0.5

    x, y = image(a), image(b)
    return sum(v * y.get(k, 0) for k, v in x.items()) / norm(a) / norm(b)


def prose(rng, n):
    return " ".join("".join(rng.choice(["ba", "lo", "mi", "ter", "san", "ko", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(seed, n=240):
    rng = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        words = prose(rng, rng.randint(5, 80)).split()
        if k % 4 == 0:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(INSULTS))
        texts.append(" ".join(words) + ".")
        labels.append(int(k % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return T.fit(*corpus(1))


def scored(model, texts):
    known = T._Margins(model)
    return np.array([model.score(known.of(T.tokens(t))) for t in texts])


def test_kernel_is_the_gapped_subsequence_kernel():
    words = ["idiot", "idxiot", "moron", "theory", "a", "é"]
    trainer = T._Trainer(["idiot", "moron", "wretch", "theory", "other", "words"], [np.arange(3), np.arange(3, 6)], np.array([True, False]))
    got = trainer._kernel([T._pieces(w)[0] for w in words])
    for i, w in enumerate(words):
        for j, mark in enumerate(trainer.landmarks):
            assert got[i, j] == pytest.approx(brute_kernel(w, mark[1:-1]), abs=1e-5)


def test_held_out_texts(model):
    texts, labels = corpus(2)
    found = scored(model, texts)
    assert ((found >= 0.7) == np.array(labels, bool)).mean() >= 0.98


def test_gaps_and_inserted_characters(model):
    rng = random.Random(5)
    hidden = ["id.iot", "mo-ron", "w*r*e*t*c*h", "1d10t", "M0R0N!!", "b u f f o o n", "idi#ot", "moxron"]
    for word in hidden:
        assert scored(model, [f"{prose(rng, 6)} {word} {prose(rng, 6)}"])[0] >= 0.7, word
    assert (scored(model, [prose(rng, n) for n in (1, 5, 50, 5000)]) < 0.7).all()


def test_long_words_are_scored_whole(model):
    plain_margin = model.margins(["idiot"])[0]
    assert plain_margin > 0
    assert len(T._pieces("x" * 500)) > 10 and "".join(p[:T.PIECE - T.OVERLAP] for p in T._pieces("ab" * 100)).startswith("^abab")


def test_nothing_to_learn_from():
    assert T.fit([], []).constant == 0.0 and T.fit(["a b"], [0]).constant == 0.0 and T.fit(["a b"], [1]).constant == 1.0
    assert T.fit(["...", "a b"], [1, 0]).constant == 0.5 and T.fit(["a b", None], [1, 0]).constant == 0.5


def test_awkward_rows(spark):
    texts, labels = corpus(3, 160)
    table = [*enumerate(texts), (900, None), (901, ""), (902, "idiot " + prose(random.Random(1), 30000)), (903, "idiot " * 4), (903, "idiot " * 4),
             (None, "idiot idiot")]
    frame = docs(spark, table, clashing=True)
    marks = spark.createDataFrame([*enumerate(labels), (5, None), (None, 1), (0, 1), (4000, 1)], "doc_id bigint, toxic int")
    got = T.op1_toxicity(frame, marks).collect()
    assert len(got) == len(table)
    by = {r.doc_id: r for r in got}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert by[900].score == by[901].score and by[900].predicted == 0
    assert by[903].predicted == 1 and by[None].predicted == 1
    kept = T.keep_clean(frame, marks)
    assert kept.columns == frame.columns
    assert {903, None}.isdisjoint(r.doc_id for r in kept.collect())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert T.op1_toxicity(docs(spark, []), none).count() == 0
    assert [r.score for r in T.op1_toxicity(docs(spark, [(1, "a b")]), none).collect()] == [0.0]


def test_accuracy_on_the_tables(spark):
    got = T.op1_toxicity(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(marks, "doc_id").where("held_out").select("predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic)
    assert right / len(rows) >= 0.96 and caught >= 0.75 and wrong <= 0.005 * len(rows)


def sampled(spark, monkeypatch, table, marks):
    """Texts and labels that training is given."""
    seen = []
    monkeypatch.setattr(T, "fit", lambda texts, toxic, prior=None: seen.append((texts, toxic)) or T.Model(constant=0.0))
    T.train(docs(spark, table), spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    return seen[0]


def test_long_texts_do_not_empty_the_sample(spark, monkeypatch):
    monkeypatch.setattr(T, "SAMPLE_CHARS", 20_000)
    table = [(k, "long " * 6000 if k % 3 == 0 else f"text {k} " + "x" * 80) for k in range(300)]
    texts, toxic = sampled(spark, monkeypatch, table, [(k, k % 2) for k in range(300)])
    assert toxic.count(0) >= 90 and toxic.count(1) >= 90 and not any("long" in t for t in texts)


def test_one_row_of_an_id_is_sampled(spark, monkeypatch):
    table = [*[(1, "the same row")] * 50, (1, "another"), (2, "clean"), (3, "toxic")]
    texts, toxic = sampled(spark, monkeypatch, table, [(1, 0), (2, 0), (3, 1)])
    assert len(texts) == 3 and sorted(toxic) == [0, 0, 1]


@pytest.mark.parametrize("marks", [[(1, 0), (2, 0)], [(1, 1), (2, 1)], [(1, 0), (9, 1)]])
def test_a_class_without_texts_is_an_error(spark, marks):
    with pytest.raises(ValueError, match="texts to learn from"):
        T.train(docs(spark, [(1, "a b"), (2, "c d")]), spark.createDataFrame(marks, "doc_id bigint, toxic int"))


def test_every_toxic_text_and_the_whole_clean_vocabulary_take_part(monkeypatch):
    monkeypatch.setattr(T, "SUSPECTS", 2)
    monkeypatch.setattr(T, "START", 6)
    monkeypatch.setattr(T, "STEP", 3)
    monkeypatch.setattr(T, "BLOCK", 7)
    clean = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    toxic = [f"only{chr(97 + k)}" for k in range(12)]
    vocabulary = [*clean, "idiot", *toxic]
    bags = [np.arange(k, k + 20) for k in range(0, 180, 20)] + [np.array([k, 200, 201 + k]) for k in range(12)]
    trainer = T._Trainer(vocabulary, bags, np.array([0] * 9 + [1] * 12))
    assert all(200 in b and b.size == 2 for b in trainer.suspects[9:])
    assert set(trainer.clean) >= set(range(180))
    model = trainer.fit(np.arange(len(bags)))
    model = T.Model(*model) if isinstance(model, tuple) else model
    assert trainer.margins(model, np.array([200]))[0] > trainer.margins(model, np.arange(180)).max()
    assert trainer.margins(model, np.zeros(0, int)).size == 0

"""Benchmark passages against brute force."""

import hashlib
import random
import re

from compare import compare, duck
from helpers import docs

from skylake.llm import decontamination as D
from skylake.llm import queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        p = words(t)
        n = min(10, len(p))
        for i in range(len(p) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == p[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item))
    listed = ",".join(sorted(found - {"None"}))
    return len(w), len(hit), len(found - {"None"}), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' as term", "'y' as pos", "'z' as doc_id")


def passage(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "tok", "É", "élan", "zug", "x7", "lorem", "ipsum"]) for _ in range(n))


ITEMS = [(1, passage(1, 30)), (2, passage(2, 12)), (10, "Three, short WORDS"), (3, passage(1, 30)), (4, None), (5, "..."), (6, "the"),
         (7, "a a a a a a a a a a a a"), (2, passage(9, 15)), (8, "no document holds unseenterm here at all of these words")]
TEXTS = [(1, "start " + passage(1, 30) + " end"), (2, passage(2, 12).upper()), (3, "x three-short.words y three short words"), (4, None), (5, ""),
         (6, "... !"), (7, "a " * 25), (8, passage(2, 11)), (9, passage(2, 9)), (10, "quite clean text with nothing in it"),
         (11, ("filler words " * 20000) + passage(9, 15)), (1, "start " + passage(1, 30) + " end"), (1, "another text of id one, the"),
         (None, passage(2, 12)), (12, passage(1, 30) + " " + passage(1, 30)), (13, "threeshort words")]


def test_awkward_rows(spark):
    got = D.op4_decontamination(docs(spark, TEXTS, clashing=True), benchmark(spark, ITEMS)).drop("n_near").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *brute(t, ITEMS)) for i, t in TEXTS], key=repr)


def test_proximity(spark):
    items = [(1, "alpha beta gamma"), (2, "solo"), (3, "delta alpha"), (4, "absent word")]
    texts = [(1, "gamma x alpha y beta"), (2, "alpha " + "x " * 30 + "beta gamma"), (3, "solo delta " + "x " * 19 + "alpha"),
             (4, "delta " + "x " * 21 + "alpha"), (5, "x")]
    got = {r.doc_id: r.n_near for r in D.op4_decontamination(docs(spark, texts), benchmark(spark, items)).collect()}
    assert got == {1: 1, 2: 0, 3: 2, 4: 0, 5: 0}


def test_keep_uncontaminated(spark):
    table = docs(spark, TEXTS, clashing=True)
    kept = D.keep_uncontaminated(table, benchmark(spark, ITEMS))
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in TEXTS if not brute(t, ITEMS)[4])


def test_shuffled_where_nothing_may_be_broadcast(spark, monkeypatch):
    from skylake.llm import common
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    got = D.op4_decontamination(docs(spark, TEXTS), benchmark(spark, ITEMS)).drop("n_near").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *brute(t, ITEMS)) for i, t in TEXTS], key=repr)


def test_empty_tables(spark):
    assert D.op4_decontamination(docs(spark, []), benchmark(spark, ITEMS)).count() == 0
    assert [r.n_hit for r in D.op4_decontamination(docs(spark, [(1, "a b")]), benchmark(spark, [])).collect()] == [0]


def test_no_python_in_the_plan(spark, plan):
    text = plan(queries.QUERIES["op4_decontamination"](spark, SF_DIR))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_same_as_sql(spark):
    assert compare(spark, duck(SF_DIR), "op4", queries.QUERIES["op4_decontamination"], D.SQL, SF_DIR) is None

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylake.llm import pii, pii_table
from skylake.llm.common import load
from tests.llm.helpers import docs, rows

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


@pytest.fixture(scope="module")
def model():
    return pii.train(pii_table.rows())


def brute(text):
    """Base spans (start, kind, end) by the patterns as they stand."""
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = (True, kind == 1 and all(int(p) <= 255 for p in m.group().split(".")),
                    12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0, 9 <= len(digits) <= 15)[kind]
            found += [(m.start(), kind, m.end())] if good else []
    return sorted(found)


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    bits = ["a", "b.c", "@", "@", ".", "x-y", "%", " ", " ", "1", "25", "256", "1.2.3.4", "0001.2.3.255", "+4", "+49 (30) ", "-", "4111 1111 1111 1111", "378282246310005", "(", "ä", "\n"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["a@b.c@d.e", "a@b", "@b.c", "1.2.3.4.5.6.7.8", "+1" + " " * 3000 + "2", "9" * 5000, "a@" * 3000]
    assert sum(len(brute(t)) for t in texts) > 1500
    for t in texts:
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("0" * 6000 + ".1.2.3") == [(0, 1, 6006)]


def whole_viterbi(text, model):
    """Labels by one Viterbi over the whole text."""
    t = pii.tokens(text)
    e = pii.scores(t, model)
    e[:, 0] += pii.CAUTION
    return t, (pii.viterbi(e[None], model.moves)[0] if len(e) else np.zeros(0, int))


def test_sure_tokens_change_nothing():
    rng = np.random.default_rng(5)
    part = 0
    for at in range(300):
        e, moves = rng.normal(size=(40, 5)), rng.normal(size=(5, 5)) * (0.3, 2.0)[at % 2]
        e[:, 0] += rng.choice([0.0, 2.0, 5.0], 40)
        best = pii.viterbi(e[None], moves)[0]
        assert (pii.labels(e, moves) == best).all()
        held = pii.sure(e, moves)
        assert not best[held].any()
        alone = e[:, 0] - e[:, 1:].max(axis=1) > pii.gain(moves)
        assert not best[alone].any()
        part += held.sum()
    assert part > 1000


def test_parts_change_nothing(model):
    lines = [t for t, _ in pii_table.rows(1, seed=6)]
    random.Random(1).shuffle(lines)
    text = "\n".join(lines) + " ä" * 40 + "1" * 500
    want = pii.model_spans(text, model)
    assert len(want) > 60
    for part in (7, 64, 301):
        assert pii.model_spans(text, model, part) == want
    t, y = whole_viterbi(text, model)
    assert {int(t.start[i]) for i in np.flatnonzero(y)} >= {s for s, _, _ in want}


HELD_OUT = [
    ("My name is {Wendy Harrow} and this is new.", "name"), ("Please contact {Ines Duarte} today.", "name"), ("Dear Mr. {Tannenbaum}, hello.", "name"),
    ("Mein Name ist {Ulrich Stein}.", "name"), ("Me llamo {Ramón Ibarra} y vivo lejos.", "name"), ("Frau {Schneider} wohnt in der Stadt.", "name"),
    ("My phone number is {212-555-0147}, please write.", "phone"), ("Telefon: {0171 2345678}", "phone"), ("Call me at {(415) 555-0199} at noon.", "phone"),
    ("Reach us at {06 55 44 33 22}", "phone"), ("write to {paul at gmail dot com} now", "email"), ("My email is {rita.voss [at] web [dot] de} here.", "email"),
    ("SSN: {123-45-6789}", "id"), ("My passport number is {X12345678}.", "id"), ("IBAN: {FR76 3000 6000 0112 3456 7890 18}", "id"),
    ("The report of 2019 has 1234567 lines.", None), ("Build 2.10.33 is out.", None), ("Das Wetter War Schön.", None), ("It is 12:30 on 2020-01-02.", None),
    ("Le Petit Prince est un livre.", None), ("Total: 5927243074273351", None), ("We walked to the old town and back.", None),
]


def test_held_out_sentences(model):
    right = 0
    for line, kind in HELD_OUT:
        at = line.find("{")
        text = line.replace("{", "").replace("}", "")
        want = [] if kind is None else [(at, pii.KINDS.index(kind), line.find("}") - 1)]
        right += pii.model_spans(text, model) == want
    assert right >= len(HELD_OUT) - 3


def test_few_false_alarms_in_invented_prose(spark, model):
    """The given documents hold no names: at most one labelled span in 50,000 characters."""
    texts = [r.text or "" for r in load(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    added = sum(len(pii.spans(t, model)) - len(pii.base_spans(t)) for t in texts)
    assert added <= sum(map(len, texts)) / 50_000


def test_query_equals_brute_force(spark, model):
    texts = [None, "", " ", "Mail a.b@c.example.org, host 10.0.0.256 or 10.0.0.25", "x " * 150_000 + " +1 (415) 555-0199", "My name is Wendy Harrow, 4111-1111-1111-1111."]
    df = docs(spark, [*enumerate(texts), (None, texts[3]), (3, texts[3])])
    want = []
    for i, t in [*enumerate(texts), (None, texts[3]), (3, texts[3])]:
        base, every = brute(t or ""), pii.spans(t or "", model)
        assert set(base) <= set(every)
        listed = lambda found: ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in found)
        want.append((i, *(sum(k == n for _, k, _ in base) for n in range(4)), hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)))
    assert rows(pii.op12_pii(df)) == sorted(want, key=repr)
    clashing = df.withColumns({c: F.lit("own") for c in ("found", "spans", "__row", "__found", "n_email", "a.b")})
    assert rows(pii.op12_pii(clashing)) == sorted(want, key=repr)
    assert "name:11:23" in want[5][-1]


def test_redaction_and_tables(spark, monkeypatch):
    monkeypatch.setattr(pii, "STEPS", 120)
    df = docs(spark, [(1, "Dear Mr. Novak, mail a@b.org"), (2, None), (3, "clean")], clashing=True)
    table = pii_table.labelled(spark, 1)
    model = pii.fit(table)
    done = {r.doc_id: r.text for r in pii.redact(df, model=model).collect()}
    assert done == {1: "Dear Mr. [name], mail [email]", 2: None, 3: "clean"}
    assert pii.redact(df, model=model).columns == df.columns
    assert rows(pii.op12_pii(docs(spark, []))) == []
    empty = pii.fit(table.limit(0))
    assert [r.spans for r in pii.find(df, model=empty).orderBy("__row.doc_id").collect()] == ["email:21:28", "", ""]

"""Chat formatting: exact round trips, masks against a walk over all characters, and SQL."""

import hashlib

import numpy as np
import pytest
from compare import compare, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from skylake.llm import chat_format as C
from skylake.llm import queries

SF_DIR = "/root/testdata/sf0.001"
ENCODER = C.Encoder()
PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "<|endoftext|>", "\\", "<\\", "<\\/s>", "\n", "a", " b", ".", "é", "語", "\u2028", "\u00a0", "'s", "👩‍👩‍👧"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=8).map("".join) | st.text(st.characters(codec="utf-8"), max_size=12)


@given(TEXT)
@settings(max_examples=400, deadline=None)
def test_escape(text):
    escaped = C.escape(text)
    assert C.unescape(escaped) == text
    assert not any(c in escaped for c in ("</s>", "<s>", "[INST]", "[/INST]", "<|endoftext|>"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a\nb", "</s>", "\\n", "\\"]), TEXT), max_size=5))
@settings(max_examples=300, deadline=None)
def test_round_trip(turns):
    formatted, spans = C.render(turns)
    assert C.turns_of(formatted) == turns
    ids, offsets = ENCODER.encode(formatted)
    masked = C.mask(spans, offsets)
    under = {i for a, b in spans for i in range(a, b)}
    assert {i for _, a, b in masked.tolist() for i in range(a, b)} == under
    walk = {k for k, (a, b) in enumerate(offsets.tolist()) if any(i in under for i in range(a, b))}
    assert set(masked[:, 0].tolist()) == walk
    assert C.masked_text(formatted, masked) == "".join(t for r, t in turns if r == "assistant")


CONV = "conv_id bigint, turn bigint, role string, text string"
ROWS = [(1, 1, "assistant", "yes."), (1, 0, "user", "is it?"), (2, 0, "assistant", None), (3, 0, None, "x"), (4, None, "assistant", "first"), (4, 0, "user", ""),
        (5, 0, "assistant", "b"), (5, 0, "assistant", "a"), (5, 0, "assistant", "a"), (None, 0, "assistant", "no id"), (0, 0, "assistant", "zero"),
        (6, 0, "user", "long " * 40000), (6, 1, "assistant", "</s> words. " * 20000), (6, 2, "assistant", "end")]


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        size = len(C.render([(r, x) for _, r, x in turns])[0])
        out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part", [1_000_000, 10])
def test_awkward_rows(spark, monkeypatch, part):
    """Long conversations are cut into parts on the workers; here the cut is also tried on its own."""
    frame = spark.createDataFrame(ROWS, CONV).selectExpr("*", "1 as conv", "2 as none", "3 as last")
    got = C.op3_chat(frame).collect()
    assert sorted(map(tuple, got), key=repr) == brute([*ROWS, *C.HARD])
    monkeypatch.setattr(C, "PART", part)
    import pyarrow as pa
    mine = sorted(((1, t, r, x) for c, t, r, x in ROWS if c == 6), key=lambda r: r[1])
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 3), pa.array([False] * 3), pa.array([r[2] for r in mine]), pa.array([r[3] for r in mine])],
                                       names=["conv", "none", "role", "text"])
    parts = list(C._format(iter([batch])))
    assert len(parts) == (1 if part > 10 else 3)
    whole, _ = C.render([(r[2], r[3]) for r in mine])
    ids = [i for p in parts for i in p.column("ids")[0].as_py()]
    assert ids == ENCODER.encode(whole)[0]
    read = [r for b in C._read(iter(parts)) for r in b.to_pylist()]
    assert [tuple(r.values())[1:6] for r in read] == [b[1:] for b in brute([(1, *r[1:]) for r in mine])]


def test_searched_spans_need_no_tokens():
    assert C.mask([], np.zeros((0, 2))).shape == (0, 3) and C.mask([(0, 0)], np.array([[0, 3]])).shape == (0, 3)


def test_empty_table(spark):
    assert [r.conv_id for r in C.op3_chat(spark.createDataFrame([], CONV)).collect()] == [-7]


def test_same_as_sql(spark):
    assert compare(spark, duck(SF_DIR), "op3", queries.QUERIES["op3_chat"], C.SQL, SF_DIR) is None

"""Chat formatting with loss masks aligned to token offsets.

A turn is rendered as `<s>ROLE`, a line end, its text, `</s>` and a line end. Control strings inside texts are escaped by one more backslash after
their first character, which is taken off again on reading; texts without control strings stay as they are. A conversation is rendered whole
and encoded once with offsets; the spans of the assistant's texts, sorted as they are, are met with the token spans by binary search.
A token that reaches over the border of a text (a full stop and the `</` after it are one token) is under the mask with the part inside only.

Rows of a conversation are streamed in order. One that is longer than PART characters comes as several parts, cut between turns, where no
token spans the border, so a task holds PART characters and one turn at most.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1_000_000
LEARNED = "assistant"
VOCABULARY = "byte_bpe_50k"
# The strings with a meaning of their own in the template or the vocabulary, cut after their first character.
CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|\|endoftext\|>)"
_CONTROL = re.compile(CONTROL)
_ESCAPED = re.compile(CONTROL.replace(r"(\\*)", r"\\(\\*)"))
_TURN = re.compile(r"<s>([^\n]*)\n(.*?)</s>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]], learned: str = LEARNED) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns, and the sorted spans of the texts of the `learned` role."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>{_escape_role(role)}\n", escape(text)
        if role == learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>\n"]
        at += len(head) + len(body) + 5
    return "".join(parts), spans


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The turns that a formatted text holds."""
    return [(_unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def mask(spans: list[tuple[int, int]], offsets: np.ndarray) -> np.ndarray:
    """(token, from, to) of every token part under the spans; `offsets` has the start and end of each token, ascending."""
    if not spans or not len(offsets):
        return np.zeros((0, 3), np.int64)
    first = np.searchsorted(offsets[:, 1], [a for a, _ in spans], side="right")  # the first token that ends after the span's start
    last = np.searchsorted(offsets[:, 0], [b for _, b in spans], side="left")  # the first token that starts at its end or later
    out = [np.column_stack([np.arange(i, j), np.maximum(offsets[i:j, 0], a), np.minimum(offsets[i:j, 1], b)])
           for (a, b), i, j in zip(spans, first, last) if i < j]
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def masked_text(formatted: str, masked: np.ndarray) -> str:
    """The text under the mask, unescaped span by span; a character of several tokens counts once."""
    runs: list[list[int]] = []
    for _, a, b in masked.tolist():
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return "".join(unescape(formatted[a:b]) for a, b in runs)


class Encoder:
    """Ids and offsets in code points; offsets keep the white space that belongs to a token."""

    def __init__(self, vocabulary: str = VOCABULARY):
        from tokenizers import Tokenizer, processors

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return found.ids, np.array(found.offsets, np.int64).reshape(-1, 2)


_PARTS = [("conv", pa.int64()), ("none", pa.bool_()), ("last", pa.bool_()), ("formatted", pa.string()), ("ids", pa.list_(pa.int64())),
          ("token", pa.list_(pa.int64())), ("from", pa.list_(pa.int64())), ("to", pa.list_(pa.int64()))]
PARTS = ("conv bigint, none boolean, last boolean, formatted string, ids array<bigint>, token array<bigint>, `from` array<bigint>, "
         "`to` array<bigint>")


def _batch(rows: list[tuple], columns: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    values = list(zip(*rows)) if rows else [[]] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip(values, columns)], names=[n for n, _ in columns])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = Encoder()
    key, turns, size = None, [], 0

    def part(last: bool) -> pa.RecordBatch:
        formatted, spans = render(turns)
        ids, offsets = encoder.encode(formatted)
        found = mask(spans, offsets)
        return _batch([(*key, last, formatted, ids, *found.T)], _PARTS)

    for batch in batches:
        for row in zip(*(batch.column(k) for k in range(4))):
            conv, none, role, text = (v.as_py() for v in row)
            if key is not None and ((conv, none) != key or size > PART):
                yield part((conv, none) != key)
                turns, size = [], 0
            key = (conv, none)
            turns.append((role, text))
            size += len(text)
    if key is not None:
        yield part(True)


def formatted(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """Formatted conversations: conv (`none`: its id is null), formatted, token ids, and (token, from, to) of the loss mask. A long conversation has
    several rows in order, `last` marks the end. Turns are ordered by number, equal numbers by role and text; null roles and texts are
    empty; a null number comes first; rows of a null id are one conversation."""
    rows = conversations.select(
        F.coalesce(F.col(conv_col).cast("bigint"), F.lit(0)).alias("conv"), F.col(conv_col).isNull().alias("none"),
        F.col(turn_col).alias("__turn"), F.coalesce(F.col(role_col), F.lit("")).alias("__role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    ordered = rows.repartition("conv", "none").sortWithinPartitions("conv", "none", "__turn", "__role", "__text")
    return ordered.select("conv", "none", "__role", "__text").mapInArrow(_format, PARTS)


_DIGESTS = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64()), ("loss_tokens", pa.int64())]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole, loss, counts = hashlib.sha256(), hashlib.sha256(), [0] * 5
    for batch in batches:
        out = []
        for row in zip(*(batch.column(k) for k in range(8))):
            conv, none, last, text, ids, token, first, to = (v.as_py() for v in row)
            for role, said in turns_of(text):
                whole.update(f"{role}\n{said}\n".encode())
                counts[0] += 1
            learned = masked_text(text, np.array([token, first, to], np.int64).reshape(3, -1).T)
            loss.update(learned.encode())
            for k, n in enumerate((len(learned), len(text), len(ids), len(set(token))), 1):
                counts[k] += n
            if last:
                out.append((None if none else conv, counts[0], whole.hexdigest(), counts[1], loss.hexdigest(), *counts[2:]))
                whole, loss, counts = hashlib.sha256(), hashlib.sha256(), [0] * 5
        yield _batch(out, _DIGESTS)


def digests(found: DataFrame) -> DataFrame:
    """What the rows of `formatted`, still in their order, hold, read from their texts and masks."""
    return found.mapInArrow(_read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                                   "formatted_chars bigint, n_tokens bigint, loss_tokens bigint")


# The conversation that the registered query adds.
HARD = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat(conversations: DataFrame) -> DataFrame:
    rows = conversations.select("conv_id", "turn", "role", "text")
    hard = conversations.sparkSession.createDataFrame(HARD, "conv_id bigint, turn bigint, role string, text string")
    return digests(formatted(rows.unionByName(hard))).drop("n_tokens", "loss_tokens")


SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
  select *, length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|\|endoftext\|>)', '\1\\\2\3', 'g')) as n,
    length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(/?s>|/?INST\]|\|endoftext\|>)', '\1\\\2\3', 'g')) as m
  from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(n + m + 9)::bigint as formatted_chars
from e group by conv_id
"""

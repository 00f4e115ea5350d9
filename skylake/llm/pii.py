"""Personal data: patterns for four base kinds, and a linear-chain conditional random field for what has no pattern.

The field labels tokens (runs of letters, runs of digits, single signs) as none, name, phone, email or id from the shapes of the tokens around them,
the gaps between them and those words of the labelled table that are no part of a span there. It is trained on a small table (`pii_table`, or
one of the caller's of the same form; its first MAX_ROWS rows by text) on the driver, by gradient ascent on the penalised likelihood, and
decoded by Viterbi in the tasks, in numpy over whole texts.

Most tokens need no search. If every run of labels through a token, whatever its ends, would score less than `none` all along (`sure`, by running
sums of the greatest gains), the best path has `none` there; so Viterbi runs on the tokens between only. A token whose best other label is worse than
`none` by more than the moves around it could make up for has none whatever else the text holds: long texts are cut at such a token. Both
give what Viterbi over the whole text gives.

Labelled spans count if they are plausible (`_plausible`) and do not overlap a base span. Base spans all stay. Runs of labels end at line breaks.

Cases: null and empty texts have no spans. Equal rows each come out. An empty labelled table labels nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylake.llm import pii_table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "name", "id")
LABELS = ("none", "name", "phone", "email", "id")
MAX_ROWS = 4000
STEPS, RATE, PENALTY, MOVE_PENALTY = 220, 0.15, 0.001, 0.02
PART = 1 << 20  # characters decoded at once
CAUTION = 1.0  # added to the score of `none`: ordinary text is many times as common as in the labelled table
_LONGEST = 24  # letters of a word that is told apart
_BEFORE, _AFTER = 3, 2

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, sorted."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, 0, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    if "." in text:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# Characters of the basic plane: their group (0 space, 1 letter, 2 digit, 3 sign), whether they are capitals, and their small form.
_ALL = [chr(i) for i in range(1 << 16)]
_GROUP = np.array([0 if c.isspace() else 1 if c.isalpha() else 2 if "0" <= c <= "9" else 3 for c in _ALL], np.uint8)
_CAPITAL = np.array([c.isupper() for c in _ALL], np.int32)
_SMALL = np.array([ord(c.lower()[0]) for c in _ALL], np.uint64)
_SIGNS = np.full(1 << 16, 57, np.int32)
_SIGNS[[i for i in range(33, 127) if not chr(i).isalnum()]] = np.arange(25, 57)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(_LONGEST)], np.uint64)
_NO_SHAPE, _SHAPES, _GAPS = 58, 59, 4


class Tokens(NamedTuple):
    """`gap` to the token before: 0 none, 1 space, 2 with a line break, 3 first token; `word`: a hash, 0 for other tokens than words."""

    start: np.ndarray
    end: np.ndarray
    shape: np.ndarray
    gap: np.ndarray
    word: np.ndarray


def tokens(text: str) -> Tokens:
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)
    n = len(codes)
    if not n:
        return Tokens(*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    group = _GROUP[codes]
    cut = np.ones(n, bool)
    cut[1:] = (group[1:] != group[:-1]) | (group[1:] == 3)
    first = np.flatnonzero(cut)
    last = np.append(first[1:], n)
    kind, length = group[first], last - first
    capitals = np.add.reduceat(_CAPITAL[codes], first)
    size = np.digitize(length, (2, 3, 5))
    case = np.where(capitals == 0, 0, np.where(capitals == length, 2, np.where((capitals == 1) & (_CAPITAL[codes[first]] == 1), 1, 3)))
    shape = np.where(kind == 1, case * 4 + size, np.where(kind == 2, 15 + np.minimum(length, 9), _SIGNS[codes[first]]))
    place = np.arange(n) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        word = np.add.reduceat(_SMALL[codes] * _POWERS[np.minimum(place, _LONGEST - 1)], first)
    word = np.where((kind == 1) & (length <= _LONGEST), word, np.uint64(0))
    breaks = np.add.reduceat(((codes == 10) | (codes == 13)).astype(np.int32), first) > 0
    held = np.flatnonzero(kind > 0)
    gap = np.zeros(len(held), np.int64)
    if len(held):
        before = held - 1
        spaced = (before >= 0) & (kind[before] == 0)
        gap = np.where(spaced, np.where(breaks[before], 2, 1), 0)
        gap[0] = 3 if first[held[0]] == 0 else gap[0]
    return Tokens(first[held], last[held], shape[held], gap, word[held])


class Model(NamedTuple):
    """`vocabulary`: sorted hashes of the words told apart; `weights`: a table (values x labels) per feature; `moves`: label to label."""

    vocabulary: np.ndarray
    weights: list[np.ndarray]
    moves: np.ndarray


def _shifted(values: np.ndarray, by: int, none: int) -> np.ndarray:
    out = np.full(len(values), none, values.dtype)
    if by < 0:
        out[-by:] = values[:by]
    elif by < len(values):
        out[:len(values) - by] = values[by:]
    return out


def features(t: Tokens, vocabulary: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(value of each token, number of values) of each feature."""
    n_words = len(vocabulary) + 2  # other words and tokens, and none
    at = np.minimum(np.searchsorted(vocabulary, t.word), max(len(vocabulary) - 1, 0))
    word = np.where(vocabulary[at] == t.word, at + 1, 0) if len(vocabulary) else np.zeros(len(t.word), np.int64)
    shape = t.shape.astype(np.int64)
    s = {k: _shifted(shape, k, _NO_SHAPE) if k else shape for k in range(-2, 3)}
    out = [(_shifted(word, k, n_words - 1) if k else word, n_words) for k in range(-_BEFORE, _AFTER + 1)]
    out += [(s[k], _SHAPES) for k in s]
    out += [(s[a] * _SHAPES + s[b], _SHAPES * _SHAPES) for a, b in ((-1, 0), (0, 1))]
    # The word before, over a sign such as the stop of a title or a colon, next to the token's own shape.
    cue = np.where(s[-1] < 25, out[_BEFORE - 1][0], n_words + np.where(s[-1] < _NO_SHAPE, out[_BEFORE - 2][0], n_words - 1))
    out.append((cue * _SHAPES + shape, 2 * n_words * _SHAPES))
    return out + [(g * _SHAPES + shape, _GAPS * _SHAPES) for g in (t.gap, _shifted(t.gap, 1, 3))]


def scores(t: Tokens, model: Model) -> np.ndarray:
    out = np.zeros((len(t.start), len(LABELS)))
    for (values, _), table in zip(features(t, model.vocabulary), model.weights):
        out += table[values]
    return out


def train(rows: list[tuple[str, list[tuple[str, int, int]]]]) -> Model:
    """Fit to (text, spans); spans are (kind, start, end)."""
    read = []
    for text, spans in rows:
        t = tokens(text)
        y = np.zeros(len(t.start), np.int64)
        for kind, start, end in spans:
            y[(t.start >= start) & (t.end <= end)] = LABELS.index(kind)
        if len(y):
            read.append((t, y))
    k = len(LABELS)
    outside: dict[int, int] = {}
    inside = {w for t, y in read for w in t.word[y > 0].tolist()}
    for words in {tuple(t.word[y == 0].tolist()) for t, y in read}:  # a sentence counts once, however often it is filled
        for w in set(words):
            outside[w] = outside.get(w, 0) + 1
    # "at" and "dot" are told apart although they stand in spelled addresses.
    spelled = set(tokens("at AT dot").word.tolist())
    vocabulary = np.array(sorted(w for w, n in outside.items() if w and n > 1 and (w not in inside or w in spelled)), np.uint64)
    longest = max((len(y) for _, y in read), default=0)
    held = [features(t, vocabulary) for t, _ in read]
    sizes = [n for _, n in (held[0] if held else features(tokens(""), vocabulary))]
    weights = [np.zeros((n, k)) for n in sizes]
    moves = np.zeros((k, k))
    if not read:
        weights[_BEFORE][:, 0] = 1.0
        return Model(vocabulary, weights, moves)
    b = len(read)
    alive = np.array([[i < len(y) for i in range(longest)] for _, y in read])
    values = [np.array([np.pad(f[j][0], (0, longest - len(f[j][0]))) for f in held]) for j in range(len(sizes))]
    target = np.array([np.pad(y, (0, longest - len(y))) for _, y in read])
    truth = np.eye(k)[target] * alive[..., None]
    lengths = alive.sum(1)
    # Every sentence stands between two tokens without a label.
    ends = np.concatenate([np.zeros((b, 1), np.int64), target, np.zeros((b, 1), np.int64)], 1)
    seen_moves = np.zeros((k, k))
    for i in range(longest + 1):
        of = i <= lengths
        np.add.at(seen_moves, (ends[of, i], np.where(i < lengths[of], ends[of, i + 1], 0)), 1)
    parts, first, second = [*weights, moves], [np.zeros_like(w) for w in [*weights, moves]], [np.zeros_like(w) for w in [*weights, moves]]

    def total(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, STEPS + 1):
        e = sum(w[v] for w, v in zip(weights, values))
        forward = np.zeros((b, longest, k))
        forward[:, 0] = moves[0] + e[:, 0]
        for i in range(1, longest):
            forward[:, i] = np.where(alive[:, i, None], total(forward[:, i - 1, :, None] + moves, 1) + e[:, i], forward[:, i - 1])
        whole = total(forward[:, -1] + moves[:, 0], 1)
        back = np.zeros((b, longest, k))
        back[:, -1] = moves[:, 0]
        for i in range(longest - 2, -1, -1):
            ahead = total(moves + (e[:, i + 1] + back[:, i + 1])[:, None, :], 2)
            back[:, i] = np.where(alive[:, i + 1, None], ahead, moves[:, 0])
        share = np.exp(forward + back - whole[:, None, None]) * alive[..., None]
        expected = np.zeros((k, k))
        expected[0] += share[:, 0].sum(0)
        expected[:, 0] += share[np.arange(b), lengths - 1].sum(0)
        for i in range(1, longest):
            pair = np.exp(forward[:, i - 1, :, None] + moves + (e[:, i] + back[:, i])[:, None, :] - whole[:, None, None])
            expected += (pair * alive[:, i, None, None]).sum(0)
        away = (truth - share).reshape(-1, k)
        slopes = []
        for w, v in zip(weights, values):
            g = np.stack([np.bincount(v.ravel(), away[:, j], len(w)) for j in range(k)], 1)
            slopes.append(g / b - PENALTY * w)
        slopes.append((seen_moves - expected) / b - MOVE_PENALTY * moves)
        for w, g, m, s in zip(parts, slopes, first, second):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            w += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return Model(vocabulary, weights, moves)


def fit(table: DataFrame) -> Model:
    """Train on (text, spans), at most MAX_ROWS rows."""
    rows = table.where("text is not null").select("text", "spans").orderBy("text", F.to_json("spans")).limit(MAX_ROWS).collect()
    return train([(r.text, [(s.kind, s.start, s.end) for s in r.spans or []]) for r in rows])


def gain(moves: np.ndarray) -> float:
    """The most that another label than none can be better in the moves from the label before and to the one after."""
    return float((moves[:, 1:] - moves[:, :1]).max() + (moves[1:] - moves[:1]).max())


def sure(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Tokens which no run of other labels can cover with a gain over none, whatever its length and labels."""
    inner = float(moves[1:, 1:].max() - moves[0, 0])
    ends = float(moves[0, 1:].max() + moves[1:, 0].max() - 2 * moves[0, 0]) - inner
    total = np.cumsum(e[:, 1:].max(axis=1, initial=-np.inf) - e[:, 0] + inner)
    before = np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]))
    after = np.maximum.accumulate(total[::-1])[::-1]
    return after - before + ends < -1e-6


def viterbi(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels (runs x length) of runs between tokens without a label; e is runs x length x labels."""
    best, back = moves[0] + e[:, 0], []
    for i in range(1, e.shape[1]):
        each = best[:, :, None] + moves
        back.append(each.argmax(1))
        best = each.max(1) + e[:, i]
    out = np.zeros(e.shape[:2], np.int64)
    out[:, -1] = (best + moves[:, 0]).argmax(1)
    for i in range(e.shape[1] - 2, -1, -1):
        out[:, i] = back[i][np.arange(len(e)), out[:, i + 1]]
    return out


def labels(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best label of each token of a text that stands between tokens without a label."""
    out = np.zeros(len(e), np.int64)
    if not len(e):
        return out
    edge = np.flatnonzero(np.diff(np.concatenate([[True], sure(e, moves), [True]]).astype(np.int8)))
    first, length = edge[::2], edge[1::2] - edge[::2]
    for n in np.unique(length):
        at = first[length == n][:, None] + np.arange(n)
        out[at] = viterbi(e[at], moves)
    return out


def _plausible(kind: str, text: str) -> bool:
    digits = sum("0" <= c <= "9" for c in text)
    if kind == "phone":
        return 7 <= digits <= 15
    if kind == "id":
        return digits >= 5
    if kind == "email":
        return re.search(r"(?i)\W(at)\W.*\W(dot)\W|\w\W+at\W+\w.*\.\w", text) is not None
    return any(c.isupper() for c in text) and not digits


def model_spans(text: str, model: Model, part: int = PART) -> list[tuple[int, int, int]]:
    """(start, kind, end) of plausible labelled spans, kind as a place in KINDS."""
    out, at, known, size = [], 0, 0, part
    bound = gain(model.moves)
    while at < len(text):
        piece, last = text[at:at + size], at + size >= len(text)
        t = tokens(piece)
        e = scores(t, model)
        e[:, 0] += CAUTION
        low = int(np.searchsorted(t.start, known - at))
        high = len(e)
        if not last:
            inside = e[low:max(high - _AFTER - 1, low)]
            held = np.flatnonzero(inside[:, 0] - inside[:, 1:].max(axis=1, initial=-np.inf) > bound)
            if not held.size:
                size *= 2
                continue
            high = low + int(held[-1]) + 1
        y = labels(e[low:high], model.moves)
        hit = np.flatnonzero(y)
        if hit.size:
            start, end, gap = t.start[low:high], t.end[low:high], t.gap[low:high]
            new = np.append(True, (np.diff(hit) > 1) | (y[hit[1:]] != y[hit[:-1]]) | (gap[hit[1:]] == 2))
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(hit)) - 1
            for a, b in zip(hit[heads], hit[tails]):
                kind = LABELS[y[a]]
                if _plausible(kind, piece[start[a]:end[b]]):
                    out.append((at + int(start[a]), KINDS.index(kind), at + int(end[b])))
        if last:
            break
        known = at + int(t.end[high - 1])
        at, size = at + int(t.start[max(high - _BEFORE, 0)]), part
        if known - at >= size:
            size = 2 * (known - at)
    return out


def spans(text: str, model: Model) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, by start and then kind."""
    base = base_spans(text)
    added = model_spans(text, model)
    if base and added:
        starts = np.array([b[0] for b in sorted(base)])
        ends = np.maximum.accumulate([b[2] for b in sorted(base)])
        # The base spans that start before an added one ends: none may reach beyond its start.
        before = [np.searchsorted(starts, s[2]) for s in added]
        added = [s for s, n in zip(added, before) if not n or ends[n - 1] <= s[0]]
    return sorted(base + added)


def _listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found)


OUTPUT = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
_FOUND = "array<struct<start:bigint,kind:string,end:bigint>>"


def find(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """`docs` packed as `__row`, with `found`: the spans (start, kind, end) of each text in code points, and the columns of OUTPUT."""
    model = model or fit(pii_table.labelled(docs.sparkSession))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")

    def read(text: pa.Array) -> pa.Array:
        out = []
        for value in text:
            t = value.as_py() or ""
            base = base_spans(t)
            every = spans(t, model)
            counts = [sum(k == i for _, k, _ in base) for i in range(4)]
            out.append({"found": [{"start": s, "kind": KINDS[k], "end": e} for s, k, e in every],
                        **dict(zip(("n_email", "n_ip", "n_card", "n_phone"), counts)),
                        "base_sha256": hashlib.sha256(_listed(base).encode()).hexdigest(), "spans": _listed(every)})
        number = [pa.field(n, pa.int64()) for n in ("n_email", "n_ip", "n_card", "n_phone")]
        span = pa.struct([pa.field("start", pa.int64()), pa.field("kind", pa.string()), pa.field("end", pa.int64())])
        return pa.array(out, pa.struct([pa.field("found", pa.list_(span)), *number, pa.field("base_sha256", pa.string()), pa.field("spans", pa.string())]))

    kinds = f"struct<found:{_FOUND}," + OUTPUT.replace(" string", ":string").replace(" bigint", ":bigint").replace(", ", ",") + ">"
    return docs.select(row, F.arrow_udf(read, kinds)(F.col(f"`{text_col}`")).alias("__found")).select("__row", "__found.*")


def redact(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets; of overlapping spans the first stands for all."""
    def cut(text: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for value, held in zip(text, found):
            t, at, parts = value.as_py(), 0, []
            for s in held.as_py():
                if s["start"] >= at:
                    parts += [t[at:s["start"]], f"[{s['kind']}]"]
                at = max(at, s["end"])
            out.append(t if t is None else "".join([*parts, t[at:]]))
        return pa.array(out, pa.string())

    own: list[Column] = [F.col("__row").getField(c) for c in docs.columns]
    rows = find(docs, text_col, model)
    new = F.arrow_udf(cut, "string")(F.col("__row").getField(text_col), F.col("found"))
    return rows.select(*[(new if c == text_col else f).alias(c) for c, f in zip(docs.columns, own)])


def op12_pii(docs: DataFrame) -> DataFrame:
    return find(docs.select("doc_id", "text")).select(F.col("__row.doc_id").alias("doc_id"), *(c.split()[0] for c in OUTPUT.split(", ")))

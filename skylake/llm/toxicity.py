"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares two words by the ordered triples of letters they share, gaps allowed: a triple that
spans s positions weighs DECAY ** s, word ends count as letters. An insult with letters put between or with
another ending still shares most of its triples with the plain one. Marks inside words are removed,
digits read as the letters they stand for, and letters written one by one are joined, before words are compared.

Training is by multiple instances: a labelled text is a bag of sentences, a sentence a bag of words. Clean texts hold
clean words only; in a toxic text at least one word is toxic, and the machine finds which: it is trained,
each toxic text keeps the words on the toxic side (its best one if there is none), and it is trained again. The margin is
linear in the landmarks' kernels, so after training it folds into one weight per triple, which scores a word
without meeting any landmark. A sentence takes the margin of its worst word and a text that of its worst sentence;
with how many words are on the toxic side and how long the text is, a logistic curve fitted on texts that the machine had not
seen turns this into the score.

Fitting runs on a bounded sample: of each class SAMPLE_PER_CLASS labelled ids in the order of a hash, one row per id, up to half of SAMPLE_CHARS
characters; single texts over a hundredth of that half are left out of the sample. Every toxic text of the sample takes part with
the SUSPECTS words, among those no clean text has, that most other toxic texts share; START clean words take part from the beginning and
after each round the STEP worst judged of all the sample's clean words. Scoring covers every text whole.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylake.session import settle

SAMPLE_PER_CLASS = 3_000
SAMPLE_CHARS = 24_000_000
LANDMARKS = 240
SUSPECTS = 16
START, STEP = 6_000, 1_000
BLOCK = 40_000
ROUNDS = 5
COST = 8.0
DECAY, SPAN = 0.7, 5
LETTERS = 64
PIECE, OVERLAP = 40, 12
MEMO = 150_000
THRESHOLD = 0.7
SURE = 0.6
FOLDS = 4

GAPS = [(i, j) for j in range(2, SPAN + 1) for i in range(1, j)]
_NOT_LETTER = re.compile(r"[\W\d_]+")
_MARKS = ".,;:!?\"'()[]|*%&#-"
_LEET = str.maketrans("013457@$", "oieastas")
_INNER = re.compile(r"(?<=[^\W\d_])[013457@$]+(?=[^\W\d_])")

_codes = np.array([29 + c % 35 for c in range(0x110000)], np.uint8)
_codes[[ord("^"), ord("$")]] = 1, 2
_codes[ord("a"):ord("z") + 1] = np.arange(3, 29)
_codes[0] = 0


def plain(token: str) -> str:
    """Letters of a lower-case token; digits and signs between letters are read as the letters they resemble."""
    token = token.strip(_MARKS)
    if token.isalpha():
        return token
    return _NOT_LETTER.sub("", _INNER.sub(lambda m: m.group().translate(_LEET), token))


def tokens(text: str | None) -> set[str]:
    """Different tokens of a text, and the words made of three or more letters written one by one."""
    words = (text or "").lower().split()
    found = set(words)
    if sum(len(w) == 1 for w in found) > 2:
        run = ""
        for w in [*words, "  "]:
            if len(w) == 1 and w.isalpha():
                run += w
            else:
                if len(run) > 2:
                    found.add(run)
                run = ""
    return found


def _pieces(word: str) -> list[str]:
    """A word with its ends marked; long ones in overlapping pieces, so that all of it is scored."""
    marked = f"^{word}$"
    if len(marked) <= PIECE:
        return [marked]
    return [marked[i:i + PIECE] for i in range(0, len(marked) - OVERLAP, PIECE - OVERLAP)]


def _matrix(pieces: list[str]) -> np.ndarray:
    """Letter codes, one row a piece, zero-padded."""
    width = max(map(len, pieces)) + SPAN
    return _codes[np.array(pieces, f"U{width}").view(np.uint32).reshape(len(pieces), width)]


def _triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per gap pattern: the triple at every position, where it is real, and its weight."""
    c = codes.astype(np.int32)
    for i, j in GAPS:
        a, b, d = c[:, :-SPAN], c[:, i:c.shape[1] - SPAN + i], c[:, j:c.shape[1] - SPAN + j]
        yield (a * LETTERS + b) * LETTERS + d, d > 0, DECAY ** j


def _norms(codes: np.ndarray) -> np.ndarray:
    total = np.zeros(len(codes))
    for _, real, weight in _triples(codes):
        total += weight * weight * real.sum(axis=1)
    return np.sqrt(np.maximum(total, 1e-9))


@dataclass
class Model:
    """`weights`: one per triple; `bias`; `curve`: of the logistic curve; `constant` where there was nothing to fit."""

    weights: np.ndarray | None = None
    bias: float = 0.0
    curve: np.ndarray = field(default_factory=lambda: np.zeros(6))
    constant: float | None = None
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each word; of a long one, that of its worst piece; without letters, far on the clean side."""
        out = np.full(len(words), -9.0)
        owner, pieces = [], []
        for k, w in enumerate(words):
            for p in _pieces(w) if w else ():
                owner.append(k)
                pieces.append(p)
        order = sorted(range(len(pieces)), key=lambda k: len(pieces[k]))
        for at in range(0, len(order), 4096):
            some = order[at:at + 4096]
            codes = _matrix([pieces[k] for k in some])
            sums = np.zeros(len(some))
            for index, real, weight in _triples(codes):
                sums += weight * (self.weights[index] * real).sum(axis=1)
            np.maximum.at(out, [owner[k] for k in some], sums / _norms(codes) + self.bias)
        return out

    def score(self, found: np.ndarray) -> float:
        """Score of a text from its words' margins."""
        return float(1 / (1 + np.exp(-np.clip(_features(found) @ self.curve, -30, 30))))


def _features(found: np.ndarray) -> np.ndarray:
    if not found.size:
        found = np.array([-9.0])
    top = np.partition(found, -2)[-2:] if found.size > 1 else np.array([-2.0, found[0]])
    sides = [np.log1p((found > least).sum()) for least in (0, SURE)]
    return np.array([1.0, np.clip(top[1], -1, 1), np.clip(top[0], -0.3, 1), *sides, np.log1p(found.size) / 5])


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Primal Newton steps for the squared hinge loss; the last column of z is the bias."""
    w = np.zeros(z.shape[1]) if start is None else start
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        on = np.flatnonzero(y * (z @ w) < 1)
        gram, target = ridge.copy(), np.zeros(z.shape[1])
        for at in range(0, len(on), 4096):
            some = on[at:at + 4096]
            part = z[some].astype(np.float64)
            gram += COST * (part * weight[some, None]).T @ part
            target += COST * part.T @ (weight[some] * y[some])
        new = np.linalg.solve(gram, target)
        if np.abs(new - w).max() < 1e-4:
            return new
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 0.05 * w
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


class _Trainer:
    """The sample's words as numbers, their kernels with the landmarks, and the machine trained on some of its texts."""

    def __init__(self, vocabulary: list[str], bags: list[np.ndarray], toxic: np.ndarray):
        """`bags` hold the numbers of each text's different words."""
        self.vocabulary, self.bags, self.toxic = vocabulary, bags, toxic
        size = len(vocabulary)
        self.hash = np.array([zlib.crc32(w.encode()) for w in vocabulary], np.uint32)
        good = self._count(b for b, t in zip(bags, toxic) if not t)
        self.suspects = [b[good[b] == 0] if t else b[:0] for b, t in zip(bags, toxic)]
        # Toxic texts that share their least hash are taken for copies of each other and count once.
        groups: dict[int, list[np.ndarray]] = {}
        for b in self.suspects:
            if b.size:
                groups.setdefault(int(self.hash[b].min()), []).append(b)
        self.support = self._count(np.unique(np.concatenate(g)) for g in groups.values())
        self.suspects = [b[np.lexsort((self.hash[b], -self.support[b]))[:SUSPECTS]] for b in self.suspects]
        ranked = self._first(-self.support, self._count(self.suspects) > 0)
        frequent = self._first(-good, good > 0)
        self.clean = self._first(np.zeros(size), good > 0)
        part = LANDMARKS // 4
        spread = ranked[2 * part::max(1, (len(ranked) - 2 * part) // part)][:part]
        chosen = dict.fromkeys(np.concatenate([ranked[:2 * part], spread, frequent[:part]]).tolist())
        self.landmarks = [_pieces(vocabulary[k])[0] for k in chosen]
        self._prepare()
        self.row = np.full(size, -1, np.int32)
        self.z = np.zeros((0, self.whiten.shape[1] + 1), np.float32)
        self.add(np.concatenate([ranked, frequent[:2 * START // 3], self.clean[:START // 3]]))

    def _count(self, bags) -> np.ndarray:
        out = np.zeros(len(self.vocabulary), np.int64)
        for b in bags:
            out[b] += 1
        return out

    def _first(self, order: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Numbers of the wanted words in this order, equals by their hash."""
        k = np.flatnonzero(wanted)
        return k[np.lexsort((self.hash[k], order[k]))]

    def _prepare(self) -> None:
        codes = _matrix(self.landmarks)
        self.index = np.unique(np.concatenate([i[r] for i, r, _ in _triples(codes)]))
        self.place = np.zeros(LETTERS ** 3, np.int32)
        self.place[self.index] = np.arange(1, len(self.index) + 1)
        self.images = np.zeros((len(self.index) + 1, len(codes)), np.float32)
        for i, real, weight in _triples(codes):
            rows, _ = np.nonzero(real)
            np.add.at(self.images, (self.place[i[real]], rows), weight)
        self.images[0] = 0
        self.images /= _norms(codes)
        own = self._kernel(self.landmarks)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        keep = values > 1e-4 * values.max()
        self.whiten = vectors[:, keep] / np.sqrt(values[keep])

    def add(self, words: np.ndarray) -> None:
        """Take words among the instances."""
        new = np.array(list(dict.fromkeys(words[self.row[words] < 0].tolist())), int)
        if new.size:
            self.row[new] = np.arange(len(self.z), len(self.z) + len(new))
            z = self._kernel([_pieces(self.vocabulary[k])[0] for k in new]) @ self.whiten
            self.z = np.vstack([self.z, np.hstack([z, np.ones((len(new), 1))]).astype(np.float32)])

    def _kernel(self, pieces: list[str]) -> np.ndarray:
        """Kernel of each piece with each landmark: only triples that some landmark has are looked at."""
        out = np.zeros((len(pieces), len(self.landmarks)))
        for at in range(0, len(pieces), 1024):
            codes = _matrix(pieces[at:at + 1024])
            sums = np.zeros((len(codes), len(self.landmarks)), np.float32)
            for i, real, weight in _triples(codes):
                place = np.where(real, self.place[i], 0)
                rows, columns = np.nonzero(place)
                if rows.size:
                    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    sums[rows[first]] += weight * np.add.reduceat(self.images[place[rows, columns]], first, axis=0)
            out[at:at + 1024] = sums / _norms(codes)[:, None]
        return out

    def margins(self, model: Model, words: np.ndarray) -> np.ndarray:
        """Margins of words, a block at a time."""
        blocks = [model.margins([self.vocabulary[k] for k in words[at:at + BLOCK]]) for at in range(0, len(words), BLOCK)]
        return np.concatenate([np.zeros(0), *blocks])

    def fit(self, chosen: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights per triple and bias from the chosen texts. Starts from the suspects that most separate toxic
        texts share; each round keeps the words on the toxic side and adds the STEP clean words, of all there are,
        that are misjudged worst."""
        seen = self._count(self.bags[k] for k in chosen if not self.toxic[k]) > 0
        pool = self.clean[seen[self.clean]]
        good = np.flatnonzero(seen & (self.row >= 0))
        bags = [b for b in (self.suspects[k] for k in chosen if self.toxic[k]) if b.size]
        table, bias, w = np.zeros(LETTERS ** 3, np.float32), 0.0, None
        for step in range(ROUNDS):
            picked: list[np.ndarray] = []
            for b in bags:
                found = self.support[b] if w is None else self.z[self.row[b]] @ w
                least = max(2, found.max() / 2) if w is None else 0
                hits = b[found >= least]
                picked.append(hits if hits.size else b if w is None else b[[found.argmax()]])
            bad = np.unique(np.concatenate(picked)) if picked else np.zeros(0, int)
            y = np.r_[np.ones(len(bad)), -np.ones(len(good))]
            share = max(1, len(good)) / max(1, len(bad))
            weight = np.r_[np.full(len(bad), min(10.0, max(0.25, share))), np.ones(len(good))]
            w = _svm(self.z[self.row[np.r_[bad, good]]], y, weight, w)
            table = np.zeros(LETTERS ** 3, np.float32)
            table[self.index] = self.images[1:] @ (self.whiten @ w[:-1])
            bias = float(w[-1])
            if pool.size and step < ROUNDS - 1:
                found = self.margins(Model(table, bias), pool)
                order = np.argsort(-found, kind="stable")[:STEP]
                worst = pool[order[found[order] > -0.7]]
                self.add(worst)
                good = np.union1d(good, worst)
        return table, bias


def _numbered(texts: Iterable[str]) -> tuple[list[str], list[np.ndarray]]:
    """Words of the texts, and each text's different words as numbers."""
    at: dict[str, int] = {}
    bags = [np.unique(np.array([at.setdefault(w, len(at)) for w in map(plain, tokens(t)) if w], np.int32)) for t in texts]
    return list(at), bags


def fit(texts: Iterable[str], toxic: list[int], prior: float | None = None) -> Model:
    """A model from labelled texts; `prior` is the share of toxic ones among all labelled rows.

    Without texts of both classes, or words in them, the model is a constant: the share of toxic texts, 0 if there is none.
    """
    y = np.array(toxic, bool)
    vocabulary, bags = _numbered(texts)
    if not any(b.size for b, t in zip(bags, y) if t) or not any(b.size for b, t in zip(bags, y) if not t):
        return Model(constant=float(y.mean()) if len(y) else 0.0)
    trainer = _Trainer(vocabulary, bags, y)
    fold = np.zeros(len(y), int)
    for label in (True, False):
        same = np.flatnonzero(y == label)
        fold[same] = np.arange(len(same)) % FOLDS
    x = np.zeros((len(y), 6))
    for part in range(FOLDS):
        train = np.flatnonzero(fold != part) if y[fold != part].any() else np.arange(len(y))
        half = Model(*trainer.fit(train))
        margin = np.zeros(len(vocabulary))
        held = np.flatnonzero(fold == part)
        asked = np.unique(np.concatenate([bags[k] for k in held])) if len(held) else np.zeros(0, int)
        margin[asked] = trainer.margins(half, asked)
        for k in held:
            x[k] = _features(margin[bags[k]])
    share = y.mean()
    prior = share if prior is None else min(max(prior, 1e-6), 1 - 1e-6)
    weight = np.where(y, prior / share, (1 - prior) / (1 - share))
    return Model(*trainer.fit(np.arange(len(y))), curve=_logistic(x, y.astype(float), weight))


class _Margins:
    """Margins by token, each computed once; emptied when it holds MEMO of them, so memory is bounded."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def of(self, found: set[str]) -> np.ndarray:
        new = [t for t in found if t not in self.known]
        if new:
            if len(self.known) > MEMO:
                self.known, new = {}, list(found)
            self.known.update(zip(new, self.model.margins([plain(t) for t in new]).tolist()))
        return np.array([self.known[t] for t in found])


_WORKER: dict[str, _Margins] = {}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          only: Column | None = None) -> Model:
    """A model from the rows of `labels` with an id and a label that `only` admits; of an id that is labelled twice
    the higher label counts, of one with several texts that of the least hash. Texts without a label, or null, take no part.
    Where there are labels and documents, a class without a text to learn from is an error."""
    rows = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).dropna()
    if only is not None:
        rows = rows.where(only)
    rows = rows.groupBy("__id").agg((F.max("__y") > 0).cast("int").alias("__y"))
    counts = {r["__y"]: r["count"] for r in rows.groupBy("__y").count().collect()}
    total = sum(counts.values())
    texts = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__th"), F.col(text_col).alias("__text"))
    usable = texts.where(F.length("__text") <= SAMPLE_CHARS // 2 // 100).select("__id", "__th", F.length("__text").alias("__n"))
    known = settle(rows.join(usable.groupBy("__id").agg(F.min(F.struct("__th", "__n")).alias("__own")), "__id").select("__id", "__y", "__own.*"), "labelled")
    chosen: list[tuple] = []
    for y in (0, 1):
        left = SAMPLE_CHARS // 2
        for r in known.where(F.col("__y") == y).orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").limit(SAMPLE_PER_CLASS).collect():
            if r["__n"] <= left:
                left -= r["__n"]
                chosen.append((r["__id"], r["__th"], y))
    if total and len({c[2] for c in chosen}) < 2 and not docs.isEmpty():
        raise ValueError(f"labelled rows by class {counts}, but texts to learn from only in the classes {sorted({c[2] for c in chosen})}")
    sample = F.broadcast(docs.sparkSession.createDataFrame(chosen, known.select("__id", "__th", "__y").schema))  # three numbers a row
    each = texts.join(sample, ["__id", "__th"]).groupBy("__id", "__y").agg(F.first("__text").alias("__text"))
    picked = each.orderBy(F.xxhash64(F.col("__id").cast("string")), "__id").select("__text", "__y").collect()
    return fit([r[0] for r in picked], [r[1] for r in picked], counts.get(1, 0) / total if total else None)


def score(model: Model, docs: DataFrame, text: Column) -> Column:
    """Score of each whole text, 0 to 1; null and empty texts are scored as texts without words."""
    if model.constant is not None:
        return F.lit(model.constant)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        model = shared.value
        if model.name not in _WORKER:
            _WORKER.clear()
            _WORKER[model.name] = _Margins(model)
        known = _WORKER[model.name]
        return pa.array([model.score(known.of(tokens(t.as_py()))) for t in texts], pa.float64())

    return run(text)


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 3 == 1


def op1_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels, only=~held_out(F.col("__id")))
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    scored = docs.select("doc_id", out.alias("held_out"), score(model, docs, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the rows whose score reaches the threshold."""
    model = train(docs, labels, only=~held_out(F.col("__id")))
    return docs.where(score(model, docs, F.col("text")) < THRESHOLD)

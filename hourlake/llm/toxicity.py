"""Operator 2: toxicity by a linear-chain conditional random field over tokens.

Labels are of documents, so tokens are labelled first: in a toxic document a token is toxic if it has
a feature (its word, or the first letters of it) that toxic documents hold in significantly more
distinct contexts than others. A two-state linear-chain field is fitted to these tokens. Its
forward-backward marginals give the toxic spans of a text with their offsets, and their sum and
largest value give the document's score through a logistic fit.
"""

from __future__ import annotations

import pickle
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.bpe import Memo, forget, give_back
from hourlake.llm.common import stored

#: The bound on labelled rows that a model is fitted on: toxic documents and others, taken in the order of a hash of the id.
TOXIC_ROWS = 1500
OTHER_ROWS = 3000
#: Documents of each kind on whose tokens the field is fitted, and steps of the fit.
FIELD_ROWS, STEPS = 250, 40
#: Letters of a word's beginning that are features of their own.
STEMS = (4, 5)
#: Least log-likelihood ratio and least ratio of rates at which a feature marks tokens; most features kept.
LEAST_RATIO, LEAST_TIMES, MOST_FEATURES = 24.0, 8.0, 20_000
#: A marginal from which a token belongs to a toxic span.
SPAN = 0.5
#: Tokens per step of the scans, and tokens that are scored at once.
CHUNK, TOKENS = 128, 1 << 18

_EDGE = "\"'.,;:!?()[]{}<>*_~`«»“”‘’¡¿-"
TOKEN = re.compile(r"\S+")


def features(token: str) -> tuple[str, ...]:
    """The word without marks at its ends, lower-cased, and its stems."""
    word = token.strip(_EDGE).lower()
    if not word:
        return ()
    return (f"w:{word}", *(f"{n}:{word[:n]}" for n in STEMS if len(word) > n))


def scan(steps: np.ndarray) -> np.ndarray:
    """For matrices steps[:, i, j], the row vectors (1, 1) @ steps[0] @ ... @ steps[t] for every t, each scaled to sum 1.

    Products inside chunks are built for all chunks at once; one short pass joins the chunks.
    """
    n = len(steps)
    rows = -(-n // CHUNK)
    padded = np.empty((rows * CHUNK, 2, 2))
    padded[:n], padded[n:] = steps, np.eye(2)
    padded = padded.reshape(rows, CHUNK, 2, 2)
    a, b, c, d = (np.ascontiguousarray(padded[:, :, i, j].T) for i in (0, 1) for j in (0, 1))
    p, q, r, s = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for k in range(CHUNK):
        p, q, r, s = p * a[k] + q * c[k], p * b[k] + q * d[k], r * a[k] + s * c[k], r * b[k] + s * d[k]
        scale = 1 / (p + q + r + s)
        p, q, r, s = p * scale, q * scale, r * scale, s * scale
    x, y, starts = 0.5, 0.5, np.empty((2, rows))
    for k, (p_, q_, r_, s_) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        starts[0, k], starts[1, k] = x, y
        x, y = x * p_ + y * r_, x * q_ + y * s_
        total = x + y
        x, y = x / total, y / total
    out = np.empty((CHUNK, rows, 2))
    x, y = starts
    for k in range(CHUNK):
        x, y = x * a[k] + y * c[k], x * b[k] + y * d[k]
        scale = 1 / (x + y)
        x, y = x * scale, y * scale
        out[k, :, 0], out[k, :, 1] = x, y
    return out.transpose(1, 0, 2).reshape(-1, 2)[:n]


def forward_backward(emit: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward and backward vectors of all sequences in a row.

    emit[t] is the score of state 1 over state 0 at token t; first marks tokens that begin a sequence, where the
    step's rows are equal and so forget what came before.
    """
    steps = np.empty((len(emit), 2, 2))
    shown = np.exp(np.clip(emit, -30, 30))
    for j in (0, 1):
        on = shown if j else 1.0
        for i in (0, 1):
            steps[:, i, j] = np.where(first, start[j], move[i, j]) * on
    forward = scan(steps)
    back = np.ones((len(emit), 2))
    if len(emit) > 1:
        back[:-1] = scan(steps[:0:-1].transpose(0, 2, 1))[::-1]
    return forward, back


@dataclass
class Model:
    """Weights of features, of state 1, of the start and of moves, and of the logistic fit."""

    weights: dict[str, float]
    bias: float
    start: float
    move: np.ndarray
    logistic: np.ndarray

    def __post_init__(self) -> None:
        self.emission = Memo(lambda token: self.bias + sum(self.weights.get(f, 0.0) for f in features(token)), 300_000)

    def __reduce__(self):
        return Model, (self.weights, self.bias, self.start, self.move, self.logistic)

    def marginals(self, texts: list[list[str]]) -> np.ndarray:
        """The probability of state 1 for each token of the texts in a row."""
        lengths = np.array([len(t) for t in texts])
        emit = np.fromiter((e for t in texts for e in map(self.emission.__getitem__, t)), np.float64, int(lengths.sum()))
        first = np.zeros(len(emit), bool)
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        forward, back = forward_backward(emit, first, np.exp([0.0, self.start]), np.exp(self.move))
        both = forward * back
        return both[:, 1] / both.sum(1)

    def evidence(self, texts: list[list[str]], found: np.ndarray) -> np.ndarray:
        """1, log(1 + expected toxic tokens) and the largest marginal of each text."""
        ends = np.cumsum([len(t) for t in texts])
        rows = np.zeros((len(texts), 3))
        rows[:, 0] = 1
        for k, t in enumerate(texts):
            if t:
                part = found[ends[k] - len(t) : ends[k]]
                rows[k, 1:] = np.log1p(part.sum()), part.max()
        return rows

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.logistic, -40, 40)))


def _marking(texts: list[list[str]], toxic: np.ndarray) -> dict[str, float]:
    """Features that mark toxic tokens. Contexts (a token and its neighbours) count once, so copies of a text add nothing."""
    seen: set[int] = set()
    new: tuple[list[str], list[str]] = ([], [])
    for tokens, label in zip(texts, toxic.tolist(), strict=True):
        for before, token, after in zip(["", *tokens], tokens, [*tokens[1:], ""], strict=False):
            context = hash((before, token, after, label))
            if context not in seen:
                seen.add(context)
                new[label].append(token)
    totals = [len(n) for n in new]
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for into, found in zip(counts, new, strict=True):
        for token, n in Counter(found).items():
            for feature in features(token):
                into[feature] += n
    out = {}
    for feature, k1 in counts[1].items():
        k0, n1, n0 = counts[0][feature], totals[1], max(totals[0], 1)
        rate = (k1 + k0) / (n1 + n0)
        part = lambda k, n: k * np.log(k / (n * rate)) if k else 0.0
        ratio = 2 * (part(k1, n1) + part(k0, n0))
        if ratio >= LEAST_RATIO and k1 / n1 >= LEAST_TIMES * (k0 + 0.5) / n0:
            out[feature] = float(ratio)
    return dict(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:MOST_FEATURES])


def _fit_field(texts: list[list[str]], toxic: np.ndarray, marking: dict[str, float]) -> tuple[dict[str, float], float, float, np.ndarray]:
    """Weights by gradient ascent on the conditional likelihood of the labelled tokens, with a small square penalty."""
    names = list(marking)
    place = {f: k for k, f in enumerate(names)}
    at, which, labels, first = [], [], [], []
    n = 0
    for tokens, label in zip(texts, toxic, strict=True):
        for k, token in enumerate(tokens):
            hits = [place[f] for f in features(token) if f in place]
            at += [n] * len(hits)
            which += hits
            labels.append(int(label and bool(hits)))
            first.append(k == 0)
            n += 1
    at, which, labels, first = np.array(at, int), np.array(which, int), np.array(labels, float), np.array(first, bool)
    w, bias, start, move = np.zeros(len(names)), -2.0, 0.0, np.zeros((2, 2))
    held = [np.zeros_like(x) for x in (w, np.zeros(1), np.zeros(1), move)] * 2
    steps_on = ~first[1:]
    pairs = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            pairs[i, j] = ((labels[:-1] == i) & (labels[1:] == j) & steps_on).sum()
    for step in range(1, STEPS + 1):
        emit = np.bincount(at, w[which], n) + bias
        forward, back = forward_backward(emit, first, np.exp([0.0, start]), np.exp(move))
        both = forward * back
        p = both[:, 1] / both.sum(1)
        shown = np.stack([np.ones(n - 1), np.exp(np.clip(emit[1:], -30, 30))], 1)
        joint = forward[:-1, :, None] * np.exp(move)[None] * (shown * back[1:])[:, None, :]
        joint = joint[steps_on] / joint[steps_on].sum((1, 2), keepdims=True)
        rest = labels - p
        slopes = (
            np.bincount(which, rest[at], len(names)) - 0.05 * w,
            np.array([rest.sum() - 0.01 * bias]),
            np.array([rest[first].sum() - 0.01 * start]),
            pairs - joint.sum(0) - 0.05 * move,
        )
        moves = []
        for k, g in enumerate(slopes):
            held[k] = 0.8 * held[k] + 0.2 * g
            held[k + 4] = 0.9 * held[k + 4] + 0.1 * g * g
            moves.append(0.4 / (1 + 2 * step / STEPS) * held[k] / (np.sqrt(held[k + 4]) + 1e-3))
        w, bias, start, move = w + moves[0], bias + moves[1][0], start + moves[2][0], np.clip(move + moves[3], -3, 3)
    return {f: float(x) for f, x in zip(names, w, strict=True) if x}, float(bias), float(start), move


def _fit_logistic(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Newton's method with a ridge."""
    w = np.zeros(rows.shape[1])
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -40, 40)))
        slope = rows.T @ (labels - p) - ridge @ w
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + ridge
        w = w + np.clip(np.linalg.solve(curve, slope), -5, 5)
    return w


def fit(texts: list[str], toxic: list[int]) -> Model:
    """A model of labelled texts. Without texts of both kinds every score is the share of toxic ones (one half for none)."""
    tokens, labels = [list(map(sys.intern, t.split())) for t in texts], np.array(toxic, int)
    share = min(max(labels.mean() if len(labels) else 0.5, 1e-6), 1 - 1e-6)
    if len(set(toxic)) < 2 or not (marking := _marking(tokens, labels)):
        return Model({}, -20.0, 0.0, np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    chosen = [k for label in (1, 0) for k in np.flatnonzero(labels == label)[:FIELD_ROWS]]
    field = _fit_field([tokens[k] for k in chosen], labels[chosen], marking)
    model = Model(*field, np.zeros(3))
    parts = [tokens[k : k + 200] for k in range(0, len(tokens), 200)]
    rows = np.concatenate([model.evidence(part, model.marginals(part) if any(part) else np.empty(0)) for part in parts])
    return Model(*field, _fit_logistic(rows, labels))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS) -> bytes:
    """A pickled model of documents (doc_id, text) and labels (doc_id, toxic), fitted on an executor.

    At most toxic_rows and other_rows labelled rows are used, in the order of a hash of the id; only
    their ids are joined to the texts by broadcast, and only the model comes to the driver.

    Nulls: rows with a null doc_id, and labels with a null toxic, are not learnt from; a null text is the empty one. An id with several labels is toxic if
    one says so; of an id with several texts the first in their order is taken, so that the model is the same in every run. Without labelled rows, or with empty
    tables, every score is the same. Other columns are not read.
    """
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    labels = labels.withColumn("place", F.xxhash64("doc_id"))
    parts = [labels.where(F.col("toxic") == kind).orderBy("place", "doc_id").limit(most) for kind, most in ((1, toxic_rows), (0, other_rows))]
    chosen = stored(parts[0].union(parts[1]), "toxicity-sample")
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("place", "doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    sample = sample.select("place", "doc_id", "text", "toxic").repartition(1).sortWithinPartitions("place", "doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        texts, toxic = [], []
        for batch in batches:  # bounded by the sample
            texts += batch.column(2).to_pylist()
            toxic += batch.column(3).to_pylist()
        made = pickle.dumps(fit(texts, toxic))
        del texts, toxic
        forget()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["model"])

    made = sample.mapInArrow(work, "model binary").collect()
    return bytes(made[0]["model"]) if made else pickle.dumps(fit([], []))


def _models() -> dict[bytes, Model]:
    """Models that this worker has unpacked, by digest."""
    return _models.__dict__.setdefault("held", {})


def _model(packed: bytes) -> Model:
    held, key = _models(), xxhash.xxh3_128_digest(packed)
    if key not in held:
        held.clear()
        held[key] = pickle.loads(packed)
    return held[key]


def spans(text: str, found: np.ndarray) -> list[dict]:
    """Character offsets of runs of toxic tokens, with the largest marginal of each."""
    out: list[dict] = []
    for k, m in enumerate(TOKEN.finditer(text)):
        if found[k] >= SPAN:
            if out and out[-1]["last"] == k - 1:
                out[-1] |= {"end": m.end(), "last": k, "p": max(out[-1]["p"], float(found[k]))}
            else:
                out.append({"begin": m.start(), "end": m.end(), "last": k, "p": float(found[k])})
    return [{k: s[k] for k in ("begin", "end", "p")} for s in out]


KIND = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])))])


def score(df: DataFrame, model: bytes, text: str = "text", into: str = "toxicity") -> DataFrame:
    """Add `into`, a struct of score (0 to 1) and spans (begin, end in characters, p).

    Nulls: a null text is scored as the empty text, which has the logistic fit's score for no evidence and no spans.
    Other columns pass through and are no inputs; an existing column named `into` is replaced. Whole texts are
    scored, whatever their length, repeated rows each; an empty table stays empty.
    """
    packed = df.sparkSession.sparkContext.broadcast(model)  # MOST_FEATURES bounds its size

    @F.arrow_udf("score double, spans array<struct<begin int, end int, p double>>")
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = _model(packed.value)
        forget(made.emission)

        def scored(texts: list[str], tokens: list[list[str]]) -> pa.Array:
            found = made.marginals(tokens) if any(tokens) else np.empty(0)
            evidence = made.evidence(tokens, found)
            ends, rows = np.cumsum([len(t) for t in tokens]), []
            for k, (t, s) in enumerate(zip(texts, made.scores(evidence).tolist(), strict=True)):
                rows.append({"score": s, "spans": spans(t, found[ends[k] - len(tokens[k]) : ends[k]]) if evidence[k, 2] >= SPAN else []})
            return pa.array(rows, KIND)

        for batch in batches:
            texts, tokens, n = [], [], 0
            for value in batch:
                texts.append(value.as_py() or "")
                tokens.append(texts[-1].split())
                n += len(tokens[-1])
                if n >= TOKENS or len(texts) >= 2000:
                    yield scored(texts, tokens)
                    texts, tokens, n = [], [], 0
            if texts:
                yield scored(texts, tokens)

    return df.withColumn(into, work(F.coalesce(F.col(text), F.lit(""))))


def training_rows(labels: DataFrame) -> DataFrame:
    """Labels of the rows that may be learnt from: crc32 of the id as text leaves a remainder by 5."""
    return labels.where(~held_out(F.col("doc_id")))


def held_out(doc_id):
    """Whether crc32(doc_id as text) mod 5 is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))

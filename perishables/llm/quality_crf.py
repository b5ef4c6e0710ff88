"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad.  A line's potentials come from its own features, those of the
lines around it, and the label of the line before it.  Forward-backward gives each line's probability
of being good; their mean, weighted by line length, is the document's raw quality, which a logistic curve
fitted on the training documents turns into the score.

Labels mark documents, not lines.  Training starts from every line bearing its document's label and
then alternates: the field is fitted, and in bad documents the lines that it finds good become good (the
worst line of each stays bad).

The field learns from a bounded sample (``max_docs`` labelled documents, half of them of either label where there are
enough, by hash), scores cover all rows and whole texts.

Defined cases: a null text counts as empty; an empty text is one empty line and gets a score like any other;
without any training document every score is 0.5; a row without label is not learned from; other columns are not
looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables.llm.common import small_batches

UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = UPPER + UPPER.lower()
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>{}[]\\^~=+_@"
STOPS = b".!?;:,"
END = re.compile(rb"[.!?:;\"')\]]\s*$")
N_FEATURES = 18


# -------------------------------------------------------------------- features
def _without(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def line_features(raw: bytes, before: bytes | None) -> tuple[float, ...]:
    """Statistics of one line, each about 0 to 1."""
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return (1.0, *(0.0,) * (N_FEATURES - 1))
    lowered = [w.lower() for w in words]
    twice = sum(map(bytes.__eq__, lowered, lowered[1:]))
    distinct = len(set(lowered))
    letters = _without(raw, LETTERS) + sum(c >= 0x80 for c in raw) if not raw.isascii() else _without(raw, LETTERS)
    upper, digits, symbols = _without(raw, UPPER), _without(raw, DIGITS), _without(raw, SYMBOLS)
    bangs, stops, pipes = raw.count(b"!"), _without(raw, STOPS), raw.count(b"|")
    mean = (size - n + 1) / n
    return (
        0.0, min(1.0, n / 100), min(1.0, n / 5), min(1.0, mean / 15), float(mean > 10), letters / size,
        upper / max(1, letters), digits / size, min(1.0, 5 * symbols / size), min(1.0, bangs / n), stops / n if stops < n else 1.0,
        min(1.0, pipes / n), twice / n, distinct / n, min(1.0, np.sqrt(n) * (1 - distinct / n) / 5),
        float(END.search(raw) is not None), float(raw[:1] in UPPER or raw[:1] >= b"\xc3") if raw[:1] else 0.0,
        float(raw == before),
    )


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line beside those of its neighbours (zero at the ends), and line lengths."""
    lines = (text or "").encode().split(b"\n")
    own = np.array([line_features(raw, before) for raw, before in zip(lines, [None, *lines])])
    pad = np.zeros((1, N_FEATURES))
    around = np.concatenate(([*pad, *own[:-1]], own, [*own[1:], *pad]), axis=1) if len(own) > 1 else \
        np.concatenate((pad, own, pad), axis=1)
    return np.concatenate((around, np.ones((len(own), 1))), axis=1), np.array([len(raw) + 1.0 for raw in lines])


# ----------------------------------------------------------------------- field
@dataclass
class LineField:
    """``weights``: what a line's features add to "good"; ``moves[a, b]``: what label b after label a adds."""

    weights: np.ndarray
    moves: np.ndarray
    curve: tuple[float, float] = (0.0, 1.0)  # of the score over the raw quality's log-odds

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """P(good) of each line of one document, by forward-backward in scaled form."""
        odds = np.exp(np.clip(x @ self.weights, -30, 30)).tolist()
        (bb, bg), (gb, gg) = np.exp(self.moves).tolist()
        n = len(odds)
        forward, bad, good = [], 0.0, 0.0
        for t, e in enumerate(odds):
            bad, good = (bad * bb + good * gb, (bad * bg + good * gg) * e) if t else (1.0, e)
            total = bad + good
            bad, good = bad / total, good / total
            forward.append(good)
        out = [0.0] * n
        bad = good = 1.0
        for t in range(n - 1, -1, -1):
            g = forward[t] * good
            out[t] = g / (g + (1 - forward[t]) * bad)
            e = good * odds[t]
            bad, good = bb * bad + bg * e, gb * bad + gg * e
            total = bad + good
            bad, good = bad / total, good / total
        return np.array(out)

    def quality(self, x: np.ndarray, sizes: np.ndarray) -> float:
        return float(self.marginals(x) @ sizes / sizes.sum())

    def score(self, text: str | None) -> float:
        return float(_curve(self.quality(*document_features(text)), *self.curve))


def _log_odds(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _curve(quality, shift: float, slope: float):
    return 1 / (1 + np.exp(-np.clip(shift + slope * _log_odds(quality), -30, 30)))


class _Chains:
    """Many documents at once: step t holds the t-th line of every document that has one."""

    def __init__(self, xs: list[np.ndarray]) -> None:
        order = sorted(range(len(xs)), key=lambda i: -len(xs[i]))
        sizes = np.array([len(xs[i]) for i in order])
        first = np.concatenate(([0], np.cumsum([len(x) for x in xs])))[:-1]
        self.steps = [first[order[:int((sizes > t).sum())]] + t for t in range(int(sizes.max(initial=0)))]

    def expectations(self, emit: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line and the summed probability of each pair of neighbouring labels."""
        a = np.empty((len(emit), 2))
        scores = np.stack((np.zeros_like(emit), emit), axis=1)
        for t, rows in enumerate(self.steps):
            a[rows] = scores[rows]
            if t:
                before = a[self.steps[t - 1][:len(rows)]]
                a[rows] += np.logaddexp(before[:, :1] + moves[0], before[:, 1:] + moves[1])
        b = np.zeros((len(emit), 2))
        pairs = np.zeros((2, 2))
        for t in range(len(self.steps) - 1, 0, -1):
            rows = self.steps[t]
            before = self.steps[t - 1][:len(rows)]
            ahead = (scores[rows] + b[rows])[:, None, :] + moves[None]
            b[before] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
            joint = a[before][:, :, None] + ahead
            joint -= joint.max(axis=(1, 2), keepdims=True)
            joint = np.exp(joint)
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        both = a + b
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -50, 50))), pairs

    def pair_counts(self, good: np.ndarray) -> np.ndarray:
        pairs = np.zeros((2, 2))
        for before, rows in zip(self.steps, self.steps[1:]):
            x, y = good[before[:len(rows)]], good[rows]
            pairs += [[((1 - x) * (1 - y)).sum(), ((1 - x) * y).sum()], [(x * (1 - y)).sum(), (x * y).sum()]]
        return pairs


def _fit_field(chains: _Chains, x: np.ndarray, good: np.ndarray, weight: np.ndarray, w: np.ndarray, moves: np.ndarray,
               steps: int, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Gradient ascent (Adam) on the conditional log-likelihood of the line labels; ``weight`` balances lines."""
    w, moves = w.copy(), moves.copy()
    seen, n = chains.pair_counts(good), max(1.0, weight.sum())
    grads = [np.zeros_like(w), np.zeros_like(moves)]
    squares = [np.zeros_like(w), np.zeros_like(moves)]
    for step in range(1, steps + 1):
        p, pairs = chains.expectations(x @ w, moves)
        for k, (value, g) in enumerate(((w, x.T @ ((good - p) * weight) / n - decay * w),
                                        (moves, (seen - pairs) / n - decay * moves))):
            grads[k] += 0.1 * (g - grads[k])
            squares[k] += 0.01 * (g * g - squares[k])
            value += rate * (grads[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.99**step)) + 1e-8)
    return w, moves


def fit(texts: list[str | None], labels: list[int], rounds: int = 3, steps: int = 60) -> LineField:
    """A field from whole documents and their labels (1 good, 0 bad)."""
    n = 3 * N_FEATURES + 1
    field = LineField(np.zeros(n), np.zeros((2, 2)))
    if not texts:
        return field
    docs = [document_features(t) for t in texts]
    xs, sizes = [x for x, _ in docs], [s for _, s in docs]
    chains, x = _Chains(xs), np.concatenate(xs)
    owner = np.repeat(np.arange(len(xs)), [len(d) for d in xs])
    label = np.array(labels, float)
    good = label[owner]
    for _ in range(rounds):
        share = np.array([max(1.0, (good == k).sum()) for k in (0, 1)])
        weight = (len(good) / 2 / share)[good.astype(int)]
        w, moves = _fit_field(chains, x, good, weight, field.weights, field.moves, steps)
        field = LineField(w, moves)
        p, _ = chains.expectations(x @ w, moves)
        worst = np.full(len(xs), np.inf)
        np.minimum.at(worst, owner, p)
        good = np.where(label[owner] == 1, 1.0, ((p > 0.5) & (p > worst[owner])).astype(float))
    raw = _log_odds(np.array([field.quality(a, s) for a, s in zip(xs, sizes)]))
    shift, slope = 0.0, 1.0
    for _ in range(500):  # logistic regression in one variable
        error = label - 1 / (1 + np.exp(-np.clip(shift + slope * raw, -30, 30)))
        shift, slope = shift + 0.5 * error.mean(), max(0.0, slope + 0.05 * (error * raw).mean())
    field.curve = (shift, slope)
    return field


# ----------------------------------------------------------------------- Spark
def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_docs: int = 3000, max_chars: int = 40_000) -> LineField:
    """A field from at most ``max_docs`` labelled documents of at most ``max_chars`` characters each (longer ones are not
    learned from, but scored like any other).  The bound holds for ids and for rows; an id with both labels, or of several
    texts, is learned from as that many documents."""
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("label")).distinct()
    known = None
    for value in (0, 1):
        one = marks.filter(F.col("label") == value).orderBy(F.xxhash64("id", F.lit("quality")), "id").limit(max_docs // 2)
        known = one if known is None else known.unionAll(one)
    # at most max_docs ids, and at most that many rows of them: each task hands on no more than the bound
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("id", "text", F.lit("row")), "id", "text"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .filter(F.coalesce(F.char_length("text"), F.lit(0)) <= max_chars).join(F.broadcast(known), "id") \
        .withColumn("place", place).filter(F.col("place") <= max_docs // 2)
    got = sorted((r["id"], r["label"], r["text"] or "") for r in rows.collect())
    return fit([text for _, _, text in got], [label for _, label, _ in got])


def score(docs: DataFrame, field: LineField, text_col: str = "text") -> Column:
    """The score of each whole text of ``docs`` as a column."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series([field.score(t) for t in texts], dtype=float)

    return scores(F.col(f"`{text_col}`").cast("string"))

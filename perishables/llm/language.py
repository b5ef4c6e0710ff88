"""Language identification by error-correcting output codes.

Every known language gets a codeword.  One binary classifier per bit (logistic, over
hashed byte trigrams of the lower-cased letters) predicts that bit for a text.  Decoding weights each
bit's logistic loss by how well its classifier does on the language, and takes the
codeword of least loss; a text whose two best codewords lie close is flagged as ambiguous.

Training takes a bounded sample: of each language the ``per_language`` labelled documents of
least hash, fewer where all languages together would have more than ``max_rows`` (but one of each).  Rows of equal id and
text are one document.  Prediction covers all rows and whole texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text where
nothing was learned; with one language every other text is of that language; rows without language or
with a null text are not learned from; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables.llm.common import small_batches, store

BUCKETS_LOG2 = 13
LOSSES = 1 << 22         # of texts, languages and bits that are held at once
UNDETERMINED = "und"
ASCII_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANKS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def has_letter(text: str | None) -> bool:
    if not text:
        return False
    raw = text.encode()
    return len(raw.translate(None, ASCII_LETTERS)) < len(raw) or not text.isascii() and any(map(str.isalpha, text))


def trigrams(text: str) -> np.ndarray:
    """How often each bucket of hashed byte trigrams occurs; runs of ASCII non-letters count as blanks."""
    raw = np.frombuffer(b"  " + text.lower().encode().translate(_BLANKS) + b" ", np.uint8).astype(np.uint32)
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    return np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS_LOG2), minlength=1 << BUCKETS_LOG2)


def _features(counts: np.ndarray) -> np.ndarray:
    """Square roots of relative frequencies, in rows of length one."""
    return np.sqrt(counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """-1/+1 words of ``n`` languages: every split of them for up to five, else the random words
    whose least distance is greatest."""
    if n < 2:
        return np.ones((n, 0), np.int8)
    if n <= 5:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, np.int8).T
    rng, width = np.random.default_rng(seed), math.ceil(10 * math.log2(n))
    best, apart = None, -1
    for _ in range(50):
        words = rng.choice(np.array([-1, 1], np.int8), (n, width))
        distance = (width - words.astype(int) @ words.T) // 2 + np.eye(n, dtype=int) * width
        if (abs(words.sum(axis=0)) < n).all() and distance.min() > apart:
            best, apart = words, distance.min()
    return best if best is not None else np.where(np.eye(n), 1, -1).astype(np.int8)


@dataclass
class CodeModel:
    languages: list[str]
    words: np.ndarray    # language x bit
    weights: np.ndarray  # bucket x bit
    bias: np.ndarray
    trust: np.ndarray    # language x bit, each row sums to the number of bits

    @classmethod
    def fit(cls, counts: np.ndarray, names: list[str], steps: int = 150, rate: float = 0.5, decay: float = 1e-5) -> CodeModel:
        """``counts`` of 32-bit floats become the features where they are, so that there is one such matrix."""
        languages = sorted(set(names))
        words = codewords(len(languages))
        place = {name: k for k, name in enumerate(languages)}
        which = np.array([place[name] for name in names], int)
        x = np.asarray(counts, np.float32)
        x /= np.maximum(x.sum(axis=-1, keepdims=True), 1)
        np.sqrt(x, out=x)
        y = (words[which] > 0).astype(np.float32)
        share = np.bincount(which, minlength=len(languages))
        weight = (1.0 / np.maximum(share, 1))[which][:, None].astype(np.float32)  # each language counts alike
        weight /= max(float(weight.sum()), 1e-9)
        w, b = np.zeros((x.shape[1], words.shape[1]), np.float32), np.zeros(words.shape[1], np.float32)
        first, second = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
        for step in range(1, steps + 1 if len(languages) > 1 else 1):
            error = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) * weight
            for k, (p, g) in enumerate(((w, x.T @ error + decay * w), (b, error.sum(axis=0)))):
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                p -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        right = ((x @ w + b > 0) == (y > 0)).astype(float)
        trust = np.array([right[which == k].mean(axis=0) for k in range(len(languages))]).reshape(words.shape)
        trust = np.maximum(trust, 1e-3)
        if words.shape[1]:
            trust *= words.shape[1] / trust.sum(axis=1, keepdims=True)
        return cls(languages, words, w, b, trust)

    def predict(self, texts: list[str | None], margin: float) -> pd.DataFrame:
        """Language, score (the share of the codeword under a soft minimum of the losses) and whether ambiguous."""
        known = np.array([bool(self.languages) and has_letter(t) for t in texts], bool)
        names, scores, unsure = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        at = np.flatnonzero(known)
        if len(at):
            bits = np.array([_features(trigrams(texts[i])) @ self.weights + self.bias for i in at])
            few = max(1, LOSSES // max(1, self.words.size))  # texts at a time
            loss = np.concatenate([(self.trust * np.logaddexp(0, -self.words[None] * bits[i:i + few, None, :])).sum(axis=2)
                                   for i in range(0, len(bits), few)])
            share = np.exp(loss.min(axis=1, keepdims=True) - loss)
            share /= share.sum(axis=1, keepdims=True)
            best = loss.argmin(axis=1)
            scores[at] = share[np.arange(len(at)), best]
            if len(self.languages) > 1:
                two = np.sort(loss, axis=1)[:, :2]
                unsure[at] = two[:, 1] - two[:, 0] < margin
            for i, k in zip(at, best):
                names[i] = self.languages[k]
        return pd.DataFrame({"lang_pred": names, "score": scores, "ambiguous": unsure})


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = 500, max_rows: int = 30_000) -> CodeModel:
    """A model from the bounded sample of ``labelled``; trigram counts are taken in the tasks.

    The driver gets sparse counts and holds one matrix of ``max_rows`` rows (1 GB at most; one row of each
    language where there are more languages than that).  A text under two languages is learned from as each of them.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col, F.lit("language")).alias("h"), F.col(text_col).alias("text"))
    keys = store(rows.select("lang", "h").distinct(), "language-keys")
    sizes = store(keys.groupBy("lang").count(), "language-sizes")
    each = min(per_language, max(1, max_rows // max(1, sizes.count())))
    by_hash = Window.partitionBy("lang").orderBy("h")
    # a frequent language's documents are thinned by hash before they are ordered: about twenty more than three times what is picked
    share = F.pmod(F.col("h"), F.lit(1 << 30)) / F.lit(float(1 << 30)) <= (3.0 * each + 20) / F.col("count")
    picked = keys.join(F.broadcast(sizes), "lang").filter(share) \
        .withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= each).select("lang", "h")
    # one row of each key: at most max_rows, or one of each language
    sample = rows.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [trigrams(t) for t in batch.column("text").to_pylist()]
            at = [np.flatnonzero(c) for c in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())),
                 pa.array([c[a].astype(np.int32) for c, a in zip(every, at)], pa.list_(pa.int32()))],
                names=["lang", "at", "n"])

    got = sample.mapInArrow(count, "lang string, at array<int>, n array<int>").orderBy("lang", F.hash("at", "n")).collect()
    counts = np.zeros((len(got), 1 << BUCKETS_LOG2), np.float32)
    for row, own in zip(counts, got):
        row[own["at"]] = own["n"]
    return CodeModel.fit(counts, [row["lang"] for row in got])


def predict(docs: DataFrame, model: CodeModel, text_col: str = "text", margin: float = 1.0) -> Column:
    """A struct column (lang_pred, score, ambiguous) for the whole texts of ``docs``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x bits

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def guess(texts: pd.Series) -> pd.DataFrame:
        return shared.value.predict(texts.tolist(), margin)

    return guess(F.col(f"`{text_col}`").cast("string"))

"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates.

A text is cut into words and runs of punctuation. Features are hashed n-grams: each word, each pair of
neighbouring words, and n-grams of word classes (lower, title, upper case, digits, punctuation) marked
when a word repeats the word before it or the one before that. A feature's value is its count over the
square root of the number of words, so the score is a sparse dot product over the whole text.

Training takes a bounded sample of labelled rows (``MAX_TRAIN_ROWS``, chosen by a hash of the id), deals it
to ``SHARDS`` groups, runs the updates in each and averages the weights (2**BITS numbers per group).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hold_cache

BITS = 18
MAX_TRAIN_ROWS = 24_000
SHARDS = 6
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5
CACHE_ENTRIES = 400_000

_TOKENS = re.compile(r"\w+|[^\w\s]+")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - BITS)


class _Words(dict):
    """Word -> 61 bits of hash and 3 bits of class; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        if not (word[0].isalnum() or word[0] == "_"):
            kind = 0
        elif word.isdigit():
            kind = 1
        elif word.islower():
            kind = 2
        elif word.isupper() and len(word) > 1:
            kind = 3
        elif word.istitle():
            kind = 4
        else:
            kind = 5
        self[word] = value = xxhash.xxh64_intdigest(word.lower()) & ~7 | kind
        return value


_words = _Words()


def features(text: str) -> tuple[np.ndarray, int]:
    """Feature places (repeats stand for counts) and the number of words."""
    tokens = _TOKENS.findall(text)
    n = len(tokens)
    packed = np.fromiter(map(_words.__getitem__, tokens), np.uint64, n)
    word, kind = packed >> np.uint64(3), packed & np.uint64(7)
    one = word * _MULTIPLY
    two = (word[:-1] * np.uint64(3) + word[1:]) * _MULTIPLY
    same = np.zeros(n, np.uint64)
    same[1:] |= word[1:] == word[:-1]
    same[2:] |= (word[2:] == word[:-2]).astype(np.uint64) << np.uint64(1)
    mark = kind | same << np.uint64(3)
    classes = np.concatenate([mark[1:] | mark[:-1] << np.uint64(5), (mark[2:] | mark[1:-1] << np.uint64(5) | mark[:-2] << np.uint64(10)) + np.uint64(1 << 20)])
    shaped = (classes + np.uint64(1 << 40)) * _MULTIPLY
    return (np.concatenate([one, two, shaped * _MULTIPLY]) >> _SHIFT).astype(np.int64), n


@dataclass(frozen=True)
class Model:
    """Weights of the features and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        """Probability of label 1; of an empty text too."""
        places, n = features(text)
        z = self.intercept + float(self.weights[places].sum(dtype=np.float64)) / max(n, 1) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def fit_rows(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Follow-the-regularised-leader updates over rows in the order given."""
    size = (1 << BITS) + 1  # the last place is the intercept
    z, s = np.zeros(size), np.zeros(size)
    rows = []
    for text in texts:
        places, n = features(text)
        at, counts = np.unique(places, return_counts=True)
        rows.append((np.append(at, size - 1), np.append(counts / max(n, 1) ** 0.5, 1.0)))

    def weights(z: np.ndarray, s: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(s)) / ALPHA + L2))

    for _ in range(epochs):
        for (at, x), y in zip(rows, labels):
            w = weights(z[at], s[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            step = (np.sqrt(s[at] + g * g) - np.sqrt(s[at])) / ALPHA
            z[at] += g - step * w
            s[at] += g * g
    w = weights(z, s)
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def is_held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          max_rows: int = MAX_TRAIN_ROWS, shards: int = SHARDS) -> Model:
    """Fit on at most about ``max_rows`` labelled rows that aren't held out.

    Null ids and labels are left out; of several labels of one id the largest holds; a document row that
    is repeated is learnt from each time. Without any label the model scores 0.5 everywhere.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~is_held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y")))
    share = min(1.0, max_rows / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # about max_rows rows of two numbers: the bound of this broadcast
    rows = (docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
            .join(F.broadcast(sample), "_id"))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        hold_cache("quality", _words.clear)
        part = part.sort_values(["_order", "_text"])
        m = fit_rows(part["_text"].tolist(), part["_y"].tolist())
        return pd.DataFrame({"weights": [m.weights.tobytes()], "intercept": [m.intercept]})

    dealt = rows.select("_text", "_y", F.xxhash64("_id", F.lit(7)).alias("_order"), F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(shards)).alias("_shard"))
    parts = dealt.groupBy("_shard").applyInPandas(fit, "weights binary, intercept double").collect()  # at most `shards` rows
    if not parts:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    weights = sum(np.frombuffer(p["weights"], np.float32).astype(np.float64) for p in parts) / len(parts)
    return Model(weights.astype(np.float32), sum(p["intercept"] for p in parts) / len(parts))


def score(docs: DataFrame, model: Model, out_col: str = "score", text_col: str = "text") -> DataFrame:
    """Add the probability of label 1 of every whole text; null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold_cache("quality", _words.clear)
        m = shared.value
        for texts in parts:
            yield pd.Series([m.score(t or "") for t in texts], dtype="float64")

    return docs.withColumn(out_col, scored(F.col(text_col)))

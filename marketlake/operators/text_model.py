"""A linear text classifier fitted by Spark aggregates (U1, F17): hashed words, multinomial logistic regression.

Features are native expressions, each once per text: folded words and pairs of neighbouring words, hashed to
``2 ** bits`` places, with the value 1 / sqrt(number of them); and how the text is written (capitals, marks, digits,
a word said twice), hashed to ``MARKS`` places of their own, with the value 1. One iteration is one aggregate over the training rows:
their class probabilities come from the current weights (literal arrays in the plan), the gradient of each place is
summed with map-side partial sums, so a shuffle moves at most ``2 ** bits`` rows per task and the driver gets that many
numbers per class, whatever the number of texts. Steps follow AdaGrad. No Python runs on rows.

Rows without a label or without words don't train; a text without words gets the most frequent class.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import col
from ..functions.sentiment import ACCENTS_FROM, ACCENTS_TO
from ..session import remove_staged, stage

BITS = 14
MARKS = 1024
ITERATIONS = 10
RATE = 0.1
RIDGE = 1e-3


def places(text, bits: int = BITS) -> Column:
    """The places of a text's words, word pairs and marks, each once, in ascending order; empty for a text without any."""
    given = F.coalesce(col(text), F.lit(""))
    folded = F.translate(F.lower(given), ACCENTS_FROM, ACCENTS_TO)
    words = F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    # every word as it is written: letters of one case as one, digits as one, marks as they are
    written = given
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lo}\p{Lm}\p{Lt}]+", "a"), (r"\p{N}+", "0")):
        written = F.regexp_replace(written, pattern, sign)
    shapes = F.filter(F.split(written, r"\s+"), lambda w: w != "")

    def neighbours(w: Column, pair) -> Column:
        return F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), pair)

    def hashed(w: Column) -> Column:
        seen = F.concat(F.transform(w, lambda x: F.xxhash64(x)), neighbours(w, lambda a, b: F.xxhash64(a, b)))
        twice = F.filter(neighbours(w, lambda a, b: F.when(a == b, F.xxhash64(F.lit("twice")))), lambda h: h.isNotNull())
        marks = F.concat(F.transform(shapes, lambda x: F.xxhash64(x)), twice)
        return F.concat(F.transform(seen, lambda h: F.pmod(h, F.lit(2 ** bits)).cast("int")),
                        F.transform(marks, lambda h: (F.pmod(h, F.lit(MARKS)) + 2 ** bits).cast("int")))
    return F.array_sort(F.array_distinct(F.transform(F.array(words), hashed)[0]))


def _parts(at: Column, bits: int) -> Column:
    """Word places, mark places, and the value of each word place: 1 / sqrt(number of word places)."""
    words, marks = F.filter(at, lambda p: p < 2 ** bits), F.filter(at, lambda p: p >= 2 ** bits)
    return F.transform(F.array(F.struct(words.alias("words"), marks.alias("marks"))), lambda s: F.struct(
        s["words"].alias("words"), s["marks"].alias("marks"), (1 / F.sqrt(F.greatest(F.size(s["words"]), F.lit(1)).cast("double"))).alias("x")))[0]


def _margin(parts: Column, weights: list[float], bias: float) -> Column:
    """bias + sum over the places of weight times value."""
    literal = F.from_json(F.lit(json.dumps(weights)), "array<double>")

    def total(w: Column) -> Column:
        def added(at: Column) -> Column:
            return F.aggregate(at, F.lit(0.0), lambda s, p: s + F.element_at(w, p + 1))
        return added(parts["words"]) * parts["x"] + added(parts["marks"])
    return F.lit(bias) + F.transform(F.array(literal), total)[0]


@dataclass
class TextModel:
    classes: list[str]
    weights: list[list[float]]
    biases: list[float]
    fallback: str
    bits: int = BITS
    losses: list[float] = field(default_factory=list)

    def probabilities(self, parts: Column) -> Column:
        """An array with the probability of each class, of a text's ``_parts``."""
        margins = F.array(*[_margin(parts, w, b) for w, b in zip(self.weights, self.biases)])

        def softmax(m: Column) -> Column:
            top = F.array_max(m)
            powers = F.transform(m, lambda x: F.exp(x - top))
            return F.transform(F.array(powers), lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y)))[0]
        return F.transform(F.array(margins), softmax)[0]

    def label(self, text) -> Column:
        """The most likely class (ties: the first in name order); ``fallback`` for a text without words."""
        def best(parts: Column) -> Column:
            scored = F.array(*[F.struct((-_margin(parts, w, b)).alias("m"), F.lit(c).alias("c")) for c, w, b in zip(self.classes, self.weights, self.biases)])
            return F.when(F.size(parts["words"]) + F.size(parts["marks"]) == 0, F.lit(self.fallback)).otherwise(F.array_min(scored)["c"])
        return F.transform(F.transform(F.array(places(text, self.bits)), lambda at: _parts(at, self.bits)), best)[0]


def _each_place(data: DataFrame, model: TextModel) -> DataFrame:
    """A row per place of a text: the errors of the text's classes, the value of its words, its loss. All of a text is
    reckoned before its places become rows, so the work grows with a text's length, not with its square.
    Place -1 gathers the bias and the loss."""
    scored = data.select("_label", "_parts", model.probabilities(F.col("_parts")).alias("_p"))
    error = [F.element_at("_p", k + 1) - (F.col("_label") == c).cast("double") for k, c in enumerate(model.classes)]
    chosen = F.element_at("_p", F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col("_label")).cast("int"))
    of_text = scored.select(F.concat(F.array(F.lit(-1)), "_parts.words", "_parts.marks").alias("_at"), F.col("_parts.x").alias("_x"),
                            *[e.alias(f"_e{k}") for k, e in enumerate(error)], (-F.log(F.greatest(chosen, F.lit(1e-300)))).alias("_loss"))
    return of_text.select(F.explode("_at").alias("_place"), "_x", *[f"_e{k}" for k in range(len(error))], "_loss")


def fit(rows: DataFrame, text: str, label: str, bits: int = BITS, iterations: int = ITERATIONS, rate: float = RATE, ridge: float = RIDGE) -> TextModel:
    """Fit on all rows with a label and words."""
    known = rows.where(F.col(label).isNotNull()).repartition(rows.sparkSession.sparkContext.defaultParallelism)
    parts = F.transform(F.array(places(text, bits)), lambda at: _parts(at, bits))[0]
    # stored before texts without words are left out: a filter on the places would find them a second time, before the shuffle
    stored = stage(known.select(F.col(label).alias("_label"), parts.alias("_parts")), "text-model")
    data = stored.where(F.size("_parts.words") + F.size("_parts.marks") > 0)
    counts = {r[0]: r[1] for r in data.groupBy("_label").count().collect()}
    classes = sorted(counts)
    n = sum(counts.values())
    if len(classes) < 2:
        remove_staged(stored)
        raise ValueError(f"labels of two classes at least are needed, there are {classes}")
    size = 2 ** bits + MARKS
    model = TextModel(classes, [[0.0] * size for _ in classes], [math.log(counts[c] / n) for c in classes], max(classes, key=lambda c: (counts[c], c)), bits)
    moved = [[1e-12] * size for _ in classes]
    moved_bias = [1e-12] * len(classes)
    for _ in range(iterations):
        each = _each_place(data, model)
        x = F.when((F.col("_place") < 0) | (F.col("_place") >= 2 ** bits), F.lit(1.0)).otherwise(F.col("_x"))
        sums = each.groupBy("_place").agg(*[F.sum(F.col(f"_e{k}") * x).alias(f"g{k}") for k in range(len(classes))],
                                          F.sum(F.when(F.col("_place") < 0, F.col("_loss"))).alias("loss")).collect()
        for r in sums:
            for k in range(len(classes)):
                g = r[f"g{k}"] / n
                if r["_place"] < 0:
                    moved_bias[k] += g * g
                    model.biases[k] -= rate * g / math.sqrt(moved_bias[k])
                else:
                    g += ridge * model.weights[k][r["_place"]]
                    moved[k][r["_place"]] += g * g
                    model.weights[k][r["_place"]] -= rate * g / math.sqrt(moved[k][r["_place"]])
            if r["_place"] < 0:
                model.losses.append(r["loss"] / n)
    remove_staged(stored)
    return model

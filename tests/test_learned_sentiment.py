"""Sentiment learnt from review scores: held-out accuracy, against the lexicon, and the fit against plain numpy."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.functions import sentiment
from marketlake.operators import text_model
from marketlake.sources.raw_views import labelled_reviews

REVIEWS = "review_id string, order_id string, review_score int, review_comment_message string"
GOOD = ["produto otimo chegou antes", "adorei muito bom", "perfeito recomendo a loja", "excelente qualidade obrigado"]
BAD = ["PESSIMO!! nunca chegou", "veio quebrado quero devolver", "horrivel atrasado demais!!", "nao gostei defeito na caixa"]


def reviews(spark, n=200):
    rows = [(f"r{i}", f"o{i}", 5 if i % 2 else 1 + i % 4 // 2, (GOOD if i % 2 else BAD)[i // 2 % 4] + f" item{i}") for i in range(n)]
    rows += [("x1", "ox1", 3, None), ("x2", "ox2", 4, "   "), ("x3", "ox3", None, "sem nota"), ("x4", None, 5, "otimo"), ("x5", "ox5", 5, "!?")]
    return spark.createDataFrame(rows, REVIEWS)


def test_learns_what_scores_say(spark):
    rv = reviews(spark)
    scorer = sentiment.learned_scorer(rv)
    out = {r.review_id: (r.s, r.l) for r in scorer(rv, "review_comment_message", "s").withColumn("l", sentiment.score_label()).collect()}
    assert all(s == l for k, (s, l) in out.items() if k.startswith("r"))
    assert out["x1"][0] == out["x2"][0] == sentiment.NO_COMMENT
    assert out["x3"][0] in (sentiment.POSITIVE, sentiment.NEGATIVE)
    assert scorer.model.losses[-1] < scorer.model.losses[0]


def test_negations_are_learnt_where_the_lexicon_fails(spark):
    rows = [(f"r{i}", f"o{i}", 5 if i % 2 else 1, f"gostei compra {i}" if i % 2 else f"nao gostei compra {i}") for i in range(120)]
    rv = spark.createDataFrame(rows, REVIEWS)
    both = sentiment.learned_scorer(rv)(sentiment.lexicon_scorer(rv, "review_comment_message", "lex"), "review_comment_message", "s")
    held = both.where(sentiment.held_out()).withColumn("l", sentiment.score_label()).collect()
    assert held and all(r.s == r.l for r in held) and sum(r.lex == r.l for r in held) < len(held)


def test_held_out_accuracy_beats_the_lexicon(spark):
    rv = labelled_reviews(spark, "/root/testdata/sf0.01")
    both = sentiment.learned_scorer(rv)(sentiment.lexicon_scorer(rv, "review_comment_message", "lex"), "review_comment_message", "s")
    held = both.where(sentiment.held_out() & (F.col("s") != sentiment.NO_COMMENT)).withColumn("l", sentiment.score_label()).collect()
    learned, lexicon = (sum(r[c] == r["l"] for r in held) / len(held) for c in ("s", "lex"))
    assert len(held) > 60 and learned >= 0.9 > lexicon


def test_no_python_on_rows(spark):
    rv = reviews(spark, 20)
    plan = sentiment.learned_scorer(rv, iterations=1, bits=8)(rv, "review_comment_message", "s")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_fit_equals_plain_numpy(spark):
    bits, rate, ridge, size = 6, 0.1, 1e-3, 2 ** 6 + text_model.MARKS
    rv = reviews(spark, 40).where(F.col("review_score").isNotNull() & F.col("review_comment_message").isNotNull())
    rows = rv.select(sentiment.score_label().alias("label"), F.col("review_comment_message").alias("text"), text_model.places("review_comment_message", bits).alias("at")).collect()
    rows = [r for r in rows if r["at"]]
    model = text_model.fit(rv.withColumn("label", sentiment.score_label()), "review_comment_message", "label", bits, 4, rate, ridge)
    classes = sorted({r["label"] for r in rows})
    x = np.zeros((len(rows), size))
    for i, r in enumerate(rows):
        words = [p for p in r["at"] if p < 2 ** bits]
        x[i, words] = 1 / math.sqrt(max(1, len(words)))
        x[i, [p for p in r["at"] if p >= 2 ** bits]] = 1
    y = np.array([[r["label"] == c for c in classes] for r in rows], float)
    w, b = np.zeros((size, len(classes))), np.log(y.mean(0))
    gw, gb, met = np.full(w.shape, 1e-12), np.full(b.shape, 1e-12), (x > 0).any(0)
    for _ in range(4):
        e = np.exp(x @ w + b)
        d = (e / e.sum(1, keepdims=True) - y) / len(rows)
        g = np.where(met[:, None], x.T @ d + ridge * w, 0)
        gw += g * g
        w -= rate * g / np.sqrt(gw)
        gb += d.sum(0) ** 2
        b -= rate * d.sum(0) / np.sqrt(gb)
    assert model.classes == classes
    assert np.allclose(np.array(model.weights).T, w, atol=1e-9) and np.allclose(model.biases, b, atol=1e-9)


def test_nothing_of_a_whole_text_is_reckoned_per_place(spark):
    at = spark.createDataFrame([("a", [1, 2, 70]), ("b", [3])], "_label string, at array<int>")
    model = text_model.TextModel(["a", "b"], [[0.0] * (2 ** 6 + text_model.MARKS)] * 2, [0.0, 0.0], "a", 6)
    rows = text_model._each_place(at.select("_label", text_model._parts(F.col("at"), 6).alias("_parts")), model)
    above, explode, _ = rows._jdf.queryExecution().optimizedPlan().toString().partition("Generate explode")
    assert explode and "lambda" not in above and "size(" not in above
    assert [(r._place, round(r._x, 9), r._e0) for r in rows.where("_label = 'a'").collect()] == [(p, round(1 / math.sqrt(2), 9), -0.5) for p in (-1, 1, 2, 70)]


def test_words_are_found_once_per_text(spark, monkeypatch):
    seen = []
    real = text_model.stage
    monkeypatch.setattr(text_model, "stage", lambda df, name: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    text_model.fit(spark.createDataFrame([("a b", "p"), ("c d", "n"), ("", "n")], "text string, label string"), "text", "label", 6, 1)
    assert len(seen) == 1 and not [line for line in seen[0].splitlines() if "Filter" in line and "lambda" in line]


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError, match="two classes"):
        text_model.fit(spark.createDataFrame([("a", "p"), ("b", "p")], "text string, label string"), "text", "label")

"""Review sentiment (U1) as native Spark expressions.

The hosted model the original platform called is not available; the re-aimed
operator is a lexicon scorer: lower-case, fold accents, split on non-letters,
count positive and negative hits, label by the sign of the difference.
Everything is a built-in expression (no Python UDF), so it runs in the JVM.
A different scorer can be plugged in as any ``DataFrame -> DataFrame``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exprs import col, non_blank

# Output labels.
POSITIVE, NEUTRAL, NEGATIVE, NO_COMMENT = "positivo", "neutro", "negativo", "sem_comentario"

# Accent folding (from -> to, same length).
ACCENTS_FROM = "áàâãäéèêëíìîïóòôõöúùûüç"
ACCENTS_TO = "aaaaaeeeeiiiiooooouuuuc"

# Portuguese lexicon (accent-free, lower case).
POSITIVE_WORDS = [
    "otimo", "otima", "bom", "boa", "excelente", "recomendo", "perfeito", "perfeita",
    "adorei", "gostei", "amei", "rapido", "rapida", "satisfeito", "satisfeita",
    "maravilhoso", "maravilhosa", "lindo", "linda", "top", "qualidade", "parabens",
    "obrigado", "obrigada", "correto", "certinho", "antes",
]
NEGATIVE_WORDS = [
    "pessimo", "pessima", "ruim", "horrivel", "atrasado", "atrasada", "atraso",
    "defeito", "defeituoso", "quebrado", "quebrada", "errado", "errada", "faltando",
    "falta", "nunca", "decepcionado", "decepcionada", "insatisfeito", "insatisfeita",
    "problema", "reclamacao", "devolver", "devolucao", "cancelado", "demorou", "lento",
]

Scorer = Callable[[DataFrame, str, str], DataFrame]


def tokens(text) -> Column:
    folded = F.translate(F.lower(col(text)), ACCENTS_FROM, ACCENTS_TO)
    return F.split(folded, "[^a-z]+")


def lexicon_score(text, positive=POSITIVE_WORDS, negative=NEGATIVE_WORDS) -> Column:
    toks = tokens(text)
    pos = F.size(F.filter(toks, lambda w: w.isin(list(positive))))
    neg = F.size(F.filter(toks, lambda w: w.isin(list(negative))))
    return pos - neg


def sentiment_label(text) -> Column:
    """positivo / neutro / negativo; blank or NULL text -> sem_comentario."""
    score = lexicon_score(text)
    return (F.when(~non_blank(text), F.lit(NO_COMMENT))
             .when(score > 0, F.lit(POSITIVE))
             .when(score < 0, F.lit(NEGATIVE))
             .otherwise(F.lit(NEUTRAL)))


def lexicon_scorer(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    return df.withColumn(out_col, sentiment_label(text_col))


def pandas_lexicon_scorer(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """The same lexicon scorer as an Arrow-batched ``mapInPandas`` step.

    This is the plug-in shape for scorers that need Python (for example a local model): whole
    Arrow batches per call, vectorised string operations, no per-row Python UDF. The native
    ``lexicon_scorer`` stays the default because it runs inside the JVM.
    """
    import pandas as pd

    pos, neg = frozenset(POSITIVE_WORDS), frozenset(NEGATIVE_WORDS)
    table = str.maketrans(ACCENTS_FROM, ACCENTS_TO)
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, `{out_col}` string"

    def label(batches):
        for pdf in batches:
            text = pdf[text_col]
            blank = text.isna() | (text.fillna("").str.strip(" ") == "")
            toks = text.fillna("").str.lower().str.translate(table).str.split(r"[^a-z]+", regex=True)
            score = toks.map(lambda ws: sum(w in pos for w in ws) - sum(w in neg for w in ws))
            out = pd.Series(NEUTRAL, index=pdf.index)
            out[score > 0] = POSITIVE
            out[score < 0] = NEGATIVE
            out[blank] = NO_COMMENT
            yield pdf.assign(**{out_col: out})

    return df.mapInPandas(label, schema)


# ---------- learnt from review scores ----------

def score_label(score="review_score") -> Column:
    """The sentiment that a review's own score stands for: 4 and 5 positive, 3 neutral, 1 and 2 negative."""
    s = col(score)
    return F.when(s >= 4, POSITIVE).when(s == 3, NEUTRAL).when(s <= 2, NEGATIVE)


def held_out(key="order_id", of: int = 5) -> Column:
    """Orders that never train a scorer: a fifth, by a hash of their id."""
    return F.crc32(F.coalesce(col(key).cast("string"), F.lit(""))) % of == 0


def learned_scorer(reviews: DataFrame, text: str = "review_comment_message", score: str = "review_score", key: str = "order_id", **options) -> Scorer:
    """A scorer fitted on the commented reviews of orders that aren't held out; labels come from their scores.

    It labels blank and NULL comments ``sem_comentario``, as the lexicon scorer does, and runs as native expressions."""
    from ..operators.text_model import fit
    train = reviews.where(non_blank(text) & ~held_out(key)).select(F.col(text).alias("_text"), score_label(score).alias("_score"))
    model = fit(train, "_text", "_score", **options)

    def scorer(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        return df.withColumn(out_col, F.when(~non_blank(text_col), F.lit(NO_COMMENT)).otherwise(model.label(text_col)))
    scorer.model = model
    return scorer

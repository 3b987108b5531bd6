"""Corpus preparation from end to end: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; between two stages the
rows are written as Parquet to the shared folder and read again, so a lost executor repeats one stage only.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import decontaminate, jaccard, line_dedup, packing, quality
from marketlake.llm.common import cut, table, text_key

REJECT_BELOW = 0.5


def wrapped(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the other columns as one, ``rest``: none of their names can clash with a helper's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest).alias("rest") if rest else F.lit(None).cast("int").alias("rest"))


def unwrapped(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    given = {c: F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c) for c in docs.columns}
    return rows.select(*[c.alias(name) for name, c in (given | changed).items()])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under ``REJECT_BELOW`` go. Null and empty texts are scored as empty, repeated rows each;
    without labels every score is 0.5 and all documents stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return unwrapped(quality.score(wrapped(docs), model, "_score").where(F.col("_score") >= REJECT_BELOW), docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated across documents stay in the first document only; no document goes."""
    out = line_dedup.drop_lines(wrapped(docs))
    n_chars = {"n_chars": F.length("text").cast("long")} if "n_chars" in docs.columns else {}
    return unwrapped(out, docs, **n_chars)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id, of several texts with that id one.

    Five-word shingles and a similarity of 0.8 or more. Texts without words are no one's copies and stay. Rows that
    repeat an id with texts that are not near copies are in groups of their own. Of rows that repeat id and text
    one stays; rows with a null id stay unless their group has a named document.
    """
    groups = jaccard.near_duplicates(docs.select("doc_id", "text"), n=5, num=8, den=10)
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("tk") == F.col("first_tk"))
    own = groups.where((F.col("n_shingles") == 0) | F.col("component_id").isNull() | first).select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk")).distinct()
    # joined on id and text key, so the rows are already together for the last step
    rows = wrapped(docs)
    keyed = rows.withColumn("_key", text_key())
    stay = keyed.join(own, (F.col("doc_id") == F.col("_id")) & (F.col("_key") == F.col("_tk"))).dropDuplicates(["doc_id", "_key"]).select(*rows.columns)
    unnamed = own.where("_id IS NULL").select("_tk")
    return unwrapped(stay.unionByName(rows.where(F.col("doc_id").isNull()).join(unnamed, text_key() == unnamed["_tk"], "left_semi")), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts hold none; each repeated row is judged; an empty
    benchmark lets all stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the documents in sequences of at most 1024 tokens. Null and empty texts are their end id
    alone; repeated rows are packed each; no documents give no pieces."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# A learnt classifier, edit distances and packing aren't SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Registered queries of the corpus operators, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import byte_pairs, conversation_repair, decontaminate, embedding_dedup, fill_in_middle, jaccard, line_dedup, packing, pii, quality, suffix_dedup, token_counts, token_store
from .common import batches, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def _pii_digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pii.BASE_KINDS
    for b in batches(it):
        counts, digests, spans, scores = {k: [] for k in kinds}, [], [], []
        for found in b.column(1).to_pylist():
            told = [f"{s['kind']}:{s['start']}:{s['end']}" for s in found]
            base = [t for s, t in zip(found, told) if s["kind"] in kinds]
            for k in kinds:
                counts[k].append(sum(s["kind"] == k for s in found))
            digests.append(hashlib.sha256(",".join(base).encode()).hexdigest())
            spans.append(",".join(told))
            scores.append(",".join(f"{s['score']:.2f}" for s in found))
        yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), **{f"n_{k}": pa.array(counts[k], pa.int64()) for k in kinds},
                                          "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string()),
                                          "scores": pa.array(scores, pa.string())})


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.mapInArrow(_pii_digests, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.kept_text(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", (F.octet_length("kept") + n_removed).alias("n_bytes"), n_removed.alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"))
    return token_store.read_documents(manifest)


def _line_digests(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it):
        n_lines, n_dropped, digests = [], [], []
        for text, keep in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            lines = (text or "").split("\n")
            n_lines.append(len(lines))
            if keep is None:
                n_dropped.append(0)
                kept = text or ""
            else:
                stay = line_dedup.kept_lines(keep, len(lines))
                n_dropped.append(len(lines) - int(stay.sum()))
                kept = "\n".join(line for line, k in zip(lines, stay) if k)
            digests.append(hashlib.sha256(kept.encode()).hexdigest())
        yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "n_lines": pa.array(n_lines, pa.int64()),
                                          "n_dropped": pa.array(n_dropped, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    joined = line_dedup.with_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return joined.select("doc_id", "text", "_keep").mapInArrow(_line_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.is_held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=3, num=90, den=100).select("doc_id", "n_shingles", "component_id")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = byte_pairs.encode(table(spark, sf_dir, "documents"), decoded=True)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return shaped.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                         F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired_digests(conversation_repair.damage(table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_counts": op3_token_counts,
    "op4_pii": op4_pii,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_files": op6_token_files,
    "op7_line_dedup": op7_line_dedup,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_quality": op9_quality,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_repair": op13_conversation_repair,
}

# Dropping repeated lines, in DuckDB.
OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
first_doc AS (SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.*, f.first_id IS NOT NULL AND f.first_id <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN first_doc f ON f.key = k.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# Links by cosine and their components, in DuckDB; all pairs, so for small tables.
OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
  WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
reach(node, origin) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT l.y, r.origin FROM reach r JOIN links l ON l.x = r.node),
least AS (SELECT node, min(origin) AS component_id FROM reach GROUP BY node),
degree AS (SELECT x, count(*) AS k FROM links GROUP BY x)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id LEFT JOIN degree ON x = vec_id
"""

# Exact Jaccard of 3-word shingle sets and the components of the links, in DuckDB; for small tables.
OP10_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+') IF w <> ''] AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM cut),
members AS (SELECT doc_id, unnest(s) AS shingle, len(s) AS n FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(node, origin) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.y, r.origin FROM reach r JOIN links l ON l.x = r.node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, min(origin) AS component_id FROM sets JOIN reach ON node = doc_id GROUP BY doc_id, s
"""

# Units as a list, cut by the digest of the id, in DuckDB. What is rebuilt is the text itself.
OP12_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS p, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS s FROM units),
parts AS (
  SELECT doc_id, n, text,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR p >= 90 THEN 'plain'
              WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
         array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

ORACLE_SQL: dict[str, str] = {"op7_line_dedup": OP7_SQL, "op8_embedding_dedup": OP8_SQL, "op10_ngram_jaccard": OP10_SQL,
                              "op12_fill_in_middle": OP12_SQL}

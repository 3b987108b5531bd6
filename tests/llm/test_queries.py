"""The registered corpus queries on whole tables against brute force, and the pipeline's stages."""

import hashlib
import os
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402
from marketlake.llm import packing, tokens  # noqa: E402
from marketlake.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in rows("documents")}


def result(spark, name):
    return [tuple(r) for r in QUERIES[name](spark, SF).collect()]


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_decontamination(spark, texts):
    items = {r["item_id"]: r["text"] for r in rows("benchmark")}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert {r[:2] for r in result(spark, "op1_decontamination")} == exact


def test_token_files_and_packing_agree(spark, texts):
    enc = tokens.encoder(tokens.default_vocabulary()).tokenizer
    at, expected = 0, []
    for d in sorted(texts):
        ids = enc.encode(texts[d], add_special_tokens=False).ids + [0]
        expected.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(result(spark, "op6_token_files")) == expected
    pieces = result(spark, "op2_best_fit_packing")
    per_doc = Counter()
    for p in pieces:
        per_doc[p[0]] += p[3]
    assert per_doc == {d: n for d, _, n, _ in expected}
    assert len({p[5] for p in pieces}) <= at // 1024 + 3


def test_suffix_dedup(spark, texts):
    count = Counter()
    raw = {d: t.encode() for d, t in texts.items()}
    for b in raw.values():
        count.update(b[i:i + 200] for i in range(len(b) - 199))
    expected = []
    for d, b in raw.items():
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = 1
        kept = bytes(x for x, g in zip(b, gone) if not g)
        expected.append((d, len(b), len(b) - len(kept), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert sorted(result(spark, "op5_suffix_dedup")) == sorted(expected)


def test_quality_on_held_out_labels(spark):
    scored = {r[0]: r for r in result(spark, "op9_quality")}
    held = [r for r in rows("labels") if scored[r["doc_id"]][1]]
    assert sum(scored[r["doc_id"]][3] == r["quality"] for r in held) >= 0.85 * len(held)


def test_stages(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, SF).persist()
        assert docs.columns == columns, name
        kept[name] = (before, {r["doc_id"]: r["text"] for r in docs.collect()})
    before, after = kept["quality"]
    labels = {r["doc_id"]: r["quality"] for r in rows("labels")}
    assert all(before[d] == t for d, t in after.items())
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in after for d in good) >= 0.97 * len(good)
    before, after = kept["line_dedup"]
    assert before.keys() == after.keys()
    seen = defaultdict(set)
    for d, t in after.items():
        for line in t.split("\n"):
            key = line.strip(" \t\v\f\r")
            if len(key) >= 10:
                seen[key.encode().lower()].add(d)
    assert all(len(ids) == 1 for ids in seen.values())
    before, after = kept["ngram_jaccard"]
    assert after.items() <= before.items()
    sets = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for d, w in ((d, t.encode().lower().split()) for d, t in before.items())}
    link = lambda a, b: bool(a and b) and 10 * len(a & b) >= 8 * len(a | b)
    stay = sorted(after)
    assert not any(link(sets[a], sets[b]) for k, a in enumerate(stay) for b in stay[:k])
    assert all(any(link(sets[d], sets[e]) for e in before if e != d) for d in before.keys() - after.keys())
    before, after = kept["decontamination"]
    items = [r["text"] for r in rows("benchmark")]
    assert not any(x in t for x in items for t in after.values())
    assert after.items() <= before.items()
    pieces = [r.asDict() for r in packing.pack_documents(docs).collect()]
    assert {p["doc_id"] for p in pieces} == after.keys()


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0

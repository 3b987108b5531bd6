"""Corpus operators on small messy tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import (decontaminate, embedding_dedup, jaccard, line_dedup, packing, pii, quality, queries, suffix_dedup,
                            token_counts, token_store, tokens)
from marketlake.llm.common import components
from marketlake.session import scratch_path

RNG = np.random.default_rng(3)
WORDS = ["".join(RNG.choice(list("abcdeèfghilmnorst"), RNG.integers(2, 9))) for _ in range(400)]


def prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] + ("." if r.random() < 0.1 else "") for i in r.integers(0, len(WORDS), n))


PASSAGE = prose(70, 1)
BASE = prose(300, 2)
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace(BASE.split()[5], "changed", 1)), (4, None), (5, ""), (6, "two words"), (7, "Two  WORDS"),
    (8, prose(40, 8) + "\n" + PASSAGE + "\n" + prose(30, 9)), (9, prose(50, 10) + "\n" + PASSAGE.upper() + "\n " + prose(20, 11)),
    (10, "x" * 5000), (11, prose(4000, 12)), (11, "same id, another text entirely, long enough"), (12, prose(5, 13)), (12, prose(5, 13)),
    (None, prose(25, 14)), (None, BASE), (13, "word " * 600), (14, prose(100, 15) + PASSAGE + prose(100, 16)), (15, "a  b\t\tc   \n\n d\n"), (16, "\n"),
]
EXTRA = ("n", "fp", "tk", "length", "score", "pos", "component_id", "spans")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *["clash"] * len(EXTRA)) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, extra int")


def ids_of(text):
    enc = tokens.encoder(tokens.default_vocabulary())
    return enc.tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def sort_key(row):
    return tuple((x is not None, x) for x in row)


# --- shared helpers

def test_components_chain_star_loop_and_nulls(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (4, None), (1, 2)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}}


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- tokens

@pytest.mark.parametrize("text", ["", " ", "a  b", "a   b", "x\n y", " \n b", "a \n", "a  ", "\n\n  x\t y", "don't  we'll 's", "é² ½ x²y. <|endoftext|> z.",
                                  "a 'shall", " leading", "a  b", "3.5, 4., x.. y.,", "　 a", "ends. "])
def test_encoder_equals_library(text):
    enc = tokens.TextEncoder(tokens.default_vocabulary())
    for _ in range(2):  # without and with cached words
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode([text, BASE])] == [ids_of(text), ids_of(BASE)]


@pytest.mark.parametrize("text", ["a<|endoftext|> b", "<|endoftext|>", "x <|endoftext|>  y<|endoftext|><|endoftext|>. z", "\n<|endoftext|> \n a  b", "<|endoftext |> c"])
def test_added_tokens_as_the_library_from_the_file(text):
    from tokenizers import Tokenizer
    fresh = Tokenizer.from_file(tokens.default_vocabulary())
    enc = tokens.TextEncoder(tokens.default_vocabulary())
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode([BASE, text])] == [fresh.encode(t, add_special_tokens=False).ids for t in (BASE, text)]
    assert (50256 in np.frombuffer(enc.encode([text])[0], "<u4")) == ("<|endoftext|>" in text)


def test_encoder_with_full_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 10)
    enc = tokens.TextEncoder(tokens.default_vocabulary())
    for _ in range(3):
        assert np.frombuffer(enc.encode([PASSAGE])[0], "<u4").tolist() == ids_of(PASSAGE)


# --- op2

def check_packing(rows, texts, capacity):
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    expected = Counter()
    for i, t in texts:
        ids = ids_of(t) + [2]
        cuts = [0, *range(len(ids) % capacity or min(capacity, len(ids)), len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        expected.update((i, p, lo, hi - lo, crc(ids[lo:hi])) for p, (lo, hi) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    return sequences


@pytest.mark.parametrize("capacity", [1024, 64])
def test_packing(docs, capacity):
    rows = packing.pack_documents(docs, capacity=capacity).collect()
    sequences = check_packing(rows, TEXTS, capacity)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // capacity) + 2


def test_packing_of_nothing(no_docs):
    out = packing.pack_documents(no_docs)
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "piece"]


def test_best_fit_is_near_the_bound():
    r = np.random.default_rng(0)
    for lengths in (r.integers(1, 1025, 5000), np.minimum(1024, r.geometric(0.01, 5000)), np.full(3000, 400), np.r_[np.full(2000, 300), r.integers(500, 700, 900)]):
        counts = Counter(lengths.tolist())
        places, used = packing.best_fit(dict(counts))
        assert sum(p[2] for p in places) == len(lengths)
        fill = Counter()
        for length, _, n, first, _ in places:
            for s in range(first, first + n):
                fill[s] += length
        assert max(fill.values()) <= 1024 and len(fill) == used
        first_fit = []  # decreasing, as the yardstick
        for x in sorted(lengths.tolist(), reverse=True):
            fits = [(g, k) for k, g in enumerate(first_fit) if g >= x]
            if fits:
                g, k = min(fits)
                first_fit[k] = g - x
            else:
                first_fit.append(1024 - x)
        assert used <= len(first_fit) * 1.01 + 1


# --- op3

def greedy(word, begin, go_on):
    n, at, pieces = 0, 0, begin
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return token_counts.UNKNOWN
        at, n, pieces = end, n + 1, go_on
    return n


def test_counter_equals_greedy_longest_match():
    r = np.random.default_rng(1)
    for _ in range(30):
        make = lambda k: {"".join(r.choice(list("abc"), r.integers(1, 6))) for _ in range(k)}
        begin, go_on = make(12), make(12)
        c = token_counts.Counter(begin, go_on)
        for _ in range(300):
            w = "".join(r.choice(list("abcd"), r.integers(1, 12), p=[.32, .32, .32, .04]))
            assert c.word(w) == greedy(w, begin, go_on), (w, begin, go_on)


def test_token_counts(docs, no_docs):
    begin, go_on = map(set, token_counts.load_vocabulary(token_counts.default_vocabulary()))
    got = Counter(map(tuple, token_counts.count_tokens(docs).collect()))
    expected = Counter()
    for i, t in TEXTS:
        n = [greedy(w, begin, go_on) for w in (t or "").split()]
        expected[(i, len(n), sum(max(1, x) for x in n), sum(x < 0 for x in n))] += 1
    assert got == expected
    assert token_counts.count_tokens(no_docs).count() == 0


def unsplit_greedy(word, pieces):
    """Greedy cut of the marked word over the whole piece list."""
    word, n, at = token_counts.WORD_BEGIN + word, 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return token_counts.UNKNOWN
        at, n = end, n + 1
    return n


def test_words_that_begin_with_the_bare_mark():
    import sentencepiece
    path = token_counts.default_vocabulary()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    c = token_counts.Counter(*token_counts.load_vocabulary(path))
    words = ["2024", "3.14", "2024-01-01", "ñandú", "ño", "日本語", "中文的一个段落没有空格", "hello", "(x)", "é2", "\U0001f600", *WORDS]
    assert [c.word(w) for w in words] == [unsplit_greedy(w, pieces) for w in words]
    assert [c.word(w) for w in words[:3]] == [5, 5, 11]
    assert c.text("2024 hello") == (2, 5 + c.word("hello"), 0)
    r = np.random.default_rng(2)
    for _ in range(30):
        make = lambda k: {"".join(r.choice(list("abc"), r.integers(1, 6))) for _ in range(k)}
        begin, go_on = make(12) | {""}, make(12)
        c = token_counts.Counter(begin, go_on)
        whole = {token_counts.WORD_BEGIN + p for p in begin} | go_on
        for _ in range(300):
            w = "".join(r.choice(list("abcd"), r.integers(1, 12), p=[.32, .32, .32, .04]))
            assert c.word(w) == unsplit_greedy(w, whole), (w, begin, go_on)


# --- op4

def plain_spans(text):
    """The base kinds straight from their expressions."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.findall("[0-9]", m.group())) <= 15]
    return out


PII_TEXTS = ["mail a.b+c@x-y.example.com, @no.com a@b a@b.c@d.e", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 255.255.255.255. 0001.2.3.004", "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111",
             "+1 (653) 555-8361 +44 20 7946 0958 +1 2 +(1)", "a@b.co" * 50, "1" * 300, "é@x.y ü1.1.1.1", "x@y..z.w a..b@c.d", "@@a@b.c", "+1 555 0100 2000 3000 4000 5000", "٣.1.2.3.4", ""]


@pytest.mark.parametrize("text", PII_TEXTS)
def test_base_spans_equal_their_expressions(text):
    assert [tuple(s)[:3] for s in pii.find(text) if s.kind in pii.BASE_KINDS] == plain_spans(text)


def test_base_spans_of_random_strings():
    r = np.random.default_rng(5)
    for _ in range(3000):
        text = "".join(r.choice(list("a1.1@-+ 0(4"), r.integers(0, 40)))
        assert [tuple(s)[:3] for s in pii.find(text) if s.kind in pii.BASE_KINDS] == plain_spans(text), text


def test_checksums_and_context():
    assert [s.kind for s in pii.find("bank account GB82 WEST 1234 5698 7654 32.")] == ["iban"]
    assert not pii.find("bank account GB83 WEST 1234 5698 7654 32.")
    assert [s.kind for s in pii.find("her social security number 078-05-1120")] == ["ssn"]
    assert not pii.find("part 078-05-1120")
    near, far = pii.find("credit card 4111111111111111")[0], pii.find("invoice 4111111111111111")[0]
    assert near.score > far.score and near.kind == far.kind == "card"


def test_long_texts_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" + "(" * 200_000, "a@" * 100_000):
        pii.find(text)


def test_pii_table(docs, no_docs):
    assert pii.find_pii(docs).count() == len(TEXTS) and pii.find_pii(no_docs).count() == 0
    assert {r["doc_id"] for r in pii.find_pii(docs).where("spans IS NULL").collect()} == set()


# --- op5

def covered(texts, width):
    count = Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if count[t[i:i + width]] > 1:
                gone[i:i + width] = True
        out.append(gone)
    return out


def check_suffix(spark, texts, width=200, **kw):
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = Counter((r["doc_id"], bytes(r["kept"]), len(r["removed"])) for r in suffix_dedup.kept_text(frame, width, **kw).collect())
    raw = [(t or "").encode() for _, t in texts]
    expected = Counter()
    for (i, _), t, gone in zip(texts, raw, covered(raw, width)):
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        expected[(i, np.frombuffer(t, np.uint8)[~gone].tobytes(), int((edges == 1).sum()))] += 1
    assert got == expected


def test_repeated_bytes(spark):
    check_suffix(spark, TEXTS)


def test_repeated_bytes_of_tricky_texts(spark, monkeypatch):
    r = np.random.default_rng(9)
    unit = "".join(r.choice(list("abcdefgh"), 50))
    block = "".join(r.choice(list("abcdefghijkl"), 199))
    texts = [(1, unit * 5 + "tail"), (2, "q" + unit + "zz" + unit), (3, "ab" * 150), (4, block + "1"), (5, "2" + block), (6, "3" + block + "1"), (7, block)]
    passage = "".join(r.choice(list("mnopqrstu"), 260))
    texts += [(10 + k, "".join(r.choice(list("abcdefgh"), 150)) + passage + "".join(r.choice(list("abcdefgh"), 150))) for k in range(30)]
    check_suffix(spark, texts)
    monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", 4)  # the frequent-name way on the same texts
    check_suffix(spark, texts)


def periodic_texts(n, least, unit):
    return [(k, f"{prose(20, 700 + k)} {(unit * (least + 37 * k))[:least + 37 * k]} {prose(20, 900 + k)}") for k in range(n)]


def contents_of(bodies):
    """(m, body) pairs as rows of the comparison."""
    n = len(bodies)
    return pa.RecordBatch.from_pydict({"m": pa.array([m for m, _ in bodies], pa.int64()), "doc_id": pa.array(range(n), pa.int64()), "tk": pa.array([1] * n, pa.int32()),
                                       "lo": pa.array([7] * n, pa.int32()), "weight": pa.array([1] * n, pa.int32()), "body": pa.array([b for _, b in bodies], pa.binary())})


def test_long_periodic_runs(spark, monkeypatch):
    texts = [t for unit in ("-", "= ", "AAAB") for t in periodic_texts(6, 2000, unit)]
    check_suffix(spark, texts)
    monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", 3000)
    check_suffix(spark, texts)


def test_few_or_many_is_decided_by_windows(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", 3000)
    frame = spark.createDataFrame([(1, bytes(2000))] * 2 + [(2, bytes(201))] * 50 + [(3, bytes(250))] * 100, "m long, body binary")
    assert {r["m"] for r in suffix_dedup._large(frame, 200).collect()} == {1, 3}


def test_a_task_holds_a_bounded_number_of_windows(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SMALL_GROUP", 3000)
    held, windows = [], suffix_dedup._windows
    monkeypatch.setattr(suffix_dedup, "_windows", lambda rows, width: held.append(windows(rows, width)) or held[-1])
    r = np.random.default_rng(11)
    bodies = [(m, r.bytes(300 + m)) for m in range(40)]
    bodies = [b for m, x in bodies for b in ((m, x), (m, b"q" + x))]
    out = list(suffix_dedup._compare(200)(iter([contents_of(bodies)])))
    assert max(len(h[0]) for h in held) <= 3000
    spans = sorted((d, s, e) for b in out for d, s, e in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()))
    assert spans == sorted((2 * m + k, 7 + k, 7 + k + 300 + m) for m in range(40) for k in (0, 1))


def test_periodic_bodies_make_few_window_rows(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 30_000)
    held, windows = [], suffix_dedup._windows
    monkeypatch.setattr(suffix_dedup, "_windows", lambda rows, width: held.append(windows(rows, width)) or held[-1])
    bodies = [(1, b"=" * (20_000 + k)) for k in range(10)] + [(1, b"AB" * 10_000)]
    out = pa.Table.from_batches(list(suffix_dedup._window_rows(200)(iter([contents_of(bodies)]))))
    assert out.num_rows == 12 and max(len(h[0]) for h in held) <= 30_000
    assert sorted(zip(*(out.column(c).to_pylist() for c in ("doc_id", "start", "end", "k")))) == [
        *((k, 7, 20_007 + k, 19_801 + k) for k in range(10)), (10, 7, 20_007, 9901), (10, 8, 20_006, 9900)]


def test_runs_over_chunks_find_the_same(monkeypatch):
    r = np.random.default_rng(2)
    text = "".join(r.choice(list("abcd"), 3000)).encode()
    raw = np.frombuffer(text[:1500] + text[200:900] + text[1500:], np.uint8)
    names = {int(m) for run in suffix_dedup.runs(raw, 200) for m in run[0]}
    monkeypatch.setattr(suffix_dedup, "CHUNK", 257)
    assert {int(m) for run in suffix_dedup.runs(raw, 200) for m in run[0]} == names


def test_no_texts_to_repeat(no_docs):
    assert suffix_dedup.kept_text(no_docs).count() == 0


# --- op6

def test_token_files(spark, docs):
    base = scratch_path(spark, "tokens")
    manifest = token_store.write_tokens(docs, base)
    rows = token_store.read_documents(manifest).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == Counter((i, len(ids_of(t)) + 1, crc(ids_of(t) + [0])) for i, t in TEXTS)
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    for m in manifest.collect():
        shard = token_store.Shard(m["path"])
        every = np.concatenate([shard.document(k) for k in range(shard.n_docs)])
        for i in RNG.integers(0, shard.n_tokens, 50):
            assert shard.token(int(i)) == every[i]


def test_segment_round_trip_and_random_access():
    for ids in (np.array([0]), RNG.integers(0, 50_257, 3000), RNG.integers(0, 200, 700), RNG.integers(0, 1 << 31, 1500), np.full(600, 255), np.full(513, 256)):
        seg = token_store.Segment(token_store.encode_segment(ids.astype(np.uint32)))
        assert seg.all().tolist() == ids.tolist()
        assert [seg.token(i) for i in range(len(ids))] == ids.tolist()


def test_no_tokens(spark, no_docs):
    assert token_store.read_documents(token_store.write_tokens(no_docs, scratch_path(spark, "tokens"))).count() == 0


def test_documents_over_segments(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SEGMENT", 100)
    path = scratch_path(spark, "tokens") + "/one.dac"
    w = token_store.ShardWriter(path)
    parts = [RNG.integers(0, 50_000, n).astype("<u4") for n in (0, 5, 250, 95, 100, 1)]
    for i, ids in enumerate(parts):
        w.add(i, ids)
    w.close()
    shard = token_store.Shard(path)
    assert [shard.document(k).tolist() for k in range(len(parts))] == [p.tolist() for p in parts]


# --- op7

def plain_lines(texts):
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(line_dedup.SPACE))
    first = {}
    for i, t in texts:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                first[key(line)] = min(first.get(key(line), i), i)
    out = Counter()
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 10 or first[key(x)] == i]
        out[(i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    return out


LINES = TEXTS + [(20 + k, f"Common HEADER line\nown line {k} of it\n  common header LINE\t\nshort\nÉcole publique ici\nécole publique ici") for k in range(60)]


def test_lines(spark):
    frame = spark.createDataFrame(LINES, "doc_id long, text string").repartition(7)
    joined = line_dedup.with_bitmaps(frame, line_dedup.keep_bitmaps(frame))
    got = joined.select("doc_id", "text", "_keep").mapInArrow(queries._line_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
    assert Counter(map(tuple, got.collect())) == plain_lines(LINES)


def test_dropping_lines_keeps_rows_and_columns(docs, no_docs):
    out = line_dedup.drop_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {r["doc_id"] for r in out.where("text IS NULL").collect()} == {4}
    assert line_dedup.drop_lines(no_docs).count() == 0


# --- op8

def check_vectors(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, raw string, fp int, tile int").repartition(3)
    got = sorted(map(tuple, embedding_dedup.near_duplicates(frame, **kw).collect()), key=sort_key)
    good = [k for k, (_, v, *_) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = defaultdict(set)
    for a in good:
        for b in good:
            va, vb = (np.array(rows[x][1]) / np.abs(rows[x][1]).max() for x in (a, b))
            if a != b and len(va) == len(vb) and va @ vb / (np.linalg.norm(va) * np.linalg.norm(vb)) >= 0.95:
                links[a].add(b)
    expected = []
    for k, (i, *_) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[x][0] for x in seen if rows[x][0] is not None), default=None)
        expected.append((i, len(links[k]), least, i == least))
    assert got == sorted(expected, key=sort_key)


def vectors(n, dim=16, seed=4):
    r = np.random.default_rng(seed)
    out = [r.standard_normal(dim) for _ in range(n)]
    near = [out[k % 10] + 0.02 * r.standard_normal(dim) for k in range(n)]
    return [[float(x) for x in v] for v in out + near + out[:15] + [out[0]] * 20]


def test_embeddings(spark):
    rows = [(i, v, "x", 1, 2) for i, v in enumerate(vectors(60))]
    bad = [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0] * 15 + [None]), (904, [float("nan")] * 16), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, rows[0][1]),
           (None, [5.0] * 16), (3, rows[3][1]), (908, [1e300] * 16), (909, [1e-300] * 16)]
    check_vectors(spark, rows + [(i, v, "x", 1, 2) for i, v in bad])


def test_embeddings_over_many_tiles(spark):
    check_vectors(spark, [(i, v, "x", 1, 2) for i, v in enumerate(vectors(150, 24, 6))], tile=16)


def test_no_embeddings(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_of_pairs_at_the_threshold():
    r = np.random.default_rng(8)
    a = embedding_dedup.unit(r.standard_normal((400, 64)))
    side = r.standard_normal((400, 64))
    side = embedding_dedup.unit(side - (side * a).sum(1, keepdims=True) * a)
    c = 0.9505
    b = c * a + np.sqrt(1 - c * c) * side
    ones = np.ones(400, np.int64)
    in_order = lambda v: v[np.argsort(v @ embedding_dedup.directions(64, 1)[:, 0])]
    counts, _ = embedding_dedup.tile_links(in_order(a), in_order(b), ones, ones, 0.95)
    assert (counts[:400] > 0).mean() >= 0.99


# --- op9

JUNK = ["&&& %%% " + " ".join(w + "!!" for w in prose(30, 100 + k).split()).upper() for k in range(60)]
GOOD = [prose(60, 300 + k) for k in range(140)]


def test_quality_learns_and_keeps_held_out_labels_out(spark):
    rows = [(i, t) for i, t in enumerate(JUNK + GOOD)] + [(1000, None), (1001, ""), (None, GOOD[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    label = lambda i: int(i >= len(JUNK))
    labels = spark.createDataFrame([(i, label(i), 0) for i in range(200)] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(frame, labels)
    out = {r["doc_id"]: r for r in quality.score(frame, model).withColumn("held", quality.is_held_out()).collect()}
    assert len(out) == 203 and all(0 <= r["score"] <= 1 for r in out.values())
    assert all(r["held"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [i for i, r in out.items() if r["held"] and i < 200]
    assert sum((out[i]["score"] >= 0.5) == bool(label(i)) for i in held) >= 0.95 * len(held)
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.train(frame, flipped).weights, model.weights)


def test_quality_without_labels_or_documents(spark, docs, no_docs):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs, empty)
    assert {r["score"] for r in quality.score(docs, model).select("score").collect()} == {0.5}
    assert quality.score(no_docs, quality.train(no_docs, empty)).count() == 0


def test_long_text_is_scored_whole():
    model = quality.fit_rows(JUNK[:20] + GOOD[:20], [0] * 20 + [1] * 20)
    assert model.score(" ".join(GOOD[20:60])) > 0.5 > model.score(" ".join(GOOD[20:22] + JUNK[20:60]))


# --- op10

def plain_sets(text, n):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", w)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def plain_components(texts, n, num, den):
    sets = [plain_sets(t, n) for _, t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * common >= num * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min((texts[k][0] for k in range(len(texts)) if group[k] == g and texts[k][0] is not None), default=None) for g in set(group)}
    return sorted(((i, len(s), least[g]) for (i, _), s, g in zip(texts, sets, group)), key=sort_key)


def near_texts():
    out, r = list(TEXTS), np.random.default_rng(12)
    for k in range(60):  # a group of near copies of two bases, some beyond the threshold
        words = (BASE if k % 2 else prose(120, 77)).split()
        for _ in range(int(r.integers(0, 9))):
            words[int(r.integers(0, len(words)))] = f"w{k}"
        out.append((100 + k, " ".join(words)))
    return out


@pytest.mark.parametrize("n,num,den,tile", [(3, 90, 100, 1024), (5, 8, 10, 1024), (3, 90, 100, 8), (5, 8, 10, 5)])
def test_jaccard(spark, monkeypatch, n, num, den, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    texts = near_texts()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, fp string, key int").repartition(3)
    got = sorted(map(tuple, jaccard.near_duplicates(frame, n, num, den).select("doc_id", "n_shingles", "component_id").collect()), key=sort_key)
    assert got == plain_components(texts, n, num, den)


def test_bitmaps_bound_from_above():
    r = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(r.integers(0, 1 << 63, r.integers(1, 80), dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([b, a[:r.integers(0, len(a) + 1)]]))
        x, y = jaccard.bitmaps([a, b])
        assert len(np.intersect1d(a, b)) <= min(len(a) - int(np.bitwise_count(x & ~y).sum()), len(b) - int(np.bitwise_count(y & ~x).sum()))


def test_no_documents_to_join(no_docs):
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_one_text_of_each_group_stays(spark):
    a, b = prose(60, 21), prose(60, 22)
    near = b + " more"
    rows = [(5, a), (5, b), (9, near), (6, a), (7, prose(60, 23)), (7, prose(60, 23)), (7, prose(60, 24)), (8, ""), (8, "  "), (None, near), (None, prose(60, 25))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = Counter(map(tuple, corpus_pipeline.jaccard_stage(spark, frame, "").collect()))
    assert out == Counter([(5, a), (5, b), (7, prose(60, 23)), (7, prose(60, 24)), (8, ""), (8, "  "), (None, prose(60, 25))])
    more = spark.createDataFrame([(5, a), (5, a + " end"), (5, b), (9, near)], "doc_id long, text string")
    texts = [r["text"] for r in corpus_pipeline.jaccard_stage(spark, more, "").collect()]
    assert len(texts) == 2 and b in texts and near not in texts


# --- op1

def edit_distance(a, b):
    """Least distance of a to a substring of b."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [row[0] + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    r = np.random.default_rng(0)
    for _ in range(400):
        a = "".join(r.choice(list("abc"), r.integers(1, 14)))
        b = "".join(r.choice(list("abc"), r.integers(0, 30)))
        found = decontaminate.best_match(a, b, 5)
        d = edit_distance(a, b)
        assert (found[0] if found else None) == (d if d <= 5 else None)


def test_every_item_within_budget_is_found():
    r = np.random.default_rng(4)
    items = [(k, prose(40, 500 + k)) for k in range(12)]
    finder = decontaminate.Finder(items)
    for trial in range(60):
        k = int(r.integers(0, 12))
        chars = list(decontaminate.normalise(items[k][1]))
        for _ in range(int(r.integers(0, 14))):
            at = int(r.integers(0, len(chars)))
            chars[at] = r.choice(["", "z", chars[at] + "q"])
        text = prose(20, trial) + " " + "".join(chars) + " " + prose(20, trial + 1)
        item = decontaminate.normalise(items[k][1])
        d = edit_distance(item, decontaminate.normalise(text))
        found = {f["item_id"]: f for f in finder.find(text)}
        assert (k in found) == (d <= int(len(item) * decontaminate.EDIT_RATE))
        if k in found:
            assert found[k]["distance"] == d
            part = decontaminate.normalise(text)[found[k]["start"]:found[k]["end"]]
            assert edit_distance(part, item) <= d


def test_short_items_are_not_found_inside_words():
    finder = decontaminate.Finder([(1, "yes"), (2, "A"), (3, "True"), (4, "东京"), (5, "c++")])
    ids = lambda text: [f["item_id"] for f in finder.find(text)]
    assert ids("yesterday eyes untrue banana truest") == [] and ids("") == []
    assert ids("yesterday, YES.") == [1] and ids("yes") == [1] and ids("(a) true") == [2, 3]
    assert ids("他住在东京市") == [4] and ids("in c++.") == [5] and ids("eyes yes")[0] == 1
    found = finder.find("yesterday yes")[0]
    assert (found["start"], found["end"], found["distance"]) == (10, 13, 0)


def test_contaminated_rows(spark, docs, no_docs, monkeypatch):
    items = spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (None, PASSAGE), (4, "two words")], "item_id long, text string")
    expected = Counter({(8, 1): 1, (8, None): 1, (9, 1): 1, (9, None): 1, (14, 1): 1, (14, None): 1, (6, 4): 1, (7, 4): 1})
    assert Counter((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()) == expected
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)  # several blocks
    assert Counter((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()) == expected
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns and left.count() == docs.count() - 5
    none = items.where("item_id = 99")
    assert decontaminate.contaminated(docs, none).count() == 0 and decontaminate.clean(docs, none).count() == docs.count()
    assert decontaminate.contaminated(no_docs, items).count() == 0

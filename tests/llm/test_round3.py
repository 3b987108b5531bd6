"""Byte-level BPE, fill-in-middle and conversation repair on small messy tables, against plain versions."""

import hashlib
import re
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import byte_pairs, conversation_repair, fill_in_middle
from marketlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = byte_pairs.load_ranks(byte_pairs.default_vocabulary())
LIBRARY = tiktoken.Encoding("own", pat_str=byte_pairs.default_pattern(), mergeable_ranks=RANKS, special_tokens={})

TEXTS = [
    (1, "Plain words, plain words."), (2, None), (3, ""), (4, " "), (5, "\n"), (6, "a  b   c \n\n d\t\te \n"), (7, "don't we'll 's it's I'd"),
    (8, "x" * 5000), (9, "ab" * 40_000), (10, "日本語のテキスト、空白なし。" * 300), (11, "naïve café señor ﬁ ½ x²y"), (11, "same id, other text"),
    (12, "repeat"), (12, "repeat"), (None, "no id"), (None, None), (13, " leading and trailing "), (14, "3.5, 4., x.. y.,, z"), (15, "<P>a<S>b<M>"),
    (16, "emoji 😀👩‍👩‍👧 end"), (17, "tab\tthen nbsp em 　 x  y"), (18, "\x1c a\x1f b\x85 c"), (19, " ".join(f"w{i}" for i in range(3000))),
]
EXTRA = ("ids", "units", "fresh", "words", "merged", "n", "form", "output", "refs", "level", "word", "decoded")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, *["clash"] * len(EXTRA)) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)).repartition(3)


def key(row):
    return tuple((x is not None, x) for x in row)


# --- byte-level BPE

def encoded(df, **kw):
    return sorted(((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in byte_pairs.encode(df, decoded=True, **kw).collect()), key=key)


def library(rows):
    return sorted(((i, tuple(LIBRARY.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows), key=key)


def test_encode_equals_the_library(docs):
    assert encoded(docs) == library(TEXTS)


@pytest.mark.parametrize("setting", [("SLICE_BYTES", 50), ("SEEN_WORDS", 3), ("FOLD_BYTES", 6)])
def test_settings_of_size_change_nothing(docs, monkeypatch, setting):
    # in one partition, so that words of earlier rows are known and forgotten again; workers are forked with the setting
    monkeypatch.setattr(byte_pairs, *setting)
    batch = next(iter(docs.select("doc_id", "text").coalesce(1).toArrow().to_batches()))
    hot = [w for w in byte_pairs.Cut(byte_pairs.default_pattern(), batch.column(1)).words.to_pylist() if len(w.encode()) <= byte_pairs.FOLD_BYTES][::3]
    assert local(batch, hot) == library(TEXTS)


class Held:
    def __init__(self, value):
        self.value = value


def local(batch, hot):
    """The tasks' functions one after the other in this process, with merges by the heap in place of the fold."""
    import pyarrow as pa
    pattern = byte_pairs.default_pattern()
    ids = [byte_pairs.merge_long(w.encode(), RANKS) for w in hot]
    table = pa.table({"word": pa.array(hot, pa.string()), "ids": pa.array(ids, pa.list_(pa.int32()))})
    words, of_words = (Held(byte_pairs._as_stream(table.select([c]))) for c in ("word", "ids"))
    out = []
    for b in byte_pairs._new_words(pattern, words)(iter([batch])):
        merged = [[byte_pairs.merge_long(w.encode(), RANKS) for w in ws] for ws in b.column("words").to_pylist()]
        columns = {c: b.column(c) for c in b.schema.names} | {"merged": pa.array(merged, pa.list_(pa.list_(pa.int32())))}
        out.append(pa.RecordBatch.from_pydict(columns))
    whole = pa.Table.from_batches(out).combine_chunks().to_batches()  # slices that end inside a batch, and batches inside a slice
    got = []
    for batches in (out, whole, [b.slice(k, 1) for b in out for k in range(b.num_rows)]):
        rows = [r for b in byte_pairs._put_together(of_words, Held(RANKS), True)(iter(batches)) for r in b.to_pylist()]
        got.append(sorted(((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in rows), key=key))
    assert got[0] == got[1] == got[2]
    return got[0]


def test_few_hot_words_and_none(docs):
    assert encoded(docs, hot=5) == library(TEXTS) == encoded(docs, hot=0)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=60) | st.text("abcdeor nst", min_size=1, max_size=40).map(str.encode))
def test_heap_merges_equal_the_library(word):
    assert byte_pairs.merge_long(word, RANKS) == LIBRARY._encode_single_piece(word)


def test_fold_equals_the_library_on_words(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeinorst éñ中😀"), rng.integers(1, 15))) for _ in range(300)]
    words = [w for w in words if len(w.encode()) <= byte_pairs.FOLD_BYTES]
    df = spark.createDataFrame([(words,)], "words array<string>").select(byte_pairs.merged_ids(F.col("words"), RANKS).alias("ids"))
    assert df.first()["ids"] == [LIBRARY._encode_single_piece(w.encode()) for w in words]


def test_decode_of_given_ids(spark):
    ids = LIBRARY.encode_ordinary("héllo 中 world")
    df = spark.createDataFrame([(1, ids), (2, []), (3, None), (None, ids[:2])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in byte_pairs.decode(df).collect()}
    assert got == {1: LIBRARY.decode_bytes(ids), 2: b"", 3: b"", None: LIBRARY.decode_bytes(ids[:2])}
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_pairs.decode(spark.createDataFrame([(1, [99_999_999])], "doc_id long, ids array<int>")).collect()


def test_bpe_of_an_empty_table(spark):
    assert byte_pairs.encode(spark.createDataFrame([], "doc_id long, text string, extra int"), decoded=True).collect() == []


def test_bpe_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op11_byte_bpe"](spark, SF).collect()}
    expected = {}
    for d, t in docs.items():
        ids = LIBRARY.encode_ordinary(t)
        expected[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert got == expected


# --- fill in the middle

def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if h4 % 100 < 20 else "psm", len(p), len(m), out, text


def shaped(df):
    out = fill_in_middle.fill_in_middle(df).withColumn("restored", fill_in_middle.restored(F.col("output"), F.col("form")))
    return sorted(map(tuple, out.collect()), key=key)


def test_fill_in_middle_equals_the_plain_version(docs):
    assert shaped(docs) == sorted((plain_fim(i, t) for i, t in TEXTS), key=key)


def test_fill_in_middle_of_many_ids_and_small_slices(spark, monkeypatch):
    alphabet = list("aZ9 \n.<>é中😀PSM")
    rng = np.random.default_rng(2)
    rows = [(i, "".join(rng.choice(alphabet, rng.integers(0, 40)))) for i in range(400)]
    assert shaped(spark.createDataFrame(rows, "doc_id long, text string")) == sorted((plain_fim(i, t) for i, t in rows), key=key)
    import pyarrow as pa
    monkeypatch.setattr(fill_in_middle, "SLICE_BYTES", 64)
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}).slice(7, 300)  # with an offset
    got = [tuple(r.values()) for b in fill_in_middle._transform(iter([batch])) for r in b.to_pylist()]
    assert sorted(got) == sorted(plain_fim(i, t)[:6] for i, t in rows[7:307])


def test_exception_index_converts_cuts_both_ways():
    text = "aé中😀b" * 50 + "plain" * 20
    index = fill_in_middle.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:i].encode()) for i in points])
    assert (index.to_bytes(points) == at).all() and (index.to_points(at) == points).all()
    assert len(index.at) == 150 and len(fill_in_middle.ExceptionIndex(np.frombuffer(b"ascii", np.uint8)).at) == 0


def test_fill_in_middle_of_an_empty_table(spark):
    assert shaped(spark.createDataFrame([], "doc_id long, text string")) == []


# --- conversation repair

def plain_repair(rows):
    """conv_id -> facts, by trying all edits (with strings compared as a whole)."""
    blank = lambda c: " " if c is None else c
    conversations = {}
    for conv, turn, role, text in rows:
        kept = conversations.setdefault(conv, [])
        role, text = blank(role), blank(text)
        fate = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        role = "user" if fate == 4 else role
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    out = {}
    sys.setrecursionlimit(50_000)
    for conv, kept in conversations.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = {r[0] for r in kept if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        faults, seen = [], set()
        for _, role, text in kept:
            body = text.rstrip(" \t\n\v\f\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))

        @lru_cache(None)
        def best(i, last, inserted):
            """(cost, audit, rows) of the cheapest edits from row i on, after a row of role ``last``."""
            offers = [(0, "", ())] if i == len(kept) and last in ("", "a") else []
            turn = "a" if last == "u" else "u"
            name = {"u": "user", "a": "assistant"}[turn]
            if inserted < 3:
                c, a, r = best(i, turn, inserted + 1)
                offers.append((c + 2, "I" + a, ((name, ""), *r)))
            if i < len(kept):
                _, role, text = kept[i]
                c, a, r = best(i + 1, last, 0)
                offers.append((c + 3, "D" + a, r))
                if faults[i] not in ("blank", "duplicate"):
                    fee = faults[i] == "truncated"
                    if role[:1] == turn or (role[:1] == "s" and last == ""):
                        c, a, r = best(i + 1, role[:1], 0)
                        offers.append((c + fee, "K" + a, ((role, text), *r)))
                    c, a, r = best(i + 1, turn, 0)
                    offers.append((c + fee + 2, "R" + a, ((name, text), *r)))
            return min(offers, key=lambda o: o[:2]) if offers else (10**9, "", ())

        cost, audit, repaired = best(0, "", 0)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)
    return out


SCHEMA = "conv_id long, turn long, role string, text string, signature string, facts string, kind int, copy string, nth int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 7, "clash", 7) for r in rows], SCHEMA).repartition(3)


def random_rows(n, seed):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Hello.", "Well", "", " \t", None, "Yes!", "No?", "é.", "ends .\n ", "same text.", "中"]
    rows = []
    for conv in [None, *range(n)]:
        for turn in range(int(rng.integers(1, 9))):
            rows.append((conv, None if rng.random() < 0.08 else int(turn * rng.integers(1, 3)), roles[rng.choice(7, p=[.35, .35, .1, .05, .05, .05, .05])],
                         texts[rng.integers(0, len(texts))]))
    return rows


def repaired(df):
    return {r[0]: tuple(r)[1:] for r in conversation_repair.repaired_digests(conversation_repair.damage(df)).collect()}


def test_repair_equals_the_plain_version(spark):
    rows = random_rows(150, 1)
    rows += [rows[3]] * 3 + [(900, 5, "user", "twice.")] * 4  # repeated rows
    rows += [(901, -2**63, "user", "a."), (901, 2**63 - 1, "assistant", "b.")]
    expected = plain_repair(rows)
    expected = {k: (min(v[0], 2**63 - 1), *v[1:]) for k, v in expected.items()}
    assert repaired(conversations(spark, rows)) == expected


def test_long_conversation(spark):
    rng = np.random.default_rng(4)
    rows = [(1, t, ["user", "assistant", "system"][rng.integers(0, 3)], f"text {rng.integers(0, 500)}" + "." * int(rng.integers(0, 2))) for t in range(700)]
    assert repaired(conversations(spark, rows)) == plain_repair(rows)


def test_conversations_that_lose_all_rows_stay(spark):
    gone = [c for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = repaired(conversations(spark, [(c, 0, "user", "x.") for c in gone]))
    assert got == {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone} and gone


def test_repaired_rows_make_the_digests(spark):
    df = conversation_repair.damage(conversations(spark, random_rows(40, 7)))
    texts = {}
    for r in sorted(conversation_repair.repair(df).collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.place or 0)):
        texts.setdefault(r.conv_id, []).extend([] if r.place is None else [f"{r.role}:{r.text}"])
    digests = {r.conv_id: r.repaired_sha256 for r in conversation_repair.repaired_digests(df).collect()}
    assert digests == {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()}
    roles = "".join(r[0] for t in texts.values() for r in [*t, " "])
    assert all(re.fullmatch("(s?(ua)+)?", c) for c in roles.split(" "))


def test_each_suffix_is_one_node(monkeypatch):
    import pyarrow as pa
    made = []

    class Counted(conversation_repair.Node):
        __slots__ = ()

        def __init__(self, *a):
            made.append(1)
            super().__init__(*a)
    monkeypatch.setattr(conversation_repair, "Node", Counted)
    signatures = sorted({"uauaua", "suaua", "xua", "ua", "a", "uaxua", "oua", "Uaua"}, key=lambda s: s[::-1])
    list(conversation_repair._best_edits(iter([pa.RecordBatch.from_pydict({"signature": signatures})])))
    assert len(made) == len({s[i:] for s in signatures for i in range(len(s) + 1)})


def test_repair_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repaired(empty) == {}


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, SF).collect()}
    assert got == plain_repair(rows)


# --- the pipeline and decontamination

HELPERS = ("_score", "_keep", "_n_lines", "_key", "_id", "_tk", "_b_id", "_b_tk", "row", "id", "doc", "tk", "component_id", "first_tk", "n_shingles", "leaks",
           "score", "keep", "fp", "h1", "h2", "pos", "kind", "length", "piece", "start", "a.b")


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_stages_keep_columns_with_names_of_helpers(spark, stage):
    import corpus_pipeline
    name, function = corpus_pipeline.STAGES[stage]
    words = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(6)]
    rows = [(i, w, i * 10, *[f"{h}-{i}" for h in HELPERS]) for i, w in enumerate(words)] + [(6, None, 0, *["n"] * len(HELPERS)), (7, "", 0, *["e"] * len(HELPERS))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, " + ", ".join(f"`{h}` string" for h in HELPERS))
    out = function(spark, docs, SF)
    assert out.columns == docs.columns
    got = {r["doc_id"]: tuple(r)[3:] for r in out.collect()}
    assert got and all(got[r[0]] == r[3:] for r in rows if r[0] in got)
    if name != "quality":
        assert set(got) == {r[0] for r in rows}


def test_pipeline_of_no_documents(spark, tmp_path):
    import corpus_pipeline
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        (df.limit(0) if t == "documents" else df).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_periodic_text_of_a_megabyte_is_searched_once():
    import time
    from marketlake.llm.decontaminate import Finder
    finder = Finder([(1, "ab" * 170), (2, "ab" * 169 + "zz")])
    began = time.process_time()
    found = finder.find("ab" * 500_000)
    assert time.process_time() - began < 5
    assert [(f["item_id"], f["distance"]) for f in found] == [(1, 0), (2, 2)]


@settings(max_examples=60, deadline=None)
@given(st.text("ab ", min_size=21, max_size=45), st.text("abc ", max_size=120), st.integers(0, 100), st.integers(0, 2))
def test_budgeted_matches_equal_a_table_of_distances(item, text, at, edits):
    from marketlake.llm.decontaminate import Finder, normalise
    text = text[:at] + item[:7] + "c" * edits + item[7:] + text[at:]
    pattern, given_text = normalise(item), normalise(text)
    k = int(len(pattern) * 0.05)
    row = [0] * (len(given_text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(given_text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    found = Finder([(1, item)]).find(text)
    if pattern and k > 0:
        assert [f["distance"] for f in found] == ([min(row)] if min(row) <= k else [])


# --- personal data

TOKEN = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


@pytest.mark.parametrize("text, kinds", [
    (f'config: token = "{TOKEN}" end', ["secret"]), (f"Das Passwort lautet {TOKEN}.", ["secret"]), (f"el secreto y la contraseña {TOKEN}", ["secret"]),
    (f"la clé {TOKEN}", ["secret"]), (f"commit {TOKEN}", []), (f"words {TOKEN} words", []), ("token = " + "a" * 40, []), ("token " + "1" * 40, []),
    ("token = aaaaaaaaaaaaaaaaaaaaaaaaaaaa1aaa2aaa3aaa", []), ("token antidisestablishmentarianismwords", []),
    ("Konto GB82 WEST 1234 5698 7654 32", ["iban"]), ("Beispiel: GB82 WEST 1234 5698 7654 32", []), ("ejemplo GB82WEST12345698765432", []),
    ("example account GB82WEST12345698765432", ["iban"]), ("sécurité sociale 078-05-1120", ["ssn"]), ("steuer 078-05-1120 rechnung", []),
])
def test_context_in_four_languages_raises_and_drops_added_kinds(text, kinds):
    from marketlake.llm import pii
    assert [s.kind for s in pii.find(text) if s.kind not in pii.BASE_KINDS] == kinds


def test_nearer_words_count_more():
    from marketlake.llm import pii
    near, far = (pii.find(f"card {gap}4111111111111111")[0].score for gap in ("", "und mehr Worte dazwischen "))
    assert near > far > pii.find("x 4111111111111111")[0].score


def test_scores_and_secrets_of_the_query(spark):
    rows = QUERIES["op4_pii"](spark, "/root/testdata/sf0.01").collect()
    assert all(len(r.scores.split(",")) == len(r.spans.split(",")) for r in rows)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    planted = {d for d, t in texts.items() if re.search('(?i)token = "[0-9a-f]{40}"', t)}
    assert planted and planted == {r.doc_id for r in rows if "secret:" in r.spans}

"""Byte-level BPE: ranked merges folded by Spark's higher-order functions over the bytes of distinct words.

``merged_ids`` is the method itself, a Column: the bytes of a word are a string of hexadecimal digits, the state
of the fold is one array with an entry (rank of the pair that begins here, place of its first byte) for each
piece, and each step joins the pair of least rank, leftmost first, and looks up the two pairs that changed. The
ranks are one literal in the plan: an array of small maps, found by the hash of a piece.

``encode`` asks it for distinct words only. The words met most often in the whole table are merged once
(``HOT_WORDS`` of them at most, a proven bound of what is broadcast); any other word is merged in the task that
reads it, once for that task, within the same stage. So texts are never shuffled and no vocabulary of the corpus
is gathered anywhere. What is hot changes the time only. ``decode`` concatenates the binary pieces of ids.

Defined results: null and empty texts have no ids; a null doc_id stays; repeated rows have a row each; an empty
table gives an empty one; columns other than the id and the text are not read, so their names cannot clash.
Words over ``FOLD_BYTES`` (runs without a space, such as 1 MB of one letter) are merged in the same order by a
linked list with a heap in Python, as an array that is copied for each merge would take quadratic time.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, found_at, gathered, hold_cache, slices
from .words import Cut, default_pattern

DEFAULT_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
FOLD_BYTES = 64
HOT_WORDS = 1_200_000
SEEN_WORDS = 1_000_000
LONG = 1 << 30
SLICE_BYTES = 4 << 20
DECODED_IDS = 1 << 20
BUCKETS = 8192
PLACE_BITS = 20
NO_RANK = 2**31 - 1

_workers: dict[int, object] = {}


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_VOCABULARY)


def load_ranks(path: str) -> dict[bytes, int]:
    """Piece -> rank (which is also its id) of a rank file: a base64 piece and a number on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}


# --- the fold

def _rank_literal(ranks: dict[bytes, int]) -> Column:
    found: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        digits = piece.hex().upper()
        found[xxhash.xxh64_intdigest(digits, seed=42) % BUCKETS][digits] = rank  # as Spark's xxhash64
    return F.from_json(F.lit(json.dumps(found, separators=(",", ":"))), "array<map<string,int>>")


def _rank(found: Column, piece: Column) -> Column:
    bucket = F.element_at(found, (F.xxhash64(piece).bitwiseAND(F.lit(BUCKETS - 1)) + 1).cast("int"))
    return F.coalesce(F.element_at(bucket, piece), F.lit(NO_RANK))


def _fold(found: Column, word: Column) -> Column:
    """Ids of one word of at most ``FOLD_BYTES`` bytes. A place outside the word is ``--``, a piece that has no rank."""
    n = F.octet_length(word)
    nothing = F.lit(NO_RANK << PLACE_BITS)

    def place(pair: Column) -> Column:
        return pair.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))

    def merged(digits: Column) -> Column:
        def piece(begin: Column, end: Column) -> Column:
            return F.substring(digits, begin.cast("int"), (end - begin).cast("int"))

        def pair(begin: Column, end: Column) -> Column:
            return F.shiftleft(_rank(found, piece(begin, end)).cast("long"), PLACE_BITS) + begin

        def at(pairs: Column, k: Column) -> Column:
            return place(F.element_at(pairs, k.cast("int")))

        def step(pairs: Column, _: Column) -> Column:
            least = F.array_min(pairs)
            joined = F.transform(F.array(F.array_position(pairs, least)), lambda k: F.concat(
                F.slice(pairs, 1, (k - 2).cast("int")),
                F.array(pair(at(pairs, k - 1), at(pairs, k + 2)), pair(at(pairs, k), at(pairs, k + 3))),
                F.slice(pairs, (k + 2).cast("int"), F.size(pairs))))[0]
            return F.when(least >= nothing, pairs).otherwise(joined)

        def ids(pairs: Column) -> Column:
            return F.transform(F.slice(pairs, 2, F.size(pairs) - 3),
                               lambda p, i: _rank(found, piece(place(p), at(pairs, i + 3))))

        first = F.concat(F.transform(F.sequence(F.lit(1).cast("long"), 2 * n + 1, F.lit(2).cast("long")), lambda p: pair(p, p + 4)),
                         F.array(nothing + 2 * n + 3, nothing + 2 * n + 5))
        return F.aggregate(F.sequence(F.lit(1), n), first, step, ids)

    return F.transform(F.array(F.concat(F.lit("--"), F.hex(word), F.lit("--"))), merged)[0]


def merged_ids(words: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of each word of an array of words that aren't empty and have at most ``FOLD_BYTES`` bytes."""
    return F.transform(F.array(_rank_literal(ranks)), lambda found: F.transform(words, lambda word: _fold(found, word)))[0]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word of any length: the pair of least rank, leftmost first, from a heap over a linked list."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the piece that begins here; end is 0 where none does
    heap = []

    def push(a: int) -> None:
        b = end[a]
        if b < n and (r := ranks.get(word[a:end[b]])) is not None:
            heap.append((r, a, end[b])) if not ready else heapq.heappush(heap, (r, a, end[b]))

    ready = False
    for a in range(n - 1):
        push(a)
    heapq.heapify(heap)
    ready = True
    while heap:
        _, a, c = heapq.heappop(heap)
        b = end[a]
        if not b or b >= n or end[b] != c:  # one of the two pieces has been joined since
            continue
        end[a], end[b] = c, 0
        if c < n:
            before[c] = a
            push(a)
        if before[a] >= 0:
            push(before[a])
    out, a = [], 0
    while a < n:
        out.append(ranks[word[a:end[a]]])
        a = end[a]
    return out


# --- words of texts

def _count_words(pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> Iterator[pa.RecordBatch]:
            summed = pa.Table.from_batches(met).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
            met.clear()
            yield from summed.to_batches(max_chunksize=1 << 16)
            pa.default_memory_pool().release_unused()

        met: list[pa.RecordBatch] = []
        for b in slices(it, 0, SLICE_BYTES):
            found = Cut(pattern, b.column(0))
            units = np.bincount(found.units, minlength=len(found.size))
            n = np.bincount(found.of_unit, np.repeat(units, found.size), len(found.words)).astype(np.int64)
            short = pa.array(found.short(FOLD_BYTES))
            met.append(pa.RecordBatch.from_arrays([found.words.filter(short), pa.array(n).filter(short)], ["word", "n"]))
            if sum(x.num_rows for x in met) > SEEN_WORDS:
                yield from told()
        if met:
            yield from told()
    return run


def hot_words(docs: DataFrame, pattern: str, text: str = "text", most: int = HOT_WORDS) -> DataFrame:
    """The words met most often in all texts, ``most`` at most: those over a count that is read off a histogram."""
    counts = cut(docs.select(F.col(text).alias("text")).mapInArrow(_count_words(pattern), "word string, n long")
                 .groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    level = F.floor(8 * F.log2("n")).cast("int")
    histogram = sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    least, total = 10**6, 0
    for r in histogram:
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    return counts.where(level >= least).select("word")


_CUT = "doc_id {}, units binary, fresh boolean, words array<string>, long array<string>, refs binary, of_unit binary, size binary"


def _new_words(pattern: str, hot) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts as numbers of their units, and what a slice's units are made of, on its first row.

    ``words``: those that no earlier slice of the partition has and that aren't hot, to be merged next; ``long``:
    those the fold doesn't take. ``refs``: for each word of the slice, its number among the hot words, or beyond them
    among the words met so far, or from ``LONG`` among the long ones. ``fresh`` where "so far" begins anew.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _hot_words(hot)
        none = pa.array([], pa.string())
        seen, anew = none, True
        for b in slices(it, 1, SLICE_BYTES):
            if len(seen) > SEEN_WORDS:
                seen, anew = none, True
            found = Cut(pattern, b.column(1))
            refs = found_at(found.words, known)
            earlier = found_at(found.words, seen)
            refs = np.where((refs < 0) & (earlier >= 0), earlier + len(known), refs)
            short = found.short(FOLD_BYTES)
            new, long = (refs < 0) & short, (refs < 0) & ~short
            refs[new] = np.arange(len(known) + len(seen), len(known) + len(seen) + int(new.sum()))
            refs[long] = np.arange(LONG, LONG + int(long.sum()))
            words = found.words.filter(pa.array(new))
            seen = pa.concat_arrays([seen, words])
            rest = [None] * (b.num_rows - 1)
            fresh = np.zeros(b.num_rows, bool)
            fresh[0], anew = anew, False
            units, ends = found.units.astype("<i4").tobytes(), np.append(0, found.ends) * 4
            own = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(units)])
            tables = [pa.array([x.astype("<i4").tobytes(), *rest], pa.binary()) for x in (refs, found.of_unit, found.size)]
            lists = [_on_first_row(x, b.num_rows) for x in (words, found.words.filter(pa.array(long)))]
            del found
            yield pa.RecordBatch.from_arrays([b.column(0), own, pa.array(fresh), *lists, *tables],
                                             ["doc_id", "units", "fresh", "words", "long", "refs", "of_unit", "size"])
            pa.default_memory_pool().release_unused()
    return run


def _on_first_row(values: pa.Array, rows: int) -> pa.ListArray:
    ends = np.full(rows + 1, len(values), np.int32)
    ends[0] = 0
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _hot_words(hot) -> pa.Array:
    """The broadcast words, read in place; once for each Python worker."""
    return _kept(hot, lambda table: table.column(0).combine_chunks())


def _hot_ids(hot) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of the broadcast words: all end to end, where those of each word begin, and how many they are."""
    def read(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values, sizes = _runs(table.column(0).combine_chunks())
        return values, np.cumsum(sizes) - sizes, sizes
    return _kept(hot, read)


def _kept(broadcast, read: Callable):
    hold_cache("byte_pairs", _workers.clear)
    raw = broadcast.value
    key = zlib.crc32(raw)
    if key not in _workers:
        if len(_workers) > 1:  # of another run
            _workers.clear()
        _workers[key] = read(pa.ipc.open_stream(raw).read_all())
    return _workers[key]


def _runs(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return lists.flatten().to_numpy().astype(np.int32, copy=False), np.diff(lists.offsets.to_numpy())


class Pieces:
    """The binary pieces of a vocabulary end to end, by id."""

    def __init__(self, ranks: dict[bytes, int]):
        piece = {r: p for p, r in ranks.items()}
        self.sizes = np.full(max(piece) + 1, -1, np.int64)
        for r, p in piece.items():
            self.sizes[r] = len(p)
        self.starts = np.cumsum(np.maximum(self.sizes, 0)) - np.maximum(self.sizes, 0)
        self.data = np.frombuffer(b"".join(piece[r] for r in sorted(piece)), np.uint8)

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The pieces of each run ``ids[ends[k]:ends[k + 1]]`` one after another."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes) or self.sizes[ids].min() < 0):
            raise ValueError("an id is not in the vocabulary")
        raw, byte_ends = gathered(self.data, self.starts, self.sizes, ids)
        at = np.concatenate([[0], byte_ends])[ends].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])


def _put_together(hot_ids, vocabulary, decoded: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = _hot_ids(hot_ids)
        pieces = Pieces(vocabulary.value) if decoded else None
        nothing = np.zeros(0, np.int64)
        met = (nothing, nothing, nothing)
        unit_ids = unit_start = unit_size = None
        for b in it:
            firsts = np.flatnonzero(b.column("refs").is_valid().to_numpy(zero_copy_only=False)).tolist()
            for lo, hi in zip([0, *firsts], [*firsts, b.num_rows]):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                first = {c: part.column(c)[0] for c in ("fresh", "long", "refs", "of_unit", "size")}
                if first["refs"].is_valid:
                    if first["fresh"].as_py():
                        met = (nothing, nothing, nothing)
                    new = part.column("merged").slice(0, 1).flatten()
                    if len(new):
                        values, sizes = _runs(new)
                        sizes = np.concatenate([met[2], sizes])
                        met = (np.concatenate([met[0], values]), np.cumsum(sizes) - sizes, sizes)
                    refs, of_unit, unit_words = (np.frombuffer(first[c].as_buffer(), "<i4") for c in ("refs", "of_unit", "size"))
                    long = [np.array(merge_long(w.encode(), vocabulary.value), np.int32) for w in first["long"].as_py()]
                    long_size = np.fromiter(map(len, long), np.int64, len(long))
                    of_long = (np.concatenate([nothing, *long]), np.cumsum(long_size) - long_size, long_size)
                    size, start = np.zeros(len(refs), np.int64), np.zeros(len(refs), np.int64)
                    parts, length = [], 0
                    for begin, end, (values, starts, sizes) in ((0, len(hot[2]), hot), (len(hot[2]), LONG, met), (LONG, 2 * LONG, of_long)):
                        here = np.flatnonzero((refs >= begin) & (refs < end))
                        got, ends = gathered(values, starts, sizes, refs[here] - begin)
                        size[here] = sizes[refs[here] - begin]
                        start[here] = length + ends - size[here]
                        parts.append(got.astype(np.int32, copy=False))
                        length += len(got)
                    unit_ids, ends = gathered(np.concatenate(parts), start, size, of_unit)
                    at = np.append(0, np.cumsum(unit_words, dtype=np.int64))
                    unit_size = np.diff(np.append(0, ends)[at])
                    unit_start = np.cumsum(unit_size) - unit_size
                units = part.column("units")
                at = np.frombuffer(units.buffers()[1], np.int32)[units.offset:units.offset + len(units) + 1]
                picks = np.frombuffer(units.buffers()[2], "<i4", int(at[-1] - at[0]) // 4, int(at[0]))
                ids, ends = gathered(unit_ids, unit_start, unit_size, picks)
                text_ends = np.append(0, ends)[(at - at[0]) // 4].astype(np.int32)
                columns = {"doc_id": part.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(text_ends), pa.array(ids, pa.int32()))}
                if pieces:
                    columns["decoded"] = pieces.decoded(ids, text_ends)
                yield pa.RecordBatch.from_pydict(columns)
                pa.default_memory_pool().release_unused()
    return run


def _as_stream(table: pa.Table) -> bytes:
    """One batch, so that workers read it in place."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id: str = "doc_id", text: str = "text",
           hot: int = HOT_WORDS, decoded: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs``: each match of ``pattern`` encoded by itself, no special tokens.
    ``decoded`` adds what ``decode`` gives for the ids, in the same tasks."""
    spark = docs.sparkSession
    ranks = load_ranks(vocabulary or default_vocabulary())
    pattern = pattern or default_pattern()
    # at most ``hot`` words of at most FOLD_BYTES bytes
    merged = (hot_words(docs, pattern, text, hot).repartition(spark.sparkContext.defaultParallelism)
              .select("word", merged_ids(F.array("word"), ranks)[0].alias("ids")).toArrow())
    known, of_known = (spark.sparkContext.broadcast(_as_stream(merged.select([c]))) for c in ("word", "ids"))
    table = spark.sparkContext.broadcast(ranks)
    id_type = docs.schema[id].dataType.simpleString()
    cut_up = (docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
              .mapInArrow(_new_words(pattern, known), _CUT.format(id_type)))
    return (cut_up.select("doc_id", "units", "fresh", merged_ids(F.col("words"), ranks).alias("merged"), "long", "refs", "of_unit", "size")
            .mapInArrow(_put_together(of_known, table, decoded), f"doc_id {id_type}, ids array<int>" + ", decoded binary" * decoded))


def _decode(vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(vocabulary.value)
        for whole in it:
            ends = whole.column(1).offsets.to_numpy()
            lo = 0
            while lo < whole.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + DECODED_IDS, "right")) - 1)
                b = whole.slice(lo, hi - lo)
                found = pieces.decoded(b.column(1).flatten().to_numpy(), ends[lo:hi + 1] - ends[lo])
                yield pa.RecordBatch.from_arrays([*b.columns, found], ["doc_id", "ids", "decoded"])
                lo = hi
    return run


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded binary): the pieces of the ids one after another. Null ids give empty bytes; an id that
    is not in the vocabulary is an error."""
    table = encoded.sparkSession.sparkContext.broadcast(load_ranks(vocabulary or default_vocabulary()))
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(_decode(table), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")

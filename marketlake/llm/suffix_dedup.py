"""Dedup of repeated bytes by runs of equal window names, in place of a suffix array by prefix doubling.

Which bytes lie in a ``width``-byte string that also starts elsewhere? Prefix doubling answers it by naming
positions with their first h bytes, pairing the names at offset h, and sorting again, until names are unique
or h reaches ``width``. Here the pairing is done inside a text, where the name at any offset is at hand, with
64-bit names in place of ranks, so no shuffle is needed to look a name up; what Spark sorts are runs of
positions, since sorting every position would move many times the input:

1. Neighbouring positions whose windows have the same least ``GRAM``-byte name form a run, about two for each
   ``width`` bytes. Equal windows have equal least names, so a run whose name occurs once has no repeated window.
2. Runs are range-sorted by the pair (least name, name of all their bytes) and reranked by their neighbours:
   a name that stands alone is dropped, equal pairs are repeated as a whole, and runs that share the name
   only go on to the next step.
3. Those are compared window by window at the full width among the runs of one name: in a task where their
   windows fit in its memory, else as rows of one aggregate, so a frequent name is spread over all tasks.

The rank loop itself (sort position and rank pairs, rerank, double the offset, repeat) is not built: there is one
range sort and one rerank pass. The result is exact up to collisions of two 64-bit names at once. A group of any size is sorted by position as
well, so it is cut into as many ranges as it needs, and a range's edge only makes step 3 look at more runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, text_key
from .windows import GRAM, pair, sliding_min, window_names

WIDTH = 200
CHUNK = 1 << 20
TASK_BYTES = 256 << 20  # memory that a task may take to compare windows
WINDOW_BYTES = 100  # that one window takes there: 73 measured, and some in reserve
SMALL_GROUP = TASK_BYTES // WINDOW_BYTES  # windows of one name that a task compares by itself
BODY_SHARE = 32  # bytes of text that take the memory of a window: three copies of them
SLICE = 2048
RUNS = "m long, c long, doc_id long, tk int, lo int, n int, self boolean"
RANKED = "m long, doc_id long, tk int, lo int, n int, whole boolean, need boolean"
CONTENTS = "m long, doc_id long, tk int, lo int, weight int, body binary"
SPANS = "doc_id long, tk int, start int, end int"


def _key(text: str):
    """31 bits are enough to tell rows apart that share an id."""
    return text_key(text).bitwiseAND(0x7FFFFFFF).cast("int")


def _packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tk, z): compressed texts, for shuffles."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3).compress
        for b in batches(it):
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "tk": b.column(1),
                                              "z": pa.array([compress((t or "").encode()) for t in b.column(2).to_pylist()], pa.binary())})
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text_col).alias("tk"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, tk int, z binary")


def runs(raw: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one least name: names, contexts, first windows, lengths, and whether a name recurs."""
    span = width - GRAM + 1
    for base in range(0, len(raw) - width + 1, CHUNK):
        part = raw[base:base + CHUNK + width - 1]
        gram, window = window_names(part, width)
        least = sliding_min(gram, span)
        lo = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        hi = np.append(lo[1:], len(least)) - 1
        name = least[lo]
        context = pair(window[lo], window[hi], 30) ^ (hi - lo).astype(np.uint64)
        for i in np.flatnonzero(hi - lo > width):  # the first and the last window don't cover these
            context[i] = xxhash.xxh64_intdigest(part[lo[i]:hi[i] + width].tobytes())
        # a gram that is the least of a window containing it; one name at two such places may repeat a window
        padded = np.zeros(len(least) + 2 * span - 2, np.uint64)
        padded[span - 1:span - 1 + len(least)] = least
        at_least = ~sliding_min(~padded, span) == gram
        values, counts = np.unique(gram[at_least], return_counts=True)
        recurs = np.isin(name, values[counts > 1])
        yield name, context, lo + base, hi - lo + 1, recurs


def _runs(width: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 256):
            out = []
            for doc, tk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                out += [(doc, tk, r) for r in (runs(raw, width) if len(raw) >= width else ())]
            if not out:
                continue
            sizes = [len(r[0]) for _, _, r in out]
            columns = [np.concatenate([r[i] for _, _, r in out]) for i in range(5)]
            ids = pa.array([d for d, _, _ in out], pa.int64()).take(pa.array(np.repeat(np.arange(len(out)), sizes)))
            yield pa.RecordBatch.from_pydict({
                "m": columns[0].view(np.int64), "c": columns[1].view(np.int64), "doc_id": ids, "tk": np.repeat(np.array([t for _, t, _ in out], np.int32), sizes),
                "lo": columns[2].astype(np.int32), "n": columns[3].astype(np.int32), "self": pa.array(columns[4])})
    return run


def rerank(m: np.ndarray, c: np.ndarray, recurs: np.ndarray, open_left: bool, open_right: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by (m, c): which stay, which are repeated as a whole, which step 3 has to look at.

    ``open_left`` and ``open_right``: the first or last name may go on in another range.
    """
    new_m = np.concatenate([[True], m[1:] != m[:-1]])
    new_c = new_m | np.concatenate([[True], c[1:] != c[:-1]])
    of_m, of_c = np.cumsum(new_m) - 1, np.cumsum(new_c) - 1
    whole = np.bincount(of_c)[of_c] > 1
    contents = np.bincount(of_m[new_c])[of_m]
    edge = (open_left & (of_m == 0)) | (open_right & (of_m == of_m[-1]))
    alone = np.bincount(of_m, weights=~whole)[of_m] > 0  # the name has a run that is not repeated as a whole
    need = np.where(whole, new_c & (alone | edge), (contents > 1) | edge | recurs)
    return whole | need, whole, need


def _rerank(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams a range; holds a batch and the rows of the name that is open."""
    held: pa.Table | None = None
    first = True

    def done(rows: pa.Table, open_right: bool) -> pa.RecordBatch:
        m, c, recurs = (rows.column(k).to_numpy() for k in ("m", "c", "self"))
        stay, whole, need = rerank(m, c, recurs, first, open_right)
        rows = rows.select(["m", "doc_id", "tk", "lo", "n"]).append_column("whole", pa.array(whole)).append_column("need", pa.array(need))
        return rows.filter(pa.array(stay)).combine_chunks()

    for b in it:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([b])
        if held is not None:
            rows = pa.concat_tables([held, rows])
        m = rows.column("m").to_numpy()
        last = len(m) - int(np.argmax(m[::-1] != m[-1])) if m[0] != m[-1] else 0
        held = rows.slice(last)
        if last:
            yield from done(rows.slice(0, last), False).to_batches()
            first = False
    if held is not None:
        yield from done(held, True).to_batches()


def _contents(width: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches(it, 128):
            rows = []
            for doc, tk, z, wanted in zip(*(b.column(i).to_pylist() for i in range(4))):
                raw = expand(z)
                rows += [(r["m"], doc, tk, r["lo"], 2 if r["whole"] else 1, raw[r["lo"]:r["lo"] + r["n"] - 1 + width]) for r in wanted]
            if rows:
                m, doc, tk, lo, weight, body = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    "m": pa.array(m, pa.int64()), "doc_id": pa.array(doc, pa.int64()), "tk": pa.array(tk, pa.int32()), "lo": pa.array(lo, pa.int32()),
                    "weight": pa.array(weight, pa.int32()), "body": pa.array(body, pa.binary())})
    return run


def _windows(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all bodies: row, offset in the body, name. Names are made for a slice of rows at a time."""
    parts = [_slice_windows(rows.slice(i, SLICE), i, width) for i in range(0, rows.num_rows, SLICE)]
    return tuple(np.concatenate(column) for column in zip(*parts))


def _slice_windows(rows: pa.Table, first: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bodies = rows.column("body").to_pylist()
    lengths = np.array(list(map(len, bodies)))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    n = lengths - width + 1
    row = np.repeat(np.arange(len(bodies), dtype=np.int32), n)
    offset = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
    _, names = window_names(np.frombuffer(b"".join(bodies), np.uint8), width)
    return row + np.int32(first), offset, names[starts[row] + offset]


def _spans(rows: pa.Table, row: np.ndarray, offset: np.ndarray, width: int) -> pa.RecordBatch:
    """Spans covered by the given windows, which are in order."""
    at = rows.column("lo").to_numpy()[row] + offset
    begin = np.ones(len(row), bool)
    begin[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    end = np.append(begin[1:], True) if len(begin) else begin
    which = pa.array(row[begin])
    return pa.RecordBatch.from_pydict({
        "doc_id": rows.column("doc_id").combine_chunks().take(which), "tk": rows.column("tk").combine_chunks().take(which),
        "start": at[begin].astype(np.int32), "end": (at[end] + width).astype(np.int32)})


def _sizes(rows: pa.Table, width: int) -> np.ndarray:
    """What each body counts towards ``SMALL_GROUP``, as in ``_size``."""
    lengths = pc.binary_length(rows.column("body")).to_numpy().astype(np.int64)
    return lengths - width + 1 + lengths // BODY_SHARE


def _size(width: int):
    return F.length("body").cast("long") - (width - 1) + F.floor(F.length("body") / BODY_SHARE)


def _large(contents: DataFrame, width: int) -> DataFrame:
    """Names with more windows than a task compares by itself: at most about one for each ``SMALL_GROUP`` bytes of text."""
    return contents.groupBy("m").agg(F.sum(_size(width)).alias("size")).where(F.col("size") > SMALL_GROUP).select("m")


def _compare(width: int):
    """Windows that recur among the bodies of one name; rows come sorted by name, with few windows of each."""
    def done(rows: pa.Table) -> pa.RecordBatch:
        row, offset, names = _windows(rows, width)
        weight = rows.column("weight").to_numpy()
        key = pair(names, rows.column("m").to_numpy().view(np.uint64)[row], 31)
        _, inverse = np.unique(key, return_inverse=True)
        again = (np.bincount(inverse, weights=weight[row])[inverse] > 1) & (weight[row] == 1)
        return _spans(rows, row[again], offset[again], width)

    def by_names(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """As many whole names at a time as a task may hold windows of."""
        m = rows.column("m").to_numpy()
        ends = np.append(np.flatnonzero(m[1:] != m[:-1]) + 1, len(m))
        upto = np.cumsum(_sizes(rows, width))[ends - 1]
        lo = before = 0
        for i, end in enumerate(ends):
            if i + 1 == len(ends) or upto[i + 1] - before > SMALL_GROUP:
                yield done(rows.slice(lo, end - lo))
                lo, before = end, upto[i]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches(it, 1024):
            rows = pa.Table.from_batches([b])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            m = rows.column("m").to_numpy()
            last = len(m) - int(np.argmax(m[::-1] != m[-1])) if m[0] != m[-1] else 0
            held = rows.slice(last)
            if last:
                yield from by_names(rows.slice(0, last))
        if held is not None:
            yield from by_names(held)
    return run


def _window_rows(width: int):
    """Windows of bodies as rows: those of one name that touch or overlap within a body are one row with their number.

    A periodic body has as many names as its period is long, so it makes few rows however long it is.
    """
    def done(rows: pa.Table) -> pa.RecordBatch:
        row, offset, names = _windows(rows, width)
        order = np.lexsort((offset, names, row))
        row, offset, names = row[order], offset[order], names[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (names[1:] != names[:-1]) | (offset[1:] - offset[:-1] > width)
        at = np.flatnonzero(first)
        last = np.append(at[1:], len(row)) - 1
        row, start, end = row[at], offset[at], offset[last] + width
        which, lo = pa.array(row), rows.column("lo").to_numpy()[row]
        column = lambda k: rows.column(k).combine_chunks().take(which)
        return pa.RecordBatch.from_pydict({
            "m": column("m"), "name": names[at].view(np.int64), "doc_id": column("doc_id"), "tk": column("tk"), "start": (lo + start).astype(np.int32),
            "end": (lo + end).astype(np.int32), "weight": column("weight"), "k": (last - at + 1) * rows.column("weight").to_numpy()[row].astype(np.int64)})

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            if not b.num_rows:
                continue
            rows = pa.Table.from_batches([b])
            upto = np.cumsum(_sizes(rows, width))
            lo = before = 0
            for end in range(1, len(upto) + 1):  # a body at least, at most about CHUNK windows
                if end == len(upto) or upto[end] - before > CHUNK:
                    yield done(rows.slice(lo, end - lo))
                    lo, before = end, upto[end - 1]
    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of UTF-8 bytes covered by ``width``-byte strings that start anywhere else too: (doc_id, tk, start, end).

    Spans of one row may touch or overlap. Matches never cross rows. ``tk`` tells rows apart that share an id; rows
    that repeat id and text are copies of each other, so all their windows are repeated. Null text is empty, texts
    under ``width`` bytes have no span, a null id is an id of its own. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _key(text_col).alias("tk"), F.col(text_col).alias("text"))
    found = cut(rows.mapInArrow(_runs(width), RUNS), "runs")
    order = ("m", "c", "doc_id", "tk", "lo")
    ranked = cut(found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_rerank, RANKED), "ranked")
    whole = ranked.where("whole").select("doc_id", "tk", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + (width - 1)).alias("end"))

    wanted = ranked.where("need").groupBy("doc_id", "tk").agg(F.collect_list(F.struct("m", "lo", "n", "whole")).alias("wanted"))
    wanted = wanted.select(F.col("doc_id").alias("w_id"), F.col("tk").alias("w_tk"), "wanted")
    texts = _packed(docs, id_col, text_col)
    joined = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["w_id"]) & (texts["tk"] == wanted["w_tk"]))
    contents = cut(joined.select("doc_id", "tk", "z", "wanted").mapInArrow(_contents(width), CONTENTS), "contents")

    large = F.broadcast(_large(contents, width))
    few = contents.join(large, "m", "left_anti").repartition("m").sortWithinPartitions("m").mapInArrow(_compare(width), SPANS)
    many = contents.join(large, "m", "left_semi").select(*contents.columns).mapInArrow(
        _window_rows(width), "m long, name long, doc_id long, tk int, start int, end int, weight int, k long")
    again = cut(many.groupBy("m", "name").agg(F.sum("k").alias("total")).where("total > 1").select("m", "name"), "again")
    spread = many.where("weight = 1").join(again, ["m", "name"]).select("doc_id", "tk", "start", "end")  # the join of a hot name can be split
    return whole.unionByName(few).unionByName(spread)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of spans that touch or overlap."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def with_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as (doc_id, tk, z, spans): the compressed UTF-8 text and the array of its (start, end), or null."""
    grouped = spans.groupBy(F.col("doc_id").alias("s_id"), F.col("tk").alias("s_tk")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    texts = _packed(docs, id_col, text_col)
    return texts.join(grouped, texts["doc_id"].eqNullSafe(grouped["s_id"]) & (texts["tk"] == grouped["s_tk"]), "left").select("doc_id", "tk", "z", "spans")


def remove_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left of a text without its merged spans."""
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at:start])
        at = end
    return b"".join([*out, raw[at:]])


def kept_text(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, the bytes that stay, and the removed spans (merged, in order)."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches(it, 256):
            kept, removed = [], []
            for z, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                gone = merged([(s["start"], s["end"]) for s in spans or ()])
                kept.append(remove_spans(expand(z), gone))
                removed.append([{"start": a, "end": e} for a, e in gone])
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), "kept": pa.array(kept, pa.binary()), "removed": pa.array(removed, kind)})

    joined = with_spans(docs, repeated_spans(docs, width, id_col, text_col), id_col, text_col)
    return joined.select("doc_id", "z", "spans").mapInArrow(run, "doc_id long, kept binary, removed array<struct<start:int,end:int>>")

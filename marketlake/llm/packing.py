"""Best-fit packing of tokenised documents into fixed-length sequences, in bulk-synchronous supersteps.

Documents are cut into pieces and range-sorted by length with Spark. Pieces of one length are alike, and
so are sequences with one gap, so a superstep works on runs: the sweep visits the lengths from the longest
down, and every run of pieces goes to its successor, the smallest open gap that holds it. Pieces that want
the same gap are told apart by rank: the first ones in the range order get the sequences of that gap in
order, the others go on to the next larger gap. A gap takes one piece in a superstep; afterwards the gaps
are updated, and the sweep is repeated until nothing fits, when the longest run opens new sequences.

The runs are a directory of at most ``capacity`` lengths and gaps whatever the input, which is why the
sweep itself needs no shuffle; the pieces are never collected. Their ranks come from the range-sorted
table and a directory with one row per partition and length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict, deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slices
from .tokens import SLICE_BYTES, default_vocabulary, encoder

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut_documents(vocabulary: str, capacity: int, end_id: int) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes()
        for b in slices(it, 1, SLICE_BYTES):
            rows = []
            for doc, raw in zip(b.column(0).to_pylist(), encode(b.column(1))):
                raw = memoryview(raw + end)
                n = len(raw) // 4
                lo, hi, piece = 0, n % capacity or min(n, capacity), 0
                while lo < n:
                    rows.append((doc, piece, lo, hi - lo, zlib.crc32(raw[4 * lo:4 * hi])))
                    lo, hi, piece = hi, hi + capacity, piece + 1
            doc, piece, start, length, crc = zip(*rows)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})
    return run


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                  capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``capacity`` ids; of a longer document all but the first are full."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_cut_documents(vocabulary or default_vocabulary(), capacity, end_id), PIECES)


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Places for ``counts`` pieces of each length: rows (length, first rank, n, first sequence, offset).

    Rank r of a row's run goes to sequence ``first sequence + r - first rank``. Second result: sequences used.
    """
    left = {n: [0, k] for n, k in counts.items() if k}  # length -> next rank, pieces left
    gaps: dict[int, deque] = defaultdict(deque)  # gap -> runs (first sequence, n)
    places, used = [], 0

    def put(length: int, first: int, n: int, gap: int, fresh: list) -> None:
        rank, k = left[length]
        places.append((length, rank, n, first, capacity - gap))
        left[length] = [rank + n, k - n]
        if gap > length:
            fresh.append((gap - length, first, n))

    def open_sequences(length: int, n: int, fresh: list) -> None:
        nonlocal used
        put(length, used, n, capacity, fresh)
        used += n

    fresh: list[tuple[int, int, int]] = []
    for length in sorted(left, reverse=True):
        if 2 * length > capacity:  # no two of these share a sequence
            open_sequences(length, left[length][1], fresh)
    while True:
        for gap, first, n in fresh:
            gaps[gap].append((first, n))
        fresh = []
        sizes = sorted(g for g, runs in gaps.items() if runs)
        for length in sorted((n for n, (_, k) in left.items() if k), reverse=True):
            at = bisect_left(sizes, length)
            while at < len(sizes) and left[length][1]:
                runs = gaps[sizes[at]]
                while runs and left[length][1]:
                    first, n = runs.popleft()
                    m = min(n, left[length][1])
                    put(length, first, m, sizes[at], fresh)
                    if m < n:
                        runs.appendleft((first + m, n - m))
                if runs:
                    break
                del sizes[at]
        if not fresh and not any(k for _, k in left.values()):
            return places, used
        if not fresh and (longest := max((n for n, (_, k) in left.items() if k), default=None)) and not any(g >= longest for g in sizes):
            open_sequences(longest, -(-left[longest][1] // (capacity // longest)), fresh)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` from 1 to ``capacity``; other columns stay.

    Offsets are gapless from 0 in every sequence. Ties in length go by doc_id and piece; repeated rows are
    packed each; a null doc_id sorts first; an empty table gives an empty result.
    """
    spark = pieces.sparkSession
    sort = [c for c in ("length", "doc_id", "piece") if c in pieces.columns]
    ranged = pieces.repartitionByRange(*sort).sortWithinPartitions(*sort)
    # partition number in the upper bits, place in the partition in the lower 33
    ranged = cut(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    directory = (ranged.groupBy("length", F.shiftright("_at", 33).alias("_part"))
                 .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).orderBy("length", "_part").collect())
    counts, runs = defaultdict(int), []  # one row per length and partition: at most capacity + partitions
    for r in directory:
        runs.append((r["length"], r["_part"], r["_first"] - counts[r["length"]]))
        counts[r["length"]] += r["_n"]
    places, _ = best_fit(dict(counts), capacity)
    run_table = spark.createDataFrame(runs, "length long, _part long, _base long")
    place_table = spark.createDataFrame(places, "length long, _rank long, _n long, _sequence long, offset long")
    ranked = ranged.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(run_table), ["length", "_part"])
    ranked = ranked.withColumn("_r", F.col("_at") - F.col("_base"))
    placed = ranked.join(F.broadcast(place_table), "length").where(
        (F.col("_r") >= F.col("_rank")) & (F.col("_r") < F.col("_rank") + F.col("_n")))
    return placed.select(*pieces.columns, (F.col("_sequence") + F.col("_r") - F.col("_rank")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack whole documents. Null text counts as empty and still holds its end id."""
    pieces = cut(cut_documents(docs, id_col, text_col, vocabulary, capacity, end_id), "pieces")
    return pack(pieces, capacity)

"""Line dedup: range-partitioned line hashes, first occurrences streamed, keep bitmaps per document.

Lines become rows (128-bit hash of the line's key, document, position). The rows are range-partitioned and
sorted by hash, document and position, so a line that a third of the documents hold is cut by document
into as many ranges as it needs. Each range is streamed once: the first document of a hash keeps its lines,
those of later documents are dropped. Only a range's first hash may have begun in an earlier range; its
rows wait for the smallest document of that hash, which comes from a table of two rows per range.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, text_key

SPACE = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
LINES = "h1 long, h2 long, doc_id long, tk long, pos int, n_lines int"
STREAMED = "kind int, " + LINES
BITMAPS = "doc_id long, tk long, n_lines long, n_dropped long, keep binary"


def _lines(min_chars: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            digests, docs, tks, positions, totals = [], [], [], [], []
            for doc, tk, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines = (text or "").split("\n")
                for i, line in enumerate(lines):
                    line = line.strip(SPACE)
                    if len(line) >= min_chars:
                        digests.append(xxhash.xxh3_128_digest(line.encode().lower()))  # bytes: A-Z only
                        docs.append(doc)
                        tks.append(tk)
                        positions.append(i)
                        totals.append(len(lines))
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_pydict({
                "h1": np.ascontiguousarray(h[:, 0]), "h2": np.ascontiguousarray(h[:, 1]), "doc_id": pa.array(docs, pa.int64()),
                "tk": pa.array(tks, pa.int64()), "pos": pa.array(positions, pa.int32()), "n_lines": pa.array(totals, pa.int32())})
    return run


def _stream(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: rows to drop; 1: rows of the range's first hash; 2: its first and last hash, with their first documents."""
    last: tuple[int, int, int] | None = None  # hash and first document of the group that is open
    head: tuple[int, int, int] | None = None
    for b in it:
        if not b.num_rows:
            continue
        h1, h2, doc = (b.column(i).to_numpy() for i in range(3))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        if last is not None and (h1[0], h2[0]) == last[:2]:
            new[0] = False
        group = np.cumsum(new)
        firsts = np.concatenate([[last[2] if last else 0], doc[new]])
        first = firsts[group]
        if head is None:
            head = (int(h1[0]), int(h2[0]), int(doc[0]))
        in_head = (h1 == head[0]) & (h2 == head[1])
        last = (int(h1[-1]), int(h2[-1]), int(first[-1]))
        keep = in_head | (doc != first)
        kinds = pa.array(in_head[keep].astype(np.int32))
        yield pa.RecordBatch.from_arrays([kinds, *(c.filter(pa.array(keep)) for c in b.columns)], names=["kind", *b.schema.names])
    if head is not None:
        rows = [head, last]
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array([2, 2], pa.int32()), "h1": [r[0] for r in rows], "h2": [r[1] for r in rows], "doc_id": [r[2] for r in rows],
            "tk": [0, 0], "pos": pa.array([0, 0], pa.int32()), "n_lines": pa.array([0, 0], pa.int32())})


def _bitmap(n_lines: int, dropped: list[int]) -> bytes:
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def kept_lines(keep: bytes, n_lines: int) -> np.ndarray:
    """Which lines stay, from a compressed bitmap."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines, bitorder="little").astype(bool)


def _bitmaps(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it):
        n_lines, dropped = b.column(2).to_pylist(), b.column(3).to_pylist()
        yield pa.RecordBatch.from_pydict({
            "doc_id": b.column(0), "tk": b.column(1), "n_lines": pa.array(n_lines, pa.int64()),
            "n_dropped": pa.array(list(map(len, dropped)), pa.int64()),
            "keep": pa.array([_bitmap(n, d) for n, d in zip(n_lines, dropped)], pa.binary())})


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Compressed keep bitmaps of the documents that lose lines: doc_id, tk, n_lines, n_dropped, keep.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased; keys of at least
    ``min_chars`` code points lose all their lines except in the smallest id that holds them. ``tk`` tells
    rows that share an id apart: they are one document to the rule, and equal rows share a bitmap. Rows with
    a null id neither lose lines nor count as holders; null text is one empty line. Other columns are ignored.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("tk"), F.col(text_col).alias("text"))
    lines = rows.mapInArrow(_lines(min_chars), LINES)
    order = ("h1", "h2", "doc_id", "tk", "pos")
    streamed = cut(lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_stream, STREAMED), "lines")
    # two rows per range: the bound of this broadcast
    ends = streamed.where("kind = 2").groupBy("h1", "h2").agg(F.min("doc_id").alias("_first"))
    waiting = streamed.where("kind = 1").join(F.broadcast(ends), ["h1", "h2"]).where(F.col("doc_id") != F.col("_first"))
    drops = streamed.where("kind = 0").drop("kind").unionByName(waiting.drop("kind", "_first"))
    # one document's lines, which came from one row
    grouped = drops.groupBy("doc_id", "tk").agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("dropped"))
    return grouped.mapInArrow(_bitmaps, BITMAPS)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``_keep`` (null: every line stays) and ``_n_lines``; all rows and columns stay."""
    small = bitmaps.select(F.col("doc_id").alias("_b_id"), F.col("tk").alias("_b_tk"), F.col("keep").alias("_keep"), F.col("n_lines").alias("_n_lines"))
    return (docs.join(small, (docs[id_col].cast("long") == small["_b_id"]) & (text_key(text_col) == small["_b_tk"]), "left").drop("_b_id", "_b_tk"))


def _kept_text(text, keep, n_lines):
    """Text without the dropped lines."""
    if keep is None:
        return text
    return "\n".join(line for line, k in zip(text.split("\n"), kept_lines(keep, n_lines)) if k)


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``docs``; the text has lost its repeated lines."""
    # the other columns go as one, so that none of their names can clash with those used here
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       (F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("int")).alias("rest"))
    joined = with_bitmaps(rows, keep_bitmaps(rows, "id", "text", min_chars), "id", "text")
    kept = F.udf(_kept_text, "string", useArrow=True)(F.col("text"), F.col("_keep"), F.col("_n_lines"))
    given = {c: F.col("rest").getField(c) for c in rest} | {id_col: F.col("id"), text_col: kept}
    return joined.select(*[given[c].alias(c) for c in docs.columns])

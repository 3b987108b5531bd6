"""Binary token files: directly addressable codes with continuation bitmaps and rank directories.

A shard file holds the ids of a run of documents in ascending id order. Ids are cut into segments of
``SEGMENT`` tokens. In a segment, level 0 has the low byte of every id and a bitmap of the ids that go
on; level 1 has the next byte of those, with its own bitmap, and so on. A rank directory gives the number
of set bits before every ``RANK_BLOCK`` bits, so the place of an id on the next level is one directory
entry and a population count: any token is read without decoding its neighbours.

File: MAGIC, segments, document ids, document offsets, segment offsets, and a fixed-size tail.
Every file is written once under a name of its own by one task attempt and listed in the manifest, which
Spark commits with the task; files of lost attempts are never listed, so nothing reads them.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, slices
from .tokens import SLICE_BYTES, default_vocabulary, encoder

MAGIC = b"DACT0001"
SEGMENT = 1 << 18
RANK_BLOCK = 512
TAIL = struct.Struct("<QQQQQ")  # documents, tokens, place of ids, place of offsets, place of segments
NULL_ID = np.iinfo(np.int64).min

MANIFEST = "shard int, path string, n_docs long, n_tokens long"


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI as Spark writes it (``file:/x``, ``hdfs://``) or a local path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def encode_segment(ids: np.ndarray) -> bytes:
    """Levels of one segment: counts, then for each level its bytes, bitmap and rank directory."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])
        out.append(struct.pack("<I", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            return struct.pack("<I", len(out)) + b"".join(out)


class Segment:
    """Levels of one segment as views on its bytes."""

    def __init__(self, raw: bytes):
        (levels,), at = struct.unpack_from("<I", raw), 4
        self.levels = []
        for _ in range(levels):
            (n,), at = struct.unpack_from("<I", raw, at), at + 4
            low = np.frombuffer(raw, np.uint8, n, at)
            at += n
            bits = np.frombuffer(raw, np.uint8, -(-n // 8), at)
            at += len(bits)
            ranks = np.frombuffer(raw, "<u4", -(-n // RANK_BLOCK) + 1, at)
            at += ranks.nbytes
            self.levels.append((low, bits, ranks))

    def token(self, i: int) -> int:
        """Id at place ``i``: one step per level, no other id is decoded."""
        value, shift = 0, 0
        for low, bits, ranks in self.levels:
            value |= int(low[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BLOCK
            first = block * RANK_BLOCK >> 3
            before = int(np.bitwise_count(bits[first:i >> 3]).sum())
            before += int(bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
            i, shift = int(ranks[block]) + before, shift + 8
        return value

    def all(self) -> np.ndarray:
        out = None
        for low, bits, _ in reversed(self.levels):
            value = low.astype(np.uint32)
            if out is not None:
                value[np.unpackbits(bits, count=len(low), bitorder="little").astype(bool)] |= out << np.uint32(8)
            out = value
        return out


class ShardWriter:
    """Streams documents into one file; holds one segment and the document index."""

    def __init__(self, path: str):
        filesystem, plain = open_path(path)
        filesystem.create_dir(plain.rpartition("/")[0], recursive=True)
        self.out = filesystem.open_output_stream(plain)
        self.out.write(MAGIC)
        self.at, self.held, self.n_held = len(MAGIC), [], 0
        self.ids, self.starts, self.segments, self.tokens = [], [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(NULL_ID if doc_id is None else doc_id)
        self.starts.append(self.tokens)
        self.tokens += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= SEGMENT:
            held = np.concatenate(self.held)
            full = len(held) // SEGMENT * SEGMENT
            for i in range(0, full, SEGMENT):
                self._segment(held[i:i + SEGMENT])
            self.held, self.n_held = [held[full:]], len(held) - full

    def _segment(self, ids: np.ndarray) -> None:
        self.segments.append(self.at)
        raw = encode_segment(ids)
        self.out.write(raw)
        self.at += len(raw)

    def close(self) -> None:
        if self.n_held:
            self._segment(np.concatenate(self.held))
        places = []
        for values in (np.array(self.ids, "<i8"), np.array([*self.starts, self.tokens], "<u8"), np.array([*self.segments, self.at], "<u8")):
            places.append(self.at)
            self.out.write(values.tobytes())
            self.at += values.nbytes
        self.out.write(TAIL.pack(len(self.ids), self.tokens, *places))
        self.out.close()


class Shard:
    """Random access to the documents and tokens of one file."""

    def __init__(self, path: str):
        filesystem, plain = open_path(path)
        self.file = filesystem.open_input_file(plain)
        size = self.file.size()
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        self.n_docs, self.n_tokens, ids, starts, segments = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        self.doc_ids = np.frombuffer(self.file.read_at(starts - ids, ids), "<i8")
        self.starts = np.frombuffer(self.file.read_at(segments - starts, starts), "<u8").astype(np.int64)
        self.segments = np.frombuffer(self.file.read_at(size - TAIL.size - segments, segments), "<u8").astype(np.int64)
        self._last: tuple[int, Segment] | None = None

    def segment(self, k: int) -> Segment:
        if self._last is None or self._last[0] != k:
            self._last = (k, Segment(self.file.read_at(int(self.segments[k + 1] - self.segments[k]), int(self.segments[k]))))
        return self._last[1]

    def token(self, i: int) -> int:
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        return self.segment(i // SEGMENT).token(i % SEGMENT)

    def chunks(self, k: int) -> Iterator[np.ndarray]:
        """Ids of document ``k``, a segment's share at a time."""
        lo, hi = int(self.starts[k]), int(self.starts[k + 1])
        while lo < hi:
            s = lo // SEGMENT
            end = min(hi, (s + 1) * SEGMENT)
            if self._decoded is None or self._decoded[0] != s:
                self._decoded = (s, self.segment(s).all())
            yield self._decoded[1][lo - s * SEGMENT:end - s * SEGMENT]
            lo = end

    _decoded: tuple[int, np.ndarray] | None = None

    def document(self, k: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *self.chunks(k)])


def _writer(base: str, vocabulary: str, end_id: int) -> Callable:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, path, out = TaskContext.get().partitionId(), None, None
        encode, end = encoder(vocabulary).encode, np.array([end_id], "<u4")
        for b in slices(it, 1, SLICE_BYTES):
            ids, texts = b.column(0).to_pylist(), b.column(1)
            if out is None:
                path = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex}.dac"
                out = ShardWriter(path)
            for i, raw in zip(ids, encode(texts)):
                out.add(i, np.concatenate([np.frombuffer(raw, "<u4"), end]))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path],
                                              "n_docs": [len(out.ids)], "n_tokens": [out.tokens]})
    return run


def write_tokens(docs: DataFrame, base: str, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str | None = None, end_id: int = 0) -> DataFrame:
    """Encode every whole text, append ``end_id``, write shards under ``base`` in ascending id order.

    Returns the manifest (shard, path, n_docs, n_tokens, start), ``start`` being the number of ids in all
    shards before. Null texts count as empty; rows that share an id stay apart, in any order; a null id
    comes first. Other columns are ignored. An empty input writes no file and gives an empty manifest.
    One range exchange of the texts; the running total is over one row per shard.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id")
    written = cut(rows.mapInArrow(_writer(base, vocabulary or default_vocabulary(), end_id), MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def _reader(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            shard = Shard(path)
            for lo in range(0, shard.n_docs, 4096):
                hi = min(lo + 4096, shard.n_docs)
                sums = []
                for k in range(lo, hi):
                    crc = 0
                    for ids in shard.chunks(k):
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    sums.append(crc)
                ids = shard.doc_ids[lo:hi]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, mask=ids == NULL_ID), "start": shard.starts[lo:hi] + start,
                    "n_tokens": np.diff(shard.starts[lo:hi + 1]), "ids_crc32": pa.array(sums, pa.int64())})


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start over all shards, n_tokens, ids_crc32.

    Shards are read side by side: the manifest is small, so its rows are dealt by a count (one task for each shard, up
    to what runs at once), which Spark doesn't merge again as it does with small partitions dealt by a key alone."""
    n = max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    shards = manifest.select("path", "start")
    return shards.repartition(n).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")

"""Helpers shared by the corpus operators: table reads, staging, row keys, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


_holder: str | None = None
_caches: dict[str, Callable[[], None]] = {}


def hold_cache(name: str, empty: Callable[[], None]) -> None:
    """Called by a task that fills a cache kept in its Python worker: the caches that tasks of other operators
    left there are emptied first, so a worker holds one operator's cache at a time."""
    global _holder
    if _holder != name:
        for other, empty_other in _caches.items():
            if other != name:
                empty_other()
        pa.default_memory_pool().release_unused()
        _holder = name
    _caches[name] = empty


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return a frame that reads it.

    A lost executor re-reads the files instead of computing the lineage again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the folder of a frame made by ``cut`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: str = "text") -> Column:
    """Tells apart rows that repeat a document id with another text; null and empty text agree."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def batches(it: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Split incoming Arrow batches so that few texts are held as Python objects at a time."""
    for b in it:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def slices(it: Iterator[pa.RecordBatch], text: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes in the column ``text``; a row with more is a slice of its own."""
    for b in it:
        ends = np.cumsum(pc.binary_length(b.column(text)).fill_null(0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + size, "right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[start:start + size]`` of the picked numbers one after another, and where each run ends."""
    size = sizes[picks]
    ends = np.cumsum(size)
    kind = np.int32 if max(len(values), int(ends[-1]) if len(ends) else 0) < 2**31 else np.int64
    places = np.repeat((starts[picks] - (ends - size)).astype(kind), size)
    places += np.arange(len(places), dtype=kind)
    return values[places], ends


def found_at(words: pa.Array, known: pa.Array) -> np.ndarray:
    """Where each of the distinct ``words`` is in ``known``, -1 if nowhere. The known words are looked up among the
    words of a slice, not the other way round, so no table of all known words is built."""
    where = np.full(len(words), -1, np.int64)
    at = pc.index_in(known, value_set=words)
    met = at.is_valid().to_numpy(zero_copy_only=False)
    where[at.drop_null().to_numpy()] = np.flatnonzero(met)
    return where


# white space (and what Python takes for it) before a space: words can't be told from spaces alone
WHITE_BEFORE_SPACE = "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace()) + "] "


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: one row (node, component) per node of ``edges``.

    ``component`` is the smallest node of the component; nodes may be of any orderable type.
    Edges with a null end and loops are ignored; an empty edge table gives an empty result.
    Alternating large-star and small-star steps: each is a partial aggregate and an equi-join on
    the node (a hot centre is split by the skew join), and every round is written to the shared
    folder, so the plan stays short and nothing is collected but a count and a checksum.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = cut(e.select(hi.alias("hi"), lo.alias("lo")).distinct(), "cc")
    mark = _checksum(e)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(root, "hi").where(F.col("lo") != F.col("m"))
                 .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(root.select("hi", F.col("m").alias("lo"))).distinct())
        nxt = cut(small, "cc")
        now = _checksum(nxt)
        discard(e)
        e, before, mark = nxt, mark, now
        if now == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()))


def _checksum(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return (r["n"], r["x"])

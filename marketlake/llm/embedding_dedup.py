"""Embedding near-dedup: window collisions counted over sorted one-dimensional projections.

Unit vectors are projected on ``PROJECTIONS`` random directions. Two vectors at distance d differ on each by a
normal variable of deviation d, so a pair at the threshold is inside a query-centred window of half width
``WINDOW`` deviations with a known probability, and the number of windows it is inside is binomial. The count a
pair must reach is the largest one that a pair at the threshold misses with a probability of at most ``MISS``
(closer pairs miss it less often); pairs that reach it are verified by their cosine in double precision.

Equal vectors become one weighted class first. The classes are range-sorted by the first projection and cut
into tiles of ``TILE``; a tile meets the tiles its window reaches. A pair of tiles counts collisions as
arrays and returns link counts per class and a spanning forest of the links, never the links themselves, so
a group of thousands of near copies costs a tile pair's time and a few rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, components, cut

PROJECTIONS = 24
WINDOW = 2.0
SORT_WINDOW = 4.0
MISS = 1e-4
TILE = 4096
ROWS = 64
DENSE = 0.02


def directions(dim: int, count: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(dim).standard_normal((dim, count))


def needed(count: int = PROJECTIONS, window: float = WINDOW, miss: float = MISS) -> int:
    """Largest number of collisions that a pair at the threshold reaches with probability 1 - miss."""
    p, below = math.erf(window / math.sqrt(2)), 0.0
    for k in range(count + 1):
        below += math.comb(count, k) * p**k * (1 - p) ** (count - k)
        if below > miss:
            return k
    return count


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so nothing overflows or vanishes."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _classes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid vectors as double bytes, with a fingerprint and the place on the first projection."""
    for b in batches(it, 4096):
        prints, raws, firsts = [], [], []
        for v in b.column(1).to_pylist():
            x = np.array([0], float) if not v or any(c is None for c in v) else np.array(v, float) + 0.0
            if np.isfinite(x).all() and x.any():
                raws.append(x.tobytes())
                prints.append(xxhash.xxh3_128_digest(raws[-1]))
                firsts.append(float(unit(x[None])[0] @ directions(len(x), 1)[:, 0]))
            else:
                raws.append(None)
                prints.append(None)
                firsts.append(None)
        yield pa.RecordBatch.from_pydict({"vec_id": b.column(0), "fp": pa.array(prints, pa.binary()), "raw": pa.array(raws, pa.binary()), "p0": pa.array(firsts, pa.float64())})


def quantised(a: np.ndarray, b: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.uint16]:
    """Projections as 16-bit steps, those of ``b`` by projection and shifted, so that a pair is inside a window
    if and only if a - b, which wraps around, is at most the third result. Rounding widens windows only."""
    scale = 30_000 / max(np.abs(a).max(), np.abs(b).max())
    steps = math.ceil(width * scale) + 1
    low = np.rint(a * scale).astype(np.int16).view(np.uint16)
    high = np.ascontiguousarray(np.rint(b * scale).astype(np.int16).view(np.uint16).T) - np.uint16(steps)
    return low, high, np.uint16(2 * steps)


def tile_links(a: np.ndarray, b: np.ndarray | None, wa: np.ndarray, wb: np.ndarray | None, cosine: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Weighted link counts of the rows of ``a`` and then ``b``, and a spanning forest of their links.

    Rows come in the order of the sort projection. With ``b`` None the links within ``a``, else those between ``a`` and ``b``.
    """
    same = b is None
    both = a if same else np.concatenate([a, b])
    other, weight = (a, wa) if same else (b, wb)
    shift = 0 if same else len(a)
    project, first = directions(a.shape[1]), directions(a.shape[1], 1)[:, 0]
    qa, qb, window = quantised(a @ project, other @ project, WINDOW * math.sqrt(2 - 2 * cosine))
    # both sides are in the order of the sort projection, so the sort window is a range of rows
    sa, sb, reach, least = a @ first, other @ first, SORT_WINDOW * math.sqrt(2 - 2 * cosine), needed()
    counts, label, forest = np.zeros(len(both), np.int64), np.arange(len(both)), []
    for lo in range(0, len(a), ROWS):
        mine = a[lo:lo + ROWS]
        begin, end = np.searchsorted(sb, [sa[lo] - reach, sa[min(lo + ROWS, len(a)) - 1] + reach])
        hits = np.zeros((len(mine), end - begin), np.uint8)
        apart, inside = np.empty(hits.shape, np.uint16), np.empty(hits.shape, bool)
        for p in range(len(qb)):
            np.subtract(qa[lo:lo + ROWS, p, None], qb[p, begin:end], out=apart)
            np.less_equal(apart, window, out=inside)
            np.add(hits, inside.view(np.uint8), out=hits)
        passed = hits >= least
        if same:
            passed[np.arange(len(mine)), np.arange(lo, lo + len(mine)) - begin] = False
        if not passed.any():
            continue
        if passed.mean() > DENSE:
            passed &= mine @ other[begin:end].T >= cosine
        else:
            r, c = np.nonzero(passed)
            low = np.einsum("ij,ij->i", mine[r], other[begin + c]) < cosine
            passed[r[low], c[low]] = False
        counts[lo:lo + len(mine)] += passed @ weight[begin:end]
        if not same:
            counts[shift + begin:shift + end] += wa[lo:lo + len(mine)] @ passed
        for r in np.flatnonzero(passed.any(axis=1)):
            c = np.flatnonzero(passed[r]) + begin + shift
            c = c[label[c] != label[lo + r]]
            while len(c):
                forest.append((lo + int(r), int(c[0])))
                label[label == label[c[0]]] = label[lo + r]
                c = c[label[c] != label[lo + r]]
    return counts, forest


def _tile(cosine: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["side", "p0", "fp"])
        fp, side = part["fp"].tolist(), part["side"].to_numpy()
        vectors = unit(np.stack([np.frombuffer(x, float) for x in part["raw"]]))
        weight = part["weight"].to_numpy(np.int64)
        first = int((side == 0).sum())
        if part["x"].iloc[0] == part["y"].iloc[0]:
            counts, forest = tile_links(vectors, None, weight, None, cosine)
        else:
            counts, forest = tile_links(vectors[:first], vectors[first:], weight[:first], weight[first:], cosine)
        some = np.flatnonzero(counts)
        return pd.DataFrame({"a": [fp[i] for i in some] + [fp[i] for i, _ in forest], "b": [None] * len(some) + [fp[j] for _, j in forest],
                             "links": np.concatenate([counts[some], np.zeros(len(forest), np.int64)])}).astype({"a": object, "b": object})
    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", tile: int = TILE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Rows link when their cosine is at least ``cosine``; n_links counts the other rows linked directly,
    component_id is the smallest id reachable (the row's own included), kept tells whether that is its own.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and neither do
    vectors of different lengths. Every row is a vector: rows that repeat an id count each. A null id never
    names a component. Other columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    signed = cut(rows.mapInArrow(_classes, "vec_id long, fp binary, raw binary, p0 double"), "vectors")
    classes = signed.where("fp IS NOT NULL").groupBy("fp").agg(
        F.first("raw").alias("raw"), F.first("p0").alias("p0"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("least_id"))
    order = (F.octet_length("raw"), F.col("p0"), F.col("fp"))
    ranged = cut(classes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
                 .withColumn("dim", F.octet_length("raw")), "classes")
    part = F.shiftright("at", 33)
    start, before = [], 0  # one row per partition
    for r in ranged.groupBy(part.alias("p")).count().orderBy("p").collect():
        start.append((r["p"], before))
        before += r["count"]
    starts = F.broadcast(spark.createDataFrame(start, "p long, before long"))
    tiled = ranged.withColumn("p", part).join(starts, "p").withColumn("tile", F.floor((F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)) / tile))
    found = cut(_meet(tiled, SORT_WINDOW * math.sqrt(2 - 2 * cosine)).groupBy("x", "y", "dim").applyInPandas(_tile(cosine), "a binary, b binary, links long"), "links")

    links = found.where("b IS NULL").groupBy(F.col("a").alias("fp")).agg(F.sum("links").alias("links"))
    named = components(found.where("b IS NOT NULL")).withColumnRenamed("node", "fp").join(classes_of(ranged), "fp")
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(least, "component").select("fp", "component_id")
    whole = (ranged.select("fp", "weight", "least_id").join(links, "fp", "left").join(of_class, "fp", "left")
             .select("fp", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id")))
    joined = signed.select("vec_id", "fp").join(whole, "fp", "left")
    own = F.when(F.col("fp").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def classes_of(ranged: DataFrame) -> DataFrame:
    return ranged.select("fp", "least_id")


def _meet(tiled: DataFrame, reach: float) -> DataFrame:
    """Rows of every tile once for each tile its window reaches: (x, y, dim, side, fp, p0, raw, weight), x <= y."""
    spark = tiled.sparkSession
    # one row per tile and vector length
    spans = tiled.groupBy("dim", "tile").agg(F.min("p0").alias("low"), F.max("p0").alias("high")).orderBy("dim", "tile").collect()
    reached, lo = [], 0
    for i, s in enumerate(spans):
        while spans[lo]["dim"] != s["dim"] or spans[lo]["high"] < s["low"] - reach:
            lo += 1
        reached.append([s["dim"], s["tile"], spans[lo]["tile"], s["tile"]])
        for k in range(lo, i):
            reached[k][3] = s["tile"]
    table = F.broadcast(spark.createDataFrame([tuple(r) for r in reached], "dim int, tile long, first long, last long"))
    other = tiled.join(table, ["dim", "tile"]).withColumn("o", F.explode(F.sequence("first", "last")))
    return other.select(F.least("tile", "o").alias("x"), F.greatest("tile", "o").alias("y"), "dim", (F.col("tile") > F.col("o")).cast("int").alias("side"), "fp", "p0", "raw", "weight")

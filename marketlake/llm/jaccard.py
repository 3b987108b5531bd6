"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

1. A document's set is its distinct word n-grams as sorted 64-bit hashes. Documents with one set become one class.
2. Classes are brought together: ``ROWS`` minima of the set under fixed permutations make a key, with as many
   keys as leave a pair at the threshold apart with a probability of at most ``MISS``. Classes that share a key
   are joined in a star around the smallest one, never pair by pair, and the stars' components are the
   candidate groups: no linked pair is in two groups, and a class is in one group only.
3. A group is laid out in tiles by size band: sets that link differ in size by a factor of at most
   1/threshold, so a tile meets the tiles of its own band and of the next one. Bands with many classes are cut
   into tiles of at most about ``TILE``, so a group of any size is spread over many tasks.
4. In a pair of tiles, bitmaps bound the intersection from above (a bit set on one side only is an element
   the other lacks); what passes is decided by exact intersection of the sorted arrays. Classes that a tile
   already knows to be linked through others need no decision, since a tile returns a spanning forest.
5. Components of the forest give every document its class.
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

from .common import batches, components, cut, hold_cache, text_key

ROWS = 4
MISS = 1e-9
TILE = 1024
BITMAP_WORDS = 16
CACHE_ENTRIES = 400_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Words(dict):
    """Word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle, no word none.

    Words are runs of other characters than ASCII white space, with A-Z lower-cased.
    """
    words = text.encode().lower().split()  # bytes: ASCII white space and letters only
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    if len(h) < n:
        return _mix(np.array([xxhash.xxh64_intdigest(h.tobytes())], np.uint64))
    s = h[:len(h) - n + 1].copy()
    for i in range(1, n):
        s = _mix(s * _A + _B) + h[i:len(h) - n + 1 + i]
    return np.unique(_mix(s))


def n_keys(num: int, den: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Keys needed for a pair at the threshold to share one with probability 1 - miss."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-min((num / den) ** rows, 1 - 1e-12))))


def keys(s: np.ndarray, count: int, rows: int = ROWS) -> np.ndarray:
    rng = np.random.default_rng(20)
    a = rng.integers(0, 1 << 63, count * rows, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
    b = rng.integers(0, 1 << 63, count * rows, dtype=np.uint64)
    low = np.full(count * rows, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 1024):
        part = s[i:i + 1024, None] * a + b
        np.minimum(low, (part ^ part >> np.uint64(32)).min(axis=0), out=low)
    low = _mix(low).reshape(count, rows)
    key = np.arange(count, dtype=np.uint64)
    for i in range(rows):
        key = _mix(key * _A + low[:, i])
    return key.view(np.int64)


def _signatures(n: int, count: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_cache("jaccard", _words.clear)
        for b in batches(it, 256):
            sizes, prints, all_keys, ends = [], [], [], [0]
            for text in b.column(2).to_pylist():
                s = shingles(text or "", n)
                sizes.append(len(s))
                prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                if len(s):
                    all_keys.append(keys(s, count))
                ends.append(ends[-1] + (count if len(s) else 0))
            flat = np.concatenate([np.zeros(0, np.int64), *all_keys])
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column(0), "tk": b.column(1), "n": pa.array(sizes, pa.int64()), "fp": pa.array(prints, pa.binary()),
                "keys": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))})
    return run


def _sets(n: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_cache("jaccard", _words.clear)
        for b in batches(it, 256):
            yield pa.RecordBatch.from_pydict({
                "fp": b.column(0), "shingles": pa.array([shingles(t or "", n).tobytes() for t in b.column(1).to_pylist()], pa.binary())})
    return run


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), BITMAP_WORDS), np.uint64)
    for row, s in zip(out, sets):
        np.bitwise_or.at(row, (s >> np.uint64(6)) % np.uint64(BITMAP_WORDS), np.uint64(1) << (s & np.uint64(63)))
    return out


def links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within ``sets`` (side all 0) or between side 0 and side 1."""
    sizes = np.array([len(s) for s in sets])
    bits = bitmaps(sets)
    label = np.arange(len(sets))
    two = bool(side.any())
    out = []
    for i in range(len(sets)):
        if two and side[i]:
            continue
        others = np.flatnonzero((side == 1) if two else (np.arange(len(sets)) > i))
        need = num * (sizes[i] + sizes[others])  # link: (num + den) * intersection >= num * (sizes)
        others = others[(num + den) * np.minimum(sizes[i], sizes[others]) >= need]
        others = others[label[others] != label[i]]
        if not len(others):
            continue
        mine, theirs = bits[i], bits[others]
        bound = np.minimum(sizes[i] - np.bitwise_count(mine & ~theirs).sum(axis=1, dtype=np.int64),
                           sizes[others] - np.bitwise_count(theirs & ~mine).sum(axis=1, dtype=np.int64))
        others = others[(num + den) * bound >= num * (sizes[i] + sizes[others])]
        while len(others):
            j, others = int(others[0]), others[1:]
            common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if (num + den) * common >= num * (sizes[i] + sizes[j]):
                out.append((i, j))
                label[label == label[j]] = label[i]
                others = others[label[others] != label[i]]
    return out


def _tile(num: int, den: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["fp", "side"]).sort_values("fp")
        sets = [np.frombuffer(x, np.uint64) for x in part["shingles"]]
        fp = part["fp"].tolist()
        found = links(sets, part["side"].to_numpy(), num, den)
        return pd.DataFrame({"a": [fp[i] for i, _ in found], "b": [fp[j] for _, j in found]}, dtype=object)
    return run


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, tk, n_shingles, component_id, first_tk.

    Two documents link when den * intersection >= num * union of their n-word shingle sets. ``component_id``
    is the smallest id reachable by links, the row's own included. Texts without words (null too) have an empty
    set and link with nothing. Every row stands for itself: rows that repeat an id with another text may be in
    different components, and rows with a null id link like others but never name a component (it is null
    when no member has an id). ``first_tk`` is the least ``tk`` of the component's rows with that id, so it tells
    components of one id apart. Other columns are ignored; an empty table gives an empty result.
    """
    count = n_keys(num, den)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("tk"), F.col(text_col).alias("text"))
    signed = cut(rows.mapInArrow(_signatures(n, count), "doc_id long, tk long, n long, fp binary, keys array<long>"), "signatures")
    classes = (signed.where("fp IS NOT NULL").groupBy("fp")
               .agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "tk"))).alias("least"), F.min(F.struct("doc_id", "tk")).alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    classes = cut(classes, "classes")

    keyed = classes.select("fp", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("fp").alias("centre"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    star = keyed.join(shared, "key").where("fp <> centre").select(F.col("fp").alias("a"), F.col("centre").alias("b"))
    groups = components(star).withColumnRenamed("node", "fp").withColumnRenamed("component", "grp")
    members = cut(groups.join(classes.drop("keys"), "fp"), "members")

    tiles = cut(_tiles(members, num, den), "tiles")
    # merge joins at every size: their skewed partitions are split, and small tables run the plan of large ones
    wanted = members.select("fp", F.col("rep.doc_id").alias("r_id"), F.col("rep.tk").alias("r_tk")).hint("merge")
    source = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("tk") == F.col("r_tk"))).select("fp", "text")
    sets = source.mapInArrow(_sets(n), "fp binary, shingles binary")
    found = (sets.join(tiles.hint("merge"), "fp").select("grp", "x", "y", "side", "fp", "shingles")
             .groupBy("grp", "x", "y").applyInPandas(_tile(num, den), "a binary, b binary"))
    linked = components(found).withColumnRenamed("node", "fp")
    named = linked.join(classes.select("fp", "least"), "fp")
    least = named.groupBy("component").agg(F.min("least").alias("first"))
    of_class = named.join(least, "component").select("fp", "first")
    whole = classes.select("fp", "least").join(of_class, "fp", "left").select("fp", F.coalesce("first", "least").alias("first"))
    textless = F.col("fp").isNull()
    return (signed.drop("keys").join(whole, "fp", "left")
            .select("doc_id", "tk", F.col("n").alias("n_shingles"), F.when(textless, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
                    F.when(textless, F.col("tk")).otherwise(F.col("first.tk")).alias("first_tk")))


def _tiles(members: DataFrame, num: int, den: int) -> DataFrame:
    """Which pairs of tiles each class takes part in: (fp, grp, x, y, side).

    A group that fits in a tile is one tile. A larger one has a band for each factor of den/num in size
    (a little wider, for rounding), cut into tiles by hash; the tiles of a band meet each other and those of
    the next band.
    """
    width = math.log(den / num) * 1.0001
    sized = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)))
    total = members.groupBy("grp").agg(F.count(F.lit(1)).alias("g"))
    cells = sized.groupBy("grp", "band").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("s"))
    placed = sized.select("fp", "grp", "band").join(total, "grp")
    small = placed.where(F.col("g") <= TILE).select("fp", "grp", F.lit("").alias("x"), F.lit("").alias("y"), F.lit(0).alias("side"))
    big = placed.where(F.col("g") > TILE)

    def neighbour(step: int, name: str) -> DataFrame:
        return cells.select("grp", (F.col("band") + step).alias("band"), F.col("s").alias(name))

    big = (big.join(neighbour(0, "s"), ["grp", "band"]).join(neighbour(1, "below"), ["grp", "band"], "left")
           .join(neighbour(-1, "above"), ["grp", "band"], "left").withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("s"))))

    def label(band, sub):
        return F.concat_ws(":", band.cast("string"), sub.cast("string"))

    me = label(F.col("band"), F.col("sub"))
    upto = lambda k: F.sequence(F.lit(0).cast("long"), F.col(k) - 1)
    own = big.withColumn("o", F.explode(upto("s"))).select(
        "fp", "grp", label(F.col("band"), F.least("sub", "o")).alias("x"), label(F.col("band"), F.greatest("sub", "o")).alias("y"), (F.col("sub") > F.col("o")).cast("int").alias("side"))
    up = big.where("above IS NOT NULL").withColumn("o", F.explode(upto("above"))).select(
        "fp", "grp", me.alias("x"), label(F.col("band") + 1, F.col("o")).alias("y"), F.lit(0).alias("side"))
    down = big.where("below IS NOT NULL").withColumn("o", F.explode(upto("below"))).select(
        "fp", "grp", label(F.col("band") - 1, F.col("o")).alias("x"), me.alias("y"), F.lit(1).alias("side"))
    return small.unionByName(own).unionByName(up).unionByName(down)

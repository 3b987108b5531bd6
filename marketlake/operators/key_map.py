"""Persistent surrogate keys (M1, M3, J9): a business key keeps its number over any number of loads.

The map is append-only: one block of (business key, number) pairs per load. A load finds the business keys that no
block holds by an anti-join and numbers them above the largest number stored, dense, by the bucket offsets of
``surrogate_key``; nothing is sorted in one task and no stored number ever changes. A block is published by
a small file whose name holds its numbers (block, first and last key, load), so the next load needs no scan to
know where to begin. A load that died before that is repeated from the same beginning with the same keys and takes
the same numbers; a load that is published gives none when repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT
from ..sources.snapshots import _write_new, file_system
from .joins import KeyLookup
from .modeling import surrogate_key

BLOCK = "_block"


@dataclass(frozen=True)
class Block:
    number: int
    first: int
    last: int
    load: str

    @property
    def name(self) -> str:
        return f"{self.number:08d}.{self.first}.{self.last}.{self.load}"

    @classmethod
    def named(cls, name: str) -> "Block":
        number, first, last, load = name.split(".", 3)
        return cls(int(number), int(first), int(last), load)


class KeyMap:
    """The key map of one dimension in a folder of its own. One load at a time."""

    def __init__(self, spark: SparkSession, path: str, business: str, surrogate: str, business_type: str = "string"):
        self.spark, self.path, self.business, self.surrogate = spark, path.rstrip("/"), business, surrogate
        self.schema = T.StructType.fromDDL(f"`{business}` {business_type}, `{surrogate}` bigint, `{BLOCK}` int")

    def blocks(self) -> list[Block]:
        """Published blocks, from the names of small files: one for each load."""
        fs, p = file_system(self.spark, f"{self.path}/_blocks")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted((Block.named(n) for n in names if not n.endswith(".tmp")), key=lambda b: b.number)

    def pairs(self) -> DataFrame:
        """(business, surrogate) of all published blocks. A block that was left unpublished is not read."""
        known = self.blocks()
        if not known:
            return self.spark.createDataFrame([], self.schema).drop(BLOCK)
        stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/keys")
        return stored.where(F.col(BLOCK) <= known[-1].number).drop(BLOCK)

    def assign(self, keys: DataFrame, load: str) -> Block | None:
        """Number the business keys of ``keys`` that have no number yet; the new block, or None if there are none.

        NULL isn't a business key: it is what the Unknown member stands for. ``load`` is kept as the block's label.
        """
        known = self.blocks()
        begin = known[-1].last if known else 0
        number = known[-1].number + 1 if known else 1
        named = keys.select(F.col(self.business).cast(self.schema[self.business].dataType)).where(F.col(self.business).isNotNull()).distinct()
        new = named.join(self.pairs().select(self.business), self.business, "left_anti") if known else named
        target = f"{self.path}/keys/{BLOCK}={number}"
        numbered = surrogate_key(new, self.business, self.surrogate).withColumn(self.surrogate, F.col(self.surrogate) + F.lit(begin))
        numbered.write.mode("overwrite").parquet(target)
        n = self.spark.read.schema(T.StructType(self.schema.fields[:2])).parquet(target).count()  # from the footers
        if not n:
            fs, p = file_system(self.spark, target)
            fs.delete(p, True)
            return None
        block = Block(number, begin + 1, begin + n, load)
        _write_new(self.spark, f"{self.path}/_blocks/{block.name}", "")
        return block

    def keyed(self, dimension: DataFrame) -> DataFrame:
        """``dimension`` with its stored numbers; rows without a business key are left to the Unknown member."""
        return dimension.join(self.pairs(), self.business).select(self.surrogate, *dimension.columns)

    def lookup(self) -> KeyLookup:
        """Business -> surrogate for facts (J9); each business key is in one block only."""
        return KeyLookup.of(self.pairs(), self.business, self.surrogate, unique=True, source=self.pairs())


def key_map(spark: SparkSession, base: str, business: str, surrogate: str, s=DEFAULT) -> KeyMap:
    """The map of a dimension of a stored lake, beside its gold tables."""
    return KeyMap(spark, f"{base.rstrip('/')}/{s.gold}/_key_maps/{surrogate}", business, surrogate)

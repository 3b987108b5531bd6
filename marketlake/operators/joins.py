"""Join helpers: measured broadcast sides, surrogate-key lookups (J9), orphan detection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT

FIXED_BYTES = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.LongType: 8,
               T.DoubleType: 8, T.FloatType: 4, T.TimestampType: 8, T.TimestampNTZType: 8}
ROW_HEADER_BYTES = 8


def row_bytes(schema: T.StructType) -> Column:
    """Bytes of a row's values: fixed widths for numbers and dates, the true length of strings."""
    size = F.lit(ROW_HEADER_BYTES)
    for f in schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            size = size + (8 if f.dataType.precision <= 18 else 16)
        elif type(f.dataType) in FIXED_BYTES:
            size = size + FIXED_BYTES[type(f.dataType)]
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + 8 + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        else:
            raise TypeError(f"no size for {f.name}: {f.dataType.simpleString()}")
    return size


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT.broadcast_max_rows,
                   max_bytes: int = DEFAULT.broadcast_max_bytes) -> bool:
    """Whether a full count of rows and bytes stays within the bounds. One aggregate with partial
    sums per partition: only one row per partition is moved, however large ``df`` is."""
    m = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df.schema)).alias("bytes")).first()
    return m["rows"] <= max_rows and (m["bytes"] or 0) <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT.broadcast_max_rows,
                    max_bytes: int = DEFAULT.broadcast_max_bytes) -> DataFrame:
    """``broadcast(df)`` if its measured rows and bytes are within the bounds, else ``df`` as it is, for
    which Spark plans a shuffle join (AQE still splits skewed partitions). For stored or cheap sides,
    as measuring runs the frame once."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


@dataclass(frozen=True)
class KeyLookup:
    """Business key -> surrogate key of one dimension.

    It owns the names of both keys, whether business keys may repeat, and whether the pairs may be
    broadcast. Rows without a business key never match a fact, so they are left out. A repeated
    business key would multiply facts: unless ``unique`` says that the dimension has one row per key by
    construction, the lookup fails the job when it meets one.
    """

    dimension: DataFrame
    business: str
    surrogate: str
    unique: bool = False
    small: bool = False

    @classmethod
    def of(cls, dimension: DataFrame, business: str, surrogate: str, unique: bool = False,
           source: DataFrame | None = None) -> "KeyLookup":
        """``source`` is a cheap frame with at least the dimension's business keys (a stored table);
        its measured size decides on the broadcast. Without one, Spark decides at run time."""
        small = source is not None and fits_broadcast(source.select(F.col(business), F.lit(0).cast("long").alias("_key")))
        return cls(dimension, business, surrogate, unique, small)

    def pairs(self) -> DataFrame:
        named = self.dimension.where(F.col(self.business).isNotNull() & (F.col(self.surrogate) != DEFAULT.unknown_key))
        if self.unique:
            return named.select(F.col(self.business).alias("_business"), F.col(self.surrogate).alias("_surrogate"))
        message = F.concat(F.lit(f"duplicate business key in {self.business}: "), F.col("_business").cast("string"))
        one = named.groupBy(F.col(self.business).alias("_business")).agg(
            F.min(self.surrogate).alias("_surrogate"), F.count(F.lit(1)).alias("_rows"))
        kind = self.dimension.schema[self.surrogate].dataType
        return one.select("_business", F.when(F.col("_rows") == 1, F.col("_surrogate"))
                          .otherwise(F.raise_error(message).cast(kind)).alias("_surrogate"))

    def resolve(self, facts: DataFrame, missing: int = DEFAULT.unknown_key) -> DataFrame:
        """``facts`` with the surrogate key of their column ``business``; no match gives ``missing`` (M3)."""
        pairs = F.broadcast(self.pairs()) if self.small else self.pairs()
        joined = facts.join(pairs, facts[self.business] == pairs["_business"], "left")
        key = F.coalesce("_surrogate", F.lit(missing).cast(self.dimension.schema[self.surrogate].dataType))
        return joined.select(*[facts[c] for c in facts.columns], key.alias(self.surrogate))


def orphans(fact: DataFrame, dim: DataFrame, fact_fk_col: str, dim_pk_col: str,
            unknown_key=DEFAULT.unknown_key) -> DataFrame:
    """Fact rows whose FK is neither the unknown key nor present in the dimension.

    NULL FKs are not counted. No DISTINCT on the dimension: an anti join does not need it.
    """
    fk_type = fact.schema[fact_fk_col].dataType
    unknown = F.lit(str(unknown_key)) if isinstance(fk_type, T.StringType) else F.lit(unknown_key)
    f = fact.where(F.col(fact_fk_col) != unknown)
    d = dim.select(F.col(dim_pk_col).alias("_pk"))
    return f.join(d, f[fact_fk_col] == d["_pk"], "left_anti")

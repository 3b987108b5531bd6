"""Exact median per group from counts of values, without gathering a group in one task.

Values are decimals, taken as whole units of their own scale. Rows are counted per (group, value) once; the
counts serve every later step:

1. the value range of all groups is cut into ``BINS`` equal bins, and the counts are summed per group and
   bin; a running sum over at most ``BINS`` rows per group finds the bins of the two middle ranks;
2. the counts of those bins (at most two per group, broadcast when measured small) get a running sum, which
   gives the values at the middle ranks.

A group that holds a third of all rows is counted on every map task before the shuffle and spread by value.
The result equals ``percentile(value, 0.5)`` (linear interpolation between the middle values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .joins import sized_broadcast

BINS = 4096


def value_counts(df: DataFrame, group: str, value: str, *more) -> DataFrame:
    """Rows per (group, value): ``_n``, plus any further aggregates; staged, as it is read several times."""
    return stage(df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"), *more), "value-counts")


def exact_median(df: DataFrame, group: str, value: str, out: str = "mediana", bins: int = BINS) -> DataFrame:
    """Exact median of a decimal column per group; NULL is a group, NULL values are left out."""
    return median_of_counts(value_counts(df, group, value), group, value, out, bins)


def median_of_counts(counts: DataFrame, group: str, value: str, out: str = "mediana", bins: int = BINS) -> DataFrame:
    """The median from a frame made by ``value_counts``."""
    kind = counts.schema[value].dataType
    if not isinstance(kind, T.DecimalType) or kind.precision > 18:
        raise TypeError(f"exact_median needs a decimal of at most 18 digits, {value} is {kind.simpleString()}")
    units = (F.col(value).cast("decimal(38,18)") * 10 ** kind.scale).cast("long")
    v = counts.where(F.col(value).isNotNull()).select(F.col(group).alias("_g"), units.alias("_u"), "_n")
    span = v.agg(F.min("_u").alias("lo"), F.max("_u").alias("hi")).first()
    lo = span["lo"] or 0
    width = ((span["hi"] or 0) - lo) // bins + 1
    v = v.withColumn("_b", F.floor((F.col("_u") - F.lit(lo)) / F.lit(width)).cast("long"))

    running = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    b = v.groupBy("_g", "_b").agg(F.sum("_n").alias("_k"))
    b = b.select("_g", "_b", "_k", F.sum("_k").over(running).alias("_cum"), F.sum("_k").over(Window.partitionBy("_g")).alias("_total"))
    position = (F.col("_total") - 1) * 0.5
    low, high = F.floor(position).cast("long") + 1, F.ceil(position).cast("long") + 1
    start = F.col("_cum") - F.col("_k")
    held = b.where(((low > start) & (low <= F.col("_cum"))) | ((high > start) & (high <= F.col("_cum"))))
    held = stage(held.select(F.col("_g").alias("_sg"), F.col("_b").alias("_sb"), start.alias("_start"), low.alias("_lo"),
                             high.alias("_hi"), (position - F.floor(position)).alias("_frac")), "middle-bins")

    # NULL is a group of its own (as in GROUP BY), so the group key is matched null-safely
    held = sized_broadcast(held)
    j = v.join(held, v["_g"].eqNullSafe(held["_sg"]) & (v["_b"] == held["_sb"]))
    within = Window.partitionBy("_g", "_b").orderBy("_u").rowsBetween(Window.unboundedPreceding, 0)
    j = j.withColumn("_end", F.col("_start") + F.sum("_n").over(within))
    first = F.col("_end") - F.col("_n")

    def at(rank: str):
        return F.max(F.when((F.col(rank) > first) & (F.col(rank) <= F.col("_end")), F.col("_u")))

    res = j.groupBy("_g").agg(at("_lo").alias("_vlo"), at("_hi").alias("_vhi"), F.max("_frac").alias("_frac"))
    lo_v, hi_v = (F.col(c).cast("double") / 10 ** kind.scale for c in ("_vlo", "_vhi"))
    return res.select(F.col("_g").alias(group), (lo_v + (hi_v - lo_v) * F.col("_frac")).alias(out))

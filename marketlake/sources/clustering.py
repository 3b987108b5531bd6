"""Multi-column clustering of stored facts (S17, P12): rows in Morton order over several slicing columns.

A value of each column gets a code of ``bits`` bits that keeps the column's order and is balanced by rows: its place in
the running row count of the column's values. The Morton code interleaves the bits of all columns, as native
expressions; rows are range-partitioned by it into files, so a file holds a small box in all columns at once, and its
Parquet statistics let a filter on any of the columns skip most files. A cell that holds a large share of the rows is
split further by a hash of the row's key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import sized_broadcast
from ..session import remove_staged, stage
from .files import write_table

BITS = 8


def morton(codes: list[Column], bits: int = BITS) -> Column:
    """Interleave the low ``bits`` bits of integer codes; the first column has the highest bit of each group."""
    n = len(codes)
    if n * bits > 62:
        raise ValueError(f"{n} columns of {bits} bits don't fit a long")
    parts = [F.shiftleft(F.shiftright(c, b).bitwiseAND(F.lit(1)).cast("long"), b * n + n - 1 - j) for b in range(bits) for j, c in enumerate(codes)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def balanced_codes(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(value, code) of a column with a bounded number of values: code = rows before the value / all rows, in
    ``2 ** bits`` steps; NULL first. One row per value; the running sum is over that table."""
    counts = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(F.asc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_n").over(Window.partitionBy())
    return counts.select("_value", F.least(F.floor(before * (2 ** bits) / total), F.lit(2 ** bits - 1)).cast("int").alias("_code"))


def with_morton(df: DataFrame, columns: list[str], out: str, bits: int = BITS) -> DataFrame:
    """Add the Morton code over ``columns``."""
    coded = df
    for j, c in enumerate(columns):
        codes = sized_broadcast(balanced_codes(df, c, bits)).select(F.col("_value").alias(f"_value{j}"), F.col("_code").alias(f"_code{j}"))
        coded = coded.join(codes, F.col(f"`{c}`").eqNullSafe(codes[f"_value{j}"])).drop(f"_value{j}")
    return coded.withColumn(out, morton([F.col(f"_code{j}") for j in range(len(columns))], bits)).drop(*[f"_code{j}" for j in range(len(columns))])


def write_clustered(df: DataFrame, base: str, layer: str, name: str, columns: list[str], key: str, files: int, bits: int = BITS) -> str:
    """Store ``df`` in ``files`` files of about equal size in Morton order over ``columns``.

    The rows are computed once, into the shared folder: the counts of each column, the sample that finds the ranges
    and the write read them there."""
    rows = stage(df, "unordered")
    coded = with_morton(rows, columns, "_morton", bits).withColumn("_spread", F.xxhash64(key))
    ranged = coded.repartitionByRange(files, "_morton", "_spread").sortWithinPartitions("_morton", "_spread")
    path = write_table(ranged.drop("_morton", "_spread"), base, layer, name, register_table=False)
    remove_staged(rows)
    return path

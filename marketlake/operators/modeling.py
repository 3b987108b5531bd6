"""Dimensional-modelling operators: latest-per-key (W1/M5), surrogate keys (M1),
Unknown member (M2), calendar generator (M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, MONTHS_PT, WEEKDAYS_PT
from ..functions.exprs import date_key


def latest_per_key(df: DataFrame, key: str, order_col: str, cols: list[str]) -> DataFrame:
    """One row per ``key``: the row with the largest ``order_col`` (ties -> larger remaining fields).

    Same result as ROW_NUMBER() OVER (PARTITION BY key ORDER BY order_col DESC) = 1, but planned
    as an aggregate with map-side partial aggregation: a key holding a third of the rows is
    reduced on every map task before the shuffle, and no per-key sort is needed.
    """
    fields = [order_col] + [c for c in cols if c not in (key, order_col)]
    best = F.max(F.struct(*[F.col(c) for c in fields])).alias("_best")
    out = df.groupBy(key).agg(best)
    keep = [c for c in cols if c != key]
    return out.select(F.col(key), *[F.col("_best").getField(c).alias(c) for c in keep])


def surrogate_key(df: DataFrame, key: str, sk_col: str, hex_chars: int = DEFAULT.surrogate_bucket_hex) -> DataFrame:
    """Dense, deterministic integer keys 1..n (M1) without a single-partition sort.

    key order = (first ``hex_chars`` hex digits of md5(key), key). Each bucket is numbered
    in parallel with a window partitioned by bucket; the bucket's offset comes from a
    (16**hex_chars + 1)-row table of bucket counts (bounded by construction, so broadcast).
    Equal to ROW_NUMBER() OVER (ORDER BY coalesce(substr(md5(key), 1, hex_chars), ''), key).
    Every row gets a key: a NULL business key has a bucket of its own, which comes first.
    Business keys must be unique (check with ``check_no_duplicates``).
    """
    bucket = F.coalesce(F.substring(F.md5(F.col(key).cast("string")), 1, hex_chars), F.lit(""))
    b = df.withColumn("_bucket", bucket)
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # <= 16**hex_chars + 1 rows: a single-partition running sum over this table is bounded
    offsets = counts.select(
        "_bucket",
        (F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(F.col(key)))
    numbered = b.withColumn("_rn", within)
    out = numbered.join(F.broadcast(offsets), "_bucket").withColumn(
        sk_col, (F.col("_off") + F.col("_rn")).cast("long"))
    return out.drop("_bucket", "_rn", "_off")


def _unknown_value(dt: T.DataType, unknown_text: str):
    if isinstance(dt, T.StringType):
        return F.lit(unknown_text)
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.lit(-1)
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.lit(-1.0)
    return F.lit(None)


def unknown_member(schema_df: DataFrame, sk_col: str, unknown_key: int = DEFAULT.unknown_key,
                   unknown_text: str = DEFAULT.unknown_text) -> DataFrame:
    """The single Unknown row of a dimension (M2): key -1, strings 'Desconhecido',
    integers -1, floating -1.0, every other type NULL. Built in-plan from one generated row."""
    spark = schema_df.sparkSession
    cols = []
    for f in schema_df.schema.fields:
        v = F.lit(unknown_key) if f.name == sk_col else _unknown_value(f.dataType, unknown_text)
        cols.append(v.cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


def with_unknown_member(dim: DataFrame, sk_col: str, **kw) -> DataFrame:
    return dim.unionByName(unknown_member(dim, sk_col, **kw))


def calendar(start: Column, end: Column, fallback_start: str = DEFAULT.calendar_fallback_start,
             fallback_end: str = DEFAULT.calendar_fallback_end) -> Column:
    """Array of days start..end (M4); NULL bounds (no orders) fall back to the default range."""
    s = F.coalesce(start, F.to_date(F.lit(fallback_start)))
    e = F.coalesce(end, F.to_date(F.lit(fallback_end)))
    return F.sequence(s, e, F.expr("INTERVAL 1 DAY"))


def calendar_frame(bounds: DataFrame, start_col: str = "min_date", end_col: str = "max_date", **kw) -> DataFrame:
    """Explode a one-row bounds frame into one row per day (bounded by the date span)."""
    return bounds.select(F.explode(calendar(F.col(start_col), F.col(end_col), **kw)).alias("data"))


def calendar_columns(day: str = "data") -> list[Column]:
    d = F.col(day)
    return [
        date_key(d).alias("date_key"),
        d.alias("data_completa"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.quarter(d).alias("trimestre"),
        F.dayofweek(d).alias("dia_da_semana"),
        F.dayofweek(d).isin(1, 7).alias("is_fim_de_semana"),
        F.date_format(d, "MMMM").alias("nome_do_mes"),
    ]


def calendar_pt_columns(day: str = "data") -> list[Column]:
    """Documented calendar: Portuguese names and ISO week of year."""
    d = F.col(day)
    months = F.array(*[F.lit(m) for m in MONTHS_PT])
    weekdays = F.array(*[F.lit(w) for w in WEEKDAYS_PT])
    return [
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.quarter(d).alias("trimestre"),
        F.weekofyear(d).alias("semana_ano"),
        F.dayofweek(d).alias("dia_semana"),
        F.element_at(months, F.month(d)).alias("nome_mes_pt"),
        F.element_at(weekdays, F.dayofweek(d)).alias("nome_dia_semana_pt"),
        F.dayofweek(d).isin(1, 7).alias("eh_fim_de_semana"),
    ]

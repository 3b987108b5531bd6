"""Declarative data-quality checks (Q1-Q17).

A suite is a list of ``Check`` specs per table. All column checks of one table are
fused into ONE aggregate (one scan), producing a one-row metrics frame that is turned
into one result row per check with ``inline``. Key-uniqueness, FK integrity and
reconciliation need their own (distributed) aggregates. Everything is lazy; only the
log writer and the gate act. Result schema (hashable, no ids or clock):
layer, table_name, check_name, passed, record_count, detail.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT
from .joins import orphans

RESULT_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("record_count", T.LongType(), True),
    T.StructField("detail", T.StringType(), True),
])

LOG_SCHEMA = T.StructType([T.StructField("check_id", T.StringType(), False)] + RESULT_SCHEMA.fields[:] + [
    T.StructField("blocking", T.BooleanType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("checked_at", T.TimestampType(), False),
])


@dataclass(frozen=True)
class Check:
    kind: str                      # non_empty | not_null | null_rate | date_range | value_range | expected_count
    column: str | None = None
    lo: object = None
    hi: object = None
    max_rate: float | None = None
    blocking: bool = True
    name: str | None = None

    def label(self) -> str:
        if self.name:
            return self.name
        if self.kind == "non_empty":
            return "non_empty"
        if self.kind in ("date_range", "value_range"):
            return f"{self.kind}({self.column} in [{self.lo}, {self.hi}])"
        if self.kind == "expected_count":
            return f"expected_count({self.lo})"
        return f"{self.kind}({self.column})"


def _txt(c: Column) -> Column:
    return c.cast("string")


def _out_of_range(c: Column, lo, hi) -> Column:
    """x < lo OR x > hi; NULL passes, NaN fails (NaN sorts above every number)."""
    return (c < F.lit(lo)) | (c > F.lit(hi))


def _metrics(check: Check, i: int) -> list[Column]:
    c = F.col(check.column) if check.column else None
    if check.kind in ("not_null", "null_rate"):
        return [F.count_if(c.isNull()).alias(f"m{i}")]
    if check.kind in ("date_range", "value_range"):
        return [F.count_if(_out_of_range(c, check.lo, check.hi)).alias(f"m{i}"), F.count(c).alias(f"n{i}")]
    return []


def _row(check: Check, i: int, layer: str, table: str) -> Column:
    total = F.col("_total")
    if check.kind == "non_empty":
        passed, cnt, detail = total > 0, total, F.lit(None).cast("string")
    elif check.kind == "expected_count":
        passed, cnt = total == F.lit(int(check.lo)), total
        detail = F.concat(F.lit(f"expected={check.lo} actual="), _txt(total))
    elif check.kind == "not_null":
        m = F.col(f"m{i}")
        passed, cnt, detail = m == 0, total, F.concat(F.lit("nulls="), _txt(m))
    elif check.kind == "null_rate":
        m = F.col(f"m{i}")
        rate = F.when(total > 0, m.cast("double") / total.cast("double")).otherwise(F.lit(0.0))
        passed, cnt = rate <= F.lit(check.max_rate), total
        detail = F.concat(F.lit("nulls="), _txt(m), F.lit(" of="), _txt(total))
    elif check.kind == "date_range":
        m, n = F.col(f"m{i}"), F.col(f"n{i}")
        passed, cnt, detail = m == 0, n, F.concat(F.lit("out_of_range="), _txt(m))
    elif check.kind == "value_range":
        m = F.col(f"m{i}")
        passed, cnt, detail = m == 0, total, F.concat(F.lit("out_of_range="), _txt(m))
    else:
        raise ValueError(f"unknown check kind {check.kind}")
    return F.struct(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"),
        F.lit(check.label()).alias("check_name"), F.coalesce(passed, F.lit(False)).alias("passed"),
        cnt.cast("long").alias("record_count"), detail.alias("detail"),
        F.lit(check.blocking).alias("blocking"),
    )


def check_metrics(checks: list[Check]) -> list[Column]:
    """What the checks of a table count, as aggregates over its rows. They serve a scan (``table_checks``) and, as
    ``DataFrame.observe`` metrics, the job that writes the table."""
    return [F.count(F.lit(1)).alias("_total"), *[m for i, ch in enumerate(checks) for m in _metrics(ch, i)]]


def table_checks(df: DataFrame, layer: str, table: str, checks: list[Check], measured: dict | None = None) -> DataFrame:
    """All column checks of one table in one aggregate pass -> one row per check. ``measured`` holds the metrics if
    they were counted while the table was written; the table isn't read then."""
    if measured is None:
        one = df.agg(*check_metrics(checks))
    else:
        named = ["_total", *[f"{k}{i}" for i, ch in enumerate(checks) for k in ("m", "n") if f"{k}{i}" in measured]]
        one = df.sparkSession.createDataFrame([tuple(int(measured[c] or 0) for c in named)], ", ".join(f"{c} bigint" for c in named))
    rows = F.array(*[_row(ch, i, layer, table) for i, ch in enumerate(checks)])
    return one.select(F.inline(rows))


def _result(df_one_row: DataFrame, layer: str, table: str, name: str, passed: Column,
            count: Column, detail: Column, blocking: bool = True) -> DataFrame:
    return df_one_row.select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"), count.cast("long").alias("record_count"),
        detail.cast("string").alias("detail"), F.lit(blocking).alias("blocking"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row (total, duplicates = total - distinct keys). NULL is a key value.
    groupBy with map-side partial counts: a hot key is pre-reduced before the shuffle."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def check_no_duplicates(df: DataFrame, layer: str, table: str, keys: list[str], blocking=True) -> DataFrame:
    d = duplicates(df, keys)
    return _result(d, layer, table, f"no_duplicates({', '.join(keys)})", F.col("duplicates") == 0,
                   F.col("duplicates"), F.concat(F.lit("total="), _txt(F.col("total"))), blocking)


def check_fk_integrity(fact: DataFrame, dim: DataFrame, fk: str, pk: str, layer: str, table: str,
                       unknown_key=DEFAULT.unknown_key, blocking=True) -> DataFrame:
    """Orphan FKs (not unknown, not NULL, absent from the dimension)."""
    n = orphans(fact, dim, fk, pk, unknown_key).agg(F.count(F.lit(1)).alias("orphans"))
    return _result(n, layer, table, f"fk_integrity({fk} -> {pk})", F.col("orphans") == 0,
                   F.col("orphans"), F.concat(F.lit("orphans="), _txt(F.col("orphans"))), blocking)


def check_reconciliation(a: DataFrame, a_col: str, b: DataFrame, b_col: str, layer: str, table: str,
                         blocking=True) -> DataFrame:
    """Q12: round(sum(a), 2) = round(sum(b), 2), both not NULL.

    Both sums come from one aggregate over the union of the two projected columns
    (no join, no collect); the detail carries the difference in cents.
    """
    u = (a.select(F.col(a_col).cast("decimal(38,4)").alias("_a"), F.lit(None).cast("decimal(38,4)").alias("_b"))
         .unionByName(b.select(F.lit(None).cast("decimal(38,4)").alias("_a"), F.col(b_col).cast("decimal(38,4)").alias("_b"))))
    one = u.agg(F.round(F.sum("_a"), 2).alias("_ra"), F.round(F.sum("_b"), 2).alias("_rb"))
    ra, rb = F.col("_ra"), F.col("_rb")
    diff = ((ra - rb) * 100).cast("long")
    return _result(one, layer, table, f"reconciliation(sum({a_col}) = sum({b_col}))",
                   ra.isNotNull() & rb.isNotNull() & (ra == rb), F.lit(1),
                   F.concat(F.lit("difference_cents="), F.coalesce(_txt(diff), F.lit("null"))), blocking)


def check_unknown_present(dim: DataFrame, key: str, layer: str, table: str,
                          unknown_key=DEFAULT.unknown_key, blocking=True) -> DataFrame:
    """Q15: exactly one Unknown member."""
    n = dim.agg(F.count_if(F.col(key) == F.lit(unknown_key)).alias("_u"))
    return _result(n, layer, table, f"unknown_member({key})", F.col("_u") == 1, F.col("_u"),
                   F.concat(F.lit("unknown_rows="), _txt(F.col("_u"))), blocking)


def check_ratio(df: DataFrame, layer: str, table: str, name: str, num: Column, den: Column,
                max_rate: float | None = None, min_rate: float | None = None, blocking=True) -> DataFrame:
    """Q13/Q17: a share computed in one pass, compared to a bound."""
    one = df.agg(num.alias("_num"), den.alias("_den"))
    rate = F.when(F.col("_den") > 0, F.col("_num").cast("double") / F.col("_den").cast("double")).otherwise(F.lit(0.0))
    passed = F.lit(True)
    if max_rate is not None:
        passed = passed & (rate <= F.lit(max_rate))
    if min_rate is not None:
        passed = passed & ((F.col("_den") == 0) | (rate >= F.lit(min_rate)))
    return _result(one, layer, table, name, passed, F.col("_num"),
                   F.concat(F.lit("count="), _txt(F.col("_num")), F.lit(" of="), _txt(F.col("_den"))), blocking)


def union_results(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def results_view(checks: DataFrame) -> DataFrame:
    """Public result columns (without the blocking flag)."""
    return checks.select(*[f.name for f in RESULT_SCHEMA.fields])


def log_frame(checks: DataFrame, run_id: str) -> DataFrame:
    """Q8: log rows with a deterministic check id (sha2 of run, layer, table, check) and time."""
    cid = F.substring(F.sha2(F.concat_ws("|", F.lit(run_id), "layer", "table_name", "check_name"), 256), 1, 16)
    return checks.select(cid.alias("check_id"), *[f.name for f in RESULT_SCHEMA.fields], "blocking",
                         F.lit(run_id).alias("run_id"), F.current_timestamp().alias("checked_at"))


class QualityGateError(RuntimeError):
    pass


def enforce(rows: list) -> None:
    """Q7: raise after logging if any blocking check failed (rows = collected check results,
    bounded by the number of checks)."""
    failed = [r for r in rows if r["blocking"] and not r["passed"]]
    if failed:
        msg = "; ".join(f"{r['layer']}.{r['table_name']}: {r['check_name']} ({r['detail']})" for r in failed)
        raise QualityGateError(f"critical quality check failed: {msg}")

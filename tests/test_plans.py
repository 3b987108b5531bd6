"""Physical-plan properties of the registered queries."""

import pytest

import __spark_entry__ as entry
from marketlake.plans.registry import QUERIES as LIBRARY
from tests.conftest import SF_SMALL

QUERIES = {k: v for k, v in entry.queries().items() if k in LIBRARY}
# these store tables first and read them back
SKIP = {"csv_stream_ingest", "csv_ingest_rerun", "csv_reordered_columns", "csv_new_column", "csv_ingest_metadata",
        "append_added_column", "upsert_moved_partition", "partitioned_fact_month"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_python_udf_and_no_cartesian(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_are_pruned(spark):
    p = _plan(QUERIES["items_per_order"](spark, SF_SMALL))
    # only the lineitem columns used by the item view are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in p


def test_latest_per_person_is_an_aggregate_not_a_window(spark):
    p = _plan(QUERIES["dim_customers"](spark, SF_SMALL))
    assert "Window" not in p


@pytest.mark.parametrize("name", ["payments_per_order", "items_per_order", "dim_customers",
                                  "geolocation_aggregated", "kpi_sellers_monthly", "check_no_duplicates"])
def test_per_key_reductions_aggregate_before_the_shuffle(spark, name):
    """A key holding a large share of rows is pre-reduced on every map task (partial aggregate
    below the exchange), so no task receives the raw rows of a hot key."""
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "partial_" in p, p


@pytest.mark.parametrize("name", ["top_sellers_in_region", "upsert_latest"])
def test_top_k_per_group_is_limited_before_the_shuffle(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_month_grain_sides_are_broadcast(spark):
    p = _plan(QUERIES["kpi_marketplace_monthly"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_exact_median_has_no_single_group_window(spark):
    """The exact median does not use Spark's ``percentile`` aggregate, whose buffer holds every
    distinct value of a group in one task; it uses the two-pass histogram operator."""
    p = _plan(QUERIES["ticket_by_category"](spark, SF_SMALL))
    assert "percentile(" not in p


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-"))


def _unreduced_single_partition_inputs(plan: str) -> list[str]:
    """Scans that reach an ``Exchange SinglePartition`` without passing an aggregate or limit."""
    lines = plan.split("\n")
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        base = _indent(line)
        sub = []
        for nxt in lines[i + 1:]:
            if nxt.strip() and _indent(nxt) <= base:
                break
            sub.append(nxt)
        for j, s in enumerate(sub):
            if "Scan " not in s and "FileScan" not in s and "Range (" not in s:
                continue
            depth, reduced = _indent(s), False
            for up in reversed(sub[:j]):
                if _indent(up) < depth:
                    depth = _indent(up)
                    if any(k in up for k in ("Aggregate", "Limit", "TakeOrdered")):
                        reduced = True
                        break
            if not reduced:
                bad.append(s.strip()[:120])
    return bad


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_single_partition_exchanges_only_see_reduced_data(spark, name):
    """Every row reaching a single-partition exchange has passed an aggregate (bounded by its
    grouping domain, or one row per task) or a limit; raw rows never funnel into one task."""
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert _unreduced_single_partition_inputs(plan) == []


def test_single_partition_detector_flags_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(1000).withColumn("rn", F.row_number().over(Window.orderBy("id")))
    assert _unreduced_single_partition_inputs(_plan(bad))
    ok = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count() \
        .withColumn("rn", F.row_number().over(Window.orderBy("k")))
    assert _unreduced_single_partition_inputs(_plan(ok)) == []


def test_customers_are_not_joined_where_no_customer_column_is_used(spark):
    for name in ("on_time_overall", "cancel_rate_by_period", "revenue_growth", "delivery_histogram", "executive_cards", "kpi_sellers_monthly"):
        assert "customer.parquet" not in _plan(QUERIES[name](spark, SF_SMALL)), name


def test_seller_months_join_items_once_without_a_distinct(spark):
    import re
    p = _plan(QUERIES["kpi_sellers_monthly"](spark, SF_SMALL))
    # the items, and the item totals that tell which orders are priced; payments are not read at all
    assert len(re.findall(r"lineitem\.parquet", p)) == 2


def test_ticket_by_category_with_a_hot_category(spark):
    """A third of all items in one category: counts per price, no task gets the category's rows."""
    from pyspark.sql import functions as F
    from marketlake.operators.quantiles import exact_median
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("g"),
                                   ((F.col("id") * 7919 % 5000) / 100).cast("decimal(18,2)").alias("v"))
    got = {r.g: r.mediana for r in exact_median(df, "g", "v").collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - float(want[k])) < 1e-9 for k in want)

"""Co-bucketed storage: the joins on the order id run without a shuffle, in this session and in the next."""

import re

import pytest
from pyspark.sql import functions as F

from marketlake.plans import gold, silver
from marketlake.plans.lake import Lake
from marketlake.sources import buckets
from tests.conftest import SF_SMALL


@pytest.fixture()
def large_sides(spark):
    """Sides that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\((\w+)", df._jdf.queryExecution().executedPlan().toString())


def test_orders_items_and_payments_join_without_a_shuffle(spark, tmp_base, large_sides):
    lk = Lake.from_testdata(spark, SF_SMALL)
    stored = buckets.write_orders(lk.raw, tmp_base, "bucketed_a", 6)
    priced = silver.orders_priced(stored)
    assert "order_id" not in shuffles(priced)
    assert "order_id" in shuffles(silver.orders_priced(lk.raw))
    assert "SortMergeJoin" in priced._jdf.queryExecution().executedPlan().toString()
    columns = priced.columns
    assert sorted(map(repr, priced.collect())) == sorted(map(repr, silver.orders_priced(lk.raw).select(*columns).collect()))
    # the item join of the monthly sellers (J7) as well
    months = gold.priced_orders(priced).select("order_id", "date_key").join(stored["olist_order_items"].select("order_id", "seller_id"), "order_id")
    assert "order_id" not in shuffles(months)


def test_another_session_takes_the_tables_up(spark, tmp_base, large_sides):
    lk = Lake.from_testdata(spark, SF_SMALL)
    rows = buckets.write_orders(lk.raw, tmp_base, "bucketed_b", 4)["olist_orders"].count()
    for t in buckets.ORDER_TABLES:
        spark.sql(f"DROP TABLE bucketed_b.{t}")
    stored = {t: buckets.read_bucketed(spark, tmp_base, "bucketed_b", t) for t in buckets.ORDER_TABLES}
    assert stored["olist_orders"].count() == rows
    assert "order_id" not in shuffles(silver.orders_priced(stored))


def test_one_file_for_each_bucket_and_no_rows_without_order(spark, tmp_base):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("order_id"), "id")
    raw = {t: df for t in buckets.ORDER_TABLES}
    stored = buckets.write_orders(raw, tmp_base, "bucketed_c", 5)
    assert len(stored["olist_orders"].inputFiles()) == 5
    assert stored["olist_order_items"].count() == 900


def test_refresh_of_a_bucketed_table(spark, tmp_base):
    for n in (100, 50):
        t = buckets.write_bucketed(spark.range(n).select(F.col("id").cast("string").alias("order_id")), tmp_base, "bucketed_d", "t", "order_id", 3)
    assert t.count() == 50


def test_folder_without_specification(spark, tmp_base):
    with pytest.raises(FileNotFoundError):
        buckets.read_bucketed(spark, tmp_base, "bucketed_e", "missing")

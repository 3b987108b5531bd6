"""Golden numbers at sf0.01 from FIXTURES.md section 2 (measured there with independent SQL)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.plans.lake import Lake
from tests.conftest import SF_ORACLE


@pytest.fixture(scope="module")
def lk(spark):
    return Lake.from_testdata(spark, SF_ORACLE)


def test_raw_counts(lk):
    counts = {t: lk.raw[t].count() for t in ("olist_orders", "olist_customers", "olist_order_items",
                                             "olist_order_payments", "olist_order_reviews", "olist_geolocation")}
    assert counts == {"olist_orders": 15000, "olist_customers": 15000, "olist_order_items": 60000,
                      "olist_order_payments": 60000, "olist_order_reviews": 4933, "olist_geolocation": 10000}


def test_silver_counts(lk):
    oe = lk.orders_enriched
    assert lk.geolocation_aggregated.count() == 233
    assert oe.count() == 14845 and lk.quarantine.count() == 155
    r = oe.agg(F.count_if(F.col("entregue_no_prazo").isNull()).alias("null_flag"),
               F.count_if(F.col("entregue_no_prazo")).alias("on_time"),
               F.count_if(~F.col("entregue_no_prazo") & (F.col("dias_atraso") <= 0)).alias("late_same_day"),
               F.count_if(F.col("valor_total_pedido").isNull()).alias("null_total")).collect()[0]
    assert (r.null_flag, r.on_time, r.late_same_day, r.null_total) == (9967, 2588, 143, 270)


def test_gold_counts(lk):
    assert lk.fact_sales.count() == 14575
    assert lk.fact_reviews.count() == 4933
    assert lk.fact_order_items.count() == 60000
    assert lk.dim_customers.count() == 1500 and lk.dim_sellers.count() == 100 and lk.dim_products.count() == 2000
    assert lk.dim_customers.where(F.col("regiao_brasil").isNull()).count() == 801
    p = lk.dim_products
    assert p.where(F.col("product_category") == "unknown").count() == 40
    assert p.select("product_category").distinct().count() == 7
    assert lk.dim_calendar.count() == 2405
    assert lk.kpi_marketplace_monthly.count() == 80


def test_revenue_reconciles_to_the_published_total(lk):
    a = lk.fact_sales.agg(F.sum("valor_total_pedido")).collect()[0][0]
    b = lk.kpi_marketplace_monthly.agg(F.sum("receita_total")).collect()[0][0]
    assert a == b == Decimal("3116940782.45")


def test_per_order_aggregates_and_dropped_review_month(lk):
    from marketlake.operators.aggregates import items_per_order, payments_per_order
    from marketlake.plans import gold
    n_pay = payments_per_order(lk.raw["olist_order_payments"]).count()
    n_items = items_per_order(lk.raw["olist_order_items"]).count()
    assert n_pay == n_items == 14743
    assert lk.raw["olist_orders"].count() - n_items == 257  # orders without any item
    assert gold.kpi_reviews_monthly(lk.fact_reviews).count() == 81
    assert lk.kpi_marketplace_monthly.count() == 80  # the review-only month is dropped

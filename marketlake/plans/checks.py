"""Quality suites per layer (Q9-Q11 as coded, plus the documented Q13-Q17 checks)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.exprs import non_blank
from ..operators.quality import (Check, check_fk_integrity, check_no_duplicates, check_ratio,
                                 check_reconciliation, check_unknown_present, table_checks,
                                 union_results)
from .silver import ORDER_RULES_CODE, rejection_reason


Measured = Mapping[str, dict]


def column_checks(table: str, s=DEFAULT, expected_counts: Mapping[str, int] | None = None) -> list[Check]:
    """The checks of a table that count over its rows alone (Q1-Q3, Q5, Q16): those a write can measure."""
    checks = [Check("non_empty")]
    checks += {
        "olist_orders": [Check("not_null", "order_id"),
                         Check("date_range", "order_purchase_timestamp", s.data_min_date, s.data_max_date, blocking=False)],
        "olist_order_reviews": [Check("value_range", "review_score", s.review_score_min, s.review_score_max)],
        "geolocation_aggregated": [Check("not_null", "zip_code_prefix"), Check("value_range", "lat", s.lat_min, s.lat_max),
                                   Check("value_range", "lng", s.lng_min, s.lng_max)],
        "orders_enriched": [Check("not_null", "order_id"), Check("value_range", "valor_total_pedido", s.order_total_min, s.order_total_max)],
        "reviews_enriched": [Check("not_null", "review_id"), Check("value_range", "review_score", s.review_score_min, s.review_score_max)],
        "fact_sales": [Check("not_null", "date_key")],
        "fact_reviews": [Check("not_null", "date_key")],
    }.get(table, [])
    if table in (expected_counts or {}):
        checks.append(Check("expected_count", lo=expected_counts[table], blocking=False))
    return checks


def bronze_suite(raw: Mapping[str, DataFrame], s=DEFAULT, expected_counts: Mapping[str, int] | None = None, measured: Measured | None = None) -> DataFrame:
    """Q9: every raw table non-empty; orders: order_id not NULL, purchase date in the expected
    period (logged only); reviews: score in 1..5. Optional expected volumes (Q16, not blocking).
    Tables whose metrics are in ``measured`` are not read."""
    m = measured or {}
    return union_results([table_checks(raw[t], s.bronze, t, column_checks(t, s, expected_counts), m.get(t)) for t in s.bronze_tables])


def silver_suite(raw: Mapping[str, DataFrame], silver: Mapping[str, DataFrame], s=DEFAULT,
                 rules=ORDER_RULES_CODE, measured: Measured | None = None) -> DataFrame:
    """Q10 (coded) + Q13/Q17 (documented): geo, orders_enriched, reviews_enriched checks,
    quarantine rate under ``rules``, duplicate order ids, score range and sentiment coverage."""
    L, m = s.silver, measured or {}
    oe, rv = silver["orders_enriched"], silver["reviews_enriched"]
    frames = [
        *[table_checks(silver[t], L, t, column_checks(t, s), m.get(t)) for t in ("geolocation_aggregated", "orders_enriched", "reviews_enriched")],
        check_ratio(raw["olist_orders"], L, "quarantine", "quarantine_rate",
                    F.count_if(rejection_reason(rules).isNotNull()), F.count(F.lit(1)), max_rate=s.max_quarantine_rate),
        check_no_duplicates(oe, L, "orders_enriched", ["order_id"]),
        check_ratio(rv, L, "reviews_enriched", "sentiment_coverage",
                    F.count_if(non_blank("review_comment_message") & F.col("review_sentiment").isNotNull()),
                    F.count_if(non_blank("review_comment_message")), min_rate=s.sentiment_min_coverage),
    ]
    return union_results(frames)


KEYED_DIMS = {"dim_customers_keyed": "customer_key", "dim_products_keyed": "product_key", "dim_sellers_keyed": "seller_key"}
GOLD_TABLES = ["dim_customers", "dim_sellers", "dim_products", "dim_calendar", "fact_sales",
               "fact_order_items", "fact_reviews", "kpi_marketplace_monthly"]


def gold_suite(gold: Mapping[str, DataFrame], s=DEFAULT, measured: Measured | None = None) -> DataFrame:
    """Q11: gold tables non-empty, date keys not NULL in facts, revenue reconciliation.
    Documented Q14/Q15/Q6 checks run when keyed tables are present."""
    L, m = s.gold, measured or {}
    frames = [table_checks(gold[t], L, t, column_checks(t, s), m.get(t)) for t in GOLD_TABLES]
    frames.append(check_reconciliation(gold["fact_sales"], "valor_total_pedido",
                                       gold["kpi_marketplace_monthly"], "receita_total", L, "kpi_marketplace_monthly"))
    frames += _star_dims(gold, L)
    if "fact_sales_item" in gold:
        frames += _star_fact(gold, "fact_sales_item", L, calendar=True)
    return union_results(frames)


def _star_fact(gold: Mapping[str, DataFrame], fact: str, layer: str, calendar: bool) -> list[DataFrame]:
    """FKs of a keyed fact: each one is in its dimension (review dates may lie outside the calendar)."""
    frames = [check_fk_integrity(gold[fact], gold[t], key, key, layer, fact) for t, key in KEYED_DIMS.items() if t in gold]
    if calendar:
        frames.append(check_fk_integrity(gold[fact], gold["dim_calendar"], "date_key", "date_key", layer, fact))
    return frames


def star_suite(gold: Mapping[str, DataFrame], items: DataFrame, orders: DataFrame, s=DEFAULT) -> DataFrame:
    """The documented star: unique keys and one Unknown member per dimension, no NULL FK and no orphan in both
    keyed facts, and the items that no valid order claims (logged, not blocking)."""
    claimed = items.select("order_id").join(orders.select("order_id", F.lit(1).alias("_valid")), "order_id", "left")
    dropped = check_ratio(claimed, s.gold, "fact_sales_item", "items_without_order", F.count_if(F.col("_valid").isNull()),
                          F.count(F.lit(1)), blocking=False)
    keys = [Check("not_null", k) for k in KEYED_DIMS.values()]
    return union_results([
        *_star_dims(gold, s.gold),
        table_checks(gold["fact_sales_item"], s.gold, "fact_sales_item", [*keys, Check("not_null", "date_key")]),
        table_checks(gold["fact_reviews_keyed"], s.gold, "fact_reviews_keyed", keys),
        *_star_fact(gold, "fact_sales_item", s.gold, calendar=True),
        *_star_fact(gold, "fact_reviews_keyed", s.gold, calendar=False), dropped])


def _star_dims(gold: Mapping[str, DataFrame], layer: str) -> list[DataFrame]:
    return [frame for t, key in KEYED_DIMS.items() if t in gold for frame in
            (check_no_duplicates(gold[t], layer, t, [key]), check_unknown_present(gold[t], key, layer, t))]

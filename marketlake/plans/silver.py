"""Silver builders (B1-B4): pure functions of the raw datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import sentiment
from ..functions.exprs import sla_columns
from ..operators.aggregates import geo_centroids, items_per_order, payments_mode_per_order, payments_per_order

Raw = Mapping[str, DataFrame]

ORDER_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id", "order_status",
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "valor_total_pedido", "quantidade_itens", "forma_pagamento_principal", "max_parcelas",
    "dias_para_entrega", "dias_estimados", "entregue_no_prazo", "dias_atraso",
]

# Quarantine rules: (function building the condition that rejects a row, reason).
# Coded default: NULL order_id only.
ORDER_RULES_CODE = [(lambda: F.col("order_id").isNull(), "order_id nulo")]
# Documented variant: NULL order_id or NULL customer_id.
ORDER_RULES_DOC = ORDER_RULES_CODE + [(lambda: F.col("customer_id").isNull(), "customer_id nulo")]


def geolocation_aggregated(raw: Raw, s=DEFAULT) -> DataFrame:
    """B1: one row per zip prefix: centroid, state, region (outliers removed)."""
    return geo_centroids(raw["olist_geolocation"], s)


def rejection_reason(rules) -> Column:
    """First failing rule's reason, NULL when the row passes every rule."""
    return F.coalesce(*[F.when(cond(), F.lit(reason)) for cond, reason in rules])


def tag_rejections(df: DataFrame, rules=ORDER_RULES_CODE) -> DataFrame:
    return df.withColumn("motivo_rejeicao", rejection_reason(rules))


def payments_of_orders(raw: Raw, payment_rule: str) -> DataFrame:
    pay = payments_per_order(raw["olist_order_payments"])
    if payment_rule == "largest":
        return pay
    if payment_rule == "most_frequent":
        mode = payments_mode_per_order(raw["olist_order_payments"]).select(
            "order_id", F.col("forma_pagamento_frequente").alias("_mode"))
        return (pay.join(mode, "order_id")
                .select("order_id", F.col("_mode").alias("forma_pagamento_principal"), "max_parcelas"))
    raise ValueError(f"unknown payment_rule {payment_rule!r}")


def orders_priced(raw: Raw, rules=ORDER_RULES_CODE, payment_rule: str = "largest") -> DataFrame:
    """Valid orders with payment and item aggregates and SLA fields, without the customer join:
    the input of every query that uses no customer column.

    Both aggregates come out of their GROUP BY hash-partitioned on order_id, so joining them
    to the orders shares that partitioning.
    """
    orders = raw["olist_orders"].where(rejection_reason(rules).isNull())
    return (orders.join(payments_of_orders(raw, payment_rule), "order_id", "left")
            .join(items_per_order(raw["olist_order_items"]), "order_id", "left")
            .withColumns(sla_columns()))


def orders_enriched(raw: Raw, rules=ORDER_RULES_CODE, payment_rule: str = "largest") -> DataFrame:
    """B2: valid orders with customer person, payment and item aggregates and SLA fields.

    ``payment_rule``: "largest" (type of the largest payment, as coded) or "most_frequent"
    (the documented rule: the order's most frequent payment type).

    Customers are joined on customer_id last; outer joins are not reordered by Catalyst, so
    the joins on order_id keep their shared partitioning.
    """
    cust = raw["olist_customers"].select("customer_id", "customer_unique_id")
    return orders_priced(raw, rules, payment_rule).join(cust, "customer_id", "left").select(*ORDER_COLUMNS)


def orders_sla(raw: Raw, rules=ORDER_RULES_CODE) -> DataFrame:
    """Valid orders with their SLA fields only (no joins): the order-grain input for queries that
    need punctuality but no customer, payment or item context."""
    orders = raw["olist_orders"].where(rejection_reason(rules).isNull())
    return orders.withColumns(sla_columns())


def quarantine(raw: Raw, rules=ORDER_RULES_CODE) -> DataFrame:
    """Rejected orders with their reason (one tagged pass, complement of B2's filter)."""
    tagged = tag_rejections(raw["olist_orders"], rules)
    return tagged.where(F.col("motivo_rejeicao").isNotNull())


def quarantine_rate(raw: Raw, rules=ORDER_RULES_CODE) -> DataFrame:
    """Q13 metric: one fused pass over the orders."""
    reason = rejection_reason(rules)
    return raw["olist_orders"].agg(
        F.count(F.lit(1)).alias("total_pedidos"),
        F.count_if(reason.isNotNull()).alias("qtd_quarentena"),
    ).withColumn("taxa_quarentena",
                 F.when(F.col("total_pedidos") > 0,
                        F.col("qtd_quarentena").cast("double") / F.col("total_pedidos").cast("double"))
                  .otherwise(F.lit(0.0)))


REVIEW_COLUMNS = ["review_id", "order_id", "review_score", "review_comment_title",
                  "review_comment_message", "review_creation_date", "review_answer_timestamp"]


def reviews_enriched(raw: Raw, scorer=sentiment.lexicon_scorer) -> DataFrame:
    """Reviews with a sentiment label; blank or NULL comments -> sem_comentario."""
    r = raw["olist_order_reviews"].select(*REVIEW_COLUMNS)
    return scorer(r, "review_comment_message", "review_sentiment")

"""Per-key aggregates. All are hash/sort aggregates with partial (map-side) aggregation,
so a key holding a large share of the rows is pre-reduced on every map task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.exprs import region_of_state


def payments_per_order(payments: DataFrame) -> DataFrame:
    """A1: type of the largest payment and max instalments per order.

    Ties on value are broken by the larger type name, so the result is deterministic;
    payments with a NULL value never win (all-NULL -> NULL type).
    """
    v, t = F.col("payment_value"), F.col("payment_type")
    top = F.max(F.when(v.isNotNull(), F.struct(v.alias("v"), t.alias("t"))))
    return payments.groupBy("order_id").agg(
        top.getField("t").alias("forma_pagamento_principal"),
        F.max("payment_installments").alias("max_parcelas"),
    )


def payments_mode_per_order(payments: DataFrame) -> DataFrame:
    """Most frequent payment type per order; ties -> smallest type name."""
    return payments.groupBy("order_id").agg(
        F.mode("payment_type", deterministic=True).alias("forma_pagamento_frequente"),
        F.count("payment_type").alias("qtd_pagamentos"),
    )


def items_per_order(items: DataFrame) -> DataFrame:
    """A2: exact (decimal) order total and item count. A NULL freight drops that item from the sum only."""
    return items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("valor_total_pedido"),
        F.count("order_item_id").alias("quantidade_itens"),
    )


def geo_in_bounds(geo: DataFrame, s=DEFAULT) -> DataFrame:
    """Keep coordinates inside the inclusive bounding box; NULL coordinates drop out."""
    return geo.where(F.col("geolocation_lat").between(s.lat_min, s.lat_max)
                     & F.col("geolocation_lng").between(s.lng_min, s.lng_max))


def geo_centroids(geo: DataFrame, s=DEFAULT) -> DataFrame:
    """A3 + F15: centroid per zip prefix, its state (smallest of the zip's states) and region."""
    agg = geo_in_bounds(geo, s).groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.avg("geolocation_lat").alias("lat"),
        F.avg("geolocation_lng").alias("lng"),
        F.min("geolocation_state").alias("state"),
    )
    return agg.withColumn("regiao_brasil", region_of_state("state", s.unknown_text))

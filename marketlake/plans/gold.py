"""Gold builders (B5-B17): dimensions, facts, monthly KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.exprs import date_key, days_between, month_key, nps, safe_ratio
from ..operators.joins import KeyLookup, sized_broadcast
from ..operators.key_map import KeyMap
from ..operators.modeling import (calendar_columns, calendar_frame, calendar_pt_columns,
                                  latest_per_key, surrogate_key, with_unknown_member)
from ..session import stage

# ---------------- dimensions ----------------


def geo_lookup(geo: DataFrame, materialize: bool = True) -> DataFrame:
    """Zip -> region/centroid lookup, broadcast only if its measured size allows. Pass the result
    of this function as ``geo`` to the dimension builders to measure (and stage) it once:
    ``materialize`` stages the aggregate first, which has one row per zip prefix."""
    lookup = geo.select("zip_code_prefix", "regiao_brasil", "lat", "lng")
    return sized_broadcast(stage(lookup, "geo") if materialize else lookup)


def _geo(geo: DataFrame, materialize: bool) -> DataFrame:
    if "state" not in geo.columns:  # already a measured lookup
        return geo
    return geo_lookup(geo, materialize)


def customer_latest(customers: DataFrame) -> DataFrame:
    """One row per person: the record with the largest customer_id (W1 as an aggregate)."""
    return latest_per_key(customers, "customer_unique_id", "customer_id",
                          ["customer_city", "customer_state", "customer_zip_code_prefix"])


def dim_customers(customers: DataFrame, geo: DataFrame, geo_materialize: bool = True,
                  latest_done: bool = False) -> DataFrame:
    """One row per person (customer_unique_id), the record with the largest customer_id,
    with the region of its zip (NULL when the zip is unknown).

    The latest record is chosen first (aggregate with map-side pre-reduction), then the
    region lookup is joined; the lookup is many-to-one, so the order does not change rows.
    ``latest_done`` means ``customers`` already is ``customer_latest(...)``.
    """
    latest = customers if latest_done else customer_latest(customers)
    g = _geo(geo, geo_materialize)
    j = latest.join(g, latest.customer_zip_code_prefix == g.zip_code_prefix, "left")
    return j.select("customer_unique_id", "customer_city", "customer_state",
                    "customer_zip_code_prefix", "regiao_brasil")


def dim_sellers(sellers: DataFrame, geo: DataFrame, geo_materialize: bool = True) -> DataFrame:
    """Sellers with the region of their zip."""
    g = _geo(geo, geo_materialize)
    j = sellers.join(g, sellers.seller_zip_code_prefix == g.zip_code_prefix, "left")
    return j.select("seller_id", "seller_city", "seller_state", "seller_zip_code_prefix", "regiao_brasil")


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with the translated category (else the original, else 'unknown')."""
    t = sized_broadcast(categories.select(
        F.col("product_category_name").alias("_cat"), "product_category_name_english"))
    j = products.join(t, products.product_category_name == t["_cat"], "left")
    return j.select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name", F.lit("unknown")).alias("product_category"),
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )


def order_date_bounds(orders_enriched: DataFrame) -> DataFrame:
    """A4: one-row global min/max purchase date (partial aggregates, no collect)."""
    d = F.to_date("order_purchase_timestamp")
    return orders_enriched.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))


def dim_calendar(orders_enriched: DataFrame, s=DEFAULT) -> DataFrame:
    """One row per day between the first and last purchase date (fallback range when empty)."""
    days = calendar_frame(order_date_bounds(orders_enriched),
                          fallback_start=s.calendar_fallback_start, fallback_end=s.calendar_fallback_end)
    return days.select(*calendar_columns())


def dim_time_pt(bounds: DataFrame) -> DataFrame:
    """Documented calendar with Portuguese names and week of year over the bounds' span."""
    return calendar_frame(bounds).select(*calendar_pt_columns())


def documented_bounds(spark: SparkSession, s=DEFAULT) -> DataFrame:
    """One-row bounds of the documented period."""
    return spark.range(1).select(F.to_date(F.lit(s.data_min_date)).alias("min_date"), F.to_date(F.lit(s.data_max_date)).alias("max_date"))


def dim_time_documented(orders: DataFrame, s=DEFAULT) -> DataFrame:
    """B17 over the documented period (1,096 days), with the number of orders bought on each day."""
    days = dim_time_pt(documented_bounds(orders.sparkSession, s))
    bought = orders.groupBy(date_key("order_purchase_timestamp").alias("date_key")).agg(F.count(F.lit(1)).alias("qtd_pedidos"))
    return days.join(bought, "date_key", "left").fillna(0, subset=["qtd_pedidos"])


# ---------------- facts ----------------

PRICED_ORDER_COLUMNS = ["order_id", "date_key", "valor_total_pedido", "order_status", "dias_para_entrega",
                        "dias_estimados", "dias_atraso", "entregue_no_prazo", "max_parcelas"]

FACT_SALES_COLUMNS = ["order_id", "customer_unique_id", "date_key", "valor_total_pedido",
                      "forma_pagamento_principal", "max_parcelas", "quantidade_itens",
                      "dias_para_entrega", "dias_estimados", "dias_atraso", "entregue_no_prazo",
                      "order_status"]


def fact_sales(orders_enriched: DataFrame) -> DataFrame:
    """One row per priced order (P4), keyed by purchase date."""
    return (orders_enriched.where(F.col("valor_total_pedido").isNotNull())
            .withColumn("date_key", date_key("order_purchase_timestamp"))
            .select(*FACT_SALES_COLUMNS))


def priced_orders(orders: DataFrame) -> DataFrame:
    """The columns of ``fact_sales`` that need no customer, from orders with payments and items only."""
    return (orders.where(F.col("valor_total_pedido").isNotNull())
            .withColumn("date_key", date_key("order_purchase_timestamp"))
            .select(*PRICED_ORDER_COLUMNS))


def fact_reviews(reviews_enriched: DataFrame) -> DataFrame:
    """One row per review, keyed by review creation date."""
    return reviews_enriched.select(
        "review_id", "order_id", date_key("review_creation_date").alias("date_key"),
        "review_score", "review_sentiment")


def fact_order_items(items: DataFrame) -> DataFrame:
    """One row per order item; total = price + freight (NULL-propagating)."""
    return items.select(
        "order_id", "order_item_id", "product_id", "seller_id",
        F.col("price").alias("preco_produto"),
        F.col("freight_value").alias("valor_frete"),
        (F.col("price") + F.col("freight_value")).alias("valor_total_item"),
    )


# ---------------- monthly KPIs ----------------

def _distinct(c: str, approx: bool):
    """Exact distinct count, or the HyperLogLog++ sketch (bounded memory, ~1% error) at scale."""
    return F.approx_count_distinct(c, 0.01) if approx else F.count_distinct(c)


def kpi_sales_monthly(fact_sales_df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Revenue, ticket, orders, distinct customers, cancel and on-time rates, mean delivery days."""
    n = F.count("order_id")
    return fact_sales_df.groupBy(month_key("date_key").alias("ano_mes")).agg(
        F.sum("valor_total_pedido").alias("receita_total"),
        safe_ratio(F.sum("valor_total_pedido"), n).alias("ticket_medio"),
        n.alias("qtd_pedidos"),
        _distinct("customer_unique_id", approx_distinct).alias("qtd_clientes_unicos"),
        safe_ratio(F.count_if(F.col("order_status") == "canceled"), n).alias("taxa_cancelamento"),
        safe_ratio(F.count_if(F.col("entregue_no_prazo")),
                   F.count_if(F.col("entregue_no_prazo").isNotNull())).alias("taxa_entrega_no_prazo"),
        F.avg("dias_para_entrega").alias("prazo_medio_entrega_dias"),
    )


def kpi_sellers_monthly(fact_sales_df: DataFrame, items: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Distinct active sellers per month (J7): one join on the order, then a distinct count, whose
    partial aggregate already reduces repeated sellers of a month before they are shuffled.
    Only the order and its date are used of ``fact_sales_df``; any priced order-grain frame will do."""
    months = fact_sales_df.select("order_id", month_key("date_key").alias("ano_mes"))
    return (months.join(items.select("order_id", "seller_id"), "order_id")
            .groupBy("ano_mes").agg(_distinct("seller_id", approx_distinct).alias("qtd_sellers_ativos")))


def kpi_reviews_monthly(fact_reviews_df: DataFrame) -> DataFrame:
    """Mean score and NPS per review month."""
    return fact_reviews_df.groupBy(month_key("date_key").alias("ano_mes")).agg(
        nps("review_score", "review_id").alias("nps_score"),
        F.avg("review_score").alias("nota_media_reviews"),
    )


KPI_COLUMNS = ["ano_mes", "receita_total", "ticket_medio", "qtd_pedidos", "qtd_clientes_unicos",
               "qtd_sellers_ativos", "taxa_cancelamento", "taxa_entrega_no_prazo",
               "prazo_medio_entrega_dias", "nps_score", "nota_media_reviews"]


def kpi_marketplace_monthly(fact_sales_df: DataFrame, fact_reviews_df: DataFrame, items: DataFrame,
                            approx_distinct: bool = False, priced_orders_df: DataFrame | None = None) -> DataFrame:
    """Sales months, left-joined with seller and review months.

    All three sides are month-grain aggregates (at most 12 rows per calendar year); Spark measures
    them at run time and broadcasts. Review months without sales are dropped (as coded).
    ``priced_orders_df`` (orders and dates without the customer join) serves the seller months.
    """
    sm = kpi_sales_monthly(fact_sales_df, approx_distinct)
    se = kpi_sellers_monthly(fact_sales_df if priced_orders_df is None else priced_orders_df, items, approx_distinct)
    rm = kpi_reviews_monthly(fact_reviews_df)
    return sm.join(se, "ano_mes", "left").join(rm, "ano_mes", "left").select(*KPI_COLUMNS)


# ---------------- documented (DOC) builders ----------------

def reviews_context(reviews_enriched_df: DataFrame, orders_sla: DataFrame, items: DataFrame,
                    products: DataFrame, sellers: DataFrame, categories: DataFrame) -> DataFrame:
    """Review with its order's SLA, first item's product/seller/category context.

    ``orders_sla`` is any order-grain frame with the SLA fields (valid orders); one item per
    order (lowest item id, then product, seller) keeps the review grain.
    """
    first_item = latest_per_key(
        items.select("order_id", (-F.col("order_item_id")).alias("_neg_item"), "product_id", "seller_id"),
        "order_id", "_neg_item", ["product_id", "seller_id"])
    o = orders_sla.select("order_id", "order_delivered_customer_date",
                          F.col("entregue_no_prazo").alias("entregue_antes_prazo"))
    cat = sized_broadcast(categories.select(F.col("product_category_name").alias("_cat"),
                                            F.col("product_category_name_english").alias("category_name_en")))
    p = products.select("product_id", F.col("product_category_name").alias("category_name_pt"))
    p = p.join(cat, p.category_name_pt == cat["_cat"], "left").drop("_cat")
    sl = sellers.select("seller_id", "seller_state")
    r = (reviews_enriched_df.join(o, "order_id", "left")
         .join(first_item, "order_id", "left")
         .join(p, "product_id", "left")
         .join(sl, "seller_id", "left"))
    return r.select(
        "review_id", "order_id", date_key("review_creation_date").alias("date_key"),
        "review_score", "review_sentiment",
        days_between("review_creation_date", "order_delivered_customer_date").alias("tempo_ate_avaliacao"),
        "entregue_antes_prazo", "product_id", "seller_id", "seller_state",
        "category_name_pt", "category_name_en",
    )


def _numbered(d: DataFrame, business: str, surrogate: str, keys: KeyMap | None, s) -> DataFrame:
    """Rows with their stored numbers, or numbered anew for this frame alone."""
    if keys is not None:
        return keys.keyed(d)
    return surrogate_key(d, business, surrogate, s.surrogate_bucket_hex).select(surrogate, *d.columns)


def dim_customers_keyed(dim_customers_df: DataFrame, geo: DataFrame, s=DEFAULT, keys: KeyMap | None = None) -> DataFrame:
    """Customer dimension with surrogate key, centroid and the Unknown member. ``keys`` holds the numbers of
    earlier loads (those of this load must have been assigned); without it, rows are numbered anew."""
    g = _geo(geo, False).select("zip_code_prefix", "lat", "lng")
    d = dim_customers_df.join(g, dim_customers_df.customer_zip_code_prefix == g.zip_code_prefix, "left")
    d = d.select(F.col("customer_unique_id"), F.col("customer_city").alias("cidade"),
                 F.col("customer_state").alias("estado"), "regiao_brasil", "lat", "lng")
    return with_unknown_member(_numbered(d, "customer_unique_id", "customer_key", keys, s), "customer_key")


def dim_sellers_keyed(dim_sellers_df: DataFrame, geo: DataFrame, s=DEFAULT, keys: KeyMap | None = None) -> DataFrame:
    g = _geo(geo, False).select("zip_code_prefix", "lat", "lng")
    d = dim_sellers_df.join(g, dim_sellers_df.seller_zip_code_prefix == g.zip_code_prefix, "left")
    d = d.select("seller_id", F.col("seller_city").alias("cidade"), F.col("seller_state").alias("estado"),
                 "regiao_brasil", "lat", "lng")
    return with_unknown_member(_numbered(d, "seller_id", "seller_key", keys, s), "seller_key")


def dim_products_keyed(products: DataFrame, categories: DataFrame, s=DEFAULT, keys: KeyMap | None = None) -> DataFrame:
    """Product key, PT and EN category, weight, volume_cm3."""
    t = sized_broadcast(categories.select(F.col("product_category_name").alias("_cat"),
                                          F.col("product_category_name_english").alias("category_en")))
    j = products.join(t, products.product_category_name == t["_cat"], "left")
    d = j.select(
        "product_id",
        F.coalesce("product_category_name", F.lit("unknown")).alias("category_pt"),
        F.coalesce("category_en", "product_category_name", F.lit("unknown")).alias("category_en"),
        F.col("product_weight_g").alias("peso_g"),
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")).alias("volume_cm3"),
    )
    return with_unknown_member(_numbered(d, "product_id", "product_key", keys, s), "product_key")


FACT_SALES_ITEM_COLUMNS = [
    "order_id", "order_item_id", "customer_key", "product_key", "seller_key", "date_key",
    "preco_produto", "valor_frete", "valor_total_item", "quantidade", "order_status",
    "payment_type", "max_parcelas", "dias_para_entrega", "dias_estimados", "entregue_no_prazo",
    "dias_atraso", "ano", "mes",
]


def star_lookups(dim_c: DataFrame, dim_p: DataFrame, dim_s: DataFrame, sources: dict | None = None) -> dict[str, KeyLookup]:
    """Lookups of the three keyed dimensions. ``sources`` names stored tables with their business keys (the
    raw datasets or the stored dimensions), whose size decides on broadcasting. The customer dimension has
    one row per person by construction; sellers and products come from raw rows, so repeats are refused."""
    src = sources or {}
    return {"customer": KeyLookup.of(dim_c, "customer_unique_id", "customer_key", unique=True, source=src.get("customer")),
            "product": KeyLookup.of(dim_p, "product_id", "product_key", source=src.get("product")),
            "seller": KeyLookup.of(dim_s, "seller_id", "seller_key", source=src.get("seller"))}


def fact_sales_item(items: DataFrame, orders_enriched_df: DataFrame, dim_c: DataFrame,
                    dim_p: DataFrame, dim_s: DataFrame, sources: dict | None = None) -> DataFrame:
    """Item-grain sales fact with -1 FKs for misses, partition columns ano/mes.

    The customer key is resolved at order grain (fewer rows to move than items) before the
    items are joined; product and seller keys are resolved at item grain. Items without a valid order
    have no place in the fact; ``items_without_order`` counts them.
    """
    look = star_lookups(dim_c, dim_p, dim_s, sources)
    o = look["customer"].resolve(orders_enriched_df.select(
        "order_id", "customer_unique_id", "order_status",
        F.col("forma_pagamento_principal").alias("payment_type"), "max_parcelas",
        "dias_para_entrega", "dias_estimados", "entregue_no_prazo", "dias_atraso",
        date_key("order_purchase_timestamp").alias("date_key"),
        F.year("order_purchase_timestamp").alias("ano"), F.month("order_purchase_timestamp").alias("mes")))
    f = look["seller"].resolve(look["product"].resolve(items.join(o, "order_id", "inner")))
    measures = {
        "preco_produto": F.col("price"),
        "valor_frete": F.col("freight_value"),
        "valor_total_item": F.col("price") + F.col("freight_value"),
        "quantidade": F.lit(1),
    }
    return f.select(*[measures[c].alias(c) if c in measures else F.col(c) for c in FACT_SALES_ITEM_COLUMNS])


def items_without_order(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items that ``fact_sales_item`` leaves out: their order id is NULL or no valid order has it."""
    return items.join(orders.select("order_id"), "order_id", "left_anti")


def fact_reviews_keyed(reviews_ctx: DataFrame, orders_enriched_df: DataFrame, dim_c: DataFrame,
                       dim_p: DataFrame, dim_s: DataFrame, sources: dict | None = None) -> DataFrame:
    """Review fact with customer/product/seller keys (-1 for misses), under the documented names."""
    look = star_lookups(dim_c, dim_p, dim_s, sources)
    r = reviews_ctx.join(orders_enriched_df.select("order_id", "customer_unique_id"), "order_id", "left")
    for name in ("customer", "product", "seller"):
        r = look[name].resolve(r)
    return r.select(
        "review_id", "customer_key", "seller_key", "product_key", "date_key", "review_score",
        F.col("tempo_ate_avaliacao").alias("tempo_ate_avaliacao_dias"), F.col("review_sentiment").alias("sentimento"),
        "entregue_antes_prazo", F.col("category_name_en").alias("category_en"),
    )

"""Documented business queries over the gold layer.

All are aggregates over facts joined to dimensions. Small results (state-, month-,
category-grain) are combined with windows over the already-aggregated rows; top-k
uses ORDER BY + LIMIT (distributed TakeOrderedAndProject) or, per group, a
row_number filter that Spark plans as a partial + final WindowGroupLimit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import month_key, nps, safe_ratio, sla_light
from ..operators.joins import sized_broadcast
from ..operators.quantiles import median_of_counts, value_counts
from .lake import Lake


def _share(count_col: str) -> F.Column:
    """count / total over an aggregated (small) frame."""
    return F.col(count_col).cast("double") / F.sum(count_col).over(Window.partitionBy()).cast("double")


def _customer_state(lk: Lake) -> DataFrame:
    """Person -> state (same rows as dim_customers; the region lookup is not needed here)."""
    return lk.customer_latest.select("customer_unique_id", "customer_state")


# N1
def delivery_by_state(lk: Lake) -> DataFrame:
    f = lk.fact_sales.join(_customer_state(lk), "customer_unique_id", "left")
    return f.groupBy("customer_state").agg(
        F.avg("dias_para_entrega").alias("prazo_medio_real"),
        F.avg("dias_estimados").alias("prazo_medio_estimado"),
        F.count("dias_para_entrega").alias("qtd_entregues"),
        F.count("order_id").alias("qtd_pedidos"))


# N2
def cancel_rate_by_period(lk: Lake) -> DataFrame:
    """Seasonality: cancellation rate per calendar month across years."""
    f = lk.priced_orders
    mes = (F.col("date_key") / 100 % 100).cast("int")
    return f.groupBy(mes.alias("mes")).agg(
        F.count("order_id").alias("qtd_pedidos"),
        F.count_if(F.col("order_status") == "canceled").alias("qtd_cancelados"),
        safe_ratio(F.count_if(F.col("order_status") == "canceled"), F.count("order_id")).alias("taxa_cancelamento"))


# N3
def on_time_overall(lk: Lake) -> DataFrame:
    f = lk.priced_orders
    on_time = F.col("entregue_no_prazo")
    return f.agg(
        F.count("order_id").alias("qtd_pedidos"),
        F.count_if(on_time.isNotNull()).alias("qtd_entregues"),
        safe_ratio(F.count_if(on_time), F.count_if(on_time.isNotNull())).alias("taxa_entrega_no_prazo"),
        safe_ratio(F.count_if(on_time.isNotNull()), F.count("order_id")).alias("taxa_entregues"))


# N4
def revenue_by_quarter(lk: Lake) -> DataFrame:
    f = lk.priced_orders
    ano = (F.col("date_key") / 10000).cast("int")
    tri = (((F.col("date_key") / 100 % 100).cast("int") - 1) / 3 + 1).cast("int")
    return f.groupBy(ano.alias("ano"), tri.alias("trimestre")).agg(
        F.sum("valor_total_pedido").alias("receita_total"), F.count("order_id").alias("qtd_pedidos"))


# W2
def revenue_growth(lk: Lake) -> DataFrame:
    """Month-over-month revenue growth. The window runs over the month-grain aggregate
    (at most 12 rows per calendar year), so its single partition is bounded."""
    m = lk.priced_orders.groupBy(month_key("date_key").alias("ano_mes")).agg(
        F.sum("valor_total_pedido").alias("receita_total"))
    prev = F.lag("receita_total").over(Window.orderBy("ano_mes"))
    return m.select("ano_mes", "receita_total", prev.alias("receita_mes_anterior"),
                    safe_ratio(F.col("receita_total") - prev, prev).alias("crescimento"))


# N5
def ticket_by_category(lk: Lake, approx: bool = False) -> DataFrame:
    """Mean and median item price and mean volume per category.

    Items are scanned and joined once and counted per (category, price), which spreads a hot category by
    price after a partial count on every map task; mean, median and volume all come from those counts.
    ``approx=True`` uses the bounded-memory ``percentile_approx`` sketch for the median instead.
    """
    items = lk.fact_order_items.select("product_id", "preco_produto")
    p = sized_broadcast(lk.dim_products.select("product_id", "product_category", (
        F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")).cast("long").alias("volume_cm3")))
    j = items.join(p, "product_id", "left")
    counts = value_counts(j, "product_category", "preco_produto", F.sum("volume_cm3").alias("_v"), F.count("volume_cm3").alias("_nv"))
    priced = F.when(F.col("preco_produto").isNotNull(), F.col("_n"))
    base = counts.groupBy("product_category").agg(
        F.sum("_n").alias("qtd_itens"),
        F.round(safe_ratio(F.sum(F.col("preco_produto") * F.col("_n")), F.sum(priced)), 6).alias("preco_medio"),
        safe_ratio(F.sum("_v"), F.sum("_nv")).alias("volume_medio_cm3"))
    if approx:
        med = j.groupBy("product_category").agg(F.percentile_approx(F.col("preco_produto").cast("double"), 0.5, 10000).alias("preco_mediano"))
    else:
        med = median_of_counts(counts, "product_category", "preco_produto", out="preco_mediano")
    med = med.withColumnRenamed("product_category", "_c")
    return base.join(med, base.product_category.eqNullSafe(med["_c"]), "left").select(
        "product_category", "qtd_itens", "preco_medio", F.round("preco_mediano", 6).alias("preco_mediano"), "volume_medio_cm3")


# N6
def installment_share(lk: Lake) -> DataFrame:
    f = lk.priced_orders
    return f.agg(F.count("order_id").alias("qtd_pedidos"),
                 F.count_if(F.col("max_parcelas") > 1).alias("qtd_parcelados"),
                 safe_ratio(F.count_if(F.col("max_parcelas") > 1), F.count("order_id")).alias("taxa_parcelado"))


def seller_metrics(lk: Lake) -> DataFrame:
    """Per seller: revenue (item prices), distinct orders, mean review score and NPS over the
    reviews of its orders (each order counted once per seller), on-time share."""
    so = lk.raw["olist_order_items"].groupBy("seller_id", "order_id").agg(F.sum("price").alias("receita"))
    o = lk.orders_sla.select("order_id", "entregue_no_prazo")
    rv = lk.fact_reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("_s"), F.count("review_id").alias("_n"),
        F.count_if(F.col("review_score") >= 4).alias("_p"), F.count_if(F.col("review_score") <= 2).alias("_d"))
    j = so.join(o, "order_id").join(rv, "order_id", "left")
    on_time = F.col("entregue_no_prazo")
    return j.groupBy("seller_id").agg(
        F.sum("receita").alias("receita_total"),
        F.count("order_id").alias("qtd_pedidos"),
        safe_ratio(F.sum("_s"), F.sum("_n")).alias("nota_media"),
        (safe_ratio(F.sum("_p") - F.sum("_d"), F.sum("_n")) * 100.0).alias("nps_score"),
        safe_ratio(F.count_if(on_time), F.count_if(on_time.isNotNull())).alias("pct_no_prazo"))


# N7 / O4
def seller_ranking(lk: Lake, k: int = 20) -> DataFrame:
    return (seller_metrics(lk).orderBy(F.desc("receita_total"), F.asc("seller_id")).limit(k)
            .select("seller_id", "receita_total", "qtd_pedidos", "nota_media", "pct_no_prazo"))


# N18
def seller_revenue_nps(lk: Lake) -> DataFrame:
    return seller_metrics(lk).select("seller_id", "receita_total", "nps_score", "qtd_pedidos")


# N8
def same_state_delivery(lk: Lake) -> DataFrame:
    """Delivery days when seller and customer share a state vs not, per distinct (order, seller)."""
    pairs = lk.raw["olist_order_items"].select("order_id", "seller_id").distinct()
    sellers = sized_broadcast(lk.raw["olist_sellers"].select("seller_id", "seller_state"))
    cust = lk.raw["olist_customers"].select("customer_id", "customer_state")
    o = lk.orders_sla.select("order_id", "customer_id", "dias_para_entrega")
    j = (pairs.join(o, "order_id").join(cust, "customer_id", "left").join(sellers, "seller_id", "left"))
    same = (F.col("seller_state") == F.col("customer_state"))
    return j.groupBy(same.alias("mesmo_estado")).agg(
        F.count(F.lit(1)).alias("qtd_pares"),
        F.count("dias_para_entrega").alias("qtd_entregues"),
        F.avg("dias_para_entrega").alias("prazo_medio_entrega"))


def _order_categories(lk: Lake) -> DataFrame:
    items = lk.raw["olist_order_items"].select("order_id", "product_id")
    p = lk.dim_products.select("product_id", "product_category")
    return items.join(p, "product_id").select("order_id", "product_category").distinct()


# N9
def nps_by_category(lk: Lake) -> DataFrame:
    r = lk.fact_reviews.select("order_id", "review_id", "review_score")
    j = _order_categories(lk).join(r, "order_id")
    return j.groupBy("product_category").agg(
        nps("review_score", "review_id").alias("nps_score"),
        F.avg("review_score").alias("nota_media"),
        F.count("review_id").alias("qtd_reviews"))


# O5
def nps_best_worst(lk: Lake, k: int = 10) -> DataFrame:
    n = nps_by_category(lk)
    best = n.orderBy(F.desc("nps_score"), F.asc("product_category")).limit(k).withColumn("grupo", F.lit("melhores"))
    worst = n.orderBy(F.asc("nps_score"), F.asc("product_category")).limit(k).withColumn("grupo", F.lit("piores"))
    return best.unionByName(worst)


def _reviews_with_sla(lk: Lake) -> DataFrame:
    r = lk.fact_reviews.select("order_id", "review_id", "review_score")
    f = lk.priced_orders.select("order_id", "dias_para_entrega", "dias_atraso", "entregue_no_prazo")
    return r.join(f, "order_id")


# N10
def delay_score_corr(lk: Lake) -> DataFrame:
    j = _reviews_with_sla(lk)
    return j.agg(F.round(F.corr("dias_para_entrega", "review_score"), 6).alias("corr_prazo_nota"),
                 F.round(F.corr("dias_atraso", "review_score"), 6).alias("corr_atraso_nota"),
                 F.count("dias_para_entrega").alias("qtd_pares"))


# N11
def score_by_punctuality(lk: Lake) -> DataFrame:
    j = _reviews_with_sla(lk)
    return j.groupBy("entregue_no_prazo").agg(
        F.avg("review_score").alias("nota_media"), nps("review_score", "review_id").alias("nps_score"),
        F.count("review_id").alias("qtd_reviews"))


# N12 / O2
def top_categories(lk: Lake, k: int = 10) -> DataFrame:
    items = lk.fact_order_items.select("product_id", "preco_produto")
    p = lk.dim_products.select("product_id", "product_category")
    rev = items.join(p, "product_id", "left").groupBy("product_category").agg(
        F.sum("preco_produto").alias("receita_total"), F.count(F.lit(1)).alias("qtd_itens"))
    return rev.orderBy(F.desc("receita_total"), F.asc("product_category")).limit(k)


# N13
def payment_mix(lk: Lake) -> DataFrame:
    p = lk.raw["olist_order_payments"]
    g = p.groupBy("payment_type").agg(F.count(F.lit(1)).alias("qtd_pagamentos"),
                                      F.sum("payment_value").alias("valor_total"))
    return g.select("payment_type", "qtd_pagamentos", "valor_total",
                    _share("qtd_pagamentos").alias("share_qtd"),
                    (F.col("valor_total").cast("double") /
                     F.sum("valor_total").over(Window.partitionBy()).cast("double")).alias("share_valor"))


def _on_time_by_state(lk: Lake) -> DataFrame:
    f = lk.fact_sales.join(_customer_state(lk), "customer_unique_id", "left")
    on_time = F.col("entregue_no_prazo")
    return f.groupBy("customer_state").agg(
        safe_ratio(F.count_if(on_time), F.count_if(on_time.isNotNull())).alias("taxa_entrega_no_prazo"),
        F.count_if(on_time.isNotNull()).alias("qtd_entregues"),
        F.avg("dias_atraso").alias("atraso_medio_dias"))


# N14
def sla_light_by_state(lk: Lake) -> DataFrame:
    s = _on_time_by_state(lk)
    return s.select("customer_state", "taxa_entrega_no_prazo", "qtd_entregues",
                    sla_light("taxa_entrega_no_prazo").alias("semaforo"))


# N15 / O3
def top_delay_states(lk: Lake, k: int = 10) -> DataFrame:
    s = _on_time_by_state(lk).where(F.col("atraso_medio_dias").isNotNull())
    return (s.orderBy(F.desc("atraso_medio_dias"), F.asc("customer_state")).limit(k)
            .select("customer_state", "atraso_medio_dias", "qtd_entregues"))


# N16
def delivery_scatter(lk: Lake) -> DataFrame:
    return lk.priced_orders.where(F.col("dias_para_entrega").isNotNull()).select(
        "order_id", "dias_para_entrega", "dias_estimados")


# N16 for a chart of any number of orders
def delivery_scatter_binned(lk: Lake, width: int = 5, most: int = 60) -> DataFrame:
    """Orders per cell of a grid over actual and estimated days: cells of ``width`` days, the first and the last of
    each side take what lies beyond 0 and ``most``. At most ((most / width) + 2) squared rows, from a partial count on
    every map task, where the scatter itself has a row for each order."""
    def cell(days: str):
        return F.least(F.greatest(F.floor(F.col(days) / width), F.lit(-1)), F.lit(most // width)).cast("int") * width
    both = lk.priced_orders.where(F.col("dias_para_entrega").isNotNull() & F.col("dias_estimados").isNotNull())
    return both.groupBy(cell("dias_para_entrega").alias("dias_de"), cell("dias_estimados").alias("estimados_de")).agg(
        F.count(F.lit(1)).alias("qtd_pedidos"), F.count_if("entregue_no_prazo").alias("qtd_no_prazo"))


# N17 / A16
def delivery_histogram(lk: Lake, lo: int = 0, hi: int = 60, width: int = 5) -> DataFrame:
    d = F.col("dias_para_entrega")
    f = lk.priced_orders.where(d.between(lo, hi))
    b = (F.floor((d - lo) / width) * width + lo).cast("int")
    return f.groupBy(b.alias("faixa_inicio")).agg(F.count(F.lit(1)).alias("qtd_pedidos"))


# N19
def executive_cards(lk: Lake) -> DataFrame:
    """Global cards from the facts (not an average of monthly rates). Sales and reviews are
    aggregated in one pass over their union (no join of the two one-row results)."""
    s = lk.priced_orders.select("order_id", "valor_total_pedido", "entregue_no_prazo",
                             F.lit(None).cast("int").alias("review_score"), F.lit(None).cast("string").alias("review_id"))
    r = lk.fact_reviews.select(F.lit(None).cast("string").alias("order_id"),
                               F.lit(None).cast(s.schema["valor_total_pedido"].dataType).alias("valor_total_pedido"),
                               F.lit(None).cast("boolean").alias("entregue_no_prazo"), "review_score", "review_id")
    u = s.unionByName(r)
    on_time = F.col("entregue_no_prazo")
    return u.agg(
        F.sum("valor_total_pedido").alias("receita_total"),
        safe_ratio(F.sum("valor_total_pedido"), F.count("order_id")).alias("ticket_medio"),
        F.count("order_id").alias("qtd_pedidos"),
        nps("review_score", "review_id").alias("nps_score"),
        safe_ratio(F.count_if(on_time), F.count_if(on_time.isNotNull())).alias("taxa_entrega_no_prazo"))


def _year(f: DataFrame) -> F.Column:
    """The stored fact's partition column, on which filters prune; else derived from the date key."""
    return F.col("ano") if "ano" in f.columns else (F.col("date_key") / 10000).cast("int")


# N20
def revenue_by_year(lk: Lake, year: int | None = None) -> DataFrame:
    f = lk.priced_orders
    if year is not None:
        f = f.where(_year(f) == year)
    return f.groupBy(_year(f).alias("ano")).agg(
        F.sum("valor_total_pedido").alias("receita_total"), F.count("order_id").alias("qtd_pedidos"))


def revenue_in_year(lk: Lake, year: int) -> DataFrame:
    return revenue_by_year(lk, year)


def top_sellers_in_region(lk: Lake, k: int = 5) -> DataFrame:
    """Top-k sellers by revenue within each seller region. The per-region row_number filter is
    planned as partial (pre-shuffle) + final WindowGroupLimit, so a large region sends only
    k rows per map partition."""
    rev = lk.raw["olist_order_items"].groupBy("seller_id").agg(F.sum("price").alias("receita_total"))
    s = lk.dim_sellers.select("seller_id", F.coalesce("regiao_brasil", F.lit("Desconhecido")).alias("regiao_brasil"))
    j = rev.join(s, "seller_id")
    rn = F.row_number().over(Window.partitionBy("regiao_brasil").orderBy(F.desc("receita_total"), F.asc("seller_id")))
    return j.withColumn("posicao", rn).where(F.col("posicao") <= k)


# N21
def category_sku_count(lk: Lake, k: int = 5) -> DataFrame:
    p = lk.dim_products.groupBy("product_category").agg(F.count(F.lit(1)).alias("qtd_produtos"))
    return p.orderBy(F.desc("qtd_produtos"), F.asc("product_category")).limit(k)


def share_by_state(lk: Lake) -> DataFrame:
    """Customer (persons) and seller counts and shares per state. Both sides are aggregated to one row
    per state text before the outer join."""
    c = lk.customer_latest.groupBy(F.col("customer_state").alias("estado")).agg(F.count(F.lit(1)).alias("qtd_clientes"))
    # dim_sellers is one row per raw seller; the state needs no region lookup
    s = lk.raw["olist_sellers"].groupBy(F.col("seller_state").alias("estado")).agg(F.count(F.lit(1)).alias("qtd_sellers"))
    j = c.join(s, "estado", "full").fillna(0, subset=["qtd_clientes", "qtd_sellers"])
    return j.select("estado", "qtd_clientes", _share("qtd_clientes").alias("share_clientes"),
                    "qtd_sellers", _share("qtd_sellers").alias("share_sellers"))


# P12
def sliced_sales(lk: Lake, period: tuple[int, int] | None = None, state: str | None = None,
                 category: str | None = None, seller_state: str | None = None) -> DataFrame:
    """Dashboard slicers on the item-grain fact: period (yyyyMM range), customer state, category,
    seller state. Each slicer is a join to a keyed dimension plus a filter (dimension sides are
    size-checked by the planner's statistics and AQE)."""
    f = lk.fact_sales_item
    if period is not None:
        ym = F.col("ano") * 100 + F.col("mes")
        # the year range prunes partitions of the stored fact; the months are exact
        f = f.where(F.col("ano").between(period[0] // 100, period[1] // 100) & ym.between(period[0], period[1]))
    if state is not None:
        c = lk.dim_customers_keyed.select("customer_key", F.col("estado").alias("customer_state"))
        f = f.join(c, "customer_key").where(F.col("customer_state") == state)
    if category is not None:
        p = lk.dim_products_keyed.select("product_key", "category_en")
        f = f.join(p, "product_key").where(F.col("category_en") == category)
    if seller_state is not None:
        sl = lk.dim_sellers_keyed.select("seller_key", F.col("estado").alias("seller_state"))
        f = f.join(sl, "seller_key").where(F.col("seller_state") == seller_state)
    return f


def sliced_kpis(lk: Lake, **slicers) -> DataFrame:
    f = sliced_sales(lk, **slicers)
    return f.groupBy("ano", "mes").agg(
        F.sum("preco_produto").alias("receita_itens"),
        F.count_distinct("order_id").alias("qtd_pedidos"),
        F.count(F.lit(1)).alias("qtd_itens"))

"""Per-query oracle SQL (DuckDB)."""

from .base import RAW, ddiff, region_case, with_ctes

ORACLE: dict[str, str] = {}


def q(name: str, body: str, extra: dict | None = None):
    ORACLE[name] = with_ctes(body, extra)


# ---------------- silver ----------------
q("geo_outlier_filter", """
SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_state FROM olist_geolocation
WHERE geolocation_lat BETWEEN -34.0 AND 5.5 AND geolocation_lng BETWEEN -74.0 AND -34.0""")

q("geolocation_aggregated", """
SELECT zip_code_prefix, round(lat, 6) AS lat, round(lng, 6) AS lng, state, regiao_brasil FROM geolocation_aggregated""")

q("region_of_state", """
SELECT customer_state, {region} AS regiao_brasil, COUNT(*) AS qtd_clientes FROM olist_customers GROUP BY customer_state
""".replace("{region}", region_case("customer_state")))

q("payments_per_order", "SELECT * FROM pay_by_order")

q("payments_mode_per_order", """
SELECT order_id, max(CASE WHEN rn = 1 THEN payment_type END) AS forma_pagamento_frequente,
       CAST(sum(cnt) AS BIGINT) AS qtd_pagamentos
FROM (SELECT order_id, payment_type, cnt,
             row_number() OVER (PARTITION BY order_id ORDER BY CASE WHEN payment_type IS NULL THEN 1 ELSE 0 END,
                                cnt DESC, payment_type ASC) AS rn
      FROM (SELECT order_id, payment_type, count(payment_type) AS cnt FROM olist_order_payments GROUP BY 1, 2))
GROUP BY order_id""")

q("items_per_order", """
SELECT order_id, CAST(valor_total_pedido AS DOUBLE) AS valor_total_pedido, quantidade_itens FROM items_by_order""")

q("sla_fields", f"""
SELECT order_id, customer_id,
       {ddiff('order_delivered_customer_date', 'order_purchase_timestamp')} AS dias_para_entrega,
       {ddiff('order_estimated_delivery_date', 'order_purchase_timestamp')} AS dias_estimados,
       CASE WHEN order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
            THEN order_delivered_customer_date <= order_estimated_delivery_date END AS entregue_no_prazo,
       CASE WHEN order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL
            THEN {ddiff('order_delivered_customer_date', 'order_estimated_delivery_date')} END AS dias_atraso
FROM olist_orders""")

q("orders_enriched", "SELECT * REPLACE (CAST(valor_total_pedido AS DOUBLE) AS valor_total_pedido) FROM orders_enriched")
q("quarantine", "SELECT * FROM quarantine")
q("quarantine_rate", """
SELECT COUNT(*) AS total_pedidos, CAST(count_if(order_id IS NULL) AS BIGINT) AS qtd_quarentena,
       CASE WHEN COUNT(*) > 0 THEN CAST(count_if(order_id IS NULL) AS DOUBLE) / COUNT(*) ELSE 0.0 END AS taxa_quarentena
FROM olist_orders""")
q("reviews_enriched", "SELECT * FROM reviews_enriched")

# ---------------- gold ----------------
q("dim_customers", "SELECT * FROM dim_customers")
q("dim_sellers", "SELECT * FROM dim_sellers")
q("dim_products", "SELECT * FROM dim_products")
q("dim_calendar", "SELECT * FROM dim_calendar")
q("fact_sales", "SELECT * REPLACE (CAST(valor_total_pedido AS DOUBLE) AS valor_total_pedido) FROM fact_sales")
q("fact_reviews", "SELECT * FROM fact_reviews")
q("fact_order_items", """
SELECT order_id, order_item_id, product_id, seller_id, CAST(preco_produto AS DOUBLE) AS preco_produto,
       CAST(valor_frete AS DOUBLE) AS valor_frete, CAST(valor_total_item AS DOUBLE) AS valor_total_item
FROM fact_order_items""")
q("kpi_sales_monthly", "SELECT * REPLACE (CAST(receita_total AS DOUBLE) AS receita_total) FROM kpi_sales")
q("kpi_sellers_monthly", "SELECT * FROM kpi_sellers")
q("kpi_reviews_monthly", "SELECT * FROM kpi_reviews")
q("kpi_marketplace_monthly",
  "SELECT * REPLACE (CAST(receita_total AS DOUBLE) AS receita_total) FROM kpi_marketplace_monthly")

OF = "(CAST(substr(order_id, 2) AS BIGINT) % 100 = {} AND year({}) = 1996)"
BOUGHT_OF = "order_purchase_timestamp"
q("kpi_incremental", "SELECT * REPLACE (CAST(receita_total AS DOUBLE) AS receita_total) FROM kpi_marketplace_monthly", {
    "olist_orders": f"""
SELECT * REPLACE (CASE WHEN {OF.format(7, BOUGHT_OF)} THEN 'canceled' ELSE order_status END AS order_status,
                  CASE WHEN {OF.format(13, BOUGHT_OF)} THEN order_purchase_timestamp + INTERVAL 40 DAY ELSE order_purchase_timestamp END AS order_purchase_timestamp)
FROM ({RAW['olist_orders']})""",
    "olist_order_items": f"""
SELECT i.* FROM ({RAW['olist_order_items']}) i LEFT JOIN (SELECT order_id, order_purchase_timestamp FROM ({RAW['olist_orders']})) o ON o.order_id = i.order_id
WHERE NOT (order_item_id = 1 AND coalesce({OF.format(21, BOUGHT_OF).replace('order_id', 'i.order_id')}, FALSE))""",
    "olist_order_reviews": f"""
SELECT * REPLACE (CASE WHEN {OF.format(33, 'review_creation_date')} THEN CAST(1 AS INTEGER) ELSE review_score END AS review_score) FROM ({RAW['olist_order_reviews']})"""})

SOLD = """
SELECT f.order_id, f.date_key, f.customer_unique_id, c.customer_state AS estado,
       CAST(f.date_key // 10000 * 10 + ceil(f.date_key // 100 % 100 / 3.0) AS INTEGER) AS ano_trimestre
FROM fact_sales f JOIN dim_customers c ON f.customer_unique_id = c.customer_unique_id
WHERE f.date_key BETWEEN 19960101 AND 19971231"""
q("distinct_sketch_quarters", """
SELECT ano_trimestre, estado, COUNT(DISTINCT s.order_id) AS qtd_pedidos, COUNT(DISTINCT customer_unique_id) AS clientes_exatos,
       COUNT(DISTINCT seller_id) AS sellers_exatos, TRUE AS clientes_no_limite, TRUE AS sellers_no_limite
FROM sold s LEFT JOIN olist_order_items i ON i.order_id = s.order_id GROUP BY ALL""", {"sold": SOLD})
q("price_sketch_by_category", """
SELECT COALESCE(product_category, 'unknown') AS categoria, COUNT(*) AS qtd_itens, TRUE AS mediana_no_limite, TRUE AS p90_no_limite
FROM fact_order_items i JOIN fact_sales f ON f.order_id = i.order_id LEFT JOIN dim_products p ON p.product_id = i.product_id
WHERE i.preco_produto IS NOT NULL AND f.date_key BETWEEN 19960101 AND 19971231 GROUP BY 1""")

q("orders_priced_bucketed", """
SELECT order_id, order_status, CAST(valor_total_pedido AS DOUBLE) AS valor_total_pedido, quantidade_itens, forma_pagamento_principal, max_parcelas,
       dias_para_entrega, entregue_no_prazo FROM orders_enriched""")
q("delivery_scatter_binned", """
SELECT CAST(least(greatest(floor(dias_para_entrega / 5.0), -1), 12) AS INTEGER) * 5 AS dias_de,
       CAST(least(greatest(floor(dias_estimados / 5.0), -1), 12) AS INTEGER) * 5 AS estimados_de,
       COUNT(*) AS qtd_pedidos, CAST(count_if(entregue_no_prazo) AS BIGINT) AS qtd_no_prazo
FROM fact_sales WHERE dias_para_entrega IS NOT NULL AND dias_estimados IS NOT NULL GROUP BY 1, 2""")
q("clustered_slices", """
SELECT f.date_key // 100 AS ano_mes, COUNT(*) AS qtd_itens, CAST(SUM(i.preco_produto) AS DOUBLE) AS preco_total
FROM fact_order_items i JOIN fact_sales f ON f.order_id = i.order_id
JOIN dim_customers c ON c.customer_unique_id = f.customer_unique_id
JOIN dim_products p ON p.product_id = i.product_id
WHERE c.customer_state = 'SP' AND p.product_category = 'economy_en' GROUP BY 1""")


def oracle_queries() -> dict[str, str]:
    return dict(ORACLE)


# ---------------- quality ----------------
from . import checks as C  # noqa: E402
from marketlake.config import DEFAULT as _S  # noqa: E402

q("check_count", C.union([C.non_empty("bronze", t) for t in _S.bronze_tables]))
q("check_null_rate", C.union([
    C.null_rate("bronze", "olist_orders", "order_id", _S.max_null_rate),
    C.null_rate("bronze", "olist_orders", "order_delivered_customer_date", _S.max_null_rate, blocking=False),
    C.not_null("bronze", "olist_orders", "customer_id")]))
q("check_date_range", C.union([
    C.date_range("bronze", "olist_orders", "order_purchase_timestamp", _S.data_min_date, _S.data_max_date, blocking=False),
    C.date_range("bronze", "olist_orders", "order_delivered_customer_date", "1995-01-01", "2001-12-31", blocking=False),
    C.date_range("bronze", "olist_order_reviews", "review_creation_date", "1995-01-01", "2001-12-31", blocking=False)]))
q("check_value_range", C.union([
    C.value_range("bronze", "olist_geolocation", "geolocation_lat", _S.lat_min, _S.lat_max, blocking=False),
    C.value_range("bronze", "olist_geolocation", "geolocation_lng", _S.lng_min, _S.lng_max, blocking=False),
    C.value_range("bronze", "olist_order_reviews", "review_score", _S.review_score_min, _S.review_score_max),
    C.value_range("silver", "orders_enriched", "valor_total_pedido", _S.order_total_min, _S.order_total_max)]))
q("check_no_duplicates", C.union([
    C.no_duplicates("bronze", "olist_order_items", ["order_id", "order_item_id"]),
    C.no_duplicates("silver", "orders_enriched", ["order_id"]),
    C.no_duplicates("gold", "dim_customers", ["customer_unique_id"])]))
q("check_fk_integrity", C.union([
    C.fk_integrity("gold", "fact_order_items", "fact_order_items", "product_id", "dim_products", "product_id"),
    C.fk_integrity("gold", "fact_order_items", "fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    C.fk_integrity("gold", "fact_order_items", "fact_order_items", "order_id", "fact_sales", "order_id"),
    C.fk_integrity("gold", "fact_sales", "fact_sales", "date_key", "dim_calendar", "date_key", string_key=False)]))
q("check_reconciliation", C.reconciliation("gold", "kpi_marketplace_monthly", "fact_sales", "valor_total_pedido",
                                           "kpi_marketplace_monthly", "receita_total"))
q("suite_bronze", C.bronze_suite())
q("suite_silver", C.silver_suite())
q("suite_gold", C.gold_suite())


# ---------------- dimensional modelling ----------------
from .base import GOLD, sk  # noqa: E402

q("surrogate_key", f"SELECT customer_unique_id, {sk('customer_unique_id')} AS customer_key FROM dim_customers")
KEY_LOADS = {
    "first_load": """
SELECT DISTINCT customer_unique_id FROM olist_customers
WHERE customer_id IN (SELECT customer_id FROM olist_orders WHERE order_purchase_timestamp < TIMESTAMP '1996-01-01')""",
    "stored_keys": f"""
SELECT customer_unique_id, {sk('customer_unique_id')} AS customer_key FROM first_load
UNION ALL
SELECT customer_unique_id, (SELECT COUNT(*) FROM first_load) + {sk('customer_unique_id')} AS customer_key
FROM (SELECT DISTINCT customer_unique_id FROM olist_customers) WHERE customer_unique_id NOT IN (SELECT customer_unique_id FROM first_load)""",
}
q("surrogate_key_second_load", "SELECT customer_unique_id, customer_key FROM stored_keys", KEY_LOADS)
q("fk_stored_keys", """
SELECT f.order_id, f.customer_unique_id, COALESCE(k.customer_key, -1) AS customer_key
FROM fact_sales f LEFT JOIN stored_keys k ON f.customer_unique_id = k.customer_unique_id""", KEY_LOADS)
q("fk_or_unknown", """
SELECT f.order_id, f.customer_unique_id, COALESCE(d.customer_key, -1) AS customer_key
FROM fact_sales f LEFT JOIN (SELECT * FROM dim_customers_keyed WHERE customer_key <> -1) d
  ON f.customer_unique_id = d.customer_unique_id""")
q("dim_customers_keyed", "SELECT * REPLACE (round(lat, 6) AS lat, round(lng, 6) AS lng) FROM dim_customers_keyed")
q("dim_sellers_keyed", "SELECT * REPLACE (round(lat, 6) AS lat, round(lng, 6) AS lng) FROM dim_sellers_keyed")
q("dim_products_keyed", "SELECT * FROM dim_products_keyed")
q("unknown_member", """
SELECT 'customer_key' AS dimension, customer_key AS member_key, customer_unique_id AS business_key FROM dim_customers_keyed WHERE customer_key = -1
UNION ALL SELECT 'product_key', product_key, product_id FROM dim_products_keyed WHERE product_key = -1
UNION ALL SELECT 'seller_key', seller_key, seller_id FROM dim_sellers_keyed WHERE seller_key = -1""")
q("reviews_context", "SELECT * FROM reviews_context")
q("fact_sales_item", """
SELECT * REPLACE (CAST(preco_produto AS DOUBLE) AS preco_produto, CAST(valor_frete AS DOUBLE) AS valor_frete,
                  CAST(valor_total_item AS DOUBLE) AS valor_total_item) FROM fact_sales_item""")
q("fact_reviews_keyed", "SELECT * FROM fact_reviews_keyed")
q("dim_time_pt", "SELECT * FROM dim_time_pt")


def _suite_gold_keyed() -> str:
    rows = [C.gold_suite()]
    for t, key in [("dim_customers_keyed", "customer_key"), ("dim_products_keyed", "product_key"),
                   ("dim_sellers_keyed", "seller_key")]:
        rows.append(C.no_duplicates("gold", t, [key]))
        rows.append(C.unknown_present("gold", t, key))
    for t, key in [("dim_customers_keyed", "customer_key"), ("dim_products_keyed", "product_key"),
                   ("dim_sellers_keyed", "seller_key")]:
        rows.append(C.fk_integrity("gold", "fact_sales_item", "fact_sales_item", key, t, key, string_key=False))
    rows.append(C.fk_integrity("gold", "fact_sales_item", "fact_sales_item", "date_key", "dim_calendar", "date_key",
                               string_key=False))
    return C.union(rows)


q("suite_gold_keyed", _suite_gold_keyed())


KEYED_DIMS = [("dim_customers_keyed", "customer_key"), ("dim_products_keyed", "product_key"), ("dim_sellers_keyed", "seller_key")]


def _suite_star_keyed() -> str:
    rows = []
    for t, key in KEYED_DIMS:
        rows += [C.no_duplicates("gold", t, [key]), C.unknown_present("gold", t, key)]
    for fact in ("fact_sales_item", "fact_reviews_keyed"):
        rows += [C.not_null("gold", fact, key) for _, key in KEYED_DIMS]
        rows += [C.fk_integrity("gold", fact, fact, key, t, key, string_key=False) for t, key in KEYED_DIMS]
    rows += [C.not_null("gold", "fact_sales_item", "date_key"),
             C.fk_integrity("gold", "fact_sales_item", "fact_sales_item", "date_key", "dim_calendar", "date_key", string_key=False),
             C.ratio("gold", "fact_sales_item", "items_without_order", "count_if(valid IS NULL)", "COUNT(*)",
                     "(SELECT valid FROM olist_order_items LEFT JOIN (SELECT order_id, 1 AS valid FROM olist_orders "
                     "WHERE order_id IS NOT NULL) USING (order_id))", blocking=False)]
    return C.union(rows)


q("suite_star_keyed", _suite_star_keyed())
q("dim_time_documented", """
SELECT d.*, (SELECT COUNT(*) FROM olist_orders WHERE CAST(order_purchase_timestamp AS DATE) = d.date) AS qtd_pedidos
FROM (""" + GOLD["dim_time_pt"].replace("calendar_days", "documented_days") + ") d")
q("surrogate_key_nulls", f"SELECT order_id, {sk('order_id')} AS order_key FROM (SELECT DISTINCT order_id FROM olist_orders)")
q("median_scale", """
SELECT l_returnflag, round(median(CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS DOUBLE)), 6)
       AS desconto_mediano
FROM lineitem GROUP BY l_returnflag""")


# ---------------- business queries ----------------
from . import analytics as _AN  # noqa: E402

for _n, _body in _AN.QUERIES.items():
    q(_n, _body, _AN.EXTRA)


# ---------------- streaming ingest and incremental upsert ----------------
q("csv_stream_ingest", "SELECT * FROM olist_order_reviews")
q("csv_ingest_rerun", "SELECT * FROM olist_orders")
q("csv_reordered_columns", "SELECT * FROM olist_sellers")
q("csv_new_column", """
SELECT *, CASE WHEN CAST(right(seller_id, 1) AS INTEGER) >= 5 THEN 'canal ' || seller_state END AS canal FROM olist_sellers""")
q("append_added_column", """
SELECT *, CASE WHEN CAST(right(seller_id, 1) AS INTEGER) >= 5 THEN 'lote 2 ' || seller_state END AS motivo FROM olist_sellers""")
q("csv_ingest_metadata", """
SELECT seller_state, COUNT(*) AS linhas, COUNT(*) AS com_arquivo, COUNT(*) AS com_horario, CAST(0 AS BIGINT) AS corrompidas
FROM olist_sellers GROUP BY seller_state""")
q("upsert_moved_partition", """
SELECT order_id, order_status, CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END AS versao,
       CAST(year(order_purchase_timestamp) + CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END AS INTEGER) AS ano
FROM olist_orders WHERE order_id IS NOT NULL""")
q("quality_log", f"""
SELECT substr(sha256('run-1|' || layer || '|' || table_name || '|' || check_name), 1, 16) AS check_id, *, 'run-1' AS run_id
FROM ({C.bronze_suite()})""")
q("partitioned_fact_month", """
SELECT * REPLACE (CAST(valor_total_pedido AS DOUBLE) AS valor_total_pedido), CAST(date_key // 10000 AS INTEGER) AS ano,
       CAST(date_key // 100 % 100 AS INTEGER) AS mes
FROM fact_sales""")
q("upsert_latest", """
SELECT customer_unique_id, customer_id, customer_city, customer_state, customer_zip_code_prefix, order_purchase_timestamp
FROM (SELECT c.*, o.order_purchase_timestamp,
             row_number() OVER (PARTITION BY c.customer_unique_id
                                ORDER BY o.order_purchase_timestamp DESC NULLS LAST,
                                         CASE WHEN o.order_purchase_timestamp >= TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END DESC,
                                         c.customer_id DESC) AS rn
      FROM olist_customers c JOIN olist_orders o ON c.customer_id = o.customer_id)
WHERE rn = 1""")

from marketlake.config import EXPECTED_COUNTS as _EXP  # noqa: E402

q("check_expected_volume", C.union([
    C.row("bronze", t, f"expected_count({n})", f"COUNT(*) = {n}", "COUNT(*)",
          f"'expected={n} actual=' || CAST(COUNT(*) AS VARCHAR)", t, blocking=False)
    for t, n in _EXP.items()]))


# ---------------- documented variants ----------------
q("quarantine_documented", """
SELECT *, CASE WHEN order_id IS NULL THEN 'order_id nulo' ELSE 'customer_id nulo' END AS motivo_rejeicao
FROM olist_orders WHERE order_id IS NULL OR customer_id IS NULL""")

q("orders_enriched_most_frequent", """
SELECT oe.* REPLACE (CAST(oe.valor_total_pedido AS DOUBLE) AS valor_total_pedido,
                     pm.tipo AS forma_pagamento_principal)
FROM orders_enriched oe
LEFT JOIN (SELECT order_id, max(CASE WHEN rn = 1 THEN payment_type END) AS tipo
           FROM (SELECT order_id, payment_type,
                        row_number() OVER (PARTITION BY order_id ORDER BY CASE WHEN payment_type IS NULL THEN 1 ELSE 0 END,
                                           cnt DESC, payment_type ASC) AS rn
                 FROM (SELECT order_id, payment_type, count(payment_type) AS cnt FROM olist_order_payments GROUP BY 1, 2))
           GROUP BY order_id) pm
  ON oe.order_id = pm.order_id""")

"""Oracle SQL for the business queries."""

NPS = ("CAST(count_if({s} >= 4) - count_if({s} <= 2) AS DOUBLE) / NULLIF(CAST(COUNT({r}) AS DOUBLE), 0) * 100.0")


def nps(s="review_score", r="review_id"):
    return NPS.format(s=s, r=r)


def ratio(num, den):
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


EXTRA = {
    "so_pairs": """SELECT seller_id, order_id, SUM(price) AS receita FROM olist_order_items GROUP BY seller_id, order_id""",
    "order_rv": """SELECT order_id, SUM(review_score) AS s, COUNT(review_id) AS n,
       count_if(review_score >= 4) AS p, count_if(review_score <= 2) AS d FROM fact_reviews GROUP BY order_id""",
    "seller_metrics": f"""
SELECT so.seller_id, SUM(so.receita) AS receita_total, COUNT(so.order_id) AS qtd_pedidos,
       {ratio('SUM(rv.s)', 'SUM(rv.n)')} AS nota_media,
       {ratio('SUM(rv.p) - SUM(rv.d)', 'SUM(rv.n)')} * 100.0 AS nps_score,
       {ratio('count_if(o.entregue_no_prazo)', 'count_if(o.entregue_no_prazo IS NOT NULL)')} AS pct_no_prazo
FROM so_pairs so JOIN orders_enriched o ON so.order_id = o.order_id LEFT JOIN order_rv rv ON so.order_id = rv.order_id
GROUP BY so.seller_id""",
    "order_cats": """SELECT DISTINCT i.order_id, p.product_category FROM olist_order_items i
       JOIN dim_products p ON i.product_id = p.product_id""",
    "nps_cat": f"""
SELECT oc.product_category, {nps('r.review_score', 'r.review_id')} AS nps_score, avg(r.review_score) AS nota_media,
       COUNT(r.review_id) AS qtd_reviews
FROM order_cats oc JOIN fact_reviews r ON oc.order_id = r.order_id GROUP BY oc.product_category""",
    "rv_sla": """SELECT r.order_id, r.review_id, r.review_score, f.dias_para_entrega, f.dias_atraso, f.entregue_no_prazo
       FROM fact_reviews r JOIN fact_sales f ON r.order_id = f.order_id""",
    "ontime_state": f"""
SELECT c.customer_state, {ratio('count_if(f.entregue_no_prazo)', 'count_if(f.entregue_no_prazo IS NOT NULL)')} AS taxa_entrega_no_prazo,
       CAST(count_if(f.entregue_no_prazo IS NOT NULL) AS BIGINT) AS qtd_entregues, avg(f.dias_atraso) AS atraso_medio_dias
FROM fact_sales f LEFT JOIN dim_customers c ON f.customer_unique_id = c.customer_unique_id GROUP BY c.customer_state""",
}

QUERIES = {
    "delivery_by_state": """
SELECT c.customer_state, avg(f.dias_para_entrega) AS prazo_medio_real, avg(f.dias_estimados) AS prazo_medio_estimado,
       COUNT(f.dias_para_entrega) AS qtd_entregues, COUNT(f.order_id) AS qtd_pedidos
FROM fact_sales f LEFT JOIN dim_customers c ON f.customer_unique_id = c.customer_unique_id GROUP BY c.customer_state""",
    "cancel_rate_by_period": f"""
SELECT CAST((date_key // 100) % 100 AS INTEGER) AS mes, COUNT(order_id) AS qtd_pedidos,
       CAST(count_if(order_status = 'canceled') AS BIGINT) AS qtd_cancelados,
       {ratio("count_if(order_status = 'canceled')", 'COUNT(order_id)')} AS taxa_cancelamento
FROM fact_sales GROUP BY 1""",
    "on_time_overall": f"""
SELECT COUNT(order_id) AS qtd_pedidos, CAST(count_if(entregue_no_prazo IS NOT NULL) AS BIGINT) AS qtd_entregues,
       {ratio('count_if(entregue_no_prazo)', 'count_if(entregue_no_prazo IS NOT NULL)')} AS taxa_entrega_no_prazo,
       {ratio('count_if(entregue_no_prazo IS NOT NULL)', 'COUNT(order_id)')} AS taxa_entregues
FROM fact_sales""",
    "revenue_by_quarter": """
SELECT CAST(date_key // 10000 AS INTEGER) AS ano, CAST(((date_key // 100) % 100 - 1) // 3 + 1 AS INTEGER) AS trimestre,
       CAST(SUM(valor_total_pedido) AS DOUBLE) AS receita_total, COUNT(order_id) AS qtd_pedidos
FROM fact_sales GROUP BY 1, 2""",
    "revenue_growth": """
SELECT ano_mes, CAST(receita AS DOUBLE) AS receita_total, CAST(prev AS DOUBLE) AS receita_mes_anterior,
       CAST(receita - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0) AS crescimento
FROM (SELECT ano_mes, receita, lag(receita) OVER (ORDER BY ano_mes) AS prev
      FROM (SELECT CAST(date_key // 100 AS INTEGER) AS ano_mes, SUM(valor_total_pedido) AS receita FROM fact_sales GROUP BY 1))""",
    "ticket_by_category": """
SELECT p.category_en AS product_category, COUNT(*) AS qtd_itens, round(avg(CAST(i.price AS DOUBLE)), 6) AS preco_medio,
       round(quantile_cont(CAST(i.price AS DOUBLE), 0.5), 6) AS preco_mediano, avg(p.volume_cm3) AS volume_medio_cm3
FROM olist_order_items i LEFT JOIN (SELECT * FROM dim_products_keyed WHERE product_key <> -1) p ON i.product_id = p.product_id
GROUP BY p.category_en""",
    "installment_share": f"""
SELECT COUNT(order_id) AS qtd_pedidos, CAST(count_if(max_parcelas > 1) AS BIGINT) AS qtd_parcelados,
       {ratio('count_if(max_parcelas > 1)', 'COUNT(order_id)')} AS taxa_parcelado FROM fact_sales""",
    "seller_ranking": """
SELECT seller_id, CAST(receita_total AS DOUBLE) AS receita_total, qtd_pedidos, nota_media, pct_no_prazo
FROM seller_metrics ORDER BY receita_total DESC, seller_id LIMIT 20""",
    "seller_revenue_nps": """
SELECT seller_id, CAST(receita_total AS DOUBLE) AS receita_total, nps_score, qtd_pedidos FROM seller_metrics""",
    "same_state_delivery": """
SELECT (s.seller_state = c.customer_state) AS mesmo_estado, COUNT(*) AS qtd_pares,
       COUNT(o.dias_para_entrega) AS qtd_entregues, avg(o.dias_para_entrega) AS prazo_medio_entrega
FROM (SELECT DISTINCT order_id, seller_id FROM olist_order_items) p
JOIN orders_enriched o ON p.order_id = o.order_id
LEFT JOIN olist_customers c ON o.customer_id = c.customer_id
LEFT JOIN olist_sellers s ON p.seller_id = s.seller_id
GROUP BY 1""",
    "nps_by_category": "SELECT * FROM nps_cat",
    "nps_best_worst": """
SELECT * FROM (SELECT *, 'melhores' AS grupo FROM nps_cat ORDER BY nps_score DESC, product_category LIMIT 10)
UNION ALL
SELECT * FROM (SELECT *, 'piores' AS grupo FROM nps_cat ORDER BY nps_score ASC, product_category LIMIT 10)""",
    "delay_score_corr": """
SELECT round(corr(dias_para_entrega, review_score), 6) AS corr_prazo_nota,
       round(corr(dias_atraso, review_score), 6) AS corr_atraso_nota, COUNT(dias_para_entrega) AS qtd_pares
FROM rv_sla""",
    "score_by_punctuality": f"""
SELECT entregue_no_prazo, avg(review_score) AS nota_media, {nps()} AS nps_score, COUNT(review_id) AS qtd_reviews
FROM rv_sla GROUP BY entregue_no_prazo""",
    "top_categories": """
SELECT p.product_category, CAST(SUM(i.price) AS DOUBLE) AS receita_total, COUNT(*) AS qtd_itens
FROM olist_order_items i LEFT JOIN dim_products p ON i.product_id = p.product_id
GROUP BY p.product_category ORDER BY SUM(i.price) DESC, p.product_category LIMIT 10""",
    "payment_mix": """
SELECT payment_type, qtd_pagamentos, CAST(valor_total AS DOUBLE) AS valor_total,
       CAST(qtd_pagamentos AS DOUBLE) / CAST(SUM(qtd_pagamentos) OVER () AS DOUBLE) AS share_qtd,
       CAST(valor_total AS DOUBLE) / CAST(SUM(valor_total) OVER () AS DOUBLE) AS share_valor
FROM (SELECT payment_type, COUNT(*) AS qtd_pagamentos, SUM(payment_value) AS valor_total
      FROM olist_order_payments GROUP BY payment_type)""",
    "sla_light_by_state": """
SELECT customer_state, taxa_entrega_no_prazo, qtd_entregues,
       CASE WHEN taxa_entrega_no_prazo >= 0.9 THEN 'verde' WHEN taxa_entrega_no_prazo >= 0.8 THEN 'amarelo'
            WHEN taxa_entrega_no_prazo IS NOT NULL THEN 'vermelho' END AS semaforo
FROM ontime_state""",
    "top_delay_states": """
SELECT customer_state, atraso_medio_dias, qtd_entregues FROM ontime_state WHERE atraso_medio_dias IS NOT NULL
ORDER BY atraso_medio_dias DESC, customer_state LIMIT 10""",
    "delivery_scatter": """
SELECT order_id, dias_para_entrega, dias_estimados FROM fact_sales WHERE dias_para_entrega IS NOT NULL""",
    "delivery_histogram": """
SELECT CAST(floor(dias_para_entrega / 5) * 5 AS INTEGER) AS faixa_inicio, COUNT(*) AS qtd_pedidos
FROM fact_sales WHERE dias_para_entrega BETWEEN 0 AND 60 GROUP BY 1""",
    "executive_cards": f"""
SELECT CAST(SUM(valor_total_pedido) AS DOUBLE) AS receita_total,
       {ratio('SUM(valor_total_pedido)', 'COUNT(order_id)')} AS ticket_medio,
       COUNT(order_id) AS qtd_pedidos,
       (SELECT {nps()} FROM fact_reviews) AS nps_score,
       {ratio('count_if(entregue_no_prazo)', 'count_if(entregue_no_prazo IS NOT NULL)')} AS taxa_entrega_no_prazo
FROM fact_sales""",
    "revenue_in_year": """
SELECT 1996 AS ano, CAST(SUM(valor_total_pedido) AS DOUBLE) AS receita_total, COUNT(order_id) AS qtd_pedidos
FROM fact_sales WHERE date_key BETWEEN 19960101 AND 19961231""",
    "revenue_by_year": """
SELECT CAST(date_key // 10000 AS INTEGER) AS ano, CAST(SUM(valor_total_pedido) AS DOUBLE) AS receita_total,
       COUNT(order_id) AS qtd_pedidos FROM fact_sales GROUP BY 1""",
    "top_sellers_in_region": """
SELECT seller_id, receita_total, regiao_brasil, posicao FROM (
  SELECT r.seller_id, CAST(r.receita_total AS DOUBLE) AS receita_total, COALESCE(s.regiao_brasil, 'Desconhecido') AS regiao_brasil,
         CAST(row_number() OVER (PARTITION BY COALESCE(s.regiao_brasil, 'Desconhecido')
                                 ORDER BY r.receita_total DESC, r.seller_id) AS INTEGER) AS posicao
  FROM (SELECT seller_id, SUM(price) AS receita_total FROM olist_order_items GROUP BY seller_id) r
  JOIN dim_sellers s ON r.seller_id = s.seller_id)
WHERE posicao <= 5""",
    "category_sku_count": """
SELECT product_category, COUNT(*) AS qtd_produtos FROM dim_products GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
    "share_by_state": """
SELECT estado, qtd_clientes, CAST(qtd_clientes AS DOUBLE) / CAST(SUM(qtd_clientes) OVER () AS DOUBLE) AS share_clientes,
       qtd_sellers, CAST(qtd_sellers AS DOUBLE) / CAST(SUM(qtd_sellers) OVER () AS DOUBLE) AS share_sellers
FROM (SELECT COALESCE(c.estado, s.estado) AS estado, COALESCE(c.qtd_clientes, 0) AS qtd_clientes,
             COALESCE(s.qtd_sellers, 0) AS qtd_sellers
      FROM (SELECT customer_state AS estado, COUNT(*) AS qtd_clientes FROM dim_customers GROUP BY 1) c
      FULL JOIN (SELECT seller_state AS estado, COUNT(*) AS qtd_sellers FROM dim_sellers GROUP BY 1) s
      ON c.estado = s.estado)""",
    "sliced_kpis": """
SELECT f.ano, f.mes, CAST(SUM(f.preco_produto) AS DOUBLE) AS receita_itens, COUNT(DISTINCT f.order_id) AS qtd_pedidos,
       COUNT(*) AS qtd_itens
FROM fact_sales_item f JOIN dim_customers_keyed c ON f.customer_key = c.customer_key
WHERE f.ano * 100 + f.mes BETWEEN 199601 AND 199712 AND c.estado = 'SP'
GROUP BY f.ano, f.mes""",
}

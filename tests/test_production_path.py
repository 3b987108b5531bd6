"""Production path on hand-made CSV files with the declared schemas: stream ingest -> all layers."""

import os

from pyspark.sql import functions as F

from marketlake.plans.pipeline import run_pipeline
from marketlake.sources.files import read_table
from marketlake.streaming.ingest import ingest_all

FILES = {
    "olist_orders_dataset.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "o2,c2,delivered,2018-07-24 20:41:37,2018-07-26 03:24:27,2018-07-26 14:31:00,2018-08-07 15:27:45,2018-08-07 00:00:00\n"
        "o3,c3,canceled,2018-08-08 08:38:49,,,,2018-08-20 00:00:00\n"),
    "olist_customers_dataset.csv": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01037,sao paulo,SP\nc2,u2,75265,cristalina,GO\nc3,u1,01037,sao paulo,SP\n"),
    "olist_order_items_dataset.csv": (
        "order_id,order_item_id,product_id,seller_id,price,freight_value\n"
        "o1,1,p1,s1,29.99,8.72\no2,1,p2,s2,118.70,22.76\no2,2,p1,s1,29.99,\no3,1,p2,s2,10.00,1.00\n"),
    "olist_order_payments_dataset.csv": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,credit_card,1,18.12\no1,2,voucher,1,20.59\no2,1,boleto,1,141.46\no3,1,credit_card,3,11.00\n"),
    "olist_order_reviews_dataset.csv": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        "review_answer_timestamp\n"
        'r1,o1,5,,"Produto ótimo, recomendo ""muito""\nchegou antes",2017-10-11 00:00:00,2017-10-12 03:43:48\n'
        "r2,o2,1,,,2018-08-08 00:00:00,2018-08-08 18:37:50\n"),
    "olist_products_dataset.csv": (
        "product_id,product_category_name,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,perfumaria,225,16,10,14\np2,,1000,30,18,20\n"),
    "olist_sellers_dataset.csv": (
        "seller_id,seller_city,seller_state,seller_zip_code_prefix\ns1,campinas,SP,13023\ns2,mogi,SP,08730\n"),
    "olist_geolocation_dataset.csv": (
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
        "01037,-23.545,-46.639,sao paulo,SP\n01037,-23.546,-46.640,sao paulo,SP\n13023,-22.898,-47.063,campinas,SP\n"
        "75265,-16.77,-47.61,cristalina,GO\n99999,40.0,-200.0,nowhere,XX\n"),
    "product_category_name_translation.csv": (
        "product_category_name,product_category_name_english\nperfumaria,perfumery\n"),
}


def test_csv_to_gold_with_declared_schemas(spark, tmp_base):
    landing = f"{tmp_base}/landing"
    os.makedirs(landing)
    for name, text in FILES.items():
        with open(f"{landing}/{name}", "w", encoding="utf-8-sig" if name.startswith("product_category") else "utf-8") as f:
            f.write(text)
    res = ingest_all(spark, landing, tmp_base, f"{tmp_base}/_ck", timeout_s=300)
    assert res["olist_orders"].rows_added == 3 and res["olist_order_reviews"].rows_added == 2

    rep = run_pipeline(spark, None, tmp_base, run_id="prod")
    assert all(r["passed"] for layer in rep.checks.values() for r in layer if r["blocking"]), rep.checks

    cust = {r.customer_unique_id: r for r in read_table(spark, tmp_base, "gold", "dim_customers").collect()}
    assert cust["u1"].customer_zip_code_prefix == "01037" and cust["u1"].regiao_brasil == "Sudeste"
    oe = {r.order_id: r for r in read_table(spark, tmp_base, "silver", "orders_enriched").collect()}
    assert oe["o1"].forma_pagamento_principal == "voucher" and str(oe["o1"].valor_total_pedido) == "38.71"
    assert str(oe["o2"].valor_total_pedido) == "141.46" and oe["o2"].quantidade_itens == 2  # NULL freight dropped
    assert oe["o2"].entregue_no_prazo is False and oe["o2"].dias_atraso == 0              # same-day late
    rv = {r.review_id: r.review_sentiment for r in read_table(spark, tmp_base, "silver", "reviews_enriched").collect()}
    assert rv == {"r1": "positivo", "r2": "sem_comentario"}
    geo = read_table(spark, tmp_base, "silver", "geolocation_aggregated")
    assert geo.count() == 3  # the out-of-bounds zip is dropped
    kpi = read_table(spark, tmp_base, "gold", "kpi_marketplace_monthly").orderBy("ano_mes").collect()
    assert [r.ano_mes for r in kpi] == [201710, 201807, 201808]
    prod = {r.product_id: r.product_category for r in read_table(spark, tmp_base, "gold", "dim_products").collect()}
    assert prod == {"p1": "perfumery", "p2": "unknown"}
    f = read_table(spark, tmp_base, "gold", "fact_sales")
    assert f.where((F.col("ano") == 2018) & (F.col("mes") == 7)).count() == 1

"""Declared schemas of the nine raw CSV datasets (S3) and of the quality log.

Streams need a declared schema; declaring it also fixes types that inference gets
wrong (a zip prefix like 01037 must stay a string). Bump the version and widen a
schema deliberately when the source adds columns (T4).
"""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = 1

S, I, D, TS = T.StringType(), T.IntegerType(), T.DecimalType(18, 2), T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "olist_orders": _st(("order_id", S), ("customer_id", S), ("order_status", S),
                        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
                        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
                        ("order_estimated_delivery_date", TS)),
    "olist_customers": _st(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
                           ("customer_city", S), ("customer_state", S)),
    "olist_order_items": _st(("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
                             ("price", D), ("freight_value", D)),
    "olist_order_payments": _st(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                                ("payment_installments", I), ("payment_value", D)),
    "olist_order_reviews": _st(("review_id", S), ("order_id", S), ("review_score", I),
                               ("review_comment_title", S), ("review_comment_message", S),
                               ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "olist_products": _st(("product_id", S), ("product_category_name", S), ("product_weight_g", I),
                          ("product_length_cm", I), ("product_height_cm", I), ("product_width_cm", I)),
    "olist_sellers": _st(("seller_id", S), ("seller_city", S), ("seller_state", S), ("seller_zip_code_prefix", S)),
    "olist_geolocation": _st(("geolocation_zip_code_prefix", S), ("geolocation_lat", T.DoubleType()),
                             ("geolocation_lng", T.DoubleType()), ("geolocation_city", S), ("geolocation_state", S)),
    "product_category_names": _st(("product_category_name", S), ("product_category_name_english", S)),
}

# Source file name of each raw dataset.
RAW_FILES: dict[str, str] = {
    "olist_orders": "olist_orders_dataset.csv",
    "olist_customers": "olist_customers_dataset.csv",
    "olist_order_items": "olist_order_items_dataset.csv",
    "olist_products": "olist_products_dataset.csv",
    "olist_sellers": "olist_sellers_dataset.csv",
    "olist_order_payments": "olist_order_payments_dataset.csv",
    "olist_order_reviews": "olist_order_reviews_dataset.csv",
    "olist_geolocation": "olist_geolocation_dataset.csv",
    "product_category_names": "product_category_name_translation.csv",
}


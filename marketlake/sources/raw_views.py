"""Raw marketplace datasets derived from the driver's TPC-H-like tables.

The library's builders take the nine raw datasets by name (``olist_orders`` ...).
In production these come from the streaming CSV ingest (``marketlake.streaming``);
for tests and benches this module derives them from the parquet tables with the
column mapping documented in FIXTURES.md section 2. Money is DECIMAL(18,2) so
sums are exact and order-independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import BaseTables

MONEY = "decimal(18,2)"

# The state of index 0..26.
STATES = ["SP", "RJ", "MG", "ES", "PR", "SC", "RS", "MT", "MS", "GO", "DF", "MA", "PI", "CE", "RN", "PB",
          "PE", "AL", "SE", "BA", "AM", "RR", "AP", "PA", "TO", "RO", "AC"]

# Payment type by l_partkey % 4.
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]

# Review comment by o_orderkey % 6 (index 0 = NULL).
REVIEW_MESSAGES = [None, "   ", "produto otimo, recomendo", "pessimo, chegou atrasado",
                   "produto ok", "otimo mas atrasado"]


def _k(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _state(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in STATES]), idx.cast("int") + 1)


def _secs(n: Column) -> Column:
    return F.make_dt_interval(secs=n.cast("int"))


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _purchase() -> Column:
    return F.col("o_orderdate") + _secs(F.col("o_orderkey") % 86400)


def _delivered() -> Column:
    return F.when(
        F.col("o_orderstatus") == "F",
        _purchase() + _days(F.col("o_orderkey") % 41) + _hours(F.col("o_orderkey") % 24),
    )


def olist_orders(t: BaseTables) -> DataFrame:
    o = t.orders
    return o.select(
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast("string"))
         .otherwise(_k("o", "o_orderkey")).alias("order_id"),
        _k("c", "o_orderkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
         .when(F.col("o_orderstatus") == "O", "shipped")
         .otherwise("canceled").alias("order_status"),
        _purchase().alias("order_purchase_timestamp"),
        (_purchase() + _hours(F.lit(1))).alias("order_approved_at"),
        (_delivered() - _hours(F.lit(1))).alias("order_delivered_carrier_date"),
        _delivered().alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + _days(10 + F.col("o_custkey") % 25)).alias("order_estimated_delivery_date"),
    )


def olist_customers(t: BaseTables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    return j.select(
        _k("c", "o_orderkey").alias("customer_id"),
        _k("u", "c_custkey").alias("customer_unique_id"),
        (F.col("c_custkey") % 500).alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        _state(F.col("c_nationkey")).alias("customer_state"),
    )


def olist_order_items(t: BaseTables) -> DataFrame:
    return t.lineitem.select(
        _k("o", "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _k("p", "l_partkey").alias("product_id"),
        _k("s", "l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.when(F.col("l_partkey") % 89 == 0, F.lit(None).cast(MONEY))
         .otherwise(F.col("l_quantity").cast(MONEY)).alias("freight_value"),
    )


def olist_order_payments(t: BaseTables) -> DataFrame:
    ptype = F.element_at(F.array(*[F.lit(x) for x in PAYMENT_TYPES]), (F.col("l_partkey") % 4 + 1).cast("int"))
    return t.lineitem.select(
        _k("o", "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        ptype.alias("payment_type"),
        (1 + F.col("l_suppkey") % 12).cast("int").alias("payment_installments"),
        F.col("l_extendedprice").cast(MONEY).alias("payment_value"),
    )


def olist_products(t: BaseTables) -> DataFrame:
    return t.part.select(
        _k("p", "p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.lower("p_type")).alias("product_category_name"),
        (F.col("p_size") * 100).alias("product_weight_g"),
        (F.col("p_size") + 10).alias("product_length_cm"),
        (F.col("p_size") + 5).alias("product_height_cm"),
        (F.col("p_size") + 7).alias("product_width_cm"),
    )


def product_category_names(t: BaseTables) -> DataFrame:
    return (t.part.where(F.col("p_type") != "PROMO")
            .select(F.lower("p_type").alias("product_category_name"))
            .distinct()
            .select("product_category_name",
                    F.concat("product_category_name", F.lit("_en")).alias("product_category_name_english")))


def olist_sellers(t: BaseTables) -> DataFrame:
    return t.supplier.select(
        _k("s", "s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_city"),
        _state(F.col("s_nationkey")).alias("seller_state"),
        (F.col("s_suppkey") % 500).alias("seller_zip_code_prefix"),
    )


def olist_geolocation(t: BaseTables) -> DataFrame:
    zip_ = F.col("event_id") % 450
    return t.events.select(
        zip_.alias("geolocation_zip_code_prefix"),
        (F.col("value") / 10.0 - 40).cast("double").alias("geolocation_lat"),
        (-(F.col("value") / 5.0)).cast("double").alias("geolocation_lng"),
        F.col("user_id").cast("string").alias("geolocation_city"),
        _state(zip_ % 27).alias("geolocation_state"),
    )


def olist_order_reviews(t: BaseTables) -> DataFrame:
    o = t.orders.where(F.col("o_orderstatus") == "F")
    msg = F.element_at(F.array(*[F.lit(m).cast("string") for m in REVIEW_MESSAGES]),
                       (F.col("o_orderkey") % 6 + 1).cast("int"))
    delivered = _delivered()
    return o.select(
        _k("r", "o_orderkey").alias("review_id"),
        _k("o", "o_orderkey").alias("order_id"),
        (1 + (F.col("o_orderkey") * 7) % 5).cast("int").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        msg.alias("review_comment_message"),
        (F.to_date(delivered).cast("timestamp_ntz") + _days(F.lit(1))).alias("review_creation_date"),
        (delivered + _days(F.lit(2))).alias("review_answer_timestamp"),
    )


RAW_BUILDERS = {
    "olist_orders": olist_orders,
    "olist_customers": olist_customers,
    "olist_order_items": olist_order_items,
    "olist_products": olist_products,
    "olist_sellers": olist_sellers,
    "olist_order_payments": olist_order_payments,
    "olist_order_reviews": olist_order_reviews,
    "olist_geolocation": olist_geolocation,
    "product_category_names": product_category_names,
}


class RawTables:
    """The nine raw datasets, derived lazily from the base tables under ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.base = BaseTables(spark, sf_dir)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = RAW_BUILDERS[name](self.base)
        return self._cache[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in RAW_BUILDERS}


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with texts of their own, for learning: the labelled documents as comments, whose quality label gives
    the score (1 and 2, or 4 and 5). The nine raw datasets' reviews have six messages, unrelated to their scores."""
    from .tables import read_base
    labels = read_base(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = read_base(spark, sf_dir, "documents").select("doc_id", "text")
    half = F.pmod("doc_id", F.lit(2)).cast("int")
    return docs.join(labels, "doc_id").select(
        _k("d", "doc_id").alias("review_id"), _k("d", "doc_id").alias("order_id"),
        F.when(F.col("quality") == 1, 4 + half).when(F.col("quality") == 0, 1 + half).cast("int").alias("review_score"),
        F.col("text").alias("review_comment_message"))

"""Stored mergeable states: distinct customers and sellers, and price quantiles, of any period and slice.

A day and customer state has one row with a HyperLogLog sketch of its customers and one of its sellers, a day and
category one with a KLL sketch of its prices; each row is a few kilobytes at most, whatever was sold that day. Any
period, and any set of states or categories, is a union of stored rows: no fact is scanned, and nobody who bought in
two months is counted twice, as happens when monthly counts are added. Days never change each other's rows, so a load
appends or replaces the days it brings.

Error: of a distinct count, one standard error is ``DISTINCT_ERROR``; of a quantile, the rank is off by less than
``RANK_ERROR`` with 99 % confidence. Exact counts and the exact median stay the default elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_table, write_table
from .lake import Lake

LG_K = 12  # 4,096 registers: 2 to 4 KB a sketch
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
KLL_K = 400
RANK_ERROR = 0.008


def distinct_states(lk: Lake) -> DataFrame:
    """Sketches of customers and sellers per day of purchase and customer state, with the orders they come from."""
    of_state = lk.customer_latest.select("customer_unique_id", F.coalesce("customer_state", F.lit("")).alias("estado"))
    sold = lk.fact_sales.where("date_key IS NOT NULL").select("order_id", "date_key", "customer_unique_id").join(of_state, "customer_unique_id")
    buyers = sold.groupBy("date_key", "estado").agg(F.hll_sketch_agg("customer_unique_id", F.lit(LG_K)).alias("clientes"), F.count(F.lit(1)).alias("qtd_pedidos"))
    items = sold.select("order_id", "date_key", "estado").join(lk.raw["olist_order_items"].select("order_id", "seller_id"), "order_id")
    sellers = items.groupBy("date_key", "estado").agg(F.hll_sketch_agg("seller_id", F.lit(LG_K)).alias("sellers"))
    return _by_year(buyers.join(sellers, ["date_key", "estado"], "left"))


def price_states(lk: Lake) -> DataFrame:
    """Sketches of item prices per day of purchase and category."""
    day = lk.fact_sales.where("date_key IS NOT NULL").select("order_id", "date_key")
    items = lk.fact_order_items.where("preco_produto IS NOT NULL").select("order_id", "product_id", "preco_produto")
    priced = items.join(day, "order_id").join(lk.dim_products.select("product_id", "product_category"), "product_id", "left")
    category = F.coalesce("product_category", F.lit("unknown")).alias("categoria")
    return _by_year(priced.groupBy("date_key", category).agg(
        F.kll_sketch_agg_double(F.col("preco_produto").cast("double"), F.lit(KLL_K)).alias("precos"), F.count(F.lit(1)).alias("qtd_itens")))


def _by_year(states: DataFrame) -> DataFrame:
    return states.withColumn("ano", (F.col("date_key") / 10000).cast("int"))


def store(lk: Lake, base: str, layer: str = "gold") -> None:
    """Store both tables, by year; the rows of a year are written by a few tasks. Both read the sales fact: a lake that
    computes it from raw data should hold it first (``Lake.hold``)."""
    for name, states, slice_ in (("sketch_distinct", distinct_states(lk), "estado"), ("sketch_prices", price_states(lk), "categoria")):
        write_table(states, base, layer, name, partition_by=["ano"], cluster_by=[slice_], register_table=False, files_per_partition=4)


def _period(states: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of the days first..last (yyyyMMdd); other years' files aren't read."""
    return states.where(F.col("ano").between(first // 10000, last // 10000) & F.col("date_key").between(first, last))


def _estimate(sketches: str) -> Column:
    """Members of the union; 0 where there is no sketch."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(sketches)), F.lit(0)).cast("bigint")


def distinct_in(states: DataFrame, first: int, last: int, estados: list[str] | None = None, by: list | None = None) -> DataFrame:
    """Estimated distinct customers and sellers of a period, in some states or all, per group of ``by`` or in total."""
    rows = _period(states, first, last)
    if estados is not None:
        rows = rows.where(F.col("estado").isin(estados))
    return rows.groupBy(*(by or [])).agg(_estimate("clientes").alias("clientes"), _estimate("sellers").alias("sellers"), F.sum("qtd_pedidos").alias("qtd_pedidos"))


def prices_in(states: DataFrame, first: int, last: int, quantiles: list[float], by: list | None = None) -> DataFrame:
    """Estimated price quantiles of a period, per group of ``by`` or in total."""
    merged = _period(states, first, last).groupBy(*(by or [])).agg(F.kll_merge_agg_double("precos", F.lit(KLL_K)).alias("_s"), F.sum("qtd_itens").alias("qtd_itens"))
    return merged.select(*[c for c in merged.columns if c != "_s"], *[F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(f"q{round(100 * q)}") for q in quantiles])


def stored_states(spark: SparkSession, base: str, layer: str = "gold") -> tuple[DataFrame, DataFrame]:
    return read_table(spark, base, layer, "sketch_distinct"), read_table(spark, base, layer, "sketch_prices")

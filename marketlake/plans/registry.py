"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's base tables under ``sf_dir`` (through the raw
dataset views) and returns the operator's result. Exact decimal money is
presented as DOUBLE, and averages of floating-point inputs are rounded to
6 places, so results compare across engines independent of summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import region_of_state, sla_columns
from ..operators import aggregates as agg
from . import gold
from .lake import Lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Decimal money -> DOUBLE (values are exact decimals, so the doubles are identical everywhere)."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake.from_testdata(spark, sf_dir)


# ---------------- silver ----------------

@register("geo_outlier_filter")
def q_geo_outlier_filter(spark, sf_dir):
    g = lake(spark, sf_dir).raw["olist_geolocation"]
    return agg.geo_in_bounds(g).select("geolocation_zip_code_prefix", "geolocation_lat",
                                       "geolocation_lng", "geolocation_state")


@register("geolocation_aggregated")
def q_geolocation_aggregated(spark, sf_dir):
    g = lake(spark, sf_dir).geolocation_aggregated
    return g.select("zip_code_prefix", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"),
                    "state", "regiao_brasil")


@register("region_of_state")
def q_region_of_state(spark, sf_dir):
    c = lake(spark, sf_dir).raw["olist_customers"]
    return c.groupBy("customer_state").agg(F.count(F.lit(1)).alias("qtd_clientes")).select(
        "customer_state", region_of_state("customer_state").alias("regiao_brasil"), "qtd_clientes")


@register("payments_per_order")
def q_payments_per_order(spark, sf_dir):
    return agg.payments_per_order(lake(spark, sf_dir).raw["olist_order_payments"])


@register("payments_mode_per_order")
def q_payments_mode_per_order(spark, sf_dir):
    return agg.payments_mode_per_order(lake(spark, sf_dir).raw["olist_order_payments"])


@register("items_per_order")
def q_items_per_order(spark, sf_dir):
    return present(agg.items_per_order(lake(spark, sf_dir).raw["olist_order_items"]))


@register("sla_fields")
def q_sla_fields(spark, sf_dir):
    o = lake(spark, sf_dir).raw["olist_orders"]
    return o.select("order_id", "customer_id", *[c.alias(n) for n, c in sla_columns().items()])


@register("orders_enriched")
def q_orders_enriched(spark, sf_dir):
    return present(lake(spark, sf_dir).orders_enriched)


@register("quarantine")
def q_quarantine(spark, sf_dir):
    return lake(spark, sf_dir).quarantine


@register("quarantine_rate")
def q_quarantine_rate(spark, sf_dir):
    from . import silver
    return silver.quarantine_rate(lake(spark, sf_dir).raw)


@register("reviews_enriched")
def q_reviews_enriched(spark, sf_dir):
    return lake(spark, sf_dir).reviews_enriched


@register("sentiment_learned")
def q_sentiment_learned(spark, sf_dir):
    """Sentiment learnt from review scores, for all labelled reviews, next to the lexicon's."""
    from ..functions import sentiment
    from ..sources.raw_views import labelled_reviews
    reviews = labelled_reviews(spark, sf_dir)
    message = "review_comment_message"
    scored = sentiment.learned_scorer(reviews)(sentiment.lexicon_scorer(reviews, message, "sentimento_lexico"), message, "sentimento")
    return scored.select("review_id", "review_score", sentiment.held_out().alias("fora_do_treino"), sentiment.score_label().alias("sentimento_da_nota"),
                         "sentimento", "sentimento_lexico")


# ---------------- gold ----------------

@register("dim_customers")
def q_dim_customers(spark, sf_dir):
    return lake(spark, sf_dir).dim_customers


@register("dim_sellers")
def q_dim_sellers(spark, sf_dir):
    return lake(spark, sf_dir).dim_sellers


@register("dim_products")
def q_dim_products(spark, sf_dir):
    return lake(spark, sf_dir).dim_products


@register("dim_calendar")
def q_dim_calendar(spark, sf_dir):
    return lake(spark, sf_dir).dim_calendar


@register("fact_sales")
def q_fact_sales(spark, sf_dir):
    return present(lake(spark, sf_dir).fact_sales)


@register("fact_reviews")
def q_fact_reviews(spark, sf_dir):
    return lake(spark, sf_dir).fact_reviews


@register("fact_order_items")
def q_fact_order_items(spark, sf_dir):
    return present(lake(spark, sf_dir).fact_order_items)


@register("kpi_sales_monthly")
def q_kpi_sales_monthly(spark, sf_dir):
    return present(gold.kpi_sales_monthly(lake(spark, sf_dir).fact_sales))


@register("kpi_sellers_monthly")
def q_kpi_sellers_monthly(spark, sf_dir):
    lk = lake(spark, sf_dir)
    return gold.kpi_sellers_monthly(lk.priced_orders, lk.raw["olist_order_items"])


@register("kpi_reviews_monthly")
def q_kpi_reviews_monthly(spark, sf_dir):
    return gold.kpi_reviews_monthly(lake(spark, sf_dir).fact_reviews)


@register("kpi_marketplace_monthly")
def q_kpi_marketplace_monthly(spark, sf_dir):
    return present(lake(spark, sf_dir).kpi_marketplace_monthly)


# ---------------- quality ----------------

def _silver(lk: Lake) -> dict:
    return {"geolocation_aggregated": lk.geolocation_aggregated, "orders_enriched": lk.orders_enriched,
            "reviews_enriched": lk.reviews_enriched}


def _gold(lk: Lake) -> dict:
    from .checks import GOLD_TABLES
    return {t: getattr(lk, t) for t in GOLD_TABLES}


@register("check_count")
def q_check_count(spark, sf_dir):
    from ..operators.quality import Check, table_checks, union_results
    lk = lake(spark, sf_dir)
    return union_results([table_checks(lk.raw[t], "bronze", t, [Check("non_empty")]) for t in lk.s.bronze_tables])


@register("check_null_rate")
def q_check_null_rate(spark, sf_dir):
    from ..operators.quality import Check, table_checks
    lk = lake(spark, sf_dir)
    return table_checks(lk.raw["olist_orders"], "bronze", "olist_orders", [
        Check("null_rate", "order_id", max_rate=lk.s.max_null_rate),
        Check("null_rate", "order_delivered_customer_date", max_rate=lk.s.max_null_rate, blocking=False),
        Check("not_null", "customer_id")])


@register("check_date_range")
def q_check_date_range(spark, sf_dir):
    from ..operators.quality import Check, table_checks, union_results
    lk = lake(spark, sf_dir)
    return union_results([
        table_checks(lk.raw["olist_orders"], "bronze", "olist_orders", [
            Check("date_range", "order_purchase_timestamp", lk.s.data_min_date, lk.s.data_max_date, blocking=False),
            Check("date_range", "order_delivered_customer_date", "1995-01-01", "2001-12-31", blocking=False)]),
        table_checks(lk.raw["olist_order_reviews"], "bronze", "olist_order_reviews", [
            Check("date_range", "review_creation_date", "1995-01-01", "2001-12-31", blocking=False)]),
    ])


@register("check_value_range")
def q_check_value_range(spark, sf_dir):
    from ..operators.quality import Check, table_checks, union_results
    lk = lake(spark, sf_dir)
    s = lk.s
    return union_results([
        table_checks(lk.raw["olist_geolocation"], "bronze", "olist_geolocation", [
            Check("value_range", "geolocation_lat", s.lat_min, s.lat_max, blocking=False),
            Check("value_range", "geolocation_lng", s.lng_min, s.lng_max, blocking=False)]),
        table_checks(lk.raw["olist_order_reviews"], "bronze", "olist_order_reviews", [
            Check("value_range", "review_score", s.review_score_min, s.review_score_max)]),
        table_checks(lk.orders_enriched, "silver", "orders_enriched", [
            Check("value_range", "valor_total_pedido", s.order_total_min, s.order_total_max)]),
    ])


@register("check_no_duplicates")
def q_check_no_duplicates(spark, sf_dir):
    from ..operators.quality import check_no_duplicates, union_results
    lk = lake(spark, sf_dir)
    return union_results([
        check_no_duplicates(lk.raw["olist_order_items"], "bronze", "olist_order_items", ["order_id", "order_item_id"]),
        check_no_duplicates(lk.orders_enriched, "silver", "orders_enriched", ["order_id"]),
        check_no_duplicates(lk.dim_customers, "gold", "dim_customers", ["customer_unique_id"]),
    ])


@register("check_fk_integrity")
def q_check_fk_integrity(spark, sf_dir):
    from ..operators.quality import check_fk_integrity, union_results
    lk = lake(spark, sf_dir)
    items = lk.fact_order_items
    return union_results([
        check_fk_integrity(items, lk.dim_products, "product_id", "product_id", "gold", "fact_order_items"),
        check_fk_integrity(items, lk.dim_sellers, "seller_id", "seller_id", "gold", "fact_order_items"),
        check_fk_integrity(items, lk.fact_sales, "order_id", "order_id", "gold", "fact_order_items"),
        check_fk_integrity(lk.fact_sales, lk.dim_calendar, "date_key", "date_key", "gold", "fact_sales"),
    ])


@register("check_reconciliation")
def q_check_reconciliation(spark, sf_dir):
    from ..operators.quality import check_reconciliation
    lk = lake(spark, sf_dir)
    return check_reconciliation(lk.fact_sales, "valor_total_pedido", lk.kpi_marketplace_monthly,
                                "receita_total", "gold", "kpi_marketplace_monthly")


@register("suite_bronze")
def q_suite_bronze(spark, sf_dir):
    from .checks import bronze_suite
    return bronze_suite(lake(spark, sf_dir).raw)


@register("suite_silver")
def q_suite_silver(spark, sf_dir):
    from .checks import silver_suite
    lk = lake(spark, sf_dir)
    return silver_suite(lk.raw, _silver(lk))


@register("suite_gold")
def q_suite_gold(spark, sf_dir):
    from .checks import gold_suite
    return gold_suite(_gold(lake(spark, sf_dir)))


# ---------------- dimensional modelling ----------------

def _round_geo(df: DataFrame) -> DataFrame:
    return df.withColumns({"lat": F.round("lat", 6), "lng": F.round("lng", 6)})


@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    from ..operators.modeling import surrogate_key
    d = lake(spark, sf_dir).dim_customers.select("customer_unique_id")
    return surrogate_key(d, "customer_unique_id", "customer_key")


@register("fk_or_unknown")
def q_fk_or_unknown(spark, sf_dir):
    from ..operators.joins import KeyLookup
    lk = lake(spark, sf_dir)
    look = KeyLookup.of(lk.dim_customers_keyed, "customer_unique_id", "customer_key", unique=True, source=lk.raw["olist_customers"])
    return look.resolve(lk.fact_sales.select("order_id", "customer_unique_id"))


@register("dim_customers_keyed")
def q_dim_customers_keyed(spark, sf_dir):
    return _round_geo(lake(spark, sf_dir).dim_customers_keyed)


@register("dim_sellers_keyed")
def q_dim_sellers_keyed(spark, sf_dir):
    return _round_geo(lake(spark, sf_dir).dim_sellers_keyed)


@register("dim_products_keyed")
def q_dim_products_keyed(spark, sf_dir):
    return lake(spark, sf_dir).dim_products_keyed


@register("unknown_member")
def q_unknown_member(spark, sf_dir):
    """The Unknown rows of the three keyed dimensions (built from their data-derived schemas)."""
    lk = lake(spark, sf_dir)
    parts = [(lk.dim_customers_keyed, "customer_key", "customer_unique_id"),
             (lk.dim_products_keyed, "product_key", "product_id"),
             (lk.dim_sellers_keyed, "seller_key", "seller_id")]
    out = None
    for df, key, biz in parts:
        u = df.where(F.col(key) == -1).select(F.lit(key).alias("dimension"), F.col(key).alias("member_key"),
                                              F.col(biz).alias("business_key"))
        out = u if out is None else out.unionByName(u)
    return out


@register("reviews_context")
def q_reviews_context(spark, sf_dir):
    return lake(spark, sf_dir).reviews_context


@register("fact_sales_item")
def q_fact_sales_item(spark, sf_dir):
    return present(lake(spark, sf_dir).fact_sales_item)


@register("fact_reviews_keyed")
def q_fact_reviews_keyed(spark, sf_dir):
    return lake(spark, sf_dir).fact_reviews_keyed


@register("dim_time_pt")
def q_dim_time_pt(spark, sf_dir):
    return gold.dim_time_pt(gold.order_date_bounds(lake(spark, sf_dir).orders_enriched))


@register("suite_gold_keyed")
def q_suite_gold_keyed(spark, sf_dir):
    from .checks import gold_suite
    lk = lake(spark, sf_dir)
    return gold_suite({**_gold(lk), **_staged_star(lk, ("fact_sales_item",))})


def _staged_star(lk: Lake, facts: tuple[str, ...]) -> dict[str, DataFrame]:
    """The keyed dimensions and facts, each computed once and read by all its checks; the facts are built
    on the staged dimensions."""
    from ..session import stage
    out = {}
    for t in ("dim_customers_keyed", "dim_products_keyed", "dim_sellers_keyed", *facts):
        lk.__dict__[t] = out[t] = stage(getattr(lk, t), t)
    return out


@register("suite_star_keyed")
def q_suite_star_keyed(spark, sf_dir):
    """Documented checks of the keyed star: keys, Unknown members, FKs of both facts, items left out."""
    from .checks import star_suite
    lk = lake(spark, sf_dir)
    return star_suite({"dim_calendar": lk.dim_calendar, **_staged_star(lk, ("fact_sales_item", "fact_reviews_keyed"))},
                      lk.raw["olist_order_items"], lk.orders_sla)


@register("dim_time_documented")
def q_dim_time_documented(spark, sf_dir):
    """The calendar of the documented period, with the orders bought on each day."""
    return gold.dim_time_documented(lake(spark, sf_dir).raw["olist_orders"])


@register("surrogate_key_nulls")
def q_surrogate_key_nulls(spark, sf_dir):
    """Surrogate keys of a business key that is NULL in one row: every row gets a key."""
    from ..operators.modeling import surrogate_key
    return surrogate_key(lake(spark, sf_dir).raw["olist_orders"].select("order_id").distinct(), "order_id", "order_key")


def _two_key_loads(spark, lk: Lake):
    """Customers numbered in two loads: those with an order before 1996, then all; the second load is repeated."""
    from ..operators.key_map import KeyMap
    from ..session import scratch_path
    early = lk.raw["olist_orders"].where(F.col("order_purchase_timestamp") < F.lit("1996-01-01").cast("timestamp_ntz"))
    first = lk.raw["olist_customers"].join(early.select("customer_id"), "customer_id", "left_semi")
    keys = KeyMap(spark, scratch_path(spark, "keys"), "customer_unique_id", "customer_key")
    keys.assign(first, "1995")
    for _ in range(2):
        keys.assign(lk.raw["olist_customers"], "2000")
    return keys


@register("surrogate_key_second_load")
def q_surrogate_key_second_load(spark, sf_dir):
    """M1: keys of a first load stay, new business keys come above them, a repeated load gives none."""
    return _two_key_loads(spark, lake(spark, sf_dir)).pairs()


@register("fk_stored_keys")
def q_fk_stored_keys(spark, sf_dir):
    """Orders resolved through the stored keys of two loads."""
    lk = lake(spark, sf_dir)
    return _two_key_loads(spark, lk).lookup().resolve(lk.fact_sales.select("order_id", "customer_unique_id"))


@register("median_scale")
def q_median_scale(spark, sf_dir):
    """Exact median of a decimal with four places: the discount of every item, per return flag."""
    from ..operators.quantiles import exact_median
    from ..sources.tables import read_base
    li = read_base(spark, sf_dir, "lineitem").select("l_returnflag", (
        F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,4)").alias("desconto"))
    return exact_median(li, "l_returnflag", "desconto", out="desconto_mediano").withColumn("desconto_mediano", F.round("desconto_mediano", 6))


# ---------------- business queries ----------------
from . import analytics as A  # noqa: E402


def _analytic(name: str, fn, **kw):
    def q(spark, sf_dir):
        return present(fn(lake(spark, sf_dir), **kw))
    q.__name__ = f"q_{name}"
    register(name)(q)


for _name, _fn, _kw in [
    ("delivery_by_state", A.delivery_by_state, {}),
    ("cancel_rate_by_period", A.cancel_rate_by_period, {}),
    ("on_time_overall", A.on_time_overall, {}),
    ("revenue_by_quarter", A.revenue_by_quarter, {}),
    ("revenue_growth", A.revenue_growth, {}),
    ("ticket_by_category", A.ticket_by_category, {}),
    ("installment_share", A.installment_share, {}),
    ("seller_ranking", A.seller_ranking, {}),
    ("same_state_delivery", A.same_state_delivery, {}),
    ("nps_by_category", A.nps_by_category, {}),
    ("nps_best_worst", A.nps_best_worst, {}),
    ("delay_score_corr", A.delay_score_corr, {}),
    ("score_by_punctuality", A.score_by_punctuality, {}),
    ("top_categories", A.top_categories, {}),
    ("payment_mix", A.payment_mix, {}),
    ("sla_light_by_state", A.sla_light_by_state, {}),
    ("top_delay_states", A.top_delay_states, {}),
    ("delivery_scatter", A.delivery_scatter, {}),
    ("delivery_histogram", A.delivery_histogram, {}),
    ("seller_revenue_nps", A.seller_revenue_nps, {}),
    ("executive_cards", A.executive_cards, {}),
    ("revenue_by_year", A.revenue_by_year, {}),
    ("revenue_in_year", A.revenue_in_year, {"year": 1996}),
    ("top_sellers_in_region", A.top_sellers_in_region, {}),
    ("category_sku_count", A.category_sku_count, {}),
    ("share_by_state", A.share_by_state, {}),
    ("sliced_kpis", A.sliced_kpis, {"period": (199601, 199712), "state": "SP"}),
]:
    _analytic(_name, _fn, **_kw)


# ---------------- streaming ingest and incremental upsert ----------------

def _ingest_roundtrip(spark, sf_dir, table: str, runs: int, split: bool = False) -> DataFrame:
    """Write a raw table to CSV files in a fresh landing folder under the shared folder,
    stream-ingest it ``runs`` times with one checkpoint, return the ingested rows."""
    src = lake(spark, sf_dir).raw[table]
    if not split:
        return _ingest(spark, src.schema, [src], runs)[0]
    # two deliveries: the second file set arrives after the first ingest
    early = F.col("order_purchase_timestamp") < F.lit("1998-01-01")
    return _ingest(spark, src.schema, [src.where(early), src.where(~early | F.col("order_purchase_timestamp").isNull())], runs)[0]


def _ingest(spark, schema, deliveries: list[DataFrame], runs: int = 1) -> tuple[DataFrame, DataFrame]:
    """Deliver frames as CSV one after the other, ingesting after each (and ``runs`` times at the end);
    returns the table's data columns and the whole table."""
    from ..session import scratch_path
    from ..sources.files import read_path
    from ..streaming.ingest import data_columns, ingest_csv, write_landing_csv
    root = scratch_path(spark, "ingest")
    landing, out, ckpt = f"{root}/landing", f"{root}/table", f"{root}/checkpoint"
    for i, frame in enumerate(deliveries):
        write_landing_csv(frame, f"{landing}/batch{i}")
        for _ in range(1 if i < len(deliveries) - 1 else runs):
            ingest_csv(spark, landing, "*.csv", out, ckpt, schema, recursive=True)
    whole = read_path(spark, out)
    return data_columns(whole), whole


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sellers, and two deliveries of them."""
    src = lake(spark, sf_dir).raw["olist_sellers"]
    first = F.substring("seller_id", -1, 1).cast("int") < 5
    return src, src.where(first), src.where(~first)


@register("csv_reordered_columns")
def q_csv_reordered_columns(spark, sf_dir):
    """A second delivery has the same columns in the opposite order: they are found by name."""
    src, a, b = _halves(spark, sf_dir)
    return _ingest(spark, src.schema, [a, b.select(*reversed(src.columns))])[0]


@register("csv_new_column")
def q_csv_new_column(spark, sf_dir):
    """A second delivery brings a column that isn't declared: it is added, and NULL in earlier rows."""
    src, a, b = _halves(spark, sf_dir)
    return _ingest(spark, src.schema, [a, b.select(F.concat(F.lit("canal "), "seller_state").alias("canal"), *src.columns)])[0].select(*src.columns, "canal")


@register("csv_ingest_metadata")
def q_csv_ingest_metadata(spark, sf_dir):
    """Ingestion time and source file of every row; records that don't parse."""
    src = lake(spark, sf_dir).raw["olist_sellers"]
    whole = _ingest(spark, src.schema, [src])[1]
    return whole.groupBy("seller_state").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("_source_file").endswith(".csv")).alias("com_arquivo"),
        F.count_if(F.col("_ingestion_timestamp") <= F.current_timestamp()).alias("com_horario"), F.count("_corrupt_record").alias("corrompidas"))


@register("append_added_column")
def q_append_added_column(spark, sf_dir):
    """A stored table gets rows with one more column; earlier rows read as NULL."""
    from ..session import scratch_path
    from ..sources.files import read_table, write_table
    src, a, b = _halves(spark, sf_dir)
    base = scratch_path(spark, "append")
    write_table(a, base, "silver", "sellers", register_table=False)
    write_table(b.withColumn("motivo", F.concat(F.lit("lote 2 "), "seller_state")), base, "silver", "sellers", mode="append", register_table=False)
    return read_table(spark, base, "silver", "sellers", merge_schema=True).select(*src.columns, "motivo")


@register("upsert_moved_partition")
def q_upsert_moved_partition(spark, sf_dir):
    """Canceled orders move to the next year's partition; no copy stays in the old one."""
    from ..session import scratch_path
    from ..sources.files import read_table, upsert_partitions, write_table
    o = lake(spark, sf_dir).raw["olist_orders"].where(F.col("order_id").isNotNull()).select(
        "order_id", "order_status", F.lit(0).alias("versao"), F.year("order_purchase_timestamp").alias("ano"))
    base = scratch_path(spark, "moved")
    write_table(o, base, "gold", "pedidos", partition_by=["ano"], register_table=False)
    moved = o.where(F.col("order_status") == "canceled").withColumns({"ano": F.col("ano") + 1, "versao": F.lit(1)})
    upsert_partitions(moved, base, "gold", "pedidos", ["order_id"], "versao", ["ano"])
    return read_table(spark, base, "gold", "pedidos").select("order_id", "order_status", "versao", "ano")


def _kpi_changes(lk: Lake) -> list[dict[str, DataFrame]]:
    """Two change sets: orders bought before 2001 and all items first (later items wait for their orders); then the
    orders of 2001, and of 1996 cancellations, orders that move by 40 days, items taken back, and reviews that change
    to one star."""
    from .incremental import signed
    raw = lk.raw
    orders, items, reviews = raw["olist_orders"], raw["olist_order_items"], raw["olist_order_reviews"]
    year = lambda c: F.coalesce(F.year(c), F.lit(0))
    of = lambda rest: F.coalesce(F.substring("order_id", 2, 20).cast("bigint") % 100 == rest, F.lit(False))
    bought, rated = year("order_purchase_timestamp"), year("review_creation_date")
    late, late_review = bought >= 2001, rated >= 2001
    canceled, moved, starred = of(7) & (bought == 1996), of(13) & (bought == 1996), of(33) & (rated == 1996)
    first = {"olist_orders": signed(orders.where(~late), 1), "olist_order_items": signed(items, 1),
             "olist_order_payments": signed(raw["olist_order_payments"], 1), "olist_order_reviews": signed(reviews.where(~late_review), 1)}
    now = orders.where(late | canceled | moved).withColumns({
        "order_status": F.when(canceled, "canceled").otherwise(F.col("order_status")),
        "order_purchase_timestamp": F.when(moved, F.col("order_purchase_timestamp") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("order_purchase_timestamp"))})
    back = items.where(of(21) & (F.col("order_item_id") == 1)).join(orders.where(bought == 1996).select("order_id"), "order_id", "left_semi")
    one_star = reviews.where(late_review | starred).withColumn("review_score", F.when(starred, 1).otherwise(F.col("review_score")))
    second = {"olist_orders": signed(now, 1).unionByName(signed(orders.where(canceled | moved), -1)),
              "olist_order_items": signed(back, -1),
              "olist_order_reviews": signed(one_star, 1).unionByName(signed(reviews.where(starred), -1))}
    return [first, second]


@register("kpi_incremental")
def q_kpi_incremental(spark, sf_dir):
    """B12 after two change sets with retractions: equal to a full refresh over the changed raw data."""
    from ..session import scratch_path
    from .incremental import IncrementalLake
    lk = lake(spark, sf_dir)
    inc = IncrementalLake(spark, scratch_path(spark, "incremental"))
    for changes in _kpi_changes(lk):
        inc.apply(changes, lk.raw["olist_customers"])
    return present(inc.kpi())


def _stored_sketches(spark, lk: Lake):
    from ..session import scratch_path
    from . import sketches
    base = scratch_path(spark, "sketches")
    # read by both tables and by the exact figures beside them
    lk.hold("fact_sales", ["order_id", "date_key", "customer_unique_id"])
    lk.hold("customer_latest", ["customer_unique_id", "customer_state"])
    sketches.store(lk, base)
    return sketches.stored_states(spark, base)


@register("distinct_sketch_quarters")
def q_distinct_sketch_quarters(spark, sf_dir):
    """Distinct customers and sellers per quarter and state from stored daily sketches, next to the exact
    counts; whether they agree within four standard errors."""
    from . import sketches
    lk = lake(spark, sf_dir)
    states, _ = _stored_sketches(spark, lk)
    quarter = ((F.col("date_key") / 10000).cast("int") * 10 + F.ceil((F.col("date_key") / 100 % 100).cast("int") / 3).cast("int")).alias("ano_trimestre")
    estimated = sketches.distinct_in(states, 19960101, 19971231, by=[quarter, F.col("estado")])
    of_state = lk.customer_latest.select("customer_unique_id", F.col("customer_state").alias("estado"))
    sold = lk.fact_sales.where("date_key BETWEEN 19960101 AND 19971231").join(of_state, "customer_unique_id")
    sellers = sold.join(lk.raw["olist_order_items"].select("order_id", "seller_id"), "order_id")
    exact = (sold.groupBy(quarter, "estado").agg(F.count_distinct("customer_unique_id").alias("_c"))
             .join(sellers.groupBy(quarter, "estado").agg(F.count_distinct("seller_id").alias("_s")), ["ano_trimestre", "estado"], "left"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), 4 * sketches.DISTINCT_ERROR * F.col(b))
    return estimated.join(exact, ["ano_trimestre", "estado"], "full").select(
        "ano_trimestre", "estado", "qtd_pedidos", F.col("_c").alias("clientes_exatos"), F.col("_s").alias("sellers_exatos"),
        near("clientes", "_c").alias("clientes_no_limite"), near("sellers", "_s").alias("sellers_no_limite"))


@register("price_sketch_by_category")
def q_price_sketch_by_category(spark, sf_dir):
    """Median and 90th percentile price per category from stored daily sketches: whether their exact ranks
    are within the rank error."""
    from . import sketches
    lk = lake(spark, sf_dir)
    _, states = _stored_sketches(spark, lk)
    q = sketches.prices_in(states, 19960101, 19971231, [0.5, 0.9], by=["categoria"])
    day = lk.fact_sales.where("date_key BETWEEN 19960101 AND 19971231").select("order_id")
    items = lk.fact_order_items.where("preco_produto IS NOT NULL").join(day, "order_id").join(lk.dim_products, "product_id", "left")
    ranked = items.select(F.coalesce("product_category", F.lit("unknown")).alias("categoria"), F.col("preco_produto").cast("double").alias("p")).join(q, "categoria")
    rank = lambda c: F.count_if(F.col("p") < F.col(c)) / F.count(F.lit(1)).cast("double")
    upto = lambda c: F.count_if(F.col("p") <= F.col(c)) / F.count(F.lit(1)).cast("double")
    within = lambda c, at: (rank(c) <= at + 2 * sketches.RANK_ERROR) & (upto(c) >= at - 2 * sketches.RANK_ERROR)
    return ranked.groupBy("categoria").agg(F.max("qtd_itens").alias("qtd_itens"), within("q50", 0.5).alias("mediana_no_limite"), within("q90", 0.9).alias("p90_no_limite"))


@register("orders_priced_bucketed")
def q_orders_priced_bucketed(spark, sf_dir):
    """Orders with payments and items, joined from tables stored by buckets of the order id."""
    import uuid
    from ..session import scratch_path
    from ..sources.buckets import write_orders
    from . import silver
    raw = write_orders(lake(spark, sf_dir).raw, scratch_path(spark, "buckets"), f"buckets_{uuid.uuid4().hex[:8]}", 8)
    return present(silver.orders_priced(raw).select(
        "order_id", "order_status", "valor_total_pedido", "quantidade_itens", "forma_pagamento_principal", "max_parcelas", "dias_para_entrega", "entregue_no_prazo"))


@register("delivery_scatter_binned")
def q_delivery_scatter_binned(spark, sf_dir):
    """N16 as a grid of bounded size: orders per cell of actual and estimated days."""
    return A.delivery_scatter_binned(lake(spark, sf_dir), 5, 60)


def sliceable_items(lk: Lake) -> DataFrame:
    """Items with the columns that dashboards slice by: month, customer state, seller state, category."""
    day = lk.fact_sales.select("order_id", "customer_unique_id", (F.col("date_key") / 100).cast("int").alias("ano_mes"))
    state = lk.customer_latest.select("customer_unique_id", F.col("customer_state").alias("estado_cliente"))
    seller = lk.raw["olist_sellers"].select("seller_id", F.col("seller_state").alias("estado_vendedor"))
    category = lk.dim_products.select("product_id", F.col("product_category").alias("categoria"))
    return (lk.fact_order_items.join(day, "order_id").join(state, "customer_unique_id").join(seller, "seller_id").join(category, "product_id")
            .select("order_id", "order_item_id", "preco_produto", "ano_mes", "estado_cliente", "estado_vendedor", "categoria"))


@register("clustered_slices")
def q_clustered_slices(spark, sf_dir):
    """Items stored in Morton order over month, both states and category; one state and one category of them."""
    from ..session import scratch_path
    from ..sources.clustering import write_clustered
    from ..sources.files import read_table
    base = scratch_path(spark, "clustered")
    write_clustered(sliceable_items(lake(spark, sf_dir)), base, "gold", "itens", ["categoria", "estado_cliente", "ano_mes", "estado_vendedor"], "order_id", 32)
    items = read_table(spark, base, "gold", "itens").where("estado_cliente = 'SP' AND categoria = 'economy_en'")
    return items.groupBy("ano_mes").agg(F.count(F.lit(1)).alias("qtd_itens"), F.sum("preco_produto").cast("double").alias("preco_total"))


@register("quality_log")
def q_quality_log(spark, sf_dir):
    """Q8: the log rows of the bronze suite (without the time of the check)."""
    from ..operators.quality import log_frame
    from .checks import bronze_suite
    return log_frame(bronze_suite(lake(spark, sf_dir).raw), "run-1").drop("checked_at")


@register("partitioned_fact_month")
def q_partitioned_fact_month(spark, sf_dir):
    """The fact stored by year and month, written and read back."""
    from ..session import scratch_path
    from ..sources.files import read_table, write_table
    f = lake(spark, sf_dir).fact_sales.withColumns({"ano": (F.col("date_key") / 10000).cast("int"), "mes": (F.col("date_key") / 100 % 100).cast("int")})
    base = scratch_path(spark, "fact")
    write_table(f, base, "gold", "fact_sales", partition_by=["ano", "mes"], cluster_by=["order_id"], register_table=False, files_per_partition=1)
    return present(read_table(spark, base, "gold", "fact_sales"))


@register("csv_stream_ingest")
def q_csv_stream_ingest(spark, sf_dir):
    return present(_ingest_roundtrip(spark, sf_dir, "olist_order_reviews", runs=1))


@register("csv_ingest_rerun")
def q_csv_ingest_rerun(spark, sf_dir):
    """Exactly-once: a second delivery is appended once and a re-run over the same files adds nothing."""
    return present(_ingest_roundtrip(spark, sf_dir, "olist_orders", runs=2, split=True))


@register("upsert_latest")
def q_upsert_latest(spark, sf_dir):
    """SCD1 refresh of the person record: snapshot from orders before the load date, changes
    from orders on or after it; the most recent purchase's record wins."""
    from ..sources.files import dedupe_latest, upsert_latest
    lk = lake(spark, sf_dir)
    o = lk.raw["olist_orders"].select("customer_id", "order_purchase_timestamp")
    c = lk.raw["olist_customers"].join(o, "customer_id")
    cols = ["customer_unique_id", "customer_id", "customer_city", "customer_state",
            "customer_zip_code_prefix", "order_purchase_timestamp"]
    cutoff = F.lit("1998-01-01").cast("timestamp_ntz")
    before = c.where(F.col("order_purchase_timestamp") < cutoff).select(*cols)
    snapshot = dedupe_latest(before, ["customer_unique_id"],
                             [F.col("order_purchase_timestamp").desc_nulls_last(), F.col("customer_id").desc_nulls_last()])
    changes = c.where(F.col("order_purchase_timestamp") >= cutoff).select(*cols)
    return upsert_latest(snapshot, changes, ["customer_unique_id"], "order_purchase_timestamp", ["customer_id"])


@register("check_expected_volume")
def q_check_expected_volume(spark, sf_dir):
    """Q16: raw volumes against the documented counts (logged, not blocking)."""
    from ..config import EXPECTED_COUNTS
    from ..operators.quality import Check, table_checks, union_results
    lk = lake(spark, sf_dir)
    return union_results([table_checks(lk.raw[t], "bronze", t, [Check("expected_count", lo=n, blocking=False)])
                          for t, n in EXPECTED_COUNTS.items()])


# ---------------- documented variants ----------------

@register("quarantine_documented")
def q_quarantine_documented(spark, sf_dir):
    """Documented rule list (NULL order_id or NULL customer_id), first failing rule's reason."""
    from . import silver
    return silver.quarantine(lake(spark, sf_dir).raw, silver.ORDER_RULES_DOC)


@register("orders_enriched_most_frequent")
def q_orders_enriched_most_frequent(spark, sf_dir):
    """Documented main payment type = the order's most frequent type (ties -> smallest name)."""
    from . import silver
    return present(silver.orders_enriched(lake(spark, sf_dir).raw, payment_rule="most_frequent"))

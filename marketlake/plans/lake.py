"""``Lake``: the raw datasets plus lazily built, memoised silver and gold DataFrames.

Nothing here runs a Spark job by itself except the size checks of lookups; every
property is a lazy DataFrame that Catalyst optimises as one plan with its consumers.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT, Settings
from ..session import stage
from . import gold, silver


class Lake:
    def __init__(self, raw: Mapping[str, DataFrame], settings: Settings = DEFAULT,
                 materialize_lookups: bool = True):
        self.raw = raw
        self.s = settings
        self.materialize_lookups = materialize_lookups

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Lake":
        from ..sources.raw_views import RawTables
        return cls(RawTables(spark, sf_dir), **kw)

    @classmethod
    def from_tables(cls, spark: SparkSession, base: str, layer: str = "bronze", **kw) -> "Lake":
        """Raw datasets stored by the bronze ingest under ``base/<layer>/<table>``."""
        from ..sources.files import read_table
        s = kw.get("settings", DEFAULT)
        return cls({t: read_table(spark, base, layer, t) for t in s.bronze_tables}, **kw)

    def hold(self, name: str, columns: list[str]) -> None:
        """Compute some columns of a frame once, into the shared folder, for a job that reads it several times.
        The lake's property then is that frame, with those columns alone."""
        setattr(self, name, stage(getattr(self, name).select(*columns), name))

    # silver
    @cached_property
    def geolocation_aggregated(self) -> DataFrame:
        return silver.geolocation_aggregated(self.raw, self.s)

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return silver.orders_enriched(self.raw)

    @cached_property
    def orders_sla(self) -> DataFrame:
        return silver.orders_sla(self.raw)

    @cached_property
    def quarantine(self) -> DataFrame:
        return silver.quarantine(self.raw)

    @cached_property
    def reviews_enriched(self) -> DataFrame:
        return silver.reviews_enriched(self.raw)

    # gold
    @cached_property
    def geo_lookup(self) -> DataFrame:
        """Size-checked (and, in-plan, materialised) zip lookup shared by all dimensions."""
        return gold.geo_lookup(self.geolocation_aggregated, self.materialize_lookups)

    @cached_property
    def customer_latest(self) -> DataFrame:
        """Latest record per person without the region lookup (for state-level analytics)."""
        return gold.customer_latest(self.raw["olist_customers"])

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.customer_latest, self.geo_lookup, latest_done=True)

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return gold.dim_sellers(self.raw["olist_sellers"], self.geo_lookup)

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.raw["olist_products"], self.raw["product_category_names"])

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return gold.dim_calendar(self.orders_enriched, self.s)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_sales(self.orders_enriched)

    @cached_property
    def priced_orders(self) -> DataFrame:
        """``fact_sales`` without its customer: no customer join for queries that don't use one."""
        return gold.priced_orders(silver.orders_priced(self.raw))

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return gold.fact_reviews(self.reviews_enriched)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return gold.fact_order_items(self.raw["olist_order_items"])

    @cached_property
    def kpi_marketplace_monthly(self) -> DataFrame:
        return gold.kpi_marketplace_monthly(self.fact_sales, self.fact_reviews, self.raw["olist_order_items"],
                                            priced_orders_df=self.priced_orders)

    # documented extensions
    @cached_property
    def reviews_context(self) -> DataFrame:
        r = self.raw
        return gold.reviews_context(self.reviews_enriched, self.orders_sla, r["olist_order_items"],
                                    r["olist_products"], r["olist_sellers"], r["product_category_names"])

    @cached_property
    def dim_customers_keyed(self) -> DataFrame:
        return gold.dim_customers_keyed(self.dim_customers, self.geo_lookup, self.s)

    @cached_property
    def dim_sellers_keyed(self) -> DataFrame:
        return gold.dim_sellers_keyed(self.dim_sellers, self.geo_lookup, self.s)

    @cached_property
    def dim_products_keyed(self) -> DataFrame:
        return gold.dim_products_keyed(self.raw["olist_products"], self.raw["product_category_names"], self.s)

    @cached_property
    def fact_sales_item(self) -> DataFrame:
        return gold.fact_sales_item(self.raw["olist_order_items"], self.orders_enriched,
                                    self.dim_customers_keyed, self.dim_products_keyed, self.dim_sellers_keyed,
                                    self.key_sources)

    @cached_property
    def fact_reviews_keyed(self) -> DataFrame:
        return gold.fact_reviews_keyed(self.reviews_context, self.orders_enriched, self.dim_customers_keyed,
                                       self.dim_products_keyed, self.dim_sellers_keyed, self.key_sources)

    @cached_property
    def key_sources(self) -> dict[str, DataFrame]:
        """Stored tables that hold the business keys of the keyed dimensions."""
        r = self.raw
        return {"customer": r["olist_customers"], "product": r["olist_products"], "seller": r["olist_sellers"]}


class StoredLake(Lake):
    """Silver and gold frames read from a pipeline run's stored tables (what dashboards query).

    Same properties as ``Lake``, so every analytics function runs unchanged on the stored
    star. ``fact_sales`` and ``fact_sales_item`` keep their partition columns ``ano`` and ``mes``, on which
    period filters prune. The keyed star is read when the run stored it (``documented=True``), else built.
    """

    def __init__(self, spark: SparkSession, base: str, settings: Settings = DEFAULT):
        from ..sources.files import read_table
        self._spark, self._base = spark, base
        self._read = lambda layer, name: read_table(spark, base, layer, name)
        raw = {t: self._read(settings.bronze, t) for t in settings.bronze_tables}
        super().__init__(raw, settings, materialize_lookups=False)

    def _silver(self, name: str) -> DataFrame:
        return self._read(self.s.silver, name)

    def _gold(self, name: str) -> DataFrame:
        return self._read(self.s.gold, name)

    @cached_property
    def geolocation_aggregated(self) -> DataFrame:
        return self._silver("geolocation_aggregated")

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return self._silver("orders_enriched")

    @cached_property
    def reviews_enriched(self) -> DataFrame:
        return self._silver("reviews_enriched")

    @cached_property
    def customer_latest(self) -> DataFrame:
        return self._gold("dim_customers")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._gold("dim_customers")

    @cached_property
    def dim_sellers(self) -> DataFrame:
        return self._gold("dim_sellers")

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._gold("dim_products")

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return self._gold("dim_calendar")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._gold("fact_sales")

    @cached_property
    def priced_orders(self) -> DataFrame:
        return self.fact_sales

    def _stored_or(self, name: str, build) -> DataFrame:
        from ..sources.files import table_exists, table_path
        return self._gold(name) if table_exists(self._spark, table_path(self._base, self.s.gold, name)) else build(self)

    @cached_property
    def dim_customers_keyed(self) -> DataFrame:
        return self._stored_or("dim_customers_keyed", Lake.dim_customers_keyed.func)

    @cached_property
    def dim_sellers_keyed(self) -> DataFrame:
        return self._stored_or("dim_sellers_keyed", Lake.dim_sellers_keyed.func)

    @cached_property
    def dim_products_keyed(self) -> DataFrame:
        return self._stored_or("dim_products_keyed", Lake.dim_products_keyed.func)

    @cached_property
    def fact_sales_item(self) -> DataFrame:
        return self._stored_or("fact_sales_item", Lake.fact_sales_item.func)

    @cached_property
    def reviews_context(self) -> DataFrame:
        return self._stored_or("reviews_context", Lake.reviews_context.func)

    @cached_property
    def fact_reviews_keyed(self) -> DataFrame:
        return self._stored_or("fact_reviews_keyed", Lake.fact_reviews_keyed.func)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return self._gold("fact_reviews")

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return self._gold("fact_order_items")

    @cached_property
    def kpi_marketplace_monthly(self) -> DataFrame:
        return self._gold("kpi_marketplace_monthly")

"""Scans of the driver's parquet tables (S8). Column pruning and filters reach the scan via Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class BaseTables:
    """Lazy accessor: ``t.orders`` reads ``<sf_dir>/orders.parquet`` once per instance."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in BASE_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_base(self.spark, self.sf_dir, name)
        return self._cache[name]

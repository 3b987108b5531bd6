"""Co-bucketed tables (J1-J3, J7, J12): orders, items and payments stored by buckets of ``order_id``.

A table is written with Spark's own bucketing: rows are dealt by the hash of the key to a fixed number of buckets, one
sorted file each. Tables with the same number of buckets are joined and aggregated on the key without a shuffle, as
each task reads the same bucket of all of them; the one shuffle is paid when a table is written. The specification is
kept beside the data, so another session takes the table up again without reading it.

Choose the number of buckets for the largest table, so that a bucket is a few hundred megabytes. A bucket is one
task's share: keys must not be hot (an order has a bounded number of items). Rows without a key are all in one bucket;
leave them out where they may be many.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import _catalog_location, _normalise, table_path, write_small_text
from .snapshots import read_small_text

ORDER_TABLES = ("olist_orders", "olist_order_items", "olist_order_payments")


def write_bucketed(df: DataFrame, base: str, layer: str, name: str, key: str, buckets: int) -> DataFrame:
    """Full refresh of a bucketed table; the table as it is read back."""
    spark = df.sparkSession
    path = table_path(base, layer, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    # dealt as the buckets are, so each is written by one task as one file
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(f"{layer}.{name}"))
    write_small_text(spark, f"{path}/_buckets.json", json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()}))
    return spark.table(f"{layer}.{name}")


def read_bucketed(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """A bucketed table, entered in the catalog of this session first if it isn't there."""
    path = table_path(base, layer, name)
    fq = f"{layer}.{name}"
    if _catalog_location(spark, fq) != _normalise(path):
        text = read_small_text(spark, f"{path}/_buckets.json")
        if text is None:
            raise FileNotFoundError(f"{path} has no specification of its buckets")
        spec = json.loads(text)
        from pyspark.sql import types as T
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(spec["schema"]).fields)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        spark.sql(f"DROP TABLE IF EXISTS {fq}")
        spark.sql(f"CREATE TABLE {fq} ({columns}) USING parquet CLUSTERED BY (`{spec['key']}`) SORTED BY (`{spec['key']}`) "
                  f"INTO {spec['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(fq)


def write_orders(raw: Mapping[str, DataFrame], base: str, layer: str, buckets: int) -> dict[str, DataFrame]:
    """Orders, items and payments by buckets of their order; rows without an order id are in no join and are left out."""
    return {t: write_bucketed(raw[t].where(F.col("order_id").isNotNull()), base, layer, t, "order_id", buckets) for t in ORDER_TABLES}

"""Hot keys: a third of the orders share one customer id and a third of the items one order.

AQE's skew thresholds are lowered so the skew-join split really happens on this small data;
results must equal the same plan without skew handling and a brute-force count.
"""

from pyspark.sql import functions as F

from marketlake.operators.aggregates import items_per_order
from marketlake.plans import silver
from marketlake.sources.raw_views import RawTables
from tests.conftest import SF_ORACLE

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _skewed_raw(spark):
    raw = dict(RawTables(spark, SF_ORACLE).as_dict())
    o = raw["olist_orders"]
    hot = F.substring(F.col("customer_id"), 2, 10).cast("long") % 3 == 0
    raw["olist_orders"] = o.withColumn("customer_id", F.when(hot, F.lit("c_hot")).otherwise(F.col("customer_id")))
    c = raw["olist_customers"]
    # one existing customer row becomes the hot customer (its own order then has no match)
    raw["olist_customers"] = c.withColumn(
        "customer_id", F.when(F.col("customer_id") == "c1", F.lit("c_hot")).otherwise(F.col("customer_id")))
    i = raw["olist_order_items"]
    raw["olist_order_items"] = i.withColumn(
        "order_id", F.when(F.col("order_item_id") % 3 == 0, F.lit("o1")).otherwise(F.col("order_id")))
    return raw


def _collect(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hot_keys_give_same_results_with_skew_splitting(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    raw = _skewed_raw(spark)
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = silver.orders_enriched(raw)
        skewed = _collect(df)
        plan = df._jdf.queryExecution().executedPlan().toString()
        items = _collect(items_per_order(raw["olist_order_items"]))
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        plain = _collect(silver.orders_enriched(raw))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "skew=true" in plan  # the hot customer partition was split
    assert skewed == plain
    n_orders = raw["olist_orders"].where(F.col("order_id").isNotNull()).count()
    assert len(skewed) == n_orders  # the left join never fans out or drops orders
    hot = [r for r in items if r[0] == "o1"][0]
    assert hot[2] == raw["olist_order_items"].where(F.col("order_id") == "o1").count()

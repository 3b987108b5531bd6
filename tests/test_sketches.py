"""Stored sketches: any period from stored rows alone, within the stated error."""

import pytest
from pyspark.sql import functions as F

from marketlake.plans import sketches
from marketlake.plans.lake import Lake
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="ml-test-")
    lk = Lake.from_testdata(spark, SF_SMALL)
    sketches.store(lk, base)
    return lk, sketches.stored_states(spark, base), base


def test_union_counts_nobody_twice(stored):
    lk, (states, _), _ = stored
    total = sketches.distinct_in(states, 19920101, 20091231).first()
    exact = lk.fact_sales.agg(F.count_distinct("customer_unique_id").alias("c"), F.count(F.lit(1)).alias("n")).first()
    assert total.qtd_pedidos == exact.n
    assert abs(total.clientes - exact.c) <= max(1, 4 * sketches.DISTINCT_ERROR * exact.c)
    months = sketches.distinct_in(states, 19920101, 20091231, by=[(F.col("date_key") / 100).cast("int").alias("m")])
    assert months.agg(F.sum("clientes")).first()[0] > total.clientes * 2  # adding months up would count people again


def test_large_cardinality_stays_within_the_error(spark):
    ids = spark.range(200_000).select((F.col("id") % 150_000).cast("string").alias("c"), (F.col("id") % 30).alias("day"))
    days = ids.groupBy("day").agg(F.hll_sketch_agg("c", F.lit(sketches.LG_K)).alias("clientes"))
    got = days.agg(sketches._estimate("clientes").alias("n")).first().n
    assert abs(got - 150_000) <= 4 * sketches.DISTINCT_ERROR * 150_000


def test_a_period_reads_its_years_alone_and_no_fact(stored):
    _, (states, _), base = stored
    plan = sketches.distinct_in(states, 19960101, 19960630, ["SP"])._jdf.queryExecution().executedPlan().toString()
    assert "ano" in plan.split("PartitionFilters")[1][:120] and "lineitem" not in plan and "orders" not in plan


def test_states_and_empty_periods(stored):
    lk, (states, prices), _ = stored
    one = sketches.distinct_in(states, 19950101, 19951231, ["SP", "RJ"], by=["estado"])
    assert {r.estado for r in one.collect()} <= {"SP", "RJ"}
    none = sketches.distinct_in(states, 20300101, 20301231).first()
    assert (none.clientes, none.sellers) == (0, 0)
    assert sketches.prices_in(prices, 20300101, 20301231, [0.5], by=["categoria"]).count() == 0


def test_quantile_ranks(stored):
    lk, (_, prices), _ = stored
    q = sketches.prices_in(prices, 19920101, 20091231, [0.1, 0.5, 0.99]).first()
    values = sorted(float(r.preco_produto) for r in lk.fact_order_items.where("preco_produto IS NOT NULL").join(lk.fact_sales.select("order_id"), "order_id").collect())
    assert q.qtd_itens == len(values)
    for at, v in ((0.1, q.q10), (0.5, q.q50), (0.99, q.q99)):
        below, upto = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
        assert below - 2 * sketches.RANK_ERROR <= at <= upto + 2 * sketches.RANK_ERROR


def test_held_frames_are_read_from_files(spark):
    lk = Lake.from_testdata(spark, SF_SMALL)
    expected = sorted(map(tuple, lk.fact_sales.select("order_id", "date_key").collect()))
    lk.hold("fact_sales", ["order_id", "date_key"])
    plan = lk.fact_sales._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "lineitem" not in plan
    assert sorted(map(tuple, lk.fact_sales.collect())) == expected


@pytest.mark.parametrize("name", ["distinct_sketch_quarters", "price_sketch_by_category"])
def test_the_queries_compute_their_facts_once(spark, monkeypatch, name):
    from marketlake.plans import registry
    made = []
    real = sketches.store
    monkeypatch.setattr(sketches, "store", lambda lk, base: (made.append((lk.fact_sales, lk.customer_latest)), real(lk, base)))
    df = registry.QUERIES[name](spark, SF_SMALL)
    for held in made[0]:
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "lineitem" not in plan and "orders.parquet" not in plan
    assert df.count() > 0

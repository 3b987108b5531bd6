"""Persistent surrogate keys: unchanged over loads, dense, repeatable, safe against a load that dies."""

import pytest

from marketlake.operators.key_map import KeyMap


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "seller_id string")


def stored(m):
    return {r.seller_id: r.seller_key for r in m.pairs().collect()}


@pytest.fixture()
def key_map(spark, tmp_base):
    return KeyMap(spark, f"{tmp_base}/keys", "seller_id", "seller_key")


def test_first_load_is_dense_and_distinct(spark, key_map):
    block = key_map.assign(keys(spark, "a", "b", "b", None, "c"), "1")
    assert (block.first, block.last) == (1, 3)
    assert sorted(stored(key_map).values()) == [1, 2, 3] and set(stored(key_map)) == {"a", "b", "c"}


def test_second_load_keeps_keys_and_numbers_new_ones_above(spark, key_map):
    key_map.assign(keys(spark, *"abcd"), "1")
    before = stored(key_map)
    key_map.assign(keys(spark, *"xbydz"), "2")  # a and c don't come again: they keep their numbers
    after = stored(key_map)
    assert {k: after[k] for k in before} == before
    assert sorted(after[k] for k in "xyz") == [5, 6, 7]


def test_repeated_load_gives_no_keys(spark, key_map):
    key_map.assign(keys(spark, *"abcd"), "1")
    before = stored(key_map)
    assert key_map.assign(keys(spark, *"abcd"), "1") is None
    assert stored(key_map) == before and len(key_map.blocks()) == 1


def test_load_that_died_before_publishing_is_not_read_and_takes_the_same_numbers(spark, key_map, monkeypatch):
    from marketlake.operators import key_map as module
    key_map.assign(keys(spark, *"ab"), "1")

    def die(*a):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        m.setattr(module, "_write_new", die)
        with pytest.raises(RuntimeError):
            key_map.assign(keys(spark, *"abcdef"), "2")
    assert set(stored(key_map)) == {"a", "b"}
    left = {r.seller_id: r.seller_key for r in spark.read.parquet(f"{key_map.path}/keys").where("_block = 2").collect()}
    key_map.assign(keys(spark, *"abcdef"), "2")
    assert {k: v for k, v in stored(key_map).items() if k in left} == left


def test_empty_loads(spark, key_map):
    assert key_map.assign(keys(spark), "0") is None
    assert key_map.pairs().count() == 0
    assert key_map.pairs().columns == ["seller_id", "seller_key"]


def test_facts_resolve_through_stored_keys(spark, key_map):
    key_map.assign(keys(spark, *"ab"), "1")
    facts = spark.createDataFrame([(1, "a"), (2, "q"), (3, None)], "n int, seller_id string")
    got = {r.n: r.seller_key for r in key_map.lookup().resolve(facts).collect()}
    assert got == {1: stored(key_map)["a"], 2: -1, 3: -1}


def test_dimension_with_stored_keys_and_unknown_member(spark, key_map):
    from marketlake.operators.modeling import with_unknown_member
    key_map.assign(keys(spark, *"ab"), "1")
    dim = spark.createDataFrame([("a", "rio"), (None, "x")], "seller_id string, cidade string")
    rows = {r.seller_id: (r.seller_key, r.cidade) for r in with_unknown_member(key_map.keyed(dim), "seller_key").collect()}
    assert rows == {"a": (stored(key_map)["a"], "rio"), "Desconhecido": (-1, "Desconhecido")}


def test_pipeline_keeps_keys_over_runs(spark, tmp_base):
    from marketlake.plans.pipeline import run_pipeline
    from marketlake.sources.files import read_table
    from marketlake.sources.raw_views import RawTables
    from tests.conftest import SF_SMALL
    raw = RawTables(spark, SF_SMALL).as_dict()
    relax = {("olist_orders", "not_null(order_id)")}
    fewer = {**raw, "olist_sellers": raw["olist_sellers"].where("seller_id <> 's1' AND seller_id <> 's5'")}
    key = lambda: {r.seller_id: r.seller_key for r in read_table(spark, tmp_base, "gold", "dim_sellers_keyed").collect()}
    run_pipeline(spark, fewer, tmp_base, run_id="k1", relax=relax, documented=True, gate=False)
    before = key()
    run_pipeline(spark, raw, tmp_base, run_id="k2", relax=relax, documented=True, gate=False)
    after = key()
    assert {k: after[k] for k in before} == before
    assert sorted(after[k] for k in ("s1", "s5")) == [len(before), len(before) + 1]  # the Unknown member has no number

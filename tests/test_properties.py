"""Property tests: operators against pure-Python brute force on random small fixtures."""

from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketlake.operators.aggregates import items_per_order, payments_per_order
from marketlake.operators.modeling import latest_per_key, surrogate_key
from marketlake.operators.quality import duplicates
from marketlake.sources.files import upsert_latest

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.sampled_from(["a", "b", "c", "d"])
types = st.one_of(st.none(), st.sampled_from(["boleto", "credit_card", "voucher"]))
money = st.one_of(st.none(), st.integers(0, 500).map(lambda c: Decimal(c) / 100))


@SETTINGS
@given(st.lists(st.tuples(keys, types, st.integers(1, 12), money), min_size=1, max_size=40))
def test_payments_per_order_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "order_id string, payment_type string, payment_installments int, "
                                     "payment_value decimal(18,2)")
    got = {r.order_id: (r.forma_pagamento_principal, r.max_parcelas) for r in payments_per_order(df).collect()}
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want = {}
    for k, rs in by.items():
        valued = [r for r in rs if r[3] is not None]
        if valued:
            top = max(valued, key=lambda r: (r[3], r[1] is not None, r[1] or ""))
            t = top[1]
        else:
            t = None
        want[k] = (t, max(r[2] for r in rs))
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(1, 5), money, money), min_size=1, max_size=40))
def test_items_per_order_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "order_id string, order_item_id int, price decimal(18,2), "
                                     "freight_value decimal(18,2)")
    got = {r.order_id: (r.valor_total_pedido, r.quantidade_itens) for r in items_per_order(df).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        rs = [r for r in rows if r[0] == k]
        terms = [r[2] + r[3] for r in rs if r[2] is not None and r[3] is not None]
        want[k] = (sum(terms) if terms else None, len(rs))
    assert got == want


@SETTINGS
@given(st.sets(st.text("abcdefghij", min_size=1, max_size=6), min_size=1, max_size=60))
def test_surrogate_keys_dense_and_ordered(spark, ks):
    import hashlib
    df = spark.createDataFrame([(k,) for k in ks], "k string")
    got = {r.k: r.sk for r in surrogate_key(df, "k", "sk").collect()}
    order = sorted(ks, key=lambda k: (hashlib.md5(k.encode()).hexdigest()[:4], k))
    assert got == {k: i + 1 for i, k in enumerate(order)}


@SETTINGS
@given(st.lists(st.tuples(keys, st.text("xyz", min_size=1, max_size=3), st.one_of(st.none(), st.sampled_from(["p", "q"]))),
                min_size=1, max_size=30))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "u string, c string, city string")
    got = {r.u: (r.c, r.city) for r in latest_per_key(df, "u", "c", ["c", "city"]).collect()}
    want = {}
    for u in {r[0] for r in rows}:
        best = max((r for r in rows if r[0] == u), key=lambda r: (r[1], r[2] is not None, r[2] or ""))
        want[u] = (best[1], best[2])
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=0, max_size=40))
def test_duplicates_matches_brute_force(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "k int")
    r = duplicates(df, ["k"]).collect()[0]
    assert (r.total, r.duplicates) == (len(vals), len(vals) - len(set(vals)))


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 9), st.integers(0, 99)), max_size=20),
       st.lists(st.tuples(keys, st.integers(0, 9), st.integers(0, 99)), max_size=20))
def test_upsert_latest_matches_brute_force(spark, old, new):
    schema = "k string, ts int, v int"
    got = {r.k: (r.ts, r.v) for r in upsert_latest(spark.createDataFrame(old, schema),
                                                   spark.createDataFrame(new, schema), ["k"], "ts", ["v"]).collect()}
    want = {}
    for k in {r[0] for r in old + new}:
        cands = [(r[1], 0, r[2]) for r in old if r[0] == k] + [(r[1], 1, r[2]) for r in new if r[0] == k]
        ts, _, v = max(cands)
        want[k] = (ts, v)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), keys), st.one_of(st.none(), st.integers(0, 300000))),
                min_size=1, max_size=60),
       st.sampled_from([2, 4096]))
def test_exact_median_matches_brute_force(spark, rows, bins):
    import statistics
    from marketlake.operators.quantiles import exact_median
    data = [(g, None if c is None else Decimal(c) / 100) for g, c in rows]
    df = spark.createDataFrame(data, "g string, v decimal(18,2)")
    got = {r.g: r.mediana for r in exact_median(df, "g", "v", bins=bins).collect()}
    want = {}
    for g in {r[0] for r in data}:
        vs = [float(r[1]) for r in data if r[0] == g and r[1] is not None]
        if vs:
            want[g] = statistics.median(vs)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)

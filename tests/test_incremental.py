"""Incremental KPIs from signed changes: equal to a full refresh, touched months only, safe against a load that dies."""

import pytest
from pyspark.sql import functions as F

from marketlake.plans import gold, incremental, silver
from marketlake.plans.incremental import IncrementalLake, consolidated, signed
from marketlake.sources.snapshots import current

ORDER = ("order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
         "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
ITEM = "order_id string, order_item_id int, product_id string, seller_id string, price decimal(18,2), freight_value decimal(18,2)"
PAYMENT = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(18,2)"
REVIEW = "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz"


def frame(spark, rows, schema):
    names = [c.split()[0] for c in schema.split(", ")]
    text = spark.createDataFrame([tuple(None if x is None else str(x) for x in r) for r in rows], ", ".join(f"{n} string" for n in names))
    kinds = [c.split(None, 1)[1] for c in schema.split(", ")]
    return text.select(*[F.col(n).cast(k).alias(n) for n, k in zip(names, kinds)])


def order(i, month, status="delivered", got=True, customer=None, day=5):
    at = f"2018-{month:02d}-{day:02d} 10:00:00"
    return (i, customer or f"c{i}", status, at, at, None, f"2018-{month:02d}-20 10:00:00" if got else None, f"2018-{month:02d}-25 00:00:00")


def item(i, n, seller, price="10.00", freight="1.50"):
    return (i, n, f"p{n}", seller, price, freight)


def review(i, score, month):
    return (f"r{i}", i, score, None, None, f"2018-{month:02d}-21 00:00:00" if month else None, None)


START = {
    "olist_order_items": [item("o1", 1, "s1"), item("o1", 2, "s2"), item("o2", 1, "s1"), item("o3", 1, "s3", freight=None), item("o4", 1, "s4"), item("late", 1, "s9")],
    "olist_orders": [order("o1", 1), order("o2", 1, "shipped", got=False, customer="c1"), order("o3", 2), order("o4", 3), order(None, 1, customer="cx")],
    "olist_order_payments": [("o1", 1, "boleto", 1, "23.00"), ("o2", 1, "voucher", 3, "11.50"), ("o4", 1, "boleto", 2, "11.50")],
    "olist_order_reviews": [review("o1", 5, 1), review("o2", 1, 1), review("o4", 3, 4), review("o3", 4, None)],
}
SCHEMAS = {"olist_orders": ORDER, "olist_order_items": ITEM, "olist_order_payments": PAYMENT, "olist_order_reviews": REVIEW}
CUSTOMERS = [("c1", "u1"), ("co1", "u1"), ("co3", "u3"), ("co4", "u1"), ("clate", "u7"), ("cnew", "u8")]


class Truth:
    """Plain row lists, changed in place, and the full refresh over them."""

    def __init__(self, spark):
        self.spark, self.rows = spark, {t: list(r) for t, r in START.items()}
        self.customers = spark.createDataFrame(CUSTOMERS, "customer_id string, customer_unique_id string")

    def change(self, **tables):
        out = {}
        for t, (gone, new) in tables.items():
            name = f"olist_{t}"
            for r in gone:
                self.rows[name].remove(r)
            self.rows[name] += new
            out[name] = signed(frame(self.spark, new, SCHEMAS[name]), 1).unionByName(signed(frame(self.spark, gone, SCHEMAS[name]), -1))
        return out

    def kpi(self):
        raw = {t: frame(self.spark, r, SCHEMAS[t]) for t, r in self.rows.items()} | {"olist_customers": self.customers}
        fact = gold.fact_sales(silver.orders_enriched(raw))
        return gold.kpi_marketplace_monthly(fact, gold.fact_reviews(silver.reviews_enriched(raw)), raw["olist_order_items"])


def rows(df):
    return sorted((tuple(float(x) if x is not None and i else x for i, x in enumerate(r)) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def loaded(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="ml-test-") + "/inc"
    IncrementalLake(spark, root).apply({t: signed(frame(spark, r, SCHEMAS[t]), 1) for t, r in START.items()}, Truth(spark).customers)
    return root


@pytest.fixture()
def lake(spark, tmp_base, loaded):
    """A copy of the lake after its first load, so that is made once."""
    import shutil
    shutil.copytree(loaded, f"{tmp_base}/inc")
    return Truth(spark), IncrementalLake(spark, f"{tmp_base}/inc")


def test_first_load_equals_the_full_refresh(lake):
    truth, inc = lake
    assert rows(inc.kpi()) == rows(truth.kpi())


CHANGES = {
    "cancel": {"orders": ([order("o2", 1, "shipped", got=False, customer="c1")], [order("o2", 1, "canceled", got=False, customer="c1")])},
    "late order, whose item came before": {"orders": ([], [order("late", 2)])},
    "the only row of a seller": {"order_items": ([item("o1", 2, "s2")], [])},
    "becomes priced": {"order_items": ([item("o3", 1, "s3", freight=None)], [item("o3", 1, "s3")])},
    "no priced item is left": {"order_items": ([item("o3", 1, "s3")], [item("o3", 1, "s3", freight=None)])},
    "move to another month": {"orders": ([order("o1", 1)], [order("o1", 2)])},
    "the only order of its month": {"orders": ([order("o4", 3)], [])},
    "review": {"order_reviews": ([review("o2", 1, 1)], [review("o2", 5, 2)])},
    "payment": {"order_payments": ([("o1", 1, "boleto", 1, "23.00")], [("o1", 1, "credit_card", 9, "23.00")])},
    "new order": {"orders": ([], [order("new", 7)]), "order_items": ([], [item("new", 1, "s1"), item("new", 2, "s1")]), "order_reviews": ([], [review("new", 2, 7)])},
}


def test_each_change_equals_the_full_refresh(lake):
    truth, inc = lake
    for name, change in CHANGES.items():
        before = rows(inc.kpi())
        inc.apply(truth.change(**change), truth.customers)
        assert rows(inc.kpi()) == rows(truth.kpi()), name
        assert rows(inc.kpi()) != before or name == "payment", name


def test_changes_one_after_the_other_and_back(lake):
    truth, inc = lake
    first = rows(inc.kpi())
    a, b = order("o1", 1), order("o1", 5)
    inc.apply(truth.change(orders=([a], [b])), truth.customers)
    assert rows(inc.kpi()) == rows(truth.kpi()) != first
    inc.apply(truth.change(orders=([b], [a])), truth.customers)
    assert rows(inc.kpi()) == first


def test_only_touched_months_are_read_and_written(lake):
    truth, inc = lake
    before = {t: set(inc.folders(t)) for t in ("orders", "items", "fact_sales", "sales", "customers", "sellers", "kpi")}
    written = inc.apply(truth.change(order_items=([item("o4", 1, "s4")], [])), truth.customers)
    assert written == {201803, 0}
    for t, old in before.items():
        kept = {f for f in old if "201803" not in f and "ano_mes=0" not in f}
        assert kept and kept <= set(inc.folders(t)), t
        assert not any("201803" in f for f in old & set(inc.folders(t))), t
    # a read of some months lists no other folder
    files = inc.read("fact_sales", {201801}).inputFiles()
    assert files and all("ano_mes=201801" in f for f in files)


def test_change_to_an_order_without_id_concerns_its_month_alone(lake):
    truth, inc = lake
    written = inc.apply(truth.change(orders=([order(None, 1, customer="cx")], [order(None, 1, "canceled", customer="cx"), order(None, 3)])), truth.customers)
    assert written == {201801, 201803, 0}
    assert rows(inc.kpi()) == rows(truth.kpi())
    assert sorted(r.order_status for r in inc.read("orders").where("order_id IS NULL").collect()) == ["canceled", "delivered"]


def test_stored_fact_equals_the_full_refresh(lake):
    truth, inc = lake
    inc.apply(truth.change(orders=([order("o1", 1)], [order("o1", 2)])), truth.customers)
    raw = {t: frame(truth.spark, r, SCHEMAS[t]) for t, r in truth.rows.items()} | {"olist_customers": truth.customers}
    full = gold.fact_sales(silver.orders_enriched(raw))
    assert sorted(map(repr, inc.read("fact_sales").select(*full.columns).collect())) == sorted(map(repr, full.collect()))


def test_load_that_dies_changes_nothing_and_is_repeated(lake, monkeypatch):
    truth, inc = lake
    before, version = rows(inc.kpi()), current(inc.spark, inc.root)[0]
    changes = truth.change(orders=([order("o1", 1)], [order("o1", 2)]))

    def die(*a):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        m.setattr(incremental, "publish", die)
        with pytest.raises(RuntimeError):
            inc.apply(changes, truth.customers)
    assert rows(inc.kpi()) == before and current(inc.spark, inc.root)[0] == version
    inc.apply(changes, truth.customers)
    assert rows(inc.kpi()) == rows(truth.kpi())


def test_row_taken_back_that_is_not_stored_is_an_error(lake):
    truth, inc = lake
    gone = signed(frame(inc.spark, [item("o1", 9, "s1")], ITEM), -1)
    with pytest.raises(Exception, match="not stored"):
        inc.apply({"olist_order_items": gone}, truth.customers)


def test_consolidated_counts_repeated_rows(spark):
    r = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", -1), ("c", 1), ("c", 1), ("c", -1), (None, 1)], "k string, _sign int")
    assert sorted(x.k or "" for x in consolidated(r).collect()) == ["", "a", "a", "c"]


def test_versions_before_the_last_are_deleted(lake):
    import os
    truth, inc = lake
    for month in (2, 3, 4, 5):
        old = next(o for o in truth.rows["olist_orders"] if o[0] == "o1")
        inc.apply(truth.change(orders=([old], [order("o1", month)])), truth.customers)
    assert len(os.listdir(f"{inc.root}/_versions")) - sum(f.startswith(".") for f in os.listdir(f"{inc.root}/_versions")) == 2
    assert rows(inc.kpi()) == rows(truth.kpi())


def test_first_load_writes_each_table_once(spark, tmp_base, monkeypatch):
    truth, names = Truth(spark), []
    real = incremental.stage
    monkeypatch.setattr(incremental, "stage", lambda df, name: (names.append(name), real(df, name))[1])
    inc = IncrementalLake(spark, f"{tmp_base}/inc")
    inc.apply({t: signed(frame(spark, r, SCHEMAS[t]), 1) for t, r in START.items()}, truth.customers)
    assert names == ["touched"]
    assert rows(inc.kpi()) == rows(truth.kpi())


def test_rows_are_added_up_and_find_their_month_in_one_shuffle(lake):
    truth, inc = lake
    change = {"olist_order_items": signed(frame(inc.spark, [item("o1", 1, "s1"), item(None, 1, "s1"), item(None, 1, "s1")], ITEM), 1)}
    after = inc._after("items", inc.read("items").limit(0), change, inc.read("orders"))
    dealt = [x.partition("hashpartitioning(")[2] for x in after._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(" in x]
    assert sum("REPARTITION_BY_COL" in x for x in dealt) == 1
    assert sum("order_item_id" in x for x in dealt) == 1  # the rows without an order alone
    assert sorted((r.order_id or "", r.ano_mes) for r in after.collect()) == [("", 0), ("", 0), ("o1", 201801)]

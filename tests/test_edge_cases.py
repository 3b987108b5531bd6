"""Hand-made fixtures for cases the synthetic tables lack (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.exprs import non_blank, region_of_state, sla_columns
from marketlake.functions.sentiment import sentiment_label
from marketlake.operators.aggregates import geo_centroids, geo_in_bounds, items_per_order, payments_per_order
from marketlake.operators.joins import KeyLookup, orphans
from marketlake.operators.modeling import latest_per_key, surrogate_key, unknown_member
from marketlake.operators.quality import Check, check_reconciliation, duplicates, table_checks
from marketlake.plans import gold

D = T.DecimalType(18, 2)


def test_payment_ties_and_nulls(spark):
    schema = "order_id string, payment_type string, payment_installments int, payment_value decimal(18,2)"
    rows = [("a", "boleto", 1, Decimal("10.00")), ("a", "voucher", 3, Decimal("10.00")),   # tie -> larger name
            ("b", None, 2, Decimal("50.00")), ("b", "credit_card", 1, Decimal("20.00")),  # NULL type wins
            ("c", "boleto", 1, None), ("c", "voucher", 4, Decimal("1.00")),               # NULL value loses
            ("d", "boleto", 2, None)]                                                       # all NULL -> NULL
    out = {r.order_id: r for r in payments_per_order(spark.createDataFrame(rows, schema)).collect()}
    assert out["a"].forma_pagamento_principal == "voucher"
    assert out["b"].forma_pagamento_principal is None
    assert out["c"].forma_pagamento_principal == "voucher" and out["c"].max_parcelas == 4
    assert out["d"].forma_pagamento_principal is None and out["d"].max_parcelas == 2


def test_items_null_freight_drops_from_sum_only(spark):
    rows = [("a", 1, Decimal("10.00"), Decimal("1.00")), ("a", 2, Decimal("5.00"), None)]
    df = spark.createDataFrame(rows, "order_id string, order_item_id int, price decimal(18,2), freight_value decimal(18,2)")
    r = items_per_order(df).collect()[0]
    assert r.valor_total_pedido == Decimal("11.00") and r.quantidade_itens == 2


def test_same_day_late_delivery(spark):
    rows = [(dt.datetime(2018, 1, 1, 9), dt.datetime(2018, 1, 10, 14), dt.datetime(2018, 1, 10, 0)),
            (dt.datetime(2018, 1, 1, 9), None, dt.datetime(2018, 1, 10, 0))]
    df = spark.createDataFrame(rows, "p timestamp_ntz, d timestamp_ntz, e timestamp_ntz")
    out = df.select(*[c.alias(n) for n, c in sla_columns("p", "d", "e").items()]).collect()
    assert out[0].entregue_no_prazo is False and out[0].dias_atraso == 0 and out[0].dias_para_entrega == 9
    assert out[1].entregue_no_prazo is None and out[1].dias_atraso is None


def test_blank_comments_and_labels(spark):
    rows = [(None,), ("",), ("   ",), ("\n\t",), ("Produto ÓTIMO, recomendo",), ("péssimo",), ("ok",)]
    df = spark.createDataFrame(rows, "m string")
    out = [r.s for r in df.select(non_blank("m").alias("nb"), sentiment_label("m").alias("s")).collect()]
    assert out[:3] == ["sem_comentario"] * 3
    assert out[3] == "neutro"  # tabs and newlines count as text
    assert out[4:] == ["positivo", "negativo", "neutro"]


def test_geo_bounds_inclusive_null_nan(spark):
    rows = [(1, 5.5, -50.0, "SP"), (1, 5.51, -50.0, "SP"), (1, None, -50.0, "SP"), (1, float("nan"), -50.0, "SP"),
            (2, -34.0, -74.0, "XX"), (3, 0.0, -40.0, None)]
    df = spark.createDataFrame(rows, "geolocation_zip_code_prefix int, geolocation_lat double, "
                                     "geolocation_lng double, geolocation_state string")
    assert geo_in_bounds(df).count() == 3
    g = {r.zip_code_prefix: r for r in geo_centroids(df).collect()}
    assert g[1].lat == 5.5 and g[1].regiao_brasil == "Sudeste"
    assert g[2].regiao_brasil == "Desconhecido" and g[3].regiao_brasil == "Desconhecido"


def test_value_range_null_passes_nan_fails(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (7.0,)], "x double")
    r = table_checks(df, "t", "t", [Check("value_range", "x", 0, 5)]).collect()[0]
    assert r.detail == "out_of_range=2" and r.passed is False


def test_date_range_upper_bound_is_midnight(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 12, 31, 12),), (dt.datetime(2018, 12, 31, 0),)], "ts timestamp_ntz")
    r = table_checks(df, "t", "t", [Check("date_range", "ts", "2016-01-01", "2018-12-31")]).collect()[0]
    assert r.detail == "out_of_range=1"


def test_fk_null_unknown_orphan(spark):
    fact = spark.createDataFrame([(None,), (-1,), (1,), (99,)], "fk long")
    dim = spark.createDataFrame([(1,), (1,), (2,)], "pk long")
    assert orphans(fact, dim, "fk", "pk").count() == 1


def test_fk_lookup_refuses_duplicate_business_keys(spark):
    fact = spark.createDataFrame([("a",), ("z",)], "k string")
    dim_ok = spark.createDataFrame([("a", 1)], "k string, sk long")
    out = {r.k: r.sk for r in KeyLookup.of(dim_ok, "k", "sk").resolve(fact).collect()}
    assert out == {"a": 1, "z": -1}
    dim_dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, sk long")
    with pytest.raises(Exception, match="duplicate business key"):
        KeyLookup.of(dim_dup, "k", "sk").resolve(fact).collect()


def test_unknown_member_types(spark):
    schema = T.StructType([
        T.StructField("sk", T.LongType(), False), T.StructField("name", T.StringType(), False),
        T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()),
        T.StructField("d", T.DateType()), T.StructField("m", D), T.StructField("b", T.BooleanType())])
    dim = spark.createDataFrame([], schema)
    r = unknown_member(dim, "sk").collect()[0]
    assert (r.sk, r.name, r.n, r.x, r.d, r.m, r.b) == (-1, "Desconhecido", -1, -1.0, None, None, None)


def test_surrogate_keys_dense_unique_deterministic(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"))
    a = surrogate_key(df, "k", "sk")
    keys = sorted(r.sk for r in a.collect())
    assert keys == list(range(1, 5001))
    b = surrogate_key(df.repartition(7), "k", "sk")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    expected = spark.sql("SELECT k, row_number() OVER (ORDER BY substr(md5(k), 1, 4), k) AS sk FROM "
                         "(SELECT concat('k', CAST(id AS STRING)) AS k FROM range(5000))")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, expected.collect()))


def test_latest_per_key_equals_row_number(spark):
    rows = [("u1", "c1", "x"), ("u1", "c3", "y"), ("u1", "c2", "z"), ("u2", "c9", None)]
    df = spark.createDataFrame(rows, "u string, c string, city string")
    out = {r.u: (r.c, r.city) for r in latest_per_key(df, "u", "c", ["c", "city"]).collect()}
    assert out == {"u1": ("c3", "y"), "u2": ("c9", None)}


def test_duplicates_counts_null_as_value(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (2,)], "k int")
    r = duplicates(df, ["k"]).collect()[0]
    assert (r.total, r.duplicates) == (5, 2)


def test_reconciliation(spark):
    a = spark.createDataFrame([(Decimal("1.005"),), (Decimal("2.00"),)], "v decimal(18,3)")
    b = spark.createDataFrame([(Decimal("3.01"),)], "w decimal(18,2)")
    r = check_reconciliation(a, "v", b, "w", "gold", "kpi").collect()[0]
    assert r.passed is True
    empty = spark.createDataFrame([], "w decimal(18,2)")
    assert check_reconciliation(a, "v", empty, "w", "gold", "kpi").collect()[0].passed is False


def test_calendar_fallback_on_empty_orders(spark):
    oe = spark.createDataFrame([], "order_purchase_timestamp timestamp_ntz")
    cal = gold.dim_calendar(oe)
    r = cal.agg(F.count("*").alias("n"), F.min("date_key").alias("a"), F.max("date_key").alias("b")).collect()[0]
    assert (r.n, r.a, r.b) == (1461, 20160101, 20191231)


def test_calendar_pt_names(spark):
    bounds = spark.createDataFrame([(dt.date(2016, 1, 1), dt.date(2018, 12, 31))], "min_date date, max_date date")
    cal = gold.dim_time_pt(bounds)
    assert cal.count() == 1096
    r = cal.where("date_key = 20160904").collect()[0]
    assert r.nome_mes_pt == "Setembro" and r.nome_dia_semana_pt == "Domingo" and r.eh_fim_de_semana


def test_region_map(spark):
    df = spark.createDataFrame([("SP",), ("AM",), ("DF",), ("XX",), (None,)], "s string")
    assert [r.r for r in df.select(region_of_state("s").alias("r")).collect()] == \
        ["Sudeste", "Norte", "Centro-Oeste", "Desconhecido", "Desconhecido"]


def test_orders_enriched_payment_rules(spark):
    from marketlake.plans import silver
    orders = spark.createDataFrame([("o1", "c1", "delivered", None, None, None, None, None)],
                                   "order_id string, customer_id string, order_status string, "
                                   "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
                                   "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
                                   "order_estimated_delivery_date timestamp_ntz")
    pays = spark.createDataFrame([("o1", "boleto", 1, Decimal("90.00")), ("o1", "voucher", 1, Decimal("5.00")),
                                  ("o1", "voucher", 2, Decimal("5.00"))],
                                 "order_id string, payment_type string, payment_installments int, payment_value decimal(18,2)")
    raw = {"olist_orders": orders, "olist_order_payments": pays,
           "olist_order_items": spark.createDataFrame([], "order_id string, order_item_id int, price decimal(18,2), "
                                                          "freight_value decimal(18,2)"),
           "olist_customers": spark.createDataFrame([("c1", "u1")], "customer_id string, customer_unique_id string")}
    assert silver.orders_enriched(raw).collect()[0].forma_pagamento_principal == "boleto"
    r = silver.orders_enriched(raw, payment_rule="most_frequent").collect()[0]
    assert r.forma_pagamento_principal == "voucher" and r.max_parcelas == 2


def test_sized_broadcast_checks_rows_and_bytes(spark):
    from marketlake.operators.joins import row_bytes, sized_broadcast
    small = spark.range(10).selectExpr("id", "cast(id as string) s")
    assert [r.b for r in small.select(row_bytes(small.schema).alias("b")).collect()] == [8 + 8 + 8 + 1] * 10

    def is_broadcast(df):
        j = spark.range(100).join(df, "id")
        return "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert is_broadcast(sized_broadcast(small, max_rows=10))
        assert not is_broadcast(sized_broadcast(small, max_rows=9))
        assert not is_broadcast(sized_broadcast(small, max_rows=10, max_bytes=249))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_slicers_compose(spark):
    from marketlake.plans import analytics
    from marketlake.plans.lake import Lake
    from tests.conftest import SF_SMALL
    lk = Lake.from_testdata(spark, SF_SMALL)
    all_rows = analytics.sliced_sales(lk).count()
    sp = analytics.sliced_sales(lk, state="SP").count()
    sp_sel = analytics.sliced_sales(lk, state="SP", seller_state="SP").count()
    assert all_rows >= sp >= sp_sel and sp > 0


def test_sla_light_thresholds(spark):
    from marketlake.functions.exprs import sla_light
    df = spark.createDataFrame([(0.95,), (0.9,), (0.899,), (0.8,), (0.799,), (None,)], "r double")
    assert [x.l for x in df.select(sla_light("r").alias("l")).collect()] == \
        ["verde", "verde", "amarelo", "amarelo", "vermelho", None]


def test_nps_formula(spark):
    from marketlake.functions.exprs import nps
    df = spark.createDataFrame([(5, "a"), (4, "b"), (3, "c"), (2, "d"), (1, "e"), (5, "f")], "s int, r string")
    assert df.agg(nps("s", "r").alias("n")).collect()[0].n == pytest.approx((3 - 2) / 6 * 100)
    empty = spark.createDataFrame([], "s int, r string")
    assert empty.agg(nps("s", "r").alias("n")).collect()[0].n is None


def test_pandas_scorer_equals_native_scorer(spark):
    from marketlake.functions.sentiment import lexicon_scorer, pandas_lexicon_scorer
    from marketlake.plans.lake import Lake
    from tests.conftest import SF_SMALL
    r = Lake.from_testdata(spark, SF_SMALL).raw["olist_order_reviews"].select("review_id", "review_comment_message")
    extra = spark.createDataFrame([("x1", "Produto ÓTIMO, recomendo"), ("x2", "\n\t"), ("x3", "péssimo atraso"),
                                   ("x4", ""), ("x5", None)], "review_id string, review_comment_message string")
    r = r.unionByName(extra)
    a = {x.review_id: x.s for x in lexicon_scorer(r, "review_comment_message", "s").collect()}
    b = {x.review_id: x.s for x in pandas_lexicon_scorer(r, "review_comment_message", "s").collect()}
    assert a == b and a["x1"] == "positivo" and a["x3"] == "negativo" and a["x5"] == "sem_comentario"


def test_fk_lookup_leaves_out_null_business_keys(spark):
    fact = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, n int")
    dim = spark.createDataFrame([("a", 7), (None, 8), (None, 9)], "k string, sk int")
    out = {r.n: r.sk for r in KeyLookup.of(dim, "k", "sk").resolve(fact).collect()}
    assert out == {1: 7, 2: -1, 3: -1}


def test_fk_lookup_broadcasts_by_the_measured_size_of_its_source(spark):
    dim = spark.createDataFrame([("a", 7)], "k string, sk int")
    assert KeyLookup.of(dim, "k", "sk", source=dim).small
    assert not KeyLookup.of(dim, "k", "sk").small


def test_surrogate_key_keeps_rows_without_a_business_key(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    out = {r.k: r.sk for r in surrogate_key(df, "k", "sk").collect()}
    assert out[None] == 1 and sorted(out.values()) == [1, 2, 3]


@pytest.mark.parametrize("values,scale", [(["1.005", "1.005", "1.007"], 3), (["0.29"] * 3, 2), (["-3.1", "5.2"], 1), (["7"], 0), (["0.0001", "99.9999"], 4)])
def test_median_keeps_the_scale(spark, values, scale):
    import statistics

    from marketlake.operators.quantiles import exact_median
    df = spark.createDataFrame([("g", Decimal(v)) for v in values], f"g string, v decimal(18,{scale})")
    assert exact_median(df, "g", "v").collect()[0].mediana == pytest.approx(statistics.median(map(float, values)))


def test_median_refuses_floating_point(spark):
    from marketlake.operators.quantiles import exact_median
    with pytest.raises(TypeError):
        exact_median(spark.createDataFrame([("g", 0.29)], "g string, v double"), "g", "v")


def test_documented_quarantine_catches_missing_customers(spark):
    from marketlake.plans import checks, silver
    orders = spark.createDataFrame([("o1", "c1"), (None, "c2"), ("o3", None), (None, None)], "order_id string, customer_id string")
    raw = {"olist_orders": orders}
    coded = {r.motivo_rejeicao for r in silver.quarantine(raw).collect()}
    documented = [r.motivo_rejeicao for r in silver.quarantine(raw, silver.ORDER_RULES_DOC).collect()]
    assert coded == {"order_id nulo"} and sorted(documented) == ["customer_id nulo", "order_id nulo", "order_id nulo"]
    assert silver.quarantine_rate(raw, silver.ORDER_RULES_DOC).collect()[0].qtd_quarentena == 3
    assert checks.rejection_reason is silver.rejection_reason


def test_shared_folder_is_needed_on_a_cluster(monkeypatch):
    from marketlake import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Spark:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Spark())

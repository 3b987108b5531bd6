"""Column checks measured by the write of a table, and the switch between versions of a stored table."""

import threading

import pytest
from pyspark.sql import functions as F

from marketlake.plans import checks
from marketlake.plans.pipeline import run_pipeline
from marketlake.sources import files
from marketlake.sources.files import read_table, upsert_partitions, write_table
from marketlake.sources.raw_views import RawTables
from marketlake.sources.snapshots import current
from tests.conftest import SF_SMALL

RELAX = {("olist_orders", "not_null(order_id)")}


@pytest.fixture(scope="module")
def run(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="ml-test-")
    return run_pipeline(spark, RawTables(spark, SF_SMALL).as_dict(), base, run_id="m1", relax=RELAX), base


def test_measured_checks_equal_a_scan(spark, run):
    report, base = run
    tables = {t: read_table(spark, base, layer, t) for layer, names in (
        ("bronze", ["olist_orders", "olist_order_reviews", "olist_sellers"]), ("silver", ["geolocation_aggregated", "orders_enriched", "reviews_enriched"]),
        ("gold", ["fact_sales", "fact_reviews", "dim_customers"])) for t in names}
    for t, df in tables.items():
        scanned = checks.table_checks(df, "x", t, checks.column_checks(t)).collect()
        measured = checks.table_checks(df, "x", t, checks.column_checks(t), report.metrics[t])
        assert measured.collect() == scanned, t
        assert "FileScan" not in measured._jdf.queryExecution().executedPlan().toString()


def test_suites_read_nothing_for_measured_tables(spark, run):
    report, base = run
    raw = {t: read_table(spark, base, "bronze", t) for t in checks.DEFAULT.bronze_tables}
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan(checks.bronze_suite(raw, measured=report.metrics))
    assert plan(checks.bronze_suite(raw)).count("FileScan") == len(raw)
    assert sorted(map(tuple, checks.bronze_suite(raw).collect())) == sorted(map(tuple, checks.bronze_suite(raw, measured=report.metrics).collect()))


def test_measured_checks_of_an_empty_table(spark, tmp_base):
    from pyspark.sql import Observation
    from marketlake.operators.quality import check_metrics
    empty = spark.createDataFrame([], "order_id string, order_purchase_timestamp timestamp_ntz")
    seen = Observation()
    write_table(empty, tmp_base, "bronze", "olist_orders", observation=seen, metrics=check_metrics(checks.column_checks("olist_orders")), register_table=False)
    got = checks.table_checks(empty, "bronze", "olist_orders", checks.column_checks("olist_orders"), seen.get).collect()
    assert got == checks.table_checks(empty, "bronze", "olist_orders", checks.column_checks("olist_orders")).collect()
    assert not got[0]["passed"]


def test_readers_during_refreshes_see_one_whole_version(spark, tmp_base):
    """At any moment the table is the version before or the new one, never none and never both."""
    write_table(spark.range(100).withColumn("v", F.lit(0)), tmp_base, "gold", "t", register_table=False)
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                df = read_table(spark, tmp_base, "gold", "t")
                seen.add(tuple(df.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()))
            except Exception as e:  # noqa: BLE001
                failed.append(str(e)[:300])
    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 6):
        write_table(spark.range(100).withColumn("v", F.lit(i)), tmp_base, "gold", "t", register_table=False)
    stop.set()
    reader.join()
    assert all(n == 100 and lo == hi for n, lo, hi in seen), seen
    # a read that began two versions ago may find its files gone, but no reader finds no table
    assert not [e for e in failed if "FILE_NOT_EXIST" not in e and "FileNotFound" not in e and "does not exist" not in e], failed


PARTS = "order_id string, mes int, version int"


def rows(spark, base):
    return sorted(map(tuple, read_table(spark, base, "gold", "m").select("order_id", "mes", "version").collect()))


def test_upsert_that_dies_before_the_switch_loses_nothing(spark, tmp_base, monkeypatch):
    """All touched partitions switch at once, or none."""
    write_table(spark.createDataFrame([("o1", 1, 1), ("o2", 2, 1), ("o3", 3, 1)], PARTS), tmp_base, "gold", "m", partition_by=["mes"], register_table=False)
    before = rows(spark, tmp_base)
    changes = spark.createDataFrame([("o1", 2, 2), ("o9", 9, 2)], PARTS)

    def die(*a):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        m.setattr(files, "publish", die)
        with pytest.raises(RuntimeError):
            upsert_partitions(changes, tmp_base, "gold", "m", ["order_id"], "version", ["mes"])
    assert rows(spark, tmp_base) == before
    for _ in range(2):
        upsert_partitions(changes, tmp_base, "gold", "m", ["order_id"], "version", ["mes"])
        assert rows(spark, tmp_base) == [("o1", 2, 2), ("o2", 2, 1), ("o3", 3, 1), ("o9", 9, 2)]


def test_upsert_keeps_the_folders_of_other_partitions(spark, tmp_base):
    write_table(spark.createDataFrame([(f"o{i}", i, 1) for i in range(6)], PARTS), tmp_base, "gold", "m", partition_by=["mes"], register_table=False)
    upsert_partitions(spark.createDataFrame([("o3", 3, 2)], PARTS), tmp_base, "gold", "m", ["order_id"], "version", ["mes"])
    upsert_partitions(spark.createDataFrame([("o4", 4, 3)], PARTS), tmp_base, "gold", "m", ["order_id"], "version", ["mes"])
    folders = sorted(current(spark, f"{tmp_base}/gold/m")[1])
    assert folders == sorted([*(f"_v=1/mes={i}" for i in (0, 1, 2, 5)), "_v=2/mes=3", "_v=3/mes=4"])
    assert rows(spark, tmp_base) == [(f"o{i}", i, {3: 2, 4: 3}.get(i, 1)) for i in range(6)]


def test_upsert_of_partition_values_with_spaces_and_marks(spark, tmp_base):
    schema = "order_id string, mes string, version int"
    write_table(spark.createDataFrame([("o1", "a b", 1), ("o2", "50% é/x", 1)], schema), tmp_base, "gold", "m", partition_by=["mes"], register_table=False)
    upsert_partitions(spark.createDataFrame([("o1", "50% é/x", 2)], schema), tmp_base, "gold", "m", ["order_id"], "version", ["mes"])
    assert rows(spark, tmp_base) == [("o1", "50% é/x", 2), ("o2", "50% é/x", 1)]


def test_refresh_after_upserts(spark, tmp_base):
    write_table(spark.createDataFrame([("o1", 1, 1)], PARTS), tmp_base, "gold", "m", partition_by=["mes"], register_table=False)
    upsert_partitions(spark.createDataFrame([("o2", 2, 2)], PARTS), tmp_base, "gold", "m", ["order_id"], "version", ["mes"])
    write_table(read_table(spark, tmp_base, "gold", "m").select("order_id", "mes", "version"), tmp_base, "gold", "m", partition_by=["mes"], register_table=False)
    assert rows(spark, tmp_base) == [("o1", 1, 1), ("o2", 2, 2)]
    assert len(current(spark, f"{tmp_base}/gold/m")[1]) == 1


def test_ingest_costs_by_what_is_new(spark, tmp_base):
    """A load after a thousand files handles the paths of its own batch alone."""
    import os
    from marketlake.schemas import RAW_SCHEMAS
    from marketlake.streaming import ingest
    landing, header = f"{tmp_base}/landing", "seller_id,seller_city,seller_state,seller_zip_code_prefix\n"
    os.makedirs(landing)
    for i in range(1000):
        with open(f"{landing}/s{i}.csv", "w") as f:
            f.write(f"{header}s{i},a,SP,1\n")
    args = (spark, landing, "s*.csv", f"{tmp_base}/t", f"{tmp_base}/ck", RAW_SCHEMAS["olist_sellers"])
    assert ingest.ingest_csv(*args).rows_added == 1000
    with open(f"{landing}/s_new.csv", "w") as f:
        f.write(f"{header}new,a,SP,1\n")
    handled, read = [], ingest.layouts_of

    def counted(batch):
        found = read(batch)
        handled.append(sum(map(len, found.values())))
        return found
    ingest.layouts_of = counted
    try:
        assert ingest.ingest_csv(*args).rows_added == 1
    finally:
        ingest.layouts_of = read
    assert handled == [1]


def test_ingest_batch_that_dies_is_repeated_into_its_folder(spark, tmp_base, monkeypatch):
    import os
    from marketlake.schemas import RAW_SCHEMAS
    from marketlake.sources.files import read_path
    from marketlake.streaming import ingest
    landing = f"{tmp_base}/landing"
    os.makedirs(landing)
    with open(f"{landing}/s1.csv", "w") as f:
        f.write("seller_id,seller_city,seller_state,seller_zip_code_prefix\ns1,a,SP,1\n")
    args = (spark, landing, "s*.csv", f"{tmp_base}/t", f"{tmp_base}/ck", RAW_SCHEMAS["olist_sellers"])

    def die(*a):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        m.setattr(ingest, "record_schema", die)  # after the rows were written
        with pytest.raises(RuntimeError):
            ingest.ingest_csv(*args)
    assert ingest.ingest_csv(*args).rows_added == 1
    assert [r.seller_id for r in read_path(spark, f"{tmp_base}/t").collect()] == ["s1"]


def test_a_table_belongs_to_one_checkpoint(spark, tmp_base):
    import os
    from marketlake.schemas import RAW_SCHEMAS
    from marketlake.streaming.ingest import ingest_csv
    os.makedirs(f"{tmp_base}/landing")
    with open(f"{tmp_base}/landing/s1.csv", "w") as f:
        f.write("seller_id,seller_city,seller_state,seller_zip_code_prefix\ns1,a,SP,1\n")
    ingest_csv(spark, f"{tmp_base}/landing", "s*.csv", f"{tmp_base}/t", f"{tmp_base}/ck", RAW_SCHEMAS["olist_sellers"])
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_csv(spark, f"{tmp_base}/landing", "s*.csv", f"{tmp_base}/t", f"{tmp_base}/ck2", RAW_SCHEMAS["olist_sellers"])

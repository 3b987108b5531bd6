"""Stream ingest: exactly-once per file, CSV dialect, metadata."""

import os

from marketlake.schemas import RAW_SCHEMAS
from marketlake.streaming.ingest import add_ingestion_metadata, ingest_csv, ingest_all

REVIEWS = RAW_SCHEMAS["olist_order_reviews"]


def _write(path, text, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
        f.write(text)


HEADER = ("review_id,order_id,review_score,review_comment_title,review_comment_message,"
          "review_creation_date,review_answer_timestamp\n")


def test_rerun_adds_nothing_new_file_adds_its_rows(spark, tmp_base):
    landing, out, ck = f"{tmp_base}/landing", f"{tmp_base}/t", f"{tmp_base}/ck"
    _write(f"{landing}/olist_order_reviews_dataset.csv",
           HEADER + 'r1,o1,5,,"otimo ""mesmo""\nsegunda linha",2018-01-01 00:00:00,2018-01-02 10:00:00\n'
                    'r2,o2,1,,pessimo,2018-01-03 00:00:00,2018-01-04 10:00:00', bom=True)
    _write(f"{landing}/olist_orders_dataset.csv", "order_id\nx\n")
    r1 = ingest_csv(spark, landing, "olist_order_reviews*.csv", out, ck, REVIEWS)
    assert r1.rows_added == 2
    r2 = ingest_csv(spark, landing, "olist_order_reviews*.csv", out, ck, REVIEWS)
    assert r2.rows_added == 0
    _write(f"{landing}/olist_order_reviews_2.csv", HEADER + "r3,o3,3,,,2018-02-01 00:00:00,2018-02-02 00:00:00\n")
    r3 = ingest_csv(spark, landing, "olist_order_reviews*.csv", out, ck, REVIEWS)
    assert r3.rows_added == 1
    df = spark.read.parquet(out)
    assert df.count() == 3
    rows = {r.review_id: r for r in df.collect()}
    assert rows["r1"].review_comment_message == 'otimo "mesmo"\nsegunda linha'  # doubled quotes, newline
    assert rows["r3"].review_comment_message is None
    assert rows["r1"]._source_file.endswith("olist_order_reviews_dataset.csv")
    assert "review_id" in df.columns  # BOM stripped from the first header name


def test_ingest_all_runs_each_dataset_independently(spark, tmp_base):
    landing = f"{tmp_base}/landing"
    _write(f"{landing}/olist_order_reviews_dataset.csv", HEADER + "r1,o1,5,,ok,2018-01-01 00:00:00,2018-01-02 00:00:00\n")
    _write(f"{landing}/product_category_name_translation.csv",
           "product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n")
    res = ingest_all(spark, landing, tmp_base, f"{tmp_base}/ck",
                     datasets={"olist_order_reviews": "olist_order_reviews*.csv",
                               "product_category_names": "product_category_name_translation*.csv"})
    assert res["olist_order_reviews"].rows_added == 1 and res["product_category_names"].rows_added == 1


def test_manual_frames_get_manual_load(spark):
    df = add_ingestion_metadata(spark.range(2))
    assert {r._source_file for r in df.collect()} == {"manual_load"}


def test_schema_is_inferred_once_and_remembered(spark, tmp_base):
    from marketlake.streaming.ingest import remembered_schema
    landing = f"{tmp_base}/landing"
    _write(f"{landing}/olist_geolocation_dataset.csv",
           "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng\n01037,-23.5,-46.6\n")
    s1 = remembered_schema(spark, landing, "olist_geolocation*.csv", f"{tmp_base}/ck/schema")
    assert dict((f.name, f.dataType.simpleString()) for f in s1.fields)["geolocation_lat"] == "double"
    _write(f"{landing}/olist_geolocation_2.csv", "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng\nx,y,z\n")
    assert remembered_schema(spark, landing, "olist_geolocation*.csv", f"{tmp_base}/ck/schema") == s1


def test_header_checked_against_declared_schema(spark, tmp_base):
    import pytest
    landing = f"{tmp_base}/landing"
    _write(f"{landing}/olist_order_reviews_dataset.csv", "wrong,header\n1,2\n")
    with pytest.raises(Exception):
        ingest_csv(spark, landing, "olist_order_reviews*.csv", f"{tmp_base}/t", f"{tmp_base}/ck", REVIEWS)


def test_append_with_added_column_reads_with_merge_schema(spark, tmp_base):
    from marketlake.sources.files import read_table, write_table
    a = spark.createDataFrame([("o1",)], "order_id string")
    b = spark.createDataFrame([("o2", "order_id nulo")], "order_id string, motivo_rejeicao string")
    write_table(a, tmp_base, "silver", "q", register_table=False)
    write_table(b, tmp_base, "silver", "q", mode="append", register_table=False)
    rows = {r.order_id: r.motivo_rejeicao for r in read_table(spark, tmp_base, "silver", "q", merge_schema=True).collect()}
    assert rows == {"o1": None, "o2": "order_id nulo"}


def test_approx_distinct_option_is_close(spark):
    from marketlake.plans import gold
    from marketlake.plans.lake import Lake
    from tests.conftest import SF_SMALL
    lk = Lake.from_testdata(spark, SF_SMALL)
    exact = {r.ano_mes: r.qtd_clientes_unicos for r in gold.kpi_sales_monthly(lk.fact_sales).collect()}
    approx = {r.ano_mes: r.qtd_clientes_unicos for r in gold.kpi_sales_monthly(lk.fact_sales, True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= max(2, 0.05 * exact[k]) for k in exact)


def test_backlog_is_drained_in_bounded_batches(spark, tmp_base):
    landing = f"{tmp_base}/landing/olist_order_reviews"
    for i in range(5):
        _write(f"{landing}/part{i}.csv", HEADER + f"r{i},o{i},5,,ok,2018-01-01 00:00:00,2018-01-02 00:00:00\n")
    res = ingest_all(spark, f"{tmp_base}/landing", tmp_base, f"{tmp_base}/ck",
                     datasets={"olist_order_reviews": "*.csv"}, subfolders=True, max_files_per_trigger=2)
    assert res["olist_order_reviews"].rows_added == 5
    assert res["olist_order_reviews"].batches == 3


SELLERS = RAW_SCHEMAS["olist_sellers"]


def test_columns_are_found_by_name_and_new_ones_added(spark, tmp_base):
    from marketlake.sources.files import read_path
    landing, out, ck = f"{tmp_base}/landing", f"{tmp_base}/t", f"{tmp_base}/ck"
    _write(f"{landing}/s1.csv", "seller_id,seller_city,seller_state,seller_zip_code_prefix\ns1,campinas,SP,13023\n")
    ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS)
    _write(f"{landing}/s2.csv", "channel,seller_state,seller_id,seller_zip_code_prefix,seller_city\nweb,RJ,s2,20000,rio\n")
    r = ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS)
    assert r.rows_added == 1 and r.new_columns == ("channel",)
    _write(f"{landing}/s3.csv", "seller_id,seller_city,seller_state,seller_zip_code_prefix\ns3,mogi,SP,08730\n")
    ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS)
    rows = {x.seller_id: (x.seller_state, x.seller_zip_code_prefix, x.channel) for x in read_path(spark, out).collect()}
    assert rows == {"s1": ("SP", "13023", None), "s2": ("RJ", "20000", "web"), "s3": ("SP", "08730", None)}


def test_new_columns_can_be_refused_and_the_load_repeated(spark, tmp_base):
    import pytest
    from marketlake.sources.files import read_path
    from marketlake.streaming.ingest import HeaderError
    landing, out, ck = f"{tmp_base}/landing", f"{tmp_base}/t", f"{tmp_base}/ck"
    _write(f"{landing}/s.csv", "seller_id,seller_city,seller_state,seller_zip_code_prefix,x\ns1,a,SP,1,2\n")
    with pytest.raises(HeaderError):
        ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS, on_new_column="reject")
    assert ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS).rows_added == 1  # nothing was lost
    assert ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS).rows_added == 0
    assert read_path(spark, out).count() == 1


def test_records_that_do_not_parse_are_kept_and_counted(spark, tmp_base):
    from marketlake.sources.files import read_path
    landing, out, ck = f"{tmp_base}/landing", f"{tmp_base}/t", f"{tmp_base}/ck"
    items = RAW_SCHEMAS["olist_order_items"]
    _write(f"{landing}/i.csv", "order_id,order_item_id,product_id,seller_id,price,freight_value\n"
                               "o1,1,p1,s1,10.00,1.00\no2,abc,p1,s1,10.00,1.00\no3,1,p1,s1,x,1.00\n")
    r = ingest_csv(spark, landing, "*.csv", out, ck, items)
    assert (r.rows_added, r.corrupt_rows) == (3, 2)
    bad = {x.order_id: x._corrupt_record for x in read_path(spark, out).where("_corrupt_record IS NOT NULL").collect()}
    assert bad == {"o2": "o2,abc,p1,s1,10.00,1.00", "o3": "o3,1,p1,s1,x,1.00"}


def test_single_line_datasets_fail_on_records_over_several_lines(spark, tmp_base):
    import pytest
    from marketlake.streaming.ingest import CorruptRecordError
    landing, out, ck = f"{tmp_base}/landing", f"{tmp_base}/t", f"{tmp_base}/ck"
    _write(f"{landing}/s.csv", 'seller_id,seller_city,seller_state,seller_zip_code_prefix\ns1,"two\nlines",SP,1\n')
    with pytest.raises(CorruptRecordError):
        ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS, multi_line=False)
    assert ingest_csv(spark, landing, "s*.csv", out, ck, SELLERS).rows_added == 1


def test_row_counts_over_more_than_a_hundred_batches(spark, tmp_base):
    from marketlake.sources.files import read_path
    landing = f"{tmp_base}/landing"
    for i in range(104):
        _write(f"{landing}/s{i}.csv", f"seller_id,seller_city,seller_state,seller_zip_code_prefix\ns{i},a,SP,1\nt{i},a,SP,1\n")
    r = ingest_csv(spark, landing, "s*.csv", f"{tmp_base}/t", f"{tmp_base}/ck", SELLERS, max_files_per_trigger=1)
    assert (r.rows_added, r.batches) == (208, 104)
    assert read_path(spark, f"{tmp_base}/t").count() == 208


def test_time_out_raises_and_stops_the_streams(spark, tmp_base):
    import pytest
    landing = f"{tmp_base}/landing"
    for i in range(30):
        _write(f"{landing}/olist_order_reviews/r{i}.csv", HEADER + f"r{i},o{i},5,,ok,2018-01-01 00:00:00,2018-01-02 00:00:00\n")
    with pytest.raises(TimeoutError):
        ingest_all(spark, landing, tmp_base, f"{tmp_base}/ck", datasets={"olist_order_reviews": "*.csv"}, subfolders=True,
                   max_files_per_trigger=1, timeout_s=0.2)
    assert not [q for q in spark.streams.active if q.isActive]
    res = ingest_all(spark, landing, tmp_base, f"{tmp_base}/ck", datasets={"olist_order_reviews": "*.csv"}, subfolders=True)
    assert res["olist_order_reviews"].rows_added == 30  # the next run takes up what was left


def test_unreadable_remembered_schema_is_an_error(spark, tmp_base):
    import pytest
    from marketlake.streaming.ingest import remembered_schema
    _write(f"{tmp_base}/ck/schema", "not json")
    with pytest.raises(ValueError):
        remembered_schema(spark, f"{tmp_base}/landing", "*.csv", f"{tmp_base}/ck/schema")

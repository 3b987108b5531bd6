"""Morton-ordered storage: filters on any of the clustered columns read a fraction of the files."""

import pytest
from pyspark.sql import functions as F

from marketlake.sources import clustering
from marketlake.sources.files import read_table


def plain_morton(codes, bits):
    n = len(codes)
    return sum(((c >> b) & 1) << (b * n + n - 1 - j) for b in range(bits) for j, c in enumerate(codes))


def test_codes_interleave(spark):
    rows = [(a, b, c) for a in (0, 1, 5, 255) for b in (0, 3, 128) for c in (7, 254)]
    got = spark.createDataFrame(rows, "a int, b int, c int").select("a", "b", "c", clustering.morton([F.col(x) for x in "abc"]).alias("m")).collect()
    assert all(r.m == plain_morton((r.a, r.b, r.c), 8) for r in got)
    with pytest.raises(ValueError):
        clustering.morton([F.lit(1)] * 9, 8)


def test_codes_are_balanced_by_rows_and_keep_order(spark):
    df = spark.createDataFrame([("a",)] * 900 + [("b",)] * 50 + [("c",)] * 49 + [(None,)], "k string")
    codes = {r._value: r._code for r in clustering.balanced_codes(df, "k", 4).collect()}
    assert codes == {None: 0, "a": 0, "b": 14, "c": 15}


@pytest.fixture(scope="module")
def stored(spark):
    import tempfile
    base = tempfile.mkdtemp(prefix="ml-test-")
    h = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    # a third of the rows in one state, one category
    hot = F.col("id") % 3 == 0
    df = spark.range(60_000).select(F.col("id").cast("string").alias("order_id"), (201601 + h(1, 12)).alias("mes"),
                                    F.when(hot, "S0").otherwise(F.concat(F.lit("S"), h(2, 27))).alias("estado"),
                                    F.when(hot, "c0").otherwise(F.concat(F.lit("c"), h(3, 40))).alias("categoria"), h(4, 1000).alias("preco"))
    clustering.write_clustered(df, base, "gold", "f", ["mes", "estado", "categoria"], "order_id", 64)
    return df, read_table(spark, base, "gold", "f")


def rows_read(df):
    """Rows that come out of the file scans, after their statistics have skipped row groups."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("Scan"):
            found += leaf.metrics().apply("numOutputRows").value()
    return found


def test_all_rows_are_stored_in_files_of_about_equal_size(stored):
    df, table = stored
    assert table.count() == df.count() and table.exceptAll(df).count() == 0
    per_file = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) > 48 and max(per_file) < 3 * df.count() / len(per_file)


@pytest.mark.parametrize("condition", ["estado = 'S5' AND categoria = 'c7'", "mes = 201603 AND estado = 'S11'", "mes = 201608 AND categoria = 'c21'"])
def test_filters_on_two_columns_read_under_a_quarter(stored, condition):
    df, table = stored
    sliced = table.where(condition).select("preco")
    assert rows_read(sliced) < df.count() / 4
    assert sliced.agg(F.sum("preco"), F.count(F.lit(1))).first() == df.where(condition).agg(F.sum("preco"), F.count(F.lit(1))).first()


def test_rows_are_computed_once(spark, tmp_base):
    """The counts of the columns, the range sample and the write read stored rows, however costly ``df`` is."""
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            computed.add(b.num_rows)
            yield b
    df = spark.range(400).selectExpr("cast(id as string) k", "cast(id % 7 as int) a", "cast(id % 5 as string) b").mapInArrow(count, "k string, a int, b string")
    clustering.write_clustered(df, tmp_base, "gold", "g", ["a", "b"], "k", 4)
    table = read_table(spark, tmp_base, "gold", "g")
    assert computed.value == 400 and table.count() == 400
    assert table.select("k").distinct().count() == 400

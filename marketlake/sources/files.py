"""Table storage on a shared file system.

Tables are Parquet directories ``<base>/<layer>/<table>``, registered as external
tables in the session catalog so SQL can address them as ``layer.table``.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT
from .snapshots import VERSION, current, file_system, leaves, partition_of, publish, read_folders, read_small_text


def table_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


def read_table(spark: SparkSession, base: str, layer: str, name: str, merge_schema: bool = False) -> DataFrame:
    """Scan a stored table; ``merge_schema`` reconciles files written with added columns.

    A table with a recorded schema (the ingest records one as columns arrive) is read with it. A
    partitioned table without rows has no files to infer a schema from; it is then read through its
    catalog entry when that entry points at the same location."""
    from pyspark.errors import AnalysisException
    root = table_path(base, layer, name)
    folders = current(spark, root)[1]
    if _of_partitions(folders):
        return read_folders(spark, root, folders)
    path = f"{root}/{folders[0]}" if folders else root
    recorded = recorded_schema(spark, path)
    if recorded is not None:
        return spark.read.schema(recorded).parquet(path)
    try:
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    except AnalysisException:
        if _catalog_location(spark, f"{layer}.{name}") == _normalise(path):
            return spark.table(f"{layer}.{name}")
        raise


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """A table's folder, with its recorded schema if there is one."""
    path = current_path(spark, path)
    recorded = recorded_schema(spark, path)
    return (spark.read.schema(recorded) if recorded is not None else spark.read).parquet(path)


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small metadata file: write beside it, then rename."""
    fs, p = file_system(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(tmp, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not write {path}")


def recorded_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema recorded in a table's folder (a hidden file), or None."""
    text = read_small_text(spark, f"{path}/_schema.json")
    return T.StructType.fromJson(json.loads(text)) if text else None


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    write_small_text(spark, f"{path}/_schema.json", schema.json())


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def _of_partitions(folders: list[str]) -> bool:
    """Whether a version is a list of partition folders, and not one folder."""
    return any(partition_of(f) for f in folders)


def current_path(spark: SparkSession, path: str) -> str:
    """The one folder that holds a table's data: its current version, or the table's own folder if it has no versions."""
    folders = current(spark, path)[1]
    if _of_partitions(folders):
        raise ValueError(f"{path} has partitions of several versions: read it with read_table")
    return f"{path}/{folders[0]}" if folders else path


def _normalise(path: str) -> str:
    return path.rstrip("/").replace("file://", "").replace("file:", "")


def _catalog_location(spark: SparkSession, fq: str) -> str | None:
    if not spark.catalog.tableExists(fq):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {fq}").where("col_name = 'Location'").collect()
    return _normalise(rows[0]["data_type"]) if rows else None


def register(spark: SparkSession, base: str, layer: str, name: str, schema=None) -> None:
    """Register the Parquet directory as an external table (schema given, so empty tables work). A table with
    partitions of several versions has no one folder: it is taken out of the catalog and read with ``read_table``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
    if _of_partitions(current(spark, table_path(base, layer, name))[1]):
        return
    path = current_path(spark, table_path(base, layer, name))
    spark.catalog.createTable(f"{layer}.{name}", path=path, source="parquet", schema=schema)


def write_table(df: DataFrame, base: str, layer: str, name: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, dynamic_partitions: bool = False,
                register_table: bool = True, cluster_by: list[str] | None = None,
                observation=None, files_per_partition: int = 8, metrics: list | None = None) -> str:
    """Full refresh (overwrite data and schema) or append; optional Hive-style partitions.

    A full refresh writes a new version folder and then publishes it (``snapshots``), so a failed write leaves
    the old table as it was and readers find one whole table at any time; the version before the last is
    deleted. The refresh may read the table it replaces.
    With ``cluster_by``, partitioned writes are first hash-distributed on the partition columns and
    ``cluster_by`` modulo ``files_per_partition``: a partition value is written by at most that many
    tasks, so a hot one is split, the file count stays bounded, and no sampling pass is needed.
    Without it the frame's own distribution is kept (never one task per partition value).
    ``dynamic_partitions`` overwrites only the partitions present in ``df`` (incremental loads); it and
    ``append`` work on the current version. ``observation`` (a ``pyspark.sql.Observation``) receives ``metrics``
    of the written rows, or their count as ``rows``.
    """
    spark = df.sparkSession
    root = table_path(base, layer, name)
    refresh = mode == "overwrite" and not dynamic_partitions
    if partition_by and cluster_by:
        salt = F.pmod(F.xxhash64(*cluster_by), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], salt)
    if observation is not None:
        df = df.observe(observation, *(metrics or [F.count(F.lit(1)).alias("rows")]))
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if refresh:
        number = current(spark, root)[0] + 1
        w.parquet(f"{root}/{VERSION}={number}")
        publish(spark, root, number, [f"{VERSION}={number}"])
    else:
        w.parquet(current_path(spark, root))
    if register_table:
        register(spark, base, layer, name, df.schema if mode == "overwrite" else None)
    return current_path(spark, root)


def ensure_layout(spark: SparkSession, base: str, s=DEFAULT) -> DataFrame:
    """One namespace per layer, a quality log table in each; returns the layer namespaces."""
    from ..operators.quality import LOG_SCHEMA
    for layer in (s.bronze, s.silver, s.gold):
        register(spark, base, layer, "quality_logs", LOG_SCHEMA)
    ns = spark.sql("SHOW SCHEMAS")
    return ns.where(F.col(ns.columns[0]).isin(s.bronze, s.silver, s.gold))


def dedupe_latest(df: DataFrame, key: list[str], order_cols: list) -> DataFrame:
    """Keep the first row per key by ``order_cols`` (Column orderings). The row_number filter is
    planned as a partial + final WindowGroupLimit, so a hot key is cut to one row per map
    partition before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*key).orderBy(*order_cols))
    return df.withColumn("_rn", rn).where(F.col("_rn") == 1).drop("_rn")


def upsert_latest(existing: DataFrame, changes: DataFrame, key: list[str], order_col: str,
                  tie_breakers: list[str] | None = None) -> DataFrame:
    """Merge a change set into a snapshot: union, keep the row with the largest ``order_col``
    per key (ties: the change wins, then the largest ``tie_breakers``)."""
    cols = existing.columns
    u = (existing.select(*cols, F.lit(0).alias("_src"))
         .unionByName(changes.select(*cols, F.lit(1).alias("_src"))))
    order = [F.col(order_col).desc_nulls_last(), F.col("_src").desc()]
    order += [F.col(c).desc_nulls_last() for c in (tie_breakers or [])]
    return dedupe_latest(u, key, order).drop("_src")


def upsert_partitions(changes: DataFrame, base: str, layer: str, name: str, key: list[str], order_col: str,
                      partition_cols: list[str], tie_breakers: list[str] | None = None,
                      max_partitions: int = 10_000) -> str:
    """Incremental load into a partitioned table (MERGE by key, latest wins).

    Touched are the partitions the changes name and those that now hold one of their keys (a key whose
    partition value changed leaves its old partition); the latter come from a semi-join that reads
    key and partition columns only. Touched partitions are read through a semi-join with their
    values (at most ``max_partitions`` rows, checked), which prunes the scan, merged with
    ``upsert_latest``, and written as partitions of a new version. Publishing that version switches all of
    them at once; partitions left without rows are not part of it, all others stay the same folders. A failure
    before the switch changes nothing, and a rerun of the same changes gives the same table.
    """
    spark = changes.sparkSession
    root = table_path(base, layer, name)
    number, folders = current(spark, root)
    existing = read_table(spark, base, layer, name)
    moved = existing.select(*key, *partition_cols).join(changes.select(*key), key, "left_semi")
    parts = changes.select(*partition_cols).unionByName(moved.select(*partition_cols)).distinct()
    rows = parts.limit(max_partitions + 1).collect()
    if len(rows) > max_partitions:
        raise ValueError(f"the changes touch more than {max_partitions} partitions of {layer}.{name}: refresh the table instead")
    if not rows:
        return root
    schema = T.StructType([T.StructField(c, existing.schema[c].dataType, True) for c in partition_cols])
    touched = spark.createDataFrame(rows, schema)
    t = touched.select(*[F.col(c).alias(f"_t_{c}") for c in partition_cols])
    same = [existing[c].eqNullSafe(t[f"_t_{c}"]) for c in partition_cols]
    at_hand = existing.join(F.broadcast(t), same, "left_semi")
    left = {partition_of(unquote(r[0]).rpartition("/")[0]) for r in at_hand.select(F.input_file_name()).distinct().collect()}
    merged = upsert_latest(at_hand, changes.select(*existing.columns), key, order_col, tie_breakers)
    version = f"{VERSION}={number + 1}"
    merged.write.mode("overwrite").partitionBy(*partition_cols).parquet(f"{root}/{version}")
    before = [leaf for f in folders for leaf in leaves(spark, root, f, len(partition_cols) - partition_of(f).count("="))]
    publish(spark, root, number + 1, [f for f in before if partition_of(f) not in left] + leaves(spark, root, version, len(partition_cols)))
    if spark.catalog.tableExists(f"{layer}.{name}") and _catalog_location(spark, f"{layer}.{name}").startswith(_normalise(root)):
        register(spark, base, layer, name, existing.schema)
    return root

"""Session construction for tests and benches, and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "marketlake") -> SparkSession:
    """Local/test session. On a cluster, submit with the cluster's own settings instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2))
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "4g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, shared by the driver and all executors.

    Where it is unset, a local session (one machine, as in tests) sets a private temp folder as
    its own; on a cluster that would leave files on each machine's own disk, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the driver and all executors")
        configured = tempfile.mkdtemp(prefix="marketlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, unique per call."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str = "stage"):
    """Materialise ``df`` as a Parquet table in the shared folder and return a frame reading it.

    Cuts the lineage (lost executors re-read files instead of recomputing) and computes the
    frame once; later counts are answered from Parquet footers. ``remove_staged`` deletes the
    folder once nothing reads the frame any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


def remove_staged(df) -> None:
    """Delete the folder of a frame made by ``stage``."""
    remove_path(df.sparkSession, df._staged_path)


def scale_settings(largest_shuffle_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings sized for a cluster run (the library itself never pins them).

    The initial shuffle partition count makes each reduce task read about
    ``target_partition_bytes`` of the largest shuffle (spill-free sort/aggregate buffers on
    typical executors), but at least two tasks per core; AQE then coalesces smaller stages
    and splits partitions that are still several times the target (hot keys).
    Example: a 20 TB items shuffle on 1000 executors x 8 cores -> 81,920 partitions (~10 waves).
    """
    n = max(2 * total_cores, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }

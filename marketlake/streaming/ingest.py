"""Incremental CSV ingest into raw (bronze) tables with Structured Streaming.

One file stream per dataset over a shared landing folder, filtered to the dataset's file name pattern, gives each new
file's path exactly once (its checkpoint remembers them); file contents aren't read by it. ``availableNow`` drains
what is there in micro-batches of at most ``max_files_per_trigger`` files and stops. Each micro-batch is a load
(``foreachBatch``): its number is the stream's own batch number, and its rows go to a folder of that number, so a
load that failed is repeated by the stream into the same folder: no file is lost or counted twice. The driver
holds one batch's paths, whatever was loaded before.

Files are read by their own header, which tasks read: columns are found by name, whatever their order. A file that
lacks a declared column is refused; a column that isn't declared is added to the table as text (or refused).
Records that don't fit are kept with their raw text in ``_corrupt_record`` and counted.
"""

from __future__ import annotations

import csv
import json
import time
import uuid
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_FILES, RAW_SCHEMAS
from ..session import remove_path
from ..sources.files import record_schema, recorded_schema, write_small_text
from ..sources.snapshots import read_small_text

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CORRUPT = "_corrupt_record"
LOAD = "_load"
METADATA = ["_ingestion_timestamp", "_source_file", CORRUPT, LOAD]
MAX_FILES = 1000
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"  # fixed by Spark


def source_file_column(df: DataFrame) -> Column:
    """File path for file-based frames; 'manual_load' for frames without file metadata."""
    try:
        df.select("_metadata.file_path")
        return F.coalesce(F.col("_metadata.file_path"), F.lit("manual_load"))
    except Exception:  # noqa: BLE001 - frames not read from files have no _metadata column
        return F.lit("manual_load")


def add_ingestion_metadata(df: DataFrame) -> DataFrame:
    """Ingestion time and source file."""
    return df.withColumns({"_ingestion_timestamp": F.current_timestamp(),
                           "_source_file": source_file_column(df)})


def data_columns(df: DataFrame) -> DataFrame:
    """A bronze table without the ingest's own columns."""
    return df.drop(*METADATA)


@dataclass
class IngestResult:
    table_path: str
    rows_added: int
    batches: int
    corrupt_rows: int = 0
    new_columns: tuple[str, ...] = ()


class HeaderError(ValueError):
    """A file's header doesn't fit the declared columns."""


class CorruptRecordError(ValueError):
    """A dataset declared to have one line per record has records that don't parse."""


# ---------------- arrivals ----------------

def arrivals_stream(spark: SparkSession, landing_dir: str, file_glob: str, max_files: int = MAX_FILES,
                    recursive: bool = False) -> DataFrame:
    """Stream of the paths of new files; contents are not read."""
    r = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", file_glob).option("maxFilesPerTrigger", str(max_files))
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.load(landing_dir).select("path", "length")


def await_all(queries: Mapping[str, object], timeout_s: float | None = None) -> None:
    """Wait until every stream has drained. If one fails or the time runs out, stop the others and raise."""
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        for name, q in queries.items():
            left = None if deadline is None else max(0.001, deadline - time.monotonic())
            finished = q.awaitTermination(left) if left is not None else q.awaitTermination()
            if finished is False:
                raise TimeoutError(f"ingest of {name} did not finish in {timeout_s}s")
            if q.exception() is not None:
                raise q.exception()
    finally:
        for q in queries.values():
            if q.isActive:
                q.stop()


# ---------------- loads ----------------

FIRST_READ = 1 << 16


def first_line(uri: str) -> str:
    """The first line of a file; only as much of it is read."""
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))
    head = b""
    with store.open_input_stream(path) as f:
        while b"\n" not in head and (more := f.read(FIRST_READ)):
            head += more
    return head.partition(b"\n")[0].rstrip(b"\r").decode("utf-8-sig")


def _headers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        lines = [first_line(p) for p in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_pydict({"path": b.column(0), "header": pa.array(lines, pa.string())})


def layouts_of(batch: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Column names -> the batch's files that begin with them, read in tasks; files without a line are left out.

    Tasks reach the files through ``pyarrow.fs`` (mounted folders, HDFS, S3, GCS)."""
    sc = batch.sparkSession.sparkContext
    # no more rows than files of one micro-batch
    found = batch.select("path").repartition(sc.defaultParallelism).mapInArrow(_headers, "path string, header string").collect()
    layouts = defaultdict(list)
    for r in sorted(found):
        if r["header"]:
            layouts[tuple(next(csv.reader([r["header"]])))].append(r["path"])
    return layouts


def read_layout(spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: T.StructType,
                columns: list[str], multi_line: bool) -> DataFrame:
    """Files that share a header, as the table's columns by name, with the ingest's own columns."""
    kinds = {f.name: f.dataType for f in schema.fields}
    layout = T.StructType([T.StructField(c, kinds.get(c, T.StringType()), True) for c in header] + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(layout).options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower())
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(paths))
    return add_ingestion_metadata(df).select(
        *[F.col(c) if c in header else F.lit(None).cast(kinds.get(c, T.StringType())).alias(c) for c in columns],
        CORRUPT, "_ingestion_timestamp", "_source_file")


@dataclass
class Dataset:
    """One dataset's ingest: where its files go and how they are read. ``load`` is the stream's batch function."""

    name: str
    table_path: str
    checkpoint: str
    schema: T.StructType
    multi_line: bool = True
    on_new_column: str = "widen"

    def __post_init__(self):
        self.result = IngestResult(self.table_path, 0, 0)
        self.failure: Exception | None = None

    def claim(self, spark: SparkSession) -> None:
        """Bind the table to this checkpoint: batch numbers of another one would overwrite its loads."""
        own = read_small_text(spark, f"{self.checkpoint}/ingest_id")
        if own is None:
            own = uuid.uuid4().hex
            write_small_text(spark, f"{self.checkpoint}/ingest_id", own)
        held = read_small_text(spark, f"{self.table_path}/_ingest_id")
        if held is None:
            write_small_text(spark, f"{self.table_path}/_ingest_id", own)
        elif held != own:
            raise ValueError(f"{self.table_path} was loaded with another checkpoint than {self.checkpoint}")

    def load(self, batch: DataFrame, number: int) -> None:
        try:
            self._load(batch, number)
        except Exception as e:  # kept for the caller, as the stream reports its text only
            self.failure = e
            raise

    def _load(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = recorded_schema(spark, self.table_path)
        added = [f.name for f in known.fields if f.name not in self.schema.names and f.name not in METADATA] if known else []
        layouts, fresh = layouts_of(batch), []
        for header, paths in layouts.items():
            missing = [c for c in self.schema.names if c not in header]
            new = [c for c in header if c not in self.schema.names and c not in added + fresh]
            if missing or len(set(header)) < len(header) or (new and self.on_new_column != "widen"):
                raise HeaderError(f"{self.name}: header {header} of {paths[0]} lacks {missing}, has undeclared {new}")
            fresh += new
        columns = [*self.schema.names, *added, *fresh]
        frames = [read_layout(spark, paths, header, self.schema, columns, self.multi_line) for header, paths in layouts.items()]
        if not frames:
            return
        rows = frames[0]
        for f in frames[1:]:
            rows = rows.unionByName(f)
        seen = Observation(f"load_{number}_{uuid.uuid4().hex[:8]}")
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"))
        target = f"{self.table_path}/{LOAD}={number}"
        rows.write.mode("overwrite").parquet(target)
        if not self.multi_line and seen.get["corrupt"]:
            remove_path(spark, target)
            raise CorruptRecordError(f"{self.name}: {seen.get['corrupt']} records of load {number} don't parse line by line; declare it multi-line")
        if fresh or known is None:
            record_schema(spark, self.table_path, T.StructType([*rows.schema.fields, T.StructField(LOAD, T.IntegerType(), True)]))
        self.result.new_columns += tuple(fresh)
        self.result.rows_added += seen.get["rows"]
        self.result.corrupt_rows += seen.get["corrupt"]
        self.result.batches += 1


def drain(spark: SparkSession, arrivals: Mapping[str, DataFrame], datasets: Mapping[str, Dataset], timeout_s: float | None = None) -> None:
    """Run the streams of some datasets side by side until each has loaded what is there; the first failure is raised."""
    for d in datasets.values():
        d.claim(spark)
    queries = {t: stream.writeStream.foreachBatch(datasets[t].load).option("checkpointLocation", f"{datasets[t].checkpoint}/stream")
               .trigger(availableNow=True).start() for t, stream in arrivals.items()}
    try:
        await_all(queries, timeout_s)
    except TimeoutError:
        raise
    except Exception as e:
        raise next((d.failure for d in datasets.values() if d.failure is not None), e) from None


# ---------------- whole ingest ----------------

def ingest_csv(spark: SparkSession, landing_dir: str, file_glob: str, table_path: str, checkpoint: str,
               schema: T.StructType | None = None, timeout_s: float | None = None, recursive: bool = False,
               multi_line: bool = True, on_new_column: str = "widen", max_files_per_trigger: int | None = None) -> IngestResult:
    """Append the new files of one dataset to a table, exactly once per file.

    Without a ``schema`` the column types are inferred once and remembered beside the checkpoint (S3).
    ``multi_line=False`` declares that every record is one line, so large files are split over tasks; a
    record that doesn't parse then fails the load. ``on_new_column``: "widen" or "reject".
    """
    checkpoint = checkpoint.rstrip("/")
    schema = schema or remembered_schema(spark, landing_dir, file_glob, f"{checkpoint}/schema")
    dataset = Dataset(file_glob, table_path.rstrip("/"), checkpoint, schema, multi_line, on_new_column)
    drain(spark, {file_glob: arrivals_stream(spark, landing_dir, file_glob, max_files_per_trigger or MAX_FILES, recursive)}, {file_glob: dataset}, timeout_s)
    return dataset.result


def ingest_all(spark: SparkSession, landing_dir: str, base: str, checkpoint_base: str, layer: str = "bronze",
               datasets: dict[str, str] | None = None, schemas: Mapping[str, T.StructType | None] | None = None,
               timeout_s: float | None = None, subfolders: bool = False, max_files_per_trigger: int | None = MAX_FILES,
               single_line: frozenset[str] = frozenset(), on_new_column: str = "widen") -> dict[str, IngestResult]:
    """Ingest every dataset; each has its own checkpoint. The streams run side by side and are awaited together
    (one failure or the time-out stops all of them and raises).
    Files are matched by name in one shared landing folder, or with ``subfolders=True`` in
    ``<landing>/<table>/``. ``single_line`` names the datasets declared to have one line per record; all
    others are read as multi-line. A dataset whose schema is None has it inferred once and remembered."""
    from ..sources.files import table_path
    datasets = datasets or RAW_FILES
    schemas = schemas or RAW_SCHEMAS
    max_files = max_files_per_trigger or MAX_FILES
    folder = {t: f"{landing_dir.rstrip('/')}/{t}" if subfolders else landing_dir for t in datasets}
    loads = {}
    for t, glob in datasets.items():
        checkpoint = f"{checkpoint_base.rstrip('/')}/{t}"
        schema = schemas[t] or remembered_schema(spark, folder[t], glob, f"{checkpoint}/schema")
        loads[t] = Dataset(t, table_path(base, layer, t), checkpoint, schema, t not in single_line, on_new_column)
    drain(spark, {t: arrivals_stream(spark, folder[t], glob, max_files) for t, glob in datasets.items()}, loads, timeout_s)
    return {t: d.result for t, d in loads.items()}


def write_landing_csv(df: DataFrame, landing_dir: str) -> str:
    """Write a frame as CSV part files (one per partition) into a landing folder; used by
    tests and the registered ingest queries to produce source files from tables."""
    df.write.mode("errorifexists").options(**CSV_OPTIONS).csv(landing_dir)
    return landing_dir


def remembered_schema(spark: SparkSession, landing_dir: str, file_glob: str, schema_file: str) -> T.StructType:
    """S3: infer the column types once with a batch read of the files present, store the schema
    as JSON next to the checkpoint, and reuse it on every later run (schema memory). Only a missing
    file counts as none: one that can't be read is an error, not a reason to infer again."""
    text = read_small_text(spark, schema_file)
    if text is not None:
        return T.StructType.fromJson(json.loads(text))
    inferred = (spark.read.options(**CSV_OPTIONS).option("inferSchema", "true")
                .option("pathGlobFilter", file_glob).csv(landing_dir).schema)
    write_small_text(spark, schema_file, inferred.json())
    return inferred

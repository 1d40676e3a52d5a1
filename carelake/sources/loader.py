"""New files -> raw VARIANT tables.

One file stream per table is the list of what was loaded: its checkpoint knows
every file it has handed out, ``availableNow`` takes all that is there in
micro-batches of at most ``max_files`` and stops.  Files that no table takes are
in no stream, so they stay open.  A table's files are found by folder
(``<root>/<table>/**``) or by file-name prefix anywhere below the root.

A micro-batch is loaded as the files are, whatever their columns:

1. tasks read each file to its end and return the text of its own Parquet schema;
   a file they cannot read, or one too large to be held whole by a task, is read by Spark on its own,
   split as Spark splits files: no task holds more of a file than ``CHECK_BYTES``;
2. files of equal schema are read together, with that schema, and each row becomes one
   VARIANT (``v``) - so fields the registry does not know, ``_deleted`` and columns
   that changed their type survive, and no type is cast or cut;
3. the batch's rows replace its own folder ``load_id=<batch>``, so a batch that is
   done again after a crash leaves one copy; then its report row per file is written.

A damaged file is set aside whole with its reason and never holds up another.  A
file's schema that VARIANT cannot hold is ``unsupported``, not damage.  A set-aside file is not
looked at again unless it comes under a new name.  The paths of one micro-batch reach the driver (Spark
reads files by path), never those of a table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..registry import ENTITIES
from ..sinks.tables import if_exists
from .files import PARQUET_SUFFIX

FILES = "path string, modificationTime timestamp, length bigint, content binary"    # the file source's own schema
REPORT = "path string, status string, reason string"
RAW = "v variant, _file string, load_id bigint"
#: Larger files are not handed to a task whole.
CHECK_BYTES = 32 << 20
#: Bytes of files that a Python worker gets at once (one file at least).
TOGETHER = 32 << 20
#: Errors of a file that cannot be read; any other error of a load is raised.
UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "Could not read footer", "is not a Parquet file",
              "UNABLE_TO_INFER_SCHEMA")


def own_schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, schema): the text of each file's Parquet schema, null when the file cannot be read to its end."""
    for batch in batches:
        found = []
        for content in batch.column("content"):
            try:
                file = pq.ParquetFile(pa.BufferReader(content.as_buffer()), coerce_int96_timestamp_unit="us")
                for _ in file.iter_batches(batch_size=1 << 14):
                    pass
                found.append(str(file.schema).split("\n", 1)[1])     # less its first line, an address
            except (pa.ArrowException, OSError, ValueError):
                found.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], ["path", "schema"])


def _read(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return (spark.read.option("ignoreCorruptFiles", "false").option("ignoreMissingFiles", "false")
            .option("recursiveFileLookup", "true").parquet(*paths))


def _by_spark(spark: SparkSession, path: str) -> tuple[str | None, str | None]:
    """(schema, None) of a file that Spark reads to its end, else (None, reason)."""
    try:
        rows = _read(spark, [path])
        rows.write.format("noop").mode("overwrite").save()
        return rows.schema.json(), None
    except Exception as e:  # a failed task reaches Python as a bare JVM error
        reason = next((k for k in UNREADABLE if k in str(e)), None)
        if reason is None:
            raise
        return None, reason


def load_files(spark: SparkSession, files: DataFrame, dest: str) -> list[tuple[str, str, str | None]]:
    """Load ``files`` (path, length) into the folder ``dest`` as rows (v, _file), replacing it.

    Returns (path, ``loaded`` / ``corrupt`` / ``unsupported``, reason) of each file."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TOGETHER))
    listed = files.select("path", "length").collect()
    known = dict.fromkeys(r["path"] for r in listed)
    if small := [r["path"] for r in listed if r["length"] <= CHECK_BYTES]:
        held = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "false")
                .option("ignoreMissingFiles", "false").load(small))
        known |= dict(tuple(r) for r in held.select("path", "content").mapInArrow(own_schemas, "path string, schema string").collect())
    report, groups = [], defaultdict(list)
    alone = [p for p, schema in known.items() if schema is None]
    with ThreadPoolExecutor(max_workers=8) as pool:
        judged = dict(zip(alone, pool.map(lambda p: _by_spark(spark, p), alone)))
    for path, schema in sorted(known.items()):
        schema, reason = judged.get(path, (schema, None))
        if schema is None:
            report.append((path, "corrupt", reason))
        else:
            groups[schema].append(path)
    parts = []
    for paths in groups.values():
        rows = _read(spark, paths)                       # one footer tells the schema of the group
        try:
            parts.append(rows.select(F.to_variant_object(F.struct("*")).alias("v"), F.col("_metadata.file_path").alias("_file")))
            status, reason = "loaded", None
        except AnalysisException as e:
            status, reason = "unsupported", e.getCondition()
        report += [(p, status, reason) for p in paths]
    if parts:
        reduce(lambda x, y: x.unionByName(y), parts).write.mode("overwrite").parquet(dest)
    return report


def load_table(spark: SparkSession, root: str, table: str, raw_root: str, state: str, by: str = "folder",
               max_files: int = 1000, options: dict | None = None) -> None:
    """Load all files of ``table`` under ``root`` that no call with this ``state`` has loaded yet.

    ``options`` go to the file source (such as ``cleanSource`` and ``sourceArchiveDir``).  ``state`` and the
    table's raw folder belong together: load ids go on from the state's."""
    if by not in ("folder", "prefix"):
        raise ValueError(f"files are found by folder or prefix, not {by!r}")
    folder, pattern = (f"{root}/{table}", f"*{PARQUET_SUFFIX}") if by == "folder" else (root, f"{table}*{PARQUET_SUFFIX}")
    if if_exists(lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)) is None:
        return                                           # nothing has come yet
    stream = (spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
              .option("maxFilesPerTrigger", max_files).options(**(options or {})).load(folder))

    def flush(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        report = load_files(own, batch, f"{raw_root}/{table}/load_id={batch_id}")
        if report:
            own.createDataFrame(report, REPORT).coalesce(1).write.mode("overwrite").parquet(
                f"{state}/report/{table}/batch_id={batch_id}")
    # a batch's rows are computed as they stand here: with the content, every file would be held whole, the large ones too
    query = (stream.select("path", "length").writeStream.foreachBatch(flush).option("checkpointLocation", f"{state}/files/{table}")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def load_new_files(spark: SparkSession, root: str, raw_root: str, state: str, by: str = "folder", max_files: int = 1000,
                   tables: Sequence[str] = tuple(ENTITIES)) -> None:
    """``load_table`` for all tables, as concurrent streams; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        done = [pool.submit(load_table, spark, root, t, raw_root, state, by, max_files) for t in tables]
        for d in done:
            d.result()


def read_raw(spark: SparkSession, raw_root: str, table: str) -> DataFrame:
    """(v, _file, load_id) rows of a raw table; empty before its first load."""
    rows = if_exists(lambda: spark.read.schema(RAW).parquet(f"{raw_root}/{table}"))
    return spark.createDataFrame([], RAW) if rows is None else rows


def read_report(spark: SparkSession, state: str) -> DataFrame:
    """(table_name, path, status, reason) of every file that was taken."""
    schema = REPORT + ", table_name string, batch_id bigint"
    found = [if_exists(lambda t=t: spark.read.schema(schema).parquet(f"{state}/report/{t}").withColumn("table_name", F.lit(t)))
             for t in ENTITIES]
    rows: Callable = lambda x, y: x.unionByName(y)
    found = [f for f in found if f is not None]
    out = reduce(rows, found) if found else spark.createDataFrame([], schema)
    return out.select("table_name", "path", "status", "reason")

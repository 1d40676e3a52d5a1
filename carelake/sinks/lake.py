"""Date-partitioned Parquet lake, one folder per table.

Layout ``<root>/[<prefix>/]<table>/date=YYYY-MM-DD/...``; ``date`` is the
*processing* date of the write.  Streaming writers add a ``batch_id``
partition level and overwrite only their own batch's folder, also when
nothing is left for it.  A batch's date is recorded before its first write and read back
by a replay (``batch_date``), so a batch replayed after midnight replaces its
own files instead of adding a second copy.

A closed day's batches can be put together (``compact_day``): the rows go, in
files of a fixed size, to a folder that listings pass over, and one pointer
switches readers to it; the batch folders may then be dropped.

Every row keeps the whole change image as JSON text (``image``) beside the
typed columns: source fields that the registry does not know are not lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..registry import WIRE_TYPES
from ..sources.files import list_files
from .tables import POINTERS, if_exists, publish_versions, remove_folder, write_version

BATCHES = "batch_id bigint, date date"
#: Size of the files that a closed day is written to.
FILE_BYTES = 128 << 20


def clean_prefix(prefix: str | None) -> str:
    """The consumer's prefix rule: surrounding spaces and slashes removed."""
    return (prefix or "").strip().strip("/")


def table_path(root: str, table: str, prefix: str | None = None) -> str:
    p = clean_prefix(prefix)
    return "/".join(x for x in (root.rstrip("/"), p, table) if x)


def lake_schema(table: str, with_batch: bool = False) -> str:
    ddl = ", ".join(f"{n} {t}" for n, t in WIRE_TYPES[table])
    ddl += ", position bigint, _deleted boolean, image string, date date"
    if with_batch:
        ddl += ", batch_id bigint"
    return ddl


def batch_date(spark: SparkSession, root: str, batch_id: int, today: Column) -> str:
    """The date a micro-batch belongs to: the one recorded at its first attempt, else ``today``."""
    path = f"{root.rstrip('/')}/_batches"
    known = if_exists(lambda: spark.read.schema(BATCHES).parquet(path))
    row = known.where(F.col("batch_id") == batch_id).agg(F.min("date")).first() if known is not None else None
    if row is not None and row[0] is not None:
        return str(row[0])
    first = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"), today.cast("date").alias("date"))
    first.write.mode("append").parquet(path)
    return batch_date(spark, root, batch_id, today)


def write_lake(df: DataFrame, root: str, table: str, run_date: str | Column,
               prefix: str | None = None, batch_id: int | None = None) -> None:
    if batch_id is not None:
        if not isinstance(run_date, str):
            raise ValueError("a batch's folder needs its date as text (batch_date)")
        df.write.mode("overwrite").parquet(batch_path(root, table, run_date, batch_id, prefix))
        return
    d = F.lit(run_date).cast("date") if isinstance(run_date, str) else run_date.cast("date")
    df.withColumn("date", d).write.mode("append").partitionBy("date").parquet(table_path(root, table, prefix))


def batch_path(root: str, table: str, date: str, batch_id: int, prefix: str | None = None) -> str:
    """The folder that one batch owns."""
    return f"{table_path(root, table, prefix)}/date={date}/batch_id={batch_id}"


def read_lake_table(spark: SparkSession, root: str, table: str, prefix: str | None = None,
                    with_batch: bool = False) -> DataFrame:
    """Read one lake table with an explicit schema: ``_deleted`` exists even
    when no file of the table holds a delete (schema drift)."""
    schema = lake_schema(table, with_batch)
    path = table_path(root, table, prefix)
    days = compacted_days(spark, path) if with_batch else {}
    rows = if_exists(lambda: spark.read.schema(schema).parquet(path)) if days else spark.read.schema(schema).parquet(path)
    if not days:
        return rows
    together = spark.read.schema(schema).parquet(*days.values())
    return together if rows is None else rows.where(~F.col("date").cast("string").isin(*days)).unionByName(together)


def compacted_days(spark: SparkSession, path: str) -> dict[str, str]:
    """Day -> folder of the days of a lake table that were put together (a few hundred a year)."""
    log = if_exists(lambda: spark.read.schema(POINTERS).parquet(f"{path}/_catalog"))
    if log is None:
        return {}
    return {r["name"]: r["path"] for r in log.groupBy("name").agg(F.max_by("path", "seq").alias("path")).collect()}


def compact_day(spark: SparkSession, root: str, table: str, day: str, prefix: str | None = None,
                file_bytes: int = FILE_BYTES) -> int:
    """Put the batches of a closed day together in files of about ``file_bytes``; returns how many files.

    A day is closed once a batch of a later day was begun; any other is an error.  The batch folders stay until
    ``drop_batches`` (a file stream may still have to read them); readers go by the new folder."""
    batches = if_exists(lambda: spark.read.schema(BATCHES).parquet(f"{root.rstrip('/')}/_batches"))
    last = batches.agg(F.max("date")).first()[0] if batches is not None else None
    if last is None or str(last) <= day:
        raise ValueError(f"{day} is not closed: no batch of a later day was begun")
    path = table_path(root, table, prefix)
    if day in compacted_days(spark, path):
        return 0
    folder = f"{path}/date={day}"
    found = if_exists(lambda: list_files(spark, folder).agg(F.sum("length")).first()[0])
    if not found:
        return 0                                         # no rows of this table on that day
    count = max(1, -(-found // file_bytes))
    rows = spark.read.schema(lake_schema(table, with_batch=True)).parquet(path).where(F.col("date") == F.lit(day).cast("date"))
    at = write_version(rows.repartition(count), path, f"_days/{day}", publish=False)
    publish_versions(spark, path, [(day, at, None)])
    return count


def drop_batches(spark: SparkSession, root: str, table: str, day: str, prefix: str | None = None) -> None:
    """Remove the batch folders of a day that was put together."""
    path = table_path(root, table, prefix)
    if day in compacted_days(spark, path):
        remove_folder(spark, f"{path}/date={day}")

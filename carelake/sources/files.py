"""Lake file discovery and routing; ``sources.loader`` loads what is new.

* ``route_by_prefix`` - table = first registry name the *file name* starts
  with, in the fixed order; no match -> skipped.
* ``route_by_folder`` - table = second path segment, exact match.
* ``list_files`` / ``new_files`` - recursive listing with a suffix filter, minus the
  files a ledger knows; only paths are compared.
* ``load_object``     - one named object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..registry import PREFIX_ROUTING_ORDER

PARQUET_SUFFIX = ".parquet"


def file_name(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def route_by_prefix(keys: DataFrame, key: str = "key", order=PREFIX_ROUTING_ORDER) -> DataFrame:
    name = file_name(F.col(key))
    table = F.lit(None).cast("string")
    for t in reversed(order):
        table = F.when(name.startswith(t), F.lit(t)).otherwise(table)
    out = keys.where(F.col(key).endswith(PARQUET_SUFFIX)).withColumn("table_name", table)
    return out.where(F.col("table_name").isNotNull())


def route_by_folder(keys: DataFrame, key: str = "key", tables=PREFIX_ROUTING_ORDER) -> DataFrame:
    folder = F.element_at(F.split(F.col(key), "/"), 2)
    out = keys.where(F.col(key).endswith(PARQUET_SUFFIX)).withColumn(
        "table_name", F.when(folder.isin(*tables), folder))
    return out.where(F.col("table_name").isNotNull())


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of the Parquet files under ``root`` at any depth; no content is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*" + PARQUET_SUFFIX).load(root))
    return files.select("path", "length")


def new_files(listing: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Listed files that the ledger (column ``path``) does not have."""
    return listing if ledger is None else listing.join(ledger.select("path").distinct(), "path", "left_anti")


def load_object(spark: SparkSession, key: str | None, schema: str) -> DataFrame:
    """Event-driven load of one named object (a Parquet file or a folder of
    Parquet parts).  A missing key is an error; a key with another suffix
    yields an empty frame with the table schema (nothing to load)."""
    if not key:
        raise ValueError("object key is required")
    if not key.rstrip("/").endswith(PARQUET_SUFFIX):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(key)

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

#: A word for sizes and shingles: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of rows that are handed to a Python worker at once.
BATCH_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared folder and read it back.

    Cuts the lineage durably: a lost executor costs only the tasks that were
    running, and later readers see the real byte size, so a broadcast is
    chosen by Spark from a measured size only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it (elsewhere it is installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    # long texts and packed rows: a batch is bounded by its bytes, not by 10,000 rows
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable in the workers."""
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would touch other letters)."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*parts: Column) -> Column:
    """A 60-bit hash as a non-negative long, the same in any SQL engine that has md5."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less any columns called ``names`` (the operator's own columns replace them)."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])

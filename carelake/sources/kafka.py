"""Change stream from Kafka topics (one topic per captured table).

Needs the Spark Kafka connector on the classpath (not part of this
install, so it is not exercised by the tests).  Offsets live in the query's
``checkpointLocation``: no consumer group or auto-commit, and together with
the batch-id-idempotent lake sink delivery is exactly-once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


#: Low bits of a position that hold the offset; those above hold the partition.
OFFSET_BITS = 44


def topics_for(server: str, tables: Sequence[str], schema: str = "public") -> list[str]:
    """``<server>.<schema>.<table>`` per captured table (include list, trimmed)."""
    return [f"{server}.{schema}.{t.strip()}" for t in tables]


def log_position(partition: Column, offset: Column) -> Column:
    """One comparable number per record: offsets order a partition, and a key stays in one partition."""
    return F.shiftleft(partition.cast("bigint"), OFFSET_BITS) + offset


def change_stream(spark: SparkSession, bootstrap: str, topics: Sequence[str],
                  starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                  options: dict | None = None) -> DataFrame:
    """``(topic, position, value)`` rows - the shape ``sources.envelope.decode`` takes."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", ",".join(topics))
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    src = r.load()
    return src.select("topic", log_position(F.col("partition"), F.col("offset")).alias("position"),
                      F.col("value").cast("string").alias("value"))

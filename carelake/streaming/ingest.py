"""Structured Streaming jobs built from the batch operators.

* ``envelopes_to_lake``  - change stream -> decode -> classify -> per-table
  date-partitioned Parquet + quarantine, in ``foreachBatch`` (empty batches
  skipped; a replayed batch overwrites its own ``batch_id`` partition under
  the date of its first attempt, so with the checkpoint each change is in the
  lake once).
* ``lake_to_raw``        - file stream over a lake table -> raw table with the
  whole image in a VARIANT column ``v`` (file sink, with its own log).
* ``current_state``      - latest row per key from a raw stream: a streaming
  ``max_by`` aggregation in update mode; every batch appends the changed
  keys to a change log partitioned by ``batch_id`` and the current state is
  the newest change per key.  Late and out-of-order rows are resolved by
  event time, never dropped (no watermark on this path).

Sources are pluggable: anything yielding ``(topic, position, value)`` works,
e.g. ``readStream.format('kafka')`` when its connector is on the classpath
(it is not in this install), or JSON files as in the tests.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cdc
from ..operators.latest import latest_by_rank, order_struct
from ..operators.staging import tiebreak_for, typed, wire_columns
from ..registry import ENTITIES, EntitySpec
from ..sinks.lake import batch_date, table_path, write_lake
from ..sinks.tables import if_exists
from ..sources.envelope import decode
from ..sources.files import list_files
from ..functions.types import PARITY_FEE_TYPE, PATIENT_DATE_BASE

ENVELOPE_FILE_SCHEMA = "topic string, position bigint, value string"
REJECTS_SCHEMA = "position bigint, topic string, op string, reason string, date date, batch_id bigint"


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def envelopes_to_lake(stream: DataFrame, lake_root: str, quarantine_root: str, checkpoint: str,
                      run_date: str | None = None, accept_flat: bool = False,
                      trigger: dict | None = None, tables=None, topics=None):
    # what the sinks take; envelopes and images that were not chosen are not kept with the batch
    classified = cdc.classify(decode(stream, accept_flat=accept_flat, topics=topics)).select(
        "topic", "position", "table_name", "op", "kind", "reason", "image")
    names = list(tables or ENTITIES)

    def flush(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():          # nothing arrived: no files, no folders
            return
        batch.persist()
        try:
            date = batch_date(batch.sparkSession, lake_root, batch_id, F.lit(run_date) if run_date else F.current_date())
            present = {r[0] for r in batch.where(F.col("kind") != "reject")
                       .select("table_name").distinct().collect()}       # <= number of tables
            steps = [lambda t=t: write_lake(cdc.unified(batch, t).drop("table_name"), lake_root, t, date, batch_id=batch_id)
                     for t in names if t in present]
            steps.append(lambda: write_lake(cdc.rejects(batch), quarantine_root, "rejects", date, batch_id=batch_id))
            with ThreadPoolExecutor(max_workers=len(steps)) as pool:     # one batch id; the first failure fails the batch
                for done in [pool.submit(step) for step in steps]:
                    done.result()
        finally:
            batch.unpersist()

    w = classified.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def lake_to_raw(spark: SparkSession, lake_root: str, table: str, raw_root: str, checkpoint: str,
                trigger: dict | None = None, max_files: int | None = None):
    from ..sinks.lake import lake_schema
    r = spark.readStream.schema(lake_schema(table, with_batch=True))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    src = r.parquet(table_path(lake_root, table))
    raw = src.select(F.parse_json("image").alias("v"), "_deleted", "position",
                     F.col("_metadata.file_path").alias("_file"), F.current_timestamp().alias("_loaded_at"))
    w = (raw.writeStream.format("parquet").option("path", table_path(raw_root, table))
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, trigger).start()


def staged_aggregate(raw: DataFrame, spec: EntitySpec, *, fee_type: str = PARITY_FEE_TYPE,
                     date_base: str = PATIENT_DATE_BASE) -> DataFrame:
    """Staging as a streaming-capable aggregate: newest typed row per key."""
    w = wire_columns(raw, spec, ("b", "position"))
    for k in spec.required:
        w = w.where(F.col(k).isNotNull())
    rest = [(n, kind) for n, kind in spec.fields if n != spec.key]
    row = F.struct(*[typed(spec, kind, F.col(n), fee_type, date_base).alias(n) for n, kind in rest])
    ordk = order_struct([F.col(spec.order_col)], tiebreak_for(spec, w))
    agg = w.groupBy(spec.key).agg(F.max_by(row, ordk).alias("row"))
    return agg.select(spec.key, *[F.col(f"row.{n}").alias(n) for n, _ in rest])


def current_state(stream_raw: DataFrame, spec: EntitySpec, log_path: str, checkpoint: str,
                  trigger: dict | None = None):
    agg = staged_aggregate(stream_raw, spec)

    def flush(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(log_path))

    w = agg.writeStream.outputMode("update").foreachBatch(flush).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def read_current_state(spark: SparkSession, log_path: str, spec: EntitySpec,
                       base_root: str | None = None, base_name: str | None = None) -> DataFrame:
    """Current state = newest change per key over (compacted base ∪ newer log batches)."""
    from ..sinks import tables
    log = spark.read.parquet(log_path)
    base = tables.read_current(spark, base_root, base_name) if base_root and base_name else None
    if base is not None:
        upto = base.agg(F.max("batch_id")).scalar()
        log = base.unionByName(log.where(F.col("batch_id") > upto))
    cols = [n for n, _ in spec.fields]
    return latest_by_rank(log, spec.key, ["batch_id"]).select(*cols, F.col("rn").cast("int").alias("rn"))


def compact_state(spark: SparkSession, log_path: str, spec: EntitySpec, base_root: str,
                  base_name: str) -> str:
    """Fold the change log into a new base version (one row per key, with the
    batch it last changed in).  Readers then scan only log batches newer than
    the base; older log partitions may be removed by retention."""
    from ..sinks import tables
    log = spark.read.parquet(log_path)
    base = tables.read_current(spark, base_root, base_name)
    if base is not None:
        upto = base.agg(F.max("batch_id")).scalar()
        log = base.unionByName(log.where(F.col("batch_id") > upto))
    newest = latest_by_rank(log, spec.key, ["batch_id"], keep_rn=False)
    return tables.write_version(newest, base_root, base_name)


def await_or_stop(query, timeout_s: float) -> bool:
    """Bounded wait: True when the stream finished by itself, False when the
    limit was reached and it was stopped."""
    done = query.awaitTermination(timeout_s)
    if not done:
        query.stop()
    return bool(done)


def wait_for_file(spark: SparkSession, root: str, matches: Callable[[DataFrame], DataFrame], timeout_s: float,
                  poke_s: float = 30.0) -> bool:
    """Look for a matching file every ``poke_s`` seconds; True as soon as there is one, False at the limit."""
    end = time.monotonic() + timeout_s
    while True:
        listing = if_exists(lambda: list_files(spark, root))
        if listing is not None and matches(listing).limit(1).count():
            return True
        left = end - time.monotonic()
        if left <= 0:
            return False
        time.sleep(min(poke_s, left))

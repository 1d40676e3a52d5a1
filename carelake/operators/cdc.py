"""CDC record classification: upsert images, delete images, rejects.

Same rules, same precedence as the consumer the survey describes:
no payload -> reject; unknown topic -> reject; op c/u/r with an ``after``
image -> upsert (emit ``after``); op d with a ``before`` image -> delete
(emit ``before`` with ``_deleted = true``); anything else -> reject, and so
is an image that is no JSON object.  Accepted rows carry the whole ``image``
beside the typed wire columns, so fields the registry does not know survive.
Every row lands in exactly one class, so ``upserts + deletes + rejects``
equals the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..registry import WIRE_TYPES
from ..sources.envelope import DELETE_OP, UPSERT_OPS, _is_object, _present, typed_image

#: Why a record is a reject; the first rule it breaks.
REASONS = ("tombstone", "no_payload", "unknown_topic", "invalid_op", "invalid_image")


def classify(decoded: DataFrame) -> DataFrame:
    """Add ``kind`` (upsert/delete/reject), ``reason`` and the emitted image text ``image``."""
    ok, known, op = F.col("payload_ok"), F.col("known_table"), F.col("op")
    # every step is a column of its own: written into one another they would be computed again at each place they stand
    steps = decoded.select("*", (ok & known & op.isin(*UPSERT_OPS) & _present(F.col("after"))).alias("_up"),
                           (ok & known & (op == DELETE_OP) & _present(F.col("before"))).alias("_dl"))
    up, dl, image, sound = map(F.col, ("_up", "_dl", "_image", "_sound"))
    steps = steps.select("*", F.when(up, F.col("after")).when(dl, F.col("before")).alias("_image"))
    steps = steps.select("*", F.coalesce(_is_object(image, F.col("value")), F.lit(False)).alias("_sound"))
    kind = F.when(up & sound, "upsert").when(dl & sound, "delete").otherwise("reject")
    reason = (F.when(F.col("value").isNull(), "tombstone")      # key-only record after a delete
              .when(~ok, "no_payload").when(~known, "unknown_topic")
              .when(~F.coalesce(up | dl, F.lit(False)), "invalid_op").when(~sound, "invalid_image"))
    # The three outputs are produced by a one-row generator: consumers filter
    # on ``kind``, and a filter over plain projections would be rewritten
    # into the scan-side filter with every alias substituted - re-parsing the
    # envelope JSON once per reference.  Generator outputs are not
    # substituted, so each envelope is parsed once and classified once.
    out = F.struct(kind.alias("kind"), reason.alias("reason"), image.alias("image"))
    return steps.select(*decoded.columns, F.inline(F.array(out)))


def _typed(df: DataFrame, table: str, extra=()) -> DataFrame:
    t = df.select("table_name", typed_image(F.col("image"), table).alias("_r"), "position", *extra, "image")
    return t.select("table_name", *[F.col(f"_r.{n}").alias(n) for n, _ in WIRE_TYPES[table]],
                    "position", *extra, "image")


def upserts(classified: DataFrame, table: str) -> DataFrame:
    c = classified.where((F.col("kind") == "upsert") & (F.col("table_name") == table))
    return _typed(c, table)


def deletes(classified: DataFrame, table: str) -> DataFrame:
    c = classified.where((F.col("kind") == "delete") & (F.col("table_name") == table))
    return _typed(c.withColumn("_deleted", F.lit(True)), table, ("_deleted",))


def unified(classified: DataFrame, table: str) -> DataFrame:
    """Upserts and deletes of one table in one frame (one scan, one parse per
    row); ``_deleted`` is true on delete images and NULL on upserts."""
    c = classified.where((F.col("kind") != "reject") & (F.col("table_name") == table))
    c = c.withColumn("_deleted", F.when(F.col("kind") == "delete", F.lit(True)))
    return _typed(c, table, ("_deleted",))


def rejects(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("kind") == "reject").select("position", "topic", "op", "reason")


def op_counts(classified: DataFrame) -> DataFrame:
    """Accepted records per table and op (the consumer's per-batch log line)."""
    return (classified.where(F.col("kind") != "reject")
            .groupBy("table_name", "op").agg(F.count(F.lit(1)).alias("cnt")))

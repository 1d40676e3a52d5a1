"""Dimensions and the wide appointment fact.

Version selection for the dimension side of the fact joins:

* ``all``     - every SCD2 version joins (reference behaviour; fans out)
* ``current`` - only open versions (``dbt_valid_to is null``)
* ``as_of``   - the version valid at the event time:
                ``valid_from <= t < valid_to`` (open end = infinity).  A key's
                versions do not overlap, so it is the last one begun by then:
                versions and events of a key go through one sort by time and
                the last version is carried forward (``as_of``): E + V rows per
                key, not E x V pairs.  A key with more than ``HOT`` events is dealt
                to several parts, each with all its versions.

No join below forces a broadcast: the snapshot sides grow with the data.
The jobs run with the static threshold off (``session.joins_by_measure``), so
a side is broadcast only when its *measured* shuffle size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise skewed
partitions of the event side are split (left outer joins may split the left
side).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.display import no_show_flag
from ..session import scratch_path

# Fixed values that must equal the reference's for right results: the
# attributes of the dimensions and the columns of the fact, in order.
DIM_ATTRS = {
    "doctor": ("doctor_id", "doctor_name", "specialty", "experience_years"),
    "hospital": ("hospital_id", "hospital_name", "city", "country", "bed_capacity"),
    "patient": ("patient_id", "patient_name", "gender", "date_of_birth", "city"),
}

FACT_COLUMNS = (
    "appointment_id", "appointment_time", "consultation_fee", "event_type",
    "patient_id", "patient_name", "gender", "date_of_birth",
    "doctor_id", "doctor_name", "specialty", "experience_years",
    "hospital_id", "hospital_name", "hospital_city", "country",
    "no_show_flag",
)


def build_dim(snapshot: DataFrame, entity: str) -> DataFrame:
    return snapshot.select(
        *DIM_ATTRS[entity], "created_at",
        F.col("dbt_valid_from").alias("effective_from"),
        F.col("dbt_valid_to").alias("effective_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
    )


def select_versions(snap: DataFrame, mode: str) -> DataFrame:
    if mode == "current":
        return snap.where(F.col("dbt_valid_to").isNull())
    if mode in ("all", "as_of"):
        return snap
    raise ValueError(f"version mode {mode!r}")


#: Events of one key that one task sorts; more are dealt to parts.  Hot keys (some 50 bytes each) that may be broadcast.
HOT, SMALL = 1_000_000, 100_000


def hot_keys(events: DataFrame, keys: Sequence[str], hot: int = HOT) -> dict[str, DataFrame | None]:
    """For each column of ``keys`` the table (_hot, _parts) of values with more than ``hot`` events; None without any.

    One aggregation (a row per key and task is shuffled) whose short result, at most events / hot rows per
    column, is written."""
    spark, path = events.sparkSession, scratch_path(events.sparkSession, "hot-keys")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("_hot")) for k in keys]))
    counts = (events.select(each.alias("x")).where(F.col("x._hot").isNotNull()).groupBy("x.name", "x._hot")
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot))
    found = counts.select("name", "_hot", F.ceil(F.col("n") / hot).cast("int").alias("_parts"))
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    sizes = dict(map(tuple, found.groupBy("name").count().collect()))          # a number per column
    own = lambda k: found.where(F.col("name") == k).drop("name")
    return {k: None if k not in sizes else F.broadcast(own(k)) if sizes[k] <= SMALL else own(k) for k in keys}


def as_of(events: DataFrame, versions: DataFrame, key: str, at: str, cols: dict[str, str], hot: dict[str, DataFrame | None]) -> DataFrame:
    """``events`` with the columns ``cols`` (source name -> new name) of the version of ``key`` that is valid at
    time ``at``: ``dbt_valid_from <= at < dbt_valid_to``; NULLs where there is none (also for a NULL key or time).

    ``hot``: of ``hot_keys``."""
    found = F.struct(F.col("dbt_valid_to").alias("_to"), *[F.col(src).alias(dst) for src, dst in cols.items()])
    side = versions.where(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.col("dbt_valid_from").alias("_t"), found.alias("_v"))
    parts = hot[key]
    if parts is None:                                    # no hot key: nothing is joined
        with_parts = lambda rows, k: rows.withColumn("_parts", F.lit(1))
    else:
        with_parts = lambda rows, k: rows.join(parts, F.col(k).cast("string") == F.col("_hot"), "left").drop("_hot")
    n = F.coalesce(F.col("_parts"), F.lit(1))
    whole = F.xxhash64(*events.columns)
    left = with_parts(events, key).select(
        F.struct(*events.columns).alias("_e"), F.col(at).alias("_t"), F.lit(None).cast(side.schema["_v"].dataType).alias("_v"),
        # an event without a key has no version: it goes anywhere
        F.col(key).alias("_k"), F.pmod(whole, F.when(F.col(key).isNull(), F.lit(1 << 20)).otherwise(n)).cast("int").alias("_part"))
    right = with_parts(side, "_k").select(
        F.lit(None).cast(left.schema["_e"].dataType).alias("_e"), "_t", "_v", "_k",
        F.explode(F.sequence(F.lit(0), n - 1)).alias("_part"))
    both = right.unionByName(left)
    # a version begun at the very time of an event counts; events without a time come before all versions
    order = Window.partitionBy("_k", "_part").orderBy(F.col("_t").asc_nulls_first(), F.col("_e").isNotNull())
    last = F.last("_v", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = both.withColumn("_v", last).where(F.col("_e").isNotNull())
    valid = F.col("_v._to").isNull() | (F.col("_t") < F.col("_v._to"))
    return both.select("_e.*", *[F.when(valid, F.col(f"_v.{c}")).alias(c) for c in cols.values()])


def _join_dim(left: DataFrame, snap: DataFrame, key: str, cols: dict[str, str],
              mode: str, at: str, hot: dict[str, DataFrame | None]) -> DataFrame:
    if mode == "as_of":
        return as_of(left, snap, key, at, cols, hot)
    side = select_versions(snap, mode)
    pre = "_" + key
    side = side.select(F.col(key).alias(pre), *[F.col(src).alias(dst) for src, dst in cols.items()])
    return left.join(side, F.col(key) == F.col(pre), "left").drop(pre)


def build_fact(events: DataFrame, patient_snap: DataFrame, doctor_snap: DataFrame,
               hospital_snap: DataFrame, version_mode: str = "all",
               as_of_col: str = "event_timestamp") -> DataFrame:
    """``events`` = staged appointment events (one row per appointment); in mode ``as_of`` they are written
    first, as their keys are counted."""
    e = events.select("appointment_id", "appointment_time", "consultation_fee", "event_type",
                      "patient_id", "doctor_id", "hospital_id", as_of_col)
    if version_mode == "as_of":
        path = scratch_path(e.sparkSession, "staged-events")
        e.write.parquet(path)
        e = e.sparkSession.read.schema(e.schema).parquet(path)
    hot = hot_keys(e, ("patient_id", "doctor_id", "hospital_id")) if version_mode == "as_of" else {}
    f = _join_dim(e, patient_snap, "patient_id",
                  {"patient_name": "patient_name", "gender": "gender",
                   "date_of_birth": "date_of_birth"}, version_mode, as_of_col, hot)
    f = _join_dim(f, doctor_snap, "doctor_id",
                  {"doctor_name": "doctor_name", "specialty": "specialty",
                   "experience_years": "experience_years"}, version_mode, as_of_col, hot)
    f = _join_dim(f, hospital_snap, "hospital_id",
                  {"hospital_name": "hospital_name", "city": "hospital_city",
                   "country": "country"}, version_mode, as_of_col, hot)
    return f.select(*[c for c in FACT_COLUMNS if c != "no_show_flag"],
                    no_show_flag(F.col("event_type")).alias("no_show_flag"))

"""The dashboard as DataFrames: one summary row plus two small listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import aggregates as agg
from ..operators.topk import top_k


def summary(fact: DataFrame, patient_dim: DataFrame, doctor_dim: DataFrame,
            hospital_dim: DataFrame, day: str, status: str = "CONFIRMED",
            case_sensitive: bool = True, weight: str | None = None) -> DataFrame:
    """Five numbers in one row.  The fact, or events with the fact rows each
    stands for in ``weight``, is scanned once (conditional counts, map-side
    partial aggregation); each distinct count is its own two-phase
    aggregate attached as a scalar subquery - nothing is cross-joined."""
    on_day = agg.day_range("appointment_time", day)
    active = on_day & agg.status_match("event_type", status, case_sensitive)
    p = patient_dim.agg(F.count_distinct("patient_id").alias("c"))
    d = doctor_dim.agg(F.count_distinct("doctor_id").alias("c"))
    h = hospital_dim.agg(F.count_distinct("hospital_id").alias("c"))
    return fact.agg(agg.rows_where(on_day, weight).alias("today_appointments"),
                    agg.rows_where(active, weight).alias("active_appointments")).select(
        "today_appointments", "active_appointments",
        p.scalar().alias("total_patients"), d.scalar().alias("total_doctors"),
        h.scalar().alias("total_hospitals"))


def recent(fact: DataFrame, k: int = 10) -> DataFrame:
    cols = ["appointment_time", "doctor_name", "patient_id", "event_type"]
    return top_k(fact.select(*cols), k, "appointment_time", cols[1:])


def specialty_stats(fact: DataFrame, doctor_dim: DataFrame, weight: str | None = None) -> DataFrame:
    counts = agg.specialty_counts(fact, doctor_dim, weight)
    return agg.with_share(counts).orderBy(F.col("cnt").desc(), F.col("specialty").asc_nulls_last())

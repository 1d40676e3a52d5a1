"""Dashboard aggregates: day counts, distinct entities, grouped shares."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.types import ts_lit


def day_range(col: str, day: str) -> Column:
    """``cast(col as date) = day`` written as a half-open range so the
    predicate reaches the Parquet scan when ``col`` is a stored column."""
    d = _dt.date.fromisoformat(day)
    nxt = (d + _dt.timedelta(days=1)).isoformat()
    return (F.col(col) >= ts_lit(f"{day} 00:00:00")) & (F.col(col) < ts_lit(f"{nxt} 00:00:00"))


def status_match(col: str, literal: str, case_sensitive: bool = True) -> Column:
    if case_sensitive:
        return F.col(col) == F.lit(literal)
    return F.lower(F.col(col)) == F.lit(literal.lower())


def fan_out(events: DataFrame, snaps: dict[str, DataFrame], mode: str, weight: str = "n_rows") -> DataFrame:
    """``events`` with the number of fact rows each becomes, without building the fact.

    In mode ``all`` an event has one row per combination of versions, so the
    number is a product of versions per key (1 where no version matches); only
    counts per key meet the events.  An open version, or the version valid
    at the event time, is at most one per key: the number is 1."""
    if mode != "all":
        return events.withColumn(weight, F.lit(1).cast("bigint"))
    out, n = events, F.lit(1).cast("bigint")
    for i, (key, snap) in enumerate(snaps.items()):
        counts = (snap.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k{i}"))
                  .agg(F.count(F.lit(1)).alias(f"_n{i}")))
        out = out.join(counts, F.col(key) == F.col(f"_k{i}"), "left")
        n = n * F.coalesce(F.col(f"_n{i}"), F.lit(1).cast("bigint"))
    return out.select(*events.columns, n.alias(weight))


def rows_where(cond: Column, weight: str | None = None) -> Column:
    """Rows that fulfil ``cond``; with ``weight`` each counts for that many."""
    if weight is None:
        return F.count_if(cond)
    return F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("bigint")


def count_on_day(fact: DataFrame, day: str, status: str | None = None, case_sensitive: bool = True,
                 alias: str = "cnt", weight: str | None = None) -> DataFrame:
    cond = day_range("appointment_time", day)
    if status is not None:
        cond = cond & status_match("event_type", status, case_sensitive)
    return fact.where(cond).agg(rows_where(F.lit(True), weight).alias(alias))


def distinct_entities(patient_dim: DataFrame, doctor_dim: DataFrame,
                      hospital_dim: DataFrame) -> DataFrame:
    """One row: exact distinct keys over all versions of each dimension.

    Each count is its own aggregation (a two-phase distinct on its key); the
    three one-row results are combined as scalar subqueries, no cross join.
    """
    p = patient_dim.agg(F.count_distinct("patient_id").alias("c"))
    d = doctor_dim.agg(F.count_distinct("doctor_id").alias("c"))
    h = hospital_dim.agg(F.count_distinct("hospital_id").alias("c"))
    return p.select(F.col("c").alias("total_patients"),
                    d.scalar().alias("total_doctors"),
                    h.scalar().alias("total_hospitals"))


def specialty_counts(fact: DataFrame, doctor_dim: DataFrame, weight: str | None = None) -> DataFrame:
    """``count(*)`` of ``fact JOIN doctor_dim ON doctor_id`` grouped by specialty.

    Both sides are reduced before they meet: fact rows per doctor, dim rows
    per (doctor, specialty).  The join then sees one row per doctor instead of
    the fanned-out product, and ``sum(n_fact * n_dim)`` is the exact count.
    """
    f = (fact.where(F.col("doctor_id").isNotNull()).groupBy("doctor_id")
         .agg(rows_where(F.lit(True), weight).alias("nf")))
    d = (doctor_dim.where(F.col("doctor_id").isNotNull())
         .groupBy("doctor_id", "specialty").agg(F.count(F.lit(1)).alias("nd")))
    return (f.join(d, "doctor_id").groupBy("specialty")
            .agg(F.sum(F.col("nf") * F.col("nd")).cast("bigint").alias("cnt")))


def with_share(counts: DataFrame, cnt: str = "cnt", alias: str = "share") -> DataFrame:
    """Bar width: ``round_half_even(cnt / greatest(max(cnt), 1) * 100)``.

    The maximum is taken over the grouped rows (one per specialty), so the
    counts are planned and computed once.
    """
    mx = F.max(cnt).over(Window.partitionBy())
    return counts.withColumn(
        alias, F.bround(F.col(cnt) / F.greatest(F.coalesce(mx, F.lit(1)), F.lit(1)) * 100, 0))

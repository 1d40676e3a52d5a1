"""Staging: raw change rows -> typed, one row per key (a lazy view).

``stage(raw, spec)`` = required-key filter, typed projection, latest per key.
``raw`` is either a raw table with a variant column ``v`` or a table whose
columns are already the wire columns; a load-batch column ``b`` (when
present) is the tie-break "later load wins" for entity tables, then the source
position; events without one go by the numeric part of ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.types import (PARITY_FEE_TYPE, PATIENT_DATE_BASE, days_to_date, id_number,
                               micros_to_ts, wire_value)
from ..registry import WIRE_TYPES, EntitySpec
from .latest import latest_by_max_by, latest_by_rank


def typed(spec: EntitySpec, kind: str, wire: Column, fee_type: str, date_base: str) -> Column:
    if kind == "string":
        return wire.cast("string")
    if kind == "int":
        return wire.cast("int")
    if kind == "lower":
        return F.lower(wire.cast("string"))
    if kind == "ts_us":
        return micros_to_ts(wire)
    if kind == "days":
        return days_to_date(wire, date_base)
    if kind == "fee":
        return wire.cast(fee_type)
    raise ValueError(kind)


def wire_columns(raw: DataFrame, spec: EntitySpec, extra: tuple[str, ...] = ()) -> DataFrame:
    """Project the wire fields (from ``v`` or typed columns) plus bookkeeping."""
    cols = raw.columns
    wt = dict(WIRE_TYPES[spec.name])
    names = [n for n, _ in spec.fields]
    if spec.name == "appointment_events":
        names = ["event_id"] + names
    out = [wire_value(cols, n, wt[n]).alias(n) for n in names]
    out += [F.col(c) for c in extra if c in cols]
    return raw.select(*out)


def tiebreak_for(spec: EntitySpec, df: DataFrame) -> list[Column]:
    """Later change wins ties: load run, then source position (offset / LSN).

    Events without a position go by the number in their id (unreadable: NULL)."""
    base = [F.col("b")] if "b" in df.columns and spec.name != "appointment_events" else []
    if "position" in df.columns:
        base.append(F.col("position"))
    if spec.name == "appointment_events":
        base.append(id_number(F.col("event_id")))
    return base


def stage(raw: DataFrame, spec: EntitySpec, run_ts: Column | None = None, *,
          fee_type: str = PARITY_FEE_TYPE, date_base: str = PATIENT_DATE_BASE,
          method: str = "rank", deletes: str = "ignore", keep_deleted: bool = False) -> DataFrame:
    """Typed latest-per-key view of a raw table.

    ``deletes='ignore'`` keeps delete images like any change (reference
    behaviour); ``'drop'`` removes keys whose winning change is a delete.
    """
    extra = ("b", "_deleted", "position")
    w = wire_columns(raw, spec, extra)
    # Required keys are tested on the cast value: JSON null and missing alike.
    for k in spec.required:
        w = w.where(F.col(k).isNotNull())
    order = [F.col(spec.order_col)]            # the raw integer, as the reference ranks
    tb = tiebreak_for(spec, w)
    typed_cols = [typed(spec, kind, F.col(n), fee_type, date_base).alias(n)
                  for n, kind in spec.fields]
    keep = [F.col(c) for c in ("_deleted",) if c in w.columns]
    if method == "rank":
        ranked = w.select(*typed_cols, *keep, *[c.alias(f"_tb{i}") for i, c in enumerate(tb)],
                          F.col(spec.order_col).alias("_ord"))
        out = latest_by_rank(ranked, spec.key, [F.col("_ord")],
                             [F.col(f"_tb{i}") for i in range(len(tb))])
        out = out.drop("_ord", *[f"_tb{i}" for i in range(len(tb))])
    elif method == "max_by":
        pre = w.select(*typed_cols, *keep, *[c.alias(f"_tb{i}") for i, c in enumerate(tb)],
                       F.col(spec.order_col).alias("_ord"))
        out = latest_by_max_by(pre, spec.key, [F.col("_ord")],
                               [F.col(f"_tb{i}") for i in range(len(tb))])
        out = out.drop("_ord", *[f"_tb{i}" for i in range(len(tb))]).withColumn("rn", F.lit(1))
    else:
        raise ValueError(method)
    if deletes == "drop" and "_deleted" in out.columns:
        out = out.where(F.coalesce(F.col("_deleted"), F.lit(False)) == F.lit(False))
    cols = [n for n, _ in spec.fields]
    if keep_deleted:
        if "_deleted" not in out.columns:
            out = out.withColumn("_deleted", F.lit(None).cast("boolean"))
        cols.append("_deleted")
    elif "_deleted" in out.columns:
        out = out.drop("_deleted")
    if spec.load_timestamp:
        lt = run_ts if run_ts is not None else F.current_timestamp().cast("timestamp_ntz")
        out = out.withColumn("load_timestamp", lt)
        cols.append("load_timestamp")
    return out.select(*cols, F.col("rn").cast("int").alias("rn"))


def view_sql(spec: EntitySpec, run_ts: str, *, fee_type: str = PARITY_FEE_TYPE, date_base: str = PATIENT_DATE_BASE) -> str:
    """``stage`` as the text of a view over a raw table ``{table}`` with columns v, b and position
    (``sinks.tables.catalog_view``): the newest change per key; ``run_ts`` is its load time."""
    wire = dict(WIRE_TYPES[spec.name])
    names = [n for n, _ in spec.fields] + (["event_id"] if spec.name == "appointment_events" else [])
    fields = ", ".join(f"try_variant_get(v, '$.{n}', '{wire[n]}') as {n}" for n in names)
    kinds = {"string": "{0}", "int": "cast({0} as int)", "lower": "lower({0})", "fee": f"cast({{0}} as {fee_type})",
             "ts_us": "cast(timestamp_micros({0}) as timestamp_ntz)", "days": f"date_add(date '{date_base}', {{0}})"}
    typed_cols = ", ".join(f"{kinds[kind].format(n)} as {n}" for n, kind in spec.fields)
    there = " and ".join(f"{k} is not null" for k in spec.required)
    ties = ["position desc nulls first", "cast(substring(event_id, 2) as bigint) desc nulls first"] if (
        spec.name == "appointment_events") else ["b desc nulls first", "position desc nulls first"]
    order = ", ".join([f"{spec.order_col} desc nulls first", *ties])
    load = f", timestamp_ntz '{run_ts}' as load_timestamp" if spec.load_timestamp else ""
    return f"""select {typed_cols}{load}, cast(rn as int) as rn from (
  select *, row_number() over (partition by {spec.key} order by {order}) as rn
  from (select {fields}, b, position from {{table}}) w where {there}) r where rn = 1"""

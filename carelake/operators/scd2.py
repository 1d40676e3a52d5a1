"""SCD2 snapshots with the "check" strategy.

A run compares the staged rows with the *open* versions by key:

* key not open yet                    -> insert a version (valid_from = run)
* any check column differs (null-safe) -> close the open one (valid_to = run)
                                         and insert the staged row
* otherwise                           -> nothing (other columns are NOT
                                         refreshed; they go stale on purpose)

Keys missing from the staged set stay open (``deletes='ignore'``), or are
closed when their staged row is a delete image (``deletes='close'``).

Two ways to compute it:

* ``merge`` - one run against stored history, which is read once: one full
  outer join on the key, in which closed versions match nothing and pass
  through (open versions and staged rows are unique per key), and one
  ``explode`` emits the 0-2 output rows of each joined row.  So plans grow by
  one join per run, and callers that keep closed versions elsewhere pass only
  the open ones.
* ``replay`` - all runs at once from the raw changes: reduce to one row per
  (key, run) with map-side partial aggregation (so a hot key costs one row
  per run), carry the newest row forward with a running ``max_by``, keep the
  runs whose tracked values changed (``lag``), and close each version at the
  next one (``lead``).  Equal to folding ``merge`` over the runs (tested).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..registry import EntitySpec
from .latest import order_struct
from .staging import stage, tiebreak_for, typed, wire_columns
from ..functions.types import PARITY_FEE_TYPE, PATIENT_DATE_BASE

SCD_COLS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def scd_id(key: Column, updated_at: Column) -> Column:
    """md5(key || '|' || updated_at) with the text form 'yyyy-MM-dd HH:mm:ss[.f]'."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(updated_at.cast("string"), F.lit(""))))


def _null_ts() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def first_run(staged: DataFrame, spec: EntitySpec, run_ts: Column) -> DataFrame:
    return staged.select(
        "*",
        scd_id(F.col(spec.key), run_ts).alias("dbt_scd_id"),
        run_ts.alias("dbt_updated_at"),
        run_ts.alias("dbt_valid_from"),
        _null_ts().alias("dbt_valid_to"),
    )


def changed(check_cols: Sequence[str], left: str, right: str) -> Column:
    conds = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in check_cols]
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def merge(history: DataFrame | None, staged: DataFrame, spec: EntitySpec, run_ts: Column,
          deletes: str = "ignore") -> DataFrame:
    """One snapshot run.  ``staged`` holds one row per key (staging output;
    with ``deletes='close'`` it may carry a boolean ``_deleted``)."""
    if history is None:
        base = staged
        if "_deleted" in staged.columns:
            if deletes == "close":      # a key first seen as deleted opens nothing
                base = base.where(~F.coalesce(F.col("_deleted"), F.lit(False)))
            base = base.drop("_deleted")
        return first_run(base, spec, run_ts)
    hist_cols = history.columns
    staged_cols = [c for c in hist_cols if c not in SCD_COLS]
    k = spec.key
    s = staged if "_deleted" in staged.columns else staged.withColumn("_deleted", F.lit(None).cast("boolean"))
    on = (F.col(f"o.{k}") == F.col(f"s.{k}")) & F.col("o.dbt_valid_to").isNull()
    j = history.alias("o").join(s.alias("s"), on, "full_outer")
    o_here, s_here = F.col(f"o.{k}").isNotNull(), F.col(f"s.{k}").isNotNull()
    is_del = F.coalesce(F.col("s._deleted"), F.lit(False)) if deletes == "close" else F.lit(False)
    chg = o_here & s_here & ~is_del & changed(spec.check_cols, "o", "s")
    close_now = chg | (o_here & s_here & is_del)
    old_row = F.when(o_here, F.struct(
        *[F.col(f"o.{c}").alias(c) for c in staged_cols],
        F.col("o.dbt_scd_id").alias("dbt_scd_id"),
        F.col("o.dbt_updated_at").alias("dbt_updated_at"),
        F.col("o.dbt_valid_from").alias("dbt_valid_from"),
        F.when(close_now, run_ts).otherwise(F.col("o.dbt_valid_to")).alias("dbt_valid_to")))
    new_row = F.when(s_here & ~is_del & (~o_here | chg), F.struct(
        *[F.col(f"s.{c}").alias(c) for c in staged_cols],
        scd_id(F.col(f"s.{k}"), run_ts).alias("dbt_scd_id"),
        run_ts.alias("dbt_updated_at"),
        run_ts.alias("dbt_valid_from"),
        _null_ts().alias("dbt_valid_to")))
    rows = j.select(F.explode(F.filter(F.array(old_row, new_row), lambda x: x.isNotNull())).alias("r"))
    return rows.select("r.*")


def fold(raw: DataFrame, spec: EntitySpec, runs: Sequence[tuple[int, Column]], **stage_kw) -> DataFrame:
    """Run the snapshot once per run: staging sees the raw rows loaded so far."""
    hist = None
    for b, ts in runs:
        staged = stage(raw.where(F.col("b") <= b), spec, ts, **stage_kw)
        hist = merge(hist, staged, spec, ts)
    return hist


def replay(raw: DataFrame, spec: EntitySpec, run_ts_col: str = "run_ts", *,
           runs: Sequence[tuple[int, Column]] | None = None, deletes: str = "ignore",
           fee_type: str = PARITY_FEE_TYPE, date_base: str = PATIENT_DATE_BASE) -> DataFrame:
    """All snapshot runs in one set-based pass over the raw changes.

    ``deletes='close'``: a run whose newest change of a key is a delete image
    (``_deleted``) closes the open version and opens none; a later change
    opens one again.

    ``raw`` carries the load run ``b`` and its time ``run_ts`` per row (or
    ``runs`` maps each run number to its time).
    """
    if run_ts_col not in raw.columns:
        if not runs:
            raise ValueError("replay needs a run time column or the run list")
        t = F.lit(None).cast("timestamp_ntz")
        for b, ts in reversed(list(runs)):
            t = F.when(F.col("b") == b, ts).otherwise(t)
        raw = raw.withColumn(run_ts_col, t)
    w = wire_columns(raw, spec, ("b", run_ts_col, "position", "_deleted"))
    gone = F.coalesce(F.col("_deleted"), F.lit(False)) if deletes == "close" and "_deleted" in w.columns else F.lit(False)
    for key in spec.required:
        w = w.where(F.col(key).isNotNull())
    k = spec.key
    staged_cols = [n for n, _ in spec.fields if n != k]
    typed_cols = [typed(spec, kind, F.col(n), fee_type, date_base).alias(n)
                  for n, kind in spec.fields if n != k]
    ordk = order_struct([F.col(spec.order_col)], tiebreak_for(spec, w))
    # (1) newest change per (key, run): partial aggregation map-side.
    per_run = w.groupBy(k, "b").agg(
        F.max_by(F.struct(*typed_cols, gone.alias("_gone")), ordk).alias("row"),
        F.max(ordk).alias("ord"),
        F.max(run_ts_col).alias("run_ts"))
    # (2) what staging would return at each run: newest row seen so far.
    wk = Window.partitionBy(k).orderBy("b")
    upto = wk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = per_run.select(k, "b", "run_ts", F.max_by("row", "ord").over(upto).alias("row"))
    # (3) keep runs whose tracked values changed; first appearance always kept.
    chk = [F.col(f"row.{c}") for c in (*spec.check_cols, "_gone")]
    prev = [F.lag(c).over(wk) for c in chk]
    first = F.lag("b").over(wk).isNull()
    diff = F.lit(False)
    for c, p in zip(chk, prev):
        diff = diff | ~c.eqNullSafe(p)
    kept = staged.withColumn("_keep", first | diff).where("_keep")
    # (4) a version closes when the next one opens.
    out = kept.select(
        k, *[F.col(f"row.{c}").alias(c) for c in staged_cols],
        *([F.col("run_ts").alias("load_timestamp")] if spec.load_timestamp else []),
        F.lit(1).alias("rn"),
        scd_id(F.col(k), F.col("run_ts")).alias("dbt_scd_id"),
        F.col("run_ts").alias("dbt_updated_at"),
        F.col("run_ts").alias("dbt_valid_from"),
        F.lead("run_ts").over(Window.partitionBy(k).orderBy("b")).alias("dbt_valid_to"),
        F.col("row._gone").alias("_gone"),
    )
    return out.where(~F.col("_gone")).drop("_gone")


def with_validity_checks(snap: DataFrame, spec: EntitySpec) -> DataFrame:
    """Per key: versions that overlap, and number of open versions (both should be 0/1)."""
    w = Window.partitionBy(spec.key).orderBy("dbt_valid_from")
    return snap.select(
        spec.key,
        (F.lead("dbt_valid_from").over(w) < F.coalesce(F.col("dbt_valid_to"),
                                                      F.lit("9999-12-31").cast("timestamp_ntz"))).alias("overlap"),
        F.col("dbt_valid_to").isNull().alias("is_open"),
    ).groupBy(spec.key).agg(F.count_if("overlap").alias("overlaps"), F.count_if("is_open").alias("open"))

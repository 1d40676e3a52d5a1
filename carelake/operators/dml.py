"""Keyed batch writes: the source-side CRUD re-aimed as set operations.

The reference changes one row per request; a Spark job applies a whole batch
of requests at once, and each form below is one or two joins on the key:

* ``insert_if_absent`` - existing row wins; within the batch the first
  request in ``order`` wins (``min_by``, one row per key leaves each task).
* ``update_by_key``    - only the listed columns change; the last request in
                         ``order`` wins; a matched flag lets an update set
                         NULL; unmatched updates do nothing.
* ``delete_by_key``    - ``left_anti``.
* ``append_rows``      - plain union with the write time stamped.
* ``allocate_ids``     - next ids = max numeric suffix + dense sequence.

Parquet tables have no ``MERGE INTO``; the result is written to a new
version of the table (``sinks.tables``), never over the files being read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.types import id_number
from .latest import order_struct


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_per_key(df: DataFrame, key: str, order: Sequence) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*[_c(o) for o in order])).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def last_per_key(df: DataFrame, key: str, order: Sequence) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*rest), order_struct([], order)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


#: All white space that may surround a typed key: ASCII, its separators, and Unicode spaces.
KEY_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
             "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def normalize_key(c) -> Column:
    """Form keys lose surrounding white space of any kind and are upper-cased before use."""
    return F.upper(F.btrim(_c(c), F.lit(KEY_SPACE)))


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str, order: Sequence) -> DataFrame:
    """``order`` says which request for a key comes first (``order=[]``: any one of them)."""
    inc = first_per_key(incoming.select(*target.columns), key, order or [F.lit(0)]).select(*target.columns)
    new = inc.join(target.select(key), key, "left_anti")
    return target.unionByName(new)


def update_by_key(target: DataFrame, updates: DataFrame, key: str, set_cols: Sequence[str],
                  order: Sequence) -> DataFrame:
    """``order`` says which request for a key comes last (``order=[]``: any one of them)."""
    order = list(order) or [F.lit(0)]
    u = last_per_key(updates.select(key, *set_cols, *[_c(o).alias(f"_o{i}") for i, o in enumerate(order)]),
                     key, [F.col(f"_o{i}") for i in range(len(order))]).select(key, *set_cols)
    u = u.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_u_{c}") for c in set_cols],
                 F.lit(True).alias("_matched"))
    j = target.join(u, target[key] == F.col("_k"), "left")
    out = [F.when(F.col("_matched"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c)
           if c in set_cols else F.col(c) for c in target.columns]
    return j.select(*out)


def delete_by_key(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def append_rows(target: DataFrame, rows: DataFrame, stamp_col: str | None = None,
                stamp: Column | None = None) -> DataFrame:
    if stamp_col is not None:
        rows = rows.withColumn(stamp_col, stamp)
    return target.unionByName(rows.select(*target.columns))


def dense_sequence(df: DataFrame, order: Sequence[str], start: Column | int = 1,
                   name: str = "seq", partitions: int | None = None) -> DataFrame:
    """Number rows 1..n in ``order`` without funnelling them through one task.

    Range-partition by the order, cut lineage with ``checkpoint()`` (so the
    partition of every row is fixed even if a task is retried), count rows
    per partition, turn the counts into offsets (one row per partition - a
    proven size bound, so that table is broadcast), then number within each
    partition.  ``order`` must be unique per row for a repeatable result.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_pid").orderBy(*order)
    base = start if isinstance(start, Column) else F.lit(start)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, base + F.col("_off") + F.row_number().over(within) - 1)
            .drop("_pid", "_off"))


def allocate_ids(requests: DataFrame, existing: DataFrame, id_col: str, order: Sequence[str],
                 prefix: str, width: int, name: str | None = None) -> DataFrame:
    """New ids ``prefix + zero-padded(max suffix + seq)`` after the existing max."""
    mx = existing.agg(F.max(id_number(F.col(id_col))).alias("m")).scalar()
    seq = dense_sequence(requests, order, start=F.coalesce(mx, F.lit(0)) + 1, name="_seq")
    return seq.withColumn(name or id_col, F.format_string(f"{prefix}%0{width}d", F.col("_seq"))).drop("_seq")


def parse_number(text, kind: str = "double") -> Column:
    """Form text -> number of ``kind`` (double, int); NULL when it is none, with white space around it ignored."""
    return F.btrim(_c(text), F.lit(KEY_SPACE)).try_cast(kind)


def domain_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations) for every rule broken at least once.

    Each row emits only the names of the rules it breaks (``explode`` of a
    filtered array), and the count is a partially aggregated ``groupBy``.
    """
    names = F.array(*[F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()])
    bad = df.select(F.explode(F.filter(names, lambda x: x.isNotNull())).alias("rule"))
    return bad.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))

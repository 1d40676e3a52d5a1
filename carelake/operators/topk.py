"""Ordered listings and top-k reports.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
its own k best rows and only those reach the final merge, so a top-k over
any table size moves k rows per task.  Orders spell out NULL placement
(newest-first puts NULL times first) and end in a total tie-break, so the
k rows are the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def top_k(df: DataFrame, k: int, newest: str | Column, tiebreak: Sequence = (),
          descending: bool = True) -> DataFrame:
    first = _c(newest).desc_nulls_first() if descending else _c(newest).asc_nulls_last()
    rest = [_c(t).asc_nulls_last() for t in tiebreak]
    return df.orderBy(first, *rest).limit(k)


def rows_of_top(df: DataFrame, k: int, time: str, descending: bool = True) -> DataFrame:
    """Rows that can be among the ``k`` first by ``time``: those up to the k-th value, its ties included.

    Rows may be multiplied afterwards (left joins) without changing the first
    k of the result, so a join behind this sees few rows.
    """
    best = top_k(df.select(time), k, time, descending=descending)
    if descending:          # NULLs come first: a NULL k-th value leaves NULLs only
        kth = best.agg(F.when(F.count(F.lit(1)) > F.count(time), F.when(F.count(time) > 0, F.min(time)))
                       .otherwise(F.min(time)).alias("t"))
        cut = kth.scalar()
        return df.where(F.col(time).isNull() | (F.col(time) >= cut))
    last = best.agg(F.when(F.count(F.lit(1)) == F.count(time), F.max(time)).alias("t")).scalar()
    return df.where(last.isNull() | (F.col(time) <= last))


def listing(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    return df.select(*cols).orderBy(F.col(key).asc_nulls_last())

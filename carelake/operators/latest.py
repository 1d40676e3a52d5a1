"""Latest row per key (row_number + rank filter, or max_by).

Ordering is "newest first" with NULL order values FIRST - the warehouse the
reference targets sorts NULLs first on DESC, so a change whose timestamp is
missing wins.  A deterministic tie-break (source position, later wins) makes
the choice repeatable when timestamps tie.

Two physical forms, same result:

* ``latest_by_rank``: ``row_number() over (partition by key order by ...)``
  filtered to ``rn = 1``.  Catalyst turns the filter into a WindowGroupLimit,
  which keeps one row per key *inside each map task* before the shuffle, so
  a key holding a third of all rows ships one row per task, not its rows.
* ``latest_by_max_by``: ``groupBy(key).agg(max_by(struct(*), order))`` - one
  row per key leaves each map task, but ``max_by`` over a struct is a sort
  aggregate, so every task sorts its rows first; it is the form Structured
  Streaming accepts (row_number is refused on streams).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def newest_first(order: Sequence, tiebreak: Sequence = ()) -> list[Column]:
    """Sort expressions: order columns DESC NULLS FIRST, then tie-breaks DESC."""
    return ([c.desc_nulls_first() for c in _cols(order)]
            + [c.desc_nulls_first() for c in _cols(tiebreak)])


def row_number_by_key(df: DataFrame, key: str | Sequence[str], order: Sequence,
                      tiebreak: Sequence = (), rn: str = "rn") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*newest_first(order, tiebreak))
    return df.withColumn(rn, F.row_number().over(w))


def latest_by_rank(df: DataFrame, key: str | Sequence[str], order: Sequence,
                   tiebreak: Sequence = (), rn: str = "rn", keep_rn: bool = True) -> DataFrame:
    out = row_number_by_key(df, key, order, tiebreak, rn).where(F.col(rn) == 1)
    return out if keep_rn else out.drop(rn)


def order_struct(order: Sequence, tiebreak: Sequence = ()) -> Column:
    """A struct whose max is the newest-first winner (NULLs win, in order columns and tie-breaks alike)."""
    parts = []
    for i, c in enumerate([*_cols(order), *_cols(tiebreak)]):
        parts += [c.isNull().alias(f"_n{i}"), c.alias(f"_o{i}")]
    return F.struct(*parts)


def latest_by_max_by(df: DataFrame, key: str | Sequence[str], order: Sequence,
                     tiebreak: Sequence = ()) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), order_struct(order, tiebreak)).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])

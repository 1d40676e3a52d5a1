"""Mixing sources to target weights by hash-threshold histograms.

Sources in code-point order (null last) get the weights ``weights``, repeating.
Together they share ``share`` times all words; no source gets more than ``cap``
times its own words, and what one cannot take is reshared by weight.

A source's target is a number of whole copies of every document plus a rest.
The rest goes to the documents whose hash lies under a threshold.  The threshold
is found without sorting: words are summed by source and hash bucket, the running
sum names the one bucket in which the rest runs out, and only that bucket is split
again, until it holds one hash value.  Thresholds are nested: a larger target keeps
what a smaller one took.

Defined cases: null text has size 0; rows that share a hash (a repeated ``doc_id``,
null ids) at the threshold each take the same part of their words, so the boundary
document gives just the words that are still wanting; very long texts are counted whole, each in one
task, and only their counts move; an empty table gives an empty result; other columns are ignored, and columns with the names of this
operator's own are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.dml import dense_sequence
from .common import hash60, materialise, without, word_count

HASH_BITS = 60
OWN = ("size", "source_size", "target", "taken", "copies")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size) rows."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_source = by_source.withColumn("_null", F.col("source").isNull())
    ranked = dense_sequence(by_source, ["_null", "source"], start=0, name="_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("_rank") % len(weights)).cast("int") + 1)
    src = materialise(ranked.select("source", "source_size", weight.alias("_w"),
                                    (F.col("source_size") * F.lit(float(cap))).alias("_cap")), "mix-sources")
    budget, level, full = None, 0.0, -1
    while True:      # each round caps at least one more source, and moves two numbers to the driver
        capped = F.col("_cap") <= F.lit(level) * F.col("_w") if full >= 0 else F.lit(False)
        row = src.agg(F.sum("source_size").alias("all"), F.sum(F.when(capped, F.col("_cap"))).alias("held"),
                      F.sum(F.when(~capped, F.col("_w"))).alias("w"), F.count(F.when(capped, 1)).alias("n")).first()
        budget = share * (row["all"] or 0)
        if row["n"] == full or not row["w"]:
            break
        level, full = (budget - (row["held"] or 0.0)) / row["w"], row["n"]
    return src.select("source", "source_size", F.least("_cap", F.lit(level) * F.col("_w")).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame, bits: int = 10) -> DataFrame:
    """Per source the whole copies, the boundary hash, and the part its rows take.

    ``sizes`` has (source, size, h).  Each round reads only rows in the boundary
    bucket of their source and sums them in at most ``2**bits`` buckets.
    """
    words = F.round("target").cast("long")
    goal = targets.select("source", "source_size", "target",
                          F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size"))
                          .otherwise(0).alias("copies"))
    goal = goal.withColumn("rest", words - F.col("copies") * F.col("source_size"))
    bound = materialise(goal.select("*", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before")),
                        "mix-goal")
    shift = HASH_BITS
    while shift > 0:
        up, shift = shift, max(0, shift - bits)
        b = bound.select(F.col("source").alias("_s"), "prefix")
        inside = sizes.join(b, sizes["source"].eqNullSafe(b["_s"])
                            & (F.shiftright(sizes["h"], up) == b["prefix"]))
        hist = (inside.groupBy("source", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("upto", F.sum("words").over(run)).withColumnRenamed("source", "_s")
        kept = bound.select("source", "source_size", "target", "copies", "rest", F.col("before").alias("_b"))
        found = (kept.join(hist, kept["source"].eqNullSafe(hist["_s"]))
                 .filter((F.col("_b") + F.col("upto") - F.col("words") <= F.col("rest"))
                         & (F.col("rest") < F.col("_b") + F.col("upto"))))
        bound = materialise(found.select("source", "source_size", "target", "copies", "rest",
                                         F.col("bucket").alias("prefix"),
                                         (F.col("_b") + F.col("upto") - F.col("words")).alias("before"),
                                         "words", "lo", "hi"), "mix-bound")
        if not bound.filter("lo < hi").limit(1).count():
            break
    return bound.select("source", F.col("lo").alias("at"), (F.col("rest") - F.col("before")).alias("wanting"),
                        F.col("words").alias("tied"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        seed: str = "mix", carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with size, source_size, target and taken (words the mix takes, repeats counted).

    ``carry`` names the columns to keep (default: all of ``docs``); without
    ``text`` among them the texts are read once and never shuffled.
    """
    carry = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in OWN]
    measured = docs.select(*[F.col(f"`{c}`") for c in carry if c not in ("source", "doc_id")], "doc_id", "source",
                           word_count(F.col("text")).alias("size"),
                           hash60(F.lit(seed), F.col("doc_id")).alias("_mix_h"))
    narrow = materialise(measured.select(*[c for c in measured.columns if c != "text"]), "mix-sizes")
    sizes = narrow.select("source", "size", F.col("_mix_h").alias("h"))
    goals = materialise(source_targets(sizes, weights, share, cap), "mix-targets")
    a, g = thresholds(sizes, goals).alias("a"), goals.alias("g")
    plan = g.join(a, F.col("g.source").eqNullSafe(F.col("a.source")), "left").select(
        F.col("g.source").alias("_mix_s"), "source_size", "target", F.col("at").alias("_mix_at"),
        F.col("wanting").alias("_mix_wanting"), F.col("tied").alias("_mix_tied"),
        F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size"))
        .otherwise(F.lit(0)).alias("copies"))
    plan = materialise(plan, "mix-plan")
    rows = measured if "text" in carry else narrow
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["_mix_s"]))
    hashed, at = F.col("_mix_h"), F.col("_mix_at")
    part = F.expr("cast(size * cast(_mix_wanting as decimal(20,0)) div _mix_tied as bigint)")
    extra = (F.when(hashed < at, F.col("size")).when(hashed == at, part)
             .otherwise(F.lit(0)))
    taken = F.coalesce(F.col("copies") * F.col("size") + extra, F.lit(0)).cast("long")
    order = [c for c in carry] + [c for c in ("doc_id", "source") if c not in carry]
    return joined.withColumn("taken", taken).select(
        *[F.col(f"`{c}`") for c in order], "size", "source_size", "target", "taken", "copies")

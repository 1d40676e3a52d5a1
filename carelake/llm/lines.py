"""Line dedup by winnowing over line hashes.

A text is its lines; a line counts as its words, without white space at its ends, and
blank lines are passed over.  A window is the shortest run of lines, from each line on, with
``min_words`` words.  Equal runs have equal windows, so every repeated run of that many words
is seen:

1. each window selects the least line hash in it as its fingerprint;
2. fingerprints that stand in one place only are left out by an aggregate, and with them
   all windows that cannot be repeated;
3. windows on the remaining fingerprints meet by the hash of all their lines, and all
   but the first - by (doc_id, text hash, line) - are repeats;
4. repeated windows that touch or overlap are one run, and its lines are deleted.

A window starts at every line, so a run is found from its first line on, but the lines behind
its last window, ``min_words`` - 1 words at most, stay.  With ``extend`` they go too, and
what goes is every line of a run of ``min_words`` words or more that stands at an earlier place:

5. a window is prolonged line by line, as long as the lines behind its first one have
   under ``min_words`` words (beyond that, the next line's window sees them), and to a next
   line that is a window itself (blank lines may lie between); the prolonged windows meet by their hash like
   the windows, each against its own first place.  No line ends more than one of them, so
   they are no more than the lines.

The registered query and the pipeline extend.

A fingerprint or a window that a third of all documents share is one partial minimum per
task; no positions are paired with each other.  Only DataFrame operations are used.

Defined cases: null and empty texts stay as they are; rows that share doc_id and text are
the same text and are cut alike; rows that share only the doc_id go by the hash of
their text; null ids come last; texts under ``min_words`` words keep all lines; a
text may become empty; the lines of a very long text are hashes in one task; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, materialise, without

MIN_WORDS = 30
DOC = ["_line_null", "_line_id", "_line_text"]


def _identity(docs: DataFrame) -> dict[str, Column]:
    key = F.col("doc_id").cast("long")
    return dict(zip(DOC, (key.isNull(), F.coalesce(key, F.lit(0)), F.xxhash64("text"))))


def line_windows(docs: DataFrame, min_words: int, extend: bool = False) -> DataFrame:
    """(doc, pos, stop, place, fp, k1, k2): the windows, their fingerprint, its place and the hash of all lines.

    With ``extend`` also _line_more: the lines behind the window that prolong it, as (h, pos).
    """
    lines = F.split(F.col("text"), "\n", -1)
    measured = F.transform(lines, lambda x: F.struct(F.xxhash64(F.btrim(x, F.lit(" \t\r"))).alias("h"),
                                                     F.regexp_count(x, F.lit(WORD)).alias("n")))
    ended = F.concat(measured, F.array(F.struct(F.lit(0).cast("long").alias("h"), F.lit(1).alias("n"))))
    # rows that share doc_id and text are one, in each task before the shuffle; all windows below go by its partitions
    rows = docs.withColumns(_identity(docs)).select(*DOC, ended.alias("xs")).groupBy(*DOC).agg(F.first("xs").alias("xs"))
    # the last row of a document marks its end; blank lines leave
    rows = rows.select(*DOC, F.posexplode("xs").alias("pos", "x")).filter("x.n > 0")
    rows = rows.select(*DOC, "pos", F.col("x.h").alias("h"), F.col("x.n").cast("long").alias("n"))
    doc = Window.partitionBy(*DOC)
    rows = rows.withColumn("s", F.coalesce(F.sum("n").over(
        doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = doc.orderBy("s").rangeBetween(0, min_words - 1)          # at most min_words lines
    after = doc.orderBy("s").rangeBetween(min_words, Window.unboundedFollowing)
    more = []
    if extend:
        then = lambda c, k=1: F.lead(c, k).over(doc.orderBy("pos"))
        rows = rows.withColumns({"e": F.col("s") + F.col("n"), "end": then("pos").isNull(), "over": F.when(
            then("pos", 2).isNotNull() & (then("n") >= min_words),
            F.array(F.struct(then("h").alias("h"), then("pos").alias("pos"))))})
        behind = doc.orderBy("e").rangeBetween(1, min_words - 1)
        tail = F.collect_list(F.when(~F.col("end"), F.struct("h", "pos"))).over(behind)
        more = [F.coalesce("over", tail).alias("more")]
    rows = rows.select(*DOC, "pos", F.first("pos").over(after).isNotNull().alias("full"),
                       F.collect_list(F.struct("h", "pos")).over(inside).alias("xs"), *more)
    rows = rows.filter("full").withColumns({"least": F.array_min("xs"),
                                            "stop": F.element_at("xs", -1)["pos"] + 1})
    hashes = F.transform("xs", lambda x: x["h"])
    if extend:
        more = [F.filter("more", lambda x: x["pos"] >= F.col("stop")).alias("_line_more")]
    return rows.select(*DOC, "pos", "stop", F.col("least.h").alias("fp"), F.col("least.pos").alias("place"),
                       F.xxhash64(hashes).alias("k1"), F.xxhash64(F.lit(7), hashes).alias("k2"), *more)


def prolonged_repeats(wins: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc, pos, stop) of the prolonged windows that repeat an earlier place; ``firsts`` has the keys of repeated windows."""
    able = wins.filter(F.size("_line_more") > 0).join(firsts, ["k1", "k2"], "left_semi")
    hashes = F.transform("_line_more", lambda x: x["h"])
    each = F.transform(F.sequence(F.lit(1), F.size("_line_more")), lambda i: F.struct(
        F.xxhash64(F.slice(hashes, 1, i)).alias("p1"), F.xxhash64(F.lit(7), F.slice(hashes, 1, i)).alias("p2"),
        (F.get("_line_more", i - 1)["pos"] + 1).alias("stop")))
    longer = materialise(able.select(*DOC, "pos", "k1", "k2", F.explode(each).alias("x"))
                         .select(*DOC, "pos", "k1", "k2", "x.*"), "line-longer")
    keys, at = ["k1", "k2", "p1", "p2"], F.struct(*DOC, "pos")
    first = longer.groupBy(*keys).agg(F.min(at).alias("first"), F.max(at).alias("hi")).filter("first <> hi")
    first = materialise(first.select(*keys, "first"), "line-longer-firsts")
    return longer.join(first, keys).filter(at > F.col("first")).select(*DOC, "pos", "stop")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, extend: bool = False) -> DataFrame:
    """(doc, _line_runs): the line ranges [a, b) of each document that repeat an earlier place, in order and disjoint."""
    wins = materialise(line_windows(docs, min_words, extend), "line-windows")
    place, at = F.struct(*DOC, "place"), F.struct(*DOC, "pos")
    fps = (wins.groupBy("fp").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo <> hi").select("fp"))
    able = wins.join(materialise(fps, "line-prints"), "fp", "left_semi")
    firsts = able.groupBy("k1", "k2").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).filter("lo <> hi")
    firsts = materialise(firsts.select("k1", "k2", F.col("lo").alias("first")), "line-firsts")
    later = wins.join(firsts, ["k1", "k2"]).filter(at > F.col("first")).select(*DOC, "pos", "stop")
    if extend:
        later = later.unionByName(prolonged_repeats(wins, firsts))
    order = Window.partitionBy(*DOC).orderBy("pos")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = later.withColumn("_new", F.when(F.col("pos") <= reach, 0).otherwise(1))
    runs = runs.withColumn("_run", F.sum("_new").over(order))
    runs = runs.groupBy(*DOC, "_run").agg(F.min("pos").alias("a"), F.max("stop").alias("b"))
    return runs.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("_line_runs"))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS, extend: bool = False) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text``, and n_lines, n_removed, n_runs added.

    ``extend``: whole runs, with the lines behind their last window.
    """
    runs = materialise(repeated_runs(docs.select("doc_id", "text"), min_words, extend), "line-runs")
    base = without(docs, "n_lines", "n_removed", "n_runs")
    keyed = base.withColumns(_identity(base))
    joined = keyed.join(runs.hint("merge"), DOC, "left")              # the same plan at every size
    lines = F.split(F.col("text"), "\n", -1)
    n = F.size(F.col("_line_runs"))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda j: F.slice(
        lines, F.coalesce(F.get(F.col("_line_runs"), j - 1)["b"], F.lit(0)) + 1,
        F.coalesce(F.get(F.col("_line_runs"), j)["a"], F.size(lines)) - F.coalesce(F.get(F.col("_line_runs"), j - 1)["b"], F.lit(0)))))
    gone = F.coalesce(F.aggregate("_line_runs", F.lit(0), lambda s, r: s + r["b"] - r["a"]), F.lit(0))
    text = F.when(F.col("_line_runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    cols = {c: F.col(f"`{c}`") for c in base.columns}
    out = joined.select(*[(text if c == "text" else x).alias(c) for c, x in cols.items()],
                        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
                        gone.cast("long").alias("n_removed"), F.coalesce(F.size("_line_runs"), F.lit(0)).cast("long").alias("n_runs"))
    return out

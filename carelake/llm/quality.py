"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of whole texts are Spark columns.  Small trees grown on resampled rows give
conjunctive rules (every path from the root); a lasso logistic regression weighs the
rules and drops most; the ones left are compiled into one Spark column, so scoring is
a projection without Python.

The trees and weights are fitted on the driver on at most ``max_train`` labelled rows
(the ones with the least hash of doc_id), one row of statistics each; a histogram of the hashes cuts the others
off before anything is sorted.  Rows whose crc32(doc_id) mod 5 is 0 are never learned from.

Defined cases: null and empty texts have zero statistics and a score like any other;
null ids are not held out and never match a label; null labels are left out; without labels of both classes
the score is the share of ones (1 without any label); repeated rows are scored each and learned from once; very long
texts are measured whole, each in one task; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import hash60, materialise

MAX_TRAIN, THRESHOLD = 12_000, 0.3
TREES, DEPTH, SAMPLE, CUTS = 60, 3, 2000, 24
PENALTY = 1e-4
#: Character classes, as the inside of a regular expression's brackets.
UPPERS, LOWERS, DIGITS = "A-Z", "a-z", "0-9"
SYMBOLS, STOPS = r"|%$#&*!@^~=+<>{}\[\]\\/_", r".,;:?'\"()\-"
#: A word that the next word repeats.
TWICE = r"(?<!\S)(\S+)\s+(?=\1(?!\S))"


def _share(text: Column, chars: str, n: Column) -> Column:
    """Share of the characters of ``text`` that are in the class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")) / F.greatest(n, F.lit(1))


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; none depends on anything but the text."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    count = F.greatest(F.size(words), F.lit(1))
    lines = F.split(t, "\n", -1)
    return {
        "words": F.log1p(F.size(words).cast("double")),
        "word_length": n / count,
        "upper": _share(t, UPPERS, n), "lower": _share(t, LOWERS, n), "digits": _share(t, DIGITS, n),
        "symbols": _share(t, SYMBOLS, n), "stops": _share(t, STOPS, n),
        "distinct": F.size(F.array_distinct(words)) / count,
        "twice": F.regexp_count(t, F.lit(TWICE)) / count,
        "line_words": F.size(words) / F.size(lines),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


Rule = tuple[tuple[int, bool, float], ...]          # (statistic, above, cut) conditions that all hold


def _tree(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], depth: int, path: Rule, rng, rules: set[Rule]) -> None:
    """Grow one tree by Gini gain over a random half of the statistics; every path is a rule."""
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return
    best = (1e-9, -1, 0.0)
    base = len(y) * y.mean() * (1 - y.mean())
    for f in rng.permutation(x.shape[1])[:(x.shape[1] + 1) // 2]:
        above = x[:, f, None] > cuts[f]
        n, ones = above.sum(0), (above & (y[:, None] > 0)).sum(0)
        m, rest = len(y) - n, y.sum() - ones
        with np.errstate(divide="ignore", invalid="ignore"):
            left = base - (ones * (1 - ones / n) + rest * (1 - rest / m))
        left[(n < 5) | (m < 5)] = 0
        k = int(np.argmax(left))
        if left[k] > best[0]:
            best = (float(left[k]), int(f), float(cuts[f][k]))
    if best[1] < 0:
        return
    side = x[:, best[1]] > best[2]
    for above in (True, False):
        rule = tuple(sorted(path + ((best[1], above, best[2]),)))
        rules.add(rule)
        pick = side == above
        _tree(x[pick], y[pick], cuts, depth - 1, rule, rng, rules)


def _fires(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, cut in rule:
        out &= (x[:, f] > cut) == above
    return out


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 800) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty on the weights, by accelerated proximal gradient."""
    n, k = r.shape
    w, b, u, c, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    step = 4 * n / (np.linalg.norm(r, 2) ** 2 + n)
    for _ in range(steps):
        e = 1 / (1 + np.exp(-(r @ u + c))) - y
        nw, nb = u - step * (r.T @ e) / n, c - step * e.mean()
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * penalty, 0)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules over named statistics."""

    names: tuple[str, ...]
    rules: tuple[tuple[Rule, float], ...]
    bias: float

    @staticmethod
    def fit(names: list[str], x: np.ndarray, y: np.ndarray, seed: int = 11, penalty: float = PENALTY) -> RuleEnsemble:
        """``x``: a row of statistics per label in ``y`` (0 or 1)."""
        share = float(y.mean()) if len(y) else 1.0
        if not 0 < share < 1:
            return RuleEnsemble(tuple(names), (), 40.0 if share else -40.0)
        rng, found = np.random.default_rng(seed), set()
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, CUTS))) for f in range(x.shape[1])]
        for _ in range(TREES):
            pick = rng.integers(0, len(y), min(SAMPLE, len(y)))
            _tree(x[pick], y[pick], cuts, DEPTH, (), rng, found)
        rules = sorted(found)
        if not rules:
            return RuleEnsemble(tuple(names), (), float(np.log(share / (1 - share))))
        w, b = _lasso(np.stack([_fires(x, r) for r in rules], 1).astype(np.float64), y.astype(np.float64), penalty)
        return RuleEnsemble(tuple(names), tuple((r, float(v)) for r, v in zip(rules, w) if v), b)

    def column(self, stats: dict[str, Column]) -> Column:
        """The score, 0 to 1, as an expression over the statistics."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            fires = F.lit(True)
            for f, above, cut in rule:
                x = stats[self.names[f]]
                fires = fires & ((x > cut) if above else (x <= cut))
            total = total + F.when(fires, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def measured(docs: DataFrame, carry: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """(``carry`` and the statistics of every row, written once; the statistics by name).

    Fitting and scoring read the numbers only."""
    stats = statistics(F.col("text"))
    table = docs.select(*[F.col(f"`{c}`") for c in carry], *[c.alias(f"_q_{k}") for k, c in stats.items()])
    return materialise(table, "text-statistics"), {k: F.col(f"_q_{k}") for k in stats}


def learn(table: DataFrame, stats: dict[str, Column], labels: DataFrame, max_train: int = MAX_TRAIN) -> RuleEnsemble:
    """Fit on the labelled rows of ``table`` that are not held out."""
    names = list(stats)
    known = labels.filter("quality is not null and doc_id is not null").select(
        F.col("doc_id").cast("long").alias("_id"), F.col("quality").alias("_y"))
    rows = (table.select(F.col("doc_id").cast("long").alias("_id"), *[c.alias(k) for k, c in stats.items()])
            .filter(~held_out(F.col("_id"))).join(known, "_id").distinct().withColumn("_h", hash60(F.lit("train"), F.col("_id"))))
    rows = materialise(rows, "labelled-statistics")
    # rows by the first ten bits of the hash: those behind the bit pattern that completes the sample go at once
    part = F.shiftright("_h", 50)
    count = sorted(map(tuple, rows.groupBy(part.alias("p")).count().collect()))
    last = next((p for (p, _), total in zip(count, np.cumsum([n for _, n in count])) if total >= max_train), 1023)
    rows = rows.filter(part <= int(last)).orderBy("_h", "_id", *names, "_y").limit(max_train)
    pdf = rows.select(*names, "_y").toPandas()                         # max_train rows of numbers
    return RuleEnsemble.fit(names, pdf[names].to_numpy(np.float64), (pdf["_y"].to_numpy() > 0).astype(np.int64))


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN,
                   threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    table, stats = measured(docs, ["doc_id"])
    score = learn(table, stats, labels, max_train).column(stats)
    out = table.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"),
                       score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns.

    Fitting reads a written table of numbers; the texts are then measured once
    more rather than written or moved."""
    table, stats = measured(docs, ["doc_id"])
    score = learn(table, stats, labels, max_train).column(stats)
    # A column drawn at random keeps the filter above the projection: pushed below it,
    # every rule would measure the text anew.
    again = docs.select("*", *[c.alias(f"_q_{k}") for k, c in statistics(F.col("text")).items()], F.rand().alias("_q_"))
    good = again.filter((score >= threshold) & (F.col("_q_") >= 0))
    return good.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Periodic runs of words, found from Lyndon roots.

A run is a stretch of words with a smallest period q that no neighbouring word extends.
Every run holds, under one of the two orders of the words, a place whose longest Lyndon
word is one period of it (its root).  So:

1. stretches that can hold a run are cut out: in a run of exponent e every word stands
   floor(e) times, so words that are rarer in a stretch end it (repeated a few times over
   the pieces; this only leaves out places that no wanted run covers);
2. Baier grouping (phase one of his suffix sorter), once per order, gives the length of the
   longest Lyndon word at every place of a stretch: groups of suffixes are taken from the
   highest down, and the places before a group's members move up into new groups;
3. each root (i, q) is extended both ways by longest common extensions of i and i + q, for all
   roots at once: blocks of 2, 4, 8 ... words get equal names when they are equal, so the
   extensions are exact;
4. equal results are one run; runs of enough exponent and length are kept.

Texts are handled one by one inside Arrow tasks, nothing is shuffled.  A text is the unit: its
stretches take about 16 bytes a word and doubling, so a text of 100 MB wants some 2 GB.

Defined cases: null texts and texts without words have no runs and an empty rest; rows
are judged each, so repeated rows and null or repeated ids change nothing; empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WORD, map_batches

MIN_EXPONENT, MIN_LENGTH = 4, 6
#: Times that the pieces of a text are cut again at their rare words.
ROUNDS = 6
#: Words of stretches whose roots are extended at once.
TOGETHER = 1 << 18
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept binary"


def stretches(words: list, times: int, shortest: int) -> Iterator[tuple[int, int]]:
    """Ranges of words outside which no run of exponent ``times`` and length ``shortest`` has a word."""
    todo = [(0, len(words), ROUNDS)]
    while todo:
        a, b, rounds = todo.pop()
        if b - a < shortest:
            continue
        part = words[a:b]
        count = Counter(part)
        rare = [i for i, w in enumerate(part, a) if count[w] < times] if rounds else []
        if not rare:
            yield a, b
            continue
        at = a
        for i in (*rare, b):
            if i - at >= shortest:
                todo.append((at, i, rounds - 1))
            at = i + 1


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at every place (a prefix counts as smaller), by Baier grouping."""
    n = len(ranks)
    lengths, group = [0] * n, [0] * n
    members: list[list[int]] = []
    width, lower, upper = [], [], []            # of a group: its context's length, the groups next to it
    place = {r: k for k, r in enumerate(sorted(set(ranks)))}
    for k in range(len(place)):
        members.append([])
        width.append(1)
        lower.append(k - 1)
        upper.append(k + 1)
    for i, r in enumerate(ranks):
        group[i] = g = place[r]
        members[g].append(i)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))   # places whose group is still to come
    g = len(place) - 1
    while g >= 0:
        u = width[g]
        sources: list[int] = []
        counts: list[int] = []
        last = -1
        for i in members[g]:
            if group[i] != g:                    # moved up meanwhile
                continue
            lengths[i] = u
            p, q = before[i], after[i]
            if q < n:
                before[q] = p
            if p >= 0:
                after[p] = q
                if p == last:
                    counts[-1] += 1
                else:
                    sources.append(p)
                    counts.append(1)
                    last = p
        for c in sorted(set(counts), reverse=True):
            new: dict[int, int] = {}
            for p, k in zip(sources, counts):
                if k != c:
                    continue
                old = group[p]
                h = new.get(old)
                if h is None:                    # right above the old group
                    h = new[old] = len(members)
                    members.append([])
                    width.append(width[old] + c * u)
                    lower.append(old)
                    upper.append(upper[old])
                    lower[upper[old]] = h
                    upper[old] = h
                group[p] = h
                members[h].append(p)
        g = lower[g]
    return lengths


def _names(ids: np.ndarray) -> list[np.ndarray]:
    """names[k][i]: equal for equal blocks of 2**k values; stops when no two blocks are equal."""
    out = [ids.astype(np.int64)]
    n, step = len(ids), 1
    while step < n:
        cur = out[-1]
        following = np.full(n, -1, np.int64)
        following[:n - step] = cur[step:]
        distinct, name = np.unique(cur * np.int64(n + 1) + following + 1, return_inverse=True)
        if len(distinct) == n:
            break
        out.append(name.astype(np.int64))
        step *= 2
    return out


def _extensions(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many values agree from a and b on (``back``: up to and with a and b)."""
    n, total = len(names[0]), np.zeros(len(a), np.int64)
    sign = -1 if back else 1
    for k in range(len(names) - 1, -1, -1):
        size = 1 << k
        x, y = a + sign * total, b + sign * total
        if back:
            x, y = x - size + 1, y - size + 1
        ok = (np.minimum(x, y) >= 0) & (np.maximum(x, y) + size <= n)
        same = np.zeros(len(a), bool)
        same[ok] = names[k][x[ok]] == names[k][y[ok]]
        total[same] += size
    return total


def find_runs(parts: list[list], exponent: int, shortest: int) -> list[np.ndarray]:
    """(start, length, period) rows of each sequence in ``parts``, sorted."""
    flat, roots, base = [-1], [], 1                 # separators equal nothing else
    for k, words in enumerate(parts):
        index: dict = {}
        ids = [index.setdefault(w, len(index)) for w in words]
        for ranks in (ids, [-x for x in ids]):      # both orders
            q = np.array(lyndon_lengths(ranks), np.int64)
            i = np.flatnonzero(q * exponent <= len(words))
            roots.append((i + base << 32) | q[i])
        flat += ids
        flat.append(-2 - k)
        base += len(words) + 1
    starts = np.cumsum([0] + [len(w) + 1 for w in parts]) + 1
    roots = np.unique(np.concatenate(roots))
    i, q = roots >> 32, roots & 0xFFFFFFFF
    ids = np.unique(np.array(flat, np.int64), return_inverse=True)[1]
    names = _names(ids)
    right = _extensions(names, i, i + q, False)
    left = _extensions(names, i - 1, i + q - 1, True)
    a, size = i - left, left + q + right
    ok = size >= np.maximum(shortest, exponent * q)
    # start and period tell a run
    a, size, q = a[ok], size[ok], q[ok]
    first = np.unique((a << 32) | q, return_index=True)[1]
    runs = np.stack([a[first], size[first], q[first]], 1)
    cuts = np.searchsorted(runs[:, 0], starts)
    return [runs[x:y] - [s, 0, 0] for s, x, y in zip(starts.tolist(), cuts, cuts[1:])]


def periodic_runs(docs: DataFrame, exponent: int = MIN_EXPONENT, shortest: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, n_words, runs, kept) of every row of ``docs``.

    ``runs``: (start, length, period) in words, by start, then period, of every run of at least
    ``exponent`` periods (a whole number of 2 or more) and ``shortest`` words.  ``kept``: the words
    that no run contains after its first period, joined by one space.
    """
    if exponent < 2:
        raise ValueError("a run has an exponent of 2 or more")

    def flush(held):
        found: list[list] = [[] for _ in held]
        owners, parts = [], []
        for k, (_, words) in enumerate(held):
            for a, b in stretches(words, exponent, shortest):
                owners.append((k, a))
                parts.append(words[a:b])
        for (k, a), runs in zip(owners, find_runs(parts, exponent, shortest) if parts else []):
            found[k] += [(s + a, n, q) for s, n, q in runs.tolist()]
        kept = []
        for (_, words), runs in zip(held, found):
            runs.sort(key=lambda r: (r[0], r[2]))
            if runs:
                gone = np.zeros(len(words) + 1, np.int64)
                for s, n, q in runs:
                    gone[s + q] += 1
                    gone[s + n] -= 1
                stay = np.cumsum(gone[:-1]) == 0
                words = [w for w, x in zip(words, stay.tolist()) if x]
            kept.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in held], pa.int64()), pa.array([len(w) for _, w in held], pa.int64()),
             pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found],
                      pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))),
             pa.array(kept, pa.binary())], ["doc_id", "n_words", "runs", "kept"])

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = (t.as_py() or b"").split()             # at ASCII white space
                held.append((i, words))
                size += len(words)
                if size >= TOGETHER:
                    yield flush(held)
                    held, size = [], 0
            if held:
                yield flush(held)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_batches(rows, run, RUNS).withColumn("kept", F.col("kept").cast("string"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs``, a tenth of them (by crc32 of the id) with a tail of words that repeats."""
    n, g = F.size("_words"), F.floor(F.col("_hash") / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_hash"))
    chosen = (F.col("_hash") % 10 == 0) & F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = rows.withColumn("_words", F.when(chosen, words))
    rows = rows.withColumns({"_n": n.cast("long"), "_a": (g % n).cast("long")})
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))).cast("int"))
    rest = (F.col("_n") - F.col("_a")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("_words", F.col("_a").cast("int") + 1, F.col("_p")),
                                    F.ceil(rest / F.col("_p")).cast("int")))
    made = F.concat(F.slice("_words", F.lit(1), F.col("_a").cast("int")), F.slice(tail, F.lit(1), rest))
    text = F.when(F.col("_words").isNull(), F.col("text")).otherwise(F.array_join(made, " "))
    return rows.select("doc_id", text.alias("text"))

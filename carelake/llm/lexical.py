"""Ranked lexical search: exact top-k of all documents for every item, by dual-tree pruning.

Terms are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
N documents have terms, L is the number of all terms, n of one document's; df documents hold
a term, tf times in one of them.  With w = floor(1000 ln((2N + 2) / (2df + 1))) and
m = 75 + (25 n N) div L, a document's score for an item is the sum over the item's terms,
repeats included, of w * ((10^9 tf) div (1000 tf + 12 m)).

* Index: documents go into shards of a few MB of text (whole documents).  A shard is one row with its
  (document, term, tf) postings, documents ordered by least term hashes so that like ones are
  neighbours.  Written once; any set of items may be searched in it.
* Items: (item, term, count) rows are counted by Spark and go, block by block, to the tasks.
  A block has about ``BLOCK_TERMS`` rows, and at most those of one item more.
* Trees: in a task, items and documents are leaves of two hierarchies (``FAN`` children a node); a
  node holds the greatest weight of each term below it.  For a pair of nodes, the product of the two
  vectors bounds every score below.  A pair is left out, with all its documents and items,
  if its bound is under the weakest k-th score of its items; at the leaves the product is the score.
* Weakest scores: the shards of a hash bucket (one in ``SEED``) are searched first; their k-th scores are
  lower bounds for all others.  A task goes on with what it found in its shards.  Both only prune,
  the result is exact.  A task returns at most k rows an item, merged by a ranked window.

Defined cases: null texts and texts without terms are no documents (they count for nothing); an
item without terms gets no rows, nor does any document with score 0; item rows that
share an id (also the null id) are one item with the terms of all their distinct texts;
repeated document rows are documents each, equal scores go by doc_id (null last), then by the hash
of the text; very long texts make a shard of their own; empty tables give an empty result; other
columns are ignored.  25 n N must stay under 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textkernel as tk
from .common import map_batches, materialise

SHARD_BYTES = 4 << 20
#: (item, term) rows in one broadcast block.
BLOCK_TERMS = 1 << 20
#: One shard in this many is searched first.
SEED = 32
FAN = 32
INDEX = ("bucket int, n_docs long, n_terms long, ids binary, no_id binary, keys binary, sizes binary, terms binary, "
         "ends binary, docs binary, counts binary")


def _least(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Places 0 .. n - 1 ordered by their two least mixed hashes."""
    keys = []
    for salt in (0, 1):
        least = np.full(n, 2**64 - 1, np.uint64)
        np.minimum.at(least, owner, tk.mixed(h ^ tk.MIX[4 + salt]))
        keys.append(least)
    return np.lexsort(keys[::-1])


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Postings of ``docs`` (doc_id, text), a row per shard, written to the shared folder."""
    def flush(ids, keys, hashes, counts):
        h, n = np.concatenate(hashes), np.concatenate(counts)
        doc = np.repeat(np.arange(len(n)), n)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][:len(h)]
        at = np.flatnonzero(new)
        h, doc, tf = h[at], doc[at], np.diff(np.r_[at, len(new)])
        some = np.flatnonzero(n)                                    # documents with terms, like ones together
        some = some[_least(np.searchsorted(some, doc), h, len(some))]
        place = np.zeros(len(n), np.int64)
        place[some] = np.arange(len(some))
        ends = np.flatnonzero(np.r_[h[1:] != h[:-1], True][:len(h)]) + 1
        own = np.array([0 if ids[i] is None else ids[i] for i in some.tolist()], np.int64)
        null = np.array([ids[i] is None for i in some.tolist()], bool)
        key = np.array(keys, np.int64)[some]
        bucket = int(key.view(np.uint64).sum(dtype=np.uint64) % np.uint64(SEED)) if len(key) else 0
        packed = [own, null, key, n[some].astype(np.int64), h[ends - 1], ends.astype(np.uint32),
                  place[doc].astype(np.uint32), tf.astype(np.uint32)]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([len(some)], pa.int64()), pa.array([int(n.sum())], pa.int64()),
             *[pa.array([x.tobytes()], pa.binary()) for x in packed]],
            [c.strip().split()[0] for c in INDEX.split(",")])

    def run(batches):
        held: tuple = ([], [], [], [])
        size = 0
        for batch in batches:
            buf, off = tk.text_bytes(batch.column("text"))
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            for lo, hi in tk.blocks(off, min(tk.BLOCK, shard_bytes)):
                if size and size + off[hi] - off[lo] > shard_bytes:
                    yield flush(*held)
                    held, size = ([], [], [], []), 0
                h, n = tk.words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], tk.ALNUM)
                for part, new in zip(held, (ids[lo:hi], keys[lo:hi])):
                    part.extend(new)
                held[2].append(h)
                held[3].append(n)
                size += off[hi] - off[lo]
        if held[0]:
            yield flush(*held)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"),
                       F.col("text").cast("binary").alias("text"))
    return materialise(map_batches(rows, run, INDEX), "lexical-index")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n): how often each term stands in each item; written to the shared folder."""
    kind = items.schema["item_id"].dataType

    def run(batches):
        for batch in batches:
            buf, off = tk.text_bytes(batch.column("text"))
            for lo, hi in tk.blocks(off):
                h, n = tk.words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], tk.ALNUM)
                owner = np.repeat(np.arange(lo, hi), n)
                order = np.lexsort((h, owner))
                h, owner = h[order], owner[order]
                at = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])][:len(h)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(owner[at])), pa.array(h[at].view(np.int64)),
                     pa.array(np.diff(np.r_[at, len(h)]), pa.int64())], ["item_id", "term", "n"])
    rows = items.select("item_id", "text").distinct().select("item_id", F.col("text").cast("binary").alias("text"))
    counted = map_batches(rows, run, f"item_id {kind.simpleString()}, term long, n long")
    return materialise(counted.groupBy("item_id", "term").agg(F.sum("n").alias("n")), "item-terms")


class _Tree:
    """Leaves with sparse term weights; nodes above hold the greatest weight of each term."""

    def __init__(self, leaf: np.ndarray, term: np.ndarray, value: np.ndarray, leaves: int):
        """Entries sorted by (leaf, term)."""
        self.levels = []
        node, n = leaf, leaves
        while True:
            self.levels.append((np.searchsorted(node, np.arange(n + 1)), term, value))
            if n <= 1:
                break
            node, n = node // FAN, -(-n // FAN)
            order = np.lexsort((term, node))
            node, term, value = node[order], term[order], value[order]
            at = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (term[1:] != term[:-1])][:len(node)])
            value = np.maximum.reduceat(value, at) if len(at) else value
            node, term = node[at], term[at]
        self.count, self.height = leaves, len(self.levels) - 1

    def terms(self, level: int, node: int) -> np.ndarray:
        ends, term, _ = self.levels[level]
        return term[ends[node]:ends[node + 1]]

    def children(self, level: int, node: int) -> range:
        """Nodes of the level below."""
        n = len(self.levels[level - 1][0]) - 1
        return range(node * FAN, min(n, (node + 1) * FAN))

    def leaves(self, level: int, node: int) -> slice:
        return slice(node * FAN ** level, min(self.count, (node + 1) * FAN ** level))

    def dense(self, level: int, nodes: range, terms: np.ndarray, kind) -> np.ndarray:
        """The vectors of ``nodes`` over the sorted ``terms``."""
        ends, term, value = self.levels[level]
        lo, hi = ends[nodes.start], ends[nodes.stop]
        out = np.zeros((len(nodes), len(terms)), kind)
        at = np.minimum(np.searchsorted(terms, term[lo:hi]), len(terms) - 1)
        ok = terms[at] == term[lo:hi]
        row = np.repeat(np.arange(len(nodes)), np.diff(ends[nodes.start:nodes.stop + 1]))
        out[row[ok], at[ok]] = value[lo:hi][ok]
        return out


class _Best:
    """The k best (score, id, key) of every item."""

    def __init__(self, floor: np.ndarray, k: int):
        n = len(floor)
        self.k, self.weakest = k, floor.copy()             # no score under it is wanted
        self.rows = [(np.empty(0, np.int64),) * 4 for _ in range(n)]

    def add(self, item: int, *new: np.ndarray) -> None:
        """``new``: scores, whether the id is null, ids, keys."""
        both = [np.concatenate(x) for x in zip(self.rows[item], new)]
        order = np.lexsort((both[3], both[2], both[1], -both[0]))[:self.k]
        self.rows[item] = tuple(x[order] for x in both)
        if len(order) == self.k:
            self.weakest[item] = max(self.weakest[item], both[0][order[-1]])


def _visit(items: _Tree, docs: _Tree, best: _Best, kind, ids: tuple[np.ndarray, ...], pair: tuple[int, int, int, int]) -> None:
    """Search the pair (item level, item node, document level, document node) down to the leaves, best bounds first."""
    todo = [pair]
    while todo:
        i, a, d, b = todo.pop()
        own = items.terms(i, a)
        shared = np.intersect1d(own, docs.terms(d, b), assume_unique=True)
        if not len(shared):
            continue
        # the higher node is opened, or both
        below = (i - (i >= d and i > 0), d - (d >= i and d > 0))
        left = items.children(i, a) if below[0] < i else range(a, a + 1)
        right = docs.children(d, b) if below[1] < d else range(b, b + 1)
        bound = items.dense(below[0], left, shared, kind) @ docs.dense(below[1], right, shared, kind).T
        weakest = np.array([best.weakest[items.leaves(below[0], x)].min() for x in left])
        able = (bound > 0) & (bound >= weakest[:, None])
        if below == (0, 0):
            for row in np.flatnonzero(able.any(1)).tolist():
                at = np.flatnonzero(able[row])
                place = at + right.start
                best.add(left.start + row, bound[row, at].astype(np.int64), *[x[place] for x in ids])
            continue
        rows, cols = np.nonzero(able)
        order = np.argsort(bound[rows, cols], kind="stable")         # the best is opened next
        todo += [(below[0], left.start + x, below[1], right.start + y)
                 for x, y in zip(rows[order].tolist(), cols[order].tolist())]


def _blocks(terms: DataFrame, limit: int) -> Iterator[dict]:
    """The items in blocks of about ``limit`` (item, term) rows: ids, terms, and (item, term, n) entries."""
    total = terms.count()
    count = -(-total // limit)
    part = F.pmod(F.xxhash64("item_id"), F.lit(max(1, count)))
    for b in range(count):
        rows = terms.filter(part == b).select(F.struct("item_id").alias("i"), "term", "n").toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        ids = rows.column("i").combine_chunks().field(0).to_pylist()
        place: dict = {}
        owner = np.array([place.setdefault(x, len(place)) for x in ids], np.int64)
        h = rows.column("term").to_numpy().view(np.uint64)
        wanted = np.unique(h)
        order = np.empty(len(place), np.int64)
        order[_least(owner, h, len(place))] = np.arange(len(place))    # like items together
        names = np.empty(len(place), object)
        for x, k in place.items():
            names[order[k]] = x
        yield {"ids": list(names), "wanted": wanted, "item": order[owner], "term": np.searchsorted(wanted, h),
               "n": rows.column("n").to_numpy().astype(np.int64)}


def _document_frequency(index: DataFrame, wanted: np.ndarray) -> np.ndarray:
    """How many documents hold each of the sorted terms ``wanted``."""
    shared = index.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for t, e in zip(batch.column("terms"), batch.column("ends")):
                t, e = np.frombuffer(t.as_buffer(), np.uint64), np.frombuffer(e.as_buffer(), np.uint32).astype(np.int64)
                at = np.searchsorted(t, wanted)
                ok = np.flatnonzero(at < len(t))
                ok = ok[t[at[ok]] == wanted[ok]]
                total[ok] += np.diff(e, prepend=0)[at[ok]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["t", "n"])
    sums = map_batches(index.select("terms", "ends"), run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n"))
    out = np.zeros(len(wanted), np.int64)
    for r in sums.collect():                    # a row per term of the block at most
        out[r["t"]] = r["n"]
    shared.destroy()
    return out


def _search(index: DataFrame, block: dict, floor: np.ndarray, k: int, n_docs: int, n_terms: int, kind) -> DataFrame:
    """(item_id, doc_id, key, score): the k best of every item in each task's shards, none under ``floor``."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((block, floor))
    arrow = to_arrow_type(kind)

    def run(batches):
        block, floor = shared.value
        wanted, weight = block["wanted"], block["value"]
        order = np.lexsort((block["term"], block["item"]))
        items = _Tree(block["item"][order], block["term"][order], weight[order], len(block["ids"]))
        # scores and bounds are whole numbers: exact as doubles under 2^53, else as 64-bit integers
        most = int(items.levels[-1][2].sum()) * 10**6
        number = np.float64 if most < 2**53 else np.int64
        best = _Best(floor, k)
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c, t: np.frombuffer(batch.column(c)[row].as_buffer(), t)
                terms, ends = get("terms", np.uint64), get("ends", np.uint32).astype(np.int64)
                at = np.searchsorted(terms, wanted)
                ok = np.flatnonzero(at < len(terms))
                ok = ok[terms[at[ok]] == wanted[ok]]
                if not len(ok):
                    continue
                n = np.diff(ends, prepend=0)[at[ok]]
                pick = np.repeat(ends[at[ok]] - np.cumsum(n), n) + np.arange(n.sum())
                doc, tf = get("docs", np.uint32)[pick].astype(np.int64), get("counts", np.uint32)[pick].astype(np.int64)
                m = 75 + 25 * get("sizes", np.int64) * n_docs // n_terms
                value = 10**9 * tf // (1000 * tf + 12 * m[doc])
                term = np.repeat(ok, n)
                order = np.lexsort((term, doc))
                some, leaf = np.unique(doc[order], return_inverse=True)
                docs = _Tree(leaf, term[order], value[order], len(some))
                who = tuple(get(c, t)[some] for c, t in (("no_id", bool), ("ids", np.int64), ("keys", np.int64)))
                _visit(items, docs, best, number, who, (items.height, 0, docs.height, 0))
        got = [x for x in range(len(best.rows)) if len(best.rows[x][0])]
        if got:
            score, null, ids, keys = (np.concatenate([best.rows[x][c] for x in got]) for c in range(4))
            owner = [block["ids"][x] for x in got for _ in range(len(best.rows[x][0]))]
            yield pa.RecordBatch.from_arrays([pa.array(owner, arrow), pa.array(ids, pa.int64(), mask=null.astype(bool)),
                                              pa.array(keys, pa.int64()), pa.array(score, pa.int64())],
                                             ["item_id", "doc_id", "key", "score"])
    return map_batches(index.drop("bucket", "n_docs", "n_terms"), run,
                       f"item_id {kind.simpleString()}, doc_id long, key long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, index: DataFrame | None = None,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item; ``index`` as made by ``build_index``."""
    spark: SparkSession = docs.sparkSession
    kind = items.schema["item_id"].dataType
    index = build_index(docs) if index is None else index
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    empty = f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    if not n_docs:
        return spark.createDataFrame([], empty)
    found = None
    first: Column = F.col("bucket") == 0
    for block in _blocks(item_terms(items), block_terms):
        df = _document_frequency(index, block["wanted"])
        weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        block["value"] = weight[block["term"]] * block["n"]
        place = {x: p for p, x in enumerate(block["ids"])}
        floor = np.zeros(len(place), np.int64)
        seeds = materialise(_ranked(_search(index.filter(first), block, floor, k, n_docs, n_terms, kind), k), "lexical-seeds")
        for r in seeds.filter(F.col("rank") == k).select("item_id", "score").collect():     # a number per item of the block
            floor[place[r["item_id"]]] = r["score"]
        rest = _search(index.filter(~first), block, floor, k, n_docs, n_terms, kind)
        part = materialise(seeds.drop("rank").unionByName(rest), "lexical-found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], empty)
    return _ranked(found, k).select("item_id", "rank", "doc_id", "score")

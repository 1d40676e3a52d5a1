"""Benchmark decontamination over a distributed positional inverted index.

Index: documents go into shards of a few MB of text (whole documents; one longer than
that is a shard of its own).  A shard's row holds, sorted by term, where each term
stands: (terms, ends, positions) as packed arrays, and its documents' word counts.  As
a phrase lies within one document, shards are searched alone; nothing is shuffled,
and a term in every document is one short list per shard.

Search: tasks cut the test items into windows of term hashes, which are written as a table, one row
per item and distinct window; no item text reaches the driver.  Windows go to the tasks in blocks
of at most about ``BLOCK_WINDOWS`` (some 100 bytes each), whatever item they are of.  How often each term of a
block stands in the corpus is summed over the index (the positions are not read).  In every shard the postings of a window's rarest term, less its offset, are
intersected with those of the next rarer terms - for all windows at once, by binary
search in (term, position) keys - until none is left or the phrase is complete.  With
``slop`` each term may stand that many words off its place beside the rarest one
(proximity matches).

Defined cases: very long documents and items are cut and indexed whole; null texts and texts without words have no words; an item of fewer words
than the window, but some, is one window; items that share an id are one item, items
without id count under the empty id; repeated document rows are judged each; empty
tables give empty results (no items: nothing is hit); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkernel as tk
from .common import map_batches, materialise

SHARD_BYTES = 4 << 20
#: Windows that one broadcast holds, and that a task returns at once.
BLOCK_WINDOWS, WINDOW_ROWS = 1 << 19, 1 << 15
#: Candidate positions intersected at once.
CANDIDATES = 1 << 20
INDEX = ("shard string, doc_ids array<long>, keys array<long>, n_words array<long>, "
         "terms binary, ends binary, positions binary")


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The positional index of ``docs``, written to the shared folder.

    ``keys`` tells rows with the same doc_id but different texts apart.
    """
    def flush(ids, keys, hashes, counts):
        h, n = np.concatenate(hashes), np.concatenate(counts)
        order = np.argsort(h, kind="stable")
        h = h[order]
        ends = np.flatnonzero(np.r_[h[1:] != h[:-1], True]) + 1 if len(h) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{_task()}"]), pa.array([ids], pa.list_(pa.int64())), pa.array([keys], pa.list_(pa.int64())),
             pa.array([n.tolist()], pa.list_(pa.int64())), pa.array([h[ends - 1].tobytes()], pa.binary()),
             pa.array([ends.astype(np.uint32).tobytes()], pa.binary()),
             pa.array([order.astype(np.uint32).tobytes()], pa.binary())],
            ["shard", "doc_ids", "keys", "n_words", "terms", "ends", "positions"])

    def _task():
        import uuid
        return uuid.uuid4().hex

    def run(batches):
        held: tuple = ([], [], [], [])
        size = 0
        for batch in batches:
            buf, off = tk.text_bytes(batch.column("text"))
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            for lo, hi in tk.blocks(off):
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
    return materialise(map_batches(rows, run, INDEX), "positional-index")


def windows(items: DataFrame, n: int) -> DataFrame:
    """(id, terms): the distinct windows of each item as packed term hashes; written to the shared folder."""
    def run(batches):
        for batch in batches:
            buf, off = tk.text_bytes(batch.column("text"))
            ids = batch.column("id")
            for lo, hi in tk.blocks(off):
                h, counts = tk.words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], tk.ALNUM)
                ends = np.cumsum(counts)
                for i, c, e in zip(range(lo, hi), counts.tolist(), ends.tolist()):
                    if not c:
                        continue
                    all_ = np.lib.stride_tricks.sliding_window_view(h[e - c:e], min(n, c))
                    for s in range(0, len(all_), WINDOW_ROWS):
                        part = np.ascontiguousarray(all_[s:s + WINDOW_ROWS])
                        packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * part.shape[1]), len(part), [None, pa.py_buffer(part)])
                        yield pa.RecordBatch.from_arrays([pa.array([ids[i].as_py()] * len(part), pa.string()),
                                                          packed.cast(pa.binary())], ["id", "terms"])
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text"))
    return materialise(map_batches(rows.filter("text is not null"), run, "id string, terms binary").distinct(), "item-windows")


def _blocks_of(wins: DataFrame, limit: int) -> Iterator[dict[str, np.ndarray]]:
    """The windows in blocks of about ``limit``: term hashes (ragged, as terms and lengths) and the item's place in ``ids``."""
    count = -(-wins.count() // limit)
    part = F.pmod(F.xxhash64("id", "terms"), F.lit(max(1, count)))
    for b in range(count):
        rows = wins.filter(part == b).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        names = rows.column("id").combine_chunks().dictionary_encode()
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        data, off = tk.text_bytes(rows.column("terms"))
        yield {"ids": np.array(names.dictionary.to_pylist(), object), "terms": np.frombuffer(data.tobytes(), np.uint64),
               "len": np.diff(off) // 8, "item": names.indices.to_numpy().astype(np.int64)}


def _frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each of the sorted ``terms`` stands in the corpus."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        wanted, total = shared.value, np.zeros(len(shared.value), np.int64)
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
    out = np.zeros(len(terms), np.int64)
    for r in sums.collect():        # one row per term of a block, so bounded by the block
        out[r["t"]] = r["n"]
    shared.destroy()
    return out


def _rarest_first(block: dict[str, np.ndarray], freq: np.ndarray, terms: np.ndarray) -> dict[str, np.ndarray]:
    """Windows as matrices of term places and offsets, rarest term first; -1 fills short windows."""
    width = int(block["len"].max())
    ends = np.cumsum(block["len"])
    at = np.arange(width) + (ends - block["len"])[:, None]
    inside = np.arange(width) < block["len"][:, None]
    term = np.where(inside, np.searchsorted(terms, block["terms"][np.minimum(at, len(block["terms"]) - 1)]), -1)
    rank = np.where(inside, freq[term], np.int64(2**62))
    order = np.argsort(rank, axis=1, kind="stable")
    alive = (np.where(inside, freq[term], 1) > 0).all(axis=1)     # every term stands somewhere
    pick = lambda x: np.take_along_axis(x, order, 1)[alive].astype(np.int32)
    return {"term": pick(term), "offset": pick(np.broadcast_to(np.arange(width), term.shape)),
            "len": block["len"][alive], "item": block["item"][alive]}


def _near(keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, low)
    found = np.zeros(len(low), bool)
    ok = at < len(keys)
    found[ok] = keys[at[ok]] <= high[ok]
    return found


def phrase_matches(terms: np.ndarray, ends: np.ndarray, positions: np.ndarray, doc_ends: np.ndarray, wanted: np.ndarray,
                   plan: dict[str, np.ndarray], slop: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(window, document, first word, end) of the matches in one shard, chunk by chunk."""
    at = np.searchsorted(terms, wanted)
    here = np.full(len(wanted) + 1, -1)                            # the place in this shard of each test term
    ok = np.flatnonzero(at < len(terms))
    ok = ok[terms[at[ok]] == wanted[ok]]
    here[ok] = at[ok]
    local = here[plan["term"]]                                     # -1 also for the fill
    present = ((local >= 0) | (plan["term"] < 0)).all(axis=1)
    todo = np.flatnonzero(present)
    if not len(todo):
        return
    counts = np.diff(ends, prepend=0)
    keys = np.repeat(np.arange(len(terms), dtype=np.int64) << 32, counts) + positions
    doc_starts = np.r_[0, doc_ends[:-1]]
    first = local[todo, 0]
    cum = np.cumsum(counts[first])
    lo = 0
    while lo < len(todo):
        base = cum[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(cum, base + CANDIDATES, "right")))
        w, n = todo[lo:hi], counts[first[lo:hi]]
        begin = ends[first[lo:hi]] - n
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        win = np.repeat(w, n)
        start = positions[at].astype(np.int64) - plan["offset"][win, 0]
        doc = np.searchsorted(doc_ends, positions[at], "right")
        ok = (start >= doc_starts[doc] - slop) & (start + plan["len"][win] <= doc_ends[doc] + slop)
        win, start, doc = win[ok], start[ok], doc[ok]
        for j in range(1, plan["term"].shape[1]):
            t = local[win, j]
            place = start + plan["offset"][win, j]
            low, high = np.maximum(place - slop, doc_starts[doc]), np.minimum(place + slop, doc_ends[doc] - 1)
            ok = (plan["term"][win, j] < 0) | _near(keys, (t << 32) + low, (t << 32) + high)
            win, start, doc = win[ok], start[ok], doc[ok]
        yield win, doc, np.maximum(start, doc_starts[doc]), np.minimum(start + plan["len"][win], doc_ends[doc])
        lo = hi


def _search(index: DataFrame, block: dict[str, np.ndarray], slop: int) -> DataFrame:
    """(shard, place, hits, items): the hit word places and the items of each document with any."""
    wanted = np.unique(block["terms"])
    plan = _rarest_first(block, _frequencies(index, wanted), wanted)
    shared = index.sparkSession.sparkContext.broadcast((wanted, plan, block["ids"]))

    def run(batches):
        wanted, plan, ids = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c, kind: np.frombuffer(batch.column(c)[row].as_buffer(), kind)
                n = batch.column("n_words")[row].values.to_numpy()
                doc_ends = np.cumsum(n)
                positions = get("positions", np.uint32)
                cover = np.zeros(len(positions) + 1, np.int64)
                pairs = []
                for win, doc, start, stop in phrase_matches(get("terms", np.uint64), get("ends", np.uint32).astype(np.int64),
                                                             positions, doc_ends, wanted, plan, slop):
                    np.add.at(cover, start, 1)
                    np.add.at(cover, stop, -1)
                    pairs.append(np.unique(doc * np.int64(len(ids)) + plan["item"][win]))
                pairs = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
                if not len(pairs):
                    continue
                docs, item = pairs // len(ids), pairs % len(ids)
                hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
                of = np.searchsorted(doc_ends, hit, "right")
                some = np.unique(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("shard")[row].as_py()] * len(some), pa.string()), pa.array(some, pa.int64()),
                     pa.array([(hit[of == d] - (doc_ends[d] - n[d])).tolist() for d in some], pa.list_(pa.int64())),
                     pa.array([ids[item[docs == d]].tolist() for d in some], pa.list_(pa.string()))],
                    ["shard", "place", "hits", "items"])
    return map_batches(index.select("shard", "n_words", "terms", "ends", "positions"), run,
                       "shard string, place long, hits array<long>, items array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, slop: int = 0,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, key, n_words, n_hit, n_items, items, hits, contaminated) for every row of ``docs``.

    ``hits`` are the places of the hit words, ``items`` the sorted ids of the items with a match.
    """
    index = build_index(docs)
    found = None
    for block in _blocks_of(windows(items, n), block_windows):
        part = materialise(_search(index, block, slop), "phrase-hits")
        found = part if found is None else found.unionByName(part)
    base = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "keys", "n_words")).alias("place", "d")).select(
        "shard", F.col("place").cast("long").alias("place"), F.col("d.doc_ids").alias("doc_id"),
        F.col("d.keys").alias("key"), F.col("d.n_words").alias("n_words"))
    if found is None:
        out = base.withColumns({"hits": F.array().cast("array<long>"), "items": F.array().cast("array<string>")})
    else:
        merged = found.groupBy("shard", "place").agg(       # at most one row per block and document
            F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        out = base.join(materialise(merged, "phrase-docs"), ["shard", "place"], "left").withColumns(
            {"hits": F.coalesce("hits", F.array().cast("array<long>")),
             "items": F.coalesce("items", F.array().cast("array<string>"))})
    size = F.size("hits").cast("long")
    return out.select("doc_id", "key", "n_words", size.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      "items", "hits", (size > 0).alias("contaminated"))

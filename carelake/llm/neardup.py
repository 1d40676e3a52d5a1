"""MinHash near-dedup: universal hash minima, banding, verification, components.

1. Every text becomes the set of its word shingles; texts with equal sets form one
   class, and only the class's least doc_id goes on (copies are never paired).
2. ``bands * rows`` multiply-shift hash minima make a signature; ``rows`` minima at a
   time make a band key.  A pair at the threshold shares no band with probability
   ``(1 - similarity**rows)**bands``, and bands are as many as bring that under 4.4e-7: 25 for
   0.85 (4.3e-7), 37 for 0.80 (4.2e-7).
3. Stars: each band bucket has a pivot, the member with the most company in all its buckets
   (of a group of copies that is the text they were made from), and every member is
   paired with the pivots of its buckets only.  Pairs whose signatures agree in too few places for
   the threshold (a chance of 2e-9 for a true link at 0.85, 4e-10 at 0.80) go; the others are
   confirmed on the full sets.  This joins almost everything that belongs together.
4. The rest: members of a pivot's buckets that are still in different components are
   compared on their full sets inside tasks, in blocks of bounded size.  A task counts
   the common shingles of a block of members outside the largest component with another block
   through an inverted index, and returns at most one link per member.  No bucket, however
   large, is skipped.
5. Components of the confirmed links by alternating large-star and small-star.

Defined cases: null or empty texts and texts without words have an empty set and are
linked with nothing; rows that share a doc_id are one document whose links are those
of all its rows; a null doc_id gets no component and is kept; a very long text is hashed whole in
one task, and its full set moves only if it shares a bucket; an empty table gives an
empty result; other columns are ignored.  ``one_of_each`` tells rows apart by id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log, log1p

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textkernel as tk
from .common import importable, map_batches, materialise
from .components import components

ROWS = 5
#: Fewest bands, and the greatest chance that a pair at the similarity asked for shares none.
BANDS, MISS = 25, 4.4e-7
#: Least equal signature places of a pair that goes on to the full sets, as a share of
#: the similarity asked for: 0.76 * 0.85 * 125 = 80 places, 6.5 standard deviations below 106.
SLACK = 0.76
#: Shingles of the members that one task compares on either side.
BLOCK_SHINGLES = 1 << 19


def bands_for(similarity: tuple[int, int], rows: int = ROWS) -> int:
    """The bands with which a pair at ``similarity`` shares none with a chance of MISS at most."""
    one = (similarity[0] / similarity[1]) ** rows
    return BANDS if one >= 1 else max(BANDS, ceil(log(MISS) / log1p(-one)))


def _hashes(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(77)
    a = rng.integers(1, 2**64 - 1, n, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 2**64 - 1, n, dtype=np.uint64)


def shingle_sets(col: pa.Array, k: int) -> Iterator[list[np.ndarray]]:
    """Block by block the sorted distinct shingle hashes of each text."""
    buf, off = tk.text_bytes(col)
    for lo, hi in tk.blocks(off):
        h, counts = tk.words(buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], tk.SPACED)
        s, counts = tk.shingles(h, counts, k)
        ends = np.cumsum(counts)
        yield [np.unique(s[e - c:e]) for c, e in zip(counts, ends)]


def signatures(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One row of 32-bit minima for each non-empty set."""
    out = np.empty((len(sets), len(a)), np.uint32)
    lo = 0
    while lo < len(sets):        # bounded pieces, so that the temporaries stay in the cache
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 1 << 15):
            total, hi = total + len(sets[hi]), hi + 1
        x = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0] + [len(s) for s in sets[lo:hi - 1]])
        for i in range(len(a)):
            out[lo:hi, i] = np.minimum.reduceat(((x * a[i] + b[i]) >> np.uint64(32)).astype(np.uint32), starts)
        lo = hi
    return out


def features(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, signature) of every row; the last three null for empty sets."""
    def run(batches):
        a, b = _hashes(bands * rows)
        for batch in batches:
            done = 0
            for sets in shingle_sets(batch.column("text"), k):
                ids = batch.column("doc_id").slice(done, len(sets))
                done += len(sets)
                some = [i for i, s in enumerate(sets) if len(s)]
                sig = signatures([sets[i] for i in some], a, b)
                key = np.full((len(some), bands), 1, np.uint64) * np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    key = tk.mixed(key * tk.MIX[5] + sig[:, r::rows].astype(np.uint64))
                keys: list = [None] * len(sets)
                sigs: list = [None] * len(sets)
                digests: list = [None] * len(sets)
                for at, i in enumerate(some):
                    keys[i], sigs[i] = key[at].view(np.int64), sig[at].tobytes()
                    digests[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "bands", "signature"])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return map_batches(
        texts, run, "doc_id long, n_shingles long, set_key binary, bands array<long>, signature binary")


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles) of the documents in ``wanted``."""
    def run(batches):
        for batch in batches:
            done = 0
            for sets in shingle_sets(batch.column("text"), k):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(done, len(sets)),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["doc_id", "shingles"])
                done += len(sets)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    picked = texts.join(wanted.select("doc_id").hint("merge"), "doc_id", "left_semi")     # one plan at every size
    return map_batches(picked, run, "doc_id long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The (u, v) pairs with den * intersection >= num * union on their full sets."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("s"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("t"))

    def run(batches):
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                same = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(den * same >= num * (len(x) + len(y) - same))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
    both = pairs.select("u", "v").join(left, "u").join(right, "v")
    return map_batches(both, run, "u long, v long").distinct()


def similar_signatures(pairs: DataFrame, signs: DataFrame, least: int) -> DataFrame:
    """The (u, v) pairs whose signatures agree in ``least`` places."""
    left = signs.select(F.col("doc_id").alias("u"), F.col("signature").alias("s"))
    right = signs.select(F.col("doc_id").alias("v"), F.col("signature").alias("t"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                s, t = (np.frombuffer(b"".join(x.as_py() for x in batch.column(c)), np.uint32).reshape(batch.num_rows, -1)
                        for c in "st")
                yield batch.select(["u", "v"]).filter(pa.array((s == t).sum(axis=1) >= least))
    both = pairs.select("u", "v").join(left, "u").join(right, "v")
    return map_batches(both, run, "u long, v long")


def _fits(n: str, m: str, num: int, den: int):
    """Sizes that allow the similarity at all."""
    return F.least(n, m) * den >= F.greatest(n, m) * num


def spokes_of(members: DataFrame) -> DataFrame:
    """(pivot, doc_id, n_shingles): the members of each pivot's buckets, the pivot among them."""
    sizes = materialise(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("company")), "nd-sizes")
    score = materialise(members.join(sizes, "bucket").groupBy("doc_id").agg(F.sum("company").alias("score")), "nd-scores")
    rank = F.struct("score", F.xxhash64("doc_id"))
    pivots = members.join(score, "doc_id").groupBy("bucket").agg(F.max_by("doc_id", rank).alias("pivot"))
    return members.join(materialise(pivots, "nd-pivots"), "bucket").select("pivot", "doc_id", "n_shingles").distinct()


def links_of_rest(spokes: DataFrame, part: DataFrame | None, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of a pivot's buckets in different components, block against block."""
    state = spokes.withColumn("component", F.col("doc_id"))
    if part is not None:
        state = spokes.join(part, F.col("doc_id") == F.col("node"), "left").select(
            "pivot", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    state = materialise(state, "nd-state")
    each = state.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    # a pair with the pivot itself is judged already, so two members leave nothing to do
    groups = each.groupBy("pivot").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"),
                                       F.max_by("component", "shingles").alias("largest"),
                                       F.sum("shingles").alias("shingles"), F.max("shingles").alias("most"))
    groups = materialise(groups.filter("n > 2 and parts > 1").select(
        "pivot", "largest", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"),
        F.ceil((F.col("shingles") - F.col("most") + 1) / BLOCK_SHINGLES).cast("int").alias("small")), "nd-groups")
    dealt = state.join(groups, "pivot").withColumns({
        "side": F.col("component") != F.col("largest"),
        "i": F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("small")).cast("int"),
        "j": F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("blocks")).cast("int")})
    # on the right every member, for each block on the left; on the left those outside the largest component
    right = dealt.select("pivot", F.explode(F.sequence(F.lit(0), F.col("small") - 1)).alias("i"), "j",
                         F.lit(False).alias("left"), "doc_id", "component")
    left = dealt.filter("side").select("pivot", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
                                       F.lit(True).alias("left"), "doc_id", "component")
    rows = right.unionByName(left).join(sets, "doc_id")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        side = pdf.left.to_numpy()
        every = [np.frombuffer(x, np.uint64) for x in pdf.shingles]
        ids, comp = pdf.doc_id.to_numpy(), pdf.component.to_numpy()
        size = np.array([len(x) for x in every])
        right, up, out = np.flatnonzero(~side), {}, []
        if not len(right) or not side.any():
            return pd.DataFrame({"u": pd.Series(dtype="int64"), "v": pd.Series(dtype="int64")})

        def root(x):
            while up.get(x, x) != x:
                x = up[x]
            return x
        values = np.concatenate([every[r] for r in right])
        owner = np.repeat(np.arange(len(right)), size[right])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        for x in np.flatnonzero(side):
            lo, hi = np.searchsorted(values, every[x], "left"), np.searchsorted(values, every[x], "right")
            n = hi - lo
            at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            same = np.bincount(owner[at], minlength=len(right))
            ok = (den * same >= num * (size[right] + size[x] - same)) & (comp[right] != comp[x])
            for r in right[np.flatnonzero(ok)]:
                a, b = root(comp[x]), root(comp[r])
                if a != b:                             # one link for two components is enough
                    up[max(a, b)] = min(a, b)
                    out.append((max(ids[x], ids[r]), min(ids[x], ids[r])))
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")
    importable(spokes.sparkSession)
    return rows.groupBy("pivot", "i", "j").applyInPandas(run, "u long, v long").distinct()


def near_dup(docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (80, 100), bands: int | None = None,
             rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    ``similarity`` is a fraction (numerator, denominator) of the union that the
    intersection of two k-word shingle sets must reach; ``bands`` follow from it if not given.
    """
    num, den = similarity
    bands = bands or bands_for(similarity, rows)
    least = int(SLACK * num / den * bands * rows)
    feats = materialise(features(docs, k, bands, rows), "nd-features")
    named = feats.filter("doc_id is not null and set_key is not null")
    classes = materialise(named.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "nd-classes")
    same = (named.select("doc_id", "set_key").join(classes, "set_key").filter("doc_id <> rep")
            .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    # one row per class; a doc_id that heads several classes keeps a row for each
    heads = (named.join(classes.withColumnRenamed("rep", "doc_id"), ["set_key", "doc_id"])
             .dropDuplicates(["set_key"]).select("doc_id", "n_shingles", "bands", "signature"))
    heads = materialise(heads, "nd-heads")
    members = heads.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    members = materialise(members.join(materialise(shared.select("bucket"), "nd-buckets"), "bucket"), "nd-members")
    signs = heads.select("doc_id", "signature")
    # one pass moves the texts of documents that share a bucket; both steps confirm on these sets
    sets = materialise(full_sets(docs, members.select("doc_id").distinct(), k), "nd-sets")
    spokes = materialise(spokes_of(members), "nd-spokes")
    sizes = members.select(F.col("doc_id").alias("pivot"), F.col("n_shingles").alias("m")).distinct()
    star = spokes.filter("doc_id <> pivot").join(sizes, "pivot").filter(_fits("n_shingles", "m", num, den))
    star = star.select(F.greatest("doc_id", "pivot").alias("u"), F.least("doc_id", "pivot").alias("v")).distinct()
    links = materialise(confirm(similar_signatures(star, signs, least), sets, num, den), "nd-links")
    part = materialise(components(links), "nd-part")
    rest = materialise(links_of_rest(spokes, part, sets, num, den), "nd-rest")
    part = materialise(components(links.unionByName(rest).unionByName(same)), "nd-components")
    out = feats.select("doc_id", "n_shingles").join(part, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the least doc_id (null last), then text hash.

    Rows that share doc_id and text are one document, of which one row stays.  Rows that share only the doc_id, and rows
    without one, are documents of their own: for the search they get ids from the hash of id and text.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                   F.xxhash64("text").alias("hash"))
    twice = docs.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_nd_twice")).agg(
        F.count(F.lit(1)).alias("_nd_n")).filter("_nd_n > 1")
    twice = materialise(twice.select("_nd_twice"), "nd-shared-ids")
    keyed = docs.withColumn("_nd_key", key).join(twice, F.col("doc_id").cast("long") == F.col("_nd_twice"), "left")
    own = -F.shiftrightunsigned(F.xxhash64("_nd_key"), 1) - 1
    odd = F.col("doc_id").isNull() | F.col("_nd_twice").isNotNull()
    keyed = keyed.withColumn("_nd_id", F.when(odd, own).otherwise(F.col("doc_id").cast("long"))).withColumn("_nd_odd", odd)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # rows repeated whole meet as one per task before the shuffle
    once = keyed.filter("_nd_odd").groupBy("_nd_id", "_nd_key").agg(F.first(F.struct(*cols)).alias("_nd_row"))
    once = once.select("_nd_id", "_nd_key", *[F.col(f"_nd_row.`{c}`") for c in docs.columns])
    clean = keyed.filter("not _nd_odd").select("_nd_id", "_nd_key", *cols).unionByName(materialise(once, "nd-odd-rows"))
    found = near_dup(clean.select(F.col("_nd_id").alias("doc_id"), "text"), k, similarity)
    found = found.select(F.col("doc_id").alias("_nd_id"), F.col("component_id").alias("_nd_group"))
    both = materialise(clean.select("_nd_id", "_nd_key").join(found, "_nd_id"), "nd-groups-of-rows")
    stay = both.groupBy("_nd_group").agg(F.min_by("_nd_id", "_nd_key").alias("_nd_stay"), F.count(F.lit(1)).alias("_nd_n"))
    gone = both.join(stay.filter("_nd_n > 1"), "_nd_group").filter("_nd_id <> _nd_stay").select("_nd_id")
    return clean.join(materialise(gone, "nd-gone"), "_nd_id", "left_anti").select(*cols)

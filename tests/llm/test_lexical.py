"""Ranked search against scoring every document for every item."""

import random

import pytest
from pyspark.sql import functions as F

from carelake.llm import lexical
from tests.llm import brute
from tests.llm.test_cases import VOCAB, prose


def items_of(spark, rows, kind="string"):
    full = [(i, t, 1, 2.0, "x") for i, t in rows]
    return spark.createDataFrame(full, f"item_id {kind}, text string, rank int, score double, term string")


def corpus(seed, n):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice(VOCAB[:r.choice([20, 100, 300])]) for _ in range(r.randint(0, 120)))) for i in range(n)]
    copies = [(n + i, rows[r.randrange(n // 20)][1]) for i in range(n // 3)]            # large groups of equal scores
    return rows + copies


def test_by_brute_force(spark, docs_of):
    docs = corpus(5, 900)
    items = [(f"i{k}", " ".join(random.Random(k).choices(VOCAB, k=1 + k % 40))) for k in range(70)] + [("all", " ".join(VOCAB))]
    table = docs_of([(i, t, "s") for i, t in docs]).repartition(3)
    want = sorted(brute.ranked(docs, items, 20))
    # shards of a few kB, so that there are first and other shards and trees of several levels
    index = lexical.build_index(table, shard_bytes=4000)
    assert index.count() > 40 and 0 < index.filter("bucket = 0").count() < index.count()
    for block in (1 << 20, 400):
        got = lexical.search(table, items_of(spark, items), 20, index, block)
        assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, lexical.search(table, items_of(spark, items), 3).collect())) == sorted(r for r in want if r[1] <= 3)


def test_large_numbers(spark, docs_of):
    """Scores beyond 2^53: an item that repeats its terms often."""
    docs = [(i, prose(5, i)) for i in range(300)] + [(300 + i, "zq " * 40 + "z" * i) for i in range(3)]
    items = [("big", "zq " * 3_000_000 + " ".join(VOCAB)), ("small", VOCAB[0])]
    got = lexical.search(docs_of([(i, t, "s") for i, t in docs]), items_of(spark, items), 5)
    want = sorted(brute.ranked(docs, items, 5))
    assert max(r[3] for r in want) > 2**53
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows(spark, docs_of):
    long = prose(60_000, 8)
    docs = [(None, None), (None, "apple pie"), (1, None), (2, ""), (3, " ,;\n"), (4, "Apple"), (4, "Apple"), (4, "apple apple tree"),
            (5, "Äpple apple"), (6, long + " apple"), (7, "x_apple-y"), (8, "中文 pie"), (-9, "PIE\x00pie"), (10, "a b c")]
    items = [(1, "apple"), (2, None), (3, ""), (4, "nowhere"), (None, "pie apple apple"), (5, "APPLE, pie"), (5, "APPLE, pie"), (5, "tree"),
             (6, "äpple Äpple"), (7, "中文"), (8, long)]
    got = lexical.search(docs_of([(i, t, "s") for i, t in docs]), items_of(spark, items, "long")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.ranked(docs, items, 20), key=str)
    assert {r.item_id for r in got} == {None, 1, 5, 6, 7, 8}


def test_empty(spark, docs_of):
    some, none = docs_of([(1, "a b", "s")]), docs_of([])
    columns = ["item_id", "rank", "doc_id", "score"]
    for docs, items in ((none, [("i", "a")]), (some, []), (none, []), (docs_of([(1, None, "s")]), [("i", "a")])):
        got = lexical.search(docs, items_of(spark, items))
        assert got.collect() == [] and got.columns == columns
    assert dict(lexical.search(some, items_of(spark, [], "int")).dtypes)["item_id"] == "int"


@pytest.mark.parametrize("leaves", [1, 31, 32, 33, 1100])
def test_nodes_bound_their_leaves(leaves):
    import numpy as np
    rng = np.random.default_rng(leaves)
    full = rng.integers(0, 9, (leaves, 12)) * (rng.random((leaves, 12)) < 0.3)
    leaf, term = np.nonzero(full)
    tree = lexical._Tree(leaf, term, full[leaf, term].astype(np.int64), leaves)
    for level in range(tree.height + 1):
        for node in range(len(tree.levels[level][0]) - 1):
            got = tree.dense(level, range(node, node + 1), np.arange(12), np.int64)[0]
            assert (got == full[tree.leaves(level, node)].max(0)).all()

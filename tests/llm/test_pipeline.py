"""Pipeline stages, each against a brute-force version on its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carelake.llm import mixing, quality
from tests.conftest import SF_SMALL
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input of every stage and, last, the result; written and read again as the driver does."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF_SMALL)
        docs.write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line dedup", "near dedup", "decontamination", "mixing"]
    for df in stages[:-1]:
        assert df.columns == COLUMNS
    assert stages[-1].columns == COLUMNS + ["size", "source_size", "target", "taken", "copies"]
    assert all(df.count() for df in stages)


def test_quality_rejects_only_what_it_scores_low(spark, stages):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in quality.quality_scores(stages[0], labels).collect()}
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if scores[i]}
    known = {r.doc_id: r.quality for r in labels.collect()}
    kept = texts(stages[1])
    assert all(i in kept for i, q in known.items() if q == 1)              # clean documents stay
    junk = [i for i, q in known.items() if q == 0]
    assert sum(i in kept for i in junk) <= 0.2 * len(junk)                 # from some 60 labels


def test_lines(stages):
    cut = brute.whole_line_cut(list(texts(stages[1]).items()), 30)
    before = texts(stages[1])
    assert texts(stages[2]) == {i: t for i, t in cut.items() if t == before[i] or brute.SPACED.search(t)}
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near(stages):
    found = brute.near(list(texts(stages[2]).items()), 5, 80, 100)
    assert texts(stages[3]) == {i: t for i, t in texts(stages[2]).items() if found[i][2]}


def test_benchmark(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute.leaks(list(texts(stages[3]).items()), items, 10)
    assert texts(stages[4]) == {i: t for i, t in texts(stages[3]).items() if not hit[i][1]}


def test_mix(stages):
    want = {r.doc_id: r.taken for r in mixing.mix(stages[4], carry=["doc_id"]).collect()}
    assert {r.doc_id: r.taken for r in stages[5].collect()} == want
    assert texts(stages[5]) == texts(stages[4])


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[5].collect()))


def test_odd_rows_go_through(spark, docs_of):
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(None, None, None), (None, words, "a"), (1, None, "a"), (2, "", "b"), (3, words, "a"), (3, words, "a"),
            (4, " \n\t", None), (5, "short", "b"), (6, "x" * 200_000, "c")]
    docs = docs_of(rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    done = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert done.count() == docs.count() and done.filter(F.col("doc_id") == 5).count() == 1
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_SMALL)
        assert empty.collect() == []
        empty = spark.createDataFrame([], empty.schema)


def test_shared_and_null_ids(spark, docs_of):
    """Each stage but the first on repeated rows and ids: one row of each group, and no text of its own is lost."""
    w, u = (" ".join(f"{c}{i}" for i in range(80)) for c in "wu")
    near = dict(corpus_pipeline.STAGES)["near dedup"]
    left = lambda rows: sorted(map(str, texts_of(near(spark, docs_of(rows), SF_SMALL))))
    assert left([(3, w, "a"), (3, w, "a"), (None, w, "a"), (None, w, "a"), (4, w, "a")]) == [str((3, w))]
    assert left([(5, w, "a"), (7, w, "a"), (7, u, "a")]) == sorted([str((5, w)), str((7, u))])
    # a line of its own keeps the run a run: rows of one document are cut alike, later documents lose it
    lines = dict(corpus_pipeline.STAGES)["line dedup"]
    rows = [(3, f"{w}\nb c", "a"), (3, f"{w}\nb c", "a"), (None, f"x\n{w}\nb c", "a"), (9, f"y\n{w}", "a")]
    assert sorted(map(str, texts_of(lines(spark, docs_of(rows), SF_SMALL)))) == sorted(
        map(str, [(3, f"{w}\nb c"), (3, f"{w}\nb c"), (None, "x"), (9, "y")]))


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

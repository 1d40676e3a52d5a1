"""Registered queries against DuckDB SQL, or against brute force where SQL has no words for them."""

import zlib

import duckdb
import pytest

import __spark_entry__ as E
from carelake.llm.queries import REGISTRY
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute
from tools.oracle_check import TABLES, digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def rows_of(spark, name, sf=SF_SMALL):
    return E.queries()[name](spark, sf)


def docs(spark, sf=SF_SMALL):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_all_registered():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in REGISTRY}
    assert set(REGISTRY) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_matches_sql(spark, duck, name):
    df = rows_of(spark, name)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(REGISTRY[name][1])
    found, cols = rel.fetchall(), rel.columns
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(found)
    assert digest(rows, df.columns) == digest(found, cols)


def test_mix_comes_near_its_targets(spark):
    source = dict(map(tuple, spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "source").collect()))
    by = {}
    for r in rows_of(spark, "op1_mix_sources", SF_MID).collect():
        assert 0 <= r.taken <= 2 * r["size"]
        by.setdefault(source[r.doc_id], []).append(r)
    for rows in by.values():
        assert rows[0].source_size == sum(r["size"] for r in rows) and rows[0].target <= 2 * rows[0].source_size
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1
    total = sum(rows[0].source_size for rows in by.values())
    assert sum(rows[0].target for rows in by.values()) == pytest.approx(1.5 * total)


def test_token_counts_are_the_library_s(spark):
    import public_tokenizers
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(docs(spark))
    got = rows_of(spark, "op3_token_count").collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(lib.encode(texts[r.doc_id] or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 4096)


def test_repeated_bytes_by_brute_force(spark):
    got = sorted(tuple(r) for r in rows_of(spark, "op9_repeated_bytes").collect())
    assert got == sorted(brute.repeated(docs(spark), 50))


def test_quality_held_out(spark):
    got = {r.doc_id: r for r in rows_of(spark, "op10_quality_rules", SF_MID).collect()}
    assert len(got) == len(docs(spark, SF_MID))
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    right = n = 0
    for r in labels:
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3)
        if g.held_out:
            n, right = n + 1, right + (g.predicted == r.quality)
    assert n > 40 and right / n >= 0.97

"""Periodic runs against trying every period."""

import random

import pytest

from carelake.llm import periods
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.test_queries import docs, rows_of


def sequences(seed, count):
    r = random.Random(seed)
    for _ in range(count):
        words = []
        while len(words) < r.randint(0, 70):
            words += [r.randint(0, r.choice([1, 3])) for _ in range(r.randint(1, 5))] * r.randint(1, 7)
        yield words


def test_lyndon_lengths():
    for s in sequences(3, 400):
        want = [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]
        assert periods.lyndon_lengths(s) == want


@pytest.mark.parametrize("exponent, shortest", [(2, 1), (3, 5), (4, 6), (7, 1)])
def test_runs_of_sequences(exponent, shortest):
    parts = list(sequences(exponent, 300)) + [[], [1], [0, 1] * 40, [2] * 9, [x.bit_count() % 2 for x in range(512)]]
    got = [list(map(tuple, x.tolist())) for x in periods.find_runs(parts, exponent, shortest)]
    assert got == [brute.word_runs(p, exponent, shortest) for p in parts]


def test_stretches_lose_no_run():
    for s in sequences(11, 300):
        inside = {i for a, b in periods.stretches(s, 4, 6) for i in range(a, b)}
        for a, n, _ in brute.word_runs(s, 4, 6):
            assert set(range(a, a + n)) <= inside


def test_odd_rows(docs_of, spark):
    texts = [None, "", " \n\t ", "one", "a b " * 8 + "a", "a a a a a a", "A a " * 9, "é 中 x 🙂 " * 5, "x\x00 y\x0b" * 7,
             "v w x y z " * 4000 + "end " + "q " * 3000, " ".join(map(str, range(5000)))]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(4, texts[4], "s"), (4, texts[4], "s"), (None, texts[5], "s"), (4, texts[7], "s")]
    got = periodic = periods.periodic_runs(docs_of(rows)).collect()
    assert len(periodic) == len(rows)
    want = []
    for i, t, _ in rows:
        w = brute.SPACED.findall(t or "")
        runs = brute.word_runs(w, 4, 6) if len(w) < 4000 else [(0, 20000, 5), (20001, 3000, 1)] if "end" in t else []
        gone = {x for s, n, q in runs for x in range(s + q, s + n)}
        want.append((i, len(w), runs, " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept) for r in got), key=str) == sorted(want, key=str)
    assert periods.periodic_runs(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        periods.periodic_runs(docs_of([]), exponent=1)


def test_tails(docs_of):
    rows = [(i, t, "s") for i in range(120) for t in ("w%d " % i * 3 + " ".join(f"u{k}" for k in range(i)), None, " ")] + [(None, "a b", "s")]
    got = [(r.doc_id, brute.SPACED.findall(r.text or "")) for r in periods.with_periodic_tails(docs_of(rows)).collect()]
    want = [(i, brute.periodic_tail(i, brute.SPACED.findall(t or ""))) for i, t, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_by_brute_force(spark):
    """Whole texts of the small table; the longest by the period alone would take minutes, so up to 3,000 words."""
    rows = {i: brute.periodic_tail(i, brute.SPACED.findall(t or "")) for i, t in docs(spark)}
    got = {r.doc_id: tuple(r) for r in rows_of(spark, "op13_periodic_runs", SF_SMALL).collect()}
    assert got.keys() == rows.keys()
    for i, words in rows.items():
        if len(words) <= 3000:
            assert got[i] == brute.runs_row(i, words)
    assert sum(r[1] > 0 for r in got.values()) > 10

"""Keyed batch writes against a brute-force model of one-row-at-a-time SQL."""

from hypothesis import HealthCheck, given, settings, strategies as st

from carelake.operators import dml

KEYS = st.sampled_from(["K1", "K2", "K3", "K4"])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=8)
SCHEMA = "k string, v int"


def _table(rows):
    out = {}
    for k, v in rows:
        out.setdefault(k, v)      # a target table has one row per key
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=ROWS, incoming=ROWS)
def test_insert_if_absent_matches_sequential_inserts(spark, target, incoming):
    t = _table(target)
    model = dict(t)
    for k, v in incoming:                  # INSERT ... ON CONFLICT DO NOTHING, row by row
        model.setdefault(k, v)
    inc = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(incoming)], SCHEMA + ", pos int")
    # order by arrival position: first request wins
    target_df = spark.createDataFrame([(k, v, -1) for k, v in t.items()], SCHEMA + ", pos int")
    got = dml.insert_if_absent(target_df, inc, "k", order=["pos"]).drop("pos")
    assert sorted(map(tuple, got.collect())) == sorted(model.items())


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=ROWS, updates=ROWS)
def test_update_by_key_matches_sequential_updates(spark, target, updates):
    t = _table(target)
    model = dict(t)
    for k, v in updates:                   # UPDATE t SET v = ? WHERE k = ?, row by row: last wins
        if k in model:
            model[k] = v
    upd = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(updates)], SCHEMA + ", pos int")
    got = dml.update_by_key(spark.createDataFrame(list(t.items()), SCHEMA), upd, "k", ["v"], order=["pos"])
    assert sorted(map(tuple, got.collect())) == sorted(model.items())


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=ROWS, keys=st.lists(KEYS, max_size=4))
def test_delete_by_key(spark, target, keys):
    t = _table(target)
    model = {k: v for k, v in t.items() if k not in set(keys)}
    got = dml.delete_by_key(spark.createDataFrame(list(t.items()), SCHEMA),
                            spark.createDataFrame([(k,) for k in keys], "k string"), "k")
    assert sorted(map(tuple, got.collect())) == sorted(model.items())

"""One small test per finding of the round: evenly dealt input, one evaluation per step, bounded tasks, whole reports."""

import os
import re

import __spark_entry__ as E
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from carelake.operators import cdc
from carelake.plans import catalog
from carelake.sources import fixtures as fx, loader
from carelake.sources.envelope import decode
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _events(path, ids):
    """An ``events`` table of its own, as one file of one row group."""
    import datetime as dt
    n = len(ids)
    pq.write_table(pa.table({
        "event_id": pa.array(ids, pa.int64()), "ts": pa.array([dt.datetime(2024, 1, 2) + dt.timedelta(minutes=i) for i in range(n)], pa.timestamp("us")),
        "user_id": pa.array([1] * n, pa.int64()), "event_type": ["view"] * n, "value": [1.5] * n, "props": ['{"k": 1}'] * n}), path / "events.parquet")


@pytest.mark.parametrize("ids,files", [([1, 2, 3, 4, 5, 5], 3), ([3, 6, 9], 1), (list(range(7)), 4)])
def test_quarantine_counts_sound_files(spark, tmp_path, monkeypatch, ids, files):
    """each sound file is in the report once; the number follows from the rows."""
    monkeypatch.setattr(catalog, "FILE_ROWS", 2)
    _events(tmp_path, ids)
    got = {r["status"]: tuple(r[1:]) for r in catalog.q_corrupt_file_quarantine(spark, str(tmp_path)).select(
        "status", "files", "bad_files", "n_rows").collect()}
    assert got == {"corrupt": (2, 2, 0), "loaded": (files, 0, len(ids))}


def test_quarantine_sql_counts_sound_files():
    assert "as files" in E.oracle_sql()["corrupt_file_quarantine"]


def test_changes_are_dealt_before_they_are_built(spark):
    """the rows of one dense file do not stay with one task."""
    assert re.search(r"hashpartitioning\(c_custkey#", _plan(fx.fx_entity_envelope(spark, SF_SMALL, "patient")))
    assert re.search(r"hashpartitioning\(event_id#", _plan(fx.fx_envelope(spark, SF_SMALL)))


def test_classify_writes_no_step_into_another(spark):
    """presence of an image is tested once per image, not once for each place that asks for it."""
    rows = spark.createDataFrame([("server.public.patient", 1, "x")], "topic string, position bigint, value string")
    plan = cdc.classify(decode(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(after#") == 1 and plan.count("trim(before#") == 1
    assert not {"_up", "_dl", "_image", "_sound"} & set(cdc.classify(decode(rows)).columns)


def test_largest_key_takes_no_sort(spark, tmp_path):
    """counting folders and the largest key holds a row per folder, not all rows of a task."""
    rows = fx.source_table(spark, SF_SMALL, "hospital")
    rows.write.parquet(f"{tmp_path}/lake/hospital/date=2024-01-01")
    loader.load_new_files(spark, f"{tmp_path}/lake", f"{tmp_path}/raw", f"{tmp_path}/state", tables=("hospital",))
    got = catalog._loaded(spark, f"{tmp_path}/raw", (("hospital", "hospital_id"), ("doctor", "doctor_id")))
    assert "Sort [" not in _plan(got)
    assert sorted(map(tuple, got.collect())) == [("doctor", 0, 0, None), ("hospital", 1, rows.count(), rows.agg(F.max("hospital_id")).first()[0])]


def test_large_files_are_not_held_whole(spark, tmp_path, monkeypatch):
    """the content of a file above ``CHECK_BYTES`` is never asked for."""
    spark.range(20_000).withColumn("x", F.sha2(F.col("id").cast("string"), 256)).coalesce(1).write.parquet(f"{tmp_path}/lake/hospital/date=2024-01-01")
    size = max(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path) for f in fs)
    monkeypatch.setattr(loader, "CHECK_BYTES", 1000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", str(size // 2))     # a read of such a content fails
    try:
        loader.load_new_files(spark, f"{tmp_path}/lake", f"{tmp_path}/raw", f"{tmp_path}/state", tables=("hospital",))
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert loader.read_raw(spark, f"{tmp_path}/raw", "hospital").count() == 20_000

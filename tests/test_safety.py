"""Failures are raised and nothing is lost silently."""

import pytest
from pyspark.sql import functions as F

from carelake import session
from carelake.operators import dml
from carelake.operators.staging import stage
from carelake.plans import daily_job
from carelake.registry import APPOINTMENT_EVENTS, wire_ddl
from carelake.sinks import lake, tables
from carelake.sources import fixtures as fx, loader
from tests.conftest import SF_SMALL
from tests.test_traps import raw_rows


def damage(folder):
    """Cut every Parquet file under ``folder`` in half."""
    hit = 0
    for f in folder.rglob("*.parquet"):
        f.write_bytes(f.read_bytes()[: f.stat().st_size // 2])
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
        hit += 1
    assert hit


def test_failing_pointer_read_raises(spark, tmp_path):
    root = str(tmp_path)
    df = lambda ids: spark.createDataFrame([(i,) for i in ids], "id int")
    assert tables.current_path(spark, root, "t") is None
    tables.write_incremental(df([1, 2]), root, "t", "keyed", key=["id"])
    assert tables.current_path(spark, root, "other") is None
    damage(tmp_path / "_catalog")
    with pytest.raises(Exception, match="(?i)parquet|read"):
        tables.write_incremental(df([3]), root, "t", "keyed", key=["id"])


def test_newest_pointer_counts(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        tables.write_version(spark.range(n), root, "t")
    assert tables.read_current(spark, root, "t").count() == 3


def test_damaged_closed_versions_raise(spark, tmp_path):
    root = str(tmp_path)
    raw = raw_rows(fx.fx_entity(spark, SF_SMALL, "hospital"))
    raw.withColumn("b", F.col("b").cast("int")).write.partitionBy("b").parquet(f"{root}/raw/hospital")
    runs = [(b, fx.run_ts_of(b)) for b, _ in fx.RUNS]
    daily_job.snapshot_runs(spark, root, runs[:1], entities=("hospital",))
    whole = daily_job.read_snapshot(spark, root, "hospital").count()      # nothing closed yet: no error
    assert whole == 25
    daily_job.snapshot_runs(spark, root, runs[1:], entities=("hospital",))
    assert daily_job.read_snapshot(spark, root, "hospital").count() == 30
    damage(next((tmp_path / "snap_hospital").glob("v=*/_open=false")))
    with pytest.raises(Exception, match="(?i)parquet|read"):
        daily_job.read_snapshot(spark, root, "hospital").collect()
    with pytest.raises(ValueError):
        daily_job.read_snapshot(spark, root, "patient")


def load_hospitals(spark, tmp_path, to="", **kw):
    """(status by arrival day, values of the raw rows) after a load of all there is."""
    args = (spark, str(tmp_path / "lake"), str(tmp_path / f"raw{to}"), str(tmp_path / f"state{to}"))
    loader.load_new_files(*args, tables=("hospital",), **kw)
    report = {r["path"].split("date=")[1][:10]: (r["status"], r["reason"]) for r in loader.read_report(spark, args[3]).collect()}
    raw = loader.read_raw(spark, args[2], "hospital")
    return report, [r[0] for r in raw.select(F.to_json("v")).collect()]


def test_half_broken_file_is_quarantined_whole(spark, tmp_path):
    rows = fx.source_table(spark, SF_SMALL, "hospital")
    put = lambda day: rows.coalesce(1).write.parquet(f"{tmp_path}/lake/hospital/date=2024-01-{day}")
    put("01"), put("02")
    damage(tmp_path / "lake" / "hospital" / "date=2024-01-01")
    report, got = load_hospitals(spark, tmp_path, max_files=1)        # the bad file is first and holds up nothing
    assert report["2024-01-02"] == ("loaded", None) and report["2024-01-01"][0] == "corrupt" and report["2024-01-01"][1]
    assert len(got) == rows.count()
    put("03")
    report, got = load_hospitals(spark, tmp_path, max_files=1)
    assert report["2024-01-03"][0] == "loaded" and len(got) == 2 * rows.count()


def test_one_call_loads_more_files_than_a_batch_takes(spark, tmp_path):
    rows = fx.source_table(spark, SF_SMALL, "hospital")
    rows.repartition(7).write.parquet(f"{tmp_path}/lake/hospital/date=2024-01-01")
    _, got = load_hospitals(spark, tmp_path, max_files=2)
    assert len(got) == rows.count() and len(set(got)) == rows.count()
    assert len(list((tmp_path / "raw" / "hospital").glob("load_id=*"))) >= 3


def test_interrupted_load_is_redone_once(spark, tmp_path):
    rows = fx.source_table(spark, SF_SMALL, "hospital")
    rows.coalesce(1).write.parquet(f"{tmp_path}/lake/hospital/date=2024-01-01")
    load_hospitals(spark, tmp_path)
    for f in (tmp_path / "state" / "files" / "hospital" / "commits").glob("*0*"):
        f.unlink()                                      # rows written, died before the commit
    _, got = load_hospitals(spark, tmp_path)
    assert len(got) == rows.count()


def test_drift_is_no_damage(spark, tmp_path, monkeypatch):
    """Unknown fields, other types and other orders of columns, in one micro-batch and read by Spark alone."""
    root = f"{tmp_path}/lake/hospital/date=2024-01-0"
    rows = fx.source_table(spark, SF_SMALL, "hospital").where("hospital_id = 'H1'")
    rows.write.parquet(root + "1")
    rows.select(F.lit(True).alias("_deleted"), "*", F.struct(F.lit(1).alias("x")).alias("new_col")).write.parquet(root + "2")
    rows.withColumn("bed_capacity", F.lit(1 << 40)).write.parquet(root + "3")
    rows.withColumn("bed_capacity", F.lit("many")).write.parquet(root + "4")
    rows.select(F.create_map(F.lit(1), F.lit("x")).alias("by_number")).write.parquet(root + "5")
    for limit in (loader.CHECK_BYTES, 0):
        monkeypatch.setattr(loader, "CHECK_BYTES", limit)
        import json
        report, got = load_hospitals(spark, tmp_path, to=limit)
        values = sorted((json.loads(x) for x in got), key=lambda v: str(v.get("bed_capacity")))
        assert [v["bed_capacity"] for v in values] == sorted([60, 60, 1 << 40, "many"], key=str)
        assert [(v["_deleted"], v["new_col"]) for v in values if "new_col" in v] == [(True, {"x": 1})]
        assert report.pop("2024-01-05")[0] == "unsupported" and {s for s, _ in report.values()} == {"loaded"}


def test_files_no_table_takes_stay_open(spark, tmp_path):
    rows = fx.source_table(spark, SF_SMALL, "hospital").coalesce(1)
    rows.write.option("mapreduce.output.basename", "clinic").parquet(f"{tmp_path}/lake/x/date=2024-01-01")
    args = (spark, str(tmp_path / "lake"), str(tmp_path / "raw"), str(tmp_path / "state"))
    loader.load_new_files(*args, by="prefix")
    assert loader.read_report(spark, args[3]).count() == 0
    rows.write.option("mapreduce.output.basename", "hospital_1").parquet(f"{tmp_path}/lake/x/date=2024-01-02")
    loader.load_new_files(*args, by="prefix")
    assert loader.read_raw(spark, args[2], "hospital").count() == rows.count()
    assert loader.read_report(spark, args[3]).count() == 1
    with pytest.raises(ValueError):
        loader.load_table(*args[:2], "hospital", *args[2:], by="size")


def test_unreadable_event_id_does_not_stop_staging(spark):
    rows = spark.createDataFrame([("EVT-9", "A1", "P1", "D1", "H1", "BOOKED", 1, 5, 1.0)], wire_ddl("appointment_events"))
    assert stage(rows, APPOINTMENT_EVENTS).count() == 1


def test_events_tie_on_position_first(spark):
    rows = spark.createDataFrame([("E000009", "A1", "P1", "D1", "H1", "BOOKED", 1, 5, 1.0, 1),
                                  ("E000002", "A1", "P1", "D1", "H1", "CANCELLED", 1, 5, 1.0, 2)],
                                 wire_ddl("appointment_events") + ", position bigint")
    assert stage(rows, APPOINTMENT_EVENTS).first()["event_type"] == "cancelled"


def test_dml_never_keeps_duplicate_requests(spark):
    t = spark.createDataFrame([("a", 1)], "k string, v int")
    inc = spark.createDataFrame([("b", 1), ("b", 2), ("a", 9)], "k string, v int")
    assert sorted(map(tuple, dml.insert_if_absent(t, inc, "k", order=["v"]).collect())) == [("a", 1), ("b", 1)]
    upd = spark.createDataFrame([("a", 3), ("a", 4)], "k string, v int")
    assert list(map(tuple, dml.update_by_key(t, upd, "k", ["v"], order=["v"]).collect())) == [("a", 4)]
    assert dml.update_by_key(t, upd, "k", ["v"], order=[]).count() == 1


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
    assert session.is_local("local[4]") and not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")


def _changes(spark, *names):
    from functools import reduce
    return reduce(lambda x, y: x.unionByName(y), [fx.fx_entity_envelope(spark, SF_SMALL, n).where("b = 0").drop("b") for n in names])


def test_rerun_of_a_load_replaces_all_its_tables(spark, tmp_path):
    """A load done again without hospital rows leaves none of them, in lake and raw."""
    root = str(tmp_path)
    got = daily_job.land(spark, _changes(spark, "hospital", "doctor"), root, 0, "2024-01-21")
    n = daily_job.read_raw(spark, root, "hospital", 0).count()
    assert n == got["hospital"] == 25 and got["patient"] == 0
    again = daily_job.land(spark, _changes(spark, "doctor"), root, 0, "2024-01-22")
    assert again["hospital"] == 0 and again["doctor"] == got["doctor"]
    assert daily_job.read_raw(spark, root, "hospital", 0).count() == 0
    assert lake.read_lake_table(spark, root + "/lake", "hospital", with_batch=True).count() == 0
    doctors = lake.read_lake_table(spark, root + "/lake", "doctor", with_batch=True)
    assert doctors.count() == got["doctor"] and [str(r[0]) for r in doctors.select("date").distinct().collect()] == ["2024-01-21"]


def test_positions_are_marked_last(spark, tmp_path):
    """A load that died half-way did not land: the next one does not drop its records."""
    root = str(tmp_path)
    rows = _changes(spark, "hospital")
    daily_job.land(spark, rows, root, 0, "2024-01-21")
    import shutil
    shutil.rmtree(tmp_path / "_positions" / "load=0")           # as if it had died before its mark
    assert daily_job.land(spark, rows, root, 1, "2024-01-21")["hospital"] == 25
    assert daily_job.land(spark, rows, root, 2, "2024-01-21")["hospital"] == 0
    no_position = rows.withColumn("position", F.lit(None).cast("bigint"))
    assert daily_job.land(spark, no_position, root, 3, "2024-01-21")["hospital"] == 25


def test_rejects_are_counted_by_reason(spark, tmp_path):
    bad = spark.createDataFrame([("server.public.other", 1, '{"payload":{"op":"c","after":{"a":1}}}'), ("server.public.doctor", 2, None),
                                 ("server.public.doctor", 3, '{"payload":{"op":"c","after":"[1]"}}'), ("server.public.doctor", 4, "{}"),
                                 ("server.public.doctor", 5, '{"payload":{"op":"x","after":{"a":1}}}')],
                                "topic string, position bigint, value string")
    got = daily_job.land(spark, bad, str(tmp_path), 0, "2024-01-21")
    assert {k: v for k, v in got.items() if v} == {"reject_tombstone": 1, "reject_no_payload": 1, "reject_unknown_topic": 1,
                                                   "reject_invalid_op": 1, "reject_invalid_image": 1}


def test_published_versions_of_runs(spark, tmp_path):
    root = str(tmp_path)
    put = lambda *runs: tables.publish_versions(spark, root, [("t", f"p{n}", r) for n, r in runs])
    put((0, 0), (1, 1))
    put((2, 2))
    assert tables.published(spark, root, "t") == [(2, "p2"), (1, "p1"), (0, "p0")]
    put((3, 1))                                          # run 1 again: run 2 is to be done again, too
    assert tables.published(spark, root, "t") == [(1, "p3"), (0, "p0")]
    assert tables.current_path(spark, root, "t", before=1) == "p0"
    put((4, 2))
    assert tables.published(spark, root, "t") == [(2, "p4"), (1, "p3"), (0, "p0")]
    put((5, 0))
    assert tables.published(spark, root, "t") == [(0, "p5")] and tables.published(spark, root, "other") == []

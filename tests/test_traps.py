"""One literal test per semantic trap, answers computed by hand."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from carelake.functions.types import days_to_date, micros_to_ts, to_fee, ts_lit, UNIX_DATE_BASE
from carelake.functions import display as dsp
from carelake.operators import aggregates as agg, cdc, dml, scd2
from carelake.operators.latest import latest_by_max_by, latest_by_rank
from carelake.operators.marts import build_fact
from carelake.operators.staging import stage
from carelake.registry import DOCTOR, HOSPITAL
from carelake.sources.envelope import decode
from carelake.sources import files as lakefiles

HOSP = "hospital_id string, hospital_name string, city string, country string, bed_capacity int, created_at bigint, b int"


def test_t1_null_time_wins_newest_first(spark):
    # the delete image has no created_at: with NULLS FIRST it is the latest row
    df = spark.createDataFrame([("H1", "a", 10, 1), ("H1", None, None, 2)], "k string, name string, ts bigint, pos int")
    for f in (latest_by_rank, latest_by_max_by):
        r = f(df, "k", ["ts"], ["pos"]).collect()
        assert [x["name"] for x in r] == [None]


def test_t2_tie_broken_by_source_position(spark):
    df = spark.createDataFrame([("A1", "booked", 5, 1), ("A1", "confirmed", 5, 2)], "k string, s string, ts bigint, pos int")
    assert latest_by_rank(df, "k", ["ts"], ["pos"]).first()["s"] == "confirmed"
    assert latest_by_max_by(df, "k", ["ts"], ["pos"]).first()["s"] == "confirmed"


def test_t3_fee_rounds_half_up_to_scale_zero(spark):
    df = spark.createDataFrame([(320.75,), (320.5,), (-0.5,)], "f double")
    assert [r[0] for r in df.select(to_fee("f")).collect()] == [Decimal(321), Decimal(321), Decimal(-1)]


def test_t4_day_number_base(spark):
    df = spark.createDataFrame([(10957,)], "d int")
    r = df.select(days_to_date("d").alias("a"), days_to_date("d", UNIX_DATE_BASE).alias("b")).first()
    assert r["a"] == dt.date(2029, 12, 31) and r["b"] == dt.date(2000, 1, 1)


def test_t5_status_literal_case(spark):
    fact = spark.createDataFrame([("confirmed", "2024-01-20 10:00:00")], "event_type string, t string") \
        .select("event_type", F.col("t").cast("timestamp_ntz").alias("appointment_time"))
    assert agg.count_on_day(fact, "2024-01-20", "CONFIRMED").first()[0] == 0
    assert agg.count_on_day(fact, "2024-01-20", "CONFIRMED", case_sensitive=False).first()[0] == 1


def _snap(spark, rows):
    df = spark.createDataFrame(rows, "patient_id string, patient_name string, gender string, date_of_birth date, "
                                     "vf string, vt string")
    return df.select("patient_id", "patient_name", "gender", "date_of_birth",
                     F.col("vf").cast("timestamp_ntz").alias("dbt_valid_from"),
                     F.col("vt").cast("timestamp_ntz").alias("dbt_valid_to"))


def test_t6_fact_version_modes(spark):
    ev = spark.createDataFrame([("A1", "P1", "D1", "H1", "booked", "2024-01-05 00:00:00")],
                               "appointment_id string, patient_id string, doctor_id string, hospital_id string, "
                               "event_type string, t string").select(
        "*", F.col("t").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("t").cast("timestamp_ntz").alias("appointment_time"), F.lit(Decimal(10)).alias("consultation_fee"))
    p = _snap(spark, [("P1", "old", "Male", dt.date(2000, 1, 1), "2024-01-01 00:00:00", "2024-01-11 00:00:00"),
                      ("P1", "new", "Male", dt.date(2000, 1, 1), "2024-01-11 00:00:00", None)])
    d = spark.createDataFrame([], "doctor_id string, doctor_name string, specialty string, experience_years int, "
                                  "dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    h = spark.createDataFrame([], "hospital_id string, hospital_name string, city string, country string, "
                                  "dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    names = {m: sorted(r["patient_name"] for r in build_fact(ev, p, d, h, m).collect())
             for m in ("all", "current", "as_of")}
    assert names == {"all": ["new", "old"], "current": ["new"], "as_of": ["old"]}


def test_t7_specialty_counts_multiply_versions(spark):
    fact = spark.createDataFrame([("D1",), ("D1",), ("D2",)], "doctor_id string")
    dim = spark.createDataFrame([("D1", "Neurology"), ("D1", "Neurology"), ("D1", "Oncology"), ("D2", "Oncology")],
                                "doctor_id string, specialty string")
    got = {r["specialty"]: r["cnt"] for r in agg.specialty_counts(fact, dim).collect()}
    assert got == {"Neurology": 4, "Oncology": 3}


def test_t8_fact_append_vs_keyed(spark, tmp_path):
    from carelake.sinks import tables
    df = spark.createDataFrame([("A1", 1), ("A2", 2)], "appointment_id string, x int")
    for _ in range(2):
        tables.write_incremental(df, str(tmp_path), "f_app", "append")
        tables.write_incremental(df, str(tmp_path), "f_key", "keyed", key=["appointment_id"])
    assert tables.read_incremental(spark, str(tmp_path), "f_app", "append").count() == 4
    assert tables.read_incremental(spark, str(tmp_path), "f_key", "keyed").count() == 2


def test_t9_deletes_ignored_dropped_or_closed(spark):
    raw = spark.createDataFrame([("H1", "a", "c", "x", 10, 1, 0, None), ("H1", "a", "c", "x", 10, 2, 0, True)],
                                HOSP + ", _deleted boolean")
    assert stage(raw, HOSPITAL, ts_lit("2024-01-01")).count() == 1
    assert stage(raw, HOSPITAL, ts_lit("2024-01-01"), deletes="drop").count() == 0
    st = stage(raw.where(F.col("_deleted").isNull()), HOSPITAL, ts_lit("2024-01-01"))
    h0 = scd2.first_run(st, HOSPITAL, ts_lit("2024-01-01 00:00:00"))
    dl = st.withColumn("_deleted", F.lit(True))
    closed = scd2.merge(h0, dl, HOSPITAL, ts_lit("2024-01-02 00:00:00"), deletes="close").collect()
    assert len(closed) == 1 and closed[0]["dbt_valid_to"] == dt.datetime(2024, 1, 2)
    kept = scd2.merge(h0, dl, HOSPITAL, ts_lit("2024-01-02 00:00:00")).collect()
    assert len(kept) == 1 and kept[0]["dbt_valid_to"] is None


def test_t10_untracked_column_goes_stale(spark):
    cols = "doctor_id string, hospital_id string, doctor_name string, specialty string, experience_years int, created_at bigint, b int"
    r0 = spark.createDataFrame([("D1", "H1", "n", "Oncology", 3, 1, 0)], cols)
    r1 = spark.createDataFrame([("D1", "H9", "n", "Oncology", 3, 2, 1)], cols)   # moved hospital only
    runs = [(0, ts_lit("2024-01-01 00:00:00")), (1, ts_lit("2024-01-11 00:00:00"))]
    out = scd2.fold(r0.unionByName(r1), DOCTOR, runs).collect()
    assert len(out) == 1 and out[0]["hospital_id"] == "H1" and out[0]["dbt_valid_to"] is None


def test_t11_ids_compare_numerically(spark):
    existing = spark.createDataFrame([("E999999",), ("E1000000",)], "event_id string")
    req = spark.createDataFrame([("A1",), ("A2",)], "appointment_id string")
    got = sorted(r["event_id"] for r in dml.allocate_ids(req, existing, "event_id", ["appointment_id"], "E", 6).collect())
    assert got == ["E1000001", "E1000002"]
    assert existing.agg(F.max("event_id")).first()[0] == "E999999"     # the lexicographic trap


def test_t12_run_time_is_a_parameter(spark):
    raw = spark.createDataFrame([("H1", "a", "c", "x", 10, 1, 0)], HOSP)
    r = stage(raw, HOSPITAL, ts_lit("2024-05-05 00:00:00")).first()
    assert r["load_timestamp"] == dt.datetime(2024, 5, 5)


def test_t13_schema_drift_deleted_column(spark, tmp_path):
    from carelake.sinks import lake
    rows = spark.createDataFrame([("E000001", "A00001", "P1", "D1", "H1", "BOOKED", 1, 1, 1.0, 1)],
                                 "event_id string, appointment_id string, patient_id string, doctor_id string, "
                                 "hospital_id string, event_type string, appointment_time bigint, "
                                 "event_timestamp bigint, consultation_fee double, position bigint")
    lake.write_lake(rows, str(tmp_path), "appointment_events", "2024-01-21")
    back = lake.read_lake_table(spark, str(tmp_path), "appointment_events").first()
    assert back["_deleted"] is None and back["date"] == dt.date(2024, 1, 21)


def test_t14_flat_and_wrapped_envelopes(spark):
    env = spark.createDataFrame([
        ("s.public.hospital", 1, '{"payload": {"op": "c", "after": {"hospital_id": "H1"}}}'),
        ("s.public.hospital", 2, '{"op": "c", "after": {"hospital_id": "H2"}}'),
        ("s.public.hospital", 3, '{"payload": {"op": "d", "before": {"hospital_id": "H3"}, "after": null}}'),
        ("s.public.hospital", 4, '{"payload": {"op": "c", "after": {}}}'),
        ("s.public.other", 5, '{"payload": {"op": "c", "after": {"x": 1}}}'),
        ("s.public.hospital", 6, None),
        ("rogue.audit.hospital", 7, '{"payload": {"op": "c", "after": {"hospital_id": "H7"}}}'),
        ("s.public.hospital", 8, '{"payload": {"op": "c", "after": "junk"}}'),
        ("s.public.hospital", 9, '{"payload": {"op": "d", "before": [1]}}'),
    ], "topic string, position bigint, value string")
    topics = ["s.public.hospital"]
    strict = {r["position"]: (r["kind"], r["reason"]) for r in cdc.classify(decode(env, topics=topics)).collect()}
    assert strict == {1: ("upsert", None), 2: ("reject", "no_payload"), 3: ("delete", None),
                      4: ("reject", "invalid_op"), 5: ("reject", "unknown_topic"), 6: ("reject", "tombstone"),
                      7: ("reject", "unknown_topic"), 8: ("reject", "invalid_image"), 9: ("reject", "invalid_image")}
    flat = {r["position"]: r["kind"] for r in cdc.classify(decode(env, accept_flat=True, topics=topics)).collect()}
    assert flat[2] == "upsert"


def test_t15_json_null_missing_and_empty_keys(spark):
    raw = spark.createDataFrame([('{"hospital_id": null, "created_at": 1}',), ('{"created_at": 2}',),
                                 ('{"hospital_id": "", "created_at": 3}',), ('{"hospital_id": "H1", "created_at": 4}',)],
                                "j string").select(F.parse_json("j").alias("v"))
    got = sorted(r["hospital_id"] for r in stage(raw, HOSPITAL, ts_lit("2024-01-01")).collect())
    assert got == ["", "H1"]


def test_t16_share_rounds_half_even(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 8)], "specialty string, cnt bigint")
    got = {r["specialty"]: r["share"] for r in agg.with_share(counts).collect()}
    assert got == {"a": 12.0, "b": 100.0}      # 12.5 -> 12


def test_t17_ledger_prevents_reloads(spark, tmp_path):
    root = str(tmp_path / "in")
    spark.range(5).write.parquet(root + "/t/date=2024-01-01")
    ledger = lakefiles.list_files(spark, root)
    ledger.write.parquet(str(tmp_path / "ledger"))
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    assert lakefiles.new_files(lakefiles.list_files(spark, root), ledger).count() == 0
    spark.range(3).coalesce(1).write.mode("append").parquet(root + "/t/date=2024-01-02")
    new = lakefiles.new_files(lakefiles.list_files(spark, root), ledger)
    assert new.count() == 1 and "date=2024-01-02" in new.first()["path"]
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0] and "parquet" not in plan.split("binaryFile")[0].lower()


def test_prefix_vs_folder_routing(spark):
    keys = spark.createDataFrame([("raw/doctor/date=2024-01-01/patient_120000000000.parquet",),
                                  ("raw/doctor/date=2024-01-01/doctor_1.json",)], "key string")
    assert [r["table_name"] for r in lakefiles.route_by_prefix(keys).collect()] == ["patient"]
    assert [r["table_name"] for r in lakefiles.route_by_folder(keys).collect()] == ["doctor"]


def test_display_helpers(spark):
    df = spark.createDataFrame([("booked", "Male", 0.125, "2024-01-02 03:04:59")], "s string, g string, f double, t string")
    r = df.select(dsp.status_class("s"), dsp.gender_class(F.lit("x")), dsp.fee_text("f"),
                  dsp.minute_text(F.col("t").cast("timestamp_ntz"))).first()
    assert tuple(r) == ("booked", "Other", "$0.12", "2024-01-02T03:04")
    assert spark.range(1).select(micros_to_ts(F.lit(86_400_000_001))).first()[0] == dt.datetime(1970, 1, 2, 0, 0, 0, 1)


def test_object_load_rules(spark, tmp_path):
    import pytest
    ddl = "k string"
    with pytest.raises(ValueError):
        lakefiles.load_object(spark, "", ddl)
    assert lakefiles.load_object(spark, str(tmp_path / "x.json"), ddl).count() == 0
    spark.createDataFrame([("a",)], ddl).write.parquet(str(tmp_path / "t_1.parquet"))
    assert lakefiles.load_object(spark, str(tmp_path / "t_1.parquet"), ddl).count() == 1


def test_lake_prefix_is_cleaned():
    from carelake.sinks.lake import clean_prefix, table_path
    assert clean_prefix(" /raw/ ") == "raw" and clean_prefix(None) == ""
    assert table_path("root", "patient", " /raw/ ") == "root/raw/patient"
    assert table_path("root", "patient", " / ") == "root/patient"


def test_sensor_wait_is_bounded(spark, tmp_path):
    from carelake.streaming import ingest
    src = tmp_path / "empty"
    src.mkdir()
    s = spark.readStream.schema("x int").parquet(str(src))
    q = s.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "chk")) \
        .trigger(processingTime="1 second").start()
    assert ingest.await_or_stop(q, 2) is False and not q.isActive
    seen = lambda files: files.where(F.col("path").contains("patient_"))
    assert ingest.wait_for_file(spark, str(tmp_path / "none"), seen, 0.1, 0.1) is False
    assert ingest.wait_for_file(spark, str(src), seen, 0.1, 0.1) is False
    spark.range(1).write.parquet(str(src / "patient_1.parquet"))
    assert ingest.wait_for_file(spark, str(src), seen, 60) is True        # at once, not at the limit


def test_kafka_source_is_configured_not_faked(spark):
    import pytest
    from carelake.sources import kafka
    assert kafka.topics_for("server", ["patient", " doctor"]) == ["server.public.patient", "server.public.doctor"]
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.change_stream(spark, "localhost:9092", ["server.public.patient"])


def raw_rows(df):
    """Typed change rows as the raw table keeps them."""
    cols = [c for c in df.columns if c not in ("b", "position", "_deleted", "run_ts")]
    more = {"position": F.lit(None).cast("bigint"), "_deleted": F.lit(None).cast("boolean")}
    return df.withColumns({k: v for k, v in more.items() if k not in df.columns}).select(
        F.to_variant_object(F.struct(*cols)).alias("v"), "_deleted", F.col("position").cast("bigint"), "b")


def test_t9_daily_job_delete_policies(spark, tmp_path):
    from carelake.plans import daily_job
    cols = HOSP + ", _deleted boolean"
    rows = [("H1", "a", "c", "x", 10, 1, 0, None), ("H2", "b", "c", "x", 10, 1, 0, None),
            ("H1", "a", "c", "x", 10, 2, 1, True)]                     # H1 deleted in run 1
    runs = [(0, ts_lit("2024-01-01 00:00:00")), (1, ts_lit("2024-01-11 00:00:00"))]
    got = {}
    for policy in ("ignore", "drop", "close"):
        root = str(tmp_path / policy)
        raw_rows(spark.createDataFrame(rows, cols)).write.partitionBy("b").parquet(root + "/raw/hospital")
        daily_job.snapshot_runs(spark, root, runs, deletes=policy, entities=("hospital",))
        snap = daily_job.read_snapshot(spark, root, "hospital").where("hospital_id = 'H1'").collect()
        got[policy] = [(r["dbt_valid_to"] is None) for r in snap]
    assert got == {"ignore": [True], "drop": [True], "close": [False]}


def test_texts_that_read_as_objects_are_checked(spark):
    """An image must be an object: a text is one only if it parses as one, however it is written."""
    from carelake.operators import cdc
    from carelake.sources.envelope import decode
    images = ['{"a":1}', ' {"a": {"b": [1]}} ', r'"{\"a\":1}"', r'"{bad"', r'" {\"a\":1"', r'"\u007bbad}"', r'" {\"a\":1}"', "[1]", "7", '"text"']
    rows = [("server.public.doctor", i, '{"payload":{"op":"c","after":%s}}' % x) for i, x in enumerate(images)]
    got = cdc.classify(decode(spark.createDataFrame(rows, "topic string, position bigint, value string")))
    assert [r["kind"] for r in got.orderBy("position").collect()] == ["upsert"] * 3 + ["reject"] * 3 + ["upsert"] + ["reject"] * 3

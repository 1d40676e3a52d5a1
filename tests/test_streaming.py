"""Streaming jobs: batch-equivalent results, restart adds nothing, order does not matter."""

from pyspark.sql import functions as F

from carelake.operators import cdc
from carelake.operators.staging import stage
from carelake.registry import APPOINTMENT_EVENTS
from carelake.sinks import lake as lakesink
from carelake.sources import fixtures as fx
from carelake.sources.envelope import decode
from carelake.streaming import ingest
from tests.conftest import SF_SMALL


def _envelopes(spark, folder, chunks):
    env = fx.fx_envelope(spark, SF_SMALL)
    for i in chunks:
        env.where(F.col("position") % 3 == i).write.json(f"{folder}/chunk={i}")


def _stream(spark, folder):
    return (spark.readStream.schema(ingest.ENVELOPE_FILE_SCHEMA).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").json(folder))


def test_stream_to_lake_equals_batch_and_restart_is_idempotent(spark, tmp_path):
    src, lake, quar, chk = (str(tmp_path / x) for x in ("in", "lake", "q", "chk"))
    _envelopes(spark, src, [0, 1])
    ingest.envelopes_to_lake(_stream(spark, src), lake, quar, chk, run_date="2024-01-21").awaitTermination()
    _envelopes(spark, src, [2])                 # a later arrival, same checkpoint
    ingest.envelopes_to_lake(_stream(spark, src), lake, quar, chk, run_date="2024-01-21").awaitTermination()
    ingest.envelopes_to_lake(_stream(spark, src), lake, quar, chk, run_date="2024-01-21").awaitTermination()
    got = lakesink.read_lake_table(spark, lake, "appointment_events", with_batch=True).drop("date", "batch_id")
    want = cdc.unified(cdc.classify(decode(fx.fx_envelope(spark, SF_SMALL))), "appointment_events").drop("table_name")
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0


def test_current_state_is_order_independent(spark, tmp_path):
    raw = fx.fx_raw(fx.fx_event(spark, SF_SMALL))
    n = F.substring(F.try_variant_get("v", "$.event_id", "string"), 2, 10).cast("bigint")
    want = stage(raw, APPOINTMENT_EVENTS)
    for order in ((0, 1, 2), (2, 1, 0)):
        root = str(tmp_path / ("s" + "".join(map(str, order))))
        for i in order:
            raw.where(n % 3 == i).write.parquet(f"{root}/in/chunk={i}")
        s = (spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1)
             .option("recursiveFileLookup", "true").parquet(root + "/in"))
        ingest.current_state(s, APPOINTMENT_EVENTS, root + "/log", root + "/chk").awaitTermination()
        got = ingest.read_current_state(spark, root + "/log", APPOINTMENT_EVENTS)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_empty_batch_writes_nothing(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    lake = str(tmp_path / "lake")
    ingest.envelopes_to_lake(_stream(spark, str(src)), lake, str(tmp_path / "q"),
                             str(tmp_path / "chk")).awaitTermination()
    assert not (tmp_path / "lake").exists()


def test_batch_replayed_after_midnight_stays_one_copy(spark, tmp_path):
    lake = str(tmp_path / "lake")
    rows = cdc.unified(cdc.classify(decode(fx.fx_envelope(spark, SF_SMALL))), "appointment_events").drop("table_name")
    for today in ("2024-01-21", "2024-01-22"):
        date = lakesink.batch_date(spark, lake, 7, F.lit(today))
        lakesink.write_lake(rows, lake, "appointment_events", date, batch_id=7)
    back = lakesink.read_lake_table(spark, lake, "appointment_events", with_batch=True)
    assert back.count() == rows.count()
    assert [str(r[0]) for r in back.select("date").distinct().collect()] == ["2024-01-21"]


def test_compacted_state_reads_the_same(spark, tmp_path):
    raw = fx.fx_raw(fx.fx_event(spark, SF_SMALL))
    n = F.substring(F.try_variant_get("v", "$.event_id", "string"), 2, 10).cast("bigint")
    root = str(tmp_path)
    want = stage(raw, APPOINTMENT_EVENTS)

    def feed(i):
        raw.where(n % 3 == i).write.parquet(f"{root}/in/chunk={i}")
        s = (spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1)
             .option("recursiveFileLookup", "true").parquet(root + "/in"))
        ingest.current_state(s, APPOINTMENT_EVENTS, root + "/log", root + "/chk").awaitTermination()

    feed(0)
    feed(1)
    ingest.compact_state(spark, root + "/log", APPOINTMENT_EVENTS, root, "state_base")
    feed(2)
    got = ingest.read_current_state(spark, root + "/log", APPOINTMENT_EVENTS, root, "state_base")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

"""A third of all rows on one key: results stay whole and exact, and the hot
key is reduced before it is shuffled."""

import pytest
from pyspark.sql import functions as F

from carelake.operators import aggregates as agg
from carelake.operators.marts import as_of, hot_keys
from carelake.operators.staging import stage
from carelake.registry import APPOINTMENT_EVENTS
from carelake.sinks import tables
from carelake.sources import fixtures as fx
from tests.conftest import SF_MID


def _hot_events(spark):
    ev = fx.fx_event(spark, SF_MID)
    n = F.substring("event_id", 2, 10).cast("bigint")
    return ev.withColumn("appointment_id", F.when(n % 3 == 0, F.lit("A99999")).otherwise(F.col("appointment_id")))


def test_hot_key_latest_is_exact(spark):
    ev = _hot_events(spark)
    a = stage(ev, APPOINTMENT_EVENTS)
    b = stage(ev, APPOINTMENT_EVENTS, method="max_by")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    keys = ev.where("appointment_id is not null and patient_id is not null").select("appointment_id").distinct().count()
    assert a.count() == keys
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_key_counts_are_whole(spark):
    ev = _hot_events(spark).withColumn("doctor_id", F.when(F.col("event_type") == "BOOKED", F.lit("D1"))
                                       .otherwise(F.col("doctor_id")))
    dim = fx.source_table(spark, SF_MID, "doctor").select("doctor_id", "specialty")
    got = agg.specialty_counts(ev, dim).agg(F.sum("cnt")).first()[0]
    want = ev.join(dim, "doctor_id").count()
    assert got == want


def test_as_of_of_many_versions_and_a_hot_key(spark):
    """Carry-forward equals the range join: 10,000 versions of one key, a third of the events on it, gaps, ties and NULLs."""
    ts = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    v = spark.range(10_000).select(F.lit("hot").alias("k"), ts(F.col("id") * 10).alias("dbt_valid_from"),
                                   F.when(F.col("id") < 9_999, ts(F.col("id") * 10 + 7)).alias("dbt_valid_to"), F.col("id").alias("name"))
    few = spark.range(300).select((F.col("id") % 100).cast("string").alias("k"), ts(F.floor(F.col("id") / 100) * 30_000).alias("dbt_valid_from"),
                                  F.when(F.col("id") < 200, ts((F.floor(F.col("id") / 100) + 1) * 30_000)).alias("dbt_valid_to"), F.col("id").alias("name"))
    null = spark.createDataFrame([(None, None, None, 7)], "k string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, name long")
    v = v.unionByName(few).unionByName(null)
    n = F.col("id")
    e = spark.range(3_000).select(n, F.when(n % 3 == 0, F.lit("hot")).when(n % 31 != 1, (n % 120).cast("string")).alias("k"),
                                  F.when(n % 13 != 5, ts((n * 41) % 110_000 - 300)).alias("t"))
    on = (F.col("e.k") == F.col("v.k")) & (F.col("t") >= F.col("dbt_valid_from")) & (F.col("dbt_valid_to").isNull() | (F.col("t") < F.col("dbt_valid_to")))
    want = sorted(map(str, e.alias("e").join(v.alias("v"), on, "left").select("id", "e.k", "t", F.col("name").alias("found")).collect()))
    for hot in (1_000_000, 100):                         # whole, and the hot key in ten parts
        got = as_of(e, v, "k", "t", {"name": "found"}, hot_keys(e, ["k"], hot))
        assert sorted(map(str, got.collect())) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dbt_valid_from" not in "".join(x for x in plan.split("\n") if "Join" in x)
    assert sum("found=None" not in x for x in want) > 500


def test_keyed_write_leaves_other_buckets_alone(spark, tmp_path):
    root = str(tmp_path)
    rows = lambda ids, v: spark.createDataFrame([(i, k, v) for i in ids for k in (0, 1)], "id int, k int, v string")
    first = tables.write_incremental(rows(range(200), "a"), root, "f", "keyed", key=["id"], buckets=16)
    assert len(first) == 16
    before = tables.bucket_paths(spark, root, "f")[1]
    again = tables.write_incremental(rows([3, 500], "b"), root, "f", "keyed", key=["id"], buckets=16)
    after = tables.bucket_paths(spark, root, "f")[1]
    assert len(again) <= 2 and {b for b in after if after[b] != before[b]} == set(again)
    written = {p.parent.name for p in tmp_path.glob("f/v=*/*/*.parquet") if str(p.parent) in after.values() and after[int(
        p.parent.name.split("=")[1])] != before.get(int(p.parent.name.split("=")[1]))}
    assert written == {f"_bucket={b}" for b in again}
    got = tables.read_incremental(spark, root, "f", "keyed")
    assert got.count() == 402 and got.where("v = 'b'").count() == 4 and got.where("id = 3").count() == 2
    empty = tables.write_incremental(rows([], "c"), root, "f", "keyed", key=["id"], buckets=16)
    assert empty == [] and tables.read_incremental(spark, root, "f", "keyed").count() == 402
    nulls = spark.createDataFrame([(None, 0, "n")], "id int, k int, v string")
    for _ in range(2):
        tables.write_incremental(nulls, root, "f", "keyed", key=["id"], buckets=16)
    assert tables.read_incremental(spark, root, "f", "keyed").where("id is null").count() == 1
    with pytest.raises(ValueError):
        tables.write_incremental(rows([1], "a"), root, "f", "keyed", key=["id"], buckets=8)


def test_storage_is_bounded_over_many_runs(spark, tmp_path):
    """Old states and open versions go; closed versions, the history and a rerun of the last run stay."""
    from carelake.plans import daily_job
    from carelake.functions.types import ts_lit
    root = str(tmp_path)
    log = spark.range(12).select(F.lit("H1").alias("hospital_id"), F.concat(F.lit("n"), F.col("id")).alias("hospital_name"), F.lit("c").alias("city"),
                                 F.lit("x").alias("country"), F.lit(5).alias("bed_capacity"), F.col("id").alias("created_at"),
                                 F.lit(None).cast("boolean").alias("_deleted"), F.col("id").alias("position"), F.col("id").cast("int").alias("b"))
    fx.fx_raw(log, keep=("_deleted", "position", "b")).write.partitionBy("b").parquet(root + "/raw/hospital")
    runs = [(b, ts_lit(f"2024-01-{b + 1:02d} 00:00:00")) for b in range(12)]
    sizes = []
    for r in runs:
        daily_job.snapshot_runs(spark, root, [r], entities=("hospital",))
        daily_job.expire_runs(spark, root)
        sizes.append(len(list(tmp_path.glob("state_hospital/v=*"))) + len(list(tmp_path.glob("snap_hospital/v=*/_open=true"))))
    assert max(sizes) <= 4 and sizes[-1] == 4
    hist = lambda: sorted((x.hospital_name, str(x.dbt_valid_to)) for x in daily_job.read_snapshot(spark, root, "hospital").collect())
    before = hist()
    assert len(before) == 12 and sum(t == "None" for _, t in before) == 1
    daily_job.snapshot_runs(spark, root, runs[-1:], entities=("hospital",))       # the last run again
    daily_job.expire_runs(spark, root)
    assert hist() == before
    assert len(list(tmp_path.glob("snap_hospital/v=*"))) == 13                    # the superseded one is the newest but one


def test_view_is_read_by_another_session(spark, tmp_path):
    from carelake.sinks.tables import catalog_view
    spark.range(5).write.parquet(str(tmp_path / "raw"))
    catalog_view(spark, "stg_five", str(tmp_path / "raw"), "select id * 2 as twice from {table} where id > 1")
    catalog_view(spark, "stg_five", str(tmp_path / "raw"), "select id * 3 as thrice from {table} where id > 1")
    assert sorted(r[0] for r in spark.newSession().sql("select thrice from stg_five").collect()) == [6, 9, 12]
    spark.sql("drop view stg_five")

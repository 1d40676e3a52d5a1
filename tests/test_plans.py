"""Plan shape at scale: the operators keep the physical plans we designed."""

from carelake.operators import aggregates as agg, scd2
from carelake.plans import catalog as C
from carelake.session import joins_by_measure
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staging_uses_partial_window_group_limit(spark):
    p = _plan(C.staged_events(spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_no_cartesian_or_nested_loop_anywhere(spark):
    for name in ("fact_all_versions", "fact_as_of", "dashboard_summary", "distinct_entities",
                 "specialty_share", "scd2_patient", "append_events"):
        p = _plan(C.REGISTRY[name][0](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_no_broadcast_before_run_time(spark):
    """Sides are broadcast only once adaptive execution has measured them."""
    for name in ("fact_all_versions", "fact_as_of", "specialty_counts", "dashboard_summary", "scd2_patient"):
        p = _plan(C.REGISTRY[name][0](spark, SF_SMALL))
        assert "BroadcastExchange" not in p and "BroadcastHashJoin" not in p, name


def test_as_of_carries_versions_forward(spark):
    """No join on the versions' times: one sort per key and dimension."""
    p = _plan(C.fact(joins_by_measure(spark), SF_SMALL, "as_of"))
    assert not any("Join" in x and "dbt_valid" in x for x in p.split("\n"))
    assert sum("Window [last(" in x for x in p.split("\n")) >= 3


def test_fold_plan_grows_by_one_merge_per_run(spark):
    """Plan nodes grow at most linearly with the number of runs."""
    raw = C.raw_of(spark, SF_SMALL, "hospital")
    sizes = []
    for n in range(1, 7):
        many = [(b, C.ts_lit(f"2024-01-{b + 1:02d} 00:00:00")) for b in range(n)]
        plan = scd2.fold(raw, C.ENTITIES["hospital"], many)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan.strip().split("\n")))
    steps = [b - a for a, b in zip(sizes, sizes[1:])]
    assert max(steps[1:]) <= steps[1] + 2, sizes


def test_counts_do_not_build_the_fact(spark):
    """Versions meet the events as counts per key: no version attribute is joined."""
    for name in ("appointments_on_day", "active_on_day_ci", "dashboard_summary"):
        df = C.REGISTRY[name][0](spark, SF_SMALL)
        opt = df._jdf.queryExecution().optimizedPlan().toString()
        for line in opt.split("\n"):
            assert not ("Join LeftOuter" in line and "patient_name" in line), name
    current = C.REGISTRY["specialty_counts_current"][0](spark, SF_SMALL)
    assert "LeftOuter" not in current._jdf.queryExecution().optimizedPlan().toString()


def test_top_k_cuts_events_before_the_joins(spark):
    opt = C.REGISTRY["recent_appointments"][0](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    below = opt[opt.rfind("Join LeftOuter"):]
    assert "scalar-subquery" in below


def test_specialty_counts_joins_aggregates_not_rows(spark):
    df = agg.specialty_counts(C.fact(spark, SF_SMALL), C.dim(spark, SF_SMALL, "doctor"))
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = opt.find("Join Inner")
    assert join_at > 0 and "Aggregate" in opt[join_at:]


def test_day_filter_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "fact")
    C.fact(spark, SF_SMALL).write.parquet(path)
    fact = spark.read.parquet(path)
    p = _plan(agg.count_on_day(fact, "2024-01-20"))
    assert "PushedFilters: [IsNotNull(appointment_time), GreaterThanOrEqual(appointment_time" in p


def test_scans_are_pruned(spark):
    p = _plan(C.REGISTRY["latest_per_order"][0](spark, SF_SMALL))
    assert p.count("ReadSchema") == 1 and "l_shipinstruct" not in p and "l_comment" not in p
    p = _plan(C.weighted_events(spark, SF_SMALL, "current").select("n_rows"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p


def test_single_partition_exchanges_only_after_partial_aggregation(spark):
    """Rows never funnel into one task: a SinglePartition exchange may only
    carry partial aggregates (one row per task) or per-partition counts."""
    skip = ("stream", "end_to_end", "lake_write", "view_and", "fact_append", "fact_idem", "incremental", "load_new",
            "corrupt", "schema_drift")
    for name, (fn, _sql) in C.REGISTRY.items():
        if name.startswith(skip):
            continue
        lines = _plan(fn(spark, SF_SMALL)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = lines[i + 1]
                bounded = "partial_" in below or "_pid" in below or "keys=[specialty" in below or "Project" in below
                assert bounded, (name, below)

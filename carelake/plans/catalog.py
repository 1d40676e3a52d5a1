"""Query catalogue: every operator of the survey as a runnable query.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
Results pass through ``report``: DECIMAL and DATE are reported as text, by
both engines, so that every digit is compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import display as dsp
from ..functions.types import UNIX_DATE_BASE, days_to_date, id_number, micros_to_ts, to_fee, ts_lit
from ..operators import aggregates as agg
from ..operators import cdc, dml, scd2
from ..operators.latest import latest_by_max_by, latest_by_rank, row_number_by_key
from ..operators.marts import build_dim, build_fact
from ..operators.staging import stage
from ..operators.topk import listing, rows_of_top, top_k
from ..registry import (APPOINTMENT_EVENTS, ENTITIES, EVENT_TYPES, EXPERIENCE_YEARS_RANGE, GENDERS,
                        MIN_BED_CAPACITY, MIN_FEE, PREFIX_ROUTING_ORDER, SPECIALTIES, WIRE_TYPES, wire_ddl)
from ..session import joins_by_measure, scratch_path
from ..sinks import lake as lakesink, tables as tablesink
from ..sources import files as lakefiles, fixtures as fx, loader
from ..sources.envelope import decode
from ..streaming import ingest
from .oracle_sql import IMAGES, with_

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

LOAD_TS = "2024-01-21 00:00:00"      # load time stamped by the staging queries
DAY = "2024-01-20"                   # "today" of the dashboard queries


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            joins_by_measure(spark)
            return report(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return run
    return deco


def report(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DecimalType, T.DateType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- building blocks

def runs():
    return [(b, fx.run_ts_of(b)) for b, _ in fx.RUNS]


def raw_of(spark, sf, entity):
    """Raw change rows as the lake holds them: typed Parquet columns.

    Staging reads these directly (column pruning, pushdown of the key
    filters); ``raw_variant_of`` is the same data as a VARIANT column ``v``,
    which ``stage`` reads by path with identical results (tested)."""
    return fx.fx_entity(spark, sf, entity)


def raw_variant_of(spark, sf, entity):
    return fx.fx_raw(fx.fx_entity(spark, sf, entity))


def staged_events(spark, sf):
    return stage(raw_of(spark, sf, "appointment_events"), APPOINTMENT_EVENTS)


def snapshot(spark, sf, entity, method: str = "replay"):
    raw = raw_of(spark, sf, entity)
    if method == "replay":
        return scd2.replay(raw, ENTITIES[entity])
    return scd2.fold(raw, ENTITIES[entity], runs())


def fact(spark, sf, mode="all"):
    return build_fact(staged_events(spark, sf), snapshot(spark, sf, "patient"),
                      snapshot(spark, sf, "doctor"), snapshot(spark, sf, "hospital"), mode)


def weighted_events(spark, sf, mode="all"):
    """Staged events with the number of fact rows each stands for."""
    snaps = {f"{e}_id": snapshot(spark, sf, e) for e in ("patient", "doctor", "hospital")}
    cols = ["appointment_time", "event_type", "patient_id", "doctor_id", "hospital_id"]
    return agg.fan_out(staged_events(spark, sf).select(*cols), snaps, mode)


def dim(spark, sf, entity):
    return build_dim(snapshot(spark, sf, entity), entity)


# ---------------------------------------------------------------- typing / scans

@query("raw_variant_extract", with_("fx_event") + """
select event_id, appointment_id, patient_id, doctor_id, hospital_id, event_type,
       appointment_time, event_timestamp, consultation_fee from fx_event""")
def q_raw_variant_extract(spark, sf):
    """SRC-11 / PRJ-01: rows as a raw variant column, fields read back by path."""
    raw = fx.fx_raw(fx.fx_event(spark, sf))
    return raw.select(*[F.try_variant_get("v", f"$.{n}", t).alias(n)
                        for n, t in WIRE_TYPES["appointment_events"]])


@query("typed_projection", with_("fx_event") + """
select event_id, cast(cast(consultation_fee as decimal(38,0)) as varchar) as consultation_fee,
       make_timestamp(appointment_time) as appointment_time,
       make_timestamp(event_timestamp) as event_timestamp,
       lower(event_type) as event_type,
       case when lower(event_type) = 'no_show' then 1 else 0 end as no_show_flag
from fx_event""")
def q_typed_projection(spark, sf):
    """PRJ-02/03/05/09."""
    e = fx.fx_event(spark, sf)
    return e.select("event_id", to_fee("consultation_fee").alias("consultation_fee"),
                    micros_to_ts("appointment_time").alias("appointment_time"),
                    micros_to_ts("event_timestamp").alias("event_timestamp"),
                    F.lower("event_type").alias("event_type"),
                    dsp.no_show_flag("event_type").alias("no_show_flag"))


@query("load_timestamp_projection", with_("fx_patient") + f"""
select patient_id, b, make_timestamp(created_at) as created_at,
       cast(cast(date '2000-01-01' + date_of_birth as date) as varchar) as date_of_birth,
       cast(cast(date '1970-01-01' + date_of_birth as date) as varchar) as date_of_birth_unix,
       timestamp '{LOAD_TS}' as load_timestamp
from fx_patient""")
def q_load_timestamp_projection(spark, sf):
    """PRJ-04 (both date bases) and PRJ-06 with a fixed run time."""
    p = fx.fx_patient(spark, sf)
    return p.select("patient_id", "b", micros_to_ts("created_at").alias("created_at"),
                    days_to_date("date_of_birth").alias("date_of_birth"),
                    days_to_date("date_of_birth", UNIX_DATE_BASE).alias("date_of_birth_unix"),
                    ts_lit(LOAD_TS).alias("load_timestamp"))


@query("required_keys_filter", with_("fx_event") + """
select event_id, appointment_id, patient_id from fx_event
where appointment_id is not null and patient_id is not null""")
def q_required_keys_filter(spark, sf):
    """FLT-01 on the cast keys of the raw variant."""
    raw = fx.fx_raw(fx.fx_event(spark, sf))
    w = raw.select(*[F.try_variant_get("v", f"$.{c}", "string").alias(c)
                     for c in ("event_id", "appointment_id", "patient_id")])
    return w.where(F.col("appointment_id").isNotNull() & F.col("patient_id").isNotNull())


_RN_SQL = with_("fx_event") + """
select event_id, appointment_id, patient_id, event_type, event_timestamp,
       cast(row_number() over (partition by appointment_id order by event_timestamp desc nulls first,
                               cast(substring(event_id, 2) as bigint) desc) as integer) as rn
from fx_event"""


@query("row_number_by_key", _RN_SQL)
def q_row_number_by_key(spark, sf):
    """WIN-01."""
    e = fx.fx_event(spark, sf).select("event_id", "appointment_id", "patient_id", "event_type",
                                      "event_timestamp")
    return row_number_by_key(e, "appointment_id", ["event_timestamp"], [id_number(F.col("event_id"))])


@query("latest_per_key", "select * exclude (rn) from (" + _RN_SQL + ") q where rn = 1")
def q_latest_per_key(spark, sf):
    """WIN-02 + FLT-04: row_number then rn = 1 (WindowGroupLimit)."""
    e = fx.fx_event(spark, sf).select("event_id", "appointment_id", "patient_id", "event_type",
                                      "event_timestamp")
    return latest_by_rank(e, "appointment_id", ["event_timestamp"], [id_number(F.col("event_id"))],
                          keep_rn=False)


@query("latest_per_key_max_by", "select * exclude (rn) from (" + _RN_SQL + ") q where rn = 1")
def q_latest_per_key_max_by(spark, sf):
    """WIN-02 as a max_by aggregate (partial aggregation; stream-capable)."""
    e = fx.fx_event(spark, sf).select("event_id", "appointment_id", "patient_id", "event_type",
                                      "event_timestamp")
    return latest_by_max_by(e, "appointment_id", ["event_timestamp"], [id_number(F.col("event_id"))])


_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_TB = [c for c in _LI_COLS if c not in ("l_orderkey", "l_shipdate")]


@query("latest_per_order", f"""
select {', '.join(_LI_COLS)} from (
  select *, row_number() over (partition by l_orderkey order by l_shipdate desc nulls first,
        {', '.join(c + ' desc nulls first' for c in _LI_TB)}) as rn
  from lineitem) q where rn = 1""")
def q_latest_per_order(spark, sf):
    """WIN-02 at scale: newest line per order over the whole lineitem table."""
    li = fx.table(spark, sf, "lineitem").select(*_LI_COLS)
    return latest_by_rank(li, "l_orderkey", ["l_shipdate"], _LI_TB, keep_rn=False)


# ---------------------------------------------------------------- staging

def _stg_sql(entity: str) -> str:
    cte = "stg_events" if entity == "appointment_events" else f"stg_{entity}"
    dob = ", cast(date_of_birth as varchar) as date_of_birth" if entity == "patient" else ""
    fee = ", cast(consultation_fee as varchar) as consultation_fee" if entity == "appointment_events" else ""
    excl = [c for c, on in (("date_of_birth", dob), ("consultation_fee", fee)) if on]
    star = f"* exclude ({', '.join(excl)})" if excl else "*"
    return with_(cte) + f"select {star}{dob}{fee} from {cte}"


@query("stg_events", _stg_sql("appointment_events"))
def q_stg_events(spark, sf):
    """STG-01."""
    return staged_events(spark, sf)


def _stg_entity(entity):
    def fn(spark, sf):
        return stage(raw_of(spark, sf, entity), ENTITIES[entity], ts_lit(LOAD_TS))
    fn.__doc__ = f"STG: staging view of {entity}."
    return fn


for _e in ("doctor", "hospital", "patient"):
    query(f"stg_{_e}", _stg_sql(_e))(_stg_entity(_e))


# ---------------------------------------------------------------- SCD2

def _snap_sql(entity: str, where: str = "", cols: str | None = None) -> str:
    dob = ", cast(date_of_birth as varchar) as date_of_birth" if entity == "patient" and cols is None else ""
    star = cols or ("* exclude (date_of_birth)" if dob else "*")
    return with_(f"{entity}_snapshot") + f"select {star}{dob} from {entity}_snapshot {where}"


def _hist_sql_upto(entity: str, last_run: int) -> str:
    """History as it stands after runs 0..last_run (valid_to past the run is still open)."""
    return with_(f"{entity}_snapshot") + f"""
select * exclude (date_of_birth, dbt_valid_to), cast(date_of_birth as varchar) as date_of_birth,
       case when dbt_valid_to <= (select run_ts from run where b = {last_run}) then dbt_valid_to end as dbt_valid_to
from {entity}_snapshot where dbt_valid_from <= (select run_ts from run where b = {last_run})"""


@query("scd2_first_run", _hist_sql_upto("patient", 0))
def q_scd2_first_run(spark, sf):
    """SCD-01 first run: every staged row opens a version."""
    st = stage(raw_of(spark, sf, "patient").where("b <= 0"), ENTITIES["patient"], fx.run_ts_of(0))
    return scd2.first_run(st, ENTITIES["patient"], fx.run_ts_of(0))


@query("scd2_merge", _hist_sql_upto("patient", 1))
def q_scd2_merge(spark, sf):
    """SCD-01 incremental merge: run 0 then run 1 against stored history."""
    return scd2.fold(raw_of(spark, sf, "patient"), ENTITIES["patient"], runs()[:2])


@query("scd2_replay", _snap_sql("patient"))
def q_scd2_replay(spark, sf):
    """SCD-05: all runs at once, set-based."""
    return snapshot(spark, sf, "patient", "replay")


for _e, _id in (("doctor", "SCD-02"), ("hospital", "SCD-03"), ("patient", "SCD-04")):
    def _mk(e=_e, i=_id):
        def fn(spark, sf):
            return snapshot(spark, sf, e, "fold")
        fn.__doc__ = f"{i}: {e} snapshot after three scheduled runs (merge per run)."
        return fn
    query(f"scd2_{_e}", _snap_sql(_e))(_mk())


@query("scd2_version_id", _snap_sql("hospital", cols="hospital_id, dbt_valid_from, dbt_scd_id"))
def q_scd2_version_id(spark, sf):
    """SCD-06: surrogate version id = md5(key | updated_at)."""
    return snapshot(spark, sf, "hospital").select("hospital_id", "dbt_valid_from", "dbt_scd_id")


for _e, _id in (("doctor", "DIM-01"), ("hospital", "DIM-02"), ("patient", "DIM-03")):
    def _mkd(e=_e, i=_id):
        def fn(spark, sf):
            return dim(spark, sf, e)
        fn.__doc__ = f"{i}: {e}_dim."
        return fn
    _dob = ", cast(date_of_birth as varchar) as date_of_birth" if _e == "patient" else ""
    _star = "* exclude (date_of_birth)" if _dob else "*"
    query(f"dim_{_e}", with_(f"{_e}_dim") + f"select {_star}{_dob} from {_e}_dim")(_mkd())


# ---------------------------------------------------------------- fact

def _fact_sql(mode: str) -> str:
    return with_(f"fact_{mode}") + f"""
select * exclude (consultation_fee, date_of_birth),
       cast(consultation_fee as varchar) as consultation_fee,
       cast(date_of_birth as varchar) as date_of_birth
from fact_{mode}"""


for _m, _n in (("all", "fact_all_versions"), ("current", "fact_current"), ("as_of", "fact_as_of")):
    def _mkf(m=_m):
        def fn(spark, sf):
            return fact(spark, sf, m)
        fn.__doc__ = f"FCT-01 / JON-01 / JON-03 with version mode {m!r}."
        return fn
    query(_n, _fact_sql(_m))(_mkf())


# ---------------------------------------------------------------- dashboard aggregates

_NEXT = "2024-01-21"


@query("appointments_on_day", with_("fact_all") + f"""
select count(*) as cnt from fact_all
where appointment_time >= timestamp '{DAY} 00:00:00' and appointment_time < timestamp '{_NEXT} 00:00:00'""")
def q_appointments_on_day(spark, sf):
    """AGG-01 / FLT-02."""
    return agg.count_on_day(weighted_events(spark, sf), DAY, weight="n_rows")


@query("active_on_day_exact", with_("fact_all") + f"""
select count(*) as cnt from fact_all where event_type = 'CONFIRMED'
  and appointment_time >= timestamp '{DAY} 00:00:00' and appointment_time < timestamp '{_NEXT} 00:00:00'""")
def q_active_on_day_exact(spark, sf):
    """AGG-02 / FLT-03: exact status literal against lower-cased staged values (parity: 0)."""
    return agg.count_on_day(weighted_events(spark, sf), DAY, "CONFIRMED", case_sensitive=True, weight="n_rows")


@query("active_on_day_ci", with_("fact_all") + f"""
select count(*) as cnt from fact_all where lower(event_type) = 'confirmed'
  and appointment_time >= timestamp '{DAY} 00:00:00' and appointment_time < timestamp '{_NEXT} 00:00:00'""")
def q_active_on_day_ci(spark, sf):
    """AGG-02 with a case-insensitive status match."""
    return agg.count_on_day(weighted_events(spark, sf), DAY, "CONFIRMED", case_sensitive=False, weight="n_rows")


@query("distinct_entities", with_("patient_dim", "doctor_dim", "hospital_dim") + """
select (select count(distinct patient_id) from patient_dim) as total_patients,
       (select count(distinct doctor_id) from doctor_dim) as total_doctors,
       (select count(distinct hospital_id) from hospital_dim) as total_hospitals""")
def q_distinct_entities(spark, sf):
    """AGG-03."""
    return agg.distinct_entities(dim(spark, sf, "patient"), dim(spark, sf, "doctor"),
                                 dim(spark, sf, "hospital"))


# rows of the fact per doctor, times the doctor's versions per specialty
_SPEC_SQL = """
select specialty, cast(sum(rows_of_fact * versions) as bigint) as cnt
from (select doctor_id as k, count(*) as rows_of_fact from {f} group by 1) x
join (select doctor_id as k, specialty, count(*) as versions from {d} group by 1, 2) y using (k)
group by specialty"""


@query("specialty_counts", with_("fact_all", "doctor_dim") + _SPEC_SQL.format(f="fact_all", d="doctor_dim"))
def q_specialty_counts(spark, sf):
    """AGG-04 / JON-02: fact (all versions) x doctor_dim (all versions)."""
    return agg.specialty_counts(weighted_events(spark, sf), dim(spark, sf, "doctor"), "n_rows")


@query("specialty_counts_current", with_("fact_current", "doctor_dim") + _SPEC_SQL.format(
    f="fact_current", d="(select * from doctor_dim where is_current)"))
def q_specialty_counts_current(spark, sf):
    """AGG-04 with current versions on both sides (no fan-out)."""
    return agg.specialty_counts(weighted_events(spark, sf, "current"),
                                dim(spark, sf, "doctor").where("is_current"), "n_rows")


@query("specialty_share", with_("fact_all", "doctor_dim") + "select *, round_even(cnt / greatest(max(cnt) over (), 1) * 100, 0) as share from ("
       + _SPEC_SQL.format(f="fact_all", d="doctor_dim") + ") s")
def q_specialty_share(spark, sf):
    """AGG-06: bar width relative to the largest specialty, half-even rounding."""
    return agg.with_share(agg.specialty_counts(weighted_events(spark, sf), dim(spark, sf, "doctor"), "n_rows"))


# ---------------------------------------------------------------- top-k and listings


def top_fact(spark, sf, k, descending=True):
    """The fact of the events that can be among the first ``k``: the joins see those only."""
    events = rows_of_top(staged_events(spark, sf), k, "appointment_time", descending)
    return build_fact(events, snapshot(spark, sf, "patient"), snapshot(spark, sf, "doctor"),
                      snapshot(spark, sf, "hospital"))


_RECENT_COLS = ["appointment_time", "doctor_name", "patient_id", "event_type"]


@query("recent_appointments", with_("fact_all") + """
select appointment_time, doctor_name, patient_id, event_type from fact_all
order by appointment_time desc nulls first, doctor_name asc nulls last, patient_id asc nulls last,
         event_type asc nulls last
limit 10""")
def q_recent_appointments(spark, sf):
    """SRT-01: ten newest appointments of the fact."""
    return top_k(top_fact(spark, sf, 10).select(*_RECENT_COLS), 10, "appointment_time", _RECENT_COLS[1:])


@query("oldest_appointments", with_("fact_all") + """
select appointment_time, doctor_name, patient_id, event_type from fact_all
order by appointment_time asc nulls last, doctor_name asc nulls last, patient_id asc nulls last,
         event_type asc nulls last
limit 5""")
def q_oldest_appointments(spark, sf):
    """SRT-02: five oldest (ascending, NULLs last)."""
    return top_k(top_fact(spark, sf, 5, descending=False).select(*_RECENT_COLS), 5, "appointment_time",
                 _RECENT_COLS[1:], descending=False)


@query("recent_events", with_("fx_event") + """
select event_id, appointment_id, patient_id, doctor_id, hospital_id, event_type,
       make_timestamp(appointment_time) as appointment_time,
       make_timestamp(event_timestamp) as event_timestamp, consultation_fee
from fx_event
order by event_timestamp desc nulls first, cast(substring(event_id, 2) as bigint) desc
limit 100""")
def q_recent_events(spark, sf):
    """SRT-03: 100 newest source events, nine columns."""
    e = fx.fx_event(spark, sf)
    e = e.select("event_id", "appointment_id", "patient_id", "doctor_id", "hospital_id", "event_type",
                 micros_to_ts("appointment_time").alias("appointment_time"),
                 micros_to_ts("event_timestamp").alias("event_timestamp"), "consultation_fee",
                 id_number(F.col("event_id")).alias("_n"))
    return e.orderBy(F.col("event_timestamp").desc_nulls_first(), F.col("_n").desc()).limit(100).drop("_n")


@query("entity_listing", with_("fx_hospital") + """
select hospital_id, hospital_name, city, country, bed_capacity from fx_hospital where b = 2
order by hospital_id""")
def q_entity_listing(spark, sf):
    """SRT-04 / SRC-13: hospital listing of the current source table."""
    return listing(fx.source_table(spark, sf, "hospital"),
                   ["hospital_id", "hospital_name", "city", "country", "bed_capacity"], "hospital_id")


@query("entity_lookup", with_("fx_patient") + """
select patient_id, patient_name from fx_patient where b = 2 order by patient_id""")
def q_entity_lookup(spark, sf):
    """SRT-05: (id, name) lookup list."""
    return listing(fx.source_table(spark, sf, "patient"), ["patient_id", "patient_name"], "patient_id")


@query("listing_count", with_("fx_patient", "fx_doctor", "fx_hospital") + """
select (select count(*) from fx_doctor where b = 2) as doctors,
       (select count(*) from fx_hospital where b = 2) as hospitals,
       (select count(*) from fx_patient where b = 2) as patients""")
def q_listing_count(spark, sf):
    """AGG-07: row count of each management listing."""
    d = fx.source_table(spark, sf, "doctor").agg(F.count(F.lit(1)).alias("doctors"))
    h = fx.source_table(spark, sf, "hospital").agg(F.count(F.lit(1)).alias("c"))
    p = fx.source_table(spark, sf, "patient").agg(F.count(F.lit(1)).alias("c"))
    return d.select("doctors", h.scalar().alias("hospitals"), p.scalar().alias("patients"))


# ---------------------------------------------------------------- display derivations

@query("status_class", with_("fx_event") + """
select event_id, event_type,
       case upper(event_type) when 'BOOKED' then 'booked' when 'CONFIRMED' then 'confirmed'
            when 'CANCELLED' then 'cancelled' else 'completed' end as status_class,
       case upper(lower(event_type)) when 'BOOKED' then 'booked' when 'CONFIRMED' then 'confirmed'
            when 'CANCELLED' then 'cancelled' else 'completed' end as staged_status_class
from fx_event""")
def q_status_class(spark, sf):
    """PRJ-10: badge class from the upper-cased status (source and staged spelling)."""
    e = fx.fx_event(spark, sf)
    return e.select("event_id", "event_type", dsp.status_class("event_type").alias("status_class"),
                    dsp.status_class(F.lower("event_type")).alias("staged_status_class"))


@query("gender_class", with_("fx_patient") + """
select patient_id, gender,
       case when gender = 'Male' then 'Male' when gender = 'Female' then 'Female' else 'Other' end as gender_class
from fx_patient where b = 2""")
def q_gender_class(spark, sf):
    """PRJ-11."""
    p = fx.source_table(spark, sf, "patient")
    return p.select("patient_id", "gender", dsp.gender_class("gender").alias("gender_class"))


@query("fee_text", with_("fx_event") + """
select event_id, '$' || printf('%.2f', consultation_fee) as fee_text from fx_event""")
def q_fee_text(spark, sf):
    """PRJ-12: ``$`` and two decimals of the source fee."""
    e = fx.fx_event(spark, sf)
    return e.select("event_id", dsp.fee_text("consultation_fee").alias("fee_text"))


@query("minute_text", with_("fx_event") + """
select event_id, strftime(make_timestamp(appointment_time), '%Y-%m-%dT%H:%M') as minute_text from fx_event""")
def q_minute_text(spark, sf):
    """PRJ-13: minute-resolution ISO text."""
    e = fx.fx_event(spark, sf)
    return e.select("event_id", dsp.minute_text(micros_to_ts("appointment_time")).alias("minute_text"))


@query("labels", with_("fx_doctor") + """
select doctor_id, doctor_id || ' — ' || doctor_name as doctor_label,
       cast(experience_years as varchar) || ' yrs' as experience_label
from fx_doctor where b = 2""")
def q_labels(spark, sf):
    """PRJ-14: ``id — name`` and ``N yrs`` labels."""
    d = fx.source_table(spark, sf, "doctor")
    return d.select("doctor_id", dsp.id_name_label("doctor_id", "doctor_name").alias("doctor_label"),
                    dsp.years_label("experience_years").alias("experience_label"))


# ---------------------------------------------------------------- dashboard composite

@query("dashboard_summary", with_("fact_all", "patient_dim", "doctor_dim", "hospital_dim") + f"""
select count(*) filter (where appointment_time >= timestamp '{DAY} 00:00:00'
                          and appointment_time < timestamp '{_NEXT} 00:00:00') as today_appointments,
       count(*) filter (where event_type = 'CONFIRMED' and appointment_time >= timestamp '{DAY} 00:00:00'
                          and appointment_time < timestamp '{_NEXT} 00:00:00') as active_appointments,
       (select count(distinct patient_id) from patient_dim) as total_patients,
       (select count(distinct doctor_id) from doctor_dim) as total_doctors,
       (select count(distinct hospital_id) from hospital_dim) as total_hospitals
from fact_all""")
def q_dashboard_summary(spark, sf):
    """DSH-01: the dashboard's five numbers in one row (one pass over the weighted events)."""
    from .dashboard import summary
    return summary(weighted_events(spark, sf), dim(spark, sf, "patient"), dim(spark, sf, "doctor"),
                   dim(spark, sf, "hospital"), DAY, weight="n_rows")


# ---------------------------------------------------------------- CDC



def classified(spark, sf):
    return cdc.classify(decode(fx.fx_envelope(spark, sf)))


_EV_COLS = "event_id, appointment_id, patient_id, doctor_id, hospital_id, event_type, " \
           "appointment_time, event_timestamp, consultation_fee"


@query("cdc_upserts", with_("fx_op") + f"""
select 'appointment_events' as table_name, {_EV_COLS}, position from fx_op
where fault <> 'null_payload' and topic = 'server.public.appointment_events'
  and op in ('c', 'u', 'r') and fault <> 'null_after'""")
def q_cdc_upserts(spark, sf):
    """SRC-01/03/05, CDC-01: upsert images of the appointment table."""
    return cdc.upserts(classified(spark, sf), "appointment_events").drop("image")


@query("cdc_deletes", with_("fx_op") + f"""
select 'appointment_events' as table_name, {_EV_COLS}, position, true as _deleted from fx_op
where fault <> 'null_payload' and topic = 'server.public.appointment_events' and op = 'd'""")
def q_cdc_deletes(spark, sf):
    """CDC-02: delete images flagged ``_deleted``."""
    return cdc.deletes(classified(spark, sf), "appointment_events").drop("image")


@query("cdc_rejects", with_("fx_op") + """
select position, topic, case when fault = 'null_payload' then null else op end as op,
       case when fault = 'null_payload' then 'no_payload'
            when topic <> 'server.public.appointment_events' then 'unknown_topic'
            else 'invalid_op' end as reason
from fx_op
where fault = 'null_payload' or topic <> 'server.public.appointment_events'
   or op not in ('c', 'u', 'r', 'd') or fault = 'null_after'""")
def q_cdc_rejects(spark, sf):
    """CDC-03: everything not accepted, with the first failing rule."""
    return cdc.rejects(classified(spark, sf))


@query("cdc_unified", with_("fx_op") + f"""
select 'appointment_events' as table_name, {_EV_COLS}, position,
       case when op = 'd' then true end as _deleted
from fx_op
where fault <> 'null_payload' and topic = 'server.public.appointment_events'
  and ((op in ('c', 'u', 'r') and fault <> 'null_after') or op = 'd')""")
def q_cdc_unified(spark, sf):
    """CDC-04: upserts and deletes in one frame with a nullable ``_deleted``."""
    return cdc.unified(classified(spark, sf), "appointment_events").drop("image")


def _unified_sql(entity: str) -> str:
    log = "fx_patient_log" if entity == "patient" else f"fx_{entity}"
    cols = ", ".join(n for n, _ in WIRE_TYPES[entity])
    more = "position, _deleted" if entity == "patient" else (
        f"cast(substring({entity}_id, 2) as bigint) * 10 + b * 2 as position, cast(null as boolean) as _deleted")
    return with_(log) + f"select '{entity}' as table_name, {cols}, {more} from {log}"


for _e in ("patient", "doctor", "hospital"):
    def _mku(e=_e):
        def fn(spark, sf):
            env = fx.fx_entity_envelope(spark, sf, e).drop("b")
            return cdc.unified(cdc.classify(decode(env)), e).drop("image")
        fn.__doc__ = f"SRC-02/05, CDC-04: change images of {e} (snapshot reads, updates, deletes)."
        return fn
    query(f"cdc_unified_{_e}", _unified_sql(_e))(_mku())


@query("schema_drift_roundtrip", with_("fx_patient_log") + """
select patient_id, position, 'n' || position as note, _deleted from fx_patient_log""")
def q_schema_drift_roundtrip(spark, sf):
    """SRC-11, CDC-04: a source field unknown to the registry goes through the lake into the raw VARIANT."""
    root = scratch_path(spark, "drift")
    env = fx.fx_entity_envelope(spark, sf, "patient").drop("b")
    lakesink.write_lake(cdc.unified(cdc.classify(decode(env)), "patient").drop("table_name"), root, "patient", LAKE_DATE)
    raw = lakesink.read_lake_table(spark, root, "patient").select(F.parse_json("image").alias("v"), "position", "_deleted")
    return raw.select(F.try_variant_get("v", "$.patient_id", "string").alias("patient_id"), "position",
                      F.try_variant_get("v", "$.note", "string").alias("note"), "_deleted")


@query("cdc_op_counts", with_("fx_op") + """
select 'appointment_events' as table_name, op, count(*) as cnt from fx_op
where fault <> 'null_payload' and topic = 'server.public.appointment_events'
  and ((op in ('c', 'u', 'r') and fault <> 'null_after') or op = 'd')
group by op""")
def q_cdc_op_counts(spark, sf):
    """CDC-05: accepted records per table and op."""
    return cdc.op_counts(classified(spark, sf))


# ---------------------------------------------------------------- keyed batch writes (DML)


_P_WIRE = "patient_id, patient_name, gender, date_of_birth, city, created_at"


def _wire(spark, sf, entity, b):
    cols = [n for n, _ in WIRE_TYPES[entity]]
    return fx.fx_entity(spark, sf, entity).where(F.col("b") == b).select(*cols)


@query("insert_if_absent", with_("fx_patient") + f"""
select {_P_WIRE} from fx_patient where b = 0
union all
select {_P_WIRE} from fx_patient where b = 1
  and patient_id not in (select patient_id from fx_patient where b = 0)""")
def q_insert_if_absent(spark, sf):
    """DML-01: run-1 extract inserted into the run-0 table; existing rows win."""
    return dml.insert_if_absent(_wire(spark, sf, "patient", 0), _wire(spark, sf, "patient", 1),
                                "patient_id", order=["created_at"])


@query("update_by_key", with_("fx_hospital") + """
select t.hospital_id,
       case when u.hospital_id is not null then u.hospital_name else t.hospital_name end as hospital_name,
       case when u.hospital_id is not null then u.city else t.city end as city,
       case when u.hospital_id is not null then u.country else t.country end as country,
       case when u.hospital_id is not null then u.bed_capacity else t.bed_capacity end as bed_capacity,
       t.created_at
from (select * from fx_hospital where b = 0) t
left join (select * from fx_hospital where b = 2) u on t.hospital_id = u.hospital_id""")
def q_update_by_key(spark, sf):
    """DML-02: listed columns updated by key; created_at untouched."""
    return dml.update_by_key(_wire(spark, sf, "hospital", 0), _wire(spark, sf, "hospital", 2),
                             "hospital_id", ["hospital_name", "city", "country", "bed_capacity"], order=["created_at"])


@query("delete_by_key", with_("fx_op") + f"""
select {_EV_COLS} from fx_event
where event_id not in (select event_id from fx_op where op = 'd')""")
def q_delete_by_key(spark, sf):
    """DML-03: events deleted by the keys of the change stream's delete ops."""
    ops = fx.fx_op(spark, sf)
    return dml.delete_by_key(fx.fx_event(spark, sf), ops.where(F.col("op") == "d"), "event_id")


_REQ_SQL = """req as (
select * from (select *, row_number() over (partition by appointment_id
                 order by event_timestamp desc nulls first, cast(substring(event_id, 2) as bigint) desc) as rk
               from fx_event where appointment_id is not null and patient_id is not null) z
where rk = 1 and event_type = 'BOOKED'),
mx as (select max(cast(substring(event_id, 2) as bigint)) as m from fx_event)"""
FOLLOW_UP_TS = "2024-01-21 00:00:00"


def _follow_up_requests(spark, sf):
    e = fx.fx_event(spark, sf).where(F.col("appointment_id").isNotNull() & F.col("patient_id").isNotNull())
    last = latest_by_rank(e, "appointment_id", ["event_timestamp"], [id_number(F.col("event_id"))],
                          keep_rn=False)
    return last.where(F.col("event_type") == "BOOKED")


@query("allocate_ids", with_("fx_event", extra=_REQ_SQL) + """
select appointment_id, printf('E%06d', (select m from mx) + row_number() over (order by appointment_id)) as event_id
from req""")
def q_allocate_ids(spark, sf):
    """DML-05 / AGG-05: next event ids for a confirmation of every booked appointment."""
    req = _follow_up_requests(spark, sf).select("appointment_id")
    return dml.allocate_ids(req, fx.fx_event(spark, sf), "event_id", ["appointment_id"], "E", 6)


@query("append_events", with_("fx_event", extra=_REQ_SQL) + f"""
select {_EV_COLS} from fx_event
union all
select printf('E%06d', (select m from mx) + row_number() over (order by appointment_id)) as event_id,
       appointment_id, patient_id, doctor_id, hospital_id, 'CONFIRMED' as event_type, appointment_time,
       epoch_us(timestamp '{FOLLOW_UP_TS}') as event_timestamp, consultation_fee
from req""")
def q_append_events(spark, sf):
    """DML-04: confirmation events appended with the write time as event_timestamp."""
    from ..functions.types import ts_to_micros
    ev = fx.fx_event(spark, sf)
    req = _follow_up_requests(spark, sf).drop("event_id")
    rows = dml.allocate_ids(req, ev, "event_id", ["appointment_id"], "E", 6)
    rows = rows.withColumn("event_type", F.lit("CONFIRMED"))
    return dml.append_rows(ev, rows, "event_timestamp", ts_to_micros(ts_lit(FOLLOW_UP_TS)))


@query("normalize_keys", with_("fx_event") + """
select event_id, raw_key, upper(trim(raw_key, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8195))) as doctor_id from (
  select event_id, case when cast(substring(event_id, 2) as bigint) % 2 = 0
                        then chr(9) || ' ' || lower(doctor_id) || chr(8195) || chr(160) || chr(10) else doctor_id end as raw_key
  from fx_event) z""")
def q_normalize_keys(spark, sf):
    """DML-06: keys typed in forms are trimmed and upper-cased."""
    e = fx.fx_event(spark, sf)
    raw = F.when(id_number(F.col("event_id")) % 2 == 0,
                 F.concat(F.lit("\t "), F.lower("doctor_id"), F.lit("\u2003\xa0\n"))).otherwise(F.col("doctor_id"))
    return e.select("event_id", raw.alias("raw_key")).withColumn("doctor_id", dml.normalize_key("raw_key"))


@query("parse_numbers", with_("fx_event") + """
select event_id, try_cast(fee_text as double) as consultation_fee,
       try_cast(fee_text as double) is not null as parse_ok from (
  select event_id, case when cast(substring(event_id, 2) as bigint) % 13 = 0 then 'n/a'
                        when cast(substring(event_id, 2) as bigint) % 17 = 0 then ''
                        else cast(consultation_fee as varchar) end as fee_text
  from fx_event) z""")
def q_parse_numbers(spark, sf):
    """DML-07: text -> number; unparsable text is flagged (quarantine), not fatal."""
    e = fx.fx_event(spark, sf)
    n = id_number(F.col("event_id"))
    txt = F.when(n % 13 == 0, F.lit("n/a")).when(n % 17 == 0, F.lit("")).otherwise(
        F.col("consultation_fee").cast("string"))
    parsed = dml.parse_number(txt)
    return e.select("event_id", parsed.alias("consultation_fee"), parsed.isNotNull().alias("parse_ok"))


@query("parse_integers", with_("fx_hospital", "fx_doctor") + """
select id, try_cast(trim(txt, ' ' || chr(9)) as integer) as n, try_cast(trim(txt, ' ' || chr(9)) as integer) is not null as parse_ok
from (select hospital_id as id, case when bed_capacity % 100 = 90 then 'many' else chr(9) || bed_capacity || ' ' end as txt
      from fx_hospital where b = 2
      union all
      select doctor_id, case when experience_years % 7 = 3 then '' when experience_years % 7 = 4 then experience_years || ' yrs'
                             else cast(experience_years as varchar) end
      from fx_doctor where b = 2) z""")
def q_parse_integers(spark, sf):
    """DML-07: the forms' integer fields (beds, years)."""
    h, d = fx.source_table(spark, sf, "hospital"), fx.source_table(spark, sf, "doctor")
    beds, years = F.col("bed_capacity"), F.col("experience_years")
    rows = h.select(F.col("hospital_id").alias("id"), F.when(beds % 100 == 90, F.lit("many")).otherwise(
        F.concat(F.lit("\t"), beds.cast("string"), F.lit(" "))).alias("txt"))
    rows = rows.unionByName(d.select(F.col("doctor_id").alias("id"), F.when(years % 7 == 3, F.lit("")).when(
        years % 7 == 4, F.concat(years.cast("string"), F.lit(" yrs"))).otherwise(years.cast("string")).alias("txt")))
    n = dml.parse_number("txt", "int")
    return rows.select("id", n.alias("n"), n.isNotNull().alias("parse_ok"))


def _in(vals):
    return "(" + ", ".join(f"'{v}'" for v in vals) + ")"


#: Required form fields per table.
REQUIRED = {
    "appointment_events": ("appointment_id", "patient_id", "doctor_id", "hospital_id", "event_type", "appointment_time"),
    "doctor": ("doctor_id", "doctor_name", "hospital_id", "specialty"),
    "hospital": ("hospital_id", "hospital_name", "city", "country"),
    "patient": ("patient_id", "patient_name", "gender", "date_of_birth", "city"),
}
#: Domains: (table, column, rule, condition in SQL that both engines read alike).
DOMAINS = (
    ("appointment_events", "event_type", "domain", f"event_type in {_in(EVENT_TYPES)}"),
    ("appointment_events", "consultation_fee", "min", f"consultation_fee >= {MIN_FEE}"),
    ("doctor", "specialty", "domain", f"specialty in {_in(SPECIALTIES)}"),
    ("doctor", "experience_years", "range",
     f"experience_years between {EXPERIENCE_YEARS_RANGE[0]} and {EXPERIENCE_YEARS_RANGE[1]}"),
    ("hospital", "bed_capacity", "min", f"bed_capacity >= {MIN_BED_CAPACITY}"),
    ("patient", "gender", "domain", f"gender in {_in(GENDERS)}"),
)


def _form_rules(table: str) -> dict[str, str]:
    """Rule name -> SQL condition of one table (a blank text is missing, too)."""
    rules = {f"{table}.{c}.required": f"trim(cast({c} as string)) <> ''" for c in REQUIRED[table]}
    return rules | {f"{t}.{c}.{kind}": cond for t, c, kind, cond in DOMAINS if t == table}


_VIOL_SQL = with_("fx_event", "fx_doctor", "fx_hospital", "fx_patient") + (
    "select rule, violations from (" + " union all ".join(
        f"select '{rule}' as rule, count(*) filter (where not coalesce({cond}, false)) as violations from "
        + ("fx_event" if t == "appointment_events" else f"fx_{t} where b = 2")
        for t in REQUIRED for rule, cond in _form_rules(t).items()) + ") z where violations > 0")


@query("domain_violations", _VIOL_SQL)
def q_domain_violations(spark, sf):
    """DML-08: all form rules checked over the source tables; broken rules counted."""
    from functools import reduce
    parts = [dml.domain_violations(fx.source_table(spark, sf, t), {r: F.expr(c) for r, c in _form_rules(t).items()})
             for t in REQUIRED]
    return reduce(lambda x, y: x.unionByName(y), parts)


# ---------------------------------------------------------------- file routing


ROUTE_NAMES = PREFIX_ROUTING_ORDER + ("misc",)
_NAMES_SQL = "[" + ", ".join(f"'{t}'" for t in ROUTE_NAMES) + "]"
_KEYS_SQL = f"""keys as (
select event_id as n,
       'raw/' || {_NAMES_SQL}[event_id % 5 + 1] || '/date=' || strftime(ts, '%Y-%m-%d') || '/'
       || {_NAMES_SQL}[(event_id // 5) % 5 + 1] || '_' || strftime(ts, '%H%M%S%f')
       || case when event_id % 10 = 7 then '.json' else '.parquet' end as key
from events)"""


def object_keys(spark, sf):
    """Object-store keys, one per event, shaped like the consumer's file layout."""
    e = fx.table(spark, sf, "events")
    names = F.array(*[F.lit(t) for t in ROUTE_NAMES])
    n = F.col("event_id")
    key = F.concat(F.lit("raw/"), F.element_at(names, (n % 5 + 1).cast("int")), F.lit("/date="),
                   F.date_format("ts", "yyyy-MM-dd"), F.lit("/"),
                   F.element_at(names, ((n / 5).cast("bigint") % 5 + 1).cast("int")), F.lit("_"),
                   F.date_format("ts", "HHmmssSSSSSS"),
                   F.when(n % 10 == 7, F.lit(".json")).otherwise(F.lit(".parquet")))
    return e.select(n.alias("n"), key.alias("key"))


@query("route_by_prefix", f"with {_KEYS_SQL}\n" + f"""
select n, key, case when split_part(key, '/', 4) like 'patient%' then 'patient'
                    when split_part(key, '/', 4) like 'doctor%' then 'doctor'
                    when split_part(key, '/', 4) like 'hospital%' then 'hospital'
                    when split_part(key, '/', 4) like 'appointment_events%' then 'appointment_events' end as table_name
from keys
where key like '%.parquet' and (split_part(key, '/', 4) like 'patient%' or split_part(key, '/', 4) like 'doctor%'
   or split_part(key, '/', 4) like 'hospital%' or split_part(key, '/', 4) like 'appointment_events%')""")
def q_route_by_prefix(spark, sf):
    """SRC-09: file -> table by file-name prefix, first match in the fixed order."""
    return lakefiles.route_by_prefix(object_keys(spark, sf))


@query("route_by_folder", f"with {_KEYS_SQL}\n" + """
select n, key, split_part(key, '/', 2) as table_name from keys
where key like '%.parquet' and split_part(key, '/', 2) in ('patient', 'doctor', 'hospital', 'appointment_events')""")
def q_route_by_folder(spark, sf):
    """SRC-10: file -> table by the folder segment, exact match."""
    return lakefiles.route_by_folder(object_keys(spark, sf))


# ---------------------------------------------------------------- sinks, streaming, pipeline


LAKE_DATE = "2024-01-21"
_EV_LIST = _EV_COLS.split(", ")

_UNIFIED_ROWS = """
from fx_op
where fault <> 'null_payload' and topic = 'server.public.appointment_events'
  and ((op in ('c', 'u', 'r') and fault <> 'null_after') or op = 'd')"""


def _text_of(rows, table):
    """All fields of a wire row but the fee (a double) in one text, as the SQL side writes them."""
    names = [n for n, _ in WIRE_TYPES[table] if n != "consultation_fee"]
    fee = [F.round(F.col("consultation_fee") * 100).cast("bigint").alias("fee_cents")] if table == "appointment_events" else [
        F.lit(None).cast("bigint").alias("fee_cents")]
    text = F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("-")) for n in names])
    return rows.select(F.lit(table).alias("table_name"), text.alias("fields"), *fee, "position", "_deleted")


def _each_table(of_table):
    """``of_table(name)`` of the four captured tables, as one frame of texts."""
    from functools import reduce
    return reduce(lambda x, y: x.unionByName(y), [_text_of(of_table(t), t) for t in ENTITIES])


def _change_rows_sql() -> str:
    parts = []
    for t in ENTITIES:
        names = [n for n, _ in WIRE_TYPES[t] if n != "consultation_fee"]
        text = "concat_ws('|', " + ", ".join(f"coalesce(cast({n} as varchar), '-')" for n in names) + ")"
        number = f"cast(substring({t}_id, 2) as bigint)"
        run, pos, gone, src = {
            "appointment_events": ("position % 3", "position", "case when op = 'd' then true end", f"fx_op where {IMAGES}"),
            "patient": ("b", "position", "_deleted", "fx_patient_log")}.get(
                t, ("b", f"({number} * 10 + b * 2)", "cast(null as boolean)", f"fx_{t}"))
        fee = "cast(round(consultation_fee * 100) as bigint)" if t == "appointment_events" else "cast(null as bigint)"
        parts.append(f"select '{t}' as table_name, {text} as fields, {fee} as fee_cents, "
                     f"cast({run} as bigint) * {1 << 44} + {pos} as position, {gone} as _deleted from {src}")
    return with_("fx_op", "fx_patient_log", "fx_doctor", "fx_hospital") + " union all ".join(parts)


_CHANGE_ROWS = _change_rows_sql()


def _all_changes(spark, sf):
    from functools import reduce
    return reduce(lambda x, y: x.unionByName(y), [fx.fx_changes(spark, sf, b) for b, _ in fx.RUNS])


@query("lake_write_roundtrip", f"select *, '{LAKE_DATE}' as date from ({_CHANGE_ROWS}) z")
def q_lake_write_roundtrip(spark, sf):
    """SNK-01/04: accepted images of the four tables -> date-partitioned Parquet -> read back with a fixed schema."""
    root = scratch_path(spark, "lake")
    sorted_out = cdc.classify(decode(_all_changes(spark, sf)))
    for t in ENTITIES:
        lakesink.write_lake(cdc.unified(sorted_out, t).drop("table_name"), root, t, LAKE_DATE)
    return _each_table(lambda t: lakesink.read_lake_table(spark, root, t).where(F.col("date") == F.lit(LAKE_DATE).cast("date"))).withColumn(
        "date", F.lit(LAKE_DATE))


@query("view_and_table", with_("hospital_dim", "stg_hospital") + """
select d.*, v.load_timestamp as staged_at, v.hospital_name as staged_name
from hospital_dim d left join stg_hospital v on d.hospital_id = v.hospital_id and d.is_current""")
def q_view_and_table(spark, sf):
    """SNK-05/06: staging as a view, the dimension as a versioned full-refresh table."""
    root = scratch_path(spark, "tables")
    tablesink.as_view(stage(raw_of(spark, sf, "hospital"), ENTITIES["hospital"], ts_lit(LOAD_TS)),
                      "stg_hospital_view")
    tablesink.write_version(dim(spark, sf, "hospital"), root, "hospital_dim")
    tablesink.write_version(dim(spark, sf, "hospital"), root, "hospital_dim")   # refresh = new version
    view = spark.table("stg_hospital_view").select(F.col("hospital_id").alias("_h"), F.col("load_timestamp").alias("staged_at"),
                                                   F.col("hospital_name").alias("staged_name"))
    dims = tablesink.read_current(spark, root, "hospital_dim")
    return dims.join(view, (F.col("hospital_id") == F.col("_h")) & F.col("is_current"), "left").drop("_h")


@query("stored_staging_view", _stg_sql("patient"))
def q_stored_staging_view(spark, sf):
    """SNK-05: staging as a view of the catalog over the stored raw table, read by another session."""
    from ..operators.staging import view_sql
    root, name = scratch_path(spark, "views"), f"stg_patient_{uuid.uuid4().hex[:8]}"
    raw = fx.fx_raw(fx.fx_patient(spark, sf).drop("run_ts"), keep=("b",))
    raw.withColumn("position", F.lit(None).cast("bigint")).write.parquet(root + "/raw/patient")
    tablesink.catalog_view(spark, name, root + "/raw/patient", view_sql(ENTITIES["patient"], LOAD_TS))
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    other.table(name).write.parquet(root + "/seen")               # what the other session reads
    spark.sql(f"drop view {name}")
    return spark.read.parquet(root + "/seen")


def _fact_report_sql(body: str) -> str:
    return with_("fact_all") + f"""
select * exclude (consultation_fee, date_of_birth), cast(consultation_fee as varchar) as consultation_fee,
       cast(date_of_birth as varchar) as date_of_birth from ({body}) z"""


@query("fact_append_twice", _fact_report_sql("select * from fact_all union all select * from fact_all"))
def q_fact_append_twice(spark, sf):
    """SNK-07 parity: the incremental fact has no filter, a rerun appends everything again."""
    root = scratch_path(spark, "fact")
    for _ in range(2):
        tablesink.write_incremental(fact(spark, sf), root, "fact", "append")
    return tablesink.read_incremental(spark, root, "fact", "append")


@query("fact_idempotent", _fact_report_sql("select * from fact_all"))
def q_fact_idempotent(spark, sf):
    """SNK-07 keyed: delete + insert by appointment, so a rerun changes nothing."""
    root = scratch_path(spark, "fact")
    for _ in range(2):
        tablesink.write_incremental(fact(spark, sf), root, "fact", "keyed", key=["appointment_id"])
    return tablesink.read_incremental(spark, root, "fact", "keyed")


CUTOFF = "2024-01-15 00:00:00"


def _early(ev):
    from ..functions.types import ts_to_micros
    return F.coalesce(F.col("event_timestamp") < ts_to_micros(ts_lit(CUTOFF)), F.lit(False))


def _fields(rows, table):
    """The wire columns of a raw table's variant rows."""
    return rows.select(*[F.try_variant_get("v", f"$.{n}", t).alias(n) for n, t in WIRE_TYPES[table]])


@query("incremental_files", with_("fx_event") + f"""
select {_EV_COLS} from fx_event
where not coalesce(event_timestamp < epoch_us(timestamp '{CUTOFF}'), false)""")
def q_incremental_files(spark, sf):
    """SRC-06/08: recursive *.parquet scan, files loaded before are left out, only new files opened."""
    root = scratch_path(spark, "incoming")
    ev, ddl = fx.fx_event(spark, sf), ("appointment_events",)
    lakesink.write_lake(ev.where(_early(ev)), root + "/lake", "appointment_events", "2024-01-14")
    loader.load_new_files(spark, root + "/lake", root + "/raw", root + "/state", tables=ddl)
    before = loader.read_raw(spark, root + "/raw", "appointment_events").agg(F.max("load_id")).scalar()
    lakesink.write_lake(ev.where(~_early(ev)), root + "/lake", "appointment_events", "2024-01-15")
    spark.createDataFrame([("not a parquet file",)], "value string").write.text(
        root + "/lake/appointment_events/date=2024-01-15/notes")
    loader.load_new_files(spark, root + "/lake", root + "/raw", root + "/state", tables=ddl)
    raw = loader.read_raw(spark, root + "/raw", "appointment_events")
    return _fields(raw.where(F.col("load_id") > before), "appointment_events")


def _loaded(spark, raw, key_of):
    """Per table: arrival folders, rows, largest key.

    The largest key is a text: counted beside distinct folders it would have each task sort all its rows by folder."""
    from functools import reduce
    parts = []
    for name, key in key_of:
        t = loader.read_raw(spark, raw, name)
        folders = t.select(F.regexp_extract("_file", "date=([0-9-]+)", 1).alias("folder")).distinct()
        n = folders.agg(F.count("folder").cast("int")).scalar()
        parts.append(t.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.try_variant_get("v", f"$.{key}", "string")).alias("last_key"))
                     .select(F.lit(name).alias("table_name"), n.alias("arrivals"), "n_rows", "last_key"))
    return reduce(lambda x, y: x.unionByName(y), parts)


_KEYS = (("appointment_events", "event_id"), ("doctor", "doctor_id"), ("hospital", "hospital_id"), ("patient", "patient_id"))
_LOADED_SQL = with_("fx_event", "fx_patient", "fx_doctor", "fx_hospital") + """
select 'appointment_events' as table_name, 2 as arrivals, count(*) as n_rows, max(event_id) as last_key from fx_event
union all select 'doctor', 1, count(*), max(doctor_id) from fx_doctor
union all select 'hospital', 1, count(*), max(hospital_id) from fx_hospital
union all select 'patient', 1, count(*), max(patient_id) from fx_patient"""


def _entity_rows(spark, sf, name):
    return fx.fx_entity(spark, sf, name).select(*[n for n, _ in WIRE_TYPES[name]])


@query("load_new_files", _LOADED_SQL)
def q_load_new_files(spark, sf):
    """SRC-08/10, STR-02: all tables' new files, in micro-batches of two files, three times, with a file no table takes."""
    root = scratch_path(spark, "landing")
    base, state, raw = root + "/lake", root + "/state", root + "/raw"
    ev = fx.fx_event(spark, sf)
    load = lambda: loader.load_new_files(spark, base, raw, state, max_files=2)
    for name in ("patient", "doctor", "hospital"):
        _entity_rows(spark, sf, name).write.parquet(f"{base}/{name}/date=2024-01-14")
    ev.where(_early(ev)).write.parquet(f"{base}/appointment_events/date=2024-01-14")
    ev.limit(1).write.parquet(f"{base}/unknown_table/date=2024-01-14")
    load()
    ev.where(~_early(ev)).write.parquet(f"{base}/appointment_events/date=2024-01-15")
    load()
    load()                                              # nothing new: no third copy
    return _loaded(spark, raw, _KEYS)


@query("load_by_prefix", _LOADED_SQL)
def q_load_by_prefix(spark, sf):
    """SRC-09: files go to the table their name starts with, whatever folder they lie in; others are left."""
    root = scratch_path(spark, "mixed")
    base, state, raw = root + "/lake", root + "/state", root + "/raw"
    ev = fx.fx_event(spark, sf)

    def put(rows, name, folder):
        rows.write.option("mapreduce.output.basename", f"{name}_000000000001").mode("append").parquet(f"{base}/{folder}")
    for name in ("patient", "doctor", "hospital"):
        put(_entity_rows(spark, sf, name), name, "doctor/date=2024-01-14")
    put(ev.where(_early(ev)), "appointment_events", "doctor/date=2024-01-14")
    put(ev.limit(1), "misc_patient", "patient/date=2024-01-14")
    loader.load_new_files(spark, base, raw, state, by="prefix")
    put(ev.where(~_early(ev)), "appointment_events", "patient/date=2024-01-15")
    loader.load_new_files(spark, base, raw, state, by="prefix")
    return _loaded(spark, raw, _KEYS)


@query("load_drifting_files", with_("fx_event") + """
, n as (select *, cast(substring(event_id, 2) as bigint) as n from fx_event)
select event_id, appointment_id, patient_id, doctor_id, hospital_id, event_type, appointment_time, event_timestamp, consultation_fee,
       case when n % 3 = 1 and n % 20 = 0 then true end as _deleted, case when n % 3 <> 0 then 'n' || n end as note
from n""")
def q_load_drifting_files(spark, sf):
    """SRC-11/12, SNK-04: arrivals with other columns and other types: nothing is cut, cast or called corrupt."""
    root = scratch_path(spark, "drift")
    n = id_number(F.col("event_id"))
    ev = fx.fx_event(spark, sf).withColumn("n", n)
    note = F.concat(F.lit("n"), F.col("n")).alias("note")
    wide = [F.col("appointment_time").cast("decimal(30,0)").alias("appointment_time"), F.col("event_timestamp").cast("string").alias("event_timestamp")]
    rest = [c for c in _EV_LIST if c not in ("appointment_time", "event_timestamp")]
    arrivals = (ev.where("n % 3 = 0").select(*_EV_LIST),
                ev.where("n % 3 = 1").select(*_EV_LIST, note, F.when(F.col("n") % 20 == 0, F.lit(True)).alias("_deleted")),
                ev.where("n % 3 = 2").select(note, *wide, *rest))
    for i, rows in enumerate(arrivals):                 # one folder, so one micro-batch sees all of them
        rows.write.parquet(f"{root}/lake/appointment_events/date=2024-01-1{i}")
    loader.load_new_files(spark, root + "/lake", root + "/raw", root + "/state", tables=("appointment_events",))
    raw = loader.read_raw(spark, root + "/raw", "appointment_events")
    return raw.select(*[F.try_variant_get("v", f"$.{c}", t).alias(c)
                        for c, t in (*WIRE_TYPES["appointment_events"], ("_deleted", "boolean"), ("note", "string"))])


@query("wait_then_load", with_("fx_hospital") + """
select 'hospital' as table_name, true as came, count(*) as n_rows from fx_hospital
union all select 'patient', false, 0""")
def q_wait_then_load(spark, sf):
    """STR-03: a bounded wait for a table's file, then its load; a file that does not come is given up at the limit."""
    import threading
    root = scratch_path(spark, "waiting")
    base = root + "/lake"
    rows = _entity_rows(spark, sf, "hospital")
    late = threading.Timer(0.5, lambda: rows.write.parquet(f"{base}/hospital/date=2024-01-14"))
    late.start()
    out = []
    for t, limit in (("hospital", 600.0), ("patient", 0.2)):
        of_table = lambda files, t=t: files.where(F.col("path").contains(f"/{t}/"))
        came = ingest.wait_for_file(spark, base, of_table, limit, poke_s=0.2)
        if came:
            late.join()
            loader.load_new_files(spark, base, root + "/raw", root + "/state", tables=(t,))
        n = loader.read_raw(spark, root + "/raw", t).agg(F.count(F.lit(1)).alias("n_rows"))
        out.append(n.select(F.lit(t).alias("table_name"), F.lit(came).alias("came"), "n_rows"))
    return out[0].unionByName(out[1])


def _put(spark, path: str, data: bytes) -> None:
    """One small file, written through the cluster's file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(data))
    out.close()


#: Rows of a sound file of ``corrupt_file_quarantine``, and how many such files there are at least.
FILE_ROWS, MIN_FILES = 1 << 20, 3


@query("corrupt_file_quarantine", with_("fx_event") + f"""
, n as (select coalesce(try_cast(substring(event_id, 2) as bigint), 0) as n from fx_event)
select 'corrupt' as status, 2 as files, 2 as bad_files, cast(0 as bigint) as n_rows
union all select 'loaded', cast(count(distinct n % (select greatest({MIN_FILES}, (count(*) + {FILE_ROWS - 1}) // {FILE_ROWS}) from n))
                                as integer), 0, count(*) from n""")
def q_corrupt_file_quarantine(spark, sf):
    """SRC-12: unreadable files are set aside whole and reported; each sound file of the same batches loads, once."""
    root = scratch_path(spark, "damaged")
    base, state, raw = root + "/lake", root + "/state", root + "/raw"
    ev = fx.fx_event(spark, sf)
    many = max(MIN_FILES, -(-ev.count() // FILE_ROWS))
    part = F.coalesce(id_number(F.col("event_id")), F.lit(0)) % many            # a file per value
    (ev.withColumn("part", part).repartition(many, "part").write.partitionBy("part").option("maxRecordsPerFile", 0)
     .parquet(f"{base}/appointment_events/date=2024-01-14"))
    for d in ("13", "15"):                              # text in a file with a Parquet name, before and behind the others
        _put(spark, f"{base}/appointment_events/date=2024-01-{d}/text.parquet", b"PAR1 but no footer PAR1")
    loader.load_new_files(spark, base, raw, state, max_files=1, tables=("appointment_events",))
    rows = loader.read_raw(spark, raw, "appointment_events").agg(F.count(F.lit(1))).scalar()
    report = loader.read_report(spark, state)
    is_bad = F.col("status") == "corrupt"
    counts = report.groupBy("status").agg(F.count(F.lit(1)).cast("int").alias("files"), F.count_if(is_bad).cast("int").alias("bad_files"))
    return counts.select("status", "files", "bad_files",
                         F.when(F.col("status") == "loaded", rows).otherwise(F.lit(0)).cast("bigint").alias("n_rows"))


def _arrive(spark, sf, folder: str, *chunks: int) -> None:
    """Records of the one change stream of four tables, as JSON files in arrival folders."""
    for b in chunks:
        fx.fx_changes(spark, sf, b).write.mode("append").json(f"{folder}/chunk={b}")


def _stream_to_lake(spark, root, run_date=LAKE_DATE):
    """Drain what has arrived into the lake; a later call goes on from the checkpoint."""
    stream = (spark.readStream.schema(ingest.ENVELOPE_FILE_SCHEMA).option("maxFilesPerTrigger", 8)
              .option("recursiveFileLookup", "true").json(root + "/incoming"))
    ingest.envelopes_to_lake(stream, root + "/lake", root + "/quarantine", root + "/_chk_lake", run_date=run_date).awaitTermination()
    return root + "/lake"


@query("stream_to_lake", _CHANGE_ROWS)
def q_stream_to_lake(spark, sf):
    """STR-01 / SRC-02/04 / SNK-02/03 / STR-05: one stream of four tables -> lake, with a restart in between."""
    root = scratch_path(spark, "stream")
    _arrive(spark, sf, root + "/incoming", 0, 1)
    _stream_to_lake(spark, root)
    _arrive(spark, sf, root + "/incoming", 2)
    lake = _stream_to_lake(spark, root)
    return _each_table(lambda t: lakesink.read_lake_table(spark, lake, t, with_batch=True))


@query("stream_rejects", with_("fx_op") + """
select case when fault = 'null_payload' then 'no_payload' when topic <> 'server.public.appointment_events' then 'unknown_topic'
            else 'invalid_op' end as reason, count(*) as n_rows
from fx_op where fault = 'null_payload' or topic <> 'server.public.appointment_events'
  or not ((op in ('c', 'u', 'r') and fault <> 'null_after') or op = 'd') group by 1""")
def q_stream_rejects(spark, sf):
    """CDC-03 in the stream: what no table takes is set aside under the same batch ids, with its reason."""
    root = scratch_path(spark, "stream")
    _arrive(spark, sf, root + "/incoming", 0, 1, 2)
    _stream_to_lake(spark, root)
    return (spark.read.schema(ingest.REJECTS_SCHEMA).parquet(root + "/quarantine/rejects")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


@query("stream_files_to_raw", _CHANGE_ROWS)
def q_stream_files_to_raw(spark, sf):
    """STR-02: new lake files of four tables -> raw VARIANT tables (file streams, availableNow), in two arrivals."""
    root = scratch_path(spark, "stream")
    for chunks in ((0,), (1, 2)):
        _arrive(spark, sf, root + "/incoming", *chunks)
        lake = _stream_to_lake(spark, root)
        for q in [ingest.lake_to_raw(spark, lake, t, root + "/raw", f"{root}/_chk_raw/{t}", max_files=16) for t in ENTITIES]:
            q.awaitTermination()
    return _each_table(lambda t: spark.read.parquet(lakesink.table_path(root + "/raw", t)).select(
        *[F.try_variant_get("v", f"$.{n}", kind).alias(n) for n, kind in WIRE_TYPES[t]], "position", "_deleted"))


@query("compact_closed_day", _CHANGE_ROWS)
def q_compact_closed_day(spark, sf):
    """SNK-01/02: a closed day's many batch folders become few files; readers see the same rows."""
    root = scratch_path(spark, "compact")
    for day, chunk in (("2024-01-19", 0), ("2024-01-20", 1), ("2024-01-21", 2)):
        _arrive(spark, sf, root + "/incoming", chunk)
        lake = _stream_to_lake(spark, root, day)

    def compact(t):
        lakesink.compact_day(spark, lake, t, "2024-01-19")
        lakesink.drop_batches(spark, lake, t, "2024-01-19")
        lakesink.compact_day(spark, lake, t, "2024-01-20")
    with ThreadPoolExecutor(max_workers=len(ENTITIES)) as pool:        # tables are folders of their own
        list(pool.map(compact, ENTITIES))
    return _each_table(lambda t: lakesink.read_lake_table(spark, lake, t, with_batch=True))


@query("stream_current_state", _stg_sql("appointment_events"))
def q_stream_current_state(spark, sf):
    """STR-04: latest state per appointment from an out-of-order raw stream."""
    root = scratch_path(spark, "state")
    ev = fx.fx_event(spark, sf)
    chunk = (id_number(F.col("event_id")) % 3).alias("chunk")
    raw = fx.fx_raw(ev.select("*", chunk), keep=("chunk",))
    raw.write.partitionBy("chunk").parquet(root + "/incoming")     # three arrivals, interleaved in time
    stream = (spark.readStream.schema(raw.drop("chunk").schema).option("maxFilesPerTrigger", 2)
              .option("recursiveFileLookup", "true").parquet(root + "/incoming"))
    q = ingest.current_state(stream, APPOINTMENT_EVENTS, root + "/log", root + "/_chk")
    q.awaitTermination()
    return ingest.read_current_state(spark, root + "/log", APPOINTMENT_EVENTS)


_E2E = ("e2e_fact", "patient_log_dim", "doctor_dim", "hospital_dim")


@query("end_to_end_dashboard", with_(*_E2E) + f"""
select count(*) filter (where appointment_time >= timestamp '{DAY} 00:00:00'
                          and appointment_time < timestamp '{_NEXT} 00:00:00') as today_appointments,
       count(*) filter (where event_type = 'CONFIRMED' and appointment_time >= timestamp '{DAY} 00:00:00'
                          and appointment_time < timestamp '{_NEXT} 00:00:00') as active_appointments,
       (select count(distinct patient_id) from patient_log_dim) as total_patients,
       (select count(distinct doctor_id) from doctor_dim) as total_doctors,
       (select count(distinct hospital_id) from hospital_dim) as total_hospitals,
       (select cast(sum(cnt) as bigint) from ({_SPEC_SQL.format(f='e2e_fact', d='doctor_dim')}) z) as specialty_total,
       (select string_agg(patient_id, ',' order by appointment_time desc, doctor_name asc nulls last, patient_id, event_type)
        from (select * from e2e_fact order by appointment_time desc nulls first, doctor_name asc nulls last,
                                              patient_id asc nulls last, event_type asc nulls last limit 10) z) as recent_patients
from e2e_fact""")
def q_end_to_end_dashboard(spark, sf):
    """SNK-08: change stream of four tables -> lake -> raw -> snapshots -> marts -> whole dashboard, three loads."""
    from .daily_job import run_pipeline
    loads = [(b, ts, fx.fx_changes(spark, sf, b)) for b, ts in runs()]
    page = run_pipeline(spark, loads, scratch_path(spark, "pipeline"), DAY, run_date=LAKE_DATE)
    total = page["specialty"].agg(F.sum("cnt").cast("bigint")).scalar()
    rank = Window.partitionBy().orderBy(F.col("appointment_time").desc_nulls_first(), F.col("doctor_name").asc_nulls_last(),
                                        F.col("patient_id").asc_nulls_last(), F.col("event_type").asc_nulls_last())
    ten = page["recent"].select(F.row_number().over(rank).alias("i"), "patient_id")      # ten rows
    names = ten.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "patient_id"))),
                                             lambda x: x["patient_id"]), ",").alias("p")).scalar()
    return page["summary"].select("*", total.alias("specialty_total"), names.alias("recent_patients"))


def _overlapping_loads(spark, sf):
    """Three loads, each of which also holds a part of what the one before it had: events and patients."""
    env = fx.fx_envelope(spark, sf)
    last = fx.table(spark, sf, "events").agg(F.max("event_id")).scalar()
    at = F.col("position") * 10
    events = [env.where(cond) for cond in (at <= 4 * last, (at > 3 * last) & (at <= 8 * last), at > 6 * last)]
    pat = fx.fx_entity_envelope(spark, sf, "patient")
    pat = pat.withColumn("position", F.shiftleft(F.col("b").cast("bigint"), 32) + F.col("position"))     # the log's order
    return [e.unionByName(pat.where(F.col("b").between(b - 1, b)).drop("b")) for b, e in enumerate(events)]


@query("land_overlapping_loads", with_("fx_op", "fx_patient_log") + f"""
select load, table_name, n_rows as lake_rows, n_rows as raw_rows, n_rows as counted from (
  select case when position * 10 <= 4 * last then 0 when position * 10 <= 8 * last then 1 else 2 end as load,
         'appointment_events' as table_name, count(*) as n_rows
  from fx_op, (select max(event_id) as last from events) m where {IMAGES} group by 1
  union all select b, 'patient', count(*) from fx_patient_log group by 1) z""")
def q_land_overlapping_loads(spark, sf):
    """STR-05 / CDC-05 / SNK-04: loads that overlap, one of them landed twice: each change is in lake and raw once."""
    from functools import reduce
    from .daily_job import land, read_raw
    root = scratch_path(spark, "landing")
    loads = _overlapping_loads(spark, sf)
    counted = {}
    for b in (0, 1, 1, 2):
        counted[b] = land(spark, loads[b], root, b, LAKE_DATE)
    rows = [(b, t, counted[b][t]) for b in range(3) for t in ("appointment_events", "patient")]
    out = []
    for t in ("appointment_events", "patient"):
        in_lake = lakesink.read_lake_table(spark, root + "/lake", t, with_batch=True)
        in_raw = reduce(lambda x, y: x.unionByName(y), [read_raw(spark, root, t, b) for b in range(3)])
        lake_n = in_lake.groupBy(F.col("batch_id").cast("int").alias("load")).agg(F.count(F.lit(1)).alias("lake_rows"))
        raw_n = in_raw.groupBy(F.col("b").alias("load")).agg(F.count("v").alias("raw_rows"))
        out.append(lake_n.join(raw_n, "load", "full").withColumn("table_name", F.lit(t)))
    seen = spark.createDataFrame(rows, "load int, table_name string, counted bigint")
    return out[0].unionByName(out[1]).join(seen, ["load", "table_name"], "left").select(
        "load", "table_name", "lake_rows", "raw_rows", "counted")


_LOG_UPTO = lambda phase, b: f"""
select '{phase}' as phase, * exclude (date_of_birth, dbt_valid_to), cast(date_of_birth as varchar) as date_of_birth,
       case when dbt_valid_to <= (select run_ts from run where b = {b}) then dbt_valid_to end as dbt_valid_to
from patient_log_snapshot where dbt_valid_from <= (select run_ts from run where b = {b})"""  # noqa: E731


@query("snapshot_crash_restart", with_("patient_log_snapshot") + " union all ".join(
    [_LOG_UPTO("crashed", 1), _LOG_UPTO("restarted", 2), _LOG_UPTO("run 1 again", 1), _LOG_UPTO("run 2 again", 2)]))
def q_snapshot_crash_restart(spark, sf):
    """SNK-08 / SCD-01: readers of the history while a run has died before its publish, after its restart, and
    after earlier runs are done again."""
    from functools import reduce
    from . import daily_job as job
    root = scratch_path(spark, "restart")
    raw = fx.fx_raw(fx.fx_patient_log(spark, sf).drop("run_ts"), keep=("_deleted", "position", "b"))
    raw.write.partitionBy("b").parquet(root + "/raw/patient")
    step, only = runs(), ("patient",)
    parts = []

    def look(phase):
        hist = job.read_snapshot(spark, root, "patient")
        hist.write.parquet(f"{root}/seen/{len(parts)}")              # what a reader sees now
        parts.append(spark.read.schema(hist.schema).parquet(f"{root}/seen/{len(parts)}").select(F.lit(phase).alias("phase"), "*"))
    for r in step[:2]:
        job.snapshot_runs(spark, root, [r], entities=only)
    job.advance_runs(spark, root, step[2:], entities=only)           # everything written, nothing published
    look("crashed")
    job.snapshot_runs(spark, root, step[2:], entities=only)
    look("restarted")
    job.snapshot_runs(spark, root, step[1:2], entities=only)
    look("run 1 again")
    job.snapshot_runs(spark, root, step[2:], entities=only)
    look("run 2 again")
    return reduce(lambda x, y: x.unionByName(y), parts)


@query("dashboard_recent", with_("fact_all") + """
select appointment_time, doctor_name, patient_id, event_type from fact_all
order by appointment_time desc nulls first, doctor_name asc nulls last, patient_id asc nulls last,
         event_type asc nulls last limit 10""")
def q_dashboard_recent(spark, sf):
    """DSH-01: the ten newest appointments of the page, in order."""
    from .dashboard import recent
    return recent(top_fact(spark, sf, 10))


@query("dashboard_specialty", with_("fact_all", "doctor_dim") + """
select specialty, cnt, round_even(cnt / greatest(max(cnt) over (), 1) * 100, 0) as share,
       cast(row_number() over (order by cnt desc, specialty asc nulls last) as integer) as place from ("""
       + _SPEC_SQL.format(f="fact_all", d="doctor_dim") + ") s")
def q_dashboard_specialty(spark, sf):
    """DSH-01 / AGG-04/06: specialty shares of the page, largest first."""
    from .dashboard import specialty_stats
    stats = specialty_stats(weighted_events(spark, sf), dim(spark, sf, "doctor"), "n_rows")
    place = Window.partitionBy().orderBy(F.col("cnt").desc(), F.col("specialty").asc_nulls_last())   # one row per specialty
    return stats.withColumn("place", F.row_number().over(place)).orderBy("place")


@query("scd2_patient_log", with_("patient_log_snapshot") + """
select * exclude (date_of_birth), cast(date_of_birth as varchar) as date_of_birth from patient_log_snapshot""")
def q_scd2_patient_log(spark, sf):
    """SCD-01/04: one merge per run over a log with several rows per key and run, reverts, NULL and tied times."""
    return scd2.fold(fx.fx_patient_log(spark, sf), ENTITIES["patient"], runs())


@query("scd2_close_deleted", with_("patient_close_snapshot") + """
select * exclude (date_of_birth), cast(date_of_birth as varchar) as date_of_birth from patient_close_snapshot""")
def q_scd2_close_deleted(spark, sf):
    """SCD-05 with deletes: a delete image closes the open version, a later change opens one."""
    return scd2.replay(fx.fx_patient_log(spark, sf), ENTITIES["patient"], deletes="close")


for _e, _cols in (("doctor", ["doctor_id", "hospital_id", "doctor_name", "specialty", "experience_years"]),
                  ("patient", ["patient_id", "patient_name", "gender", "city"])):
    def _mkl(e=_e, cols=_cols):
        def fn(spark, sf):
            return listing(fx.source_table(spark, sf, e), cols, f"{e}_id")
        fn.__doc__ = f"SRT-04 / SRC-13: {e} listing of the current source table."
        return fn
    query(f"{_e}_listing", with_(f"fx_{_e}") + f"select {', '.join(_cols)} from fx_{_e} where b = 2 order by {_e}_id")(_mkl())

for _e in ("doctor", "hospital"):
    def _mkk(e=_e):
        def fn(spark, sf):
            return listing(fx.source_table(spark, sf, e), [f"{e}_id", f"{e}_name"], f"{e}_id")
        fn.__doc__ = f"SRT-05: (id, name) lookup list of {e}."
        return fn
    query(f"{_e}_lookup", with_(f"fx_{_e}") + f"select {_e}_id, {_e}_name from fx_{_e} where b = 2 order by {_e}_id")(_mkk())


@query("object_load", with_("fx_event") + f"select {_EV_COLS} from fx_event")
def q_object_load(spark, sf):
    """SRC-07: load one named object; a non-Parquet key loads nothing."""
    root = scratch_path(spark, "objects")
    key = f"{root}/appointment_events/appointment_events_000000000001.parquet"
    fx.fx_event(spark, sf).write.parquet(key)
    ddl = wire_ddl("appointment_events")
    return lakefiles.load_object(spark, key, ddl).unionByName(
        lakefiles.load_object(spark, key.replace(".parquet", ".json"), ddl))


_IMG_SQL = """imgs as (
select *, case when op = 'd' then true end as _deleted from fx_op
where fault <> 'null_payload' and topic = 'server.public.appointment_events'
  and ((op in ('c', 'u', 'r') and fault <> 'null_after') or op = 'd')),
ranked as (
select *, row_number() over (partition by appointment_id order by event_timestamp desc nulls first,
                             cast(substring(event_id, 2) as bigint) desc, position desc) as rn
from imgs where appointment_id is not null and patient_id is not null)"""
_IMG_STG = """select appointment_id, patient_id, doctor_id, hospital_id, lower(event_type) as event_type,
       make_timestamp(appointment_time) as appointment_time, make_timestamp(event_timestamp) as event_timestamp,
       cast(cast(consultation_fee as decimal(38,0)) as varchar) as consultation_fee, cast(rn as integer) as rn
from ranked where rn = 1"""


def _cdc_images(spark, sf):
    return cdc.unified(classified(spark, sf), "appointment_events").drop("table_name")


@query("stg_events_from_cdc", with_("fx_op", extra=_IMG_SQL) + _IMG_STG)
def q_stg_events_from_cdc(spark, sf):
    """STG-01 over change images: delete images rank like any change (reference, T9)."""
    return stage(_cdc_images(spark, sf), APPOINTMENT_EVENTS)


@query("stg_events_drop_deletes", with_("fx_op", extra=_IMG_SQL) + _IMG_STG + " and _deleted is null")
def q_stg_events_drop_deletes(spark, sf):
    """T9 option: keys whose newest change is a delete leave the staged view."""
    return stage(_cdc_images(spark, sf), APPOINTMENT_EVENTS, deletes="drop")

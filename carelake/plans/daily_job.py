"""The whole job: change stream -> lake -> raw -> staging -> snapshots -> marts -> dashboard.

The reference runs it as scheduled steps (consume, load, snapshot, marts); here
it is one function over loads with explicit run times.  A load is any
DataFrame of change records ``(topic, position, value)`` of the captured tables:
a batch read of the topics, files, or the rows a stream handed over.  Every
step *writes* its result, which also cuts lineage between runs, so a lost
executor recomputes at most one step and plans stay small however many runs
are replayed.  Failures raise.

Crashes and reruns:

* a load owns its folders (lake, raw, classified) and overwrites them whole, so a
  rerun replaces everything the load wrote, also in tables it has no rows for any more;
* each load records the highest position of every topic partition it has seen; a
  load drops records at or below those of the loads before it, so loads that overlap
  (or a consumer that starts over) land each change once;
* a run writes its staging state and the versions it closed or left open into new
  folders and publishes all of them by one append of pointers: before that, readers see the
  history as it was, closed versions included;
* a run done again starts from the state of the runs before it; runs after
  it count as not done.

What a run costs:

* staging state  - latest change per key is an associative argmax, so the
  state after run n is ``latest(state(n-1) + rows of load n)``; older raw loads
  are not read again, the state table (one row per key) is rewritten.
* snapshot store - a run's version holds the open versions (one row per key) and,
  in a partition of their own, those that the run closed, which are never
  written again.  The full history is all closed partitions + the newest open one.
* marts          - built from the whole state and history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators import cdc, scd2
from ..operators.latest import latest_by_rank
from ..operators.marts import build_dim, build_fact
from ..operators.staging import stage, tiebreak_for, wire_columns
from ..registry import ENTITIES, APPOINTMENT_EVENTS, EntitySpec
from ..session import joins_by_measure
from ..sinks import lake, tables
from ..sinks.tables import if_exists
from ..sources.envelope import decode
from ..sources.kafka import OFFSET_BITS
from . import dashboard as dash

SNAPSHOT_ENTITIES = ("patient", "doctor", "hospital")
RAW = "v variant, _deleted boolean, position bigint, b int"
REJECTS = "_rejects"
CLASSIFIED = ("topic string, position bigint, op string, kind string, reason string, image string, "
              "source_table string, table_name string")
MARKS = "topic string, part bigint, high bigint, load int"
#: Topic partitions whose marks may be broadcast (some 50 bytes each).
SMALL_MARKS = 100_000
#: Partition column of a snapshot version: open versions apart from those that the run closed.
OPEN = "_open"
_BOOK = ("b", "position", "_deleted")
#: One load: its number, its run time, its change records.
Load = tuple[int, Column, DataFrame]


def _each(fn: Callable, items) -> list:
    """Independent per-table steps run as concurrent Spark jobs (the
    scheduler interleaves their tasks); the first failure is raised."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return [f.result() for f in [pool.submit(fn, x) for x in items]]


def _base(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def partition_of(position: Column) -> Column:
    """The topic partition that a position (``sources.kafka.log_position``) belongs to."""
    return F.shiftright(position, OFFSET_BITS)


def not_landed(spark: SparkSession, changes: DataFrame, root: str, b: int) -> DataFrame:
    """``changes`` less those that a load before ``b`` has seen: at or below its highest position of
    their topic partition.  Records without a position always land."""
    marks = if_exists(lambda: spark.read.schema(MARKS).parquet(_base(root, "_positions")))
    if marks is None:
        return changes
    high = marks.where(F.col("load") < b).groupBy(F.col("topic").alias("_topic"), "part").agg(F.max("high").alias("high"))
    if high.count() <= SMALL_MARKS:                  # a row per topic partition
        high = F.broadcast(high)
    on = (F.col("topic") == F.col("_topic")) & (partition_of(F.col("position")) == F.col("part"))
    seen = F.coalesce(F.col("position") <= F.col("high"), F.lit(False))
    return changes.join(high, on, "left").where(~seen).select(*changes.columns)


def land(spark: SparkSession, changes: DataFrame, root: str, b: int, run_date: str | Column, topics=None) -> dict[str, int]:
    """One load of change records into the lake and the raw tables; returns what became of them.

    The envelopes are parsed once; what they are is written by table (rejects
    with their reason), and the lake and raw VARIANT folders of the load
    follow from that.  The counts (accepted per table, rejects per reason) are observed by that write."""
    sorted_out = cdc.classify(decode(not_landed(spark, changes, root, b), topics=topics))
    rejected = F.col("kind") == "reject"
    counts = Observation()
    seen = sorted_out.observe(
        counts, *[F.count_if(~rejected & (F.col("table_name") == t)).alias(t) for t in ENTITIES],
        *[F.count_if(rejected & (F.col("reason") == r)).alias(f"reject_{r}") for r in cdc.REASONS])
    path = _base(root, f"classified/load={b}")
    (seen.select("topic", "position", "op", "kind", "reason", "image", F.col("table_name").alias("source_table"),
                 F.when(rejected, F.lit(REJECTS)).otherwise(F.col("table_name")).alias("table_name"))
     .write.mode("overwrite").partitionBy("table_name").parquet(path))
    rows = spark.read.schema(CLASSIFIED).parquet(path)
    today = F.lit(run_date) if isinstance(run_date, str) else run_date
    date = lake.batch_date(spark, _base(root, "lake"), b, today)

    def to_lake(name: str) -> None:
        lake.write_lake(cdc.unified(rows, name).drop("table_name"), _base(root, "lake"), name, date, batch_id=b)

    def to_raw(name: str) -> None:
        own = rows.where(F.col("table_name") == name)
        (own.select(F.parse_json("image").alias("v"), F.when(F.col("kind") == "delete", F.lit(True)).alias("_deleted"), "position")
         .write.mode("overwrite").parquet(_base(root, f"raw/{name}/b={b}")))
    _each(lambda step: step[0](step[1]), [(sink, t) for t in ENTITIES for sink in (to_lake, to_raw)])
    # last: from here on the load counts as landed
    (rows.where(F.col("position").isNotNull()).groupBy("topic", partition_of(F.col("position")).alias("part"))
     .agg(F.max("position").alias("high")).write.mode("overwrite").parquet(_base(root, f"_positions/load={b}")))
    return counts.get


def read_raw(spark: SparkSession, root: str, name: str, b: int) -> DataFrame:
    return spark.read.schema(RAW).parquet(_base(root, f"raw/{name}")).where(F.col("b") == b)


def _wire(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    w = wire_columns(rows, spec, _BOOK)
    for k in spec.required:
        w = w.where(F.col(k).isNotNull())
    return w


def latest_wire(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """Newest change per key in wire form (keeps the ranking columns, so the
    result can be merged with later loads)."""
    w = _wire(rows, spec)
    return latest_by_rank(w, spec.key, [F.col(spec.order_col)], tiebreak_for(spec, w), keep_rn=False)


def advance_state(state: DataFrame | None, loaded: DataFrame, spec: EntitySpec) -> DataFrame:
    """``latest(state + load)``: one ranking (one shuffle) per run; the
    partial WindowGroupLimit still reduces a hot key inside each map task."""
    cand = _wire(loaded, spec)
    if state is not None:
        cand = state.unionByName(cand, allowMissingColumns=True)
    return latest_wire(cand, spec)


def advance_runs(spark: SparkSession, root: str, runs: Sequence[tuple[int, Column]], deletes: str = "ignore",
                 entities: Sequence[str] = tuple(ENTITIES)) -> list[tuple[str, str, int]]:
    """Write the states and snapshots after each of ``runs``; returns the pointers that publish them.

    The first run starts from what the runs before it published."""
    def one(name: str) -> list[tuple[str, str, int]]:
        spec, first = ENTITIES[name], runs[0][0]
        state = tables.read_current(spark, root, f"state_{name}", before=first)
        open_ = read_open(spark, root, name, before=first) if name in SNAPSHOT_ENTITIES else None
        out = []
        for b, ts in runs:          # runs are sequential per entity: each builds on the last
            nxt = advance_state(state, read_raw(spark, root, name, b), spec)
            out.append((f"state_{name}", tables.write_version(nxt, root, f"state_{name}", publish=False), b))
            state = spark.read.schema(nxt.schema).parquet(out[-1][1])     # known schema: no footer scan
            if name not in SNAPSHOT_ENTITIES:
                continue
            if deletes == "close":
                staged = stage(state, spec, ts, deletes="ignore", keep_deleted=True)
            else:
                staged = stage(state, spec, ts, deletes=deletes)
            hist = scd2.merge(open_, staged, spec, ts, deletes=deletes)
            out.append((f"snap_{name}", tables.write_version(hist.withColumn(OPEN, F.col("dbt_valid_to").isNull()), root,
                                                             f"snap_{name}", publish=False, partition_by=[OPEN]), b))
            open_ = _versions(spark, [out[-1][1]], hist.schema, True)
        return out
    return [p for pointers in _each(one, entities) for p in pointers]


def snapshot_runs(spark: SparkSession, root: str, runs: Sequence[tuple[int, Column]], deletes: str = "ignore",
                  entities: Sequence[str] = tuple(ENTITIES)) -> None:
    """Advance the staging state and the snapshots by runs in order, from the published state of the runs before them.

    ``deletes``: ``ignore`` (reference: a delete image is staged like any
    change), ``drop`` (keys whose newest change is a delete leave staging and
    their open version stays open) or ``close`` (such keys' open version is
    closed at the run)."""
    # readers switch once every table's run sequence is complete: one publish, closed versions included
    tables.publish_versions(spark, root, sorted(advance_runs(spark, root, runs, deletes, entities), key=lambda p: p[2]))


def _versions(spark: SparkSession, paths: Sequence[str], schema, is_open: bool) -> DataFrame:
    table = paths[0].rsplit("/", 1)[0]                   # the versions' common folder
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField(OPEN, T.BooleanType())]))
            .option("basePath", table).parquet(*paths))
    return rows.where(F.col(OPEN) == is_open).select(*schema.names)


def _snapshot_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType([f for f in spark.read.parquet(path).schema if f.name != OPEN])


def read_open(spark: SparkSession, root: str, name: str, before: int | None = None) -> DataFrame | None:
    """The open versions, one row per key; None when no run was published."""
    path = tables.current_path(spark, root, f"snap_{name}", before)
    return _versions(spark, [path], _snapshot_schema(spark, path), True) if path else None


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Full history = versions closed by any published run + open versions of the last.  A history that cannot be read raises."""
    paths = [p for _, p in tables.published(spark, root, f"snap_{name}")]
    if not paths:
        raise ValueError(f"no snapshot of {name} was ever published under {root}")
    schema = _snapshot_schema(spark, paths[0])
    return _versions(spark, paths, schema, False).unionByName(_versions(spark, paths[:1], schema, True))


def expire_runs(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove what only runs before the newest ``keep`` need: states, open versions, dimensions.  Closed versions stay."""
    gone = tables.expire(spark, root, [f"state_{e}" for e in ENTITIES] + [f"{e}_dim" for e in SNAPSHOT_ENTITIES], keep)
    return gone + tables.expire(spark, root, [f"snap_{e}" for e in SNAPSHOT_ENTITIES], keep, closed=f"{OPEN}=true")


def build_marts(spark: SparkSession, root: str, version_mode: str = "all", fact_mode: str = "append",
                deletes: str = "ignore") -> None:
    snaps = {n: read_snapshot(spark, root, n) for n in SNAPSHOT_ENTITIES}
    state = tables.read_current(spark, root, f"state_{APPOINTMENT_EVENTS.name}")
    events = stage(state, APPOINTMENT_EVENTS, deletes="ignore" if deletes == "ignore" else "drop")
    fact = build_fact(events, snaps["patient"], snaps["doctor"], snaps["hospital"], version_mode)

    def step(name: str) -> tuple[str, str, None] | None:
        if name == "fact":
            tables.write_incremental(fact, root, "appointment_events_fact", fact_mode,
                                     key=["appointment_id"] if fact_mode == "keyed" else None)
            return None
        return f"{name}_dim", tables.write_version(build_dim(snaps[name], name), root, f"{name}_dim", publish=False), None
    tables.publish_versions(spark, root, [p for p in _each(step, (*SNAPSHOT_ENTITIES, "fact")) if p])


def dashboard(spark: SparkSession, root: str, day: str, fact_mode: str = "append") -> dict[str, DataFrame]:
    """The page's three parts over the stored marts: summary, recent appointments, specialty shares."""
    fact = tables.read_incremental(spark, root, "appointment_events_fact", fact_mode)
    dims = {n: tables.read_current(spark, root, f"{n}_dim") for n in SNAPSHOT_ENTITIES}
    return {"summary": dash.summary(fact, dims["patient"], dims["doctor"], dims["hospital"], day),
            "recent": dash.recent(fact),
            "specialty": dash.specialty_stats(fact, dims["doctor"])}


def run_pipeline(spark: SparkSession, loads: Sequence[Load], root: str, day: str, version_mode: str = "all",
                 fact_mode: str = "append", deletes: str = "ignore", run_date: str | None = None,
                 topics=None) -> dict[str, DataFrame]:
    """All steps for ``loads`` in order; ``root`` is a folder that all executors share.

    A later call with the next loads goes on from the published state."""
    joins_by_measure(spark)
    for b, _ts, changes in loads:
        land(spark, changes, root, b, run_date or F.current_date(), topics)
    snapshot_runs(spark, root, [(b, ts) for b, ts, _ in loads], deletes)
    build_marts(spark, root, version_mode, fact_mode, deletes)
    return dashboard(spark, root, day, fact_mode)

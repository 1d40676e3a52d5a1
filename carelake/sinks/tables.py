"""Table materializations on plain Parquet.

* view        - a lazy DataFrame registered with ``createOrReplaceTempView``, or
                over a stored table a view of the catalog that other sessions read
* table       - full refresh: written to a *new version folder*, then a
                pointer row is appended; the newest pointer counts, so
                readers see the old version or the new one and never a gap,
                and a job may read the version it replaces (Parquet cannot
                be overwritten while being read).  A pointer may carry the
                number of the run that made it: a run that is done again
                starts from the versions of the runs before it, and its
                pointers take the place of those of its own and later runs.
* incremental - ``append`` (reference: every run appends the whole set
                again), ``replace`` or ``keyed`` (delete + insert by key, in
                the buckets that hold the keys: rerunning a batch is a no-op).
* ``expire``  - removes versions that no reader can need any more.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

POINTERS = "name string, path string, seq bigint, run int"

#: Folders of a keyed table, by the hash of the key, and the column that tells them.
BUCKETS, BUCKET = 64, "_bucket"


def _base(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def if_exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    """``read()``, or None when its path does not exist; every other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the cluster's file system; False if there was none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def catalog_view(spark: SparkSession, name: str, path: str, query: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name``: ``query`` over the Parquet folder ``path``, written ``{table}`` in it."""
    table = "parquet.`" + path.replace("`", "``") + "`"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + query.replace("{table}", table))
    return spark.table(name)


def write_version(df: DataFrame, root: str, name: str, publish: bool = True, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a new version; ``publish`` switches readers to it."""
    path = f"{_base(root, name)}/v={time.time_ns()}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    if publish:
        publish_versions(df.sparkSession, root, [(name, path, None)])
    return path


def publish_versions(spark: SparkSession, root: str, versions: Sequence[tuple[str, str, int | None]]) -> None:
    """Switch readers of several tables at once: one file of (name, path, run) pointer rows is appended."""
    if not versions:
        return
    rows = [(name, path, time.time_ns(), run) for name, path, run in versions]
    (spark.createDataFrame(rows, POINTERS).coalesce(1).write.mode("append")
     .parquet(f"{root.rstrip('/')}/_catalog"))


def published(spark: SparkSession, root: str, name: str, before: int | None = None) -> list[tuple[int | None, str]]:
    """(run, path) of the versions that hold, newest first; ``before``: of earlier runs only.

    There are as many as runs of the job.  A run done again drops what it and later runs published."""
    log = if_exists(lambda: spark.read.schema(POINTERS).parquet(f"{root.rstrip('/')}/_catalog"))
    if log is None:
        return []
    out: list[tuple[int | None, str]] = []
    for r in log.where(F.col("name") == name).orderBy(F.desc("seq"), F.desc("run")).collect():
        if before is not None and (r["run"] is None or r["run"] >= before):
            continue
        if not out or (r["run"] is not None and out[-1][0] is not None and r["run"] < out[-1][0]):
            out.append((r["run"], r["path"]))
    return out


def current_path(spark: SparkSession, root: str, name: str, before: int | None = None) -> str | None:
    """The published version's path; None only when nothing was ever published."""
    found = published(spark, root, name, before)
    return found[0][1] if found else None


def read_current(spark: SparkSession, root: str, name: str, before: int | None = None) -> DataFrame | None:
    p = current_path(spark, root, name, before)
    return spark.read.parquet(p) if p else None


def write_incremental(df: DataFrame, root: str, name: str, mode: str = "append",
                      key: Sequence[str] | None = None, buckets: int = BUCKETS) -> list[int]:
    """Add ``df`` to a table; returns the buckets that were written (keyed mode only).

    ``keyed``: rows are held in ``buckets`` folders by the hash of their key (a number that a table keeps for
    good).  Only buckets that ``df`` has keys of are read, joined and written anew; one append of pointers switches
    readers to all of them."""
    if mode == "append":
        df.write.mode("append").parquet(f"{_base(root, name)}/data")
        return []
    if mode == "replace":
        write_version(df, root, name)
        return []
    if mode != "keyed":
        raise ValueError(mode)
    if not key:
        raise ValueError("keyed mode needs a key")
    spark = df.sparkSession
    kept = bucket_paths(spark, root, name)
    if kept and kept[0] != buckets:
        raise ValueError(f"{name} is held in {kept[0]} buckets")
    new = df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())      # at most ``buckets`` numbers
    out = new
    old = [kept[1][b] for b in touched if kept and b in kept[1]]
    if old:
        same = reduce(lambda x, y: x & y, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key])
        cur = spark.read.schema(df.schema).parquet(*old).withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        out = cur.alias("o").join(df.select(*key).distinct().alias("n"), same, "left_anti").unionByName(new)
    # files by size: adaptive execution splits large buckets and joins small ones
    path = f"{_base(root, name)}/v={time.time_ns()}"
    out.hint("rebalance", BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(path)
    publish_versions(spark, root, [(f"{name}/{buckets}/{b}", f"{path}/{BUCKET}={b}", None) for b in touched])
    return touched


def bucket_paths(spark: SparkSession, root: str, name: str) -> tuple[int, dict[int, str]] | None:
    """(number of buckets, bucket -> folder) of a keyed table; None before its first write."""
    log = if_exists(lambda: spark.read.schema(POINTERS).parquet(f"{root.rstrip('/')}/_catalog"))
    if log is None:
        return None
    rows = (log.where(F.col("name").startswith(f"{name}/")).groupBy("name").agg(F.max_by("path", "seq").alias("path")).collect())
    found = {tuple(int(x) for x in r["name"].rsplit("/", 2)[1:]): r["path"] for r in rows}
    return (next(iter(found))[0], {b: p for (_, b), p in found.items()}) if found else None


def read_incremental(spark: SparkSession, root: str, name: str, mode: str = "append") -> DataFrame:
    if mode == "append":
        return spark.read.parquet(f"{_base(root, name)}/data")
    if mode == "replace":
        return read_current(spark, root, name)
    kept = bucket_paths(spark, root, name)
    if kept is None:
        raise ValueError(f"{name} was never written under {root}")
    return spark.read.parquet(*kept[1].values())


def expire(spark: SparkSession, root: str, names: Sequence[str], keep: int = 2, closed: str | None = None) -> int:
    """Remove the version folders of ``names`` that no reader can need any more; returns how many.

    The newest ``keep`` published versions stay (the one before the newest may still be read), and so do
    younger folders: they belong to a run that has not published yet.  ``closed`` names the partition (such as
    ``_open=true``) that older versions lose while the rest of them stays for good; what a
    run done again has superseded goes whole.  A run can be done again only if the run before it is kept."""
    gone = 0
    for name in names:
        lineage = [_folder_of(p) for _, p in published(spark, root, name)]
        kept = lineage[:keep] if len(lineage) > 1 else _newest(spark, root, name, keep)
        in_buckets = bucket_paths(spark, root, name)
        if in_buckets:
            kept = [*kept, *map(_folder_of, in_buckets[1].values())]
        if not kept:
            continue                                     # nothing was published
        oldest, held = min(map(_made, kept)), {*kept, *(lineage if closed else ())}
        drop = [f for f in _folders(spark, _base(root, name)) if _made(f) < oldest and f not in held]
        drop += [f"{f}/{closed}" for f in lineage[keep:]] if closed else []
        gone += sum(remove_folder(spark, f"{_base(root, name)}/{f}") for f in drop)
    return gone


def _folder_of(path: str) -> str:
    return re.search(r"v=\d+", path)[0]


def _made(folder: str) -> int:
    return int(folder.split("=")[1])


def _newest(spark: SparkSession, root: str, name: str, keep: int) -> list[str]:
    """The newest ``keep`` published versions of a table that no run numbers."""
    log = if_exists(lambda: spark.read.schema(POINTERS).parquet(f"{root.rstrip('/')}/_catalog"))
    rows = [] if log is None else log.where(F.col("name") == name).orderBy(F.desc("seq")).limit(keep).collect()
    return [_folder_of(r["path"]) for r in rows]


def _folders(spark: SparkSession, base: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return [n for n in names if re.fullmatch(r"v=\d+", n)]

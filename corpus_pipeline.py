"""Corpus pipeline: documents through five operators of ``carelake.llm``.

Every stage works on all that the one before it kept:

1. quality classifier - documents that it rejects go
2. line dedup - repeated runs of lines go, and documents of which nothing is left by that
3. MinHash near-dedup - the least doc_id of each group stays
4. benchmark decontamination - documents with a benchmark passage go
5. mixing sources to target weights - what every document gives to the mix

Defined cases: null and empty texts go or stay as the quality classifier scores them and have no
part in stages 2 to 4; very long texts are handled whole; rows that share doc_id and text are one
document for stages 2 to 4, and stage 3 keeps one of them; rows that share only the doc_id, and rows
without one, are documents of their own, told apart by the hash of their text; of documents that
tie in stage 3 the one with the least doc_id (null last), then text hash, stays; an empty table
stays empty; extra columns go through, whatever their names, but size, source_size, target, taken and
copies, which the last stage replaces.

Stages 1 to 4 return the columns of documents (n_chars follows the text); the last adds
size, source_size, target, taken and copies.  No stage can be written as SQL alone (a
fitted model, a search), so tests hold each against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelake.llm.common import materialise, table
from carelake.llm.decontam import decontaminate
from carelake.llm.lines import line_dedup
from carelake.llm.mixing import mix
from carelake.llm.neardup import one_of_each
from carelake.llm.quality import keep_good
from carelake.session import configure, joins_by_file_size


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    configure(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated runs of lines; those left without any word by that go."""
    configure(spark)
    done = line_dedup(docs, extend=True).filter("n_removed = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    cols = {c: F.col(f"`{c}`") for c in docs.columns}
    if "n_chars" in cols:
        cols["n_chars"] = length.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return done.select(*cols.values())


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least doc_id, of each group of near duplicates."""
    configure(spark)
    return one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    configure(spark)
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("contaminated")
    hit = materialise(hit.select(F.col("doc_id").alias("_leak_id"), F.col("key").alias("_leak_key")).distinct(), "leaking")
    same = F.xxhash64("text").eqNullSafe(F.col("_leak_key")) & F.col("doc_id").eqNullSafe(F.col("_leak_id"))
    return docs.join(hit, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the words that each gives to the mix."""
    configure(spark)
    return mix(docs)


STAGES = [("quality", quality_stage), ("line dedup", line_stage), ("near dedup", near_stage),
          ("decontamination", benchmark_stage), ("mixing", mix_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; what a stage returns is written before the next reads it."""
    joins_by_file_size(configure(spark))
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name.replace(' ', '-')}")
    return docs

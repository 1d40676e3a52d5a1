"""The registered queries of the training-data operators, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import joins_by_file_size
from . import oracle_sql as sql
from .chat import Template, format_chats, loss_text, read_back
from .common import table
from .decontam import decontaminate
from .exact import exact_dedup
from .lexical import search
from .lines import line_dedup
from .mixing import mix
from .neardup import near_dup
from .periods import periodic_runs, with_periodic_tails
from .quality import quality_scores
from .secretspans import KINDS, secret_spans
from .suffixes import repeated_bytes
from .tokens import count_tokens
from .urls import judge_urls

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(joins_by_file_size(spark), sf_dir)
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, oracle)
        return fn
    return deco


@query("op1_mix_sources", sql.MIX)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that each document gives to the mix."""
    docs = table(spark, sf_dir, "documents")
    return mix(docs, carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_url_filter", sql.URLS)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op3_token_count")
def op3_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the public 32k piece model."""
    return count_tokens(table(spark, sf_dir, "documents"))


@query("op4_line_dedup", sql.LINES)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated runs of lines, each prolonged as far as it goes."""
    done = line_dedup(table(spark, sf_dir, "documents"), extend=True)
    return done.select("doc_id", "n_lines", "n_removed",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op5_near_dedup", sql.NEAR)
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: three-word shingles, similarity 0.85."""
    return near_dup(table(spark, sf_dir, "documents"), k=3, similarity=(85, 100))


@query("op6_exact_dedup", sql.EXACT)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keeper and copies of every document's normalised text."""
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op7_decontaminate", sql.LEAKS)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and benchmark items that occur in every document, by windows of ten words."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query("op8_chat_format", sql.CHAT)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    r"""Digests of all conversations and of one that holds the template's marks, read back from the output."""
    text = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    t = Template()
    done = format_chats(rows, t).withColumns({"turns": read_back(F.col("formatted"), t),
                                              "loss": loss_text(F.col("segments"))})
    flat = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op9_repeated_bytes")
def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 50-byte strings of smaller documents."""
    return repeated_bytes(table(spark, sf_dir, "documents"))


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_ranked_search", sql.RANKED)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query("op12_secret_scan")
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: those of the fixed patterns, and all with those the random field adds."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS[:3]))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document; a tenth of the documents get a periodic tail first."""
    found = periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumn("_best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("(1000 * _best.length) div -_best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("collapsed_sha256"))

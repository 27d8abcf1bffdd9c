"""Scores in long form: (run_id, architecture, benchmark, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The largest fall, in percent, that is no regression; all other benchmarks have 1.0.
FLOORS = {"aime24": 2.0, "gpqa": 2.0, "triton": 2.0}
BENCHMARKS = ("bfcl", "gsm8k", "humaneval", "ifeval", "mmlu_pro", "aime24", "gpqa", "triton")
#: gsm8k may fall by so much where triton rose by so much.
RELAXED_FLOOR, RELAXED_FROM = 2.0, 2.0


def valid_score(c: Column) -> Column:
    """A fraction from 0 to 1."""
    return F.coalesce(~F.isnan(c) & c.between(0.0, 1.0), F.lit(False))


def invalid_scores(results: DataFrame) -> DataFrame:
    """run_id, benchmark, n of null, NaN and out-of-range scores."""
    return results.where(~valid_score(F.col("score"))).groupBy("run_id", "benchmark").agg(F.count(F.lit(1)).alias("n"))


def run_scores(results: DataFrame) -> DataFrame:
    """The latest valid score of each run and benchmark; of several at one time the highest."""
    best = F.max(F.struct("scored_at", "score"))
    return results.where(valid_score(F.col("score")) & F.col("run_id").isNotNull() & F.col("benchmark").isin(*BENCHMARKS)).groupBy("run_id", "gpu_architecture", "benchmark").agg(best.alias("x")).select("run_id", "gpu_architecture", "benchmark", "x.score", "x.scored_at")


def pct_delta(candidate: Column, frontier: Column) -> Column:
    """Change in percent; from 0 it is 0 or infinite."""
    return F.when(frontier == 0, F.when(candidate == 0, 0.0).otherwise(F.lit(float("inf")))).otherwise((candidate - frontier) / F.nullif(frontier, F.lit(0.0)) * 100)


def frontier(scores: DataFrame) -> DataFrame:
    """Best score of each architecture and benchmark."""
    return scores.groupBy("gpu_architecture", "benchmark").agg(F.max("score").alias("frontier"))


def frontier_history(scores: DataFrame) -> DataFrame:
    """Every run's score with the frontier before it (by time, then run) and whether it moves it. The key space of a window is one architecture's
    results of one benchmark."""
    w = Window.partitionBy("gpu_architecture", "benchmark").orderBy("scored_at", "run_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("score").over(w)
    return scores.select("run_id", "gpu_architecture", "benchmark", "score", before.alias("before")).withColumn("moves", F.col("before").isNull() | (F.col("score") > F.col("before")))


def against_frontier(scores: DataFrame, base: DataFrame) -> DataFrame:
    """run_id, gpu_architecture, benchmark, delta_pct, regression of every score that has a frontier. base: gpu_architecture, benchmark, frontier."""
    joined = scores.join(F.broadcast(base) if base.count() <= 100_000 else base, ["gpu_architecture", "benchmark"]).withColumn("delta_pct", pct_delta(F.col("score"), F.col("frontier")))
    triton = joined.where("benchmark = 'triton'").select("run_id", "gpu_architecture", F.col("delta_pct").alias("triton_pct"))
    floor = F.lit(1.0)
    for name, value in FLOORS.items():
        floor = F.when(F.col("benchmark") == name, value).otherwise(floor)
    floor = F.when((F.col("benchmark") == "gsm8k") & (F.col("triton_pct") >= RELAXED_FROM), RELAXED_FLOOR).otherwise(floor)
    out = joined.join(triton, ["run_id", "gpu_architecture"], "left")
    return out.select("run_id", "gpu_architecture", "benchmark", "delta_pct", ((F.col("delta_pct") < 0) & (-F.col("delta_pct") > floor)).alias("regression"))


def outside_tolerance(claimed: DataFrame, measured: DataFrame, keys: list[str], points: float = 2.0) -> DataFrame:
    """keys, claimed, measured, off of the pairs that differ by more than so many percentage points; unclaimed ones are skipped."""
    off = F.abs(F.col("claimed") - F.col("measured")) * 100
    return claimed.join(measured, keys).where(F.col("claimed").isNotNull() & F.col("measured").isNotNull()).withColumn("off", off).where(F.col("off") > points).select(*keys, "claimed", "measured", "off")


def ledger_once(ledger: DataFrame) -> DataFrame:
    """The first entry of each run: a second delivery changes nothing. Entries without a run are left out."""
    first = F.min(F.struct(F.coalesce("date", F.lit("")).alias("at"), F.coalesce("pr", F.lit("")).alias("pr"), "label", "best_benchmark", "best_pct_delta", "regressions", "attested"))
    x = ledger.where("run_id is not null").groupBy("run_id").agg(first.alias("x"))
    return x.select("run_id", F.col("x.at").alias("date"), F.col("x.pr").alias("pr"), F.col("x.label").alias("label"), F.size(F.coalesce("x.regressions", F.array().cast("array<string>"))).alias("n_regressions"), F.coalesce("x.attested", F.lit(False)).alias("attested"))

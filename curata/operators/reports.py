"""Aggregates of benchmark reports and timings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_level(details: DataFrame) -> DataFrame:
    """level, n, pass_rate, mean_score for each level and, under the level 'all', over everything: one pass by grouping sets. details: level, passed, score."""
    text = details.select(F.coalesce(F.col("level").cast("string"), F.lit("none")).alias("level"), F.col("passed").cast("int").alias("passed"), F.coalesce("score", F.lit(0.0)).alias("score"))
    out = text.groupingSets([["level"], []], "level").agg(F.grouping("level").alias("g"), F.count(F.lit(1)).alias("n"), F.avg("passed").alias("pass_rate"), F.avg("score").alias("mean_score"))
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.col("level")).alias("level"), "n", "pass_rate", "mean_score")


def quick_mean(details: DataFrame, levels: tuple[str, ...] = ("1", "bugfix")) -> DataFrame:
    """Mean score of the quick levels; a missing score counts 0, and without such rows the mean is null."""
    return details.select(F.avg(F.when(F.col("level").cast("string").isin(*levels), F.coalesce("score", F.lit(0.0)))).alias("quick_mean"))


def metric_means(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """metric, mean."""
    return rows.unpivot([], metrics, "metric", "value").groupBy("metric").agg(F.avg("value").alias("mean"))


def speedups(timings: DataFrame, least: float = 0.1, most: float = 10.0) -> DataFrame:
    """file, speedup of the reference's time over the candidate's; files whose ratio is out of the bounds, or without time, are left out."""
    sums = timings.groupBy("file").agg(F.sum("reference_ms").alias("r"), F.sum("candidate_ms").alias("c"))
    return sums.where("c > 0").select("file", (F.col("r") / F.col("c")).alias("speedup")).where((F.col("speedup") < most) & (F.col("speedup") > least))


def matched_timings(candidate: DataFrame, reference: DataFrame) -> DataFrame:
    """file, reference_ms, candidate_ms of the files that both have. Where a file has another number of sizes in the reference, only the reference's
    sizes that the candidate has count; where the numbers still differ the file is left out. Both: file, input_size, ms, one row a size."""
    c = candidate.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum("ms").alias("candidate_ms"))
    both = reference.join(candidate.select("file", "input_size", F.lit(True).alias("has")).distinct(), ["file", "input_size"], "left")
    r = both.groupBy("file").agg(F.count(F.lit(1)).alias("n_all"), F.sum("ms").alias("ms_all"), F.count("has").alias("n_has"), F.sum(F.when(F.col("has"), F.col("ms"))).alias("ms_has"))
    out = c.join(r, "file")
    whole = F.col("n") == F.col("n_all")
    return out.where(whole | (F.col("n") == F.col("n_has"))).select("file", F.when(whole, F.col("ms_all")).otherwise(F.col("ms_has")).alias("reference_ms"), "candidate_ms")


def mean_speedup(speedup_table: DataFrame, digits: int = 2) -> DataFrame:
    """n, speedup: files and the mean of their ratios."""
    return speedup_table.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("speedup"), digits).alias("speedup"))


def rates(samples: DataFrame) -> DataFrame:
    """samples (n_bytes, n_flops, ms) with bandwidth in GB/s and compute in TFLOPS; null for a time of 0."""
    seconds = F.nullif(F.col("ms"), F.lit(0.0)) / 1000
    return samples.withColumns({"bandwidth": F.col("n_bytes") / 1e9 / seconds, "compute": F.col("n_flops") / 1e12 / seconds})


def summary(details: DataFrame, key: str, rates_of: tuple[str, ...], means_of: tuple[str, ...]) -> DataFrame:
    """key, n, a rate for each column of truth and a mean for each of numbers, for each key (null counts as 'none') and, under 'all', over everything. A
    missing truth or number counts 0."""
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in (*rates_of, *means_of)}
    rows = details.select(F.coalesce(F.col(key).cast("string"), F.lit("none")).alias("_key"), *(v.alias(c) for c, v in values.items()))
    out = rows.groupingSets([["_key"], []], "_key").agg(F.grouping("_key").alias("_g"), F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(c) for c in values))
    return out.select(F.when(F.col("_g") == 1, "all").otherwise(F.col("_key")).alias(key), "n", *values)


def only_containing(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """text_id, part_id of every text that contains exactly one of the parts. texts: text_id, text. parts (part_id, part) is the smaller side, of a
    checked size: a join on containment compares every text with every part. Line feeds don't count; empty parts are left out."""
    bare = lambda c: F.replace(F.col(c), F.lit("\n"))
    few = parts.where("part <> ''").select("part_id", bare("part").alias("_part"))
    if few.count() > 10_000:
        raise ValueError("more than 10,000 parts")
    met = texts.select("text_id", bare("text").alias("_text")).join(F.broadcast(few), F.contains("_text", F.col("_part")))
    return met.groupBy("text_id").agg(F.count(F.lit(1)).alias("n"), F.min("part_id").alias("part_id")).where("n = 1").select("text_id", "part_id")


def efficiency(samples: DataFrame, peak_bandwidth: float = 1800.0, peak_compute: float = 838.0, digits: int = 4) -> DataFrame:
    """file, percent of the peak, of bandwidth or of compute, whichever is higher, each rounded; 100 or more is rejected."""
    best = samples.groupBy("file").agg(F.max("bandwidth").alias("b"), F.max("compute").alias("c"))
    share = F.greatest(F.round(F.col("b") * 100 / peak_bandwidth, digits), F.round(F.col("c") * 100 / peak_compute, digits))
    return best.select("file", share.alias("efficiency")).where("efficiency < 100")


def first_stable(series: DataFrame, key: str, at: str, value: str, change: float = 1e-4, times: int = 3) -> DataFrame:
    """key and the first place at which the value changed by less than `change` for `times` steps in a row."""
    w = Window.partitionBy(key).orderBy(at)
    before = F.lag(value).over(w)
    calm = F.coalesce(F.abs(F.col(value) - before) < F.lit(change) * F.abs(before), F.lit(False))
    marked = series.withColumn("_calm", calm)
    run = F.sum(F.when(F.col("_calm"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    counted = marked.withColumn("_run", run).withColumn("_n", F.sum(F.col("_calm").cast("int")).over(Window.partitionBy(key, "_run").orderBy(at).rowsBetween(Window.unboundedPreceding, 0)))
    return counted.where(F.col("_n") >= times).groupBy(key).agg(F.min(at).alias("stable_at"))

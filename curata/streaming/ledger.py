"""A ledger of runs as a stream, and counts of events by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_runs(entries: DataFrame, at: str = "scored_at", delay: str = "30 days") -> DataFrame:
    """Each run's first entry; repeats that arrive within the delay are dropped, and the state of older ones is given up."""
    return entries.where("run_id is not null").withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark(["run_id", "benchmark"])


def window_counts(events: DataFrame, at: str = "ts", width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """window_start, event_type, n, total of a stream or table of events."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))  # a watermark needs a point in time
    grouped = timed.withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), "event_type")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


def keep_frontier(spark: SparkSession, path: str):
    """A foreachBatch function that merges each batch's scores into a stored frontier; a batch given twice changes nothing.

    Every version is written beside the last one, under the batch's number, and read from the highest complete one.
    """

    def versions() -> list[int]:
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = [s.getPath() for s in fs.listStatus(folder)]
        return sorted(int(p.getName()[1:]) for p in names if p.getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def merge(batch: DataFrame, number: int) -> None:
        scores = batch.groupBy("gpu_architecture", "benchmark").agg(F.max("score").alias("frontier"))
        old = [v for v in versions() if v < number]
        if old:
            scores = spark.read.parquet(f"{path}/v{old[-1]}").unionByName(scores).groupBy("gpu_architecture", "benchmark").agg(F.max("frontier").alias("frontier"))
        scores.coalesce(1).write.mode("overwrite").parquet(f"{path}/v{number}")

    merge.versions = versions
    return merge

"""Checks of an append-only registry. Validators gather issues in a column; they don't raise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

REQUIRED = ("miner", "hf_url", "trajectories_sha256", "rows_total", "dataset_version", "gpu_architecture")


def validated(registry: DataFrame) -> DataFrame:
    """line_no, issues (in a fixed order), n_issues."""
    missing = lambda c: F.col(c).isNull() | (F.col(c).cast("string").isin("", "0"))
    checks = [(missing(c), f"missing {c}") for c in REQUIRED]
    checks += [
        (F.length("trajectories_sha256").between(1, 63) | (F.length("trajectories_sha256") > 64), "digest length"),
        (F.coalesce(F.col("rows_total"), F.lit(0)) <= 0, "rows_total not positive"),
        (T.repository(F.col("hf_url")).isNull(), "not a dataset address"),
        (~missing("gpu_architecture") & T.architecture(F.col("gpu_architecture")).isNull(), "unknown architecture"),
    ]
    issues = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(message)) for bad, message in checks)))
    return registry.select("line_no", issues.alias("issues")).withColumn("n_issues", F.size("issues"))


def normalised(registry: DataFrame) -> DataFrame:
    """line_no, miner, url, repository, architecture in their normal forms."""
    return registry.select("line_no", T.strip(F.col("miner")).alias("miner"), T.url(F.col("hf_url")).alias("url"), T.repository(F.col("hf_url")).alias("repository"), T.architecture(F.col("gpu_architecture")).alias("architecture"))


def repeated(registry: DataFrame) -> DataFrame:
    """line_no, field, value: lines whose repository or digest stands in an earlier line. Malformed and missing ones repeat nothing."""
    pairs = registry.select(
        "line_no", F.inline(F.array(F.struct(F.lit("repository").alias("field"), T.repository(F.col("hf_url")).alias("value")), F.struct(F.lit("digest").alias("field"), F.when(F.col("trajectories_sha256") != "", F.col("trajectories_sha256")).alias("value"))))
    )
    pairs = pairs.where("value is not null")
    first = pairs.groupBy("field", "value").agg(F.min("line_no").alias("_first"))
    return pairs.join(first, ["field", "value"]).where("line_no > _first").select("line_no", "field", "value")


def appended(base: DataFrame, head: DataFrame) -> DataFrame:
    """place, line of the head that the base has not, repeats included; both have place and line."""
    return head.join(base.select("line").distinct(), "line", "left_anti").select("place", "line")


def rewritten(base: DataFrame, head: DataFrame) -> DataFrame:
    """place of every base line that the head doesn't have at the same place: empty for an append-only change."""
    return base.alias("b").join(head.alias("h"), "place", "left").where(~F.col("b.line").eqNullSafe(F.col("h.line"))).select("place")


def selected(registry: DataFrame, requested: DataFrame) -> DataFrame:
    """Registry lines of the requested digests (place, trajectories_sha256), in the order of the request, each once; of several lines of a digest the
    last counts."""
    wanted = requested.groupBy("trajectories_sha256").agg(F.min("place").alias("place"))
    last = registry.groupBy("trajectories_sha256").agg(F.max("line_no").alias("line_no"))
    return wanted.join(last, "trajectories_sha256").select("place", "line_no", "trajectories_sha256")


def requested_lines(registry: DataFrame, digests: DataFrame, miners: DataFrame) -> DataFrame:
    """place, line_no, trajectories_sha256: first the requested digests (place, trajectories_sha256) as `selected` has them, then all lines of the
    requested miners (place, miner), in the order of the request and of the registry, each digest once."""
    by_digest = selected(registry, digests).select(F.lit(0).alias("_part"), "place", "line_no", "trajectories_sha256")
    asked = miners.groupBy("miner").agg(F.min("place").alias("place"))
    by_miner = registry.where("trajectories_sha256 is not null").join(asked, "miner").select(F.lit(1).alias("_part"), "place", "line_no", "trajectories_sha256")
    by_miner = by_miner.join(by_digest.select("trajectories_sha256"), "trajectories_sha256", "left_anti")
    once = by_miner.groupBy("trajectories_sha256").agg(F.min(F.struct("place", "line_no")).alias("x")).select(F.lit(1).alias("_part"), "x.place", "x.line_no", "trajectories_sha256")
    return by_digest.unionByName(once).select(F.col("_part").alias("part"), "place", "line_no", "trajectories_sha256")


def unknown_requests(registry: DataFrame, requested: DataFrame, key: str) -> list[str]:
    """Requested digests, or miners, that the registry doesn't have: at most eight, for the message of an error."""
    lacking = requested.select(key).distinct().join(registry.select(key).distinct(), key, "left_anti")
    return [r[0] for r in lacking.orderBy(key).limit(8).collect()]


def single_additions(added: DataFrame, change: str) -> DataFrame:
    """change, n, single: added lines of each change, and whether it is exactly one."""
    return added.groupBy(change).agg(F.count(F.lit(1)).alias("n")).withColumn("single", F.col("n") == 1)


def line_of_manifest(manifests: DataFrame) -> DataFrame:
    """Registry lines of manifests (texts): miner, hf_url, trajectories_sha256, rows_total, dataset_version, gpu_architecture in their normal forms, and
    issues; rows_total has to be written as a whole number."""
    whole = F.when(F.trim("rows_total").rlike("^-?[0-9]+$"), F.trim("rows_total").try_cast("bigint"))
    rows = manifests.select(T.strip(F.col("miner")).alias("miner"), T.url(F.col("hf_url")).alias("hf_url"), "trajectories_sha256", whole.alias("rows_total"), "dataset_version", T.architecture(F.col("gpu_architecture")).alias("gpu_architecture"))
    bad = [(T.some(F.col("miner")).isNull(), "miner"), (T.repository(F.col("hf_url")).isNull(), "hf_url"), (~F.coalesce(F.length("trajectories_sha256") == 64, F.lit(False)), "trajectories_sha256"), (~F.coalesce(F.col("rows_total") > 0, F.lit(False)), "rows_total"), (F.col("gpu_architecture").isNull(), "gpu_architecture")]
    return rows.withColumn("issues", F.array_compact(F.array(*(F.when(b, F.lit(name)) for b, name in bad))))

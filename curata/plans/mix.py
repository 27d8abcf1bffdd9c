"""A mix of registry components with its manifest, and the check of a manifest."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedupe, near_mode, pins, records
from ..operators import registry as R
from ..session import materialise

VERSION = "1"


@dataclass
class Mix:
    """rows: row_index, component, line, id, messages; components: counters of each component; totals: one row."""

    rows: DataFrame
    components: DataFrame
    totals: DataFrame


def selection(registry: DataFrame, digests: list[str] | None = None, miners: list[str] | None = None) -> DataFrame:
    """Registry lines that a request names, digests first, in its order; line_no counts from 1 in that order. A digest or miner that the registry
    doesn't have is an error, as is an empty request."""
    if not digests and not miners:
        raise ValueError("name digests or miners")
    spark = registry.sparkSession
    asked = [spark.createDataFrame(list(enumerate(names or [])), f"place long, {key} string") for names, key in ((digests, "trajectories_sha256"), (miners, "miner"))]
    lacking = R.unknown_requests(registry, asked[0], "trajectories_sha256") + R.unknown_requests(registry, asked[1], "miner")
    if lacking:
        raise ValueError(f"not in the registry: {', '.join(lacking)}")
    chosen = dedupe.dense_index(R.requested_lines(registry, *asked).select("part", "place", "line_no"), "part", "place", "line_no", name="_index")
    return registry.join(chosen.select("line_no", "_index"), "line_no").withColumn("line_no", F.col("_index") + 1).select(*registry.columns)


def provenance(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """rows and metadata of the mix: miner, url and digest of the component's first registry line, row index, task id."""
    first = registry.where("trajectories_sha256 is not null").groupBy(F.lower("trajectories_sha256").alias("component")).agg(F.min_by(F.struct("miner", "hf_url"), "line_no").alias("_r"))
    mine = F.struct(F.col("_r.miner").alias("mix_source_miner"), F.col("_r.hf_url").alias("mix_source_hf_url"), F.col("component").alias("mix_source_sha256"), F.col("row_index").alias("mix_row_index"), F.col("task_id").alias("mix_task_id"))
    return rows.join(first, "component", "left").withColumn("metadata", mine).drop("_r")


def build(trajectory: DataFrame, registry: DataFrame, quota: int | None = None, mode: str = "exact") -> Mix:
    """The mix in registry and line order, with a mode of near_mode. Verdicts are written once, for three readers. A quota goes with 'exact' only."""
    rows = dedupe.placed(trajectory, registry)
    if quota is not None and mode != "exact":
        raise ValueError("a quota needs the mode 'exact'")
    if quota is not None:
        judged = dedupe.quota_mix(rows, quota)
    else:
        judged = dedupe.verdicts(rows) if mode == "exact" else near_mode.verdicts(rows, near_mode.key_prompts(trajectory), mode)
    judged = materialise(judged, "verdicts")
    counts = dedupe.counters(judged.where("verdict is not null"))
    every = dedupe.components(registry).withColumnRenamed("trajectories_sha256", "component")
    counters = every.join(counts, "component", "left").select("ord", "component", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts.columns[1:]))
    chosen = dedupe.dense_index(judged.where("verdict = 'selected'").select(*dedupe.PLACE, "component", "task_id"), *dedupe.PLACE)
    built = chosen.join(records.message_records(trajectory).dropDuplicates(["traj_id"]).withColumnRenamed("traj_id", "id"), "id").select("row_index", "component", "line", "id", "task_id", "messages")
    totals = counters.agg(*(F.sum(c).alias(c) for c in counts.columns[1:]), F.count_if(F.col("rows_selected") > 0).alias("components_used"))
    return Mix(built, counters, totals)


def manifest(mix: Mix, mix_id: str, created_at: str, max_components: int = 100_000) -> str:
    """The manifest as JSON. Components are lines of a registry; more than max_components don't belong into one document."""
    rows = mix.components.orderBy("ord").limit(max_components + 1).collect()
    if len(rows) > max_components:
        raise ValueError(f"more than {max_components} components")
    total = mix.totals.first().asDict()
    if not total["rows_selected"]:
        raise ValueError("no row was selected")
    body = {"mix_version": VERSION, "mix_id": mix_id, "created_at": created_at, "rows_total": total["rows_selected"], "dedupe_mode": "exact", "components": [{k: v for k, v in r.asDict().items() if k != "ord"} for r in rows]}
    return json.dumps(body, indent=2)


def check_manifest(text: str, registry: DataFrame, row_count: int, sft_sha256: str | None = None) -> list[str]:
    """What is wrong with a manifest: version, unknown components, another url or miner than the registry's, totals, and the digest of the mix's file if
    one is given."""
    try:
        body = json.loads(text)
    except ValueError:
        return ["not json"]
    issues = [] if body.get("mix_version") == VERSION else ["mix_version"]
    components = body.get("components") or []
    if not components:
        return [*issues, "no components"]
    spark = registry.sparkSession
    named = spark.createDataFrame([(c.get("component"),) for c in components], "component string")
    known = dedupe.components(registry).withColumnRenamed("trajectories_sha256", "component")
    issues += [f"unknown component {r[0]}" for r in named.join(known, "component", "left_anti").orderBy("component").collect()]
    if sum(c.get("rows_selected") or 0 for c in components) != body.get("rows_total"):
        issues.append("rows_selected do not add up to rows_total")
    if sft_sha256 is not None and body.get("sft_sha256") and body["sft_sha256"] != sft_sha256:
        issues.append("sft_sha256 is not the file's")
    described = spark.createDataFrame([(c.get("component"), c.get("hf_url"), c.get("miner")) for c in components], "trajectories_sha256 string, hf_url string, miner string")
    lines = registry.withColumn("trajectories_sha256", F.lower("trajectories_sha256"))
    for r in pins.checked_components(described, lines).where(F.size("issues") > 0).orderBy("trajectories_sha256").collect():
        issues += [f"{x} of {r['trajectories_sha256']}" for x in r["issues"] if x in ("hf_url", "miner")]
    if body.get("rows_total") != row_count:
        issues.append("rows_total is not the number of rows")
    return issues

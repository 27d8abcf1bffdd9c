"""Ordered de-duplication across components, and the mixes and snapshots built on it.

The order of records carries meaning: of the records with one key, the first that can be exported keeps it. Rows have the columns ord (place of
their component), line (place in it), id (breaks ties), key (null: never a duplicate) and exportable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialise

PLACE = ("ord", "line", "id")


def task_prompt() -> Column:
    return F.lower(T.strip(F.coalesce(T.some(F.col("metadata.prompt_meta.prompt"), F.col("prompt")), F.lit(""))))


def task_id() -> Column:
    return T.some(F.col("metadata.prompt_meta.task_id"), F.col("metadata.prompt_meta.problem_id"), F.col("metadata.task_id"))


def scope() -> Column:
    return F.coalesce(T.some(F.col("gpu_architecture"), F.col("metadata.prompt_meta.gpu_architecture")), F.lit(T.DEFAULT_ARCHITECTURE))


def dedupe_key() -> Column:
    """Digest of architecture and task prompt; null for an empty prompt. 32 bytes are shuffled in place of whole prompts."""
    prompt = task_prompt()
    return F.when(F.length(prompt) > 0, F.unhex(F.sha2(F.concat(scope(), F.lit(":"), prompt), 256)))


def exportable() -> Column:
    return F.col("response").isNotNull() & F.coalesce(F.col("sparkproof_validation.passed"), F.lit(True))


def first_by_key(lines: DataFrame, key: str, place: str) -> DataFrame:
    """The first line of each key, in place order; lines without a key are all kept."""
    first = lines.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(place).alias("_first"))
    kept = lines.join(first, key, "left").where(F.col("_first").isNull() | (F.col(place) == F.col("_first"))).drop("_first")
    return kept.select(*lines.columns)


def components(registry: DataFrame) -> DataFrame:
    """trajectories_sha256, ord: place of the first registry line of each digest."""
    digest = F.lower("trajectories_sha256")
    return registry.where("trajectories_sha256 is not null").groupBy(digest.alias("trajectories_sha256")).agg(F.min("line_no").alias("ord"))


def placed(trajectory: DataFrame, registry: DataFrame) -> DataFrame:
    """The narrow rows of a mix: component, ord, line, id, key, exportable, task_id. Rows of unknown components are left out, and a row given twice
    under one component, line and id counts once."""
    rows = trajectory.select(
        F.lower("trajectories_sha256").alias("component"), F.col("line_no").alias("line"), F.col("traj_id").alias("id"), dedupe_key().alias("key"), exportable().alias("exportable"), task_id().alias("task_id")
    )
    rows = rows.dropDuplicates(["component", "line", "id"])
    return rows.join(components(registry).withColumnRenamed("trajectories_sha256", "component"), "component")


def verdicts(rows: DataFrame, claim_unexportable: bool = False) -> DataFrame:
    """rows and verdict: 'selected', 'exact_skipped' or 'unexportable_skipped'.

    A row is skipped if an earlier one with its key was exported (with claim_unexportable: if there was any earlier one, as a snapshot has it).
    The earliest claimant of each key comes from an aggregation, combined before the shuffle, so a hot key costs one row a task; joining it back
    is an equi-join whose skewed partitions adaptive execution splits. No window holds a whole key.
    """
    place = F.struct(*PLACE)
    claim = F.lit(True) if claim_unexportable else F.col("exportable")
    first = rows.where(F.col("key").isNotNull() & claim).groupBy("key").agg(F.min(place).alias("_first"))
    late = F.coalesce(F.col("_first") < place, F.lit(False))
    verdict = F.when(late, "exact_skipped").when(F.lit(claim_unexportable) | F.col("exportable"), "selected").otherwise("unexportable_skipped")
    return rows.join(first, "key", "left").withColumn("verdict", verdict).select(*rows.columns, "verdict")


def counters(judged: DataFrame) -> DataFrame:
    """Rows of each component by verdict."""
    count = lambda v: F.count_if(F.col("verdict") == v)
    return judged.groupBy("component").agg(F.count(F.lit(1)).alias("rows_in_source"), count("selected").alias("rows_selected"), (count("exact_skipped") + count("near_skipped")).alias("rows_skipped_dedupe"), count("unexportable_skipped").alias("rows_skipped_unexportable"))


def dense_index(rows: DataFrame, *order: str, name: str = "row_index") -> DataFrame:
    """rows with their place from 0 in the order, without gaps: a range-partitioned sort and one offset a partition, no single-task window."""
    sorted_ = materialise(rows.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "sorted")
    sizes = {r[0]: r[1] for r in sorted_.groupBy("_part").count().collect()}
    offsets, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(part, 0)
    table = rows.sparkSession.createDataFrame(list(enumerate(offsets)), "_part int, _offset long")
    return sorted_.join(F.broadcast(table), "_part").withColumn(name, F.col("_at") + F.col("_offset")).drop("_part", "_at", "_offset")


def quota_mix(rows: DataFrame, quota: int, rounds: int | None = None) -> DataFrame:
    """verdicts of a mix that reads each component, in order, only until `quota` of its rows are selected. Rows never read have a null verdict.

    Rows after a component's quota leave their keys free for later components, so one pass over keys can't decide. Rounds do: each takes the
    accepted rows of the round before as the claims on keys and cuts every component at its quota anew. After k rounds the first k components
    are final, and mixes settle far earlier; a round that changes nothing ends the loop. Each round is one aggregation and one join.
    """
    place = F.struct("line", "id")
    own = rows.where("exportable and key is not null").groupBy("ord", "key").agg(F.min(place).alias("p"))
    keyless = rows.where("exportable and key is null").select("ord", F.lit(None).cast("binary").alias("key"), place.alias("p"))
    able = materialise(own.select("ord", "key", "p").unionByName(keyless), "able")
    accepted, step = None, 0
    while rounds is None or step < rounds:
        step += 1
        open_ = able
        if accepted is not None:
            taken = accepted.where("key is not null").groupBy("key").agg(F.min("ord").alias("taken"))
            open_ = able.join(taken, "key", "left").where(F.col("taken").isNull() | (F.col("taken") >= F.col("ord"))).select("ord", "key", "p")
        rank = F.row_number().over(Window.partitionBy("ord").orderBy("p"))
        now = materialise(open_.withColumn("_n", rank).where(F.col("_n") <= quota).select("ord", "key", "p"), "accepted")
        if accepted is not None and now.count() == accepted.count() and now.join(accepted, ["ord", "p"], "left_anti").isEmpty():
            break
        accepted = now
    last = accepted.groupBy("ord").agg(F.count(F.lit(1)).alias("_n"), F.max("p").alias("_last"))
    taken = accepted.where("key is not null").groupBy("key").agg(F.min(F.struct("ord", "p.line", "p.id")).alias("_first"))
    chosen = accepted.select(F.col("ord"), F.col("p.line").alias("line"), F.col("p.id").alias("id"), F.lit(True).alias("_chosen"))
    out = rows.join(last, "ord", "left").join(taken, "key", "left").join(chosen, ["ord", "line", "id"], "left")
    unread = (F.col("_n") >= quota) & (F.struct("line", "id") > F.col("_last"))
    verdict = F.when(F.coalesce(unread, F.lit(False)), F.lit(None)).when(F.col("_chosen"), "selected").when(F.coalesce(F.col("_first") < F.struct(*PLACE), F.lit(False)), "exact_skipped").otherwise("unexportable_skipped")
    return out.withColumn("verdict", verdict).select(*rows.columns, "verdict")

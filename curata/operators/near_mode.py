"""The 'near' mode of ordered de-duplication: a row is also skipped if an exported earlier row has a similar prompt in the same scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import dedupe

MODES = ("none", "exact", "near")


def mode_of(value: str | None) -> str:
    """A mode's name in any case and with outer blanks; anything else stands for 'exact'."""
    name = (value or "").strip().lower()
    return name if name in MODES else "exact"


def shingles(text: Column, width: int) -> Column:
    """The distinct runs of `width` words of a text, as hashes in order; none for a text with fewer words."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    starts = F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, width), " "))))


def similar_keys(prompts: DataFrame, threshold: float, width: int) -> DataFrame:
    """a, b of every two keys of one scope whose prompts have a similarity of the threshold or more, in both directions. prompts: key, scope, prompt.

    Two similar sets share one of the rarest n - ceil(t * n) + 1 of either's shingles; those meet, and candidates are verified by whole sets.
    """
    sets = materialise(prompts.select("key", "scope", shingles(F.col("prompt"), width).alias("s")).where(F.size("s") > 0), "shingles")
    each = sets.select("key", "scope", F.size("s").alias("n"), F.explode("s").alias("t"))
    common = each.groupBy("t").agg(F.count(F.lit(1)).alias("f"))
    ranked = each.join(common, "t").groupBy("key", "scope", "n").agg(F.array_sort(F.collect_list(F.struct("f", "t"))).alias("o"))
    prefix = materialise(ranked.select("key", "scope", "n", F.explode(F.slice("o", F.lit(1), F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1)).alias("p")).select("key", "scope", "n", "p.t"), "prefixes")
    a, b = (prefix.select("scope", "t", F.col("key").alias(k), F.col("n").alias(f"n{k}")) for k in "ab")
    fits = (F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb"))
    met = a.join(b, ["scope", "t"]).where(fits).select("a", "b").distinct()
    both = met.join(sets.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    near = both.where(shared >= F.lit(threshold) * (F.size("sa") + F.size("sb") - shared)).select("a", "b")
    return near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))


def verdicts(rows: DataFrame, prompts: DataFrame, mode: str = "near", threshold: float = 0.8, width: int = 5) -> DataFrame:
    """rows and verdict: those of dedupe.verdicts, and 'near_skipped'; with mode 'none' nothing is skipped as a repeat.

    A key is exported at its first exportable row unless a similar key was exported before. Whether it was may hang on a third key, so keys are
    settled in rounds: one without unsettled or exported earlier neighbours is exported, one with an exported earlier neighbour isn't. Each
    round settles at least the earliest open key of every chain, and the rounds end when none is open.
    """
    if mode == "none":
        return rows.withColumn("verdict", F.when(F.col("exportable"), "selected").otherwise("unexportable_skipped"))
    if mode == "exact":
        return dedupe.verdicts(rows)
    place = F.struct(*dedupe.PLACE)
    first = materialise(rows.where("key is not null and exportable").groupBy("key").agg(F.min(place).alias("p")), "first")
    links = materialise(similar_keys(prompts, threshold, width), "links")
    earlier = links.join(first.withColumnRenamed("key", "a"), "a").join(first.select(F.col("key").alias("b"), F.col("p").alias("pb")), "b").where("pb < p").select("a", "b")
    earlier = materialise(earlier, "earlier")  # b comes before a
    settled = first.join(earlier.select(F.col("a").alias("key")).distinct(), "key", "left_anti").select("key", F.lit(True).alias("out"))
    settled = materialise(settled, "settled")
    while True:
        open_ = earlier.join(settled.select(F.col("key").alias("a")), "a", "left_anti")
        if open_.isEmpty():
            break
        state = open_.join(settled.withColumnRenamed("key", "b"), "b", "left").groupBy("a").agg(F.coalesce(F.bool_or("out"), F.lit(False)).alias("hit"), F.count_if(F.col("out").isNull()).alias("waiting"))
        now = state.where("hit or waiting = 0").select(F.col("a").alias("key"), (~F.col("hit")).alias("out"))
        settled = materialise(settled.unionByName(now), "settled")
    exported = materialise(first.join(settled.where("out"), "key").select("key", "p"), "exported")
    near = links.join(exported.select(F.col("key").alias("b"), "p"), "b").groupBy(F.col("a").alias("key")).agg(F.min("p").alias("_near"))
    out = rows.join(exported.select("key", F.col("p").alias("_own")), "key", "left").join(near, "key", "left")
    late = lambda c: F.coalesce(F.col(c) < place, F.lit(False))
    verdict = F.when(late("_own"), "exact_skipped").when(late("_near"), "near_skipped").when(F.col("exportable"), "selected").otherwise("unexportable_skipped")
    return out.withColumn("verdict", verdict).select(*rows.columns, "verdict")


def key_prompts(trajectory: DataFrame) -> DataFrame:
    """key, scope, prompt of every distinct key of the rows."""
    rows = trajectory.select(dedupe.dedupe_key().alias("key"), dedupe.scope().alias("scope"), dedupe.task_prompt().alias("prompt"))
    return rows.where("key is not null").groupBy("key").agg(F.first("scope").alias("scope"), F.first("prompt").alias("prompt"))

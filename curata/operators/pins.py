"""Pins, manifests and claims held against them. Checks gather issues in a column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# The longest training in hours, and the tokens of the devices a training may use.
MOST_HOURS = 5.0
DEVICES = ("rtx pro 6000", "h100", "h200")
REPORT_FROM, REPORT_BYTES = 568, 64


def issues(*checks: tuple[Column, str]) -> Column:
    """Names of the checks that are true, in order; null is not true."""
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for bad, name in checks)))


def manifest_pins(reports: DataFrame) -> DataFrame:
    """reports and pins: a map of the snapshot fields that aren't null. reports: snapshot_sha256, snapshot_rows, task_ids_sha256, task_ids_rows."""
    names = ("snapshot_sha256", "snapshot_rows", "task_ids_sha256", "task_ids_rows")
    whole = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*(F.col(c).cast("string") for c in names)))
    return reports.withColumn("pins", F.map_filter(whole, lambda _, v: v.isNotNull()))


def canonical_pin(manifest: DataFrame, repo: str, hub: str = "https://hub.example/datasets/") -> DataFrame:
    """The pin of a manifest (mix_id, rows_total, sft_sha256): repo_id, url, mix_id, rows_total, sft_sha256. A manifest whose digest isn't of 64
    characters gives none."""
    return manifest.where(F.length("sft_sha256") == 64).select(F.lit(repo).alias("repo_id"), F.lit(hub + repo).alias("url"), "mix_id", "rows_total", "sft_sha256")


def against_pin(manifests: DataFrame, pin: DataFrame) -> DataFrame:
    """manifests (repo_id, rows_total, sft_sha256, ...) and issues against a pin of one row."""
    p = F.broadcast(pin.limit(1).select(*(F.col(c).alias(f"_{c}") for c in ("repo_id", "rows_total", "sft_sha256"))))
    differs = lambda c: F.col(f"_{c}").isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = manifests.crossJoin(p)  # one row
    return out.withColumn("issues", issues((differs("repo_id"), "repo_id"), (differs("sft_sha256"), "sft_sha256"), (differs("rows_total"), "rows_total"))).drop("_repo_id", "_rows_total", "_sft_sha256")


def checked_components(components: DataFrame, registry: DataFrame) -> DataFrame:
    """components (trajectories_sha256, hf_url, miner, ...) and issues: no digest, not in the registry, another url or miner than the registry's last
    line of the digest. A component without url or miner has none to compare."""
    last = registry.where("trajectories_sha256 is not null").groupBy("trajectories_sha256").agg(F.max_by(F.struct("hf_url", "miner"), "line_no").alias("_r"))
    out = components.join(last, "trajectories_sha256", "left")
    missing = T.some(F.col("trajectories_sha256")).isNull()
    unknown = ~missing & F.col("_r").isNull()
    other = lambda c: F.col("_r").isNotNull() & (T.some(F.col(c)) != F.col(f"_r.{c}"))
    return out.withColumn("issues", issues((missing, "no digest"), (unknown, "not in the registry"), (other("hf_url"), "hf_url"), (other("miner"), "miner"))).select(*components.columns, "issues")


def selected_of(components: DataFrame) -> DataFrame:
    """trajectories_sha256, rows_selected of the first component of each digest. components: place, trajectories_sha256, rows_selected."""
    return components.where("trajectories_sha256 is not null").groupBy("trajectories_sha256").agg(F.min_by("rows_selected", "place").alias("rows_selected"))


def training_issues(claims: DataFrame) -> DataFrame:
    """claims (hours, gpu, ...) and issues: hours missing or above MOST_HOURS, a device that isn't accepted."""
    low = F.lower(F.coalesce("gpu", F.lit("")))
    accepted = F.lit(False)
    for token in DEVICES:
        accepted = accepted | F.contains(low, F.lit(token))
    return claims.withColumn("issues", issues((F.col("hours").isNull(), "no hours"), (F.col("hours") > MOST_HOURS, "too long"), (~accepted, "device")))


def canonical_claims(claims: DataFrame, url: Column, allowed: DataFrame) -> DataFrame:
    """claims (dataset_url, sha256, ...) and issues: another address than the canonical one, trailing slashes aside, or a digest that isn't allowed
    (allowed: sha256)."""
    known = allowed.where("sha256 is not null").select("sha256", F.lit(True).alias("_known")).distinct()
    plain = lambda c: F.regexp_replace(c, "/+$", "")
    out = claims.join(known, "sha256", "left")
    return out.withColumn("issues", issues((~plain(F.col("dataset_url")).eqNullSafe(plain(url)), "dataset_url"), (F.col("_known").isNull(), "sha256"))).select(*claims.columns, "issues")


def recipe_paths(recipes: DataFrame, canonical: str) -> DataFrame:
    """recipe, at, path of every data set of a recipe (array of structs with path) that isn't the canonical one; blank paths are passed over."""
    each = recipes.select("recipe", F.posexplode("datasets").alias("at", "d")).select("recipe", "at", T.strip(F.col("d.path")).alias("path"))
    return each.where((F.col("path") != "") & (F.col("path") != canonical))


def map_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """path, change of every path on which two maps (path, sha256) differ: 'removed', 'added' or 'changed'."""
    both = old.select("path", F.struct("sha256").alias("a")).join(new.select("path", F.struct("sha256").alias("b")), "path", "full")
    change = F.when(F.col("b").isNull(), "removed").when(F.col("a").isNull(), "added").when(~F.col("a.sha256").eqNullSafe(F.col("b.sha256")), "changed")
    return both.select("path", change.alias("change")).where("change is not null")


def same_maps(old: DataFrame, new: DataFrame) -> bool | None:
    """Whether two maps are equal; None where one of them is empty and nothing can be compared."""
    if old.isEmpty() or new.isEmpty():
        return None
    return map_changes(old, new).isEmpty()


def proof_issues(bundles: DataFrame, files: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """bundle, issues. files: bundle, name, sha256, n_rows. bundles: bundle, passed, nonce, gate_passed, blocked_rows, gated_sha256, claimed_sha256,
    rows_total, gpu_architecture. A missing required file is the only issue of its bundle, as nothing else can be read then; a missing
    architecture stands for the default one."""
    wanted = bundles.select("bundle", F.explode(F.array(*map(F.lit, required))).alias("name"))
    missing = wanted.join(files.select("bundle", "name").distinct(), ["bundle", "name"], "left_anti").groupBy("bundle").agg(F.array_sort(F.collect_list(F.concat(F.lit("missing "), "name"))).alias("_missing"))
    main = files.where(F.col("name") == required[0]).groupBy("bundle").agg(F.min("sha256").alias("_sha"), F.max("n_rows").alias("_rows"))
    architecture = T.architecture(F.coalesce("gpu_architecture", F.lit(T.DEFAULT_ARCHITECTURE)))
    found = issues(
        (~F.coalesce("passed", F.lit(False)), "not passed"), (T.some(F.col("nonce")).isNull(), "no nonce"), (~F.coalesce("gate_passed", F.lit(False)), "gate not passed"), (F.col("blocked_rows") > 0, "blocked rows"),
        (T.some(F.col("gated_sha256")) != F.col("_sha"), "changed after the gate"), (T.some(F.col("claimed_sha256")) != F.col("_sha"), "not the claimed digest"),
        (F.coalesce("rows_total", F.lit(0)) != F.col("_rows"), "rows_total"), (architecture.isNull(), "unknown architecture"),
    )
    out = bundles.join(missing, "bundle", "left").join(main, "bundle", "left")
    return out.select("bundle", F.coalesce("_missing", found).alias("issues"))


def report_data(digest: Column) -> Column:
    """A digest in hexadecimal, filled up with zeros to the length of the report data of a quote."""
    return F.rpad(F.lower(digest), 2 * REPORT_BYTES, "0")


def quoted_data(quote: Column) -> Column:
    """The report data of a quote in base64, in hexadecimal; null for a quote that is too short or no base64."""
    raw = F.try_to_binary(quote, F.lit("base64"))
    return F.when(F.length(raw) >= REPORT_FROM + REPORT_BYTES, F.lower(F.hex(F.substring(raw, REPORT_FROM + 1, REPORT_BYTES))))


def token_payload(token: Column, schema: str) -> Column:
    """The payload of a signed token, not verified; null where it can't be read."""
    part = F.translate(F.try_element_at(F.split(token, r"\."), F.lit(2)), "-_", "+/")
    filled = F.rpad(part, (F.ceil(F.length(part) / 4) * 4).cast("int"), F.lit("="))
    return F.from_json(F.try_to_binary(filled, F.lit("base64")).cast("string"), schema)


def hardware_models(top: Column, devices: Column) -> Column:
    """The model of a claim and those of its devices (array of structs with hwmodel), in lower case, without nulls."""
    return F.transform(F.array_compact(F.concat(F.array(top), F.transform(F.coalesce(devices, F.array().cast("array<struct<hwmodel:string>>")), lambda d: d["hwmodel"]))), lambda m: F.lower(m))


def device_list(text: Column) -> Column:
    """Numbers of devices written as '0', '0,1' or '[0, 1]'; what isn't a number is left out."""
    return F.array_compact(F.transform(F.split(F.regexp_replace(text, r"[\[\]\s]", ""), ","), lambda x: x.try_cast("int")))


def replaced_labels(current: Column, known: Column, new: Column) -> Column:
    """Labels to take off: those of the current ones that are known and aren't given anew."""
    return F.array_except(F.array_intersect(current, known), new)

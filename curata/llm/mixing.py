"""Problem 7: a mix of sources with target shares of tokens.

Soft-membership mixing. Every document has a membership in each domain (a source of mix_target): its own source if that is one of them, else, if
it has no source, the posterior of a classifier fitted on all labelled documents. Rates say how often a document is used in the mean, from 0 to its
cap. They minimise the squared distance of the domains' expected tokens from their targets by projected gradient steps, each one pass over a
narrow table that returns one number a domain. Rates are then rounded to whole copies by error diffusion.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .encode import token_count
from .near import _batches
from .shingles import WORD

#: The classifier has a feature for each bucket of hashed words, and some for the form of a text.
BUCKETS = 128
#: It is fitted on at most so many labelled documents, drawn by a hash of their ids; with this many the model doesn't change with more.
FIT_ROWS = 20_000
#: Weight decay and passes of the fit.
DECAY, FIT_STEPS = 1e-3, 200
STEPS, TOLERANCE = 40, 1e-6
#: Documents of a source that are rounded together, about.
BUCKET_ROWS = 10_000
#: mix_target is a small table of the operator; more sources than this aren't taken for one.
MAX_DOMAINS = 5_000


def domains_of(mix_target: DataFrame) -> pd.DataFrame:
    """source (without case and outer white space), share, repeats of the targets, by name. A source named twice has its shares added and its larger repeats."""
    name = F.lower(F.trim(F.regexp_replace("source", r"^\s+|\s+$", "")))
    rows = mix_target.where("source is not null").groupBy(name.alias("source")).agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("repeats"))
    out = rows.orderBy("source").limit(MAX_DOMAINS + 1).toPandas()
    if len(out) > MAX_DOMAINS:
        raise ValueError(f"mix_target has more than {MAX_DOMAINS} sources")
    return out


class Model(NamedTuple):
    """Softmax regression: means and deviations of the features, weights, and which domains have documents."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    known: np.ndarray


def features(text: str | None) -> np.ndarray:
    """Roots of the shares of hashed words, and the form of a text: lengths, lines, marks, digits, distinct words."""
    text = text or ""
    words = [w.lower() for w in WORD.findall(text)]
    n, size = max(1, len(words)), max(1, len(text))
    shares = np.bincount([zlib.crc32(w.encode()) % BUCKETS for w in words], minlength=BUCKETS) / n
    lines = text.split("\n")
    form = [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), size / n, len(set(words)) / n, sum(map(str.isdigit, text)) / size, sum(map(str.isupper, text)) / size,
        "```" in text, text.startswith("#"), text.startswith("["), text.startswith(("From", "Subject")), 10 * text.count("?") / n, 10 * text.count("`") / size, 10 * text.count(":") / size, 10 * text.count("|") / size,
        sum(x.startswith(("- ", "* ")) for x in lines) / len(lines), sum(x.startswith("[") for x in lines) / len(lines), not text.isascii(), text.count(". ") / n,
    ]
    return np.concatenate([np.sqrt(shares), np.array(form, float)])


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit_classifier(labelled: DataFrame, n_domains: int) -> Model:
    """Softmax regression by gradient steps with momentum, on at most FIT_ROWS labelled documents (doc_id, domain, text)."""

    def run(iterator):
        for table in _batches(iterator, 2000):
            rows = [features(t) for t in table["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([table["domain"].combine_chunks(), pa.array(rows, pa.list_(pa.float64()))], ["domain", "x"])

    drawn = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS).select("domain", "text").mapInArrow(run, "domain int, x array<double>").toPandas()
    y = drawn["domain"].to_numpy(np.int64)
    known = np.bincount(y, minlength=n_domains) > 0
    width = len(features("")) + 1
    if not len(y):
        return Model(np.zeros(width - 1), np.ones(width - 1), np.zeros((width, n_domains)), known)
    x = np.array(drawn["x"].tolist())
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.hstack([(x - mean) / deviation, np.ones((len(x), 1))])
    weights, speed = np.zeros((x.shape[1], n_domains)), 0.0
    for _ in range(FIT_STEPS):
        slope = DECAY * weights
        for s in range(0, len(x), 5000):
            p = _softmax(np.where(known, x[s : s + 5000] @ weights, -np.inf))
            p[np.arange(len(p)), y[s : s + 5000]] -= 1
            slope = slope + x[s : s + 5000].T @ p / len(x)
        speed = 0.9 * speed - 0.05 * slope
        weights = weights + speed
    return Model(mean, deviation, weights, known)


def posterior(text: str | None, model: Model) -> np.ndarray:
    """Membership in each domain, 0 in one of which no document is known. All zero if none is."""
    if not model.known.any():
        return np.zeros(len(model.known))
    x = np.append((features(text) - model.mean) / model.deviation, 1.0)
    return _softmax(np.where(model.known, x @ model.weights, -np.inf)[None, :])[0]


def memberships(documents: DataFrame, domains: pd.DataFrame, soft: bool) -> DataFrame:
    """doc_id, domain (null for unlabelled), tokens, cap, membership (array of one entry a domain for unlabelled, null for labelled) of every
    document that may take part: with a target's source, and, if soft, those without any source. One row a doc_id."""
    spark = documents.sparkSession
    name = F.lower(F.trim(F.regexp_replace("source", r"^\s+|\s+$", "")))
    index = {s: k for k, s in enumerate(domains["source"])}
    place = F.create_map(*(F.lit(x) for pair in index.items() for x in pair)) if index else F.create_map().cast("map<string,int>")
    rows = documents.where("doc_id is not null").select("doc_id", F.when(name != "", name).alias("source"), "text")
    rows = rows.withColumn("domain", F.try_element_at(place, F.coalesce("source", F.lit(""))))
    rows = rows.where(F.col("domain").isNotNull() | (F.col("source").isNull() if soft else F.lit(False)))
    model = spark.sparkContext.broadcast(fit_classifier(rows.where("domain is not null"), len(domains))) if soft and len(domains) else None

    def run(iterator):
        for batch in iterator:
            out = [None if d is not None else posterior(t, model.value).tolist() for d, t in zip(batch.column("domain").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("domain"), batch.column("tokens"), pa.array(out, pa.list_(pa.float64()))], ["doc_id", "domain", "tokens", "membership"])

    rows = rows.select("doc_id", "domain", token_count(F.col("text")).alias("tokens"), "text")
    kept = rows.mapInArrow(run, "doc_id long, domain int, tokens int, membership array<double>") if model else rows.select("doc_id", "domain", "tokens", F.lit(None).cast("array<double>").alias("membership"))
    kept = kept.groupBy("doc_id").agg(F.min(F.struct("tokens", "domain", "membership")).alias("x")).select("doc_id", "x.*").where("tokens > 0")
    return materialise(kept, "members")


def _matrix(table: pa.Table, n: int) -> np.ndarray:
    out = np.zeros((table.num_rows, n))
    for k, (d, m) in enumerate(zip(table["domain"].to_pylist(), table["membership"].to_pylist())):
        if d is not None:
            out[k, d] = 1
        elif m is not None:
            out[k] = m
    return out


def _rates(member: np.ndarray, cap: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """The rates after the gradient steps so far, worked out anew from them: no state of documents is kept between passes."""
    r = np.zeros(len(member))
    for step in steps:
        r = np.clip(r - member @ step, 0, cap)
    return r


def _totals(members: DataFrame, repeats: np.ndarray, steps: list[np.ndarray], caps: bool = False) -> np.ndarray:
    """Expected tokens of each domain under the rates; with caps, under the caps."""
    n = len(repeats)

    def run(iterator):
        total = np.zeros(n)
        for table in _batches(iterator, 5000):
            member = _matrix(table, n)
            cap = member @ repeats
            rate = cap if caps else _rates(member, cap, steps)
            total += (rate * table["tokens"].to_numpy()) @ member
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total)], ["domain", "tokens"])

    rows = members.mapInArrow(run, "domain long, tokens double").groupBy("domain").agg(F.sum("tokens").alias("tokens")).toPandas()
    out = np.zeros(n)
    out[rows["domain"].to_numpy(np.int64)] = rows["tokens"].to_numpy(np.float64)
    return out


def fit_rates(members: DataFrame, domains: pd.DataFrame, total_tokens: float | None) -> tuple[list[np.ndarray], float]:
    """Gradient steps of the least squares fit, and the total. Without one it is the largest for which each domain with documents has its share."""
    share, repeats = domains["share"].to_numpy(float), domains["repeats"].to_numpy(float)
    most = _totals(members, repeats, [], caps=True)
    there = (most > 0) & (share > 0)
    total = total_tokens if total_tokens is not None else float((most[there] / share[there]).min()) if there.any() else 0.0
    target = share * total
    scale = np.where(most > 0, most / np.maximum(repeats, 1), 1.0)
    reach = np.minimum(target, most)
    steps: list[np.ndarray] = []
    have, best, rate = np.zeros(len(domains)), np.inf, 1.0
    for _ in range(STEPS):
        error = np.where(there, have - reach, have)
        worst = float(np.abs(error / np.maximum(reach, 1)).max(initial=0))
        if worst >= best:  # the step made it worse: it is taken back, and a shorter one tried
            rate /= 2
            steps[-1], error, worst = rate * last, before, best
            if rate < 1 / 64:
                steps.pop()
                break
            have = _totals(members, repeats, steps)
            continue
        if worst < TOLERANCE or worst > best * (1 - 1e-4):
            break
        best, before, last, rate = worst, error, error / scale, 1.0
        steps.append(last)
        have = _totals(members, repeats, steps)
    return steps, total


def residual(members: DataFrame, domains: pd.DataFrame, steps: list[np.ndarray], total: float) -> pd.DataFrame:
    """source, wanted, expected tokens of each domain under the fitted rates: how far the fit is from the targets."""
    have = _totals(members, domains["repeats"].to_numpy(float), steps)
    return pd.DataFrame({"source": domains["source"], "wanted": domains["share"] * total, "expected": have})


def _diffused(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies whose tokens stay within half a document of the sum of rate times tokens all along the bucket."""
    rows = rows.sort_values(["key", "doc_id"])
    copies, carried = [], 0.0
    for rate, tokens, cap in zip(rows["rate"], rows["tokens"], rows["cap"]):
        carried += rate * tokens
        n = int(min(max(0, np.floor(carried / tokens + 0.5)), np.floor(cap)))
        carried -= n * tokens
        copies.append(n)
    return rows.assign(copies=np.array(copies, np.int32))[["doc_id", "domain", "tokens", "copies"]]


def mix(documents: DataFrame, mix_target: DataFrame, total_tokens: float | None = None, soft: bool = False) -> DataFrame:
    """doc_id, source, n_tokens, copies (1 or more) of the documents in the mix.

    Sources are compared without case and outer white space. A document is used max_repeats times of its source at most; one without tokens,
    or of a source that has no target, not at all. With soft, documents without a source take part by their predicted memberships, and their
    source comes out null. Of rows under one doc_id one is used; empty tables give no rows. A target that its documents can't fill is filled
    as far as they go: `shares` says by how much it falls short.
    """
    domains = domains_of(mix_target)
    members = memberships(documents, domains, soft)
    steps, _ = fit_rates(members, domains, total_tokens)
    n, repeats = len(domains), domains["repeats"].to_numpy(float)

    def run(iterator):
        for table in _batches(iterator, 5000):
            member = _matrix(table, n)
            cap = member @ repeats
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), table["domain"].combine_chunks(), table["tokens"].combine_chunks(), pa.array(_rates(member, cap, steps)), pa.array(cap)], ["doc_id", "domain", "tokens", "rate", "cap"])

    rated = members.mapInArrow(run, "doc_id long, domain int, tokens int, rate double, cap double").where("rate > 0")
    sizes = {(-1 if r[0] is None else r[0]): max(1, r[1] // BUCKET_ROWS) for r in members.groupBy("domain").count().collect()}
    buckets = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair)) if sizes else F.create_map(F.lit(-1), F.lit(1))
    group = F.coalesce("domain", F.lit(-1))
    keyed = rated.withColumn("key", F.xxhash64("doc_id")).withColumn("bucket", F.pmod("key", F.try_element_at(buckets, group).cast("long"))).withColumn("part", group)
    whole = keyed.groupBy("part", "bucket").applyInPandas(_diffused, "doc_id long, domain int, tokens int, copies int").where("copies > 0")
    names = F.array(*(F.lit(s) for s in domains["source"])) if n else F.array().cast("array<string>")
    return whole.select("doc_id", F.try_element_at(names, F.col("domain") + 1).alias("source"), F.col("tokens").alias("n_tokens"), "copies")


def shares(mixed: DataFrame, mix_target: DataFrame) -> DataFrame:
    """source, target_share, max_repeats, n_documents, n_copies, tokens, reached_share (of the mix's tokens) of each target, and a row with a null
    source for documents without one, if the mix has any."""
    name = F.lower(F.trim(F.regexp_replace("source", r"^\s+|\s+$", "")))
    target = mix_target.where("source is not null").groupBy(name.alias("source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    got = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("copies").alias("n_copies"), F.sum(F.col("copies").cast("long") * F.col("n_tokens")).alias("tokens"))
    whole = got.agg(F.sum("tokens").alias("all_tokens"))
    out = target.join(got, "source", "full").crossJoin(F.broadcast(whole))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("source", "target_share", "max_repeats", zero("n_documents"), zero("n_copies"), zero("tokens"), F.coalesce(F.col("tokens") / F.nullif(F.col("all_tokens"), F.lit(0)), F.lit(0.0)).alias("reached_share"))

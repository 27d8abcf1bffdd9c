"""Problem 3: records that repeat another one with small edits.

Similarity joins by adaptive multi-match prefixes. Every record is a set of word shingles. Under one global order, rare shingles first, two
sets of similarity t or more share at least l shingles among the first n - ceil(t * n) + l of either, for every l up to ceil(t * n). A record
picks its l by the cost its prefix is estimated to cause; a pair has to share the smaller l of the two before it is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import shingles as S

#: A shingle in more than this share of all records counts as frequent: its estimated frequency then orders it behind all others.
FREQUENT = 1e-3
#: Frequent shingles kept for the order, the most frequent first. Their number is below (mean shingles of a record) / FREQUENT whatever the
#: size of the input; the limit guards the driver against very long texts. It changes the order, never the result.
MAX_FREQUENT = 500_000
#: Shared prefix shingles that are required at least (of records with so many shingles) and at most. One more lengthens a prefix by one shingle.
MIN_MATCHES, MAX_MATCHES = 3, 6
#: Of 128 bits, two of each of 64 minwise hashes, so many may differ. At similarity 0.7 the mean is 19.2 with deviation 4.8, so a pair is lost
#: with a probability of about one in ten million; at 0.75 or more under one in 10**9.
MAX_BITS = 44
#: Tables of at most so many ids are broadcast; larger ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _batches(iterator: Iterator[pa.RecordBatch], rows: int = 10_000, size: int = 16_000_000) -> Iterator[pa.Table]:
    """Arrow batches put together, or cut, to tables of so many rows or, if they get there earlier, about so many bytes: long arrays for numpy and a
    bound on memory for long texts, which are never cut themselves."""
    kept: list[pa.RecordBatch] = []
    n = held = 0
    for batch in iterator:
        step = batch.num_rows if batch.nbytes <= size else max(1, int(batch.num_rows * size / batch.nbytes))
        for start in range(0, batch.num_rows, max(1, step)):
            part = batch.slice(start, step)
            kept.append(part)
            n, held = n + part.num_rows, held + part.nbytes
            if n >= rows or held >= size:
                yield pa.Table.from_batches(kept)
                kept, n, held = [], 0, 0
    if kept:
        yield pa.Table.from_batches(kept)


def _texts(table: pa.Table) -> list[str]:
    return S.joined(table["prompt"].to_pylist(), table["response"].to_pylist())


def _records(df: DataFrame, id_col: str) -> DataFrame:
    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), "prompt", "response")


def survey(records: DataFrame, width: int) -> DataFrame:
    """One pass over all records: (id, h1, h2, null, null) for each record, (null, null, null, shingle, count) for each frequent one of a part."""

    def run(iterator):
        for table in _batches(iterator):
            words, counts = S.word_hashes(_texts(table))
            h = S.sequence_hash(words, counts)
            values, _ = S.shingles(words, counts, width)  # a shingle repeated in a text counts again: the order is all that depends on it
            yield pa.RecordBatch.from_arrays([table["id"].combine_chunks(), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.int64())], ["id", "h1", "h2", "shingle", "n"])
            value, n = np.unique(values, return_counts=True)
            keep = n >= max(2, FREQUENT / 2 * table.num_rows)
            none = pa.nulls(int(keep.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(value[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["id", "h1", "h2", "shingle", "n"])

    return records.mapInArrow(run, "id long, h1 long, h2 long, shingle long, n long")


def frequent_table(surveyed: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and their estimated frequency."""
    top = surveyed.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2, FREQUENT * total)).orderBy(F.desc("n"), "shingle").limit(MAX_FREQUENT).toPandas()
    value = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(value)
    return value[order], top["n"].to_numpy(np.int64)[order]


def prefixes(records: DataFrame, frequent, threshold: float, width: int, total: int) -> DataFrame:
    """token, id, pack (16 * shingles + required matches), bits1, bits2: one row for each shingle of a record's prefix.

    A token is the class of the shingle's estimated frequency (0: not frequent, else rising with its logarithm) before 56 bits of its hash, so
    that the order of tokens is the global order.
    """
    shared = records.sparkSession.sparkContext.broadcast(frequent)
    unit = max(1.0, FREQUENT * total)

    def run(iterator):
        known, freq = shared.value
        rank_of = np.minimum(127, 1 + 6 * np.log2(np.maximum(1.0, freq / unit))).astype(np.uint64)
        for table in _batches(iterator):
            words, counts = S.word_hashes(_texts(table))
            values, sizes = S.shingles(words, counts, width)
            if len(known):
                at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                ranks = np.where(known[at] == values, rank_of[at], np.uint64(0))
            else:
                ranks = np.zeros(len(values), np.uint64)
            tokens, sizes = S.distinct((ranks << np.uint64(56)) | (values >> np.uint64(8)), sizes)
            bits = S.low_bits(S.minwise(S.scramble(tokens), sizes, 64))
            ids = table["id"].to_numpy()
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            place = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)
            need = np.ceil(threshold * sizes - 1e-9).astype(np.int64)
            estimate = np.where(tokens >> np.uint64(56) > 0, 2.0 ** ((tokens >> np.uint64(56)).astype(np.float64) / 6), 0.0)
            cost = np.bincount(owner, np.where(place < (sizes - need + 1)[owner], estimate, 0), len(sizes))
            matches = np.minimum(np.minimum(MAX_MATCHES, MIN_MATCHES + np.log2(1 + cost).astype(np.int64)), np.maximum(1, need))
            keep = place < (sizes - need + matches)[owner]
            o = owner[keep]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tokens[keep].view(np.int64), ids[o], sizes[o] * 16 + matches[o], bits[o, 0], bits[o, 1])], ["token", "id", "pack", "bits1", "bits2"])

    return records.mapInArrow(run, "token long, id long, pack long, bits1 long, bits2 long")


def bits_apart(x: str, y: str, lanes: int = 2) -> F.Column:
    """Bits in which two fingerprints differ; columns x1, x2, ... and y1, y2, ..."""
    out = F.bit_count(F.col(f"{x}1").bitwiseXOR(F.col(f"{y}1")))
    for k in range(2, lanes + 1):
        out = out + F.bit_count(F.col(f"{x}{k}").bitwiseXOR(F.col(f"{y}{k}")))
    return out


def required(x: str, y: str, threshold: float) -> F.Column:
    """Prefix shingles that a pair of that similarity shares at least.

    Both prefixes hold the smaller l of the two. And of the shingles that the sets share, those beyond the prefix that ends first are no more
    than that record has left, so the prefixes share all others.
    """
    n = {k: F.shiftright(f"pack_{k}", 4) for k in (x, y)}
    matches = {k: F.col(f"pack_{k}").bitwiseAND(F.lit(15)) for k in (x, y)}
    left = {k: F.ceil(F.lit(threshold) * n[k] - F.lit(1e-9)) - matches[k] for k in (x, y)}
    overlap = F.ceil(F.lit(threshold / (1 + threshold)) * (n[x] + n[y]) - F.lit(1e-6))
    return F.greatest(F.least(matches[x], matches[y]), overlap - F.greatest(left[x], left[y]))


def shingle_table(records: DataFrame, width: int) -> DataFrame:
    """id and its distinct shingles."""

    def run(iterator):
        for table in _batches(iterator, 2000):
            words, counts = S.word_hashes(_texts(table))
            values, sizes = S.shingle_sets(words, counts, width)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays([table["id"].combine_chunks(), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))], ["id", "s"])

    return records.mapInArrow(run, "id long, s array<long>")


def only_ids(records: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Records whose id is (or, for left_anti, is not) in the written table ids; broadcast only behind a count."""
    return records.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def similarity() -> F.Column:
    both = F.size(F.array_intersect("sa", "sb"))
    return both / (F.size("sa") + F.size("sb") - both)


def verified(pairs: DataFrame, records: DataFrame, threshold: float, width: int) -> DataFrame:
    """a, b, similarity of the candidate pairs that reach the threshold, by their whole texts."""
    pairs = materialise(pairs, "pairs")
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    sets = shingle_table(only_ids(records, ids), width)
    sets = materialise(sets, "sets")
    out = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return out.groupBy("a", "b").agg(F.max(similarity()).alias("similarity")).where(F.col("similarity") >= threshold)


class NearDuplicates:
    """Groups and pairs of near duplicates of a table.

    Similarity is that of the sets of `width`-word shingles of prompt followed by response; null counts as the empty text. Records with the
    same word sequence form a class and are compared once, through the smallest id. Records under `width` words have no shingles and are
    similar to none. Rows with a null id are left out; a row given twice under one id counts once (with two texts, by the more similar one); other columns are not read; an empty table gives no rows.
    """

    def __init__(self, df: DataFrame, id_col: str, threshold: float = 0.7, width: int = 3):
        self.records = _records(df, id_col)
        self.threshold, self.width = threshold, width
        surveyed = materialise(survey(self.records, width), "survey")
        rows = surveyed.where("id is not null").select("id", "h1", "h2")
        total = rows.count()
        frequent = frequent_table(surveyed, total)
        classes = rows.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.max("id").alias("last")).where("rep < last")
        #: id, rep of every member, the representative included, of a class of two or more.
        self.members = materialise(rows.join(classes, ["h1", "h2"]).select("id", "rep").distinct(), "members")
        copies = materialise(self.members.where("id <> rep").select("id"), "copies")
        firsts = only_ids(self.records, copies, "left_anti")
        tokens = prefixes(firsts, frequent, threshold, width, total)
        a, b = (tokens.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("id", "pack")), *(F.col(f"bits{k}").alias(f"bits_{x}{k}") for k in (1, 2))) for x in "ab")
        na, nb = (F.shiftright(f"pack_{x}", 4) for x in "ab")
        close = (F.col("id_a") < F.col("id_b")) & (F.least(na, nb) >= F.lit(threshold) * F.greatest(na, nb)) & (bits_apart("bits_a", "bits_b") <= MAX_BITS)
        met = a.join(b, (a["token"] == b["token"]) & close).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "pack_a", "pack_b")
        shared = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("pack_a").alias("pack_a"), F.min("pack_b").alias("pack_b"))
        candidates = shared.where(F.col("shared") >= required("a", "b", threshold)).select("a", "b")
        #: a < b, similarity: pairs of class representatives.
        self.links = materialise(verified(candidates, firsts, threshold, width), "links")

    def groups(self) -> DataFrame:
        """id, class_id (smallest id of its copies), n_copies, n_links (other classes it is similar to) of every record."""
        links = self.links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
        sizes = self.members.groupBy("rep").agg(F.count(F.lit(1)).alias("n_copies"))
        reps = self.records.select("id").distinct().join(self.members.groupBy("id").agg(F.min("rep").alias("rep")), "id", "left").select("id", F.coalesce("rep", "id").alias("class_id"))
        out = reps.join(sizes.withColumnRenamed("rep", "class_id"), "class_id", "left").join(links.withColumnRenamed("rep", "class_id"), "class_id", "left")
        return out.select("id", "class_id", F.coalesce("n_copies", F.lit(1)).alias("n_copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"))

    def class_pairs(self) -> DataFrame:
        """a, b, similarity between class representatives; with `members` this holds every pair."""
        return self.links

    def pairs(self) -> DataFrame:
        """a < b of all similar records, copies included. The pairs inside a class and between classes are spelled out here and only here."""
        shown = only_ids(self.records, materialise(self.members.select(F.col("rep").alias("id")).distinct(), "reps"))
        worded = shingle_table(shown, self.width).where(F.size("s") > 0).select(F.col("id").alias("rep"))
        inside = self.members.join(worded, "rep")
        x, y = (inside.select("rep", F.col("id").alias(c)) for c in "ab")
        within = x.join(y, "rep").where("a < b").select("a", "b")
        of = self.members.select(F.col("rep"), "id")
        out = self.links.select("a", "b")
        for c in "ab":
            out = out.join(of.withColumnsRenamed({"rep": c, "id": "id_" + c}), c, "left").withColumn(c, F.coalesce("id_" + c, c)).drop("id_" + c)
        across = out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return within.unionByName(across)


def found(trajectory: DataFrame) -> DataFrame:
    return NearDuplicates(trajectory, "traj_id").pairs().select(F.col("a").alias("traj_id_a"), F.col("b").alias("traj_id_b"))

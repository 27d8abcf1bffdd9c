"""Problem 5: new batches against everything accepted before.

A record's bit-difference fingerprint holds BLOCKS blocks of bits, each made of a few low bits of PER_BLOCK minwise hashes of its three-word
shingles, and 256 further bits for the Hamming distance. The index stores fingerprints with all their blocks and is only ever appended to; for a
lookup each is given once for each block, rotated so that this block leads (the key is the block's number and value). A new record looks up its own
blocks by exact match, survivors of the Hamming test are verified by the whole set of shingles.

Bits of sums of signed hashes (the older kind of bit-difference fingerprint) differ in about 12 of 64 places at similarity 0.7, too many for
exact block matches; low bits of minwise hashes agree far more often in whole blocks, and their Hamming distance measures the similarity itself.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, scratch_dir, shuffles_dropped
from . import shingles as S
from .copies import bare, multiset_fingerprint
from .near import _batches, _texts, bits_apart, only_ids, similarity

#: With similarity 0.7 a block of four agrees with probability (0.7 + 0.3 / 64) ** 4 = 0.247, so all 36 fail with 0.00004; at 0.75 with 0.000002. Two
#: unrelated records share one of 36 blocks of 24 bits with a chance of one in 470,000.
BLOCKS, PER_BLOCK, BITS_EACH = 36, 4, 6
#: Of the 256 bits, two of each minwise hash, so many may differ. At similarity 0.7 the mean is 38.4 with deviation 6.8: one pair in ten million is lost.
BITS = ("bits1", "bits2", "bits3", "bits4")
MAX_BITS = 74
HISTORY, INCOMING = 0, 1
#: The tables of an index; a table without rows has no file to read its columns from.
TABLES = {
    "texts": "id long, prompt string, response string, part int",
    "copies": "id long, f1 long, f2 long, digest binary, part int",
    "prints": "h1 long, h2 long, id long, n long, " + "".join(f"{b} long, " for b in BITS) + "blocks array<int>, part int",
}


def ordered_history(trajectory: DataFrame) -> DataFrame:
    """part 0: all of it is earlier than any batch."""
    return trajectory.where("traj_id is not null").select(F.lit(HISTORY).alias("part"), F.col("traj_id").alias("id"), "prompt", "response")


def ordered_incoming(incoming: DataFrame) -> DataFrame:
    """part is the batch number (1 or more), so that (part, id) is the order of arrival; without one a record counts as the last batch's."""
    batch = F.coalesce(F.greatest(F.lit(INCOMING), F.col("batch_no").cast("int")), F.lit(2**31 - 1))
    return incoming.where("in_id is not null").select(batch.alias("part"), F.col("in_id").alias("id"), "prompt", "response")


def fingerprints(records: DataFrame, width: int = 3) -> DataFrame:
    """part, id, h1, h2 (word sequence), n (shingles), blocks (one number each), bits1 to bits4. Records without shingles have none."""

    def run(iterator):
        for table in _batches(iterator, 5000):
            words, counts = S.word_hashes(_texts(table))
            h = S.sequence_hash(words, counts)
            values, sizes = S.shingle_sets(words, counts, width)
            minima = S.minwise(values, sizes, BLOCKS * PER_BLOCK)
            low = ((minima * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS_EACH)).reshape(len(sizes), BLOCKS, PER_BLOCK)
            block = (low << (np.arange(PER_BLOCK, dtype=np.uint32) * np.uint32(BITS_EACH))).sum(axis=2).astype(np.int32) + (np.arange(BLOCKS, dtype=np.int32) << (BITS_EACH * PER_BLOCK))
            keep = sizes > 0
            block = block[keep]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, block.size + 1, BLOCKS, dtype=np.int32)), pa.array(block.ravel()))
            parts, ids = (table[c].to_numpy()[keep] for c in ("part", "id"))
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array(ids), *(pa.array(x[keep]) for x in (h[:, 0], h[:, 1], sizes)), lists, *(pa.array(x) for x in S.low_bits(minima[:, :128])[keep].T.copy())], ["part", "id", "h1", "h2", "n", "blocks", *BITS])

    return records.mapInArrow(run, "part int, id long, h1 long, h2 long, n long, blocks array<int>, " + ", ".join(f"{b} long" for b in BITS))


def first_of_each(prints: DataFrame) -> DataFrame:
    """The earliest record of each word sequence: later copies can't be the only earlier partner of any record."""
    return prints.groupBy("h1", "h2").agg(F.min(F.struct("part", "id", "n", *BITS, "blocks")).alias("x")).select("h1", "h2", "x.*")


def block_rows(prints: DataFrame, blocks: range, filter_: tuple[int, np.ndarray] | None = None) -> DataFrame:
    """block, part, id, n, bits: a row for each of these blocks, which is its key: the number of the block and its bits. The Hamming bits go along, so
    that pairs are tested where they meet: those that share a block grow with the square of the records, those that pass don't. With a filter, only of
    blocks that it may hold."""
    rows = prints.select("part", "id", F.col("n").cast("int").alias("n"), *BITS, F.slice("blocks", blocks.start + 1, len(blocks)).alias("blocks"))
    if filter_ is None:
        return rows.select(F.explode("blocks").alias("block"), "part", "id", "n", *BITS)
    width, marked = filter_[0], prints.sparkSession.sparkContext.broadcast(filter_[1])
    kept = ["part", "id", "n", *BITS]

    def run(iterator):
        for batch in iterator:
            lists = batch.column("blocks")
            block, counts = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            at = _place(block, width)
            keep = (marked.value[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & np.uint8(1) > 0
            owner = pa.array(np.repeat(np.arange(batch.num_rows), counts)[keep])
            yield pa.RecordBatch.from_arrays([pa.array(block[keep]), *(batch.column(c).take(owner) for c in kept)], ["block", *kept])

    return rows.mapInArrow(run, "block int, part int, id long, n int, " + ", ".join(f"{b} long" for b in BITS))


#: Bits of a batch's filter for each of its blocks, about, and the logarithm of the most that it has: 16 MB.
FILTER_BITS, FILTER_WIDTH = 16, 27
_PART_BYTES = 4096


def _place(block: np.ndarray, width: int) -> np.ndarray:
    return (block.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - width)


def rounds(probes: int) -> list[range]:
    """The blocks in the parts that are looked up one after the other: as many at once as a filter can tell apart for so many probes."""
    step = next((k for k in range(BLOCKS, 0, -1) if BLOCKS % k == 0 and FILTER_BITS * k * probes <= 1 << FILTER_WIDTH), 1)
    return [range(k, k + step) for k in range(0, BLOCKS, step)]


def block_filter(probes: DataFrame, blocks: range, number: int) -> tuple[int, np.ndarray]:
    """A bitmap of these blocks of a batch of so many probes, so that of the index only what the batch may meet is shuffled. It has a bounded size: a batch
    too large for it fills it up and lets more through, but loses nothing."""
    width = int(np.clip(np.ceil(np.log2(max(1, FILTER_BITS * len(blocks) * number))), 15, FILTER_WIDTH))

    def run(iterator):
        marked = np.zeros(1 << width, bool)
        for batch in iterator:
            marked[_place(batch.column(0).flatten().to_numpy(), width)] = True
        bits = np.packbits(marked, bitorder="little").reshape(-1, _PART_BYTES)
        used = np.flatnonzero(bits.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([bits[k].tobytes() for k in used], pa.binary())], ["at", "bits"])

    out = np.zeros((1 << width) // 8, np.uint8).reshape(-1, _PART_BYTES)
    for at, bits in probes.select(F.slice("blocks", blocks.start + 1, len(blocks)).alias("blocks")).mapInArrow(run, "at int, bits binary").groupBy("at").agg(F.bitmap_or_agg("bits").alias("bits")).collect():
        out[at] = np.frombuffer(bits, np.uint8)
    return width, out.ravel()


def shingle_rows(records: DataFrame, width: int) -> DataFrame:
    """part, id and its distinct shingles."""

    def run(iterator):
        for table in _batches(iterator, 2000):
            values, sizes = S.shingle_sets(*S.word_hashes(_texts(table)), width)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(table[c].combine_chunks() for c in ("part", "id")), lists], ["part", "id", "s"])

    return records.mapInArrow(run, "part int, id long, s array<long>")


def copy_prints(records: DataFrame) -> DataFrame:
    """part, id and fingerprint and digest of the letters and digits of prompt and of response, in order."""
    values = {"prompt": F.col("v0"), "response": F.col("v1")}
    rows = records.select("part", "id", bare(F.col("prompt")).alias("v0"), bare(F.col("response")).alias("v1"))
    return rows.select("part", "id", *multiset_fingerprint(values), F.unhex(F.sha2(F.concat_ws("|", F.sha2("v0", 512), F.sha2("v1", 512)), 256)).alias("digest"))


def lookup(index: DataFrame, probes: DataFrame, threshold: float) -> DataFrame:
    """id, i_fresh, i_part, i_id: probes and indexed records that share a block, fit in size and pass the Hamming test. A stored record is earlier
    than all probes, a fresh one by its part and id. Of pairs that only share a block none is written or shuffled."""
    number = probes.count()
    earlier = ~F.col("i_fresh") | (F.col("i_part") < F.col("part")) | ((F.col("i_part") == F.col("part")) & (F.col("i_id") < F.col("id")))
    fits = F.least("n", "i_n") >= F.lit(threshold) * F.greatest("n", "i_n")
    met = []
    for blocks in rounds(number):
        stored = block_rows(index.where("not fresh"), blocks, block_filter(probes, blocks, number)).withColumn("fresh", F.lit(False))
        fresh = block_rows(index.where("fresh"), blocks).withColumn("fresh", F.lit(True))
        a, b = block_rows(probes, blocks), stored.unionByName(fresh).select("block", *(F.col(c).alias(f"i_{c}") for c in ("fresh", "part", "id", "n", *BITS)))
        close = (a["block"] == b["block"]) & earlier & fits & (bits_apart("bits", "i_bits", 4) <= MAX_BITS)
        met.append(materialise(a.join(b, close).select("id", "i_fresh", "i_part", "i_id").distinct(), "met"))
    return reduce(DataFrame.unionByName, met).distinct()


def sent_again(incoming: DataFrame, registry: DataFrame) -> DataFrame:
    """Ids of incoming records under a digest that the registry has for history, whatever its case and outer blanks."""
    key = lambda c: F.lower(F.trim(c))
    known = registry.where("batch_no is null and trajectories_sha256 is not null").select(key("trajectories_sha256").alias("digest")).distinct()
    return incoming.where("in_id is not null").select(F.col("in_id").alias("id"), key("trajectories_sha256").alias("digest")).join(known, "digest", "left_semi").select("id").distinct()


def repeats(trajectory: DataFrame, incoming: DataFrame, registry: DataFrame, threshold: float = 0.7, width: int = 3) -> DataFrame:
    """in_id, kind ('exact' or 'near') of every incoming record that repeats an earlier one: a new index of `trajectory`, and HistoryIndex.repeats.

    Earlier are all of `trajectory`, all earlier batches and smaller ids of the same batch. A record under a digest of history counts as
    'exact'. Null texts count as empty; rows with a null id are left out; records without shingles can only be exact repeats; empty tables give
    no rows.
    """
    spark = trajectory.sparkSession
    index = HistoryIndex(spark, f"{scratch_dir(spark)}/index-{uuid.uuid4().hex[:12]}", threshold, width)
    index.append(ordered_history(trajectory))
    return index.repeats(incoming, registry).select(F.col("id").alias("in_id"), "kind")


class HistoryIndex:
    """The index as a stored table, for batches that come one after the other: `repeats` of a batch, or of several that wait, then `append` of their
    records; history isn't read again."""

    def __init__(self, spark, path: str, threshold: float = 0.7, width: int = 3):
        self.spark, self.path, self.threshold, self.width = spark, path.rstrip("/"), threshold, width

    def _has(self, table: str) -> bool:
        context = self.spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}/_SUCCESS")
        return target.getFileSystem(context._jsc.hadoopConfiguration()).exists(target)

    def _stored(self, table: str) -> DataFrame:
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.path}/{table}")

    def append(self, records: DataFrame) -> None:
        """Adds part, id, prompt, response records: texts and copy fingerprints of all, and the fingerprint of each new word sequence.

        Each table has a folder for each part, which a batch fills as a whole: a batch that is appended again, after a failure or by mistake, replaces
        its own rows and no others.
        """
        with shuffles_dropped(self.spark):
            firsts = first_of_each(fingerprints(records, self.width))
            if self._has("prints"):
                firsts = firsts.join(self._stored("prints").select("h1", "h2"), ["h1", "h2"], "left_anti")
            for table, rows in (("texts", records), ("copies", copy_prints(records)), ("prints", firsts)):
                kept = materialise(rows, "append") if table == "prints" and self._has("prints") else rows
                kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("part").parquet(f"{self.path}/{table}")

    def check(self, batch: DataFrame) -> DataFrame:
        """id, kind of the records (part, id, prompt, response) that repeat an indexed one. Repeats inside the batch and digests of history are
        left to `repeats`."""
        return self._find(batch, False, None)

    def repeats(self, incoming: DataFrame, registry: DataFrame) -> DataFrame:
        """id, kind of the incoming records, of one batch or several, that repeat an indexed one, one of an earlier batch or one of a smaller id of
        their own batch, or come under a digest that the registry has for history."""
        return self._find(ordered_incoming(incoming), True, sent_again(incoming, registry))

    def _find(self, new: DataFrame, within: bool, sent: DataFrame | None) -> DataFrame:
        with shuffles_dropped(self.spark):
            exact = self._exact(new, within)
            exact = materialise(exact if sent is None else exact.union(sent).distinct(), "exact")
            prints = materialise(fingerprints(new, self.width), "prints")
            keys = ["part", "id", "n", "blocks", *BITS]
            index = self._stored("prints").select(F.lit(False).alias("fresh"), *keys)
            if within:
                index = index.unionByName(materialise(first_of_each(prints), "firsts").select(F.lit(True).alias("fresh"), *keys))
            probes = materialise(prints.join(exact, "id", "left_anti"), "probes")
            near = self._near(materialise(lookup(index, probes, self.threshold), "pairs"), new)
        return exact.select("id", F.lit("exact").alias("kind")).unionByName(near.select("id", F.lit("near").alias("kind")))

    def _exact(self, new: DataFrame, within: bool) -> DataFrame:
        """Ids of the new records with an earlier copy: same letters and digits of prompt and of response, in order. Verified by digest."""
        mine = copy_prints(new).withColumn("place", F.struct(F.lit(True).alias("fresh"), "part", "id"))
        known = self._stored("copies").withColumn("place", F.struct(F.lit(False).alias("fresh"), "part", "id"))
        first = (known.unionByName(mine) if within else known).groupBy("f1", "f2", "digest").agg(F.min("place").alias("first"))
        return mine.join(first, ["f1", "f2", "digest"]).where(F.col("first") < F.col("place")).select("id").distinct()

    def _near(self, pairs: DataFrame, new: DataFrame) -> DataFrame:
        """Ids of the pairs that reach the threshold, by the whole sets of shingles of both."""
        new_ids = materialise(pairs.select("id").union(pairs.where("i_fresh").select("i_id")).distinct(), "ids")
        old_ids = materialise(pairs.where("not i_fresh").select(F.col("i_id").alias("id")).distinct(), "ids")
        mine = materialise(shingle_rows(only_ids(new, new_ids), self.width), "sets")
        sets = lambda rows, fresh: rows.select(F.lit(fresh).alias("i_fresh"), F.col("part").alias("i_part"), F.col("id").alias("i_id"), F.col("s").alias("sb"))
        indexed = sets(shingle_rows(only_ids(self._stored("texts"), old_ids).select("part", "id", "prompt", "response"), self.width), False).unionByName(sets(mine, True))
        out = pairs.join(mine.select("id", F.col("s").alias("sa")), "id").join(indexed, ["i_fresh", "i_part", "i_id"])
        return out.where(similarity() >= self.threshold).select("id").distinct()

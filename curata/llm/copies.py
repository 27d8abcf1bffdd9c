"""Problem 4: records that differ only in the way they are written."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

NOT_LETTER_OR_DIGIT = r"[^\p{L}\p{N}]+"


def bare(text: Column) -> Column:
    """Letters and digits of a text in lower case; null counts as the empty text."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_LETTER_OR_DIGIT, ""))


def multiset_fingerprint(fields: dict[str, Column]) -> list[Column]:
    """Two 64-bit lanes f1, f2 of the record's field-name and value pairs.

    Each pair is hashed by itself and the hashes are added modulo 2**64, so neither the order of the fields nor a sort plays a part.
    """
    lanes = []
    for lane, seed in (("f1", "a"), ("f2", "b")):
        total: Column | None = None
        for name, value in fields.items():
            part = F.xxhash64(F.lit(f"{seed}:{name}"), value).cast("decimal(38,0)")
            total = part if total is None else total + part
        # decimal(38,0) holds the sum of any real number of fields exactly; pmod folds it to 64 bits
        lanes.append((F.pmod(total, F.lit("18446744073709551616").cast("decimal(38,0)")) - F.lit("9223372036854775808").cast("decimal(38,0)")).cast("long").alias(lane))
    return lanes


#: Hexadecimal digits of a digest in each of its whole numbers, and how many of those are kept: 240 bits.
_DIGITS, LANES = 15, 4


def digest_lanes(values: list[Column]) -> list[Column]:
    """d1 to d4: 240 bits of a SHA-256 of the SHA-512 of each value, as whole numbers, which aggregate by hash where bytes would be sorted."""
    whole = F.sha2(F.concat_ws("|", *(F.sha2(v, 512) for v in values)), 256)
    return [F.conv(F.substring(whole, 1 + _DIGITS * k, _DIGITS), 16, 10).cast("long").alias(f"d{k + 1}") for k in range(LANES)]


def _prints(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """id, f1, f2, d1 to d4 of every row with an id."""
    values = {f: F.col(f"v{k}") for k, f in enumerate(fields)}
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), *(bare(F.col(f)).alias(f"v{k}") for k, f in enumerate(fields)))
    return rows.select("id", *multiset_fingerprint(values), *digest_lanes(list(values.values())))


def collapse_copies(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """One row for each record with copies: keep_id (smallest id), copy_id.

    Copies have, field by field, the same letters and digits in the same order, ignoring case and everything else. Nulls count as empty
    texts, so records with nothing in any field are copies of each other. A row delivered twice under one id yields no pair of an id with
    itself; rows with a null id are left out; an empty table gives no rows; other columns of df are not read.

    Fingerprints are aggregated before the shuffle, so a group that holds a third of all rows costs one row a task. Equality is then verified
    by digests of each normalised field (the texts are read once, fingerprints and digests are written); a fingerprint shared by different records
    is split by the digests themselves. Nothing is sorted to be grouped.
    """
    lanes = [f"d{k + 1}" for k in range(LANES)]
    rows = materialise(_prints(df, id_col, fields), "prints")
    spread = [f(d).alias(f"{name}_{d}") for d in lanes for f, name in ((F.min, "least"), (F.max, "most"))]
    groups = rows.groupBy("f1", "f2").agg(F.min("id").alias("keep_id"), F.max("id").alias("last"), *spread).where("keep_id < last")
    equal = F.lit(True)
    for d in lanes:
        equal = equal & (F.col(f"least_{d}") == F.col(f"most_{d}"))
    groups = groups.select("f1", "f2", "keep_id", equal.alias("equal"))
    copies = rows.join(groups, ["f1", "f2"]).distinct()  # rows given twice; they lie together already
    plain = copies.where("equal and id <> keep_id").select("keep_id", F.col("id").alias("copy_id"))
    mixed = copies.where("not equal")
    split = mixed.groupBy("f1", "f2", *lanes).agg(F.min("id").alias("keep_id"))
    split = mixed.drop("keep_id").join(split, ["f1", "f2", *lanes]).where("id <> keep_id").select("keep_id", F.col("id").alias("copy_id"))
    return plain.unionByName(split)


def copy_counts(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """One row for each distinct record: keep_id and n_copies, the number of records it stands for (itself included)."""
    keys = ["f1", "f2", *(f"d{k + 1}" for k in range(LANES))]
    return _prints(df, id_col, fields).groupBy(*keys).agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n_copies")).select("keep_id", "n_copies")


@F.pandas_udf(T.StructType([T.StructField("is_object", T.BooleanType()), T.StructField("prompt", T.StringType()), T.StructField("response", T.StringType())]))
def parse_record(line: pd.Series) -> pd.DataFrame:
    """Prompt and response of a JSON object; is_object is false for everything else. A value that is no string is written as JSON."""

    def one(text):
        try:
            value = json.loads(text)
        except (TypeError, ValueError, RecursionError):
            return False, None, None
        if not isinstance(value, dict):
            return False, None, None
        return True, *(v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in (value.get("prompt"), value.get("response")))

    out = [tuple(x.encode("utf-8", "replace").decode() if isinstance(x, str) else x for x in one(t)) for t in line]
    return pd.DataFrame(out, columns=["is_object", "prompt", "response"])


def raw_records(raw: DataFrame) -> DataFrame:
    """raw_id, prompt, response of the lines that hold a JSON object; broken, blank and null lines are left out."""
    return raw.select("raw_id", parse_record("line").alias("r")).where("r.is_object").select("raw_id", "r.prompt", "r.response")


def found(trajectory: DataFrame, raw: DataFrame) -> DataFrame:
    """src_table, keep_id, copy_id over both tables."""
    fields = ["prompt", "response"]
    parts = [collapse_copies(t, i, fields).select(F.lit(name).alias("src_table"), "keep_id", "copy_id") for name, t, i in (("trajectory", trajectory, "traj_id"), ("trajectory_raw", raw_records(raw), "raw_id"))]
    return parts[0].unionByName(parts[1])


def counts(trajectory: DataFrame, raw: DataFrame) -> DataFrame:
    """src_table, keep_id, n_copies over both tables."""
    fields = ["prompt", "response"]
    parts = [copy_counts(t, i, fields).select(F.lit(name).alias("src_table"), "keep_id", "n_copies") for name, t, i in (("trajectory", trajectory, "traj_id"), ("trajectory_raw", raw_records(raw), "raw_id"))]
    return parts[0].unionByName(parts[1])

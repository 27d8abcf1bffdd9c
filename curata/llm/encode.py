"""Problem 6: token ids of a corpus by a public byte-level tokenizer."""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_FILE = os.environ.get("CURATA_RANK_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")
MULTI_RANK_FILE = os.environ.get("CURATA_MULTI_RANK_FILE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: The published pre-splitting pattern of byte_bpe_50k (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts above this many characters are cut at safe boundaries into pieces of about this length before encoding.
PIECE_CHARS = 20_000
#: A single blank between two characters that aren't white space starts a new pre-token whatever surrounds it.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def encoding(rank_file: str = RANK_FILE):
    """The tokenizer of a local rank file, once for each Python worker."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """The text cut at safe boundaries; encoding the pieces one by one gives the ids of the whole."""
    out, start = [], 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size - 1)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def encode_text(text: str | None, rank_file: str = RANK_FILE) -> list[int]:
    """Ids without special tokens; the null and the empty text give the empty list; marker-like strings are ordinary text."""
    if not text:
        return []
    encode = encoding(rank_file).encode_ordinary
    if len(text) <= PIECE_CHARS:
        return encode(text)
    return [i for p in pieces(text) for i in encode(p)]


def decode_ids(ids, rank_file: str = RANK_FILE) -> bytes:
    """The bytes of the ids; a slice of ids may end inside a character, so bytes and not a text come out."""
    return b"".join(map(encoding(rank_file).decode_single_token_bytes, ids))


def ids_of(text: Column, rank_file: str = RANK_FILE) -> Column:
    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([encode_text(t, rank_file) for t in texts], dtype=object)

    return run(text)


def token_count(text: Column, rank_file: str = RANK_FILE) -> Column:
    """Number of ids of each text, without shipping the ids back to the JVM."""

    @F.pandas_udf("int")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([len(encode_text(t, rank_file)) for t in texts], dtype="int32")

    return run(text)


def text_of(ids: Column, rank_file: str = RANK_FILE) -> Column:
    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else decode_ids(x, rank_file).decode("utf-8", "replace") for x in lists], dtype=object)

    return run(ids)


def encode_documents(documents: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """doc_id and ids of every row: a narrow map without any shuffle."""
    return documents.select("doc_id", ids_of(F.col("text"), rank_file).alias("ids"))


def round_trip(documents: DataFrame, rank_file: str = RANK_FILE) -> DataFrame:
    """doc_id, n_ids, and whether the ids decode to the text again (null counts as the empty text)."""
    ids = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), ids_of(F.col("text"), rank_file).alias("ids"))
    return ids.select("doc_id", F.size("ids").alias("n_ids"), (text_of(F.col("ids"), rank_file) == F.col("text")).alias("same"))

"""BLEU and weighted n-gram recall of texts against references.

Candidate and reference stand in one row, so counts are taken row by row in Arrow batches: nothing but one small array a pair leaves a row, where a
join of exploded n-grams would shuffle every n-gram of the corpus.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS = 4
#: Added to a precision without matches.
EPSILON = 0.1
# The keywords of Python.
KEYWORDS = tuple("False None True and as assert async await break class continue def del elif else except finally for from global if import in is lambda nonlocal not or pass raise return try while with yield".split())

_KEYWORDS = frozenset(KEYWORDS)


def _tokens(text: str | None) -> list[str]:
    """The text cut at Unicode white space."""
    return (text or "").split()


def _grams(words: list[str], n: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(n))))


@F.pandas_udf(T.ArrayType(T.LongType()))
def counted(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    """Tokens of the candidate and of the reference, then clipped matches and total of the candidate's n-grams for n from 1 to ORDERS."""

    def one(c, r):
        cw, rw = _tokens(c), _tokens(r)
        out = [len(cw), len(rw)]
        for n in range(1, ORDERS + 1):
            cg, rg = _grams(cw, n), _grams(rw, n)
            out += [sum(min(k, rg[g]) for g, k in cg.items() if g in rg), max(0, len(cw) - n + 1)]
        return out

    return pd.Series([one(c, r) for c, r in zip(candidate, reference)], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def counted_many(candidate: pd.Series, references: pd.Series) -> pd.Series:
    """As `counted`, against several references: the second number is the length closest to the candidate's (of two, the shorter), and matches are
    clipped by the largest count of any reference. One order more than ORDERS is counted, for smoothing."""

    def one(c, several):
        cw, rws = _tokens(c), [_tokens(r) for r in several if r is not None] if several is not None else []
        out = [len(cw), min((len(r) for r in rws), key=lambda n: (abs(n - len(cw)), n), default=0)]
        for n in range(1, ORDERS + 2):
            most: Counter = Counter()
            for r in rws:
                most |= _grams(r, n)
            out += [sum(min(k, most[g]) for g, k in _grams(cw, n).items()), max(0, len(cw) - n + 1)]
        return out

    return pd.Series([one(c, r) for c, r in zip(candidate, references)], dtype=object)


def smoothed(counts: list[int], method: int, epsilon: float = EPSILON, alpha: float = 5, k: float = 5) -> float | None:
    """BLEU from the numbers of `counted_many` under one of the eight published smoothing methods (0: none). 0 without a common token; null where
    method 6 has no bigram in common, for which it isn't defined."""
    length, reference = counts[:2]
    hits, totals = counts[2::2], [max(1, t) for t in counts[3::2]]
    if not hits[0]:
        return 0.0
    p = [h / t for h, t in zip(hits[:ORDERS], totals)]
    if method == 0:
        p = [x or 2.2250738585072014e-308 for x in p]
    elif method == 1:
        p = [x or epsilon / t for x, t in zip(p, totals)]
    elif method == 2:
        p = [(h + 1) / (t + 1) for h, t in zip(hits[:ORDERS], totals)]
    elif method == 3:
        zeros = 0
        for n in range(ORDERS):
            if not hits[n]:
                zeros += 1
                p[n] = 1 / (2**zeros * totals[n])
    if method in (4, 7):
        for n in range(ORDERS):
            if not hits[n] and length > 1:
                p[n] = (n + k / math.log(length)) / totals[n]
    if method in (5, 7):
        following = [*p[1:], hits[ORDERS] / totals[ORDERS]]
        before = p[0] + 1
        for n in range(ORDERS):
            before = p[n] = (before + p[n] + following[n]) / 3
    if method == 6:
        if not hits[1]:
            return None
        for n in range(2, ORDERS):
            prior = p[n - 1] ** 2 / p[n - 2] if p[n - 2] else 0.0
            p[n] = (hits[n] + alpha * prior) / (max(0, length - n) + alpha)
    if min(p) <= 0:
        return 0.0
    penalty = 1.0 if length > reference else math.exp(1 - reference / length)
    return penalty * math.exp(math.fsum(math.log(x) for x in p) / ORDERS)


def smoothed_bleu(pairs: DataFrame, methods: tuple[int, ...] = tuple(range(8))) -> DataFrame:
    """key, method, bleu of each pair under each method. pairs: key, candidate, references (array)."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def all_methods(counts: pd.Series) -> pd.Series:
        return pd.Series([[smoothed([int(x) for x in c], m) for m in methods] for c in counts], dtype=object)

    scores = pairs.select("key", all_methods(counted_many("candidate", "references")).alias("x"))
    return scores.select("key", F.inline(F.arrays_zip(F.array(*map(F.lit, methods)).alias("method"), F.col("x").alias("bleu")))).toDF("key", "method", "bleu")


def _weighted(keyword_weight: float, other_weight: float):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def recall(candidate: pd.Series, reference: pd.Series) -> pd.Series:
        weight = lambda t: keyword_weight if t in _KEYWORDS else other_weight

        def one(c, r):
            cw, rw = _tokens(c), _tokens(r)
            cg, rg = _grams(cw, 1), _grams(rw, 1)
            out = [float(len(cw)), sum(weight(t) * min(k, cg[t,]) for (t,), k in rg.items()), sum(weight(t) * k for (t,), k in rg.items())]
            for n in range(2, ORDERS + 1):
                cg, rg = _grams(cw, n), _grams(rw, n)
                out += [float(sum(min(k, cg[g]) for g, k in rg.items())), float(max(0, len(rw) - n + 1))]
            return out

        return pd.Series([one(c, r) for c, r in zip(candidate, reference)], dtype=object)

    return recall


def _numbers(pairs: DataFrame) -> DataFrame:
    return pairs.select("key", counted("candidate", "reference").alias("x"))


def gram_counts(pairs: DataFrame) -> DataFrame:
    """key, n, matches (clipped by the reference), total for n from 1 to ORDERS. pairs: key, candidate, reference; null texts count as empty."""
    rows = F.array(*(F.struct(F.lit(n).alias("n"), F.col("x")[2 * n].alias("matches"), F.col("x")[2 * n + 1].alias("total")) for n in range(1, ORDERS + 1)))
    return _numbers(pairs).select("key", F.inline(rows))


def _bleu(at) -> Column:
    """BLEU from the numbers of `counted`, at(place): smoothed by EPSILON; 0 without a common token."""
    logs = sum((F.log(F.when(at(2 * n) > 0, at(2 * n)).otherwise(F.lit(EPSILON)) / F.greatest(at(2 * n + 1), F.lit(1))) for n in range(1, ORDERS + 1)), F.lit(0.0)) / ORDERS
    penalty = F.when(at(0) > at(1), 1.0).when(at(0) == 0, 0.0).otherwise(F.exp(1 - at(1) / F.nullif(at(0), F.lit(0))))
    return F.when(at(2) > 0, penalty * F.exp(logs)).otherwise(0.0)


def sentence_bleu(pairs: DataFrame) -> DataFrame:
    """key, bleu of each pair."""
    return _numbers(pairs).select("key", _bleu(lambda k: F.col("x")[k]).alias("bleu"))


def corpus_bleu(pairs: DataFrame) -> DataFrame:
    """One row, bleu: counts and lengths are added over all pairs before precisions are taken."""
    sums = _numbers(pairs).agg(*(F.coalesce(F.sum(F.col("x")[k]), F.lit(0)).alias(f"s{k}") for k in range(2 * ORDERS + 2)))
    return sums.select(_bleu(lambda k: F.col(f"s{k}")).alias("bleu"))


def weighted_recall(pairs: DataFrame, keyword_weight: float = 1.0, other_weight: float = 0.2) -> DataFrame:
    """key, recall (share of the reference's tokens found in the candidate, keywords weighing more; null without reference tokens), weighted_bleu: the
    mean of logarithms of that and of the plain recall of longer n-grams, smoothed by EPSILON, 0 without a common token. In place of the
    reference's length stands 2, the length of a pair of tokens and weights, so that only candidates of one token are penalised: scores on
    record were made so."""
    x = lambda k: F.col("x")[k]
    logs = F.lit(0.0)
    for n in range(1, ORDERS + 1):
        hit, whole = x(2 * n - 1), F.when(x(2 * n) > 0, x(2 * n)).otherwise(F.lit(1.0))
        logs = logs + F.log(F.when(hit > 0, hit).otherwise(F.lit(EPSILON)) / whole)
    penalty = F.when(x(0) > 2, 1.0).when(x(0) == 0, 0.0).otherwise(F.exp(1 - 2 / F.nullif(x(0), F.lit(0.0))))
    out = pairs.select("key", _weighted(keyword_weight, other_weight)("candidate", "reference").alias("x"))
    return out.select("key", (x(1) / F.nullif(x(2), F.lit(0.0))).alias("recall"), F.when(x(1) > 0, penalty * F.exp(logs / ORDERS)).otherwise(0.0).alias("weighted_bleu"))


def best_reference(pairs: DataFrame) -> DataFrame:
    """key, length, closest: tokens of the candidate, and the reference length closest to it (of two, the shorter). pairs: key, candidate, references."""
    return pairs.select("key", counted_many("candidate", "references").alias("x")).select("key", F.col("x")[0].alias("length"), F.col("x")[1].alias("closest"))


def code_bleu(parts: DataFrame, weights: tuple[float, float, float, float] = (0.25, 0.25, 0.25, 0.25)) -> DataFrame:
    """parts (bleu, weighted_bleu, syntax, dataflow) and code_bleu, their weighted sum; a missing part counts 0."""
    total = F.lit(0.0)
    for name, weight in zip(("bleu", "weighted_bleu", "syntax", "dataflow"), weights):
        total = total + F.coalesce(name, F.lit(0.0)) * weight
    return parts.withColumn("code_bleu", total)

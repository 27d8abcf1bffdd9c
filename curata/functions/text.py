"""Column functions on texts that keep the semantics of the records' origin: Unicode white space, emptiness as absence, ordered fallbacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character that counts as white space when a text is stripped; all of them lie below U+3001.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Architecture families and the tokens that stand for them in free text; the first family with a token wins.
ARCHITECTURES = ("blackwell", "hopper")
ARCHITECTURE_TOKENS = {"hopper": ("h100", "h200", "gh100", "gh200", "hopper"), "blackwell": ("rtx pro 6000", "gb20", "b200", "b300", "gb200", "gb102", "blackwell")}
DEFAULT_ARCHITECTURE = "blackwell"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def some(*columns: Column) -> Column:
    """The first column that is neither null nor the empty text."""
    return F.coalesce(*(F.when(c != "", c) for c in columns))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.length(strip(c)) == 0, F.lit(True))


def architecture(c: Column) -> Column:
    """Family of a free-text claim, or null."""
    low = F.lower(strip(c))
    out = F.when(low.isin(*ARCHITECTURES), low)
    for family, tokens in ARCHITECTURE_TOKENS.items():
        out = out.when(reduce(lambda a, b: a | b, (F.contains(low, F.lit(t)) for t in tokens)), F.lit(family))
    return out


def url(c: Column, hub: str = "https://hub.example/datasets/") -> Column:
    """Stripped, without trailing slashes, and with the hub's address before a bare repository name."""
    bare = F.regexp_replace(strip(c), "/+$", "")
    return F.when(bare.startswith("https://"), bare).otherwise(F.concat(F.lit(hub), F.regexp_replace(bare, "^/+", "")))


def repository(c: Column, hub: str = "https://hub.example/datasets/") -> Column:
    """owner/name of a hub address, or null."""
    return F.nullif(F.regexp_extract(strip(c), "^" + hub.replace(".", "\\.") + "([^/]+/[^/#?]+)", 1), F.lit(""))


# --- answers to arithmetic problems -------------------------------------------------------------------------------------------------------------
STRICT_ANSWER = r"#### (\-?[0-9\.\,]+)"
ANY_NUMBER = r"-?[$0-9.,]{2,}|-?[0-9]+"


def answer_of(text: Column) -> Column:
    """The number after the answer mark, else the last number of the text, else null."""
    return F.coalesce(F.nullif(F.regexp_extract(text, STRICT_ANSWER, 1), F.lit("")), F.try_element_at(F.regexp_extract_all(text, F.lit(ANY_NUMBER), 0), F.lit(-1)))


def plain_answer(answer: Column) -> Column:
    """An answer without separators, currency, what stands before the answer mark, and a final point."""
    bare = F.regexp_replace(F.regexp_replace(F.replace(F.replace(answer, F.lit(",")), F.lit("$")), r"(?s).*#### ", ""), r"\.$", "")
    return strip(bare)


def same_answer(gold: Column, given: Column) -> Column:
    """False where either is missing."""
    return F.coalesce(plain_answer(gold) == plain_answer(given), F.lit(False))


# --- code in texts ---------------------------------------------------------------------------------------------------------------------------
def code_of(text: Column) -> Column:
    """All python blocks, else all unnamed blocks, joined by an empty line; the whole text if there is none."""
    named = F.regexp_extract_all(text, F.lit("(?s)```python\\n(.*?)```"), 1)
    bare = F.regexp_extract_all(text, F.lit("(?s)```\\n(.*?)```"), 1)
    return F.when(F.size(named) > 0, F.array_join(named, "\n\n")).when(F.size(bare) > 0, F.array_join(bare, "\n\n")).otherwise(text)


def last_block(text: Column) -> Column:
    """What follows the last opening of a python block, without end marks."""
    return reduce(lambda c, mark: F.replace(c, F.lit(mark)), ("<|im_end|>", "<|EOT|>"), F.element_at(F.split(text, "```python"), -1))


def metric_of(values: Column, metric: str) -> Column:
    """A metric of a map whose keys may carry a filter: the bare key, then strict-match, then none, then the first other filter by name."""
    filters = F.array_sort(F.filter(F.map_keys(values), lambda k: k.startswith(metric + ",")))
    return F.coalesce(*(F.try_element_at(values, F.lit(k)) for k in (metric, f"{metric},strict-match", f"{metric},none")), F.try_element_at(values, F.try_element_at(filters, F.lit(1))))


def metric_named(values: Column, metric: Column) -> Column:
    """metric_of with a name that is a column."""
    filters = F.array_sort(F.filter(F.map_keys(values), lambda k: k.startswith(F.concat(metric, F.lit(",")))))
    return F.coalesce(*(F.try_element_at(values, k) for k in (metric, F.concat(metric, F.lit(",strict-match")), F.concat(metric, F.lit(",none")))), F.try_element_at(values, F.try_element_at(filters, F.lit(1))))


def indented(text: Column, prefix: str = "    ") -> Column:
    """Every line behind a prefix."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda line: F.concat(F.lit(prefix), line)), "\n")


def claims_architecture(claims: Column) -> Column:
    """Family of the first token in a struct of claims, written as JSON."""
    return architecture(F.to_json(claims))


def bundle_architecture(*claims: Column) -> Column:
    """The first claim that names a family, else the default one."""
    return F.coalesce(*map(architecture, claims), F.lit(DEFAULT_ARCHITECTURE))


def padded_grams(tokens: Column, n: int, left: str | None = None, right: str | None = None) -> Column:
    """The runs of n tokens, joined by blanks, with n - 1 marks before or after the tokens if they are given."""
    pad = lambda mark: F.array(*(F.lit(mark) for _ in range(n - 1))).cast("array<string>") if mark is not None else F.array().cast("array<string>")
    whole = F.concat(pad(left), tokens, pad(right))
    starts = F.when(F.size(whole) >= n, F.sequence(F.lit(1), F.size(whole) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(whole, i, n), " "))


def words(text: Column) -> Column:
    """The text cut at Unicode white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITE_SPACE) + "]+"), lambda w: w != "")

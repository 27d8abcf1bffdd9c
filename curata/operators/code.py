"""Heuristic scores of generated kernels."""

from __future__ import annotations

import ast
import io
import re
import tokenize
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Interfaces that are out of date or modern, and the weights of the scores.
DEPRECATED = ("tl.make_block_ptr", "tl.advance")
MODERN = ("tl.make_tensor_descriptor", "desc.load", "desc.store", "tl.float8e4nv", "tl.float8e5m2", "tl.associative_scan", "tl.reduce", "num_stages", "num_warps", "num_ctas")
MODERNITY = {"tl.make_tensor_descriptor": 0.15, "tl.float8e4nv": 0.10, "tl.associative_scan": 0.10, "num_stages": 0.05, "input_precision": 0.05, "tl.make_block_ptr": -0.15, "tl.advance": -0.10}
TARGETS = ("blackwell", "sm_120", "sm_121", "rtx 50", "sm120")
WEIGHTS = {"correctness": 0.35, "api_modernity": 0.20, "perf_awareness": 0.20, "completeness": 0.15, "code_quality": 0.10}


def _has(code: Column, *needles: str) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(code, F.lit(n)) for n in needles))


def _worth(condition: Column, value: float) -> Column:
    return F.when(condition, value).otherwise(0.0)


def interfaces(code: Column) -> Column:
    """struct of deprecated and modern interfaces used, and whether the code is modern."""
    used = lambda names: F.array_compact(F.array(*(F.when(_has(code, n), F.lit(n)) for n in names)))
    modern = _has(code, "@triton.jit") & _has(code, "tl.program_id") & ~_has(code, *DEPRECATED)
    return F.struct(used(DEPRECATED).alias("deprecated"), used(MODERN).alias("modern_used"), modern.alias("modern"))


def correctness(code: Column, passed: Column) -> Column:
    return F.when(~passed, 0.0).when(_has(code, "torch.allclose", "torch.testing.assert_close"), 1.0).when(code.rlike(r"(?m)^\s*assert\b"), 0.8).otherwise(0.5)


def api_modernity(code: Column) -> Column:
    total = reduce(lambda a, b: a + b, (_worth(_has(code, n), v) for n, v in MODERNITY.items()), F.lit(0.5))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))


def perf_awareness(code: Column) -> Column:
    checks = [_has(code, "@triton.autotune"), code.rlike(r"BLOCK_[MNK]\s*[=:]\s*\d+"), _has(code, "num_stages"), _has(code, "num_warps"), _has(code, "tl.dot("), _has(F.lower(code), *TARGETS)]
    return reduce(lambda a, b: a + b, (_worth(c, 1.0) for c in checks)) / len(checks)


def completeness(code: Column, required: Column | None = None) -> Column:
    """Four quarters; with an array of required patterns, the mean of that and of the share of patterns present."""
    checks = [_has(code, "@triton.jit"), _has(code, "def ") & _has(code, "grid"), _has(code, "torch.allclose", "assert"), _has(code, "@triton.autotune")]
    plain = reduce(lambda a, b: a + b, (_worth(c, 0.25) for c in checks))
    if required is None:
        return plain
    present = F.size(F.filter(required, lambda p: F.contains(code, p))) / F.nullif(F.size(required), F.lit(0))
    return F.when(F.coalesce(F.size(required), F.lit(0)) > 0, 0.5 * plain + 0.5 * present).otherwise(plain)


def code_quality(code: Column) -> Column:
    hashes = F.length(code) - F.length(F.replace(code, F.lit("#")))
    lines = F.size(F.split(F.btrim(code, F.lit(" \t\n\r\x0b\x0c")), "\n"))
    total = F.lit(0.5) + _worth(_has(code, '"""', "'''") | (hashes >= 3), 0.2) + _worth(_has(code, ": int", "tl.constexpr"), 0.15) + _worth(lines.between(20, 200), 0.15)
    return F.least(F.lit(1.0), total)


def scores(code: Column, passed: Column, required: Column | None = None) -> dict[str, Column]:
    """The five scores and composite_score."""
    parts = {"correctness": correctness(code, passed), "api_modernity": api_modernity(code), "perf_awareness": perf_awareness(code), "completeness": completeness(code, required), "code_quality": code_quality(code)}
    return parts | {"composite_score": reduce(lambda a, b: a + b, (parts[k] * w for k, w in WEIGHTS.items()))}


def _parsed(code: str | None):
    try:
        return ast.parse(code or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None


@F.pandas_udf(T.BooleanType())
def parses(code: pd.Series) -> pd.Series:
    """Whether the text is Python; null counts as the empty program."""
    return code.map(lambda c: _parsed(c) is not None, na_action=None).astype(bool)


@F.pandas_udf(T.StringType())
def definitions(code: pd.Series) -> pd.Series:
    """Only the imports and functions at the top of a program; the text itself where it isn't Python."""

    def one(c):
        tree = _parsed(c)
        if c is None or tree is None:
            return c
        return "\n\n".join(ast.unparse(n) for n in tree.body if isinstance(n, (ast.Import, ast.ImportFrom, ast.FunctionDef, ast.AsyncFunctionDef)))

    return code.map(one, na_action=None)


def _without_comments(code: str) -> str:
    """Python without comments, without strings that stand alone as a statement, and without blank lines; what isn't Python stays as it is."""
    tree = _parsed(code)
    if tree is None:
        return code
    try:
        tokens = list(tokenize.generate_tokens(io.StringIO(code).readline))
    except (tokenize.TokenError, IndentationError, SyntaxError):
        return code
    lines = code.splitlines(keepends=True)
    offset = [0]
    for line in lines:
        offset.append(offset[-1] + len(line))
    cuts = [(offset[t.start[0] - 1] + t.start[1], offset[t.end[0] - 1] + t.end[1]) for t in tokens if t.type == tokenize.COMMENT]
    alone = {(n.value.lineno, n.value.end_lineno) for n in ast.walk(tree) if isinstance(n, ast.Expr) and isinstance(n.value, ast.Constant) and isinstance(n.value.value, str)}
    cuts += [(offset[t.start[0] - 1] + t.start[1], offset[t.end[0] - 1] + t.end[1]) for t in tokens if t.type == tokenize.STRING and (t.start[0], t.end[0]) in alone and not lines[t.start[0] - 1][: t.start[1]].strip()]
    out, at = [], 0
    for start, end in sorted(cuts):
        out.append(code[at:start])
        at = end
    text = "".join([*out, code[at:]])
    return "\n".join(line.rstrip() for line in text.splitlines() if line.strip())


#: Strings and comments of languages in the manner of C; strings come first, so that marks inside them stay.
_C_STYLE = re.compile(r"""("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|/\*.*?\*/|//[^\n]*""", re.DOTALL)


def strip_comments(code: Column, language: str = "python") -> Column:
    """Code without comments and blank lines; 'ruby' has no rule and stays as it is; null stays null."""

    def one(text):
        if text is None or language == "ruby":
            return text
        if language == "python":
            return _without_comments(text)
        bare = _C_STYLE.sub(lambda m: m.group(1) or " ", text)
        return "\n".join(line for line in bare.split("\n") if line.strip())

    @F.pandas_udf(T.StringType())
    def stripped(c: pd.Series) -> pd.Series:
        return c.map(one, na_action=None)

    return stripped(code)


def subtrees(code: str | None) -> list[str]:
    """Shapes of all inner nodes of a program, without names and constants."""

    def shape(node) -> str:
        inner = [shape(c) for c in ast.iter_child_nodes(node)]
        name = type(node).__name__
        text = f"({name} {' '.join(inner)})" if inner else name
        if inner:
            out.append(text)
        return text

    out: list[str] = []
    tree = _parsed(code)
    if tree is not None:
        shape(tree)
    return out


def flows(code: str | None) -> list[tuple[str, str]]:
    """(target, source) for every assignment of a program, names numbered by first use."""
    tree = _parsed(code)
    if tree is None:
        return []
    numbers: dict[str, str] = {}
    name = lambda n: numbers.setdefault(n, f"var_{len(numbers)}")
    names = lambda node: [n.id for n in ast.walk(node) if isinstance(n, ast.Name)]
    out = []
    for node in ast.walk(tree):
        if isinstance(node, (ast.Assign, ast.AugAssign, ast.AnnAssign)) and node.value is not None:
            targets = node.targets if isinstance(node, ast.Assign) else [node.target]
            for source in names(node.value):
                s = name(source)
                out.extend((name(t), s) for target in targets for t in names(target))
    return out


@F.pandas_udf(T.DoubleType())
def syntax_match(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    """Share of the reference's subtrees that the candidate has; null without any."""

    def one(c, r):
        want, have = subtrees(r), set(subtrees(c))
        return sum(t in have for t in want) / len(want) if want else None

    return pd.Series([one(c, r) for c, r in zip(candidate, reference)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def dataflow_match(candidate: pd.Series, reference: pd.Series) -> pd.Series:
    """Share of the reference's flows that the candidate has, each of the candidate's used once; null without any."""

    def one(c, r):
        want, have = flows(r), flows(c)
        hit = 0
        for w in want:
            if w in have:
                have.remove(w)
                hit += 1
        return hit / len(want) if want else None

    return pd.Series([one(c, r) for c, r in zip(candidate, reference)], dtype="float64")

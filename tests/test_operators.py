import math

import pytest
from pyspark.sql import functions as F

from curata.functions import text as T
from curata.operators import code, records, registry, reports, scoring, similarity


def one(spark, column, **values):
    types = {str: "string", float: "double", int: "long", bool: "boolean", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text", ["\t a ", "　b\x85", "\x1cc\x1f", " \n", "", "d"])
def test_strip(spark, text):
    assert one(spark, T.strip(F.col("t")), t=text) == text.strip()


@pytest.mark.parametrize(("text", "family"), [("blackwell", "blackwell"), (" BLACKWELL", "blackwell"), ("Hopper-H100", "hopper"), ("RTX PRO 6000", "blackwell"), ("GB200 with H100", "hopper"), ("ampere", None), ("", None), (None, None)])
def test_architecture(spark, text, family):
    assert one(spark, T.architecture(F.col("t")), t=text) == family


@pytest.mark.parametrize(
    ("text", "answer", "plain"),
    [("so #### 18", "18", "18"), ("it is $70,000.", "$70,000.", "70000"), ("first 3, then 42.", "42.", "42"), ("none", None, None), ("#### -1,200 and 5", "-1,200", "-1200")],
)
def test_answers(spark, text, answer, plain):
    a = T.answer_of(F.col("t"))
    assert one(spark, a, t=text) == answer and one(spark, T.plain_answer(a), t=text) == plain


def test_same_answer(spark):
    assert one(spark, T.same_answer(F.col("a"), F.col("b")), a="#### 1,000", b="1000.") is True
    assert one(spark, T.same_answer(F.col("a"), F.col("b")), a="1", b=None) is False


def test_code_blocks(spark):
    assert one(spark, T.code_of(F.col("t")), t="x\n```python\na\n```\ny\n```python\nb\n```") == "a\n\n\nb\n"
    assert one(spark, T.code_of(F.col("t")), t="```\na\n```") == "a\n" and one(spark, T.code_of(F.col("t")), t="plain") == "plain"
    assert one(spark, T.last_block(F.col("t")), t="```python\na```python\nb<|im_end|>") == "\nb"


def test_metric_lookup(spark):
    df = spark.createDataFrame([({"acc,none": 0.1, "acc,z": 0.3},), ({"acc": 0.2, "acc,none": 0.1},), ({"acc,z": 0.3, "acc,b": 0.4},), ({},), (None,)], "m map<string,double>")
    assert [r[0] for r in df.select(T.metric_of(F.col("m"), "acc")).collect()] == [0.1, 0.2, 0.4, None, None]


def test_records(spark):
    schema = "traj_id long, prompt string, response string, reasoning string, system string, metadata struct<prompt_meta:struct<prompt:string>>, sparkproof_validation struct<passed:boolean>"
    rows = [(1, " p ", " r ", " z ", "s", (("task",),), None), (2, "p", "r", " ", "", ((None,),), (True,)), (3, "p", None, None, None, None, None), (4, "p", "r", None, None, None, (False,))]
    df = spark.createDataFrame(rows, schema)
    out = {r["traj_id"]: [tuple(m) for m in r["messages"]] for r in records.message_records(df).collect()}
    assert out == {1: [("system", "s"), ("user", "task"), ("assistant", "<think>\nz\n</think>\n\nr")], 2: [("user", "p"), ("assistant", "r")]}
    assert {r["traj_id"]: (r["prompt"], r["response"]) for r in records.alpaca(df).collect()} == {1: (" p ", "<think>\nz\n</think>\n\nr"), 2: ("p", "r"), 4: ("p", "r")}


def test_registry(spark):
    sha = "a" * 64
    rows = [(1, "m", "https://hub.example/datasets/o/n/", sha, 5, "v", "hopper"), (2, None, "nowhere", "abc", 0, "", "ampere"), (3, "m", "https://hub.example/datasets/o/n", sha, None, "v", None)]
    df = spark.createDataFrame(rows, "line_no long, miner string, hf_url string, trajectories_sha256 string, rows_total long, dataset_version string, gpu_architecture string")
    issues = {r["line_no"]: r["issues"] for r in registry.validated(df).collect()}
    assert issues[1] == [] and issues[2] == ["missing miner", "missing rows_total", "missing dataset_version", "digest length", "rows_total not positive", "not a dataset address", "unknown architecture"]
    assert {(r["line_no"], r["field"]) for r in registry.repeated(df).collect()} == {(3, "repository"), (3, "digest")}
    assert [r["url"] for r in registry.normalised(df).orderBy("line_no").collect()] == ["https://hub.example/datasets/o/n", "https://hub.example/datasets/nowhere", "https://hub.example/datasets/o/n"]
    lines = lambda *x: spark.createDataFrame(list(enumerate(x)), "place long, line string")
    assert registry.rewritten(lines("a", "b"), lines("a", "b", "c")).count() == 0
    assert [r[0] for r in registry.rewritten(lines("a", "b"), lines("a")).collect()] == [1]
    assert sorted(r["line"] for r in registry.appended(lines("a"), lines("a", "c", "c")).collect()) == ["c", "c"]


@pytest.mark.parametrize(("candidate", "frontier", "delta"), [(0.0, 0.0, 0.0), (0.1, 0.0, math.inf), (0.5, 0.4, 25.0), (0.3, 0.4, -25.0)])
def test_pct_delta(spark, candidate, frontier, delta):
    assert one(spark, scoring.pct_delta(F.col("c"), F.col("f")), c=candidate, f=frontier) == pytest.approx(delta)


def test_regressions(spark):
    s = spark.createDataFrame([("r", "h", "gsm8k", 0.985), ("r", "h", "triton", 0.6), ("q", "h", "gsm8k", 0.985), ("q", "h", "bfcl", 0.5)], "run_id string, gpu_architecture string, benchmark string, score double")
    base = spark.createDataFrame([("h", "gsm8k", 1.0), ("h", "triton", 0.5), ("h", "bfcl", 0.5)], "gpu_architecture string, benchmark string, frontier double")
    out = {(r["run_id"], r["benchmark"]): r["regression"] for r in scoring.against_frontier(s, base).collect()}
    assert out == {("r", "gsm8k"): False, ("r", "triton"): False, ("q", "gsm8k"): True, ("q", "bfcl"): False}


def test_scores(spark):
    rows = [("a", "h", "triton", 0.5, 1), ("a", "h", "triton", 0.4, 2), ("a", "h", "triton", 88.0, 3), ("a", "h", "triton", float("nan"), 4), ("a", "h", "other", 0.1, 5), (None, "h", "triton", 0.1, 6), ("a", "h", "gsm8k", None, 7)]
    df = spark.createDataFrame(rows, "run_id string, gpu_architecture string, benchmark string, score double, scored_at long")
    assert [(r["benchmark"], r["score"]) for r in scoring.run_scores(df).collect()] == [("triton", 0.4)]
    assert {(r["benchmark"], r["n"]) for r in scoring.invalid_scores(df).collect()} == {("triton", 2), ("gsm8k", 1)}


def test_reports(spark):
    d = spark.createDataFrame([("1", True, 1.0), ("bugfix", False, None), (None, True, 0.5)], "level string, passed boolean, score double")
    assert {r["level"]: (r["n"], r["mean_score"]) for r in reports.by_level(d).collect()} == {"1": (1, 1.0), "bugfix": (1, 0.0), "none": (1, 0.5), "all": (3, 0.5)}
    assert reports.quick_mean(d).first()[0] == 0.5 and reports.quick_mean(d.limit(0)).first()[0] is None
    s = spark.createDataFrame([("k", i, v) for i, v in enumerate([1.0, 2.0, 2.00001, 2.00001, 2.00002, 9.0])], "key string, at long, value double")
    assert reports.first_stable(s, "key", "at", "value").first()["stable_at"] == 4
    t = spark.createDataFrame([("a", 10.0, 1.0), ("b", 3.0, 2.0), ("c", 1.0, 0.0), ("d", 0.1, 10.0)], "file string, reference_ms double, candidate_ms double")
    assert {r["file"]: r["speedup"] for r in reports.speedups(t).collect()} == {"b": 1.5}


def test_code_scores(spark):
    text = "@triton.jit\ndef k(x, n: tl.constexpr):\n    tl.program_id(0)\n    tl.advance(x)\n# a\n# b\n# c\ngrid = 1\nassert True\n"
    got = {k: one(spark, v, c=text, p=True) for k, v in code.scores(F.col("c"), F.col("p")).items()}
    assert got["correctness"] == 0.8 and got["api_modernity"] == pytest.approx(0.4) and got["perf_awareness"] == 0 and got["completeness"] == 0.75 and got["code_quality"] == pytest.approx(0.85)
    assert got["composite_score"] == pytest.approx(0.8 * 0.35 + 0.4 * 0.2 + 0.75 * 0.15 + 0.085)
    assert one(spark, code.interfaces(F.col("c")), c=text)["modern"] is False
    assert one(spark, code.parses(F.col("c")), c="def f(:") is False and one(spark, code.parses(F.col("c")), c=None) is True
    assert one(spark, code.definitions(F.col("c")), c="import a\nx = 1\ndef f():\n    pass") == "import a\n\ndef f():\n    pass"
    assert one(spark, code.syntax_match(F.col("a"), F.col("b")), a="x = y + 1", b="u = v + 2") == 1.0
    assert one(spark, code.dataflow_match(F.col("a"), F.col("b")), a="x = y", b="u = v\nw = v") == 0.5
    assert one(spark, code.syntax_match(F.col("a"), F.col("b")), a="x", b=None) is None


def test_similarity(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat", "the cat sat on the mat"), (2, "a b", "c d e"), (3, None, "x"), (4, "if x", "if x return y")], "key long, candidate string, reference string")
    bleu = {r["key"]: r["bleu"] for r in similarity.sentence_bleu(df).collect()}
    assert bleu[1] == pytest.approx(1.0) and bleu[2] == 0 and bleu[3] == 0
    counts = {(r["key"], r["n"]): (r["matches"], r["total"]) for r in similarity.gram_counts(df).collect()}
    assert counts[1, 4] == (3, 3) and counts[2, 1] == (0, 2) and counts[3, 1] == (0, 0)
    recall = {r["key"]: r["recall"] for r in similarity.weighted_recall(df).collect()}
    assert recall[4] == pytest.approx(1.2 / 2.4) and recall[3] == 0
    assert 0 < similarity.corpus_bleu(df).first()["bleu"] < 1
    assert similarity.corpus_bleu(df.limit(0)).first()["bleu"] == 0

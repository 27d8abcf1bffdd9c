"""Samples, claims, pins and texts on small tables with nulls, repeats and clashing names."""

import base64
import json
import random

import pytest
from pyspark.sql import functions as F

from curata.functions import text as T
from curata.operators import code, dedupe, near_mode, pins, registry, reports, samples, similarity
from curata.plans import mix


def test_sample_coverage(spark):
    problems = spark.createDataFrame([("a", "#### 1"), ("b", "#### 2"), ("c", "3")], "problem string, gold string").withColumn("sample", F.lit("clash"))
    rows = [("whole", "a", "1"), ("whole", "b", "so 2."), ("whole", "c", "4"), ("forged", "a", "1"), ("forged", "a", "1"), ("forged", "a", "1"), ("odd", "x", "9"), (None, "a", "1"), ("odd", None, "1"), ("odd", "a", None)]
    got = {r["sample"]: r for r in samples.coverage(problems, spark.createDataFrame(rows, "sample string, problem string, response string")).collect()}
    assert (got["whole"]["exact_match"], got["whole"]["issue"], got["whole"]["n_correct"]) == (2 / 3, None, 2)
    assert got["forged"]["issue"] and (got["forged"]["n_repeated"], got["forged"]["n_missing"]) == (2, 2)
    assert (got["odd"]["n_unknown"], got["odd"]["n_missing"], got["odd"]["n_correct"]) == (1, 2, 0)
    assert samples.coverage(problems, spark.createDataFrame([], "sample string, problem string, response string")).count() == 0


def test_gold(spark):
    rows = [("so #### 5", "7", "so #### 5"), ("five", "7", "#### 7"), ("five", None, "five"), ("five", "", "five"), (None, "7", "#### 7"), (None, None, None)]
    df = spark.createDataFrame(rows, "answer string, short string, want string")
    assert all(r[0] == r[1] for r in df.select(samples.gold(F.col("answer"), F.col("short")), "want").collect())


def test_attested(spark):
    m = {"acc,none": 0.5, "acc,strict-match": 0.4}
    rows = [("r", "mmlu_pro", "lm_eval_results", m, "acc", None, 0.4, 0.402), ("r", "ifeval", "lm_eval_results", m, "acc", None, 0.5, 0.41), ("r", "triton", "tritonbench_report", None, None, 0.4, None, 0.44), ("r", "x", "odd", None, None, None, None, None), ("r", "gsm8k", "regression_responses", None, None, None, 0.1, None)]
    e = spark.createDataFrame(rows, "run_id string, benchmark string, type string, metrics map<string,double>, metric string, worked_out double, reported double, claimed double")
    assert {r["benchmark"]: r["issues"] for r in samples.attested(e).collect()} == {"mmlu_pro": [], "ifeval": ["reported score differs", "claim differs"], "triton": [], "x": ["unknown type"], "gsm8k": ["no result"]}


def test_reports_scores(spark):
    r = spark.createDataFrame([("a", {"x": "0.5", "y": "no"}, {"z": "1"}), ("b", {"y": "no"}, {"z": "1", "w": None}), ("c", None, None)], "run_id string, per_benchmark map<string,string>, scores map<string,string>")
    assert {tuple(x) for x in samples.candidate_scores(r).collect()} == {("a", "x", 0.5), ("b", "z", 1.0)}


def test_report_data_and_tokens(spark):
    digest = "AB" * 32
    quote = base64.b64encode(bytes(568) + bytes.fromhex(digest) + bytes(32) + b"rest").decode()
    body = base64.urlsafe_b64encode(json.dumps({"a": "é?>", "n": 3}).encode()).decode().rstrip("=")
    row = spark.createDataFrame([(digest, quote, f"e30.{body}.c2ln"), (digest, base64.b64encode(b"short").decode(), "no token"), (None, None, None)], "d string, q string, t string")
    got = row.select(pins.report_data(F.col("d")), pins.quoted_data(F.col("q")), pins.token_payload(F.col("t"), "a string, n int")).collect()
    assert got[0][0] == got[0][1] == digest.lower() + "0" * 64 and (got[0][2]["a"], got[0][2]["n"]) == ("é?>", 3)
    assert got[1][1] is None and got[2][0] is None and got[2][1] is None


def test_lists(spark):
    one = spark.range(1).select(pins.device_list(F.lit("[0, 1]")), pins.device_list(F.lit("3")), pins.device_list(F.lit("")), pins.replaced_labels(F.array(F.lit("a"), F.lit("b"), F.lit("z")), F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))), pins.hardware_models(F.lit("GH100"), F.expr("array(named_struct('hwmodel', 'X'), named_struct('hwmodel', string(null)))"))).first()
    assert list(one) == [[0, 1], [3], [], ["a"], ["gh100", "x"]]


def test_proofs_and_maps(spark):
    files = spark.createDataFrame([("a", "t", "s1", 3), ("b", "t", "s2", 3), ("a", "m", "s", 0), ("b", "m", "s", 0)], "bundle string, name string, sha256 string, n_rows long")
    rows = [("a", True, "n", True, 0, "s1", "s1", 3, None), ("b", False, "", False, 2, "x", "y", 4, "abacus"), ("c", True, "n", True, 0, None, None, 0, None)]
    b = spark.createDataFrame(rows, "bundle string, passed boolean, nonce string, gate_passed boolean, blocked_rows int, gated_sha256 string, claimed_sha256 string, rows_total long, gpu_architecture string")
    got = {r["bundle"]: r["issues"] for r in pins.proof_issues(b, files, ("t", "m")).collect()}
    assert got["a"] == [] and got["c"] == ["missing m", "missing t"] and len(got["b"]) == 8
    x, y = (spark.createDataFrame(r, "path string, sha256 string") for r in ([("p", "1"), ("q", None), ("r", "3")], [("p", "2"), ("q", None), ("s", "4")]))
    assert {tuple(r) for r in pins.map_changes(x, y).collect()} == {("p", "changed"), ("r", "removed"), ("s", "added")}
    assert pins.same_maps(x, x) and pins.same_maps(x, y) is False and pins.same_maps(x, y.limit(0)) is None


def test_pins_and_recipes(spark):
    m = spark.createDataFrame([("x/y", 5, "a" * 64), ("x/z", 6, None)], "repo_id string, rows_total long, sft_sha256 string")
    pin = pins.canonical_pin(spark.createDataFrame([("m", 5, "a" * 64)], "mix_id string, rows_total long, sft_sha256 string"), "x/y")
    assert [r["issues"] for r in pins.against_pin(m, pin).orderBy("repo_id").collect()] == [[], ["repo_id", "sft_sha256", "rows_total"]]
    r = spark.createDataFrame([("r", [("data/mix",), (" ",), ("other",), (None,)])], "recipe string, datasets array<struct<path:string>>")
    assert [tuple(x) for x in pins.recipe_paths(r, "data/mix").collect()] == [("r", 2, "other")]
    t = spark.createDataFrame([(5.0, "RTX PRO 6000 Blackwell"), (5.1, "H100"), (None, "abacus")], "hours double, gpu string")
    assert [x["issues"] for x in pins.training_issues(t).collect()] == [[], ["too long"], ["no hours", "device"]]


def test_requests(spark):
    r = spark.createDataFrame([(1, "m", "u1", "a"), (2, "n", "u2", "b"), (3, "m", "u3", "c"), (4, "m", "u4", "a"), (5, "n", "u5", None)], "line_no long, miner string, hf_url string, trajectories_sha256 string")
    assert [x["hf_url"] for x in mix.selection(r, ["b", "a", "b"], ["m"]).orderBy("line_no").collect()] == ["u2", "u4", "u3"]
    for bad in ({"digests": ["zz"]}, {"miners": ["zz"]}, {}):
        with pytest.raises(ValueError):
            mix.selection(r, **bad)
    lines = registry.line_of_manifest(spark.createDataFrame([(" m ", "o/n/", "a" * 64, "3", "v", "h100"), ("", None, "a", "3.0", None, "?")], "miner string, hf_url string, trajectories_sha256 string, rows_total string, dataset_version string, gpu_architecture string")).collect()
    assert lines[0]["issues"] == [] and (lines[0]["miner"], lines[0]["rows_total"], lines[0]["gpu_architecture"]) == ("m", 3, "hopper") and len(lines[1]["issues"]) == 5


def test_near_mode_is_the_sequential_loop(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(24)] for _ in range(6)]
    rows = []
    for i in range(160):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i // 40, i % 40, i, rng.choice("ab"), " ".join(w), rng.random() < 0.8))
    rows += [(5, k, 500 + k, "a", None, True) for k in range(3)]
    shingles = lambda p: {tuple(p.split()[k : k + 3]) for k in range(len(p.split()) - 2)}
    want, kept = {}, []
    for ord_, line, i, scope, p, able in rows:
        near = p is not None and any(s == scope and q != p and len(shingles(p) & shingles(q)) >= 0.6 * len(shingles(p) | shingles(q)) for s, q in kept)
        want[i] = "exact_skipped" if p is not None and (scope, p) in kept else "near_skipped" if near else "selected" if able else "unexportable_skipped"
        if want[i] == "selected" and p is not None:
            kept.append((scope, p))
    df = spark.createDataFrame(rows, "ord long, line long, id long, scope string, prompt string, exportable boolean").withColumn("key", F.when(F.col("prompt").isNotNull(), F.unhex(F.sha2(F.concat("scope", F.lit(":"), "prompt"), 256)))).withColumn("component", F.col("ord").cast("string"))
    prompts = df.where("key is not null").select("key", "scope", "prompt").distinct()
    placed = df.drop("prompt", "scope")
    got = {r["id"]: r["verdict"] for r in near_mode.verdicts(placed, prompts, "near", 0.6, 3).collect()}
    assert got == want and set(want.values()) == {"exact_skipped", "near_skipped", "selected", "unexportable_skipped"}
    assert {r["id"]: r["verdict"] for r in near_mode.verdicts(placed, prompts, "exact").collect()} == {r["id"]: r["verdict"] for r in dedupe.verdicts(placed).collect()}
    assert near_mode.verdicts(placed, prompts, "none").where("verdict like '%near%' or verdict like '%exact%'").count() == 0
    assert [near_mode.mode_of(x) for x in (" Near ", None, "odd", "NONE")] == ["near", "exact", "exact", "none"]


def test_smoothing(spark):
    c = "It is a guide to action which ensures that the military always obeys the commands of the party"
    r = "It is a guide to action that ensures that the military will forever heed Party commands"
    rows = spark.createDataFrame([(1, c, [r]), (2, "x", [r]), (3, None, None), (4, c, [r, None, c])], "key long, candidate string, references array<string>")
    got = {(x["key"], x["method"]): x["bleu"] for x in similarity.smoothed_bleu(rows).collect()}
    published = (0.4118, 0.4118, 0.4489, 0.4118, 0.4118, 0.4905, 0.4135, 0.4905)
    assert all(abs(got[1, m] - v) < 1e-4 for m, v in enumerate(published))
    assert got[2, 1] == 0 and got[3, 4] == 0 and abs(got[4, 1] - 1) < 1e-12
    assert [tuple(x) for x in similarity.best_reference(spark.createDataFrame([(1, "a b c", ["a", "a b c d e", "a b"])], "key long, candidate string, references array<string>")).collect()] == [(1, 3, 2)]


def test_code_texts(spark):
    source = '"""doc"""\nx = 1  # c\n\ndef f():\n    "d"\n    s = "# no"\n    return s\n'
    df = spark.createDataFrame([(source, "a = 1; // x\n/* y\n z */ b = \"//no\";"), ("not python (", None)], "p string, c string")
    got = df.select(code.strip_comments(F.col("p")).alias("p"), code.strip_comments(F.col("c"), "java").alias("c"), T.indented(F.col("p"), "> ").alias("i")).collect()
    assert got[0]["p"] == 'x = 1\ndef f():\n    s = "# no"\n    return s' and got[0]["c"] == 'a = 1;  \n  b = "//no";' and got[1]["p"] == "not python (" and got[1]["c"] is None
    assert got[1]["i"] == "> not python ("


def test_timings(spark):
    c = spark.createDataFrame([("a", "1", 2.0), ("a", "2", 2.0), ("b", "1", 1.0), ("c", "9", 1.0)], "file string, input_size string, ms double")
    r = spark.createDataFrame([("a", "1", 4.0), ("a", "2", 4.0), ("a", "3", 99.0), ("b", "7", 3.0), ("c", "1", 1.0), ("c", "2", 1.0)], "file string, input_size string, ms double")
    assert {tuple(x) for x in reports.matched_timings(c, r).collect()} == {("a", 8.0, 4.0), ("b", 3.0, 1.0)}
    assert reports.rates(spark.createDataFrame([(10**9, 10**12, 500.0), (1, 1, 0.0)], "n_bytes long, n_flops long, ms double")).collect()[0]["bandwidth"] == 2.0

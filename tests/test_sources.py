import hashlib
import json
import os

from pyspark.sql import functions as F

from curata.sources import files
from curata.streaming import ledger


def test_lines_and_records(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_bytes('{"miner": "m", "rows_total": 3}\n\n  \n{"miner": ""}\nnot json\n[1]\n{"miner": "x y"}\r\n'.encode())
    out = files.read_records(spark, str(p), files.REGISTRY, ("miner",)).orderBy("line_no").collect()
    assert [(r["line_no"], r["issue"]) for r in out] == [(1, None), (4, "missing miner"), (5, "not json"), (6, "not json"), (7, None)]
    assert out[0]["rows_total"] == 3 and out[4]["miner"] == "x y"
    assert files.first_lines(files.lines(spark, str(p)), 2).count() == 2


def test_write_keeps_bytes(spark, tmp_path):
    df = spark.createDataFrame([(2, "é", None), (1, "a", [1, 2])], "n long, t string, xs array<long>")
    files.write_records(df, ["n"], str(tmp_path / "out"))
    text = "".join(open(tmp_path / "out" / f).read() for f in sorted(os.listdir(tmp_path / "out")) if f.startswith("part"))
    assert text == "".join(json.dumps(x, separators=(",", ":")) + "\n" for x in ({"t": "a", "xs": [1, 2]}, {"t": "é", "xs": None}))


def test_json_keeps_every_digit(spark, tmp_path):
    rows = [(1, 5, None, {"k": 2**53 + 1}, [None, 3]), (2, None, 2.5, None, None), (3, 2**53 + 1, 1.0, {}, [2**60])]
    df = spark.createDataFrame(rows, "n int, x long, d double, m map<string,long>, xs array<long>").withColumn("at", F.lit("2026-01-02 03:04:05").cast("timestamp_ntz")).withColumn("s", F.struct(F.lit(None).cast("string").alias("a")))
    got = [r[0] for r in df.orderBy("n").select(files.json_line(F.struct("x", "d", "m", "xs", "at", "s"), False)).collect()]
    want = [{"x": x, "d": d, "m": m, "xs": xs, "at": "2026-01-02T03:04:05", "s": {"a": None}} for _, x, d, m, xs in rows]
    assert got == [json.dumps(w) for w in want]


def test_lines_over_several_splits(spark, tmp_path):
    text = [("" if k % 7 == 3 else f"line {k} é" + "x" * (k % 50)) + ("\r" if k % 5 == 0 else "") for k in range(4000)]
    (tmp_path / "a.txt").write_bytes("\n".join(text).encode() + b"\n")
    (tmp_path / "b.txt").write_bytes(b"only\n\nthird")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        got = {(os.path.basename(r["file"]), r["line_no"]): r["line"] for r in files.lines(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {("a.txt", k + 1): x.removesuffix("\r") for k, x in enumerate(text) if x.strip()} | {("b.txt", 1): "only", ("b.txt", 3): "third"}
    assert got == want
    assert {r["n"] for r in files.line_count(files.lines(spark, str(tmp_path))).where("file is null").collect()} == {len(want)}


def test_problems_examples_documents(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"problem_id": 1, "question": "q", "answer": "#### 2"}\n{"problem_id": 2, "question": ""}\n')
    got = files.read_problems(spark, str(tmp_path / "p.jsonl")).orderBy("line_no").collect()
    assert [r["issue"] for r in got] == [None, "missing question"]
    assert files.issue_message(files.read_problems(spark, str(tmp_path / "p.jsonl"))).first()["message"].endswith("p.jsonl:2 missing question")
    (tmp_path / "e.jsonl").write_text('{"question": "b", "answer": "1"}\n{"question": "a", "answer": "2"}\n')
    assert files.read_examples(spark, str(tmp_path / "e.jsonl")) == [("b", "1"), ("a", "2")]
    (tmp_path / "d.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert files.read_document(spark, str(tmp_path / "d.json"), kind="array").count() == 2
    for run in (lambda: files.read_document(spark, str(tmp_path / "d.json"), kind="object"), lambda: files.read_examples(spark, str(tmp_path / "p.jsonl"))):
        try:
            run()
        except ValueError:
            continue
        raise AssertionError


def test_located_and_bounded(spark, tmp_path):
    for name, at in (("results_1.json", 100), ("results_2.json", 200), ("other.json", 300)):
        (tmp_path / name).write_text("{}")
        os.utime(tmp_path / name, (at, at))
    assert files.located(spark, str(tmp_path), "results.json").first()[0].endswith("results_2.json")
    (tmp_path / "results.json").write_text("{}")
    os.utime(tmp_path / "results.json", (50, 50))
    assert files.located(spark, str(tmp_path), "results.json").first()[0].endswith("results.json")
    assert files.newest(spark, str(tmp_path), "*.json").first()[0].endswith("other.json")
    assert files.newest(spark, str(tmp_path), "results*", after="1970-01-01T00:03:30").count() == 0


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([("r1", 0.5)], "run_id string, score double")
    files.append_entries(e, str(tmp_path / "ledger"))
    files.append_entries(e.withColumn("run_id", F.lit("r2")), str(tmp_path / "ledger"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "ledger")).collect()) == ['{"run_id": "r1", "score": 0.5}', '{"run_id": "r2", "score": 0.5}']
    rows = spark.createDataFrame([(2, "b", "t2"), (1, "a", "t1"), (3, "c", "t1"), (4, "d", None)], "n int, text string, task string")
    files.write_snapshot(rows, ["n"], "task", str(tmp_path / "snap"))
    assert [json.loads(r[0])["task_id"] for r in spark.read.text(str(tmp_path / "snap/task_ids")).collect()] == ["t1", "t2"]
    frontier = spark.createDataFrame([("hopper", "triton", 0.4), ("hopper", "gsm8k", 0.7)], "gpu_architecture string, benchmark string, frontier double")
    files.write_frontiers(spark, frontier, ("blackwell", "hopper"), str(tmp_path / "f"), "hopper")
    assert files.load_frontier_scores(spark, str(tmp_path / "f"), "hopper") == {"gsm8k": 0.7, "triton": 0.4}
    assert files.load_frontier_scores(spark, str(tmp_path / "f"), "blackwell") is None and files.load_frontier_scores(spark, str(tmp_path / "none"), "hopper") is None
    files.write_bundle(spark, {"triton": 0.4}, str(tmp_path / "f"), e, str(tmp_path / "bundle"))
    assert spark.read.json(str(tmp_path / "bundle/manifest")).count() >= 2
    try:
        files.write_bundle(spark, {}, str(tmp_path / "missing"), e, str(tmp_path / "bundle2"))
    except ValueError:
        assert not (tmp_path / "bundle2").exists()
    else:
        raise AssertionError


def test_yaml(spark, tmp_path):
    import pytest

    pytest.importorskip("yaml")
    (tmp_path / "1").mkdir()
    (tmp_path / "1" / "softmax.yaml").write_text("prompt: p\n")
    assert [tuple(r)[1:4] for r in files.read_yaml_problems(spark, str(tmp_path), ("1", "2")).collect()] == [("softmax", "1", "p")]


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.py").write_text("old" + "#" * 146 + "new")
    (tmp_path / "y.py").write_text("z")
    os.utime(tmp_path / "y.py", (1, 1))
    m = {os.path.basename(r["path"]): r["sha256"] for r in files.manifest(spark, str(tmp_path)).collect()}
    assert m["y.py"] == hashlib.sha256(b"z").hexdigest() and len(m) == 2
    assert files.newest(spark, str(tmp_path)).first()["path"].endswith("x.py")
    assert files.code_files(spark, str(tmp_path / "d")).first()["code"] == "new"


def test_frontier_stream(spark, tmp_path):
    schema = "run_id string, gpu_architecture string, benchmark string, score double, scored_at timestamp"
    src = str(tmp_path / "in")
    batches = [[("a", "h", "triton", 0.5)], [("b", "h", "triton", 0.7), ("a", "h", "triton", 0.5)], [("c", "h", "gsm8k", 0.1)]]
    for rows in batches:
        spark.createDataFrame(rows, "run_id string, gpu_architecture string, benchmark string, score double").withColumn("scored_at", F.lit("2026-01-01").cast("timestamp")).coalesce(1).write.mode("append").json(src)
    merge = ledger.keep_frontier(spark, str(tmp_path / "frontier"))
    stream = ledger.new_runs(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src))
    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = merge.versions()[-1]
    read = lambda: {r["benchmark"]: r["frontier"] for r in spark.read.parquet(f"{tmp_path}/frontier/v{last}").collect()}
    assert read() == {"triton": 0.7, "gsm8k": 0.1}
    merge(spark.createDataFrame([("c", "h", "gsm8k", 0.1)], "run_id string, gpu_architecture string, benchmark string, score double"), last)  # a second delivery
    assert read() == {"triton": 0.7, "gsm8k": 0.1}


def test_window_stream(spark, data, tmp_path):
    (tmp_path / "ev").mkdir()
    spark.read.parquet(f"{data}/events.parquet").write.mode("overwrite").parquet(str(tmp_path / "ev"))
    events = spark.read.parquet(str(tmp_path / "ev"))
    stream = ledger.window_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev")))
    q = stream.writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(str, spark.table("w").select("window_start", "event_type", "n").collect())) == sorted(map(str, ledger.window_counts(events).select("window_start", "event_type", "n").collect()))

"""Line-oriented JSON and other files."""

from __future__ import annotations

import base64
import hashlib
import json
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank

TRAJECTORY = "prompt string, response string, provider string, model string, system string, reasoning string, gpu_architecture string, metadata struct<tier:string,task_id:string,prompt_meta:struct<task_id:string,problem_id:string,prompt:string,origin:string,split:string,gpu_architecture:string>,multi_turn:boolean>, sparkproof_validation struct<passed:boolean>"
REGISTRY = "miner string, hf_url string, trajectories_sha256 string, rows_total bigint, dataset_version string, gpu_architecture string"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, line of every line that isn't blank. Lines end at line feeds only; line_no counts all lines of the file from 1.

    Files are cut into splits and read side by side. A line's number is its place in its split, whose rows are one run of ids, after the lines of the
    file's earlier splits: one row a split is gathered for that.
    """
    meta = F.col("_metadata")
    text = spark.read.option("lineSep", "\n").text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("_start"), F.monotonically_increasing_id().alias("_id"), F.regexp_replace("value", "\r$", "").alias("line"))
    splits = text.groupBy("file", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "_start", "_first", before.alias("_before"))
    rows = text.where(~is_blank(F.col("line"))).join(splits, ["file", "_start"])
    return rows.select("file", (F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "line")


def line_count(line_table: DataFrame) -> DataFrame:
    """file, n of the lines that aren't blank, and one row with a null file for all of them together."""
    return line_table.groupingSets([["file"], []], "file").agg(F.count(F.lit(1)).alias("n"))


def parsed(line_table: DataFrame, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """The lines' columns, their record by the schema, and issue: null, 'not json', or the first required field that is missing."""
    full = T.StructType.fromDDL(schema).add("_corrupt", T.StringType())
    record = F.from_json("line", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"})
    out = line_table.withColumn("r", record)
    issue = F.when(F.col("r").isNull() | F.col("r._corrupt").isNotNull() | ~F.ltrim("line").startswith("{"), "not json")
    for name in required:
        issue = issue.when(F.col(f"r.{name}").isNull() | (F.col(f"r.{name}").cast("string") == ""), f"missing {name}")
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    return out.select(*line_table.columns, *(F.col(f"r.{n}").alias(n) for n in names), issue.alias("issue"))


def read_records(spark: SparkSession, path: str, schema: str = TRAJECTORY, required: tuple[str, ...] = ()) -> DataFrame:
    return parsed(lines(spark, path), schema, required)


def first_lines(line_table: DataFrame, n: int) -> DataFrame:
    """The first n lines that aren't blank, in order: a top-n, no full sort."""
    return line_table.orderBy("file", "line_no").limit(n)


def issue_message(record_table: DataFrame) -> DataFrame:
    """file, line_no, message ('place: what is wrong') of the lines with an issue."""
    return record_table.where("issue is not null").select("file", "line_no", F.concat_ws(":", "file", F.concat("line_no", F.lit(" "), "issue")).alias("message"))


PROBLEM = "problem_id bigint, question string, answer string, answer_short string"
EXAMPLE = "question string, answer string"


def read_problems(spark: SparkSession, path: str) -> DataFrame:
    """Problems, with an issue where one of three fields is missing."""
    return read_records(spark, path, PROBLEM, ("problem_id", "question", "answer"))


def read_examples(spark: SparkSession, path: str, most: int = 1000) -> list[tuple[str, str]]:
    """Worked examples of a prompt, in order; all of them go into one prompt, so more than `most` are an error, as is a missing field."""
    rows = read_records(spark, path, EXAMPLE, ("question", "answer")).orderBy("file", "line_no").limit(most + 1).collect()
    wrong = [f"{r['file']}:{r['line_no']} {r['issue']}" for r in rows if r["issue"]]
    if wrong or len(rows) > most:
        raise ValueError("; ".join(wrong) or f"more than {most} examples")
    return [(r["question"], r["answer"]) for r in rows]


def read_document(spark: SparkSession, path: str, schema: str | None = None, kind: str | None = None) -> DataFrame:
    """A JSON object, or an array of objects, over several lines. kind ('object' or 'array') makes any other an error."""
    if kind:
        marks = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.substring(F.ltrim(F.regexp_replace("value", r"^\s+", "")), 1, 1).alias("mark"))
        wrong = [r[0] for r in marks.where(F.col("mark") != F.lit("{" if kind == "object" else "[")).limit(8).collect()]
        if wrong:
            raise ValueError(f"no JSON {kind}: {', '.join(wrong)}")
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_yaml_problems(spark: SparkSession, path: str, levels: tuple[str, ...], schema: str = "id string, level string, prompt string, input_code string, constraints string") -> DataFrame:
    """Problems of YAML files in a folder for each level, in the order of level and path; id is the file's name unless it has one. A missing folder is
    passed over. It needs the yaml package where the executors run."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    files = listing(spark, path, "*.{yml,yaml}")
    files = files.withColumn("level", F.element_at(F.split("path", "/"), -2)).where(F.col("level").isin(*levels)).select("path", "level")

    def run(iterator):
        import yaml

        for batch in iterator:
            out = []
            for file, level in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _opened(file) as f:
                    record = {"id": file.rsplit("/", 1)[-1].rsplit(".", 1)[0], "level": level} | (yaml.safe_load(f.read()) or {})
                out.append([file, *(None if record.get(n) is None else str(record[n]) for n in names)])
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.string()) for k in range(len(names) + 1)], ["path", *names])

    order = F.array_position(F.array(*map(F.lit, levels)), F.col("level"))
    rows = files.mapInArrow(run, ", ".join(["path string", *(f"{n} string" for n in names)]))
    return rows.orderBy(order, "path")


@contextmanager
def _opened(path: str):
    """A stream of a file of any file system that pyarrow knows; a path without a scheme is a local one."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)
    stream = system.open_input_stream(place)
    try:
        yield stream
    finally:
        stream.close()


def listing(spark: SparkSession, path: str, pattern: str = "*", **options: str) -> DataFrame:
    """path, n_bytes, changed of every file under a folder; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).options(**options)
    return reader.load(path).select("path", F.col("length").alias("n_bytes"), F.col("modificationTime").alias("changed"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, n_bytes, sha256 of every file under a folder. A file is digested in pieces of 8 MB, so its size doesn't matter; large and small files are
    spread over the tasks."""

    def run(iterator):
        for batch in iterator:
            digests = []
            for file in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with _opened(file) as f:
                    while piece := f.read(8_000_000):
                        digest.update(piece)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.string())], ["path", "n_bytes", "sha256"])

    files = listing(spark, path).select("path", "n_bytes")
    return files.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(run, "path string, n_bytes long, sha256 string")


def newest(spark: SparkSession, path: str, pattern: str = "*", after: str | None = None) -> DataFrame:
    """path of the file that was changed last, and not before `after` (yyyy-MM-ddTHH:mm:ss) if it is given; ties go to the last name."""
    files = listing(spark, path, pattern, **({"modifiedAfter": after} if after else {}))
    return files.agg(F.max(F.struct("changed", "path")).alias("x")).where("x is not null").select("x.path")


def located(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """path of the file of that name, else of the newest whose name begins with the name's stem and an underscore."""
    stem, _, ending = name.rpartition(".")
    files = listing(spark, folder, f"{stem}*.{ending}").withColumn("_name", F.element_at(F.split("path", "/"), -1)).where((F.col("_name") == name) | F.col("_name").startswith(stem + "_"))
    return files.agg(F.max(F.struct(F.col("_name") == name, "changed", "path")).alias("x")).where("x is not null").select("x.path")


def code_files(spark: SparkSession, path: str, separator: str = "#" * 146) -> DataFrame:
    """path, code: what follows the last separator of each file."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return text.select("path", F.element_at(F.split("value", separator), -1).alias("code"))


def _plain(value):
    """Values as JSON has them: times and dates as ISO texts, bytes in base64, decimals as texts."""
    if isinstance(value, bytes):
        return base64.b64encode(value).decode()
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


def json_line(record: Column, compact: bool = True) -> Column:
    """A struct as a line of ASCII JSON that keeps nulls, the fields' order and every digit, as hashes of files need it."""
    separators = (",", ":") if compact else (", ", ": ")

    def listed(value, kind):
        if value is None:
            return None
        if pa.types.is_map(kind):
            return {k: listed(v, kind.item_type) for k, v in value}
        if pa.types.is_struct(kind):
            return {f.name: listed(value[f.name], f.type) for f in kind}
        return [listed(v, kind.value_type) for v in value] if pa.types.is_list(kind) else value

    @F.arrow_udf(T.StringType())
    def dump(s: pa.Array) -> pa.Array:
        return pa.array([json.dumps(listed(r, s.type), separators=separators, default=_plain) for r in s.to_pylist()], pa.string())

    return dump(record)


def write_records(df: DataFrame, order: list[str], path: str, compact: bool = True) -> None:
    """All other columns of df as JSON lines in the order; part files follow each other by name."""
    kept = [c for c in df.columns if c not in order]
    df.orderBy(*order).select(json_line(F.struct(*kept), compact).alias("value")).write.option("lineSep", "\n").text(path)


def append_entries(entries: DataFrame, path: str, compact: bool = False) -> None:
    """Entries (of a ledger or a registry) as further JSON lines of a folder; what is there isn't touched."""
    entries.select(json_line(F.struct(*entries.columns), compact).alias("value")).write.mode("append").option("lineSep", "\n").text(path)


def document(spark: SparkSession, body: dict, path: str) -> None:
    """A small JSON document, indented by two, in a folder of one file."""
    spark.createDataFrame([(json.dumps(body, indent=2),)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)


def write_snapshot(accepted: DataFrame, order: list[str], task_id: str, path: str) -> None:
    """The accepted rows as JSON lines, and the sorted distinct task ids with their number; accepted is read twice, so it should be a written table."""
    write_records(accepted, order, f"{path}/rows")
    ids = accepted.where(F.col(task_id).isNotNull()).select(F.col(task_id).alias("task_id")).distinct()
    write_records(ids.withColumn("_order", F.col("task_id")), ["_order"], f"{path}/task_ids")


def frontier_tables(spark: SparkSession, frontier: DataFrame, architectures: tuple[str, ...]) -> DataFrame:
    """gpu_architecture and its scores, a map of benchmark to score: empty, not missing, for an architecture without any."""
    every = spark.createDataFrame([(a,) for a in architectures], "gpu_architecture string")
    scores = frontier.groupBy("gpu_architecture").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("benchmark", "frontier")))).alias("scores"))
    return every.join(scores, "gpu_architecture", "left").select("gpu_architecture", F.coalesce("scores", F.create_map().cast("map<string,double>")).alias("scores"))


def write_frontiers(spark: SparkSession, frontier: DataFrame, architectures: tuple[str, ...], path: str, mirrored: str) -> None:
    """Scores of all architectures as one JSON document, and those of one of them in the older form; a frontier has a row a benchmark."""
    tables = {r[0]: dict(sorted(r[1].items())) for r in frontier_tables(spark, frontier, architectures).collect()}
    document(spark, {a: {"scores": tables[a]} for a in architectures}, f"{path}/frontiers")
    document(spark, {"scores": tables.get(mirrored, {})}, f"{path}/frontier")


def load_frontier_scores(spark: SparkSession, path: str, architecture: str) -> dict[str, float] | None:
    """Scores of an architecture from the document of all, else, for one that it lacks, from the older one; None if there are none."""

    def read(name):
        rows = spark.read.text(f"{path}/{name}", wholetext=True).limit(1).collect() if not listing_empty(spark, f"{path}/{name}") else []
        return json.loads(rows[0][0]) if rows else {}

    body = read("frontiers")
    return (body[architecture].get("scores") if architecture in body else read("frontier").get("scores")) or None


def listing_empty(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def write_bundle(spark: SparkSession, scores: dict[str, float], checkpoint: str, samples: DataFrame, path: str) -> None:
    """A bundle of scores, the manifest of a checkpoint's files, and samples. Nothing is written for a missing or empty checkpoint."""
    if listing_empty(spark, checkpoint):
        raise ValueError(f"no folder {checkpoint}")
    files = manifest(spark, checkpoint)
    if files.isEmpty():
        raise ValueError(f"no files in {checkpoint}")
    document(spark, scores, f"{path}/scores")
    append_entries(files.orderBy("path"), f"{path}/manifest")
    append_entries(samples, f"{path}/samples")

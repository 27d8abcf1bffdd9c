"""Answer samples and attested results: every problem answered once, scores worked out anew, claims held against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# By how many percentage points a claim may differ from its sample; of the benchmarks not named, by DEFAULT_TOLERANCE.
TOLERANCES = {"triton": 5.0}
DEFAULT_TOLERANCE = 0.5
EXACT = 1e-9
ANSWER_MARK = "####"


def gold(answer: Column, short: Column) -> Column:
    """The answer if it has the answer mark; else the short answer behind a mark; else the answer."""
    return F.when(F.contains(answer, F.lit(ANSWER_MARK)), answer).when(T.some(short).isNotNull(), F.concat(F.lit(ANSWER_MARK + " "), short)).otherwise(answer)


def graded(problems: DataFrame, responses: DataFrame) -> DataFrame:
    """responses (sample, problem, response) with gold and correct; a response to an unknown problem has a null gold and isn't correct."""
    right = T.same_answer(T.answer_of(F.col("gold")), T.answer_of(F.col("response")))
    return responses.join(problems.select("problem", "gold", F.lit(True).alias("_known")), "problem", "left").select("sample", "problem", "response", "gold", F.coalesce("_known", F.lit(False)).alias("known"), right.alias("correct"))


def coverage(problems: DataFrame, responses: DataFrame) -> DataFrame:
    """Of each sample: n_responses, n_unknown, n_repeated, n_missing, n_correct, exact_match (of all problems), issue: null if every problem is
    answered exactly once. Repeats are counted from one row a sample and problem, which is combined before the shuffle. problem is unique in
    problems; null samples and problems are left out."""
    total = problems.agg(F.count(F.lit(1)).alias("_total"))
    each = graded(problems, responses.where("sample is not null and problem is not null")).groupBy("sample", "problem").agg(F.count(F.lit(1)).alias("n"), F.bool_or("known").alias("known"), F.count_if("correct").alias("right"))
    out = each.groupBy("sample").agg(
        F.sum("n").alias("n_responses"), F.sum(F.when(~F.col("known"), F.col("n")).otherwise(0)).alias("n_unknown"), F.sum(F.when(F.col("known"), F.col("n") - 1).otherwise(0)).alias("n_repeated"), F.count_if("known").alias("_seen"), F.sum("right").alias("n_correct")
    )
    out = out.crossJoin(F.broadcast(total)).withColumn("n_missing", F.col("_total") - F.col("_seen"))
    issue = F.when((F.col("n_unknown") > 0) | (F.col("n_repeated") > 0) | (F.col("n_missing") > 0), "not each problem exactly once")
    return out.select("sample", "n_responses", "n_unknown", "n_repeated", "n_missing", "n_correct", (F.col("n_correct") / F.nullif(F.col("_total"), F.lit(0))).alias("exact_match"), issue.alias("issue"))


def tolerance(benchmark: Column) -> Column:
    out = F.lit(DEFAULT_TOLERANCE)
    for name, value in TOLERANCES.items():
        out = F.when(benchmark == name, value).otherwise(out)
    return out


def attested(entries: DataFrame) -> DataFrame:
    """entries and recomputed, issues. entries: run_id, benchmark, type ('regression_responses', 'lm_eval_results' or 'tritonbench_report'), metrics
    (map of metric to value, for lm_eval_results), metric (its name), worked_out (score of responses or report, for the other two), reported,
    claimed. A claim of a type that isn't known is an issue, a missing report or claim isn't."""
    from_map = T.metric_named(F.col("metrics"), F.col("metric"))
    kind = F.col("type")
    recomputed = F.when(kind == "lm_eval_results", from_map).when(kind.isin("regression_responses", "tritonbench_report"), F.col("worked_out"))
    out = entries.withColumn("recomputed", recomputed)
    off = F.abs(F.col("claimed") - F.col("recomputed")) * 100
    checks = [
        (~F.coalesce(kind.isin("regression_responses", "lm_eval_results", "tritonbench_report"), F.lit(False)), "unknown type"),
        (kind.isin("regression_responses", "lm_eval_results", "tritonbench_report") & F.col("recomputed").isNull(), "no result"),
        (F.abs(F.col("reported") - F.col("recomputed")) > EXACT, "reported score differs"),
        (off > tolerance(F.col("benchmark")), "claim differs"),
    ]
    return out.withColumn("issues", F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for bad, name in checks))))


def unified(attested_rows: DataFrame, legacy: DataFrame) -> DataFrame:
    """The unified samples of each run, and of runs without any the legacy one. Both have run_id, benchmark, type, worked_out."""
    columns = ["run_id", "benchmark", "type", "worked_out"]
    only = legacy.join(attested_rows.select("run_id").distinct(), "run_id", "left_anti")
    return attested_rows.select(*columns).unionByName(only.select(*columns))


def claimed(scores: Column, benchmark: Column) -> Column:
    """A claimed score of a map; for triton that of the quick run if it is there."""
    own = F.try_element_at(scores, benchmark)
    return F.when((benchmark == "triton") & own.isNotNull(), F.coalesce(F.try_element_at(scores, F.lit("triton_quick")), own)).otherwise(own)


def summary_scores(report: DataFrame) -> DataFrame:
    """run_id and the five scores of a report: run_id, avg_composite, quick_mean, exec_pass_rate, avg_correctness, syntax_pass_rate; missing ones are 0,
    a missing quick mean is the headline."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return report.select(
        "run_id", zero("avg_composite").alias("triton"), F.coalesce(F.col("quick_mean"), zero("avg_composite")).alias("triton_quick"), zero("exec_pass_rate").alias("triton_exec_pass_rate"), zero("avg_correctness").alias("triton_correctness"),
        zero("syntax_pass_rate").alias("triton_syntax_pass_rate"),
    )


def candidate_scores(reports: DataFrame) -> DataFrame:
    """run_id, benchmark, score of reports: run_id, per_benchmark (map to a text), scores (map to a text). Scores count only where per_benchmark has
    no number at all; what isn't a number is left out."""
    numbers = lambda c: F.map_filter(F.transform_values(F.coalesce(c, F.create_map().cast("map<string,string>")), lambda _, v: v.try_cast("double")), lambda _, v: v.isNotNull())
    own = numbers(F.col("per_benchmark"))
    chosen = F.when(F.size(own) > 0, own).otherwise(numbers(F.col("scores")))
    return reports.select("run_id", F.explode(chosen).alias("benchmark", "score"))


def responses_in_order(responses: DataFrame) -> DataFrame:
    """sample and its responses, as structs of problem and response, by problem. A sample has one response a problem."""
    return responses.groupBy("sample").agg(F.array_sort(F.collect_list(F.struct("problem", "response"))).alias("responses"))

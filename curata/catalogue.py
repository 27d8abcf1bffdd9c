"""The registered queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import code as C
from .operators import dedupe, records, reports, scoring, similarity
from .operators import registry as R
from .plans import mix

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL fragments ---------------------------------------------------------------------------------------------------------------------------
_WS = "'" + T.WHITE_SPACE + "'"
_strip = lambda c: f"trim({c}, {_WS})"
_PROMPT = f"lower({_strip('coalesce(nullif(metadata.prompt_meta.prompt, %s), prompt, %s)' % (chr(39) * 2, chr(39) * 2))})"
_ARCH = "coalesce(nullif(gpu_architecture, ''), nullif(metadata.prompt_meta.gpu_architecture, ''), 'blackwell')"
_KEY = f"CASE WHEN length({_PROMPT}) > 0 THEN {_ARCH} || ':' || {_PROMPT} ELSE '#' || traj_id END"
_COMPONENTS = "comp AS (SELECT lower(trajectories_sha256) AS component, min(line_no) AS ord FROM registry WHERE trajectories_sha256 IS NOT NULL GROUP BY 1)"
_PLACED = f"""{_COMPONENTS}, placed AS (
  SELECT c.component, c.ord, t.line_no AS line, t.traj_id AS id, {_KEY} AS k, (response IS NOT NULL AND coalesce(sparkproof_validation.passed, true)) AS ex
  FROM trajectory t JOIN comp c ON lower(t.trajectories_sha256) = c.component)"""
_JUDGED = _PLACED + """, judged AS (
  SELECT *, CASE WHEN coalesce(max(ex::INT) OVER (PARTITION BY k ORDER BY ord, line, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'exact_skipped'
                 WHEN ex THEN 'selected' ELSE 'unexportable_skipped' END AS verdict FROM placed)"""
_RESPONSE = f"CASE WHEN coalesce(length({_strip('reasoning')}), 0) = 0 THEN {_strip('response')} ELSE '<think>' || chr(10) || {_strip('reasoning')} || chr(10) || '</think>' || chr(10) || chr(10) || {_strip('response')} END"
_FAMILY = "CASE WHEN {0} IN ('blackwell', 'hopper') THEN {0} " + " ".join(
    f"WHEN {' OR '.join('contains({0}, ' + chr(39) + t + chr(39) + ')' for t in tokens)} THEN '{family}'" for family, tokens in T.ARCHITECTURE_TOKENS.items()
) + " END"
_family = lambda c: _FAMILY.replace("{0}", f"lower({_strip(c)})")
_HUB = "https://hub.example/datasets/"
_REPO = f"nullif(regexp_extract({_strip('hf_url')}, '^https://hub\\.example/datasets/([^/]+/[^/#?]+)', 1), '')"
_VALID = "score IS NOT NULL AND NOT isnan(score) AND score BETWEEN 0 AND 1"
_BENCH = "('" + "', '".join(scoring.BENCHMARKS) + "')"
_SCORES = f"""scores AS (SELECT run_id, gpu_architecture, benchmark, x.score AS score, x.scored_at AS scored_at FROM (
    SELECT run_id, gpu_architecture, benchmark, max({{'scored_at': scored_at, 'score': score}}) AS x FROM bench_result
    WHERE {_VALID} AND run_id IS NOT NULL AND benchmark IN {_BENCH} GROUP BY 1, 2, 3))"""


# --- ordered de-duplication ------------------------------------------------------------------------------------------------------------------
def _placed(spark, d):
    return dedupe.placed(_t(spark, d, "trajectory"), _t(spark, d, "registry"))


@query(f"""WITH {_JUDGED} SELECT component, count(*) AS rows_in_source, count(*) FILTER (verdict = 'selected') AS rows_selected,
    count(*) FILTER (verdict = 'exact_skipped') AS rows_skipped_dedupe, count(*) FILTER (verdict = 'unexportable_skipped') AS rows_skipped_unexportable FROM judged GROUP BY 1""")
def exact_dedupe_mix(spark, d):
    return dedupe.counters(dedupe.verdicts(_placed(spark, d)))


@query(f"WITH {_JUDGED} SELECT id AS traj_id, verdict FROM judged")
def exact_dedupe_rows(spark, d):
    return dedupe.verdicts(_placed(spark, d)).select(F.col("id").alias("traj_id"), "verdict")


@query(f"WITH {_PLACED} SELECT id AS traj_id, CASE WHEN row_number() OVER (PARTITION BY k ORDER BY ord, line, id) = 1 THEN 'selected' ELSE 'exact_skipped' END AS verdict FROM placed")
def snapshot_accepted(spark, d):
    return dedupe.verdicts(_placed(spark, d), claim_unexportable=True).select(F.col("id").alias("traj_id"), "verdict")


@query(f"""WITH {_JUDGED} SELECT 'rows_in_source' AS counter, count(*) AS n FROM judged UNION ALL SELECT 'rows_selected', count(*) FROM judged WHERE verdict = 'selected'
    UNION ALL SELECT 'rows_skipped_dedupe', count(*) FROM judged WHERE verdict = 'exact_skipped' UNION ALL SELECT 'rows_skipped_unexportable', count(*) FROM judged WHERE verdict = 'unexportable_skipped'""")
def mix_totals(spark, d):
    c = dedupe.counters(dedupe.verdicts(_placed(spark, d)))
    names = c.columns[1:]
    return c.agg(*(F.sum(n).alias(n) for n in names)).unpivot([], names, "counter", "n")


@query()
def mix_with_quota(spark, d):
    """No SQL: components depend on each other in order. Tests hold it against a sequential loop."""
    return dedupe.counters(dedupe.quota_mix(_placed(spark, d), 20).where("verdict is not null"))


@query(f"WITH {_JUDGED} SELECT id AS traj_id, row_number() OVER (ORDER BY ord, line, id) - 1 AS row_index FROM judged WHERE verdict = 'selected'")
def mix_row_index(spark, d):
    chosen = dedupe.verdicts(_placed(spark, d)).where("verdict = 'selected'").select(*dedupe.PLACE)
    return dedupe.dense_index(chosen, *dedupe.PLACE).select(F.col("id").alias("traj_id"), "row_index")


@query(f"""WITH {_JUDGED} SELECT j.id AS traj_id, j.component, row_number() OVER (ORDER BY ord, line, id) - 1 AS row_index,
    'user' || chr(10) || coalesce(nullif(metadata.prompt_meta.prompt, ''), prompt, '') || chr(10) || 'assistant' || chr(10) || ({_RESPONSE}) AS turns
    FROM judged j JOIN trajectory t ON t.traj_id = j.id WHERE verdict = 'selected'""")
def mix_records(spark, d):
    rows = mix.build(_t(spark, d, "trajectory"), _t(spark, d, "registry")).rows
    turns = F.array_join(F.transform(F.filter("messages", lambda m: m["role"] != "system"), lambda m: F.concat(m["role"], F.lit("\n"), m["content"])), "\n")
    return rows.select(F.col("id").alias("traj_id"), "component", "row_index", turns.alias("turns"))


@query("SELECT line_no, trajectories_sha256 FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(trajectories_sha256, '#' || line_no) ORDER BY line_no) AS n FROM registry) WHERE n = 1")
def first_by_digest(spark, d):
    return dedupe.first_by_key(_t(spark, d, "registry"), "trajectories_sha256", "line_no").select("line_no", "trajectories_sha256")


@query(f"""SELECT coalesce(nullif(metadata.prompt_meta.task_id, ''), nullif(metadata.prompt_meta.problem_id, ''), nullif(metadata.task_id, '')) AS task_id, count(*) AS n FROM trajectory
    WHERE coalesce(nullif(metadata.prompt_meta.task_id, ''), nullif(metadata.prompt_meta.problem_id, ''), nullif(metadata.task_id, '')) IS NOT NULL GROUP BY 1""")
def task_ids(spark, d):
    return _t(spark, d, "trajectory").select(dedupe.task_id().alias("task_id")).where("task_id is not null").groupBy("task_id").agg(F.count(F.lit(1)).alias("n"))


# --- records ---------------------------------------------------------------------------------------------------------------------------------
@query(f"SELECT traj_id, prompt, {_RESPONSE} AS response, system FROM trajectory WHERE response IS NOT NULL")
def alpaca_records(spark, d):
    return records.alpaca(_t(spark, d, "trajectory"))


@query(f"""SELECT traj_id, CASE WHEN system <> '' THEN 3 ELSE 2 END AS n_turns, coalesce('system' || chr(10) || nullif(system, '') || chr(10), '') || 'user' || chr(10)
    || coalesce(nullif(metadata.prompt_meta.prompt, ''), prompt, '') || chr(10) || 'assistant' || chr(10) || ({_RESPONSE}) AS turns
    FROM trajectory WHERE response IS NOT NULL AND coalesce(sparkproof_validation.passed, true)""")
def message_records(spark, d):
    m = records.message_records(_t(spark, d, "trajectory"))
    return m.select("traj_id", F.size("messages").alias("n_turns"), F.array_join(F.transform("messages", lambda t: F.concat(t["role"], F.lit("\n"), t["content"])), "\n").alias("turns"))


@query("SELECT item_id, 'Question: 2 + 2?' || chr(10) || 'Answer: #### 4' || chr(10) || 'Question: ' || text || chr(10) || 'Answer:' AS prompt FROM eval_item")
def few_shot_prompt(spark, d):
    return _t(spark, d, "eval_item").select("item_id", records.few_shot([("2 + 2?", "#### 4")], F.col("text")).alias("prompt"))


@query("""SELECT raw_id, CASE WHEN json_valid(line) AND json_type(line) = 'OBJECT' THEN NULL ELSE 'not json' END AS issue FROM trajectory_raw WHERE length(trim(coalesce(line, ''), """ + _WS + """)) > 0""")
def raw_line_issues(spark, d):
    from .sources.files import TRAJECTORY, parsed

    rows = _t(spark, d, "trajectory_raw").where(~T.is_blank(F.col("line"))).select("raw_id", "line")
    return parsed(rows, TRAJECTORY).select("raw_id", "issue")


# --- registry --------------------------------------------------------------------------------------------------------------------------------
@query(f"SELECT line_no, {_strip('miner')} AS miner, CASE WHEN starts_with(u, 'https://') THEN u ELSE '{_HUB}' || regexp_replace(u, '^/+', '') END AS url, {_REPO} AS repository, {_family('gpu_architecture')} AS architecture FROM (SELECT *, regexp_replace({_strip('hf_url')}, '/+$', '') AS u FROM registry)")
def registry_normalised(spark, d):
    return R.normalised(_t(spark, d, "registry"))


_missing = lambda c: f"({c} IS NULL OR {c}::VARCHAR IN ('', '0'))"
_CHECKS = [(_missing(c), f"missing {c}") for c in R.REQUIRED] + [
    ("(length(trajectories_sha256) > 0 AND length(trajectories_sha256) <> 64)", "digest length"),
    ("coalesce(rows_total, 0) <= 0", "rows_total not positive"),
    (f"{_REPO} IS NULL", "not a dataset address"),
    (f"(NOT {_missing('gpu_architecture')} AND ({_family('gpu_architecture')}) IS NULL)", "unknown architecture"),
]


@query("SELECT line_no, " + " || ".join(f"CASE WHEN coalesce({c}, false) THEN '{m};' ELSE '' END" for c, m in _CHECKS) + " AS issues FROM registry")
def registry_issues(spark, d):
    return R.validated(_t(spark, d, "registry")).select("line_no", F.array_join(F.transform("issues", lambda x: F.concat(x, F.lit(";"))), "").alias("issues"))


@query(f"""WITH p AS (SELECT line_no, 'repository' AS field, {_REPO} AS value FROM registry UNION ALL SELECT line_no, 'digest', nullif(trajectories_sha256, '') FROM registry)
    SELECT line_no, field, value FROM (SELECT *, row_number() OVER (PARTITION BY field, value ORDER BY line_no) AS n FROM p WHERE value IS NOT NULL) WHERE n > 1""")
def registry_repeats(spark, d):
    return R.repeated(_t(spark, d, "registry"))


def _versions(spark, d):
    r = _t(spark, d, "registry").select(F.col("line_no").alias("place"), F.concat_ws("|", "miner", "hf_url", "trajectories_sha256").alias("line"), "batch_no")
    return r.where("batch_no is null").select("place", "line"), r.select("place", "line")


_LINES = "v AS (SELECT line_no AS place, concat_ws('|', miner, hf_url, trajectories_sha256) AS line, batch_no FROM registry)"


@query(f"WITH {_LINES} SELECT place, line FROM v WHERE line NOT IN (SELECT line FROM v WHERE batch_no IS NULL)")
def registry_appended(spark, d):
    return R.appended(*_versions(spark, d))


_PLAIN_LINE = "concat_ws('|', " + _strip("miner") + ", regexp_replace(" + _strip("hf_url") + ", '/+$', ''), lower(" + _strip("trajectories_sha256") + "))"


@query(f"WITH {_LINES}, p AS (SELECT line_no AS place, {_PLAIN_LINE} AS line FROM registry) SELECT v.place FROM v LEFT JOIN p USING (place) WHERE v.batch_no IS NULL AND v.line IS DISTINCT FROM p.line")
def registry_rewritten(spark, d):
    """History against a file in which every line was written anew in its normal form."""
    base, _ = _versions(spark, d)
    plain = F.concat_ws("|", T.strip(F.col("miner")), F.regexp_replace(T.strip(F.col("hf_url")), "/+$", ""), F.lower(T.strip(F.col("trajectories_sha256"))))
    return R.rewritten(base, _t(spark, d, "registry").select(F.col("line_no").alias("place"), plain.alias("line")))


@query("""SELECT place, line_no, trajectories_sha256 FROM (SELECT trajectories_sha256, min(-line_no) AS place FROM registry WHERE batch_no IS NOT NULL GROUP BY 1)
    JOIN (SELECT trajectories_sha256, max(line_no) AS line_no FROM registry GROUP BY 1) USING (trajectories_sha256)""")
def registry_selected(spark, d):
    """The digests of the incoming batches, asked for in the reverse order of the file."""
    r = _t(spark, d, "registry")
    return R.selected(r, r.where("batch_no is not null").select((-F.col("line_no")).alias("place"), "trajectories_sha256"))


@query("""WITH r AS (SELECT lower(trajectories_sha256) AS digest, max(rows_total) AS claimed FROM registry WHERE trajectories_sha256 IS NOT NULL GROUP BY 1),
    t AS (SELECT lower(trajectories_sha256) AS digest, count(*) AS rows FROM trajectory GROUP BY 1), n AS (SELECT digest, claimed, coalesce(rows, 0) AS rows FROM r LEFT JOIN t USING (digest))
    SELECT digest, claimed, rows, CASE WHEN rows >= 150 THEN 'xl' WHEN rows >= 100 THEN 'l' WHEN rows >= 75 THEN 'm' WHEN rows >= 50 THEN 's' WHEN rows >= 25 THEN 'xs' ELSE 'none' END AS band FROM n""")
def size_bands(spark, d):
    """Claimed and counted rows of each digest, and the band of the count."""
    r = _t(spark, d, "registry").where("trajectories_sha256 is not null").groupBy(F.lower("trajectories_sha256").alias("digest")).agg(F.max("rows_total").alias("claimed"))
    t = _t(spark, d, "trajectory").groupBy(F.lower("trajectories_sha256").alias("digest")).agg(F.count(F.lit(1)).alias("rows"))
    n = F.coalesce("rows", F.lit(0))
    band = F.when(n >= 150, "xl").when(n >= 100, "l").when(n >= 75, "m").when(n >= 50, "s").when(n >= 25, "xs").otherwise("none")
    return r.join(t, "digest", "left").select("digest", "claimed", n.alias("rows"), band.alias("band"))


@query(f"SELECT traj_id, {_family('gpu_architecture')} AS architecture FROM trajectory")
def architectures(spark, d):
    return _t(spark, d, "trajectory").select("traj_id", T.architecture(F.col("gpu_architecture")).alias("architecture"))


# --- answers ---------------------------------------------------------------------------------------------------------------------------------
_ANSWER = "coalesce(nullif(regexp_extract({0}, '#### (-?[0-9.,]+)', 1), ''), regexp_extract_all({0}, '-?[$0-9.,]{{2,}}|-?[0-9]+')[-1])"
_PLAIN = "trim(regexp_replace(regexp_replace(replace(replace({0}, ',', ''), '$', ''), '(?s).*#### ', ''), '\\.$', ''), " + _WS + ")"
_GIVEN = _ANSWER.format("response")


@query(f"SELECT traj_id, {_GIVEN} AS answer, {_PLAIN.format(_GIVEN)} AS plain FROM trajectory WHERE response IS NOT NULL")
def answers(spark, d):
    a = T.answer_of(F.col("response"))
    return _t(spark, d, "trajectory").where("response is not null").select("traj_id", a.alias("answer"), T.plain_answer(a).alias("plain"))


@query(f"""WITH g AS (SELECT metadata.tier AS tier, coalesce({_PLAIN.format(_ANSWER.format("reasoning"))} = {_PLAIN.format(_GIVEN)}, false) AS same FROM trajectory)
    SELECT coalesce(tier, 'none') AS tier, count(*) AS n, round(avg(same::INT), 6) AS exact_match FROM g GROUP BY 1""")
def exact_match_rate(spark, d):
    """Share of rows, of all rows, whose response ends in the number that its reasoning ends in."""
    same = T.same_answer(T.answer_of(F.col("reasoning")), T.answer_of(F.col("response")))
    rows = _t(spark, d, "trajectory").select(F.coalesce("metadata.tier", F.lit("none")).alias("tier"), same.alias("same"))
    return rows.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("same").cast("int")), 6).alias("exact_match"))


# --- scores ----------------------------------------------------------------------------------------------------------------------------------
@query(f"WITH {_SCORES} SELECT * FROM scores")
def run_scores(spark, d):
    return scoring.run_scores(_t(spark, d, "bench_result"))


@query(f"SELECT run_id, benchmark, count(*) AS n FROM bench_result WHERE NOT coalesce({_VALID}, false) GROUP BY 1, 2")
def invalid_scores(spark, d):
    return scoring.invalid_scores(_t(spark, d, "bench_result"))


@query(f"WITH {_SCORES} SELECT gpu_architecture, benchmark, max(score) AS frontier FROM scores GROUP BY 1, 2")
def frontier_merge(spark, d):
    return scoring.frontier(run_scores(spark, d))


@query(f"""WITH {_SCORES}, h AS (SELECT *, max(score) OVER (PARTITION BY gpu_architecture, benchmark ORDER BY scored_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM scores)
    SELECT run_id, gpu_architecture, benchmark, score, before, before IS NULL OR score > before AS moves FROM h""")
def frontier_history(spark, d):
    return scoring.frontier_history(run_scores(spark, d))


_DELTA = "CASE WHEN f.frontier = 0 THEN CASE WHEN s.score = 0 THEN 0 ELSE 'Infinity'::DOUBLE END ELSE (s.score - f.frontier) / f.frontier * 100 END"


@query(f"""WITH {_SCORES}, f AS (SELECT gpu_architecture, benchmark, min(score) AS frontier FROM scores GROUP BY 1, 2),
    dl AS (SELECT s.run_id, s.gpu_architecture, s.benchmark, {_DELTA} AS delta FROM scores s JOIN f ON f.gpu_architecture = s.gpu_architecture AND f.benchmark = s.benchmark),
    t AS (SELECT run_id, gpu_architecture, delta AS tri FROM dl WHERE benchmark = 'triton')
    SELECT dl.run_id, dl.gpu_architecture, dl.benchmark, round(delta, 6) AS delta_pct, delta < 0 AND -delta > CASE WHEN benchmark = 'gsm8k' AND tri >= 2 THEN 2 WHEN benchmark IN ('aime24', 'gpqa', 'triton') THEN 2 ELSE 1 END AS regression
    FROM dl LEFT JOIN t ON t.run_id = dl.run_id AND t.gpu_architecture = dl.gpu_architecture""")
def frontier_deltas(spark, d):
    """Scores against the lowest frontier of each benchmark, so that changes of either sign occur."""
    s = run_scores(spark, d)
    base = s.groupBy("gpu_architecture", "benchmark").agg(F.min("score").alias("frontier"))
    return scoring.against_frontier(s, base).withColumn("delta_pct", F.round("delta_pct", 6))


@query(f"""WITH {_SCORES}, c AS (SELECT gpu_architecture, benchmark, max(score) AS claimed FROM scores GROUP BY 1, 2)
    SELECT s.run_id, s.gpu_architecture, s.benchmark, claimed, s.score AS measured, round(abs(claimed - s.score) * 100, 6) AS off FROM c
    JOIN scores s ON s.gpu_architecture = c.gpu_architecture AND s.benchmark = c.benchmark WHERE abs(claimed - s.score) * 100 > 2.0""")
def claims_outside_tolerance(spark, d):
    """Runs that claim the frontier, against what they measured."""
    s = run_scores(spark, d)
    claimed = s.select("run_id", "gpu_architecture", "benchmark").join(scoring.frontier(s), ["gpu_architecture", "benchmark"]).withColumnRenamed("frontier", "claimed")
    out = scoring.outside_tolerance(claimed, s.withColumnRenamed("score", "measured"), ["run_id", "gpu_architecture", "benchmark"])
    return out.withColumn("off", F.round("off", 6))


@query("""SELECT run_id, date, pr, label, coalesce(len(regressions), 0) AS n_regressions, coalesce(attested, false) AS attested FROM (
    SELECT run_id, coalesce(date, '') AS date, coalesce(pr, '') AS pr, label, regressions, attested,
      row_number() OVER (PARTITION BY run_id ORDER BY coalesce(date, ''), coalesce(pr, ''), label NULLS FIRST, best_benchmark NULLS FIRST, best_pct_delta NULLS FIRST, regressions NULLS FIRST, attested NULLS FIRST) AS n
    FROM ledger WHERE run_id IS NOT NULL) WHERE n = 1""")
def ledger_once(spark, d):
    return scoring.ledger_once(_t(spark, d, "ledger"))


@query("SELECT r AS benchmark, count(*) AS n FROM (SELECT unnest(regressions) AS r FROM ledger) GROUP BY 1")
def ledger_regressions(spark, d):
    return _t(spark, d, "ledger").select(F.explode("regressions").alias("benchmark")).groupBy("benchmark").agg(F.count(F.lit(1)).alias("n"))


# --- reports ---------------------------------------------------------------------------------------------------------------------------------
_DETAILS = "d AS (SELECT e.level, b.score >= 0.5 AS passed, b.score FROM (SELECT benchmark, score FROM bench_result WHERE " + _VALID + ") b JOIN (SELECT DISTINCT benchmark, level FROM eval_item) e USING (benchmark))"


def _details(spark, d):
    b = _t(spark, d, "bench_result").where(scoring.valid_score(F.col("score"))).select("benchmark", "score")
    e = _t(spark, d, "eval_item").select("benchmark", "level").distinct()
    return b.join(e, "benchmark").select("level", (F.col("score") >= 0.5).alias("passed"), "score")


@query(f"""WITH {_DETAILS}, c AS (SELECT coalesce(level, 'none') AS level, passed::INT AS passed, score FROM d)
    SELECT CASE WHEN grouping(level) = 1 THEN 'all' ELSE level END AS level, count(*) AS n, round(avg(passed), 6) AS pass_rate, round(avg(score), 6) AS mean_score FROM c GROUP BY GROUPING SETS ((level), ())""")
def report_by_level(spark, d):
    return reports.by_level(_details(spark, d)).withColumns({c: F.round(c, 6) for c in ("pass_rate", "mean_score")})


@query(f"WITH {_DETAILS} SELECT round(avg(coalesce(score, 0)) FILTER (level IN ('1', 'bugfix')), 6) AS quick_mean FROM d")
def quick_subset_mean(spark, d):
    return reports.quick_mean(_details(spark, d)).select(F.round("quick_mean", 6).alias("quick_mean"))


@query("SELECT metric, round(avg(value), 6) AS mean FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME metric VALUE value) GROUP BY 1")
def metric_means(spark, d):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return reports.metric_means(_t(spark, d, "lineitem").select(*names), names).withColumn("mean", F.round("mean", 6))


@query("SELECT l_partkey AS file, round(sum(l_extendedprice) / sum(l_quantity * 700), 6) AS speedup FROM lineitem GROUP BY 1 HAVING sum(l_extendedprice) / sum(l_quantity * 700) < 10 AND sum(l_extendedprice) / sum(l_quantity * 700) > 0.1")
def speedups(spark, d):
    rows = _t(spark, d, "lineitem").select(F.col("l_partkey").alias("file"), F.col("l_extendedprice").alias("reference_ms"), (F.col("l_quantity") * 700).alias("candidate_ms"))
    return reports.speedups(rows).withColumn("speedup", F.round("speedup", 6))


@query("SELECT l_suppkey AS file, greatest(round(max(l_quantity * 30) * 100 / 1800.0, 4), round(max(l_tax * 1000) * 100 / 838.0, 4)) AS efficiency FROM lineitem GROUP BY 1 HAVING greatest(round(max(l_quantity * 30) * 100 / 1800.0, 4), round(max(l_tax * 1000) * 100 / 838.0, 4)) < 100")
def efficiency(spark, d):
    rows = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("file"), (F.col("l_quantity") * 30).alias("bandwidth"), (F.col("l_tax") * 1000).alias("compute"))
    return reports.efficiency(rows)


@query("""WITH s AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events),
    c AS (SELECT *, coalesce(abs(value - p) < 0.3 * abs(p), false) AS calm FROM s),
    r AS (SELECT *, sum(CASE WHEN calm THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
    n AS (SELECT *, sum(calm::INT) OVER (PARTITION BY user_id, run ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS k FROM r)
    SELECT user_id, min(event_id) AS stable_at FROM n WHERE k >= 3 GROUP BY 1""")
def first_stable(spark, d):
    return reports.first_stable(_t(spark, d, "events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", change=0.3)


@query("SELECT event_type, arg_max(event_id, {'ts': ts, 'event_id': event_id}) AS event_id FROM events GROUP BY 1")
def newest_event(spark, d):
    return _t(spark, d, "events").groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN k + 1 WHEN 'view' THEN k + 2 WHEN 'error' THEN k + 3 ELSE k END AS metric FROM (SELECT event_id, event_type, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""")
def metric_lookup(spark, d):
    """Maps of four filters: with the bare key, with strict-match, with none, with others only, by the kind of the event."""
    k = F.from_json("props", "map<string,double>")["k"]
    kind = F.col("event_type")
    named = lambda *pairs: F.create_map(*(x for key, add in pairs for x in (F.lit(key), k + add)))
    values = (
        F.when(kind == "click", named(("exact,zz", 9.0), ("exact,strict-match", 1.0), ("exact,none", 8.0)))
        .when(kind == "view", named(("exact,aa", 9.0), ("exact,none", 2.0), ("exactly", 7.0)))
        .when(kind == "error", named(("exact,flexible", 3.0), ("exact,zz", 9.0), ("other", 7.0)))
        .otherwise(named(("exact", 0.0), ("exact,strict-match", 9.0)))
    )
    return _t(spark, d, "events").select("event_id", T.metric_of(values, "exact").alias("metric"))


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    from .streaming.ledger import window_counts

    return window_counts(_t(spark, d, "events")).withColumn("total", F.round("total", 4))


# --- code ------------------------------------------------------------------------------------------------------------------------------------
_CODE = """CASE WHEN len(regexp_extract_all({0}, '(?s)```python\\n(.*?)```', 1)) > 0 THEN array_to_string(regexp_extract_all({0}, '(?s)```python\\n(.*?)```', 1), chr(10) || chr(10))
    WHEN len(regexp_extract_all({0}, '(?s)```\\n(.*?)```', 1)) > 0 THEN array_to_string(regexp_extract_all({0}, '(?s)```\\n(.*?)```', 1), chr(10) || chr(10)) ELSE {0} END"""
_WITH_CODE = f"k AS (SELECT traj_id, coalesce(sparkproof_validation.passed, false) AS passed, {_CODE.format('response')} AS c FROM trajectory WHERE response IS NOT NULL)"


def _has(*names: str) -> str:
    return "(" + " OR ".join(f"contains(c, '{n}')" for n in names) + ")"


def _with_code(spark, d):
    return _t(spark, d, "trajectory").where("response is not null").select("traj_id", F.coalesce("sparkproof_validation.passed", F.lit(False)).alias("passed"), T.code_of(F.col("response")).alias("c"))


@query(f"WITH {_WITH_CODE} SELECT traj_id, c AS code FROM k")
def code_blocks(spark, d):
    return _with_code(spark, d).select("traj_id", F.col("c").alias("code"))


@query("SELECT traj_id, replace(replace(string_split(response, '```python')[-1], '<|im_end|>', ''), '<|EOT|>', '') AS code FROM trajectory WHERE response IS NOT NULL")
def last_code_block(spark, d):
    return _t(spark, d, "trajectory").where("response is not null").select("traj_id", T.last_block(F.col("response")).alias("code"))


@query(f"""WITH {_WITH_CODE} SELECT traj_id, {' || '.join("CASE WHEN " + _has(n) + " THEN '" + n + ";' ELSE '' END" for n in C.DEPRECATED)} AS deprecated,
    {' || '.join("CASE WHEN " + _has(n) + " THEN '" + n + ";' ELSE '' END" for n in C.MODERN)} AS modern_used,
    {_has('@triton.jit')} AND {_has('tl.program_id')} AND NOT {_has(*C.DEPRECATED)} AS modern FROM k""")
def code_interfaces(spark, d):
    x = _with_code(spark, d).select("traj_id", C.interfaces(F.col("c")).alias("x"))
    listed = lambda c: F.array_join(F.transform(c, lambda n: F.concat(n, F.lit(";"))), "")
    return x.select("traj_id", listed("x.deprecated").alias("deprecated"), listed("x.modern_used").alias("modern_used"), F.col("x.modern").alias("modern"))


_SCORE_SQL = {
    "correctness": f"CASE WHEN NOT passed THEN 0.0::DOUBLE WHEN {_has('torch.allclose', 'torch.testing.assert_close')} THEN 1.0 WHEN regexp_matches(c, '(?m)^\\s*assert\\b') THEN 0.8 ELSE 0.5 END",
    "api_modernity": "greatest(0.0, least(1.0, 0.5::DOUBLE" + "".join(f" + CASE WHEN {_has(n)} THEN {v}::DOUBLE ELSE 0 END" for n, v in C.MODERNITY.items()) + "))",
    "perf_awareness": "(" + " + ".join(f"({x})::INT" for x in (_has("@triton.autotune"), "regexp_matches(c, 'BLOCK_[MNK]\\s*[=:]\\s*\\d+')", _has("num_stages"), _has("num_warps"), _has("tl.dot("), _has(*C.TARGETS).replace("(c,", "(lower(c),"))) + ")::DOUBLE / 6",
    "completeness": "0.25::DOUBLE * (" + " + ".join(f"({x})::INT" for x in (_has("@triton.jit"), f"{_has('def ')} AND {_has('grid')}", _has("torch.allclose", "assert"), _has("@triton.autotune"))) + ")",
    "code_quality": "least(1.0, 0.5::DOUBLE + CASE WHEN contains(c, '\"\"\"') OR contains(c, '''''''') OR length(c) - length(replace(c, '#', '')) >= 3 THEN 0.2 ELSE 0 END + CASE WHEN contains(c, ': int') OR contains(c, 'tl.constexpr') THEN 0.15 ELSE 0 END"
    " + CASE WHEN len(string_split(trim(c, ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)), chr(10))) BETWEEN 20 AND 200 THEN 0.15 ELSE 0 END)",
}


@query(f"WITH {_WITH_CODE}, s AS (SELECT traj_id, {', '.join(v + ' AS ' + k for k, v in _SCORE_SQL.items())} FROM k) SELECT traj_id, {', '.join(f'round({k}, 6) AS {k}' for k in _SCORE_SQL)}, round({' + '.join(f'{k} * {w}' for k, w in C.WEIGHTS.items())}, 6) AS composite_score FROM s")
def code_scores(spark, d):
    rows = _with_code(spark, d)
    return rows.select("traj_id", *(F.round(v, 6).alias(k) for k, v in C.scores(F.col("c"), F.col("passed")).items()))


@query()
def code_parses(spark, d):
    """No SQL: it needs Python's own parser."""
    return _with_code(spark, d).select("traj_id", C.parses("c").alias("parses"))


@query()
def code_definitions(spark, d):
    return _with_code(spark, d).select("traj_id", C.definitions("c").alias("code"))


def _pairs(spark, d):
    """Responses against the reasoning of the same row."""
    return _t(spark, d, "trajectory").where("response is not null and reasoning is not null").select(F.col("traj_id").alias("key"), F.col("response").alias("candidate"), F.col("reasoning").alias("reference"))


_SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in T.WHITE_SPACE) + "]+"
_TOKENS = f"""w AS (SELECT traj_id AS key, [x FOR x IN regexp_split_to_array(response, '{_SPACE}') IF x <> ''] AS c, [x FOR x IN regexp_split_to_array(reasoning, '{_SPACE}') IF x <> ''] AS r
    FROM trajectory WHERE response IS NOT NULL AND reasoning IS NOT NULL),
  cg AS (SELECT key, n, array_to_string(c[i:i + n - 1], ' ') AS g, count(*) AS k FROM w, unnest([1, 2, 3, 4]) AS a(n), unnest(generate_series(1, greatest(0, len(c) - n + 1))) AS u(i) GROUP BY 1, 2, 3),
  rg AS (SELECT key, n, array_to_string(r[i:i + n - 1], ' ') AS g, count(*) AS k FROM w, unnest([1, 2, 3, 4]) AS a(n), unnest(generate_series(1, greatest(0, len(r) - n + 1))) AS u(i) GROUP BY 1, 2, 3),
  m AS (SELECT cg.key, cg.n, sum(least(cg.k, coalesce(rg.k, 0))) AS matches, sum(cg.k) AS total FROM cg LEFT JOIN rg ON rg.key = cg.key AND rg.n = cg.n AND rg.g = cg.g GROUP BY 1, 2),
  e AS (SELECT w.key, a.n, coalesce(m.matches, 0)::BIGINT AS matches, coalesce(m.total, 0)::BIGINT AS total FROM w CROSS JOIN unnest([1, 2, 3, 4]) AS a(n) LEFT JOIN m ON m.key = w.key AND m.n = a.n)"""
_BLEU = "CASE WHEN max(matches) FILTER (n = 1) > 0 THEN {penalty} * exp(sum(ln(CASE WHEN matches > 0 THEN matches::DOUBLE ELSE 0.1 END / greatest(total, 1)) / 4)) ELSE 0 END"


@query(f"WITH {_TOKENS} SELECT key AS traj_id, n, matches, total FROM e")
def bleu_counts(spark, d):
    return similarity.gram_counts(_pairs(spark, d)).withColumnRenamed("key", "traj_id")


@query(f"""WITH {_TOKENS}, l AS (SELECT key, len(c) AS cl, len(r) AS rl FROM w)
    SELECT e.key AS traj_id, round({_BLEU.format(penalty='CASE WHEN any_value(cl) > any_value(rl) THEN 1 WHEN any_value(cl) = 0 THEN 0 ELSE exp(1 - any_value(rl)::DOUBLE / any_value(cl)) END')}, 6) AS bleu FROM e JOIN l ON l.key = e.key GROUP BY 1""")
def sentence_bleu(spark, d):
    return similarity.sentence_bleu(_pairs(spark, d)).select(F.col("key").alias("traj_id"), F.round("bleu", 6).alias("bleu"))


@query(f"""WITH {_TOKENS}, s AS (SELECT n, sum(matches) AS matches, sum(total) AS total FROM e GROUP BY 1), l AS (SELECT sum(len(c)) AS cl, sum(len(r)) AS rl FROM w)
    SELECT round({_BLEU.format(penalty='(SELECT CASE WHEN cl > rl THEN 1 WHEN cl = 0 THEN 0 ELSE exp(1 - rl::DOUBLE / cl) END FROM l)')}, 6) AS bleu FROM s""")
def corpus_bleu(spark, d):
    return similarity.corpus_bleu(_pairs(spark, d)).select(F.round("bleu", 6).alias("bleu"))


_KEYWORDS = "('" + "', '".join(similarity.KEYWORDS) + "')"


@query(f"""WITH {_TOKENS}, t AS (SELECT rg.key, rg.n, CASE WHEN rg.n > 1 THEN 1.0::DOUBLE WHEN rg.g IN {_KEYWORDS} THEN 1.0 ELSE 0.2 END AS wt, rg.k AS want, least(rg.k, coalesce(cg.k, 0)) AS hit FROM rg LEFT JOIN cg ON cg.key = rg.key AND cg.n = rg.n AND cg.g = rg.g),
    o AS (SELECT key, n, sum(wt * hit) AS hit, sum(wt * want) AS want FROM t GROUP BY 1, 2),
    q AS (SELECT w.key, len(w.c) AS cl, max(hit) FILTER (n = 1) AS h1, max(want) FILTER (n = 1) AS w1, sum(ln(CASE WHEN hit > 0 THEN hit ELSE 0.1 END / want)) AS logs, count(o.n) AS orders FROM w LEFT JOIN o ON o.key = w.key GROUP BY w.key, w.c)
    SELECT key AS traj_id, round(h1 / w1, 9) AS recall, round(CASE WHEN coalesce(h1, 0) > 0 THEN CASE WHEN cl > 2 THEN 1 ELSE exp(1 - 2.0 / cl) END * exp((logs + (4 - orders) * ln(0.1)) / 4) ELSE 0 END, 9) AS weighted_bleu FROM q""")
def weighted_recall(spark, d):
    return similarity.weighted_recall(_pairs(spark, d)).select(F.col("key").alias("traj_id"), F.round("recall", 9).alias("recall"), F.round("weighted_bleu", 9).alias("weighted_bleu"))


# --- digests and sets ------------------------------------------------------------------------------------------------------------------------
@query("SELECT traj_id, sha256(response) AS digest FROM trajectory WHERE response IS NOT NULL")
def content_digests(spark, d):
    return _t(spark, d, "trajectory").where("response is not null").select("traj_id", F.sha2("response", 256).alias("digest"))


_LEAF = "SELECT lower(trajectories_sha256) AS digest, coalesce(line_no, 0) // {0} AS a, coalesce(line_no, 0) // {1} AS b, sha256(string_agg(sha256(coalesce(response, '')), '' ORDER BY line_no, traj_id)) AS h FROM trajectory GROUP BY ALL"


@query(f"WITH x AS ({_LEAF.format(1000, 1000000)}), y AS (SELECT digest, b, sha256(string_agg(h, '' ORDER BY a)) AS h FROM x GROUP BY 1, 2) SELECT digest, sha256(string_agg(h, '' ORDER BY b)) AS bundle FROM y GROUP BY 1")
def bundle_digests(spark, d):
    """Digest of each component's content: a tree of digests in the order of lines. No task holds more than the digests of a thousand lines, of a
    thousand of such, or of one component's millions."""
    return digest_tree(_t(spark, d, "trajectory"))


def digest_tree(rows: DataFrame, fan: int = 1000) -> DataFrame:
    line = F.coalesce("line_no", F.lit(0))
    leaf = rows.select(F.lower("trajectories_sha256").alias("digest"), F.floor(line / fan).alias("a"), F.floor(line / fan**2).alias("b"), F.struct("line_no", "traj_id", F.sha2(F.coalesce("response", F.lit("")), 256).alias("h")).alias("x"))
    joined = F.sha2(F.array_join(F.array_sort(F.collect_list("x"))["h"], ""), 256)
    first = leaf.groupBy("digest", "a", "b").agg(joined.alias("h")).select("digest", "b", F.struct("a", "h").alias("x"))
    second = first.groupBy("digest", "b").agg(joined.alias("h")).select("digest", F.struct("b", "h").alias("x"))
    return second.groupBy("digest").agg(joined.alias("bundle"))


@query("""SELECT side, count(*) AS n FROM (SELECT 'only_registry' AS side, d FROM (SELECT lower(trajectories_sha256) AS d FROM registry WHERE trajectories_sha256 IS NOT NULL EXCEPT SELECT lower(trajectories_sha256) FROM trajectory)
    UNION ALL SELECT 'only_trajectory', d FROM (SELECT lower(trajectories_sha256) AS d FROM trajectory EXCEPT SELECT lower(trajectories_sha256) FROM registry)
    UNION ALL SELECT 'both', d FROM (SELECT lower(trajectories_sha256) AS d FROM trajectory INTERSECT SELECT lower(trajectories_sha256) FROM registry)) GROUP BY 1""")
def digest_sets(spark, d):
    r, t = (_t(spark, d, n).where("trajectories_sha256 is not null").select(F.lower("trajectories_sha256").alias("digest")).distinct() for n in ("registry", "trajectory"))
    both = r.withColumn("r", F.lit(True)).join(t.withColumn("t", F.lit(True)), "digest", "full")
    side = F.when(F.col("t").isNull(), "only_registry").when(F.col("r").isNull(), "only_trajectory").otherwise("both")
    return both.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalogue_checks  # noqa: F401 - it adds its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)

"""More registered queries and their SQL: samples, claims, pins, timings, requests, texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalogue import _ANSWER, _BENCH, _HUB, _PLAIN, _SCORES, _SPACE, _VALID, _WITH_CODE, _WS, _family, _pairs, _placed, _strip, _t, _with_code, query, run_scores
from .functions import text as T
from .operators import code as C
from .operators import dedupe, near_mode, pins, records, reports, samples, scoring, similarity
from .operators import registry as R
from .plans import mix

_TASK = "coalesce(nullif(metadata.prompt_meta.task_id, ''), nullif(metadata.prompt_meta.problem_id, ''), nullif(metadata.task_id, ''))"
_FILLER = "00" * pins.REPORT_FROM


# --- samples and claims ------------------------------------------------------------------------------------------------------------------------
def _problems(spark, d):
    """Each task with the answer of its first trajectory, whose short form is the reasoning's number."""
    t = _t(spark, d, "trajectory").select(dedupe.task_id().alias("problem"), "traj_id", "response", T.answer_of(F.col("reasoning")).alias("short")).where("problem is not null")
    first = t.groupBy("problem").agg(F.min_by(F.struct("response", "short"), "traj_id").alias("x"))
    return first.select("problem", samples.gold(F.col("x.response"), F.col("x.short")).alias("gold"))


def _responses(spark, d):
    return _t(spark, d, "trajectory").select(F.lower("trajectories_sha256").alias("sample"), dedupe.task_id().alias("problem"), "response")


_SAMPLES = f"""t AS (SELECT {_TASK} AS problem, traj_id, response, {_ANSWER.format('reasoning')} AS short, lower(trajectories_sha256) AS sample FROM trajectory),
    f AS (SELECT problem, response, short FROM t WHERE problem IS NOT NULL QUALIFY row_number() OVER (PARTITION BY problem ORDER BY traj_id) = 1),
    p AS (SELECT problem, CASE WHEN contains(response, '####') THEN response WHEN short <> '' THEN '#### ' || short ELSE response END AS gold FROM f),
    g AS (SELECT sample, t.problem, coalesce({_PLAIN.format(_ANSWER.format('p.gold'))} = {_PLAIN.format(_ANSWER.format('t.response'))}, false) AS good FROM t JOIN p ON p.problem = t.problem)"""


@query(f"""WITH {_SAMPLES}, e AS (SELECT sample, problem, count(*) AS n, sum(good::INT) AS k FROM g WHERE sample IS NOT NULL GROUP BY 1, 2)
    SELECT sample, sum(n)::BIGINT AS n_responses, 0::BIGINT AS n_unknown, sum(n - 1)::BIGINT AS n_repeated, (SELECT count(*) FROM p) - count(*) AS n_missing, sum(k)::BIGINT AS n_correct,
      round(sum(k) / (SELECT count(*) FROM p), 9) AS exact_match, CASE WHEN sum(n - 1) > 0 OR (SELECT count(*) FROM p) > count(*) THEN 'not each problem exactly once' END AS issue FROM e GROUP BY 1""")
def sample_coverage(spark, d):
    """Each component as a sample over all tasks."""
    return samples.coverage(_problems(spark, d), _responses(spark, d)).withColumn("exact_match", F.round("exact_match", 9))


@query(f"WITH {_SAMPLES} SELECT problem, gold FROM p")
def gold_answers(spark, d):
    return _problems(spark, d)


@query(f"""WITH t AS (SELECT lower(trajectories_sha256) AS sample, {_TASK} AS problem, count(*) AS n, min(sha256(response)) AS h FROM trajectory WHERE {_TASK} IS NOT NULL AND response IS NOT NULL GROUP BY 1, 2)
    SELECT sample, count(*) AS n, sha256(string_agg(problem || '=' || h, ';' ORDER BY problem)) AS digest FROM t GROUP BY 1""")
def responses_in_order(spark, d):
    """Each sample's responses, one a problem, in the order of problems."""
    rows = _responses(spark, d).where("problem is not null and response is not null").groupBy("sample", "problem").agg(F.min(F.sha2("response", 256)).alias("response"))
    listed = F.array_join(F.transform("responses", lambda r: F.concat(r["problem"], F.lit("="), r["response"])), ";")
    return samples.responses_in_order(rows).select("sample", F.size("responses").alias("n"), F.sha2(listed, 256).alias("digest"))


_KIND = "CASE WHEN benchmark = 'triton' THEN 'tritonbench_report' WHEN benchmark = 'gsm8k' THEN 'regression_responses' WHEN benchmark = 'bfcl' THEN 'other' ELSE 'lm_eval_results' END"


def _attested(spark, d):
    """The newest result of each run and benchmark as the one worked out anew, the oldest as reported, the best as claimed."""
    b = _t(spark, d, "bench_result").where(scoring.valid_score(F.col("score")) & F.col("run_id").isNotNull() & F.col("benchmark").isNotNull())
    x = F.struct("scored_at", "score")
    g = b.groupBy("run_id", "benchmark").agg(F.max(x).alias("new"), F.min(x).alias("old"), F.max("score").alias("claimed"))
    kind = F.when(F.col("benchmark") == "triton", "tritonbench_report").when(F.col("benchmark") == "gsm8k", "regression_responses").when(F.col("benchmark") == "bfcl", "other").otherwise("lm_eval_results")
    suffix = F.when(F.col("benchmark") == "ifeval", ",strict-match").when(F.col("benchmark") == "mmlu_pro", ",none").when(F.col("benchmark") == "gpqa", ",flexible-extract").otherwise("")
    metrics = F.create_map(F.concat(F.lit("acc"), suffix), F.col("new.score"), F.lit("acc_stderr,none"), F.lit(0.01))
    return g.select("run_id", "benchmark", kind.alias("type"), metrics.alias("metrics"), F.lit("acc").alias("metric"), F.col("new.score").alias("worked_out"), F.col("old.score").alias("reported"), "claimed")


@query(f"""WITH g AS (SELECT run_id, benchmark, {_KIND} AS type, max({{'a': scored_at, 's': score}}).s AS new, min({{'a': scored_at, 's': score}}).s AS old, max(score) AS claimed FROM bench_result
      WHERE {_VALID} AND run_id IS NOT NULL AND benchmark IS NOT NULL GROUP BY 1, 2)
    SELECT run_id, benchmark, type, CASE WHEN type <> 'other' THEN new END AS recomputed,
      CASE WHEN type = 'other' THEN 'unknown type;' ELSE '' END || CASE WHEN type <> 'other' AND abs(old - new) > 1e-9 THEN 'reported score differs;' ELSE '' END
      || CASE WHEN type <> 'other' AND abs(claimed - new) * 100 > CASE WHEN benchmark = 'triton' THEN 5.0 ELSE 0.5 END THEN 'claim differs;' ELSE '' END AS issues FROM g""")
def attested_results(spark, d):
    out = samples.attested(_attested(spark, d))
    return out.select("run_id", "benchmark", "type", "recomputed", F.array_join(F.transform("issues", lambda i: F.concat(i, F.lit(";"))), "").alias("issues"))


@query(f"""WITH {_SCORES}, u AS (SELECT run_id, benchmark, score FROM scores WHERE benchmark = 'triton'), l AS (SELECT run_id, benchmark, score FROM scores WHERE benchmark = 'gsm8k')
    SELECT run_id, benchmark, 'unified' AS type, score AS worked_out FROM u UNION ALL SELECT run_id, benchmark, 'legacy', score FROM l WHERE run_id NOT IN (SELECT run_id FROM u)""")
def unified_samples(spark, d):
    """Results of triton as the unified samples, of gsm8k as the legacy ones of runs without those."""
    s = run_scores(spark, d).select("run_id", "benchmark", F.col("score").alias("worked_out"))
    return samples.unified(s.where("benchmark = 'triton'").withColumn("type", F.lit("unified")), s.where("benchmark = 'gsm8k'").withColumn("type", F.lit("legacy")))


@query("SELECT run_id, best_benchmark AS benchmark, best_pct_delta::VARCHAR::DOUBLE AS score FROM ledger WHERE best_pct_delta IS NOT NULL AND best_benchmark IS NOT NULL UNION ALL SELECT run_id, 'pr', NULL FROM ledger WHERE false")
def candidate_scores(spark, d):
    """Reports of the ledger's rows: a number under per_benchmark, a text that is none under scores."""
    r = _t(spark, d, "ledger").where("best_benchmark is not null").select("run_id", F.create_map(F.col("best_benchmark"), F.col("best_pct_delta").cast("string")).alias("per_benchmark"), F.create_map(F.lit("pr"), F.coalesce("pr", F.lit("none"))).alias("scores"))
    return samples.candidate_scores(r)


@query(f"""WITH {_SCORES}, r AS (SELECT run_id, max(score) FILTER (benchmark = 'triton') AS head, max(score) FILTER (benchmark = 'gsm8k') AS quick, max(score) FILTER (benchmark = 'humaneval') AS exec FROM scores GROUP BY 1)
    SELECT run_id, coalesce(head, 0) AS triton, coalesce(quick, head, 0) AS triton_quick, coalesce(exec, 0) AS triton_exec_pass_rate, 0.0::DOUBLE AS triton_correctness, 0.0::DOUBLE AS triton_syntax_pass_rate FROM r""")
def report_scores(spark, d):
    pick = lambda n: F.max(F.when(F.col("benchmark") == n, F.col("score")))
    r = run_scores(spark, d).groupBy("run_id").agg(pick("triton").alias("avg_composite"), pick("gsm8k").alias("quick_mean"), pick("humaneval").alias("exec_pass_rate"))
    return samples.summary_scores(r.withColumns({c: F.lit(None).cast("double") for c in ("avg_correctness", "syntax_pass_rate")}))


@query(f"""WITH {_SCORES}, m AS (SELECT run_id, max(score) FILTER (benchmark = 'triton') AS t, max(score) FILTER (benchmark = 'ifeval') AS q FROM scores GROUP BY 1)
    SELECT s.run_id, s.benchmark, CASE WHEN s.benchmark = 'triton' THEN coalesce(q, s.m) ELSE s.m END AS claimed FROM (SELECT run_id, benchmark, max(score) AS m FROM scores GROUP BY 1, 2) s JOIN m ON m.run_id = s.run_id""")
def claimed_scores(spark, d):
    """Claims of each run as a map, with its ifeval result standing for the quick run of triton."""
    s = run_scores(spark, d).groupBy("run_id", "benchmark").agg(F.max("score").alias("score"))
    named = F.when(F.col("benchmark") == "ifeval", "triton_quick").otherwise(F.col("benchmark"))
    maps = s.groupBy("run_id").agg(F.map_from_entries(F.concat(F.collect_list(F.struct("benchmark", "score")), F.collect_list(F.when(F.col("benchmark") == "ifeval", F.struct(named.alias("benchmark"), "score"))))).alias("claims"))
    return s.join(maps, "run_id").select("run_id", "benchmark", samples.claimed(F.col("claims"), F.col("benchmark")).alias("claimed"))


# --- pins, manifests, proofs -------------------------------------------------------------------------------------------------------------------
_COUNTS = "n AS (SELECT lower(trajectories_sha256) AS digest, count(*) AS rows FROM trajectory WHERE trajectories_sha256 IS NOT NULL GROUP BY 1)"


def _counts(spark, d):
    return _t(spark, d, "trajectory").where("trajectories_sha256 is not null").groupBy(F.lower("trajectories_sha256").alias("digest")).agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""WITH {_COUNTS} SELECT line_no, CASE WHEN n.digest IS NULL THEN 'missing trajectories;' ELSE CASE WHEN coalesce(r.miner, '') = '' THEN 'no nonce;' ELSE '' END || CASE WHEN r.batch_no IS NOT NULL THEN 'gate not passed;' ELSE '' END
      || CASE WHEN coalesce(r.rows_total, 0) <> n.rows THEN 'rows_total;' ELSE '' END || CASE WHEN ({_family("coalesce(r.gpu_architecture, 'blackwell')")}) IS NULL THEN 'unknown architecture;' ELSE '' END END AS issues
    FROM registry r LEFT JOIN n ON n.digest = lower(r.trajectories_sha256)""")
def proof_issues(spark, d):
    """Each registry line as a bundle whose one file are the trajectories under its digest; waiting batches have not passed the gate."""
    r = _t(spark, d, "registry")
    files = r.join(_counts(spark, d), F.lower("trajectories_sha256") == F.col("digest")).select(F.col("line_no").alias("bundle"), F.lit("trajectories").alias("name"), F.col("digest").alias("sha256"), "n_rows")
    digest = F.lower("trajectories_sha256")
    bundles = r.select(F.col("line_no").alias("bundle"), F.lit(True).alias("passed"), F.col("miner").alias("nonce"), F.col("batch_no").isNull().alias("gate_passed"), F.lit(0).alias("blocked_rows"), digest.alias("gated_sha256"), digest.alias("claimed_sha256"), "rows_total", "gpu_architecture")
    out = pins.proof_issues(bundles, files, ("trajectories",))
    return out.select(F.col("bundle").alias("line_no"), F.array_join(F.transform("issues", lambda i: F.concat(i, F.lit(";"))), "").alias("issues"))


@query(f"SELECT traj_id, rpad(sha256(response), 128, '0') AS expected, true AS same FROM trajectory WHERE response IS NOT NULL")  # noqa: F541
def report_data(spark, d):
    """A digest's report data, put into a quote and taken out of it again."""
    expected = pins.report_data(F.sha2("response", 256))
    quote = F.base64(F.unhex(F.concat(F.lit(_FILLER), expected)))
    return _t(spark, d, "trajectory").where("response is not null").select("traj_id", expected.alias("expected"), (pins.quoted_data(quote) == expected).alias("same"))


@query("SELECT traj_id, provider, model FROM trajectory")
def token_payloads(spark, d):
    """A token of each row's provider and model, read again."""
    body = F.to_json(F.struct("provider", "model"))
    token = F.concat(F.lit("e30."), F.rtrim(F.translate(F.base64(body.cast("binary")), "+/\r\n", "-_"), F.lit("=")), F.lit(".c2ln"))
    got = pins.token_payload(token, "provider string, model string")
    return _t(spark, d, "trajectory").select("traj_id", got["provider"].alias("provider"), got["model"].alias("model"))


@query("SELECT o_orderkey, len(list_value(o_custkey, o_orderkey)) AS n, o_custkey::INT AS first_device FROM orders")
def device_lists(spark, d):
    text = F.concat(F.lit("["), "o_custkey", F.lit(", "), "o_orderkey", F.lit("]"))
    x = pins.device_list(text)
    return _t(spark, d, "orders").select("o_orderkey", F.size(x).alias("n"), F.element_at(x, 1).alias("first_device"))


@query("SELECT run_id, string_agg(lower(benchmark), ',' ORDER BY lower(benchmark)) AS models FROM (SELECT DISTINCT run_id, benchmark FROM bench_result WHERE run_id IS NOT NULL AND benchmark IS NOT NULL UNION SELECT DISTINCT run_id, upper(gpu_architecture) FROM bench_result WHERE run_id IS NOT NULL AND gpu_architecture IS NOT NULL) GROUP BY 1")
def hardware_models(spark, d):
    """The architecture of a run as its claim's model, its benchmarks as those of the devices."""
    b = _t(spark, d, "bench_result").where("run_id is not null and (benchmark is not null or gpu_architecture is not null)")
    r = b.groupBy("run_id").agg(F.collect_set(F.upper("gpu_architecture")).alias("tops"), F.collect_set(F.struct(F.col("benchmark").alias("hwmodel"))).alias("devices"))
    models = F.concat(pins.hardware_models(F.try_element_at("tops", F.lit(1)), F.col("devices")), F.transform(F.slice("tops", F.lit(2), F.greatest(F.size("tops"), F.lit(1))), lambda m: F.lower(m)))
    return r.select("run_id", F.array_join(F.array_sort(models), ",").alias("models"))


@query(f"SELECT traj_id, coalesce({_family('gpu_architecture')}, {_family('metadata.prompt_meta.gpu_architecture')}, 'blackwell') AS architecture, {_family('metadata::JSON::VARCHAR')} AS claimed FROM trajectory")
def claimed_architectures(spark, d):
    t = _t(spark, d, "trajectory")
    return t.select("traj_id", T.bundle_architecture(F.col("gpu_architecture"), F.col("metadata.prompt_meta.gpu_architecture")).alias("architecture"), T.claims_architecture(F.col("metadata")).alias("claimed"))


_LAST = "l AS (SELECT trajectories_sha256 AS d, arg_max({'u': hf_url, 'm': miner}, line_no) AS r FROM registry WHERE trajectories_sha256 IS NOT NULL GROUP BY 1)"


@query(f"""WITH {_LAST} SELECT c.line_no, CASE WHEN coalesce(c.trajectories_sha256, '') = '' THEN 'no digest;' ELSE '' END || CASE WHEN c.trajectories_sha256 <> '' AND l.d IS NULL THEN 'not in the registry;' ELSE '' END
      || CASE WHEN c.hf_url <> '' AND c.hf_url <> l.r.u THEN 'hf_url;' ELSE '' END || CASE WHEN c.miner <> '' AND c.miner <> l.r.m THEN 'miner;' ELSE '' END AS issues
    FROM registry c LEFT JOIN l ON l.d = c.trajectories_sha256""")
def component_issues(spark, d):
    """Every registry line as a component of a manifest, against the last line of its digest."""
    r = _t(spark, d, "registry")
    out = pins.checked_components(r.select("line_no", "trajectories_sha256", "hf_url", "miner"), r)
    return out.select("line_no", F.array_join(F.transform("issues", lambda i: F.concat(i, F.lit(";"))), "").alias("issues"))


@query("SELECT trajectories_sha256, arg_min(rows_total, line_no) AS rows_selected FROM (SELECT * FROM registry WHERE rows_total IS NOT NULL) WHERE trajectories_sha256 IS NOT NULL GROUP BY 1")
def selected_counts(spark, d):
    return pins.selected_of(_t(spark, d, "registry").where("rows_total is not null").select(F.col("line_no").alias("place"), "trajectories_sha256", F.col("rows_total").alias("rows_selected")))


@query("""WITH p AS (SELECT hf_url AS u, rows_total AS n, trajectories_sha256 AS s FROM registry WHERE length(trajectories_sha256) = 64 ORDER BY line_no LIMIT 1)
    SELECT line_no, CASE WHEN p.u IS NOT NULL AND r.hf_url IS DISTINCT FROM p.u THEN 'repo_id;' ELSE '' END || CASE WHEN p.s IS NOT NULL AND r.trajectories_sha256 IS DISTINCT FROM p.s THEN 'sft_sha256;' ELSE '' END
      || CASE WHEN p.n IS NOT NULL AND r.rows_total IS DISTINCT FROM p.n THEN 'rows_total;' ELSE '' END AS issues FROM registry r, p""")
def pin_issues(spark, d):
    """Every registry line against a pin made of the first valid one."""
    r = _t(spark, d, "registry")
    manifest = r.orderBy("line_no").where(F.length("trajectories_sha256") == 64).limit(1).select(F.lit("m").alias("mix_id"), "rows_total", F.col("trajectories_sha256").alias("sft_sha256"), F.col("hf_url").alias("u"))
    pin = pins.canonical_pin(manifest, "x/y").crossJoin(manifest.select("u")).withColumn("repo_id", F.col("u"))  # one row
    out = pins.against_pin(r.select("line_no", F.col("hf_url").alias("repo_id"), "rows_total", F.col("trajectories_sha256").alias("sft_sha256")), pin)
    return out.select("line_no", F.array_join(F.transform("issues", lambda i: F.concat(i, F.lit(";"))), "").alias("issues"))


@query("""SELECT run_id, round(hours, 6) AS hours, CASE WHEN hours > 5.0 THEN 'too long;' ELSE '' END || 'device;' AS issues FROM (
    SELECT run_id, date_diff('second', min(scored_at), max(scored_at)) / 3600.0 AS hours FROM bench_result WHERE run_id IS NOT NULL AND scored_at IS NOT NULL GROUP BY 1)""")
def training_issues(spark, d):
    """The span of each run's results as its hours; an architecture's name is no accepted device."""
    b = _t(spark, d, "bench_result").where("run_id is not null and scored_at is not null").groupBy("run_id").agg(F.date_diff(F.max("scored_at"), F.min("scored_at")).alias("_d"), ((F.unix_micros(F.max(F.col("scored_at").cast("timestamp"))) / F.lit(1e6)).cast("bigint") - (F.unix_micros(F.min(F.col("scored_at").cast("timestamp"))) / F.lit(1e6)).cast("bigint")).alias("s"), F.max("gpu_architecture").alias("gpu"))
    out = pins.training_issues(b.select("run_id", (F.col("s") / 3600.0).alias("hours"), "gpu"))
    return out.select("run_id", F.round("hours", 6).alias("hours"), F.array_join(F.transform("issues", lambda i: F.concat(i, F.lit(";"))), "").alias("issues"))


@query(f"""WITH c AS (SELECT regexp_replace(hf_url, '/+$', '') AS u FROM registry WHERE hf_url IS NOT NULL ORDER BY line_no LIMIT 1), a AS (SELECT DISTINCT trajectories_sha256 AS s FROM registry WHERE batch_no IS NULL)
    SELECT line_no, CASE WHEN regexp_replace(hf_url, '/+$', '') IS DISTINCT FROM (SELECT u FROM c) THEN 'dataset_url;' ELSE '' END || CASE WHEN trajectories_sha256 IS NULL OR trajectories_sha256 NOT IN (SELECT s FROM a WHERE s IS NOT NULL) THEN 'sha256;' ELSE '' END AS issues FROM registry""")  # noqa: F541
def canonical_claims(spark, d):
    """Claims of every registry line against the first address and the digests of history."""
    r = _t(spark, d, "registry")
    first = r.where("hf_url is not null").orderBy("line_no").select("hf_url").first()
    claims = r.select("line_no", F.col("hf_url").alias("dataset_url"), F.col("trajectories_sha256").alias("sha256"))
    out = pins.canonical_claims(claims, F.lit(first[0] if first else None).cast("string"), r.where("batch_no is null").select(F.col("trajectories_sha256").alias("sha256")))
    return out.select("line_no", F.array_join(F.transform("issues", lambda i: F.concat(i, F.lit(";"))), "").alias("issues"))


@query(f"SELECT miner AS recipe, line_no AS at, {_strip('hf_url')} AS path FROM registry WHERE miner IS NOT NULL AND {_strip('hf_url')} <> '' AND {_strip('hf_url')} <> '{_HUB}x/y'")
def recipe_paths(spark, d):
    """Each miner's lines as the data sets of one recipe; at is the line."""
    r = _t(spark, d, "registry").where("miner is not null").groupBy("miner").agg(F.array_sort(F.collect_list(F.struct("line_no", F.col("hf_url").alias("path")))).alias("datasets"))
    out = pins.recipe_paths(r.select(F.col("miner").alias("recipe"), "datasets"), _HUB + "x/y")
    return out.join(r.select(F.col("miner").alias("recipe"), "datasets"), "recipe").select("recipe", F.expr("datasets[at].line_no").alias("at"), "path")


@query("""WITH o AS (SELECT prompt AS path, min(sha256(response)) AS h FROM trajectory WHERE prompt IS NOT NULL GROUP BY 1), n AS (SELECT prompt AS path, min(sha256(response)) AS h FROM incoming_trajectory WHERE prompt IS NOT NULL GROUP BY 1)
    SELECT change, count(*) AS n FROM (SELECT CASE WHEN n.path IS NULL THEN 'removed' WHEN o.path IS NULL THEN 'added' WHEN o.h IS DISTINCT FROM n.h THEN 'changed' END AS change FROM o FULL JOIN n ON o.path = n.path) WHERE change IS NOT NULL GROUP BY 1""")
def map_changes(spark, d):
    """Prompts as paths, digests of their responses as contents, of history against the incoming batches."""
    of = lambda name: _t(spark, d, name).where("prompt is not null").groupBy(F.col("prompt").alias("path")).agg(F.min(F.sha2("response", 256)).alias("sha256"))
    return pins.map_changes(of("trajectory"), of("incoming_trajectory")).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT line_no, CASE WHEN rows_total IS NULL THEN 2 ELSE 3 END - CASE WHEN trajectories_sha256 IS NULL THEN 1 ELSE 0 END AS n FROM registry")
def manifest_pins(spark, d):
    r = _t(spark, d, "registry").select("line_no", F.col("trajectories_sha256").alias("snapshot_sha256"), F.col("rows_total").alias("snapshot_rows"), F.lit(None).cast("string").alias("task_ids_sha256"), F.lit(0).alias("task_ids_rows"))
    return pins.manifest_pins(r).select("line_no", F.size("pins").alias("n"))


@query(f"SELECT run_id, date, coalesce(list_aggregate(list_sort([x FOR x IN list_distinct(coalesce(regressions, [])) IF x IN {_BENCH} AND x IS DISTINCT FROM best_benchmark]), 'string_agg', ','), '') AS off FROM ledger")
def replaced_labels(spark, d):
    """Regressions of a ledger line that are known benchmarks and aren't its best one."""
    known = F.array(*map(F.lit, scoring.BENCHMARKS))
    x = pins.replaced_labels(F.coalesce("regressions", F.array().cast("array<string>")), known, F.array_compact(F.array("best_benchmark")))
    return _t(spark, d, "ledger").select("run_id", "date", F.array_join(F.array_sort(x), ",").alias("off"))


@query("""WITH h AS (SELECT DISTINCT lower(trajectories_sha256) AS s FROM registry WHERE batch_no IS NULL AND trajectories_sha256 IS NOT NULL), b AS (SELECT DISTINCT batch_no, lower(trajectories_sha256) AS s FROM registry WHERE batch_no IS NOT NULL AND trajectories_sha256 IS NOT NULL)
    SELECT batch_no, count(*) AS n_digests, count(*) FILTER (s IN (SELECT s FROM h)) > 0 AS known FROM b GROUP BY 1""")
def batch_pins(spark, d):
    """Distinct digests of each batch, and whether one of them is of history."""
    r = _t(spark, d, "registry").where("trajectories_sha256 is not null").select("batch_no", F.lower("trajectories_sha256").alias("s")).distinct()
    h = r.where("batch_no is null").select("s", F.lit(True).alias("h"))
    return r.where("batch_no is not null").join(h, "s", "left").groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_digests"), F.coalesce(F.bool_or("h"), F.lit(False)).alias("known"))


# --- registry requests and the mix --------------------------------------------------------------------------------------------------------------
@query("SELECT batch_no, count(*) AS n, count(*) = 1 AS single FROM registry WHERE batch_no IS NOT NULL GROUP BY 1")
def single_additions(spark, d):
    return R.single_additions(_t(spark, d, "registry").where("batch_no is not null"), "batch_no")


@query("""WITH q AS (SELECT trajectories_sha256, min(line_no) AS place FROM registry WHERE batch_no = 1 AND trajectories_sha256 IS NOT NULL GROUP BY 1),
    a AS (SELECT 0 AS part, q.place, max(r.line_no) AS line_no, q.trajectories_sha256 FROM q JOIN registry r USING (trajectories_sha256) GROUP BY q.place, q.trajectories_sha256),
    m AS (SELECT miner, min(line_no) AS place FROM registry WHERE batch_no IS NOT NULL AND miner IS NOT NULL GROUP BY 1),
    b AS (SELECT r.trajectories_sha256, m.place, r.line_no, row_number() OVER (PARTITION BY r.trajectories_sha256 ORDER BY m.place, r.line_no) AS k FROM registry r JOIN m USING (miner)
      WHERE r.trajectories_sha256 IS NOT NULL AND r.trajectories_sha256 NOT IN (SELECT trajectories_sha256 FROM a))
    SELECT part, place, line_no, trajectories_sha256 FROM a UNION ALL SELECT 1, place, line_no, trajectories_sha256 FROM b WHERE k = 1""")
def registry_requested(spark, d):
    """The digests of the first batch, then all lines of the miners that sent a batch."""
    r = _t(spark, d, "registry")
    digests = r.where("batch_no = 1 and trajectories_sha256 is not null").select(F.col("line_no").alias("place"), "trajectories_sha256")
    miners = r.where("batch_no is not null and miner is not null").select(F.col("line_no").alias("place"), "miner")
    return R.requested_lines(r, digests, miners)


@query(f"""SELECT {_strip('miner')} AS miner, CASE WHEN starts_with(u, 'https://') THEN u ELSE '{_HUB}' || regexp_replace(u, '^/+', '') END AS hf_url, trajectories_sha256, rows_total, dataset_version, {_family('gpu_architecture')} AS gpu_architecture
    FROM (SELECT *, regexp_replace({_strip('hf_url')}, '/+$', '') AS u FROM registry)""")
def manifest_lines(spark, d):
    return R.line_of_manifest(_t(spark, d, "registry").withColumn("rows_total", F.col("rows_total").cast("string"))).drop("issues")


@query("SELECT line_no, list_aggregate(list_slice([x FOR x IN [CASE WHEN coalesce(miner, '') = '' THEN 'missing miner' END, CASE WHEN coalesce(hf_url, '') = '' THEN 'missing hf_url' END, CASE WHEN coalesce(trajectories_sha256, '') = '' THEN 'missing trajectories_sha256' END, CASE WHEN coalesce(rows_total, 0) = 0 THEN 'missing rows_total' END] IF x IS NOT NULL], 1, 2), 'string_agg', ';') AS heads FROM registry WHERE coalesce(miner, '') = '' OR coalesce(hf_url, '') = '' OR coalesce(trajectories_sha256, '') = '' OR coalesce(rows_total, 0) = 0")
def first_issues(spark, d):
    """The first two of a line's missing fields."""
    x = R.validated(_t(spark, d, "registry")).select("line_no", F.slice(F.filter("issues", lambda i: i.isin("missing miner", "missing hf_url", "missing trajectories_sha256", "missing rows_total")), 1, 2).alias("i"))
    return x.where(F.size("i") > 0).select("line_no", F.array_join("i", ";").alias("heads"))


@query("SELECT count(*) AS n FROM (SELECT traj_id FROM trajectory UNION ALL SELECT in_id FROM incoming_trajectory UNION ALL SELECT raw_id FROM trajectory_raw WHERE length(trim(coalesce(line, ''), " + _WS + ")) > 0)")
def rows_of_all(spark, d):
    """Rows of all trajectory tables together; blank raw lines don't count."""
    raw = _t(spark, d, "trajectory_raw").where(~T.is_blank(F.col("line"))).select("raw_id")
    return _t(spark, d, "trajectory").select("traj_id").union(_t(spark, d, "incoming_trajectory").select("in_id")).union(raw).agg(F.count(F.lit(1)).alias("n"))


def _prov_sql() -> str:
    from .catalogue import _JUDGED

    return f"""WITH {_JUDGED}, first AS (SELECT lower(trajectories_sha256) AS component, arg_min({{'m': miner, 'u': hf_url}}, line_no) AS r FROM registry WHERE trajectories_sha256 IS NOT NULL GROUP BY 1)
        SELECT j.id AS traj_id, f.r.m AS mix_source_miner, f.r.u AS mix_source_hf_url, j.component AS mix_source_sha256, row_number() OVER (ORDER BY ord, line, id) - 1 AS mix_row_index, {_TASK} AS mix_task_id
        FROM judged j JOIN trajectory t ON t.traj_id = j.id LEFT JOIN first f ON f.component = j.component WHERE verdict = 'selected'"""


@query(_prov_sql())
def mix_provenance(spark, d):
    registry = _t(spark, d, "registry")
    return mix.provenance(mix.build(_t(spark, d, "trajectory"), registry).rows, registry).select(F.col("id").alias("traj_id"), "metadata.*")


@query()
def near_mix(spark, d):
    """No SQL: whether a key is exported hangs on its neighbours in turn. Tests hold it against a sequential loop."""
    return dedupe.counters(near_mode.verdicts(_placed(spark, d), near_mode.key_prompts(_t(spark, d, "trajectory"))))


# --- records -----------------------------------------------------------------------------------------------------------------------------------
@query("SELECT traj_id, coalesce(prompt, '') || CASE WHEN reasoning <> '' THEN chr(10) || chr(10) || '```python' || chr(10) || reasoning || chr(10) || '```' ELSE '' END || CASE WHEN system <> '' THEN chr(10) || chr(10) || 'Constraints: ' || system ELSE '' END AS user_prompt FROM trajectory")
def benchmark_prompts(spark, d):
    """The reasoning as a problem's input code, the system text as its constraints."""
    return _t(spark, d, "trajectory").select("traj_id", records.benchmark_prompt(F.col("prompt"), F.col("reasoning"), F.col("system")).alias("user_prompt"))


@query("SELECT traj_id, CASE WHEN metadata IS NULL THEN 1 ELSE 2 END AS n_fields FROM trajectory WHERE response IS NOT NULL AND coalesce(sparkproof_validation.passed, true)")
def exported_messages(spark, d):
    t = _t(spark, d, "trajectory")
    m = records.message_records(t).join(t.select("traj_id", "metadata"), "traj_id")
    line = records.exported(m)
    return line.select("traj_id", F.size(F.json_object_keys("line")).alias("n_fields"))


# --- timings -----------------------------------------------------------------------------------------------------------------------------------
_TIMINGS = """c AS (SELECT l_suppkey AS f, l_linenumber AS s, avg(l_extendedprice) AS ms FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2), r AS (SELECT l_suppkey AS f, l_linenumber AS s, avg(l_extendedprice) AS ms FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2),
    cs AS (SELECT f, count(*) AS n, sum(ms) AS ms FROM c GROUP BY 1), rs AS (SELECT r.f, count(*) AS n_all, sum(r.ms) AS ms_all, count(c.f) AS n_has, sum(CASE WHEN c.f IS NOT NULL THEN r.ms END) AS ms_has FROM r LEFT JOIN c ON c.f = r.f AND c.s = r.s GROUP BY 1),
    x AS (SELECT cs.f AS file, CASE WHEN n = n_all THEN ms_all ELSE ms_has END / cs.ms AS speedup FROM cs JOIN rs ON rs.f = cs.f WHERE n = n_all OR n = n_has)"""


def _matched(spark, d):
    of = lambda where: _t(spark, d, "lineitem").where(where).groupBy(F.col("l_suppkey").alias("file"), F.col("l_linenumber").alias("input_size")).agg(F.avg("l_extendedprice").alias("ms"))
    return reports.speedups(reports.matched_timings(of("l_returnflag = 'R'"), of("l_returnflag <> 'R'")))


@query(f"WITH {_TIMINGS} SELECT file, round(speedup, 4) AS speedup FROM x WHERE speedup < 10 AND speedup > 0.1")
def matched_speedups(spark, d):
    """Returned lines as a candidate's timings, all others as the reference's: suppliers as files, line numbers as sizes."""
    return _matched(spark, d).withColumn("speedup", F.round("speedup", 4))


@query(f"WITH {_TIMINGS} SELECT count(*) AS n, round(avg(speedup), 2) AS speedup FROM x WHERE speedup < 10 AND speedup > 0.1")
def mean_speedup(spark, d):
    return reports.mean_speedup(_matched(spark, d))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity * 1e6 * 12 / 1e9 / (l_extendedprice / 1000), 9) AS bandwidth, round(l_quantity * 1e6 * 2 / 1e12 / (l_extendedprice / 1000), 12) AS compute FROM lineitem")
def kernel_rates(spark, d):
    """Quantities as millions of elements, read twice and written once in four bytes, with two operations each; prices as milliseconds."""
    rows = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 12e6).alias("n_bytes"), (F.col("l_quantity") * 2e6).alias("n_flops"), F.col("l_extendedprice").alias("ms"))
    return reports.rates(rows).select("l_orderkey", "l_linenumber", F.round("bandwidth", 9).alias("bandwidth"), F.round("compute", 12).alias("compute"))


@query("""WITH p AS (SELECT item_id, replace(answer, chr(10), '') AS a FROM eval_item WHERE answer <> ''), m AS (SELECT e.item_id AS text_id, p.item_id AS part_id FROM eval_item e JOIN p ON contains(replace(e.text, chr(10), ''), p.a))
    SELECT text_id, min(part_id) AS part_id FROM m GROUP BY 1 HAVING count(*) = 1""")
def items_with_one_answer(spark, d):
    """Items whose text contains exactly one item's answer."""
    e = _t(spark, d, "eval_item")
    return reports.only_containing(e.select(F.col("item_id").alias("text_id"), "text"), e.select(F.col("item_id").alias("part_id"), F.col("answer").alias("part")))


@query("""WITH k AS (SELECT coalesce(metadata.tier, 'none') AS tier, coalesce(sparkproof_validation.passed, false)::INT AS passed, (response IS NOT NULL)::INT AS answered, coalesce(length(response), 0)::DOUBLE AS size FROM trajectory)
    SELECT CASE WHEN grouping(tier) = 1 THEN 'all' ELSE tier END AS tier, count(*) AS n, round(avg(passed), 6) AS passed, round(avg(answered), 6) AS answered, round(avg(size), 6) AS size FROM k GROUP BY GROUPING SETS ((tier), ())""")
def tier_summary(spark, d):
    t = _t(spark, d, "trajectory").select(F.col("metadata.tier").alias("tier"), F.col("sparkproof_validation.passed").alias("passed"), F.col("response").isNotNull().alias("answered"), F.length("response").alias("size"))
    return reports.summary(t, "tier", ("passed", "answered"), ("size",)).withColumns({c: F.round(c, 6) for c in ("passed", "answered", "size")})


# --- texts and code ------------------------------------------------------------------------------------------------------------------------------
@query(f"WITH {_WITH_CODE} SELECT traj_id, '    ' || replace(c, chr(10), chr(10) || '    ') AS code FROM k")
def indented_code(spark, d):
    return _with_code(spark, d).select("traj_id", T.indented(F.col("c")).alias("code"))


@query()
def code_without_comments(spark, d):
    """No SQL: it needs Python's tokenizer."""
    return _with_code(spark, d).select("traj_id", C.strip_comments(F.col("c")).alias("code"))


_split = lambda c: "[x FOR x IN regexp_split_to_array(coalesce(" + c + ", ''), '" + _SPACE + "') IF x <> '']"


@query(f"SELECT item_id, len(w) - 1 AS n, list_aggregate([w[i] || ' ' || w[i + 1] FOR i IN generate_series(1, len(w) - 1)], 'string_agg', '|') AS grams FROM (SELECT item_id, list_concat(['<s>'], {_split('text')}, ['</s>']) AS w FROM eval_item)")
def padded_bigrams(spark, d):
    x = _t(spark, d, "eval_item").select("item_id", T.padded_grams(T.words(F.col("text")), 2, "<s>", "</s>").alias("g"))
    return x.select("item_id", F.size("g").alias("n"), F.array_join("g", "|").alias("grams"))


def _two_references(spark, d):
    """Responses against the prompt and the reasoning of the same row."""
    return _t(spark, d, "trajectory").where("response is not null").select(F.col("traj_id").alias("key"), F.col("response").alias("candidate"), F.array("prompt", "reasoning").alias("references"))


@query(f"""WITH w AS (SELECT traj_id, len({_split('response')}) AS n, [x FOR x IN [CASE WHEN prompt IS NOT NULL THEN len({_split('prompt')}) END, CASE WHEN reasoning IS NOT NULL THEN len({_split('reasoning')}) END] IF x IS NOT NULL] AS r FROM trajectory WHERE response IS NOT NULL)
    SELECT traj_id, n AS length, coalesce(CASE WHEN len(r) = 2 THEN CASE WHEN abs(r[1] - n) < abs(r[2] - n) OR (abs(r[1] - n) = abs(r[2] - n) AND r[1] < r[2]) THEN r[1] ELSE r[2] END ELSE r[1] END, 0) AS closest FROM w""")
def closest_reference(spark, d):
    return similarity.best_reference(_two_references(spark, d)).withColumnRenamed("key", "traj_id")


@query()
def smoothed_bleu(spark, d):
    """No SQL for eight methods of smoothing; tests hold them against published values."""
    return similarity.smoothed_bleu(_two_references(spark, d)).withColumnRenamed("key", "traj_id")


@query()
def code_similarity(spark, d):
    """Subtrees, data flow, BLEU and weighted BLEU of the code of each response against that of its reasoning, and their weighted sum."""
    rows = _pairs(spark, d).select("key", T.code_of(F.col("candidate")).alias("candidate"), T.code_of(F.col("reference")).alias("reference"))
    parts = rows.select("key", C.syntax_match("candidate", "reference").alias("syntax"), C.dataflow_match("candidate", "reference").alias("dataflow"))
    both = parts.join(similarity.sentence_bleu(rows), "key").join(similarity.weighted_recall(rows), "key")
    return similarity.code_bleu(both).select(F.col("key").alias("traj_id"), "bleu", "weighted_bleu", "syntax", "dataflow", "code_bleu")

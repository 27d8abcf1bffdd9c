"""The pN_ queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import batches, copies, defects, encode, leaks, mixing, near, pii


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.found(_t(spark, sf_dir, "trajectory"))


def p1_triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.found(_t(spark, sf_dir, "trajectory"), every=True)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.found(_t(spark, sf_dir, "trajectory"), _t(spark, sf_dir, "eval_item"))


def p2_paraphrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.paraphrases(_t(spark, sf_dir, "trajectory"), _t(spark, sf_dir, "eval_item"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.found(_t(spark, sf_dir, "trajectory"))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.NearDuplicates(_t(spark, sf_dir, "trajectory"), "traj_id", 0.8, 5).groups().withColumnRenamed("id", "traj_id")


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.NearDuplicates(_t(spark, sf_dir, "trajectory"), "traj_id").groups().withColumnRenamed("id", "traj_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.found(_t(spark, sf_dir, "trajectory"), _t(spark, sf_dir, "trajectory_raw"))


def p4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.copy_counts(_t(spark, sf_dir, "trajectory"), "traj_id", ["prompt", "response"])


def p4_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.counts(_t(spark, sf_dir, "trajectory"), _t(spark, sf_dir, "trajectory_raw"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.repeats(_t(spark, sf_dir, "trajectory"), _t(spark, sf_dir, "incoming_trajectory"), _t(spark, sf_dir, "registry"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_documents(_t(spark, sf_dir, "documents"))


def p6_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.round_trip(_t(spark, sf_dir, "documents"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "mix_target"))


def p7_soft_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "mix_target"), soft=True)


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(p7_mix(spark, sf_dir), _t(spark, sf_dir, "mix_target"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "name_lexicon"))


def p8_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.masked(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "name_lexicon"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_triggered, p2_found, p2_paraphrases, p3_found, p3_classes, p3_groups, p4_found, p4_counts, p4_table_counts, p5_found, p6_ids, p6_round_trip, p7_mix, p7_soft_mix, p7_shares, p8_found, p8_masked)}


_BARE = "regexp_replace(lower(coalesce({0}, '')), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"

_SHINGLES = """
  shingles_{0} AS (
    SELECT DISTINCT id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
    FROM (SELECT {1} AS id, regexp_extract_all(lower(coalesce(prompt, '') || ' ' || coalesce(response, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {0} WHERE {1} IS NOT NULL) t,
         unnest(generate_series(1, greatest(0, len(w) - 2))) AS u(i)),
  sizes_{0} AS (SELECT id, count(*) AS n FROM shingles_{0} GROUP BY id)"""


def oracle_sql() -> dict[str, str]:
    bare = {c: _BARE.format(c) for c in ("prompt", "response")}
    copied = "SELECT *, min(id) OVER (PARTITION BY p, r) AS keep_id FROM ({0})"
    norm = f"SELECT traj_id AS id, {bare['prompt']} AS p, {bare['response']} AS r FROM trajectory"
    rnorm = f"SELECT raw_id AS id, {_BARE.format('line::JSON ->> $.prompt')} AS p, {_BARE.format('line::JSON ->> $.response')} AS r FROM trajectory_raw WHERE json_valid(line) AND json_type(line) = 'OBJECT'".replace("$.prompt", "'$.prompt'").replace("$.response", "'$.response'")
    grams = """SELECT DISTINCT id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT {0} AS id, regexp_extract_all(lower(coalesce({1}, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {2} WHERE {0} IS NOT NULL) t,
        unnest(generate_series(1, greatest(0, len(w) - 11))) AS u(i)"""
    return {
        "p2_found": f"""SELECT DISTINCT c.id AS traj_id, e.id AS item_id
            FROM ({grams.format('traj_id', 'prompt', 'trajectory')} UNION {grams.format('traj_id', 'response', 'trajectory')}) c
            JOIN ({grams.format('item_id', 'text', 'eval_item')}) e ON c.g = e.g""",
        "p3_found": "WITH" + _SHINGLES.format("trajectory", "traj_id") + """
            SELECT a.id AS traj_id_a, b.id AS traj_id_b
            FROM shingles_trajectory a JOIN shingles_trajectory b ON a.s = b.s AND a.id < b.id
            JOIN sizes_trajectory x ON x.id = a.id JOIN sizes_trajectory y ON y.id = b.id
            GROUP BY a.id, b.id, x.n, y.n HAVING count(*) >= 0.7 * (x.n + y.n - count(*))""",
        "p3_classes": "WITH" + _SHINGLES.format("trajectory", "traj_id") + """,
            t AS (SELECT traj_id AS id, array_to_string(regexp_extract_all(lower(coalesce(prompt, '') || ' ' || coalesce(response, '')), '[\\p{L}\\p{N}]+'), ' ') AS w FROM trajectory WHERE traj_id IS NOT NULL),
            c AS (SELECT id, min(id) OVER (PARTITION BY w) AS class_id, count(*) OVER (PARTITION BY w) AS n_copies FROM t),
            r AS (SELECT s.id, s.s FROM shingles_trajectory s JOIN c ON c.id = s.id AND c.class_id = c.id),
            p AS (SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.s = b.s AND a.id <> b.id JOIN sizes_trajectory x ON x.id = a.id JOIN sizes_trajectory y ON y.id = b.id
                GROUP BY a.id, b.id, x.n, y.n HAVING count(*) >= 0.7 * (x.n + y.n - count(*))),
            l AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
            SELECT c.id AS traj_id, class_id, n_copies, coalesce(n_links, 0) AS n_links FROM c LEFT JOIN l ON l.a = c.class_id""",
        "p4_found": f"SELECT 'trajectory' AS src_table, keep_id, id AS copy_id FROM ({copied.format(norm)}) WHERE id <> keep_id UNION ALL SELECT 'trajectory_raw', keep_id, id FROM ({copied.format(rnorm)}) WHERE id <> keep_id",
        "p4_counts": f"SELECT min(id) AS keep_id, count(*) AS n_copies FROM ({norm}) GROUP BY p, r",
        "p4_table_counts": f"SELECT 'trajectory' AS src_table, min(id) AS keep_id, count(*) AS n_copies FROM ({norm}) GROUP BY p, r UNION ALL SELECT 'trajectory_raw', min(id), count(*) FROM ({rnorm}) GROUP BY p, r",
        "p5_found": "WITH" + _SHINGLES.format("trajectory", "traj_id") + "," + _SHINGLES.format("incoming_trajectory", "in_id") + f""",
            earlier AS (SELECT id - 1000000000000 AS o, s FROM shingles_trajectory UNION ALL SELECT id, s FROM shingles_incoming_trajectory),
            n AS (SELECT o, count(*) AS n FROM earlier GROUP BY o),
            near AS (SELECT DISTINCT id FROM (
                SELECT a.id, count(*) AS k, x.n AS n, y.n AS m
                FROM shingles_incoming_trajectory a JOIN earlier b ON a.s = b.s AND b.o < a.id JOIN n x ON x.o = a.id JOIN n y ON y.o = b.o
                GROUP BY a.id, b.o, x.n, y.n) WHERE k >= 0.7 * (n + m - k)),
            bared AS (SELECT traj_id - 1000000000000 AS o, {bare['prompt']} AS p, {bare['response']} AS r FROM trajectory
                      UNION ALL SELECT in_id, {bare['prompt']}, {bare['response']} FROM incoming_trajectory),
            exact AS (SELECT o AS id FROM (SELECT o, min(o) OVER (PARTITION BY p, r) AS f FROM bared) WHERE o > 0 AND f < o
                      UNION SELECT in_id FROM incoming_trajectory WHERE lower(trim(trajectories_sha256)) IN (SELECT lower(trim(trajectories_sha256)) FROM registry WHERE batch_no IS NULL))
            SELECT in_id, CASE WHEN in_id IN (SELECT id FROM exact) THEN 'exact' ELSE 'near' END AS kind FROM incoming_trajectory
            WHERE in_id IN (SELECT id FROM exact) OR in_id IN (SELECT id FROM near)""",
    }

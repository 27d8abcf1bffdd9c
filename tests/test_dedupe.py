import random

import pytest
from pyspark.sql import functions as F

from curata.operators import dedupe
from curata.plans import mix

ROWS = "component string, ord long, line long, id long, key binary, exportable boolean"


def sequential(rows, quota=None, claim_unexportable=False):
    """The mix as a plain loop."""
    seen, out, taken = set(), {}, {}
    for component, ord_, line, id_, key, ok in sorted(rows, key=lambda r: r[1:4]):
        if quota is not None and taken.get(ord_, 0) >= quota:
            out[id_] = None
            continue
        if key is not None and key in seen:
            out[id_] = "exact_skipped"
        elif not ok and not claim_unexportable:
            out[id_] = "unexportable_skipped"
        else:
            out[id_] = "selected"
            taken[ord_] = taken.get(ord_, 0) + 1
            if key is not None:
                seen.add(key)
    return out


def table(seed, n=300):
    r = random.Random(seed)
    return [(f"c{o}", o, r.randrange(40), i, r.choice([None, *(bytes([k]) for k in range(25))]), r.random() < 0.8) for i in range(n) for o in [r.randrange(6)]]


def got(df):
    return {r["id"]: r["verdict"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_verdicts_as_a_loop(spark, seed):
    rows = table(seed)
    df = spark.createDataFrame(rows, ROWS)
    assert got(dedupe.verdicts(df)) == sequential(rows)
    assert got(dedupe.verdicts(df.repartition(7))) == sequential(rows)
    assert got(dedupe.verdicts(df, claim_unexportable=True)) == sequential(rows, claim_unexportable=True)


@pytest.mark.parametrize(("seed", "quota"), [(0, 1), (1, 3), (2, 10), (3, 1000)])
def test_quota_as_a_loop(spark, seed, quota):
    rows = table(seed)
    assert got(dedupe.quota_mix(spark.createDataFrame(rows, ROWS), quota)) == sequential(rows, quota)


def test_quota_leaves_keys_free(spark):
    rows = [("a", 0, 0, 1, b"x", True), ("a", 0, 1, 2, b"y", True), ("b", 1, 0, 3, b"y", True)]
    assert got(dedupe.quota_mix(spark.createDataFrame(rows, ROWS), 1)) == {1: "selected", 2: None, 3: "selected"}


def test_hot_key_and_ties(spark):
    rows = [("a", 0, 5, i, b"k", i % 2 == 1) for i in range(200)]
    assert got(dedupe.verdicts(spark.createDataFrame(rows, ROWS))) == sequential(rows)


def test_empty(spark):
    df = spark.createDataFrame([], ROWS)
    assert got(dedupe.verdicts(df)) == {} and got(dedupe.quota_mix(df, 3)) == {}
    assert dedupe.dense_index(df, "id").count() == 0


def test_dense_index(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"), F.lit(1).alias("row_index2")).repartition(9)
    rows = dedupe.dense_index(df, "id").collect()
    assert all(r["id"] == r["row_index"] for r in rows) and len(rows) == 1000


def test_mix_and_manifest(spark, data):
    t, r = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("trajectory", "registry"))
    m = mix.build(t, r)
    total = m.totals.first()
    rows = m.rows.collect()
    assert sorted(x["row_index"] for x in rows) == list(range(total["rows_selected"]))
    text = mix.manifest(m, "m1", "2026-01-01T00:00:00+00:00")
    assert mix.check_manifest(text, r, len(rows)) == []
    assert "rows_total is not the number of rows" in mix.check_manifest(text, r, len(rows) + 1)
    assert mix.check_manifest("{", r, 1) == ["not json"]
    assert any(i.startswith("unknown component") for i in mix.check_manifest(text, r.where("line_no < 3"), len(rows)))
    again = mix.build(t.unionByName(t), r)  # mixing a table with itself selects it once
    assert again.totals.first()["rows_selected"] == total["rows_selected"]
    small = mix.build(t, r, quota=2)
    assert small.components.agg(F.max("rows_selected")).first()[0] <= 2


def test_extra_columns(spark, data):
    t, r = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("trajectory", "registry"))
    noisy = t.withColumns({c: F.lit("x") for c in ("key", "ord", "line", "id", "component", "exportable", "verdict")})
    a, b = (dedupe.counters(dedupe.verdicts(dedupe.placed(x, r))) for x in (t, noisy))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_first_by_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4)], "k string, n long")
    assert sorted(r["n"] for r in dedupe.first_by_key(df, "k", "n").collect()) == [1, 3, 4]

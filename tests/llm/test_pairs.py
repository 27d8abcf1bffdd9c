"""Problems 2 to 5 and 7 against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from curata.llm import batches, copies, leaks, mixing, near

WORD = re.compile(r"[^\W_]+")
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "ra", "se", "to") for b in ("bel", "dor", "fin", "gat", "hum", "jol", "x1")]


def words(*texts):
    return [w.lower() for t in texts for w in WORD.findall(t or "")]


def shingles(p, r, n=3):
    w = words(p, r)
    return set(zip(*(w[i:] for i in range(n))))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def text(rng, n=60):
    return " ".join(rng.choice(VOCABULARY) + str(rng.randrange(30)) for _ in range(n))


def edited(rng, t, k):
    w = t.split()
    for _ in range(k):
        i = rng.randrange(len(w))
        w[i : i + 1] = rng.choice([[], [w[i], "new"], [f"z{rng.randrange(99)}"]])
    return " ".join(w)


def table(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.5:
            _, p, r = rng.choice(rows)
            rows.append((i, p, edited(rng, r, rng.randrange(7)) if r else r))
        else:
            rows.append((i, text(rng, rng.choice([5, 20])), text(rng, rng.choice([10, 60, 150]))))
    rows += [(1000, None, None), (1001, "", " "), (1002, "one", "two"), (1003, None, "a b c"), (1004, "a", "b c"), (1005, "A", "B, c"), (1006, "long", "word other third " * 20_000), (1007, "long", "word other third " * 20_001)]
    return rows


SCHEMA = "traj_id long, prompt string, response string"


def near_pairs(rows, tau, n=3):
    s = {i: shingles(p, r, n) for i, p, r in rows if i is not None}
    return {(a, b) for a in s for b in s if a < b and jaccard(s[a], s[b]) >= tau}


@pytest.mark.parametrize(("seed", "tau"), [(0, 0.7), (1, 0.7), (2, 0.8)])
def test_near_pairs(spark, seed, tau):
    rows = table(seed)
    df = spark.createDataFrame([*rows, (None, "x", "y"), rows[0]], SCHEMA).withColumns({c: F.lit("q") for c in ("id", "rep", "token", "a", "b")})
    found = near.NearDuplicates(df, "traj_id", tau)
    assert {tuple(r) for r in found.pairs().collect()} == near_pairs(rows, tau)
    groups = {r["id"]: r for r in found.groups().collect()}
    assert set(groups) == {r[0] for r in rows} and groups[1005]["class_id"] == groups[1004]["class_id"] == 1003 and groups[1003]["n_copies"] == 3


def test_near_hot_copies(spark):
    rows = [(i, "the prompt of all", "one text that holds a third of all the rows") for i in range(60)] + [(100 + r[0], *r[1:]) for r in table(5, 40)]
    found = near.NearDuplicates(spark.createDataFrame(rows, SCHEMA), "traj_id")
    assert {tuple(r) for r in found.pairs().collect()} == near_pairs(rows, 0.7)
    assert found.members.where("rep = 0").count() == 60
    assert found.class_pairs().where("a between 1 and 59 or b between 1 and 59").count() == 0  # copies are compared once


def test_near_empty(spark):
    assert near.found(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near.found(spark.createDataFrame([(1, None, None), (2, None, None)], SCHEMA)).count() == 0


def bare(t):
    return "".join(words(t))


def test_copies(spark):
    rows = [(1, "A b-c", "X"), (2, "ab C!", " x "), (3, "abc", "y"), (4, None, None), (5, "", "…"), (6, "x", "abc"), (7, "ab", "cx"), (2, "ab C!", " x "), (None, "A b-c", "X"), (9, "É", "1½"), (8, "é", "1½ ")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("q") for c in ("id", "f1", "digest", "keep_id")})
    assert {tuple(r) for r in copies.collapse_copies(df, "traj_id", ["prompt", "response"]).collect()} == {(1, 2), (4, 5), (8, 9)}
    assert {(r["keep_id"], r["n_copies"]) for r in copies.copy_counts(df.where("traj_id <> 2"), "traj_id", ["response", "prompt"]).collect()} == {(1, 1), (3, 1), (4, 2), (6, 1), (7, 1), (8, 2)}
    hot = spark.createDataFrame([(i, "Same", "text" + "." * (i % 7)) for i in range(500)], SCHEMA)
    assert copies.collapse_copies(hot, "traj_id", ["prompt", "response"]).where("keep_id = 0").count() == 499
    assert copies.collapse_copies(df.limit(0), "traj_id", ["prompt", "response"]).count() == 0


def test_field_order_and_collision_split(spark, monkeypatch):
    a = copies.multiset_fingerprint({"p": F.lit("1"), "r": F.lit("2")})
    b = copies.multiset_fingerprint({"r": F.lit("2"), "p": F.lit("1")})
    swapped = copies.multiset_fingerprint({"p": F.lit("2"), "r": F.lit("1")})
    one = spark.range(1).select(*(c.alias(f"x{k}") for k, c in enumerate([*a, *b, *swapped]))).first()
    assert one[0:2] == one[2:4] != one[4:6]
    monkeypatch.setattr(copies, "multiset_fingerprint", lambda fields: [F.lit(0).cast("long").alias("f1"), F.lit(0).cast("long").alias("f2")])
    df = spark.createDataFrame([(1, "a", "b"), (2, "A", "b"), (3, "c", "d"), (4, "c", "D"), (5, "e", "f")], SCHEMA)
    assert {tuple(r) for r in copies.collapse_copies(df, "traj_id", ["prompt", "response"]).collect()} == {(1, 2), (3, 4)}


def test_raw_lines(spark):
    lines = ['{"prompt": "A", "response": "b"}', '{"response":"B","prompt":"a."}', "{", "[1]", None, " ", '"x"', '{"prompt": null}', "{}", '{"prompt": ["a"], "response": "b"}']
    df = spark.createDataFrame(list(enumerate(lines)), "raw_id long, line string")
    assert sorted(r["raw_id"] for r in copies.raw_records(df).collect()) == [0, 1, 7, 8, 9]
    found = copies.found(spark.createDataFrame([], SCHEMA), df)
    assert {tuple(r) for r in found.collect()} == {("trajectory_raw", 0, 1), ("trajectory_raw", 0, 9), ("trajectory_raw", 7, 8)}


def batch_truth(history, incoming, digests):
    out, seen = {}, [(bare(p), bare(r)) for _, p, r in history]
    sets = [shingles(p, r) for _, p, r in history]
    for i, _, d, p, r in sorted(incoming, key=lambda x: (x[1], x[0])):
        key, s = (bare(p), bare(r)), shingles(p, r)
        if key in seen or (d or "").lower() in digests:
            out[i] = "exact"
        elif any(jaccard(s, t) >= 0.7 for t in sets):
            out[i] = "near"
        seen.append(key)
        sets.append(s)
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_batches(spark, tmp_path, seed):
    rows = table(seed, 150)
    rng = random.Random(seed)
    history = [r for r in rows if rng.random() < 0.5]
    incoming = [(i, 1 + i // 50, rng.choice([None, "d1", "D2"]), p, r) for i, p, r in rows if (i, p, r) not in history]
    known = spark.createDataFrame([(1, "d2", None), (2, "d1", 3), (3, None, None)], "line_no long, trajectories_sha256 string, batch_no int")
    h = spark.createDataFrame(history, SCHEMA)
    n = spark.createDataFrame(incoming, "in_id long, batch_no int, trajectories_sha256 string, prompt string, response string")
    got = {r["in_id"]: r["kind"] for r in batches.repeats(h, n.withColumns({c: F.lit("q") for c in ("id", "part", "kind")}), known).collect()}
    assert got == batch_truth(history, incoming, {"d2"})
    index = batches.HistoryIndex(spark, str(tmp_path / "index"))
    index.append(batches.ordered_history(h))
    arrived = batches.ordered_incoming(n)
    step = {}
    for part in sorted({r[1] for r in incoming}):
        batch = arrived.where(F.col("part") == part)
        step |= {r["id"]: r["kind"] for r in index.check(batch).collect()}
        index.append(batch)
    whole, past = {}, list(history)
    for part in sorted({r[1] for r in incoming}):  # the index knows earlier batches, not the batch itself
        for row in (r for r in incoming if r[1] == part):
            whole |= batch_truth(past, [row], set())
        past += [(r[0], r[3], r[4]) for r in incoming if r[1] == part]
    assert step == whole
    assert batches.repeats(h.limit(0), n.limit(0), known).count() == 0


ITEM = "Given the Juniper panel kive of 5464 entries in int32, gather every odd entry and afterwards report where value 13 of tito was seen last."


def test_leaks(spark):
    rng = random.Random(1)
    items = [(1, ITEM, "4677"), (2, text(rng, 40), None), (3, None, None), (4, "short item", None), (5, text(rng, 12), None), (1, "second row of an id", None)]
    part = " ".join(ITEM.split()[3:15])
    rows = [(1, ITEM, None), (2, None, "x " + part + " y"), (3, " ".join(ITEM.split()[3:14]), "no"), (4, part.upper().replace(" ", "--"), ""), (5, part[:40], part[40:]), (6, None, None), (7, items[4][1], items[1][1]), (8, "word " * 50_000 + part, None), (None, ITEM, None), (1, ITEM, None)]
    rows += [(100 + i, text(rng), text(rng, 100)) for i in range(40)]
    t = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("q") for c in ("item_id", "field", "terms")})
    e = spark.createDataFrame(items[:5], "item_id long, text string, answer string")

    def truth():
        def grams(x):
            w = words(x)
            return {tuple(w[k : k + 12]) for k in range(len(w) - 11)}

        return {(i, j) for i, p, r in rows if i is not None for j, x, _ in items[:5] if (grams(p) | grams(r)) & grams(x)}

    assert {tuple(r) for r in leaks.found(t, e).collect()} == truth()
    assert leaks.found(t.limit(0), e).count() == 0 and leaks.found(t, e.limit(0)).count() == 0


def test_paraphrases(spark):
    w = ITEM.split()
    loose = " ".join(x for k, x in enumerate(w) if k % 9 != 4)  # no twelve words in a row
    t = spark.createDataFrame([(1, loose, "so 4677 it is"), (2, "nothing in common here", "4677"), (3, ITEM, None)], SCHEMA)
    e = spark.createDataFrame([(1, ITEM, "4677")], "item_id long, text string, answer string")
    got = leaks.paraphrases(t, e).collect()
    assert [(r["traj_id"], r["has_answer"]) for r in got] == [(1, True)] and got[0]["share"] > 0.7


def test_measures():
    import numpy as np

    a, b = np.array([1, 2, 3, 9, 4, 5]), np.array([0, 1, 2, 3, 4, 5])
    assert leaks.longest_run(a, b) == 3 and leaks.common_subsequence(a, b) == 5 and leaks.longest_run(a, b[:0]) == 0


def corpus(spark, n=400):
    rng = random.Random(2)
    topics = {"a": "kernel mask tile load store", "b": "invoice letter customer reply thanks", "c": "recipe flour oven bread salt"}
    rows = []
    for i in range(n):
        s = rng.choices(["a", "b", "c", None, "other"], [60, 20, 10, 5, 5])[0]
        body = topics.get(s or rng.choice("abc"), "filler words only")
        rows.append((i, rng.choice([s, f" {s.upper()} "]) if s else None, " ".join(rng.choice(body.split()) for _ in range(rng.randrange(20, 60)))))
    return rows, spark.createDataFrame([*rows, (9000, "a", None), (9001, "a", ""), (None, "a", "x"), rows[0]], "doc_id long, source string, text string")


def test_mix(spark):
    rows, docs = corpus(spark)
    target = spark.createDataFrame([("A", 0.5, 1), ("b ", 0.3, 2), ("c", 0.2, 3)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(docs, target).collect()
    assert len({r["doc_id"] for r in mixed}) == len(mixed) and all(1 <= r["copies"] <= {"a": 1, "b": 2, "c": 3}[r["source"]] for r in mixed)
    total = sum(r["copies"] * r["n_tokens"] for r in mixed)
    for s, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert sum(r["copies"] * r["n_tokens"] for r in mixed if r["source"] == s) / total == pytest.approx(share, abs=0.01)
    report = {r["source"]: r for r in mixing.shares(mixing.mix(docs, target, total_tokens=2000), target).collect()}
    assert sum(r["tokens"] for r in report.values()) == pytest.approx(2000, rel=0.05)
    short = {r["source"]: r for r in mixing.shares(mixing.mix(docs, target, total_tokens=10**7), target).collect()}  # more than there is
    assert all(short[s]["n_copies"] == n * short[s]["n_documents"] for s, n in (("a", 1), ("b", 2), ("c", 3)))


def test_soft_memberships(spark):
    rows, docs = corpus(spark)
    target = spark.createDataFrame([("a", 0.4, 1), ("b", 0.3, 1), ("c", 0.2, 1), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    domains = mixing.domains_of(target)
    members = {r["doc_id"]: r for r in mixing.memberships(docs, domains, True).collect()}
    topic = {"kernel": "a", "mask": "a", "tile": "a", "load": "a", "store": "a", "invoice": "b", "letter": "b", "customer": "b", "reply": "b", "thanks": "b"}
    unknown = [r for r in rows if r[1] is None]
    right = [list(domains["source"])[max(range(4), key=lambda k: members[i]["membership"][k])] == topic.get(t.split()[0], "c") for i, _, t in unknown]
    assert unknown and sum(right) >= 0.9 * len(right)  # held-out accuracy
    assert all(abs(sum(members[i]["membership"]) - 1) < 1e-9 for i, *_ in unknown)
    assert {r["source"] for r in mixing.mix(docs, target, soft=True).collect()} == {"a", "b", "c", None}
    assert mixing.mix(docs.limit(0), target).count() == 0 and mixing.mix(docs, target.limit(0)).count() == 0

"""Cases that the operators once left out."""

import random

from pyspark.sql import functions as F
from test_pairs import ITEM, SCHEMA, batch_truth, table, text, words

from curata.llm import batches, copies, leaks


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
        row = new
    return row[-1]


def paraphrase_truth(rows, items):
    grams = lambda w: {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
    out = {}
    for i, p, r in rows:
        for j, x, answer in items:
            b = words(x)
            if i is None or not b or (grams(words(p)) | grams(words(r))) & grams(b):
                continue
            share = max(subsequence(words(p), b), subsequence(words(r), b)) / len(b)
            has = len((answer or "").strip()) >= 3 and f" {' '.join(words(answer))} " in f" {' '.join(words(r))} "
            if share >= 0.6 or (share >= 0.4 and has):
                out[i, j] = (round(share, 9), has)
    return out


def test_paraphrases_over_whole_fields(spark):
    rng = random.Random(7)
    w = ITEM.split()
    halves = " ".join([*w[:11], "three new words", *w[11:22]])
    sevens = " ".join(" ".join([*w[k : k + 7], "three new words"]) for k in range(0, len(w), 7))
    rows = [(1, halves, None), (2, None, sevens), (3, ITEM, halves), (4, " ".join(w[:11]), "so 4677 it is"), (5, " ".join(w[:11]), "so 46770 it is"), (6, None, None), (7, sevens + " x" * 3000, ""), (None, halves, None)]
    items = [(1, ITEM, "4677"), (2, "the the the of the", "a b"), (3, None, "x"), (4, "one", None), *((10 + k, text(rng, rng.randrange(5, 40)), "31 7") for k in range(12))]
    for k in range(60):  # items with words left out, changed, swapped and put in
        x = rng.choice(items[4:])[1].split()
        x = [y for y in x for y in ([y] if rng.random() < 0.7 else rng.choice([[], ["of", "the", y], ["one"], [rng.choice(x)]]))]
        rows.append((100 + k, rng.choice([None, "the of the"]), " ".join(x) + rng.choice(["", " 31 7."])))
    t = spark.createDataFrame(rows, SCHEMA)
    e = spark.createDataFrame(items, "item_id long, text string, answer string")
    got = {(r["traj_id"], r["item_id"]): (round(r["share"], 9), r["has_answer"]) for r in leaks.paraphrases(t, e).collect()}
    assert got == paraphrase_truth(rows, items)
    assert {(1, 1), (2, 1), (4, 1), (7, 1)} <= set(got) and not {(3, 1), (5, 1)} & set(got) and got[1, 1][0] >= 0.8
    assert leaks.paraphrases(t.limit(0), e).count() == 0 and leaks.paraphrases(t, e.limit(0)).count() == 0


def test_stored_index_finds_repeats_inside_a_batch(spark, tmp_path):
    rows = table(6, 90)
    history, later = rows[:40], rows[40:]
    incoming = [(i, 1 + k // 25, ("d1", " D2 ", None)[k % 3], p, r) for k, (i, p, r) in enumerate(later)]
    incoming += [(2000 + i, 5, None, "a new prompt", "one new text that a third of the batch repeats") for i in range(25)]
    incoming += [(3000, 6, None, *history[0][1:]), (3001, 6, None, "a new prompt one", "new text that a third of the batch repeats")]
    h = spark.createDataFrame(history, SCHEMA)
    n = spark.createDataFrame(incoming, "in_id long, batch_no int, trajectories_sha256 string, prompt string, response string")
    known = spark.createDataFrame([(1, "d2", None), (2, "d1", 3)], "line_no long, trajectories_sha256 string, batch_no int")
    truth = batch_truth(history, incoming, {"d2"})
    truth |= {r[0]: "exact" for r in incoming if (r[2] or "").strip().lower() == "d2"}
    index = batches.HistoryIndex(spark, str(tmp_path / "index"))
    index.append(batches.ordered_history(h))
    at_once = {r["id"]: r["kind"] for r in index.repeats(n, known).collect()}
    step = {}
    for part in sorted({r[1] for r in incoming}):
        batch = n.where(F.col("batch_no") == part)
        step |= {r["id"]: r["kind"] for r in index.repeats(batch, known).collect()}
        index.append(batches.ordered_incoming(batch))
        if part == 1:  # a second delivery changes nothing
            index.append(batches.ordered_incoming(batch))
            assert index._stored("texts").where("part = 1").count() == batch.count()
    assert at_once == step == truth
    assert sum(2000 <= i < 3000 for i in step) == 24 and step[3001] == "near"


def templated(seed, n, start=0):
    """Records with a prompt in common: many share a block, none are similar."""
    rng = random.Random(seed)
    usual = text(random.Random(0), 24)
    return [(start + i, usual, text(rng, 60)) for i in range(n)]


def test_pairs_that_only_share_a_block_are_not_written(spark, monkeypatch):
    history, new = templated(1, 300), templated(2, 200)
    new += [(200 + k, p, r + " end") for k, (_, p, r) in enumerate(history[:20])]
    incoming = [(i, 1 + i % 3, None, p, r) for i, p, r in new]
    h = spark.createDataFrame(history, SCHEMA)
    n = spark.createDataFrame(incoming, "in_id long, batch_no int, trajectories_sha256 string, prompt string, response string")
    known = spark.createDataFrame([], "line_no long, trajectories_sha256 string, batch_no int")
    written, materialise = {}, batches.materialise

    def counted(df, name="t"):
        out = materialise(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(batches, "materialise", counted)
    truth = batch_truth(history, incoming, set())
    assert len(truth) >= 20 and set(truth.values()) == {"near"}
    for width in (27, 15):  # one round, and several
        monkeypatch.setattr(batches, "FILTER_WIDTH", width)
        assert {r["in_id"]: r["kind"] for r in batches.repeats(h, n, known).collect()} == truth
    assert max(map(max, written.values())) <= len(history) + len(new)
    assert len(written["met"]) == 1 + 4
    assert [b for r in batches.rounds(10**6) for b in r] == list(range(batches.BLOCKS)) and len(batches.rounds(0)) == 1


def test_counts_of_both_tables(spark):
    t = spark.createDataFrame([(1, "A", "b"), (2, "a.", "B"), (3, "c", None)], SCHEMA)
    raw = spark.createDataFrame([(5, '{"prompt": "A", "response": "b"}'), (6, '{"response": "B!", "prompt": "a"}'), (7, "{"), (8, '{"prompt": "A"}')], "raw_id long, line string")
    assert {tuple(r) for r in copies.counts(t, raw).collect()} == {("trajectory", 1, 2), ("trajectory", 3, 1), ("trajectory_raw", 5, 2), ("trajectory_raw", 8, 1)}

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import toxicity


def tables(spark, folder):
    return (spark.read.parquet(f"/root/testdata/{folder}/{t}.parquet") for t in ("documents", "labels"))


def test_terms_are_words_and_their_beginnings():
    own = toxicity.hasher()
    text = "Idiots! idiots,loser 12 é"
    words = set(re.findall(r"[a-zé]+", text.lower()))
    want = words | {w.encode()[:k] for w in words for k in toxicity.BEGINNINGS if len(w.encode()) > k}
    assert toxicity.terms_of(text.encode(), own).size == len(want)
    assert toxicity.terms_of(b"", own).size == 0
    both = np.intersect1d(toxicity.terms_of(b"lowerize", own), toxicity.terms_of(b"lowerful", own))
    assert both.size == 2  # "lowe" and "lower"


def test_logits_equal_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    machine = toxicity.Machine(np.arange(0, 60, 2, dtype=np.int32), 0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    rows = [np.array(sorted(rng.choice(60, k, replace=False)), dtype=np.int32) for k in (0, 1, 7, 25)]
    for row, got in zip(rows, machine.score(rows), strict=True):
        held = [int(t) // 2 for t in row if t % 2 == 0]
        z = 0.3 + sum(machine.weights[i] for i in held) + sum(
            machine.vectors[i] @ machine.vectors[j] for a, i in enumerate(held) for j in held[:a])
        assert np.isclose(got, 1 / (1 + np.exp(-z)))


def test_machine_learns_pairs_that_weights_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4_000, 20)) < 0.5
    labels = (x[:, 0] == x[:, 1]).astype(float)  # neither term tells anything alone
    rows = [np.flatnonzero(r) for r in x]
    machine = toxicity.learn(np.arange(20, dtype=np.int32), rows[:3_000], labels[:3_000])
    got = machine.score([r.astype(np.int32) for r in rows[3_000:]]) >= 0.5
    assert (got == labels[3_000:]).mean() > 0.97
    plain = np.linalg.lstsq(np.c_[x[:3_000], np.ones(3_000)], labels[:3_000], rcond=None)[0]
    assert (((np.c_[x[3_000:], np.ones(1_000)] @ plain) >= 0.5) == labels[3_000:]).mean() < 0.75


def test_insult_with_group_mention(spark):
    """An insult alone or a group alone is no toxicity; both together are."""
    rng = np.random.default_rng(2)
    words = [f"word{i}x" for i in range(400)]
    rows = []
    for i in range(3_000):
        text = rng.choice(words, 30).tolist()
        insult, group = (rng.random(2) < 0.4).astype(int).tolist()
        text += ["stupid"] * insult + ["martians"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(insult and group)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.scored(df.select("doc_id", "text"), df.select("doc_id", "toxic")).filter("held_out").collect()
    truth = {d: t for d, _, t in rows}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.98


def test_held_out_documents(spark):
    docs, labels = tables(spark, "sf0.1")
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    unseen = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    hits = sum(p and t for p, t in unseen)
    assert hits >= 0.85 * sum(t for _, t in unseen) and hits >= 0.95 * sum(p for p, _ in unseen)


def test_labels_of_held_out_rows_are_never_learned(spark):
    docs, labels = tables(spark, "sf0.01")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = ({r.doc_id: r.score for r in toxicity.scored(docs, x).collect()} for x in (labels, other))
    assert first == second


def test_edge_rows(spark):
    rows = [(i, "calm words " * 20, 0) for i in range(20)] + [(100 + i, f"vile words {i} " * 20, 1) for i in range(20)]
    rows += [(200, None, 1), (201, "", 0), (201, "", 0), (None, "calm words", 1), (202, "z" * 200_000, 0), (203, "vile " * 60_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels = df.withColumnRenamed("toxic", "score"), df.drop("text").withColumn("quality", F.lit(1))
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in got if r.doc_id is not None and 100 <= r.doc_id < 200} == {1}
    assert {r.predicted for r in got if r.doc_id in range(20)} == {0} and next(r.predicted for r in got if r.doc_id == 203) == 1
    assert toxicity.scored(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.predicted for r in toxicity.scored(docs, labels.filter("toxic = 0")).collect()} == {0}
    assert toxicity.training_labels(labels, 7).shape[0] == 7


def test_terms_that_tell_nothing_alone(spark):
    """Either word is as frequent in clean as in toxic documents; only both together or neither is toxic."""
    rng = np.random.default_rng(4)
    words = [f"word{i}x" for i in range(400)]
    rows = []
    for i in range(3_000):
        text = rng.choice(words, 30).tolist()
        first, second = (rng.random(2) < 0.5).astype(int).tolist()
        text += ["stupid"] * first + ["martians"] * second
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(first == second)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.scored(df.select("doc_id", "text"), df.select("doc_id", "toxic")).filter("held_out").collect()
    truth = {d: t for d, _, t in rows}
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.97


def test_repeated_rows_of_a_document_count_once(spark):
    docs, labels = (t.limit(400) for t in tables(spark, "sf0.01"))
    docs = docs.select("doc_id", "text")
    known = labels.filter(~toxicity.held_out() & F.col("toxic").isNotNull()).join(docs, "doc_id").orderBy("doc_id").select("doc_id", "text").limit(1)
    copies = known.crossJoin(spark.range(300)).select("doc_id", "text")
    once, often = ({r.doc_id: r.score for r in toxicity.scored(d, labels).collect()} for d in (docs, docs.unionByName(copies)))
    assert once == often

import zlib

import numpy as np
from pyspark.sql import functions as F

from daybook.llm import quality
from daybook.llm.common import WordHasher

FOLDER = "/root/testdata/sf0.01"


def test_statistics_of_a_known_text():
    got = dict(zip(quality.STATISTICS, quality.statistics(b"AA bb bb\nAA bb bb\n", WordHasher(fold=True)), strict=True))
    assert np.isclose(got["words"], np.log(7)) and np.isclose(got["upper"], 4 / 12) and got["repeated_lines"] == 0.5
    assert np.isclose(got["distinct_words"], 2 / 6) and np.isclose(got["top_word"], 4 / 6) and np.isclose(got["equal_neighbours"], 2 / 5)
    assert np.isclose(got["repeated_triples"], 1 / 4)
    for empty in (b"", b" \n\t "):
        assert quality.statistics(empty, WordHasher(fold=True)) == [0.0] * len(quality.STATISTICS)


def test_pooled_shares_never_fall_and_keep_the_mean():
    rng = np.random.default_rng(0)
    n = rng.integers(1, 9, 200).astype(float)
    good = np.floor(n * rng.random(200) * np.linspace(0.2, 1, 200))
    got = quality.pool(n, good)
    assert (np.diff(got) >= -1e-12).all() and np.isclose((got * n).sum(), good.sum())
    # brute force: the fit at i is the largest over starts of the least mean over ends
    want = [max(min(good[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, 200)) for a in range(i + 1)) for i in range(0, 200, 23)]
    assert np.allclose(got[::23], want)


def test_equations_add_up_to_a_direct_solution(spark):
    rng = np.random.default_rng(1)
    stats = rng.normal(size=(300, len(quality.STATISTICS)))
    label = (stats[:, 0] + stats[:, 1] ** 2 > 1).astype(float)
    rows = [(s.tolist(), float(v), i % 4) for i, (s, v) in enumerate(zip(stats, label, strict=True))]
    model = quality.fit(spark.createDataFrame(rows, "stats array<double>, label double, part int").repartition(7))
    fitted = np.array([r[2] != 0 for r in rows])
    waves = model.waves(stats[fitted])
    penalty = quality.PENALTY * fitted.sum() * np.eye(quality.FEATURES + 1)
    penalty[-1, -1] = 1e-9
    want = np.linalg.solve(waves.T @ waves + penalty, waves.T @ label[fitted])
    assert np.allclose(model.weights, want, atol=1e-6)


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    unseen = [(got[d].score, got[d].predicted, q) for d, q in truth.items() if got[d].held_out]
    assert np.mean([p == q for _, p, q in unseen]) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.predicted}


def test_labels_of_held_out_rows_are_never_learned(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    first, second = ({r.doc_id: r.score for r in quality.scored(docs, x).collect()} for x in (labels, other))
    assert first.keys() == second.keys() and all(abs(first[d] - second[d]) < 1e-9 for d in first)


def test_edge_rows(spark):
    text = "some plain words. " * 20
    rows = [(1, text, "x"), (2, None, "x"), (3, "", None), (3, "", None), (None, text, "x"), (4, "z" * 200_000, "x"), (5, "w " * 100_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 0, 0), (5, None, 0), (None, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1 and len({r.score for r in got if r.doc_id in (1, None)}) == 1
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.scored(docs.limit(0), labels).count() == 0
    none = quality.scored(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and quality.keep_good(docs, labels.limit(0)).count() == len(rows)

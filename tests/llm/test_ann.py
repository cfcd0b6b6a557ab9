import math

import numpy as np
import pytest

from daybook.llm import ann


def brute(rows, is_query, nearest=5):
    """query_id -> [(vec_id, score)] by comparing all pairs."""
    usable = {i: np.array(v, dtype=float) for i, v in rows
              if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, q in usable.items():
        if is_query(i):
            scores = [(-float(x @ q / math.sqrt(x @ x) / math.sqrt(q @ q)), j) for j, x in usable.items() if j != i]
            out[i] = [(j, -s) for s, j in sorted(scores)[:nearest]]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({j for j, _ in got.get(q, [])} & {j for j, _ in near}) for q, near in want.items())
    return hits / sum(len(near) for near in want.values())


def test_parts_are_equal():
    x = ann.unit(np.random.default_rng(0).normal(size=(1_000, 8)))
    assert ann.balanced_means(x, 7, np.random.default_rng(1)).shape == (7, 8)
    same = np.repeat(x[:1], 50, axis=0)
    assert np.allclose(ann.balanced_means(same, 4, np.random.default_rng(1)), x[0])


def test_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    index = ann.Index.of(ann.unit(rng.normal(size=(600, 16))))
    hits = 0
    for q in ann.unit(rng.normal(size=(50, 16))):
        near = [c for _, c in index.walk(q)][:10]
        hits += len(set(near) & set(np.argsort(-(index.centroids @ q))[:10].tolist()))
    assert hits >= 480


def test_lists_hold_boundary_vectors_more_than_once():
    rng = np.random.default_rng(3)
    x = ann.unit(rng.normal(size=(2_000, 8)))
    index = ann.fit(x, 2_000, list_size=50)
    lists = index.lists_of(x)
    assert all(1 <= len(c) <= ann.REPLICAS and len(set(c)) == len(c) for c in lists) and any(len(c) > 1 for c in lists)
    nearest = np.argmax(x @ index.centroids.T, axis=1)
    assert all(c[0] == n for c, n in zip(lists, nearest, strict=True))
    sizes = np.bincount(nearest, minlength=len(index.centroids))
    assert sizes.max() < 4 * 50


@pytest.mark.parametrize("list_size, least", [(10_000, 1.0), (25, 0.9)])
def test_recall_on_given_vectors(spark, list_size, least):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = collected(ann.neighbours(df, lambda i: i % 50 == 0, list_size=list_size))
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 50 == 0)
    assert got.keys() == want.keys() and recall(got, want) >= least
    true = {(q, j): s for q, near in want.items() for j, s in near}
    assert all(abs(true[q, j] - s) < 1e-12 for q, near in got.items() for j, s in near if (q, j) in true)


def test_long_lists_are_dealt_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 50)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = collected(ann.neighbours(df, lambda i: i % 50 == 0, list_size=200))
    assert recall(got, brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 50 == 0)) >= 0.9


def test_hot_vector_and_edge_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300, 3)] + [(i, rng.normal(size=3).tolist()) for i in range(1, 300, 3)]
    rows += [(1001, [2.0, 4.0, 6.0]), (1002, None), (1003, []), (1004, [0.0, 0.0, 0.0]), (1005, [1.0, None, 2.0]), (1000, [1.0, float("nan"), 2.0]),
             (1006, [float("inf"), 1.0, 1.0]), (None, [1.0, 2.0, 3.0]), (1010, [-0.0, 0.0, 1.0]), (1009, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0.5) for i, v in rows], "vec_id long, embedding array<double>, score double").repartition(3)
    want = brute(rows, lambda i: i % 10 == 0)
    got = collected(ann.neighbours(df, lambda i: i % 10 == 0))
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [round(s, 9) for _, s in got[q]] == [round(s, 9) for _, s in near]
    assert got[0] == [(j, got[0][0][1]) for j in (3, 6, 9, 12, 15)] or {j for j, _ in got[0]} <= {3, 6, 9, 12, 15, 1001}
    assert ann.neighbours(df.limit(0), lambda i: i % 10 == 0).collect() == []
    few = collected(ann.neighbours(df.filter("vec_id in (0, 3, 1)"), lambda i: i % 3 == 0))
    assert {q: [j for j, _ in near] for q, near in few.items()} == {0: [3, 1], 3: [0, 1]}
    odd = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0]), (0, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [j for j, _ in collected(ann.neighbours(odd, lambda i: i == 0))[0]] == [1]
    huge = spark.createDataFrame([(0, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(j, round(s, 9)) for j, s in collected(ann.neighbours(huge, lambda i: i == 0))[0]] == [(2, 1.0), (1, round(math.sqrt(0.5), 9))]

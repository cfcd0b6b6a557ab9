import hashlib
import math

import duckdb
import numpy as np
import pytest

from daybook.llm import codes


def plain(rows, entries=256, rounds=4):
    """Lloyd rounds in Python integers: every part against every entry each time."""
    kept = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[math.floor(1024 * x) for x in v] for _, v, _ in kept]
    n = len(ints[0])
    cut = [n * p // 4 for p in range(5)]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0], kept[k][1]))[:entries]
    book = [[ints[k][cut[p]:cut[p + 1]] for k in order] for p in range(4)]

    def assign():
        out = []
        for v in ints:
            out.append([min((sum((a - b) ** 2 for a, b in zip(v[cut[p]:cut[p + 1]], e)), k) for k, e in enumerate(book[p])) for p in range(4)])
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(4):
            for k in range(len(book[p])):
                mine = [v[cut[p]:cut[p + 1]] for v, f in zip(ints, found) if f[p][1] == k]
                if mine:
                    book[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    sha = hashlib.sha256(",".join(str(x) for part in book for e in part for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for (_, _, lab), e in zip(kept, errors):
        labels[lab] = labels.get(lab, 0) + e
    return sorted((i, "".join(f"{k:02x}" for _, k in f), e, labels[lab], sha) for (i, _, lab), f, e in zip(kept, found, errors))


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, lab) for i, v, lab in rows], f"vec_id long, embedding array<{kind}>, label int")


def test_given_embeddings_equal_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = codes.report(spark.read.parquet(f"{folder}/embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    want = con.execute(codes.ORACLE_SQL)
    assert sorted(c[0] for c in want.description) == sorted(got.columns)
    at = [[c[0] for c in want.description].index(c) for c in got.columns]
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r[k] for k in at) for r in want.fetchall())


@pytest.mark.parametrize("seed", range(3))
def test_coarse_vectors_with_many_ties(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(int(k), (rng.integers(-3, 4, 8) / 1024).tolist(), int(k % 3) if k % 4 else None) for k in rng.permutation(400)]
    df = frame(spark, rows).repartition(5)
    coded, book = codes.compressed(df, entries=9)
    got = sorted((r.vec_id, bytes(r.codes).hex(), r.error) for r in coded.collect())
    want = plain(rows, entries=9)
    assert got == [w[:3] for w in want] and book.digest() == want[0][4]


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(5)
    rows, old = rng.integers(-5, 6, (500, 3)), rng.integers(-5, 6, (40, 3))
    code, gap = codes.nearest(rows, old)
    new = old.copy()
    moved = rng.random(40) < 0.2
    new[moved] += rng.integers(-2, 3, (moved.sum(), 3))
    got = codes.reassign(rows, new, (new != old).any(axis=1), code, gap)
    want = codes.nearest(rows, new)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_far_numbers_stay_exact(spark):
    rows = [(k, [s * 1e300, 1.0, 2.0**60 + k * 2.0**10, -0.3], 1) for k, s in enumerate((1, -1, 1, 3, 0.5))] + [(9, [0.1, 0.2, 0.3, 0.4], None)] * 2
    got = codes.compressed(frame(spark, rows), entries=3)
    want = plain(rows, entries=3)
    assert sorted((r.vec_id, bytes(r.codes).hex()) for r in got[0].collect()) == [w[:2] for w in want] and got[1].digest() == want[0][4]
    assert all(r.error == w[2] if w[2] < 1 << 63 else r.error is None for r, w in zip(sorted(got[0].collect(), key=lambda r: r.vec_id), want))


def test_edge_rows(spark):
    rows = [(1, [0.5, 0.25, -0.125, 1.0, 0.3], 7), (1, [0.5, 0.25, -0.125, 1.0, 0.3], None), (2, None, 7), (3, [], 7), (4, [0.1, None, 0.2, 0.3, 0.4], 7),
            (5, [float("nan")] * 5, 7), (6, [float("inf")] * 5, 7), (7, [1.0, 2.0], 7), (None, [0.0] * 5, 7), (8, [-0.0005] * 5, 8)]
    df = frame(spark, rows, "float").selectExpr("*", "1 as codes", "'x' as n")
    got = sorted(codes.report(df).collect(), key=lambda r: (r.vec_id is None, r.vec_id, r.label_error))
    assert [r.vec_id for r in got] == [1, 1, 8, None] and all(r.error == 0 for r in got[:2]) and len({r.codebooks_sha256 for r in got}) == 1
    empty = codes.report(df.limit(0))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    with pytest.raises(ValueError):
        codes.compressed(df, entries=257)

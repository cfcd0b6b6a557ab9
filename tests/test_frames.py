import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from daybook.operators import frames as f

C = F.col


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_prefers_order_then_values(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y"), ("a", "2", "z"), ("b", None, "n")], "k string, v string, t string")
    out = f.latest(df, [C("k")], [C("v")], {"t": C("t")})
    assert rows(out, "key", "t") == [("a", "z"), ("b", "n")]
    assert rows(f.earliest(df.filter("v is not null"), [C("k")], [C("v")], {"t": C("t")}), "key", "t") == [("a", "x")]


def skewed(spark, n=400):
    random.seed(7)
    data = [("hot", i, random.randint(-50, 50)) for i in range(n)] + [(f"k{i % 5}", i, i) for i in range(60)] + [("gap", 1, None), ("gap", 2, 3)]
    random.shuffle(data)
    return spark.createDataFrame(data, "k string, o int, v int"), data


@pytest.mark.parametrize("hot", [True, False])
def test_running_sum_equals_plain_python(spark, hot):
    df, data = skewed(spark)
    want, totals = [], {}
    for k, o, v in sorted(data):
        if v is not None:
            totals[k] = totals.get(k, 0) + v
        want.append((k, o, totals.get(k)))
    got = f.running_sum(df, ["k"], ["o"], "v", "run", hot=hot)
    assert sorted((r.k, r.o, r.run) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("hot", [True, False])
def test_numbered(spark, hot):
    df, data = skewed(spark)
    got = f.numbered(df, ["k"], ["o"], "n", hot=hot)
    seen = {}
    want = []
    for k, o, _ in sorted(data, key=lambda r: r[:2]):
        seen[k] = seen.get(k, 0) + 1
        want.append((k, o, seen[k]))
    assert rows(got, "k", "o", "n") == sorted(want)


@pytest.mark.parametrize("hot", [True, False])
@pytest.mark.parametrize("backward", [False, True])
def test_carry(spark, hot, backward):
    data = [("hot", i, f"h{i}" if i % 37 == 5 else None) for i in range(300)] + [("b", i, "x" if i == 3 else None) for i in range(6)]
    df = spark.createDataFrame(data, "k string, s int, h string").repartition(3)
    want = []
    for k, s, _ in data:
        seen = [(t, h) for kk, t, h in data if kk == k and h is not None and (t >= s if backward else t <= s)]
        want.append((k, s, (min(seen) if backward else max(seen))[1] if seen else None))
    got = f.carry(df, ["k"], "s", "h", "out", backward, hot=hot)
    assert sorted((r.k, r.s, r.out) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("hot", [False, True])
def test_group_stats(spark, hot):
    df, data = skewed(spark)
    got = f.group_stats(df, ["k"], {"t": F.sum("v"), "n": F.count("*")}, hot)
    assert got.count() == len(data)
    assert got.filter("k = 'hot'").select("t", "n").distinct().collect() == [(sum(v for k, _, v in data if k == "hot"), 400)]


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.range(500).select((C("id") * 7919 % 500).alias("x"), F.lit("p").alias("y")).repartition(5)
    got = f.global_row_number(df, ["x"], "n").collect()
    assert sorted((r.x, r.n) for r in got) == [(i, i + 1) for i in range(500)]


def test_listing_has_totals(spark):
    df = spark.createDataFrame([("d1", "b1", "2", Decimal(5)), ("d1", "b1", "1", Decimal(7)), ("d1", "b2", "9", Decimal(1))],
                               "day string, branch string, account_no string, amt decimal(18,2)")
    got = f.listing(df, ["day", "branch"], "account_no", {"amt": "decimal(18,2)"})
    assert sorted((r.branch, r.row_type, r.account_no, r.row_no, r.amt) for r in got.collect()) == [
        ("b1", "DATA", "1", 1, Decimal(7)), ("b1", "DATA", "2", 2, Decimal(5)), ("b1", "TOTAL", "TOTAL", None, Decimal(12)),
        ("b2", "DATA", "9", 1, Decimal(1)), ("b2", "TOTAL", "TOTAL", None, Decimal(1))]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(-9, 9)), min_size=1, max_size=30))
def test_range_subtotals_match_brute_force(spark, leaves):
    df = spark.createDataFrame([("d", o, Decimal(a)) for o, a in leaves], "day string, order_id int, amount decimal(18,2)")
    spec = {100: f.between("order_id", 3, 9), 101: f.between("order_id", 1, 20, but=(5,), sign=-1)}
    got = {r.order_id: r.amount for r in f.range_subtotals(df, ["day"], "order_id", "amount", spec).collect()}
    assert got[100] == sum(a for o, a in leaves if 3 <= o <= 9)
    assert got[101] == -sum(a for o, a in leaves if o != 5)


def test_with_rows_keeps_quotes(spark):
    got = f.with_rows(spark.range(2), [(1, "Buka'e"), (2, None)], ("n", "t")).collect()
    assert sorted((r.id, r.n, r.t or "") for r in got) == [(0, 1, "Buka'e"), (0, 2, ""), (1, 1, "Buka'e"), (1, 2, "")]


def test_null_safe_join(spark):
    a = spark.createDataFrame([("x", None), ("y", "1")], "a string, b string")
    b = spark.createDataFrame([("x", None, 1), ("y", "2", 2)], "c string, d string, n int")
    assert f.null_safe_join(a, b, [(a.a, b.c), (a.b, b.d)], "inner").select("n").collect() == [(1,)]


def test_history_triplet(spark):
    schema = "loan string, load_date string, type_period string"
    old = spark.createDataFrame([("p", "2026-02-28", "CURR"), ("q", "2026-01-31", "CURR"), ("y", "2025-03-01", "CURR"),
                                 ("n", "2025-03-02", "CURR"), ("z", "2026-02-28", "PREV")], schema)
    now = spark.createDataFrame([("c", "2026-03-15", "CURR")], schema)
    got = f.history_triplet(now, old, "2026-03-15", "load_date")
    assert rows(got, "loan", "load_date", "type_period") == [
        ("c", "2026-03-15", "CURR"), ("p", "2026-03-15", "PREV"), ("y", "2026-03-15", "YOY")]
    assert f.history_triplet(now, None, "2026-03-15", "load_date").count() == 1


def test_year_triplet(spark):
    schema = "v string, report_year int, type_period string"
    old = spark.createDataFrame([("a", 2024, "CURR"), ("b", 2022, "CURR"), ("c", 2020, "CURR"), ("d", 2026, "CURR")], schema)
    now = spark.createDataFrame([("n", 2026, "CURR")], schema)
    assert rows(f.year_triplet(now, old, 2026), "v", "report_year", "type_period") == [
        ("a", 2026, "PREV"), ("b", 2026, "YOY"), ("n", 2026, "CURR")]

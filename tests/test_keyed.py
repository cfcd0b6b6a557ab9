import os

import pytest
from pyspark.sql import functions as F

from daybook.sources.keyed import KeyedTable
from daybook.sources.tables import upsert_report


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_an_upsert_reads_and_writes_touched_prefixes_only(spark, tmp_path):
    path = str(tmp_path / "t")
    stored = KeyedTable(spark, path, ["id"], prefixes=32)
    assert stored.read() is None
    stored.upsert(spark.range(1_000).selectExpr("id", "'old' as v"))
    before = files(path)
    changes = spark.createDataFrame([(5, "new"), (2_000, "added")], "id long, v string")
    prefixes = stored.touched(changes)
    read = {f.removeprefix("file://") for f in stored.merged(changes, prefixes).inputFiles()}
    assert read and all(any(f"_prefix={p}/" in f for p in prefixes) for f in read)
    assert stored.upsert(changes) == prefixes and len(prefixes) <= 2
    after = files(path)
    untouched = [f for f in before if not any(f"_prefix={p}/" in f for p in prefixes)]
    assert len(untouched) >= 28 and all(after.get(f) == before[f] for f in untouched)
    assert rows(stored.read()) == sorted([(k, "new" if k == 5 else "old") for k in range(1_000)] + [(2_000, "added")], key=repr)
    assert stored.upsert(changes) == prefixes and stored.read().count() == 1_001  # again


def test_deletes_nulls_and_new_columns(spark, tmp_path):
    stored = KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], prefixes=4)
    stored.upsert(spark.createDataFrame([(1, None, "x"), (None, None, "y"), (2, "k", "z")], "a int, b string, v string"))
    changes = spark.createDataFrame([(None, None, None, True, 1), (2, "k", "w", False, 2), (9, "none", None, True, 3)], "a int, b string, v string, del boolean, extra int")
    stored.upsert(changes, gone=F.col("del"))
    assert rows(stored.read().select("a", "b", "v", "extra")) == sorted([(1, None, "x", None), (2, "k", "w", 2)], key=repr)
    stored.upsert(spark.createDataFrame([(1, None), (2, "k")], "a int, b string"), gone=F.lit(True))
    assert stored.read().count() == 0
    assert stored.upsert(changes.limit(0)) == []
    again = KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], prefixes=99)
    assert again.prefixes == 4
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), ["a"])
    with pytest.raises(ValueError):
        stored.upsert(spark.createDataFrame([("1", "x")], "a string, b string"))
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "u"), ["a"], by=["b"])


def test_a_days_load_touches_one_prefix(spark, tmp_path):
    path = str(tmp_path / "r")
    for day, n in (("2026-01-01", 50), ("2026-01-02", 60), ("2026-01-02", 40)):
        load = spark.range(n).selectExpr(f"'{day}' as load_date", "id as account", f"{n} as total")
        out = upsert_report(spark, path, load, ["load_date", "account"], by=["load_date"], prefixes=1_000)
    # the second load of a day replaces the rows of its own keys only
    assert rows(out.groupBy("load_date", "total").count()) == [("2026-01-01", 50, 50), ("2026-01-02", 40, 40), ("2026-01-02", 60, 20)]
    assert len([d for d in os.listdir(path) if d.startswith("_prefix=")]) == 2

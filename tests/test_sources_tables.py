import pytest
from pyspark.sql import functions as F

from daybook.sources import raw
from daybook.sources.tables import (ParquetStore, align, children_of, living, merge_rows, merged, save_partitions, write_day,
                                    write_report)

C = F.col


def test_bulk_text_drops_status_lines(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("R1\t<row/>\nStarting copy...\nR2\t<row>a\tb</row>\n\n2 rows copied.\n")
    assert sorted(map(tuple, raw.read_bulk_text(spark, str(tmp_path)).collect())) == [("R1", "<row/>"), ("R2", "<row>a\tb</row>")]


def test_extract_counts_and_stays_readable_when_empty(spark, tmp_path):
    df = spark.range(25).select(C("id").cast("string").alias("RECID"), F.lit("<row/>").alias("XMLRECORD"))
    assert raw.write_extract(df.coalesce(1), str(tmp_path / "a"), rows_per_file=10) == 25
    assert len(list((tmp_path / "a").glob("*.parquet"))) == 3
    assert raw.write_extract(df.filter("1 = 0"), str(tmp_path / "b")) == 0
    assert raw.read_raw(spark, str(tmp_path / "b")).count() == 0
    with pytest.raises(ValueError):
        raw.newer_than(df, "RECID", None)


def test_incremental_filter_is_pushed_down(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    plan = raw.newer_than(spark.read.parquet(str(tmp_path / "t")), "id", "5")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id" in plan


def test_metadata_json(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"RECID": "A",\n "XMLRECORD": "<row/>"}]')
    assert raw.read_metadata(spark, str(tmp_path)).collect() == [("A", "<row/>")]


def test_utf16_table(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes("a~b\n@x ~ \n~\n y~2\n".encode("utf-16"))
    assert sorted(map(tuple, raw.read_utf16_table(spark, str(tmp_path), "a string, b string").collect()), key=str) == [("x", None), ("y", "2")]


def test_mixed_encodings(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("olá}1~x\n".encode("utf-8"))
    (tmp_path / "b.txt").write_bytes("olá}2~x\n".encode("cp1252"))
    (tmp_path / "c.txt").write_bytes("olá}3~x\n".encode("utf-16"))
    got = {r.source_file: (r.line, r.cells) for r in raw.read_mixed_encodings(spark, str(tmp_path)).collect()}
    assert got["a.txt"] == ("olá: 1~x", ["olá: 1", "x"])
    assert got["b.txt"][0] == "olá: 2~x" and got["c.txt"][0].endswith("olá: 3~x")


def test_headers_and_delimiters(spark):
    lines = spark.createDataFrame([("0;1;2;3",), ("0;4;5;6",)], "value string")
    assert raw.best_delimiter(lines) == ";"
    wide = raw.assign_headers(lines, ["a", "b"], 4, ";", drop_first=True)
    assert wide.columns == ["a", "b", "Extra_Col_3"] and sorted(map(tuple, wide.collect())) == [("1", "2", "3"), ("4", "5", "6")]
    assert raw.assign_headers(lines, ["a", "b", "c", "d"], 4, ";", drop_first=True).columns == ["a", "b", "c"]
    whole = raw.assign_headers(lines, ["a", "b"], 4, ";")
    assert whole.columns == ["a", "b", "Extra_Col_3", "Extra_Col_4"] and ("0", "1", "2", "3") in list(map(tuple, whole.collect()))
    late = spark.range(300).selectExpr("if(id < 299, 'a;b', 'x|y|z|w') as value")  # the last line decides
    assert raw.best_delimiter(late) == "|"


def test_export_is_ordered(spark, tmp_path):
    df = spark.range(500).selectExpr("id * 7919 % 500 as n", "'v' as v").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        raw.export_csv(df, str(tmp_path / "many"), ["n"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "many").glob("*.csv"))
    assert len(files) > 1 and [int(line.split(",")[0]) for f in files for line in f.read_text().split("\n")[1:] if line] == list(range(500))
    raw.export_csv(df, str(tmp_path / "one"), [C("n").desc()], one_file=True)
    (single,) = (tmp_path / "one").glob("*.csv")
    assert [int(line.split(",")[0]) for line in single.read_text().split("\n")[1:] if line] == list(range(499, -1, -1))


def test_only_newer_loads(spark):
    df = spark.createDataFrame([("2026-01-31", 1), ("2026-02-28", 2)], "load_date string, n int")
    assert raw.newer_than_own(df, "load_date", None) is df
    assert [r.n for r in raw.newer_than_own(df, "load_date", df.filter("n = 1")).collect()] == [2]
    assert raw.newer_than_own(df, "load_date", df.limit(0)).count() == 2


def test_channel_log(spark, tmp_path):
    (tmp_path / "atm_2024_03.csv").write_text('when,what\n05/03/2024,"two\nlines"\nbad,x\n')
    got = sorted((str(r.partition_date), r.partition_month, r.what) for r in raw.read_channel_log(spark, str(tmp_path), "when").collect())
    assert got == [("2024-03-01", "2024-03", "x"), ("2024-03-05", "2024-03", "two\nlines")]


def test_small_readers(spark, tmp_path):
    (tmp_path / "p.txt").write_text("1|2\n")
    assert raw.read_pipe_table(spark, str(tmp_path / "p.txt"), ["x", "y"]).collect() == [("1", "2")]
    assert raw.read_pipe_table(spark, str(tmp_path / "p.txt"), ["x"]).columns == ["_c0", "_c1"]
    one = spark.createDataFrame([("1.2345678901E10", "20240102", "1,5")], "n string, d string, a string")
    account, branch, product = raw.account_from_number("n")
    assert one.select(account, branch, product).first()[:] == ("12345678901", "12", "3456")
    cast = raw.cast_listed(one, dates=["d", "zz"], decimals=["a"]).first()
    assert str(cast.d) == "2024-01-02" and str(cast.a) == "15.0000"
    raw.export_csv(one, str(tmp_path / "out"), one_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1


def test_manifest_and_missing_files(spark):
    files = spark.createDataFrame([("a",), ("b",)], "file_name string")
    manifest = spark.createDataFrame([("R", "2024-01-01", "a"), ("R", "2024-01-01", "z"), ("Q", "2024-01-01", "b")],
                                     "report_name string, date_created string, file_name string")
    found, missing = raw.wanted_files(files, manifest, "R", "2024-01-01")
    assert found.collect() == [("a",)]
    with pytest.raises(FileNotFoundError, match="z"):
        raw.require_all(missing)


def changes(spark, rows):
    return spark.createDataFrame(rows, "recid string, v string, __op string, __lsn string")


def state_of(*frames, order=("__lsn",)):
    """Changes folded in one after the other."""
    state = None
    for df in frames:
        state = merged(state, df, ["recid"], order)
    return state


def values(df):
    return sorted((r.recid, r.v) for r in living(df).collect())


def test_state_follows_the_log_position(spark):
    first = changes(spark, [("a", "1", "c", "01"), ("b", "1", "c", "02")])
    second = changes(spark, [("a", None, "d", "05"), ("b", "2", "u", "06")])
    late = changes(spark, [("a", "late", "u", "03"), ("b", "late", "u", "04"), ("c", "1", "c", "07")])
    assert values(state_of(first, second, late)) == values(state_of(late, second, second, first)) == [("b", "2"), ("c", "1")]
    after = changes(spark, [("a", "still late", "u", "04"), ("c", "2", "u", "08")])  # the delete stays in the state
    assert values(state_of(first, second, late, after)) == [("b", "2"), ("c", "2")]
    assert merged(first, None, ["recid"], ["__lsn"]) is first


def test_children_follow_the_winning_event(spark):
    rows = spark.createDataFrame([("a", "x", "01"), ("a", "y", "02"), ("a", "y", "02"), ("b", "z", "01"), ("n", "w", None)], "recid string, c string, __lsn string")
    state = changes(spark, [("a", "2", "u", "02"), ("b", None, "d", "01"), ("n", "1", "c", None)])
    got = children_of(rows, state, ["recid"], ["__lsn"])
    assert sorted((r.recid, r.c) for r in got.collect()) == [("a", "y"), ("n", "w")]


def test_store_keeps_rows_over_copies(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    assert store.read("t") == (None, None)
    store.append("t", changes(spark, [("a", "1", "c", "01")]))
    store.append("t", changes(spark, [("b", "1", "c", "02")]).withColumn("extra", F.lit("x")))
    full, news = store.read("t")
    assert full is None and sorted((r.recid, r.extra) for r in news.collect()) == [("a", None), ("b", "x")]
    store.replace("t", merged(full, news, ["recid"], ["__lsn"]))
    store.append("t", changes(spark, [("a", "2", "u", "03")]))
    full, news = store.read("t")
    assert full.count() == 2 and values(merged(full, news, ["recid"], ["__lsn"])) == [("a", "2"), ("b", "1")]


def test_unfinished_copy_is_never_read(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    store.append("t", changes(spark, [("a", "1", "c", "01")]))
    changes(spark, [("half", "1", "c", "01")]).write.parquet(str(tmp_path / "t" / "rows" / "generation=1" / "full_copy=1"))  # its mark is missing
    full, news = store.read("t")
    assert full is None and [r.recid for r in news.collect()] == ["a"]
    store.replace("t", merged(full, news, ["recid"], ["__lsn"]))
    assert [r.recid for r in store.read("t")[0].collect()] == ["a"]


def test_report_is_stored_by_key(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))

    def load(rows):
        return spark.createDataFrame(rows, "day string, branch string, n int")

    write_report(store, "rep", load([("2026-05-31", "A", 1), ("2026-05-31", None, 2)]), ["day", "branch"])
    write_report(store, "rep", load([("2026-06-30", "A", 3)]), ["day", "branch"])  # the first load stays
    kept = write_report(store, "rep", load([("2026-05-31", None, 9)]), ["day", "branch"])
    assert sorted(((r.day, r.branch, r.n) for r in kept.collect()), key=repr) == sorted(
        [("2026-05-31", "A", 1), ("2026-05-31", None, 9), ("2026-06-30", "A", 3)], key=repr)
    assert "updated_at" in kept.columns


def test_partitioned_catalog_table_is_created_if_absent(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    spark.sql("drop table if exists part_report")
    for _ in range(2):
        save_partitions(rows, "part_report", ["p"])
    save_partitions(spark.createDataFrame([(5, "b")], "n int, p string"), "part_report", ["p"])
    assert sorted((r.n, r.p) for r in spark.table("part_report").collect()) == [(1, "a"), (5, "b")]
    spark.sql("drop table part_report")


def test_day_partition_is_replaced(spark, tmp_path):
    path = str(tmp_path / "pull")
    df = spark.range(5)
    assert write_day(df, path, "2026-01-01") == 5
    write_day(df, path, "2026-01-02")
    assert write_day(df.limit(2), path, "2026-01-02") == 2
    got = {str(r.business_date): r["count"] for r in spark.read.parquet(path).groupBy("business_date").count().collect()}
    assert got == {"2026-01-01": 5, "2026-01-02": 2}
    plan = spark.read.parquet(path).filter("business_date = date'2026-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(business_date" in plan


def test_align_and_merge(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert align(df, [("y", "bigint"), ("z", "date"), ("x", "string")]).dtypes == [("y", "bigint"), ("z", "date"), ("x", "string")]
    old = spark.createDataFrame([("k", "1", "keep", 5), ("m", "1", "z", 9)], "id string, a string, b string, n int")
    new = spark.createDataFrame([("k", "2", None, 4), ("new", "3", "q", 1)], "id string, a string, b string, n int")
    got = {r.id: tuple(r)[1:] for r in merge_rows(old, new, ["id"], ["b"]).collect()}
    assert got == {"k": ("2", "keep", 4), "m": ("1", "z", 9), "new": ("3", "q", 1)}
    guarded = {r.id: r.n for r in merge_rows(old, new, ["id"], only_if=C("n.n") > C("o.n")).collect()}
    assert guarded == {"k": 5, "m": 9, "new": 1}


def test_a_store_reads_its_current_generation_only(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path))
    for n in range(4):
        store.append("t", spark.range(2).selectExpr("id", f"{n} as v"))
        store.replace("t", spark.range(3).selectExpr("id", f"{n} as v"))
    full, news = store.read("t")
    assert news is None and all("generation=4/" in f for f in full.inputFiles()) and full.columns == ["id", "v"]
    store.append("t", spark.range(1).selectExpr("id", "9 as v", "1 as extra"))
    assert store.read("t")[1].collect() == [(0, 9, 1)]
    assert store.forget("t") == 3 and store.forget("t") == 0 and store.read("t")[0].count() == 3

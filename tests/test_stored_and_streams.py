"""Stored dimensions, totals in one scan, pruned loads, additive distinct counts and streaming state."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from daybook.checks import bank_views, registry
from daybook.operators import distinct, frames
from daybook.plans import MARTS
from daybook.sources import raw
from daybook.sources.dimensions import newest_rows, store_dimensions
from daybook.sources.keyed import KeyedTable
from daybook.streaming import cdc

FOLDER = "/root/testdata/sf0.001"
C = F.col


@pytest.fixture
def no_broadcast(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_statement_book_over_stored_dimensions_has_no_sort_aggregation(spark, no_broadcast):
    frames_ = bank_views.frames(spark, FOLDER)
    stored = store_dimensions(spark, {name: frames_[name] for name in registry.STORED}, "plan_test_")
    before = plan(MARTS["statement_book"](registry.bank(spark, FOLDER, pins=registry.PINS)))
    after = plan(MARTS["statement_book"](registry.bank(spark, FOLDER, pins=registry.PINS, stored=stored)))
    assert before.count("SortAggregate") >= 20 and "SortAggregate" not in after
    assert after.count("Bucketed: true") == 11 and before.count("Exchange hashpartitioning") - after.count("Exchange hashpartitioning") >= 11


def test_newest_rows_takes_whole_rows(spark):
    rows = [(" 1", "2", "a", 9), ("1", "3", "b", 1), ("1 ", "3", "b", 2), (None, "1", "x", 1), (" ", "1", "y", 1)]
    df = spark.createDataFrame(rows, "recid string, curr_no string, v string, n int")
    assert sorted(tuple(r) for r in newest_rows(df).select("_key", "v", "n").collect()) == [("", "y", 1), ("1", "b", 2)]
    assert newest_rows(df.drop("curr_no")).count() == 2


def test_a_listing_with_totals_reads_its_source_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 as g", "cast(id as decimal(18,2)) as v", "cast(null as string) as account_no").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    listed = frames.listing(df, ["g"], "id", {"v": "decimal(18,2)"})
    two = frames.with_totals(listed.filter("row_type = 'DATA'"), ["row_type"], {"v": "decimal(28,2)"}, {"account_no": "ALL"})
    assert plan(listed).count("FileScan") == 1 and plan(two).count("FileScan") == 1 and plan(listed).count("Exchange hashpartitioning") == 1
    got, hot = (sorted(map(tuple, frames.listing(df, ["g"], "id", {"v": "decimal(18,2)"}, hot=h).collect()), key=repr) for h in (False, True))
    assert got == hot and len(got) == 107
    nulls = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", None)], "g string, v double")
    assert sorted(map(tuple, frames.with_totals(nulls, ["g"], {"v": "double"}, {}).collect()), key=repr) == sorted(
        [(None, 1.0), (None, 2.0), (None, 3.0), ("a", None), ("a", None)], key=repr)
    assert frames.with_totals(nulls.limit(0), ["g"], {"v": "double"}, {}).count() == 0


def scanned_partitions(spark, df):
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        query = df.select("*")._jdf.queryExecution()
        query.executedPlan().executeCollect()
        leaf = query.executedPlan().collectLeaves().apply(0)
        return leaf.metrics().apply("numPartitions").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)


def test_newer_loads_read_newer_partitions_only(spark, tmp_path):
    days = spark.range(40).selectExpr("id", "date_add(date'2026-01-01', cast(id as int)) as day")
    days.write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    history = days.filter("id < 35")
    newer = raw.newer_than_own(table, "day", history)
    assert newer.count() == 5 and scanned_partitions(spark, newer) == 5
    assert raw.newer_than_own(table, "day", history.limit(0)).count() == 40 and raw.newer_than_own(table, "day", None).count() == 40
    gaps = days.unionByName(days.limit(2).withColumn("day", F.lit(None).cast("date")))
    assert raw.newer_than_own(gaps, "day", history.limit(0)).count() == 42 and raw.newer_than_own(gaps, "day", history).count() == 5
    for kind, value in (("int", 3), ("string", "b"), ("double", 1.5), ("timestamp", datetime.datetime(2026, 1, 2))):
        one = spark.createDataFrame([(value,)], f"c {kind}")
        assert raw.newer_than_own(one, "c", one.limit(0)).count() == 1 and raw.newer_than_own(one, "c", one).count() == 0


def test_distinct_counts_add_up(spark):
    rng = random.Random(8)
    rows = [(m, rng.choice(["a", None]), rng.randrange(90_000) if rng.random() < 0.99 else None) for m in range(6) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "month int, branch string, value int")
    numbered = df.join(distinct.dense_numbers(df, "value", "number"), "value", "left")
    assert numbered.agg(F.max("number")).first()[0] == len({v for *_, v in rows if v is not None})
    months = distinct.bitmaps(numbered, ["month", "branch"], "number")
    halves = distinct.rolled_up(months.withColumn("half", F.expr("month div 3")), ["half", "branch"])
    whole = distinct.rolled_up(halves, ["branch"])
    for bits, keys, of in ((months, ["month", "branch"], lambda m, b: (m, b)), (halves, ["half", "branch"], lambda m, b: (m // 3, b)), (whole, ["branch"], lambda m, b: (b,))):
        want = {}
        for m, b, v in rows:
            if v is not None:
                want.setdefault(of(m, b), set()).add(v)
        assert {tuple(r)[:-1]: r.n for r in distinct.counted(bits, keys, "n").collect()} == {k: len(v) for k, v in want.items()}


def test_a_stream_keeps_the_newest_event_through_restarts(spark, tmp_path):
    """Late events, a restart from the checkpoint, and one without it, against the newest of all events."""
    rng = random.Random(1)
    events = [(str(rng.randrange(20)), f"x{n}", "d" if n % 9 == 0 else "u", f"{rng.randrange(100):05d}" if n % 7 else None, n, n) for n in range(300)]
    schema = '"RECID" string'.replace('"', "") + ", XMLRECORD string, __op string, __lsn string, __ts_ms long, __offset long"
    frame = spark.createDataFrame(events, schema)
    path = str(tmp_path / "in")
    table = KeyedTable(spark, str(tmp_path / "table"), ["RECID"], prefixes=4)
    marks = KeyedTable(spark, str(tmp_path / "marks"), ["topic"], prefixes=2)

    def run(checkpoint):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        cdc.stream_newest(stream, table, str(tmp_path / checkpoint), every=None).awaitTermination()
        cdc.stream_progress(stream, C("__op"), marks, str(tmp_path / f"{checkpoint}-marks"), every=None).awaitTermination()

    def check(upto):
        want = sorted(map(tuple, cdc.latest_events(upto).collect()))
        assert sorted(map(tuple, table.read().select(*frame.columns).collect())) == want
        assert sorted(map(tuple, cdc.stored_progress(marks).collect())) == sorted(map(tuple, cdc.progress_rows(upto, C("__op")).collect()))

    late, early = frame.filter("__offset % 3 > 0"), frame.filter("__offset % 3 = 0")
    late.coalesce(2).write.parquet(path)
    run("one")
    check(late)
    early.coalesce(1).write.mode("append").parquet(path)
    run("one")
    check(frame)
    path = str(tmp_path / "again")
    early.coalesce(1).write.parquet(path)
    run("two")  # knows nothing of the later events
    check(frame)

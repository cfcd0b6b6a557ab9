"""Keys that one task should not take: cut into slices without a second copy of the rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.checks import registry
from daybook.operators import frames as f
from daybook.plans import MARTS
from daybook.sources import textreports

FOLDER = "/root/testdata/sf0.001"
C = F.col


@pytest.fixture(autouse=True)
def sixteen_slices(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def written(monkeypatch):
    """Rows of the frames that helpers write out."""
    counts, plain = [], f.materialise

    def counted(df, path=None):
        out = plain(df, path)
        counts.append(out.count())
        return out

    monkeypatch.setattr(f, "materialise", counted)
    return counts


def skewed(spark):
    """Two long keys, one of them null, and many short ones; some orders repeat a date, some values are null."""
    data = [(None, i // 40, f"e{i:04d}", None if i % 9 == 0 else i % 23 - 11) for i in range(900)] \
        + [("hot", i // 300, f"e{i:04d}", i % 17) for i in range(1200)] + [(f"k{i % 60}", i % 7, f"e{i:04d}", 1) for i in range(300)]
    return spark.createDataFrame(data, "k string, d int, e string, v int"), data


def expected(data):
    want, totals = [], {}
    for k, d, e, v in sorted(data, key=lambda r: (r[0] or "", r[1], r[2])):
        if v is not None:
            totals[k] = totals.get(k, 0) + v
        want.append((k, d, e, totals.get(k)))
    return sorted(want, key=repr), totals


def test_only_long_keys_are_cut(spark):
    df, _ = skewed(spark)
    cuts = f.slices(df, ["k"], ["d", "e"])
    assert {b[0] for b in cuts.bounds} == {None, "hot"}
    rows = cuts.number(df).groupBy("k").agg(F.count_distinct(f.SLICE).alias("n")).collect()
    assert {r.k for r in rows if r.n > 1} == {None, "hot"}
    assert not f.slices(df.filter("k like 'k%'"), ["k"], ["d", "e"])


def test_hot_keys_are_summed_without_a_copy_of_the_rows(spark, written):
    df, data = skewed(spark)
    want, totals = expected(data)
    cuts = f.slices(df, ["k"], ["d", "e"])
    got = f.running_sum(df, ["k"], ["d", "e"], "v", "run", cuts)
    got = f.group_stats(got, ["k"], {"t": F.sum("v"), "n": F.count("v")}, cuts).collect()
    assert sorted(((r.k, r.d, r.e, r.run) for r in got), key=repr) == want
    assert {(r.k, r.t) for r in got} == set(totals.items())
    plain = f.running_sum(df, ["k"], ["d", "e"], "v", "run", True)
    assert plain.columns == [*df.columns, "run"] and sorted(((r.k, r.d, r.e, r.run) for r in plain.collect()), key=repr) == want
    assert max(written) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("backward", [False, True])
def test_hot_keys_carry_without_a_copy_of_the_rows(spark, written, backward):
    data = [(f, 7, s, "x%d" % s if s % 97 == 3 else None) for f in ("a", None) for s in range(600)] + [("b", 7, s, None) for s in range(9)]
    df = spark.createDataFrame(data, "f string, g int, s int, h string")
    want = {}
    for key in ("a", None, "b"):
        last = None
        for s in sorted((r[2] for r in data if r[0] == key), reverse=backward):
            last = f"x{s}" if key != "b" and s % 97 == 3 else last
            want[key, s] = last
    got = f.carry(df, ["f", "g"], "s", "h", "out", backward, hot=True).collect()
    assert {(r.f, r.s): r.out for r in got} == want and len(got) == len(data)
    assert max(written) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_rows_that_may_change_are_written_before_they_are_cut(spark, written):
    df = spark.range(400).select(F.lit("a").alias("k"), F.monotonically_increasing_id().alias("o"), C("id").alias("v"))
    got = f.running_sum(df, ["k"], ["o"], "v", "run", True).collect()
    assert written[0] == 400 and sorted((r.v, r.run) for r in got) == [(i, i * (i + 1) // 2) for i in range(400)]


def test_rows_that_are_shuffled_to_be_made_are_written_once(spark, written):
    df, data = skewed(spark)
    want, _ = expected(data)
    got = f.running_sum(df.repartition(5, "e"), ["k"], ["d", "e"], "v", "run", True)
    assert written[0] == len(data) and "RepartitionByExpression [e#" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(((r.k, r.d, r.e, r.run) for r in got.collect()), key=repr) == want


@pytest.mark.parametrize("name", ["statement_book", "account_statement"])
def test_short_keys_need_nothing_more_than_on_the_plain_path(spark, written, name):
    def exchanges(hot):
        plan = MARTS[name](registry.bank(spark, FOLDER, pins=registry.PINS, hot=hot))._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange")

    assert exchanges(True) == exchanges(False) and not written


@pytest.mark.parametrize("hot", [True, False])
def test_lines_of_one_long_file(spark, hot, written):
    lines = spark.range(3000).select(
        F.lit("f").alias("file"), F.lit("f.txt").alias("source_file"), (C("id") + 1).cast("int").alias("line_seq"),
        F.expr("""case when id = 0 then 'RE000010 02 CITY EXBANK   GENERAL LEDGER' when id % 100 = 50 then concat('   AC.1-TR.', id)
                  when id % 100 = 20 then ' 2730 Loans   1.00 2.00 3.00 4.00' else '   (a remark)' end""").alias("line"))
    got = textreports.parse_ledger(lines, "EXBANK", hot=hot).collect()
    codes = sorted((r.line_seq, r.description) for r in got)
    assert codes == [(i * 100 + 21, "Loans" if i == 0 else f"AC.1-TR.{i * 100 - 50} Loans") for i in range(30)]
    assert not hot or max(written) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_what_is_written_leaves_no_shuffle_behind(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = folders.getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    before = shuffled()
    done = f.materialise(spark.range(5000).repartition(7).groupBy((C("id") % 100).alias("g")).count())
    assert shuffled() <= before and done.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"

import json

import pytest
from pyspark.sql import functions as F

from daybook.plans import MARTS, readiness as r
from daybook.sources.records import Field, Spec
from daybook.streaming import cdc

C = F.col
SPEC = Spec("T", (Field("V", 1), Field("M", 2, multi=True)))
ROUTES = cdc.parse_routes(["T=topic_t:table_t  # comment", "", "# nothing"])


def message(op, key, lsn, value=None, wrapped=True, sub=None, topic="topic_t"):
    xml = f"<row><c1>{value}</c1>" + (f'<c2 m="2" s="2">{sub}</c2>' if sub else "") + "</row>"
    body = {"op": op, "ts_ms": int(lsn), "source": {"change_lsn": lsn, "commit_lsn": "zz"}, "before": {"RECID": key},
            "after": None if op == "d" else {"RECID": key, "XMLRECORD": xml}}
    return topic, json.dumps({"payload": body} if wrapped else body).encode(), int(lsn)


def frame(spark, rows):
    return spark.createDataFrame(rows, "topic string, value binary, offset bigint")


def test_routes():
    assert ROUTES == [cdc.Route("T", "topic_t", "table_t", "T")]
    assert cdc.parse_routes(["ACC.HIS=t:b:ss=ACCOUNT"])[0].metadata_key == "ACCOUNT"
    with pytest.raises(ValueError):
        cdc.parse_routes(["nonsense"])


def test_unwrap_and_latest(spark):
    rows = [message("c", "a", "01", "x"), message("u", "a", "02", "y", wrapped=False), message("d", "b", "03"), ("topic_t", None, 9)]
    events = cdc.unwrap(frame(spark, rows))
    assert sorted((e.RECID, e["__op"], e["__lsn"], e["__ts_ms"]) for e in events.collect()) == [("a", "c", "01", 1), ("a", "u", "02", 2), ("b", "d", "03", 3)]
    last = {e.RECID: e["__op"] for e in cdc.latest_events(events).collect()}
    assert last == {"a": "u", "b": "d"}
    fallback = cdc.unwrap(frame(spark, [("t", json.dumps({"op": "c", "source": {"commit_lsn": "7"}, "after": {"RECID": "q"}}).encode(), 1)]))
    assert fallback.first()["__lsn"] == "7"
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1  # a message is read once


def state(bronze):
    return sorted((x.recid, x.v) for x in bronze.read("table_t").collect())


def test_batches_out_of_order_and_replayed(spark, tmp_path):
    bronze = cdc.Bronze(spark, str(tmp_path))
    batches = [[message("c", "a", "01", "a1", sub="s1"), message("c", "b", "02", "b1", sub="t1")],
               [message("u", "a", "05", "a5"), message("d", "b", "06"), message("u", "c", "07", "bad<"), message("c", "x", "08", "x", topic="unknown")],
               [message("u", "a", "03", "a3", sub="old"), message("u", "b", "04", "b4", sub="old")]]
    for rows in batches:
        for _ in range(2):
            bronze.apply_batch(frame(spark, rows), ROUTES, {"T": SPEC})
    assert state(bronze) == [("a", "a5")]  # the late events neither win nor revive the deleted key
    assert bronze.children("table_t").count() == 0  # a5 has no sub-values, b is gone
    assert [x.recid for x in bronze.errors("table_t").collect()] == ["c"]
    assert {x.table_name: x.max_lsn for x in bronze.progress().collect()} == {"table_t": "07", "__global__": "07"}
    bronze.compact(["table_t"])
    assert state(bronze) == [("a", "a5")] and bronze.children("table_t").count() == 0


def stream(spark, path, rows):
    frame(spark, rows).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("topic string, value binary, offset bigint").option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("compacted", [True, False])
def test_new_checkpoint_loses_nothing(spark, tmp_path, compacted):
    """A stream that starts over counts its batches from 0 again."""
    bronze = cdc.Bronze(spark, str(tmp_path / "bronze"))
    for i in range(3):
        bronze.run(stream(spark, str(tmp_path / "a"), [message("c", f"k{i}", f"0{i}", f"v{i}", sub=f"s{i}")]), ROUTES, {"T": SPEC},
                   str(tmp_path / "check_a"), every=None).awaitTermination()
    if compacted:
        bronze.compact(["table_t"])
    bronze.run(stream(spark, str(tmp_path / "b"), [message("c", "new", "09", "n", sub="t"), message("u", "k1", "08", "v8")]), ROUTES, {"T": SPEC},
               str(tmp_path / "check_b"), every=None, compact_every=1).awaitTermination()
    assert state(bronze) == [("k0", "v0"), ("k1", "v8"), ("k2", "v2"), ("new", "n")]
    assert sorted(x.value for x in bronze.children("table_t").collect()) == ["s0", "s2", "t"]
    assert {x.table_name: x.max_lsn for x in bronze.progress().collect()} == {"table_t": "09", "__global__": "09"}


def test_stream_equals_batch(spark, tmp_path):
    rows = [message("u" if i % 5 else "d", f"k{i % 7}", f"{i:04d}", f"v{i}") for i in range(60)]
    want = {}
    for i in range(60):
        want[f"k{i % 7}"] = f"v{i}" if i % 5 else None
    frame(spark, rows).repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("topic string, value binary, offset bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    bronze = cdc.Bronze(spark, str(tmp_path / "bronze"), keep_lsn=["table_t"])
    for _ in range(2):  # the second run finds nothing new
        bronze.run(stream, ROUTES, {"T": SPEC}, str(tmp_path / "checkpoint"), every=None).awaitTermination()
    assert state(bronze) == sorted((k, v) for k, v in want.items() if v)
    assert "__lsn" in bronze.read("table_t").columns


def test_source_map_covers_known_marts(spark):
    rows = r.source_rows(spark)
    assert set(r.SOURCES) <= set(MARTS)
    assert r.misclassified(rows).count() == 0
    clash = rows.unionByName(spark.createDataFrame([("m", "d", "company", "dim", None)], rows.schema))
    assert r.misclassified(clash).collect() == [("company",)]
    assert "stmt_entry" in [x[0] for x in r.tables_of(rows, ["event"]).collect()]


def test_marker(spark):
    batch = spark.createDataFrame([("BNK/COB.INITIALISE", ["0"], ["2026-06-25"], "0009"), ("OTHER", ["0"], ["2026-01-01"], "1")],
                                  "recid string, process_status array<string>, last_run_date array<string>, __lsn string")
    assert r.cob_marker(batch).collect() == [("2026-06-25", "0009")]
    running = batch.withColumn("process_status", F.array(F.lit("1")))
    assert r.cob_marker(running).count() == 0
    assert r.forced_marker(spark, "2026-06-25").collect() == [("2026-06-25", "0")]


def test_caught_up(spark):
    tables = spark.createDataFrame([("busy", "t1"), ("quiet", "t2"), ("behind", "t3"), ("empty", "t4")], "source_table string, topic string")
    progress = spark.createDataFrame([("busy", "0009"), ("behind", "0003"), ("quiet", "0002"), ("__global__", "0009")], "table_name string, max_lsn string")
    ends = spark.createDataFrame([("t2", 0, 10), ("t3", 0, 10)], "topic string, partition int, end_offset long")
    read = spark.createDataFrame([("t2", 0, 10), ("t3", 0, 4)], "topic string, partition int, committed_offset long")
    lags = r.lag(ends, read, tables.select("topic"))
    got = {x.source_table: x.caught_up for x in r.caught_up(tables, progress, lags, "0005").collect()}
    assert got == {"busy": True, "quiet": True, "behind": False, "empty": True}
    early = progress.filter("table_name <> '__global__'")
    assert not {x.source_table: x.caught_up for x in r.caught_up(tables, early, lags, "0005").collect()}["quiet"]


def test_ledger_flow(spark):
    day = "2026-06-25"
    source = lambda *names: spark.createDataFrame([(n,) for n in names], "source_table string").withColumn("business_date", F.lit(day).cast("date"))
    control = spark.createDataFrame([], r.CONTROL)
    control = r.open_pending(control, source("account", "customer").withColumns({"flow": F.lit("cdc"), "l_cob": F.lit("7")}))
    assert r.is_sealed(control, [], day) and not r.is_sealed(control, ["account"], day)
    control = r.seal(control, source("account").withColumns({"flow": F.lit("cdc"), "snapshot_id": F.lit(4).cast("bigint")}))
    control = r.mark_failed(control, source("customer", "stranger"))
    assert {x.source_table: x.status for x in control.collect()} == {"account": "sealed", "customer": "failed"}
    control = r.seal(control, source("customer").withColumns({"flow": F.lit("cdc"), "snapshot_id": F.lit(5).cast("bigint")}))
    control = r.seal(control, source("account").withColumn("flow", F.lit("cdc")))
    assert r.read_pins(control, day) == {"account": 4, "customer": 5}
    assert r.is_sealed(control, ["account", "customer", "account"], day) and not r.is_sealed(control, ["account"], "2026-06-26")
    assert control.filter("source_table = 'account'").first().l_cob == "7"


def test_run_and_ingest_logs(spark):
    keys = spark.createDataFrame([("aml", "acct_cust", "silver", "2026-06-25")], "domain string, mart string, layer string, d string") \
        .select("domain", "mart", "layer", C("d").cast("date").alias("business_date"))
    runs = r.start_run(spark.createDataFrame([], r.RUNS), keys)
    assert not r.all_built(runs, "aml", ["acct_cust"], "2026-06-25")
    runs = r.finish_run(runs, keys.withColumns({"status": F.lit("success"), "models_built": F.lit(1)}))
    assert r.all_built(runs, "aml", ["acct_cust"], "2026-06-25") and not r.is_built(runs, "aml", "2026-06-25")
    assert r.all_built(runs, "aml", [], "2026-06-25")
    log_keys = spark.createDataFrame([("company", "pull")], "source_name string, flow string").withColumn("business_date", F.lit("2026-06-25").cast("date"))
    log = r.mark_synced(spark.createDataFrame([], r.INGEST), log_keys)
    assert (log.first().is_sync, log.first().is_parsed) == (True, None)
    log = r.mark_parsed(log, log_keys)
    assert (log.first().is_sync, log.first().is_parsed) == (True, True) and log.first().synced_at is not None


def test_reconcile_counts(spark):
    rows = spark.createDataFrame([("a", "2026-01-01"), ("a", "2026-01-01"), ("a", "2026-01-02")], "source_table string, d string") \
        .select("source_table", C("d").cast("date").alias("business_date"))
    expected = spark.createDataFrame([("a", 2), ("b", 1)], "source_table string, expected_count long")
    got = {x.source_table: (x.actual_count, x.matches) for x in r.reconcile_counts(rows, expected, "2026-01-01").collect()}
    assert got == {"a": (2, True), "b": (0, False)}

"""Ledgers, logs and delivered files: closing marks, runs, ingests, pins, listings, channel logs, dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.checks import operator_views, text_views
from daybook.checks.file_views import new_folder, table
from daybook.plans import readiness
from daybook.sources import raw, textreports
from daybook.sources.tables import overwrite_partitions
from daybook.streaming import cdc

C = F.col


def report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger listings written as text files, read line by line and parsed."""
    path = new_folder(spark)
    lines = text_views.ledger_lines(spark, sf_dir)
    lines.repartition("source_file").sortWithinPartitions("source_file", "line_seq").select("source_file", C("line").alias("value")).write.partitionBy("source_file").text(path)
    read = textreports.read_lines(spark, path).withColumn("source_file", F.regexp_extract("file", "source_file=([^/]+)", 1))
    return textreports.parse_ledger(read, text_views.BANK)


def closing_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as closing records: views belong to the record that is watched, and have finished where their value is below 50."""
    batch = table(spark, sf_dir, "events").select(
        F.when(C("event_type") == "view", readiness.COB_RECORD).otherwise("BNK/OTHER").alias("recid"), F.array(F.when(C("value") < 50, "0").otherwise("1")).alias("process_status"),
        F.array(C("ts").cast("string")).alias("last_run_date"), F.lpad(C("event_id").cast("string"), 20, "0").alias("__lsn"))
    return readiness.cob_marker(batch)


CLOSING_MARKS = """select strftime(ts, '%Y-%m-%d') as business_date, lpad(cast(event_id as varchar), 20, '0') as l_cob from events where event_type = 'view' and value < 50"""


def forced_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of a replayed day: with the forced mark, all that have any position have caught up."""
    events = table(spark, sf_dir, "events")
    progress = cdc.progress_rows(events.filter(C("event_type") != "view").select("event_type", F.lpad(C("event_id").cast("string"), 20, "0").alias("__lsn")), C("event_type"))
    topics = events.select(C("event_type").alias("topic")).distinct()
    lags = topics.withColumn("lag", F.lit(5).cast("bigint"))
    mark = readiness.forced_marker(spark, "1998-06-01 10:00:00").first()
    return readiness.caught_up(topics.select(C("topic").alias("source_table"), "topic"), progress, lags, mark["l_cob"]).withColumn("business_date", F.lit(mark["business_date"]))


FORCED_REPLAY = """select event_type as source_table, if(event_type = 'view', null, lpad(cast(max(event_id) as varchar), 20, '0')) as max_lsn, 5::bigint as lag,
  event_type <> 'view' as caught_up, '1998-06-01' as business_date from events group by event_type"""


def pinned_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pins of a day as a mart's context takes them."""
    pins = readiness.read_pins(operator_views._control(spark, sf_dir), "1998-06-01")
    return spark.createDataFrame(sorted(pins.items()), "source_table string, version bigint")


PINNED_TABLES = "select c_name as source_table, c_custkey as version from customer where c_nationkey not in (5, 6)"


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as marts of their segment: all started, some finished, some started again."""
    marts = table(spark, sf_dir, "customer").select(C("c_mktsegment").alias("domain"), C("c_name").alias("mart"), F.lit("silver").alias("layer"),
                                                    F.lit("1998-06-01").cast("date").alias("business_date"), "c_nationkey")
    key = ["domain", "mart", "layer", "business_date"]
    runs = readiness.start_run(spark.createDataFrame([], readiness.RUNS), marts.select(*key))
    done = marts.filter("c_nationkey < 20").select(*key, F.when(C("c_nationkey") < 15, "success").otherwise("failed").alias("status"),
                                                   F.when(C("c_nationkey") < 10, C("c_nationkey").cast("int")).alias("models_built"))
    runs = readiness.start_run(readiness.finish_run(runs, done), marts.filter("c_nationkey = 17").select(*key))
    return runs.select(*key, "status", "models_built", C("started_at").isNotNull().alias("started"), C("completed_at").isNotNull().alias("completed"))


RUN_LOG = """select c_mktsegment as domain, c_name as mart, 'silver' as layer, date '1998-06-01' as business_date,
  case when c_nationkey >= 20 or c_nationkey = 17 then 'running' when c_nationkey < 15 then 'success' else 'failed' end as status,
  if(c_nationkey < 10, c_nationkey, null)::integer as models_built, true as started, c_nationkey < 20 and c_nationkey <> 17 as completed from customer"""


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as deliveries: those not pending were synced, filled ones parsed, some parsed without a note of the sync."""
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("S"), "o_orderkey").alias("source_name"), F.lit("pull").alias("flow"),
                                                   C("o_orderdate").cast("date").alias("business_date"), C("o_orderstatus").alias("s"))
    synced = readiness.mark_synced(spark.createDataFrame([], readiness.INGEST), orders.filter("s = 'O'").drop("s"))
    log = readiness.mark_parsed(synced, orders.filter("s = 'F' or s = 'O' and day(business_date) < 10").drop("s"))
    return log.select("source_name", "flow", "business_date", "is_sync", F.coalesce("is_parsed", F.lit(False)).alias("is_parsed"),
                      C("synced_at").isNotNull().alias("synced"), C("parsed_at").isNotNull().alias("parsed"))


INGEST_LOG = """select 'S' || o_orderkey as source_name, 'pull' as flow, o_orderdate::date as business_date, true as is_sync, p as is_parsed, o_orderstatus = 'O' as synced, p as parsed
from (select *, o_orderstatus = 'F' or (o_orderstatus = 'O' and day(o_orderdate) < 10) as p from orders) where o_orderstatus in ('O', 'F')"""


def counts_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items per order of one month against the announced number, which is wrong for some; one source never came."""
    rows = table(spark, sf_dir, "lineitem").select(C("l_suppkey").cast("string").alias("source_table"), F.trunc("l_shipdate", "month").alias("business_date"))
    expected = rows.filter("business_date = '1998-06-01'").groupBy("source_table").agg(F.count(F.lit(1)).alias("n")).select(
        "source_table", (C("n") + (C("source_table").cast("int") % 5 == 0).cast("int")).alias("expected_count"))
    none = table(spark, sf_dir, "supplier").select(F.concat(F.lit("new "), "s_suppkey").alias("source_table"), F.lit(1).cast("bigint").alias("expected_count"))
    return readiness.reconcile_counts(rows, expected.unionByName(none), "1998-06-01")


COUNTS_RECONCILED = """with c as (select l_suppkey, count(*) as n from lineitem where date_trunc('month', l_shipdate) = date '1998-06-01' group by 1)
select cast(l_suppkey as varchar) as source_table, n + (l_suppkey % 5 = 0)::int as expected_count, n as actual_count, l_suppkey % 5 <> 0 as matches from c
union all select 'new ' || s_suppkey, 1, 0, false from supplier"""


def delivered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers delivered as a text file per nation; the files are listed without being read and compared with the announced sizes."""
    path = new_folder(spark)
    customers = table(spark, sf_dir, "customer").select(C("c_nationkey").alias("nation"), C("c_name").alias("value"))
    customers.filter("nation <> 3").repartition("nation").write.partitionBy("nation").text(path)
    announced = customers.groupBy("nation").agg(F.sum(F.octet_length("value") + F.when(C("nation") == 5, 2).otherwise(1)).alias("announced"))
    files = raw.listed_files(spark, path, "*/*.txt").select(F.regexp_extract("path", "nation=(\\d+)", 1).cast("bigint").alias("nation"), "bytes")
    sizes = files.groupBy("nation").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return announced.join(sizes, "nation", "left").select(
        "nation", F.coalesce("files", F.lit(0)).alias("files"), "bytes", C("bytes").eqNullSafe(C("announced")).alias("complete"))


DELIVERED_FILES = """select c_nationkey as nation, if(c_nationkey = 3, 0, 1)::bigint as files, if(c_nationkey = 3, null, sum(strlen(c_name) + 1))::bigint as bytes,
  c_nationkey not in (3, 5) as complete from customer group by c_nationkey"""


def channel_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as monthly logs of a channel: quoted cells over two lines, unreadable days, account numbers as floating point text."""
    path = new_folder(spark)
    logs = table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy_MM").alias("month"), C("o_orderkey").alias("reference"),
        F.when(C("o_orderstatus") == "P", "unknown").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("when"),
        F.concat(C("o_custkey") + 10_000_000_000, F.lit(".0")).alias("account"), F.concat(C("o_orderpriority"), F.lit(',\n"x"')).alias("remark"))
    logs.repartition("month").write.partitionBy("month").csv(path, header=True, quote='"', escape='"')
    read = raw.read_channel_log(spark, f"{path}/*", "when")
    account, branch, product = raw.account_from_number("account")
    return read.select(C("reference").cast("bigint").alias("reference"), "remark", "partition_month", "partition_date", account.alias("account"), branch.alias("branch"), product.alias("product"))


CHANNEL_LOG = """select o_orderkey as reference, o_orderpriority || ',' || chr(10) || '"x"' as remark, strftime(o_orderdate, '%Y-%m') as partition_month,
  if(o_orderstatus = 'P', date_trunc('month', o_orderdate), o_orderdate)::date as partition_date, cast(o_custkey + 10000000000 as varchar) as account,
  substring(cast(o_custkey + 10000000000 as varchar), 1, 2) as branch, substring(cast(o_custkey + 10000000000 as varchar), 3, 4) as product from orders"""


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a delimited extract with days and grouped amounts as text, typed and stamped with where they came from."""
    path = new_folder(spark)
    table(spark, sf_dir, "orders").select("o_orderkey", F.when(C("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"),
                                          F.when(C("o_orderstatus") == "F", "-").otherwise(F.format_number("o_totalprice", 2)).alias("amount")).write.csv(path, header=True)
    read = raw.with_provenance(spark.read.csv(path, header=True), "1998-06-01")
    typed = raw.cast_listed(read, dates=["day", "not there"], decimals=["amount"])
    return typed.select(C("o_orderkey").cast("bigint").alias("o_orderkey"), "day", "amount", C("_source_file").endswith(".csv").alias("from_csv"), "_ingestion_date")


PROVENANCE = """select o_orderkey, if(o_orderstatus = 'P', null, o_orderdate::date) as day, if(o_orderstatus = 'F', null, round(o_totalprice, 2))::decimal(20,4) as amount,
  true as from_csv, date '1998-06-01' as _ingestion_date from orders"""


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages of which some carry a broken record: their keys and positions are set aside, the others are stored."""
    bronze = cdc.Bronze(spark, new_folder(spark))
    for turn in (0, 1, 1):
        bronze.apply_batch(_broken(spark, sf_dir).filter(C("offset") % 2 == turn), operator_views.ROUTES, {"EVENT": operator_views.EVENT_SPEC})
    out = None
    for name in ("table_a", "table_b"):
        rows = bronze.errors(name)
        if rows is not None:
            rows = rows.select(F.lit(name).alias("table_name"), "recid", "__lsn", "__offset")
            out = rows if out is None else out.unionByName(rows)
    return out


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without deletes; the record of a sign-up is cut off."""
    rows = table(spark, sf_dir, "events").filter("event_type <> 'error'").selectExpr("event_id as offset", "if(event_type = 'view', 'topic_a', 'topic_b') as topic", """
        named_struct('op', 'u', 'ts_ms', event_id, 'source', named_struct('change_lsn', lpad(cast(event_id as string), 20, '0')), 'after', named_struct('RECID', cast(event_id as string),
          'XMLRECORD', concat('<row><c1>', event_type, if(event_type = 'signup', '', '</c1></row>')))) as m""")
    return rows.select("topic", F.to_json("m").cast("binary").alias("value"), "offset")


DEAD_LETTERS = """select 'table_b' as table_name, cast(event_id as varchar) as recid, lpad(cast(event_id as varchar), 20, '0') as __lsn, event_id as __offset
from events where event_type = 'signup'"""


def kept_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of which one keeps the log position of its rows."""
    bronze = cdc.Bronze(spark, new_folder(spark), keep_lsn=["table_a"])
    bronze.apply_batch(operator_views.messages(spark, sf_dir), operator_views.ROUTES, {"EVENT": operator_views.EVENT_SPEC})
    kept, plain = bronze.read("table_a"), bronze.read("table_b")
    return kept.select(F.lit("table_a").alias("table_name"), "recid", "__lsn").unionByName(
        plain.select(F.lit("table_b").alias("table_name"), "recid", (C("__lsn") if "__lsn" in plain.columns else F.lit(None).cast("string")).alias("__lsn")))


KEPT_POSITIONS = f"""with l as (select * from ({operator_views._EVENT}) qualify row_number() over (partition by topic, recid order by lsn desc) = 1)
select if(topic = 'topic_a', 'table_a', 'table_b') as table_name, recid, if(topic = 'topic_a', lsn, null) as __lsn from l where op <> 'd'"""


def partitioned_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per year and customer as a report by year: the whole of it, then 1998 once more and in part; other years stay as they are."""
    path = new_folder(spark)
    sales = table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "year").alias("load_year"), C("o_custkey").alias("customer")).agg(
        F.sum(C("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
    overwrite_partitions(sales, path, ["load_year"])
    overwrite_partitions(sales.filter("load_year = '1998-01-01' and total > 100000"), path, ["load_year"])
    return spark.read.parquet(path).select("load_year", "customer", "total")


PARTITIONED_REPORT = """with s as (select date_trunc('year', o_orderdate)::date as load_year, o_custkey as customer, sum(o_totalprice::decimal(18,2))::decimal(28,2) as total from orders group by 1, 2)
select * from s where load_year <> date '1998-01-01' or total > 100000"""


LOGS = {
    "report_parse_ledger_files": (report_files, text_views.LEDGER_SQL), "closing_marks": (closing_marks, CLOSING_MARKS), "forced_replay": (forced_replay, FORCED_REPLAY),
    "pinned_tables": (pinned_tables, PINNED_TABLES), "run_log": (run_log, RUN_LOG), "ingest_log": (ingest_log, INGEST_LOG),
    "counts_reconciled": (counts_reconciled, COUNTS_RECONCILED), "delivered_files": (delivered_files, DELIVERED_FILES), "channel_log": (channel_log, CHANNEL_LOG),
    "extract_provenance": (provenance, PROVENANCE), "dead_letters": (dead_letters, DEAD_LETTERS), "kept_positions": (kept_positions, KEPT_POSITIONS),
    "partitioned_report": (partitioned_report, PARTITIONED_REPORT),
}

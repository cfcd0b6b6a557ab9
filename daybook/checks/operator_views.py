"""Inputs for single operators, made from the driver's tables, and the rows they must give."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.functions.columns import robust_date
from daybook.operators import distinct
from daybook.operators.staging import materialise, shared_folder
from daybook.plans import readiness
from daybook.sources import raw, records
from daybook.sources.keyed import KeyedTable
from daybook.sources.tables import overwrite_partitions
from daybook.streaming import cdc

C = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """New folder for one run."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


# ---- records -----------------------------------------------------------------------------------

SPEC = records.Spec("CUSTOMER", (
    records.Field("NAME", 1), records.Field("BALANCE", 2, "decimal(20,4)"), records.Field("SEGMENT", 3, multi=True),
    records.Field("OPENED", 4, "date"), records.Field("AMOUNTS", 5, "decimal(20,4)", True),
    records.Field("LOCAL.REF", 179, multi=True)), (records.Field("NAME", 179, local_index=2),))


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as XML: padded text, gaps in multi-values, sub-values, a local field, some broken records."""
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as RECID",
        """case when c_nationkey = 3 then '<row><c1>unclosed' when c_nationkey = 4 then null else concat(
          '<row id="', c_custkey, '"><c1>  ', c_name, ' &amp; co </c1><c2>', cast(cast(c_acctbal as decimal(18,2)) as string), '</c2>',
          case when c_nationkey > 10 then concat('<c3 m="2">', c_mktsegment, '</c3><c3 m="4">x</c3><c3 m="4">second</c3>') else '<c3 m="1"/>' end,
          '<c4>', date_format(date_add(date'1990-01-01', cast(c_nationkey as int)), 'yyyyMMdd'), '</c4>',
          '<c5>', c_nationkey, '.5</c5><c5 m="2">oops</c5>',
          '<c179 m="2">L', c_nationkey, '</c179><c179 m="7" s="2">sub ', c_nationkey, '</c179><zz>1</zz></row>') end as XMLRECORD""",
        "c_mktsegment as __op")


def _parsed(spark: SparkSession, sf_dir: str) -> records.Parsed:
    return records.parse(customer_records(spark, sf_dir), SPEC, keep=["__op"])


def roundtrip_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir).main
    return parsed.select("recid", "__op", "name", "balance", "opened", "lr_name", F.array_join("segment", "|", "-").alias("segment"),
                         F.array_join(F.transform("amounts", lambda x: x.cast("string")), "|", "-").alias("amounts"))


ROUNDTRIP_MAIN = """
select cast(c_custkey as varchar) as recid, c_mktsegment as __op, c_name || ' & co' as name, c_acctbal::decimal(18,2)::decimal(20,4) as balance,
  date '1990-01-01' + c_nationkey as opened, 'L' || c_nationkey as lr_name, if(c_nationkey > 10, '-|' || c_mktsegment || '|-|x', '-') as segment,
  c_nationkey || '.5000|-' as amounts
from customer where c_nationkey not in (3, 4)"""
ROUNDTRIP_SPILL = """
select cast(c_custkey as varchar) as recid, c_mktsegment as __op, 'LOCAL.REF' as field, 179 as pos, 7 as mv_no, 2 as sv_no, 'sub ' || c_nationkey as value
from customer where c_nationkey not in (3, 4)"""
ROUNDTRIP_ERRORS = "select cast(c_custkey as varchar) as recid, c_mktsegment as __op from customer where c_nationkey in (3, 4)"


def spec_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata record per region, one field per nation, compiled and described."""
    cells = table(spark, sf_dir, "nation").selectExpr("cast(n_regionkey as string) as region", "n_nationkey as n").selectExpr(
        "region", "n", "concat('<c1 m=\"', n + 1, '\">NATION.', n, '</c1><c2 m=\"', n + 1, '\">', if(n % 7 = 0, 'I', 'D'), '</c2><c3 m=\"', n + 1, '\">', n, "
        "'</c3><c4 m=\"', n + 1, '\">', case n % 3 when 0 then 'IN2D&amp;11' when 1 then 'IN2AMT' else 'IN2' end, '</c4><c10 m=\"', n + 1, '\">', if(n % 2 = 0, 'M', 'S'), '</c10>') as x")
    record = cells.groupBy(F.concat(F.lit("R"), "region").alias("RECID")).agg(F.concat(
        F.lit("<row>"), F.array_join(F.array_sort(F.collect_list("x")), ""), F.lit("</row>")).alias("XMLRECORD"))
    return records.describe_metadata(record)


SPEC_COMPILE = """
select 'R' || n_regionkey as "table", 'nation_' || n_nationkey as "column", 'NATION.' || n_nationkey as field,
  if(n_nationkey % 2 = 0, 'array<' || t || '>', t) as type, if(n_nationkey % 2 = 0, 'multi', 'single') as kind, n_nationkey::integer as position
from (select *, case n_nationkey % 3 when 0 then 'date' when 1 then 'decimal(20,4)' else 'string' end as t from nation) where n_nationkey % 7 <> 0"""

# ---- change data capture -------------------------------------------------------------------------

_XML = "'<row><c1>' || event_type || '</c1><c2>' || cast(cast(value as decimal(18,2)) as string) || '</c2><c3 m=\"2\" s=\"2\">' || cast(event_id as string) || '</c3></row>'"


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change messages: errors are deletes, clicks come without the outer payload, sign-ups twice as tombstones."""
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type", "if(event_type in ('error', 'view'), 'topic_a', 'topic_b') as topic", f"""
        named_struct('op', case event_type when 'error' then 'd' when 'signup' then 'c' else 'u' end, 'ts_ms', event_id,
          'source', named_struct('change_lsn', if(event_type = 'view', null, lpad(cast(event_id as string), 20, '0')), 'commit_lsn', lpad(cast(event_id as string), 20, '0')),
          'before', if(event_type = 'error', named_struct('RECID', cast(user_id as string)), null),
          'after', if(event_type = 'error', null, named_struct('RECID', cast(user_id as string), 'XMLRECORD', {_XML}))) as m""")
    body = F.when(C("event_type") == "click", F.to_json("m")).otherwise(F.to_json(F.struct(C("m").alias("payload"))))
    live = rows.select("topic", body.cast("binary").alias("value"), C("event_id").alias("offset"))
    tombstones = rows.filter(C("event_type") == "error").select("topic", F.lit(None).cast("binary").alias("value"), C("event_id").alias("offset"))
    return live.unionByName(tombstones)


_EVENT = f"""select if(event_type in ('error', 'view'), 'topic_a', 'topic_b') as topic, cast(user_id as varchar) as recid, if(event_type = 'error', null, {_XML}) as xml, event_type,
  case event_type when 'error' then 'd' when 'signup' then 'c' else 'u' end as op, lpad(cast(event_id as varchar), 20, '0') as lsn, event_id, value from events"""


def cdc_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.unwrap(messages(spark, sf_dir), ["topic"])


CDC_UNWRAP = f"""select topic, recid as "RECID", xml as "XMLRECORD", op as __op, lsn as __lsn, event_id as __ts_ms, event_id as __offset from ({_EVENT})"""


def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.latest_events(cdc.unwrap(messages(spark, sf_dir)))


CDC_LATEST = f"""select recid as "RECID", xml as "XMLRECORD", op as __op, lsn as __lsn, event_id as __ts_ms, event_id as __offset from ({_EVENT})
qualify row_number() over (partition by recid order by lsn desc) = 1"""

EVENT_SPEC = records.Spec("EVENT", (records.Field("TYPE", 1), records.Field("VALUE", 2, "decimal(20,4)"), records.Field("ID", 3, multi=True)))
ROUTES = cdc.parse_routes(["# name=topic:table", "A=topic_a:table_a:ss=EVENT", "", "B=topic_b:table_b:ss=EVENT"])


def _state(bronze: cdc.Bronze) -> DataFrame:
    """Both tables with the sub-value of each record."""
    out = None
    for name in ("table_a", "table_b"):
        rows = bronze.read(name).join(bronze.children(name).select("recid", C("value").alias("sub_value")), "recid", "left")
        rows = rows.select(F.lit(name).alias("table_name"), "recid", "type", "value", "sub_value")
        out = rows if out is None else out.unionByName(rows)
    return out


def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches applied out of order, one of them twice, with a compaction in between."""
    bronze = cdc.Bronze(spark, scratch(spark))
    source = messages(spark, sf_dir)
    for turn, rest in enumerate((2, 0, 0, 1)):
        bronze.apply_batch(source.filter(C("offset") % 3 == rest), ROUTES, {"EVENT": EVENT_SPEC})
        if turn == 2:
            bronze.compact(["table_a", "table_b"])
    return _state(bronze)


def cdc_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half as one stream, a compaction, the earlier half as a stream with a new checkpoint, then all of it with a third."""
    folder = scratch(spark)
    source = messages(spark, sf_dir)
    middle = table(spark, sf_dir, "events").agg(F.expr("percentile_approx(event_id, 0.5)")).scalar()
    bronze = cdc.Bronze(spark, f"{folder}/bronze")
    for turn, part in enumerate((C("offset") > middle, C("offset") <= middle, F.lit(True))):
        source.filter(part).repartition(2).write.parquet(f"{folder}/in{turn}")
        stream = spark.readStream.schema("topic string, value binary, offset bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in{turn}")
        bronze.run(stream, ROUTES, {"EVENT": EVENT_SPEC}, f"{folder}/checkpoint{turn}", every=None, compact_every=2).awaitTermination()
    return _state(bronze)


def cdc_stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream of files, a few per micro-batch."""
    folder = scratch(spark)
    messages(spark, sf_dir).repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("topic string, value binary, offset bigint").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    bronze = cdc.Bronze(spark, f"{folder}/bronze")
    bronze.run(stream, ROUTES, {"EVENT": EVENT_SPEC}, f"{folder}/checkpoint", every=None).awaitTermination()
    return _state(bronze)


CDC_STATE = f"""
with l as (select * from ({_EVENT}) qualify row_number() over (partition by topic, recid order by lsn desc) = 1)
select if(topic = 'topic_a', 'table_a', 'table_b') as table_name, recid, event_type as type, value::decimal(18,2)::decimal(20,4) as value, cast(event_id as varchar) as sub_value
from l where op <> 'd'"""


def _in_two_runs(spark: SparkSession, sf_dir: str, start) -> None:
    """A stream over files that stops, goes on with more files and the same checkpoint, and starts over on the first files with a new one."""
    folder = scratch(spark)
    parts = messages(spark, sf_dir).repartition(4, "offset")
    halves = [parts.filter(C("offset") % 2 == turn) for turn in (1, 0)]
    halves[0].write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("topic string, value binary, offset bigint").option("maxFilesPerTrigger", 3).parquet(f"{folder}/in")
    start(cdc.unwrap(stream, ["topic"]), f"{folder}/checkpoint").awaitTermination()
    halves[1].write.mode("append").parquet(f"{folder}/in")
    start(cdc.unwrap(stream, ["topic"]), f"{folder}/checkpoint").awaitTermination()
    halves[0].write.parquet(f"{folder}/again")
    again = spark.readStream.schema("topic string, value binary, offset bigint").parquet(f"{folder}/again")
    start(cdc.unwrap(again, ["topic"]), f"{folder}/fresh").awaitTermination()


def cdc_stream_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = KeyedTable(spark, scratch(spark), ["RECID"], prefixes=16)
    _in_two_runs(spark, sf_dir, lambda events, checkpoint: cdc.stream_newest(events.drop("topic"), table_, checkpoint, every=None))
    return table_.read()


def cdc_stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ = KeyedTable(spark, scratch(spark), ["topic"], prefixes=4)
    _in_two_runs(spark, sf_dir, lambda events, checkpoint: cdc.stream_progress(events, C("topic"), table_, checkpoint, every=None))
    return cdc.stored_progress(table_)


def distinct_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders per month, quarter and year, counted once."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
    numbered = orders.join(distinct.dense_numbers(orders, "o_custkey", "number"), "o_custkey")
    months = materialise(distinct.bitmaps(numbered, ["month"], "number"))
    quarters = distinct.rolled_up(months.withColumn("quarter", F.trunc("month", "quarter")), ["quarter"])
    years = distinct.rolled_up(quarters.withColumn("year", F.trunc("quarter", "year")), ["year"])
    out = None
    for kind, bits in (("month", months), ("quarter", quarters), ("year", years)):
        rows = distinct.counted(bits, [kind], "customers").select(F.lit(kind).alias("kind"), C(kind).alias("period"), "customers")
        out = rows if out is None else out.unionByName(rows)
    return out


DISTINCT_BY_PERIOD = " union all ".join(
    f"select '{kind}' as kind, date_trunc('{kind}', o_orderdate)::date as period, count(distinct o_custkey) as customers from orders group by 2" for kind in ("month", "quarter", "year"))


def progress_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = cdc.unwrap(messages(spark, sf_dir), ["topic"])
    first = cdc.progress_rows(events.filter(C("__offset") % 2 == 0), C("topic"))
    return cdc.advance(first, cdc.progress_rows(events, C("topic")))


PROGRESS_MAX = f"with e as ({_EVENT}) select topic as table_name, max(lsn) as max_lsn from e group by 1 union all select '__global__', max(lsn) from e"


def _marks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per event type: progress of the types that are not views, end and committed offsets."""
    events = table(spark, sf_dir, "events")
    progress = cdc.progress_rows(events.filter(C("event_type") != "view").select(
        C("event_type"), F.lpad(C("event_id").cast("string"), 20, "0").alias("__lsn")), C("event_type"))
    ends = events.groupBy(C("event_type").alias("topic"), (C("user_id") % 3).alias("partition")).agg(F.max("event_id").alias("end_offset"))
    read = events.filter((C("event_type") != "click") & ~((C("event_type") == "purchase") & (C("user_id") % 3 == 1))) \
        .groupBy(C("event_type").alias("topic"), (C("user_id") % 3).alias("partition")).agg(F.max("event_id").alias("committed_offset"))
    return progress, ends, read


def topic_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, ends, read = _marks(spark, sf_dir)
    topics = ends.select("topic").distinct().unionByName(table(spark, sf_dir, "region").select(C("r_name").alias("topic")))
    return readiness.lag(ends, read, topics)


TOPIC_LAG = """
with e as (select event_type as topic, user_id % 3 as p, max(event_id) as x, event_type = 'click' or (event_type = 'purchase' and user_id % 3 = 1) as unread from events group by 1, 2, 4)
select topic, sum(if(unread, x, 0))::bigint as lag from e group by 1 union all select r_name, 0 from region"""


def caught_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress, ends, read = _marks(spark, sf_dir)
    topics = ends.select("topic").distinct()
    lags = readiness.lag(ends, read, topics)
    newest = table(spark, sf_dir, "events").agg(F.max("event_id")).scalar()
    return readiness.caught_up(topics.select(C("topic").alias("source_table"), "topic"), progress, lags, F.lpad((newest - 1).cast("string"), 20, "0"))


CAUGHT_UP = """
with m as (select max(event_id) - 1 as cut, max(event_id) filter (event_type <> 'view') as whole from events),
t as (select event_type as t, max(event_id) as x from events group by 1),
g as (select event_type as topic, user_id % 3 as p, max(event_id) as x, event_type = 'click' or (event_type = 'purchase' and user_id % 3 = 1) as unread from events group by 1, 2, 4),
l as (select topic, sum(if(unread, x, 0))::bigint as lag from g group by 1)
select t as source_table, if(t = 'view', null, lpad(cast(x as varchar), 20, '0')) as max_lsn, lag,
  coalesce(t <> 'view' and x >= cut, false) or (whole >= cut and lag = 0) as caught_up
from t join l on l.topic = t.t cross join m"""

# ---- tables and ledger ---------------------------------------------------------------------------


def partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year written twice, then the last year replaced by its filled orders only."""
    path = scratch(spark)
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    for _ in range(2):
        overwrite_partitions(orders, path, ["y"])
    last = orders.agg(F.max("y")).scalar()
    overwrite_partitions(orders.filter((C("y") == last) & (C("o_orderstatus") == "F")), path, ["y"])
    return spark.read.parquet(path).groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum(C("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))


PARTITION_OVERWRITE = """
select year(o_orderdate)::integer as y, count(*) as n, sum(o_totalprice::decimal(18,2))::decimal(28,2) as total from orders
where o_orderstatus = 'F' or year(o_orderdate) < (select max(year(o_orderdate)) from orders) group by 1"""


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", C("o_orderdate").cast("date").alias("day"))
    fresh = raw.newer_than(orders, "day", "1999-01-01")
    return fresh.withColumn("next_mark", raw.high_water(fresh, "day").scalar())


INCREMENTAL = "select o_orderkey, o_orderdate::date as day, (select max(o_orderdate)::date from orders) as next_mark from orders where o_orderdate > date '1999-01-01'"


def robust_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """case o_custkey % 7 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'dd/MM/yyyy HH:mm:ss')
      when 2 then date_format(o_orderdate, 'dd-MM-yyyy') when 3 then date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss") when 4 then date_format(o_orderdate, 'dd/MM/yyyy')
      when 5 then date_format(o_orderdate, "'00'yy-MM-dd") else 'no date' end"""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{text} as raw")
    return rows.select("o_orderkey", robust_date("raw", fallback=F.lit("1900-01-01").cast("date")).alias("day"))


ROBUST_DATES = """select o_orderkey, case o_custkey % 7 when 6 then date '1900-01-01' when 5 then make_date(2000 + (year(o_orderdate) % 100)::bigint, month(o_orderdate), day(o_orderdate))
  else o_orderdate::date end as day from orders"""


def logical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").selectExpr("concat(case n_regionkey when 0 then 'FBNK_' when 1 then 'F_' else '' end, 'T_', n_name) as physical")
    return raw.logical_names(names, {"FBNK_T_NATION_0": ("OWN.KEY", "own_table")})


LOGICAL_NAMES = """
select case n_regionkey when 0 then 'FBNK_' when 1 then 'F_' else '' end || 'T_' || n_name as physical,
  if(n_name = 'NATION_0' and n_regionkey = 0, 'OWN.KEY', replace('T_' || n_name, '_', '.')) as metadata_key, if(n_name = 'NATION_0' and n_regionkey = 0, 'own_table', lower('T_' || n_name)) as target from nation"""


def _control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' customers as sources of a day: opened, most sealed, some failed, one sealed again."""
    customers = table(spark, sf_dir, "customer").select(
        F.lit("1998-06-01").cast("date").alias("business_date"), C("c_name").alias("source_table"), "c_nationkey", "c_custkey")
    empty = spark.createDataFrame([], readiness.CONTROL)
    control = readiness.open_pending(empty, customers.select("business_date", "source_table", F.lit("cdc").alias("flow"), F.lit("7").alias("l_cob")))
    sealed = customers.filter(C("c_nationkey") != 5).select("business_date", "source_table", F.lit("cdc").alias("flow"), C("c_custkey").alias("snapshot_id"))
    control = readiness.seal(control, sealed)
    control = readiness.mark_failed(control, customers.filter(C("c_nationkey") == 6).unionByName(
        customers.withColumn("source_table", F.concat(F.lit("not "), "source_table"))))
    again = customers.filter(C("c_nationkey") == 7).select("business_date", "source_table", F.lit("pull").alias("flow"), F.lit(3).cast("bigint").alias("actual_count"))
    return readiness.seal(control, again)


def seal_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _control(spark, sf_dir).drop("sealed_at")


_LEDGER = """select date '1998-06-01' as business_date, c_name as source_table, if(c_nationkey = 7, 'pull', 'cdc') as flow,
  case c_nationkey when 5 then 'pending' when 6 then 'failed' else 'sealed' end as status, null::bigint as expected_count,
  if(c_nationkey = 7, 3, null)::bigint as actual_count, '7' as l_cob, if(c_nationkey = 5, null, c_custkey) as snapshot_id from customer"""


def all_sealed(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer").select(C("c_mktsegment").alias("mart"), C("c_name").alias("source_table")).unionByName(
        table(spark, sf_dir, "customer").filter("c_nationkey > 7").select(F.lit("late").alias("mart"), C("c_name").alias("source_table")))
    return readiness.all_sealed(_control(spark, sf_dir), wanted, "1998-06-01")


ALL_SEALED = """
select c_mktsegment as mart, bool_and(c_nationkey not in (5, 6)) as ready from customer group by 1
union all select 'late', true from customer having count(*) filter (c_nationkey > 7) > 0"""


def source_set_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers declare parts as captured or pulled; parts declared both ways are returned."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("cast(l_suppkey as string) as mart", "'x' as division", "cast(l_partkey as string) as source_table",
                                                       "case when l_returnflag = 'R' then 'pull' when l_linestatus = 'O' then 'event' else 'dim' end as kind")
    return readiness.misclassified(rows)


SOURCE_SET_CHECK = "select cast(l_partkey as varchar) as source_table from lineitem group by 1 having bool_or(l_returnflag = 'R') and bool_or(l_returnflag <> 'R')"


def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are the files that arrived, line items the manifest; missing entries are marked."""
    files = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(C("o_orderkey").cast("string").alias("file_name"))
    manifest = table(spark, sf_dir, "lineitem").select(C("l_orderkey").cast("string").alias("file_name"), C("l_returnflag").alias("report_name"),
                                                       F.trunc("l_shipdate", "year").alias("date_created"))
    found, missing = raw.wanted_files(files, manifest, "A", "1998-01-01")
    return found.withColumn("status", F.lit("found")).unionByName(missing.distinct().withColumn("status", F.lit("missing")))


FILE_MANIFEST = """
with m as (select distinct l_orderkey as f from lineitem where l_returnflag = 'A' and year(l_shipdate) = 1998), a as (select o_orderkey as f from orders where o_orderstatus <> 'P')
select cast(f as varchar) as file_name, if(f in (select f from a), 'found', 'missing') as status from m"""


def template_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as pipe lines under a 14-column template; short ones are set aside."""
    names = ["id", *[f"c{i}" for i in range(2, 14)], "amount"]
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "concat_ws('|', concat(l_orderkey, '-', l_linenumber), l_partkey, l_suppkey, '', ' x ', 'e', 'f', 'g', 'h', 'i', 'j', if(l_returnflag = 'R', null, 'k'), 'l', "
        "if(l_linestatus = 'F', 'n/a', format_number(l_extendedprice, 2))) as value")
    good, short = raw.split_by_template(lines, names, numeric=["amount"])
    return good.select("id", "c5", "amount", "amount_is_number").unionByName(
        short.select(F.split("value", "[|]")[0].alias("id"), F.lit(None).cast("string").alias("c5"), F.lit("short").alias("amount"), F.lit(None).cast("boolean").alias("amount_is_number")))


TEMPLATE_SPLIT = """
select l_orderkey || '-' || l_linenumber as id, if(l_returnflag = 'R', null, 'x') as c5,
  case when l_returnflag = 'R' then 'short' when l_linestatus = 'F' then 'n/a' else format('{:,.2f}', l_extendedprice) end as amount,
  if(l_returnflag = 'R', null, l_linestatus <> 'F') as amount_is_number from lineitem"""

OPERATORS = {
    "record_roundtrip_main": (roundtrip_main, ROUNDTRIP_MAIN),
    "record_roundtrip_spill": (lambda s, d: _parsed(s, d).sub_values, ROUNDTRIP_SPILL),
    "record_roundtrip_errors": (lambda s, d: _parsed(s, d).errors, ROUNDTRIP_ERRORS),
    "spec_compile": (spec_compile, SPEC_COMPILE),
    "cdc_unwrap": (cdc_unwrap, CDC_UNWRAP), "cdc_latest": (cdc_latest, CDC_LATEST), "cdc_apply": (cdc_apply, CDC_STATE),
    "cdc_stream_replay": (cdc_stream_replay, CDC_STATE), "cdc_restart": (cdc_restart, CDC_STATE), "progress_max": (progress_max, PROGRESS_MAX),
    "cdc_stream_newest": (cdc_stream_newest, CDC_LATEST), "cdc_stream_progress": (cdc_stream_progress, PROGRESS_MAX),
    "distinct_by_period": (distinct_by_period, DISTINCT_BY_PERIOD), "topic_lag": (topic_lag, TOPIC_LAG), "caught_up": (caught_up, CAUGHT_UP),
    "partition_overwrite_idempotent": (partition_overwrite, PARTITION_OVERWRITE),
    "incremental_extract": (incremental_extract, INCREMENTAL), "robust_date_parse": (robust_dates, ROBUST_DATES),
    "logical_table_names": (logical_names, LOGICAL_NAMES), "seal_ledger": (seal_ledger, _LEDGER), "all_sealed": (all_sealed, ALL_SEALED),
    "source_set_check": (source_set_check, SOURCE_SET_CHECK), "file_manifest": (file_manifest, FILE_MANIFEST),
    "template_split": (template_split, TEMPLATE_SPLIT),
}

"""Readers and writers on files made from the given tables, and the rows they must give back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from daybook.operators.frames import global_row_number
from daybook.operators.staging import materialise, shared_folder
from daybook.sources import raw
from daybook.sources.keyed import KeyedTable
from daybook.sources.tables import ParquetStore, align, merge_rows, save_partitions, save_table, upsert_report, write_day, write_report

C = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def new_table() -> str:
    return f"t_{uuid.uuid4().hex}"


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an extract with a further column, written in files of 100 rows."""
    path = new_folder(spark)
    raw.write_extract(table(spark, sf_dir, "customer").selectExpr("cast(c_custkey as string) as RECID", "concat('<row><c1>', c_name, '</c1></row>') as XMLRECORD",
                                                                  "c_nationkey as other"), path, rows_per_file=100)
    return raw.read_raw(spark, path)


LANDED_RECORDS = """select cast(c_custkey as varchar) as "RECID", '<row><c1>' || c_name || '</c1></row>' as "XMLRECORD" from customer"""


def bulk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a bulk copy with status lines; the text of a record may hold tabs."""
    path = new_folder(spark)
    table(spark, sf_dir, "orders").selectExpr("""if(o_orderstatus = 'P', concat(o_orderkey, ' rows copied.'),
        concat(o_orderkey, '\\t', o_orderpriority, if(o_orderstatus = 'F', '\\tmore', ''))) as value""").write.text(path)
    return raw.read_bulk_text(spark, path)


BULK_TEXT = """select cast(o_orderkey as varchar) as "RECID", o_orderpriority || if(o_orderstatus = 'F', chr(9) || 'more', '') as "XMLRECORD"
from orders where o_orderstatus <> 'P'"""


def metadata_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON arrays of at most 1,000 records, one array to a file."""
    path = new_folder(spark)
    record = F.struct(C("c_name").alias("RECID"), F.concat(F.lit("<row>\n"), "c_custkey", F.lit("</row>")).alias("XMLRECORD"))
    arrays = table(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 1000")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return raw.read_metadata(spark, path)


METADATA_ARRAY = """select c_name as "RECID", '<row>' || chr(10) || c_custkey || '</row>' as "XMLRECORD" from customer"""


def utf16_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in UTF-16 with marks in the cells, blanks and empty rows."""
    path = new_folder(spark)
    rows = table(spark, sf_dir, "customer").selectExpr("if(c_nationkey = 4, '', concat('@', c_custkey)) as a", "if(c_nationkey in (3, 4), ' ', concat(c_name, ' é')) as b")
    rows.write.csv(path, sep="~", encoding="UTF-16LE", header=True, lineSep="\n")
    return raw.read_utf16_table(spark, path, "a string, b string")


UTF16_TABLE = "select cast(c_custkey as varchar) as a, if(c_nationkey = 3, null, c_name || ' é') as b from customer where c_nationkey <> 4"


def mixed_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in three encodings below one folder; the lines of a file are numbered, empty ones too."""
    path = new_folder(spark)
    lines = table(spark, sf_dir, "customer").selectExpr("c_nationkey % 3 as kind", "concat('olá}', c_name, '~', c_custkey) as value")
    for kind, encoding in enumerate(("ISO-8859-1", "UTF-8", "UTF-16")):
        lines.filter(C("kind") == kind).select("value").write.csv(f"{path}/{encoding}", encoding=encoding, quote="", escapeQuotes=False)
    read = raw.read_mixed_encodings(spark, f"{path}/*/*.csv")
    each = read.select("source_file", "line_seq", "line", C("cells")[0].alias("head"), C("cells")[1].alias("key"))
    return each.withColumn("lines", F.max("line_seq").over(Window.partitionBy("source_file"))).select(
        "line", "head", "key", (C("line_seq").between(1, C("lines"))).alias("numbered"))


MIXED_ENCODINGS = "select 'olá: ' || c_name || '~' || c_custkey as line, 'olá: ' || c_name as head, cast(c_custkey as varchar) as key, true as numbered from customer"


def pipe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_returnflag").write.csv(path, sep="|")
    return raw.read_pipe_table(spark, path, ["order_key", "line", "flag"])


PIPE_TABLE = "select cast(l_orderkey as varchar) as order_key, cast(l_linenumber as varchar) as line, l_returnflag as flag from lineitem"


def quoted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with quotes, separators and line ends inside their cells, in one file for every 200,000 rows."""
    path = new_folder(spark)
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "concat('a \"', l_returnflag, '\", b\n\n\"c', if(l_linenumber = 1, '\n\"\"', '')) as text", "l_partkey", "l_linenumber")
    lines.coalesce(1).write.option("maxRecordsPerFile", 200_000).csv(path, header=True, quote='"', escape='"', quoteAll=True)
    return raw.read_quoted_table(spark, path)


QUOTED_TABLE = """select cast(l_orderkey as varchar) as l_orderkey, 'a "' || l_returnflag || '", b' || chr(10) || chr(10) || '"c' || if(l_linenumber = 1, chr(10) || '""', '') as text,
  cast(l_partkey as varchar) as l_partkey, cast(l_linenumber as varchar) as l_linenumber from lineitem"""


def seed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as int) as code", "s_name as label").write.csv(path, header=True)
    return raw.read_seed(spark, path, "code int, label string")


SEED_TABLE = "select s_suppkey::integer as code, s_name as label from supplier"


def header_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text with more cells than headers; the delimiter is found in the lines."""
    path = new_folder(spark)
    table(spark, sf_dir, "lineitem").selectExpr("concat_ws(';', '0', l_orderkey, l_linenumber, concat(' ', l_returnflag), l_linestatus) as value").write.text(path)
    lines = spark.read.text(path)
    return raw.assign_headers(lines, ["order_key", "line"], 5, raw.best_delimiter(lines), drop_first=True)


HEADER_ASSIGNMENT = """select cast(l_orderkey as varchar) as order_key, cast(l_linenumber as varchar) as line, l_returnflag as "Extra_Col_3",
  l_linestatus as "Extra_Col_4" from lineitem"""


def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers exported by balance and read back in the order of files and lines."""
    path = new_folder(spark)
    raw.export_csv(table(spark, sf_dir, "supplier").select("s_suppkey", C("s_acctbal").cast("decimal(18,2)").alias("bal")), path, [C("bal").desc(), "s_suppkey"])
    back = spark.read.csv(path, header=True).select("s_suppkey", C("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("place"))
    return global_row_number(back, ["file", "place"], "line").select("s_suppkey", "line")


ORDERED_EXPORT = """select cast(s_suppkey as varchar) as s_suppkey, row_number() over (order by s_acctbal::decimal(18,2) desc, s_suppkey) as line from supplier"""


def day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers pulled on two days; the second day is pulled again with fewer rows."""
    path = new_folder(spark)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    write_day(customers, path, "1998-06-01")
    write_day(customers, path, "1998-06-02")
    write_day(customers.filter("c_nationkey < 5"), path, "1998-06-02")
    return spark.read.parquet(path).select("c_custkey", "business_date")


DAY_PARTITIONS = """select c_custkey, date '1998-06-01' as business_date from customer
union all select c_custkey, date '1998-06-02' from customer where c_nationkey < 5"""


def report_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per year and status loaded year by year, the last year twice: what is stored is one row per key."""
    store = ParquetStore(spark, new_folder(spark))
    orders = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y"), C("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"))
    write_report(store, "report", orders.filter("y < 1996"), ["y", "status"])
    write_report(store, "report", orders.filter("y >= 1996").withColumn("n", F.lit(-1).cast("long")), ["y", "status"])
    return write_report(store, "report", orders.filter("y >= 1996"), ["y", "status"]).drop("updated_at")


REPORT_STORE = "select year(o_orderdate)::integer as y, o_orderstatus as status, count(*) as n from orders group by 1, 2"


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by key and, on top, those of the last months: changed, deleted where they are filled, and each once more under a new key."""
    stored = KeyedTable(spark, new_folder(spark), ["id", "kind"], prefixes=24)
    orders = table(spark, sf_dir, "orders").select(C("o_orderkey").alias("id"), F.lit("order").alias("kind"), C("o_custkey").alias("customer"),
                                                   C("o_orderdate").cast("date").alias("day"), C("o_orderstatus").alias("state"))
    stored.upsert(orders.drop("state"))
    late = orders.filter("day >= '1998-06-01'")
    stored.upsert(late.withColumn("note", F.lit("late")).withColumn("customer", C("customer") + 100), gone=C("state") == "F")
    stored.upsert(late.selectExpr("id", "'copy' as kind", "customer", "day"))
    return stored.read().drop("state")


KEYED_UPSERT = """with o as (select o_orderkey as id, 'order' as kind, o_custkey as customer, o_orderdate::date as day, o_orderstatus as state from orders),
late as (select * from o where day >= date '1998-06-01')
select id, kind, customer, day, null as note from o where day < date '1998-06-01'
union all select id, kind, customer + 100, day, 'late' from late where state <> 'F'
union all select id, 'copy', customer, day, null from late"""


def report_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per month and status, stored as one load and then loaded once more for the last year; months decide which prefixes a load touches."""
    path = new_folder(spark)
    sales = table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month"), C("o_orderstatus").alias("status"), C("o_custkey").alias("customer")).agg(
        F.sum(C("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
    first = upsert_report(spark, path, sales.withColumn("total", F.when(C("month") < "1998-01-01", C("total"))), ["month", "status", "customer"], by=["month"], prefixes=24)
    last = sales.filter("month >= '1998-01-01'")
    return upsert_report(spark, path, last, ["month", "status", "customer"], by=["month"]).select(*first.drop("updated_at").columns)


REPORT_UPSERT = """select date_trunc('month', o_orderdate)::date as month, o_orderstatus as status, o_custkey as customer, sum(o_totalprice::decimal(18,2))::decimal(28,2) as total
from orders group by 1, 2, 3"""


def newer_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of dates that the own history does not reach."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", C("o_orderdate").cast("date").alias("day"))
    return raw.newer_than_own(orders, "day", orders.filter(F.year("day") < 1997))


NEWER_LOADS = "select o_orderkey, o_orderdate::date as day from orders where o_orderdate > (select max(o_orderdate) from orders where year(o_orderdate) < 1997)"


def newer_loads_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a table partitioned by month of the order: older partitions are not read."""
    path = new_folder(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"))
    orders.repartition("month").write.partitionBy("month").parquet(path)
    return raw.newer_than_own(spark.read.parquet(path), "month", orders.filter(F.year("month") < 1997))


NEWER_LOADS_BY_DAY = "select o_orderkey, date_trunc('month', o_orderdate)::date as month from orders where year(o_orderdate) >= 1997"


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rebuilt table, and one by partition that is created and then partly replaced, with its columns aligned."""
    whole, parts = new_table(), new_table()
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    for _ in range(2):
        save_table(customers, whole)
    save_partitions(customers, parts, ["c_nationkey"])
    save_partitions(align(customers.filter("c_nationkey = 1 and c_custkey > 50"), [("c_custkey", "bigint"), ("c_nationkey", "bigint")]), parts, ["c_nationkey"])
    both = spark.table(whole).withColumn("kind", F.lit("whole")).unionByName(spark.table(parts).withColumn("kind", F.lit("parts")))
    kept = materialise(both.select(C("c_custkey").cast("bigint"), C("c_nationkey").cast("int"), "kind"))
    for name in (whole, parts):
        spark.sql(f"drop table {name}")
    return kept


CATALOG_TABLES = """select c_custkey, c_nationkey::integer as c_nationkey, 'whole' as kind from customer
union all select c_custkey, c_nationkey::integer, 'parts' from customer where c_nationkey <> 1 or c_custkey > 50"""


def upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers merged with changed and new ones; an empty segment keeps the old one."""
    old = table(spark, sf_dir, "customer").selectExpr("c_custkey as id", "c_mktsegment as segment", "c_nationkey as n")
    new = old.filter("n < 5").selectExpr("id + if(n = 4, 10000000, 0) as id", "if(n % 2 = 0, null, 'NEW') as segment", "n + 100 as n")
    return merge_rows(old, new, ["id"], ["segment"])


UPSERTS = """select c_custkey as id, if(c_nationkey in (1, 3), 'NEW', c_mktsegment) as segment, c_nationkey + if(c_nationkey < 4, 100, 0) as n from customer
union all select c_custkey + 10000000, null, 104 from customer where c_nationkey = 4"""

FILES = {
    "landed_records": (landed_records, LANDED_RECORDS), "bulk_text": (bulk_text, BULK_TEXT), "metadata_array": (metadata_array, METADATA_ARRAY),
    "utf16_table": (utf16_table, UTF16_TABLE), "mixed_encodings": (mixed_encodings, MIXED_ENCODINGS), "pipe_table": (pipe_table, PIPE_TABLE),
    "quoted_table": (quoted_table, QUOTED_TABLE), "seed_table": (seed_table, SEED_TABLE), "header_assignment": (header_assignment, HEADER_ASSIGNMENT),
    "ordered_export": (ordered_export, ORDERED_EXPORT), "day_partitions": (day_partitions, DAY_PARTITIONS), "report_store": (report_store, REPORT_STORE),
    "newer_loads": (newer_loads, NEWER_LOADS), "newer_loads_by_day": (newer_loads_by_day, NEWER_LOADS_BY_DAY), "catalog_tables": (catalog_tables, CATALOG_TABLES), "upserts": (upserts, UPSERTS), "keyed_upsert": (keyed_upsert, KEYED_UPSERT), "report_upsert": (report_upsert, REPORT_UPSERT),
}

"""Report files and records written from the driver's tables, to be parsed back, and what must come out."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.operators.frames import SLICE, running_sum, slices
from daybook.operators.staging import materialise

C = F.col
BANK = "EXBANK"
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax"
_FILE = "concat(l_linestatus, '_', cast(l_suppkey % 13 + 1 as string), '.txt')"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(pieces: DataFrame, key: str, order: list[str], lines: Column, sample: DataFrame) -> DataFrame:
    """Line numbers over the pieces of a file, as a reader of the file would give them.

    ``lines`` holds the lines of a piece. They are written behind the shuffle, from the columns that pieces are ordered by; files are
    cut into slices, whose bounds come from ``sample``.
    """
    cuts = slices(pieces, [key], order, sample)
    each = (cuts.number(pieces) if cuts else pieces).withColumn("one", F.lit(1).cast("bigint"))
    each = each.select(*each.columns, F.posexplode(lines).alias("piece", "line")).drop("line")
    cuts = replace(cuts, rows=each)
    seq = running_sum(each.repartition(key, SLICE) if cuts else each, [key], [*order, "piece"], "one", "line_seq", cuts)
    return materialise(seq.select(C(key).alias("file"), key, C("line_seq").cast("int").alias("line_seq"), lines[C("piece")].alias("line")))


def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per branch and ledger; the kind of each line follows l_linenumber."""
    item = _table(spark, sf_dir, "lineitem").selectExpr(
        f"{_FILE} as source_file", "l_linestatus", "l_suppkey % 13 + 1 as branch", *_ORDER.split(", "))
    k, p, price = C("l_linenumber"), C("l_partkey"), F.format_number("l_extendedprice", 2)
    amounts = F.concat(price, F.lit("  0.00   0.00   "), F.concat(F.lit("-"), price))
    row = (F.when(k == 1, F.array(F.concat(F.lit("  AC.1.TR."), p, F.lit("  "), amounts)))
           .when(k == 2, F.array(F.concat(F.lit(" 2730 Business Loans  "), amounts)))
           .when(k == 3, F.array(F.concat(F.lit("   AC.1.TR.USD-"), p), F.lit(""), F.lit("     .3004.X"),
                                 F.concat(F.lit("  STD   "), amounts)))
           .when(k == 4, F.array(F.lit(""))).when(k == 5, F.array(F.lit("AREA NAME  X   PAGE NO   5")))
           .when(k == 6, F.array(F.lit("  2740 Past due Loans")))
           .otherwise(F.array(F.concat(F.lit("  AC.9."), p, F.lit("  "), amounts), F.lit("  TAIL.7"))))
    body = item.select("source_file", F.lit(1).alias("part"), *_ORDER.split(", "), F.lit(None).cast("array<string>").alias("own"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in item.schema.fields if f.name in _ORDER.split(", ")]
    files = item.select("source_file", "l_linestatus", "branch").distinct()
    title = F.array(F.concat(F.lit("RE000010 "), F.lpad(C("branch").cast("string"), 2, "0"), F.lit(f" CITY {BANK}     "),
                             F.when(C("l_linestatus") == "O", "GENERAL LEDGER").otherwise("PROFIT AND LOSS")),
                    F.lit("LINE  DESCRIPTION"))
    closing = F.array(F.lit("   END OF REPORT"), F.lit(" 2750 Not a row     1.00 1.00 1.00 1.00"))
    ends = files.select("source_file", F.lit(0).alias("part"), *nothing, title.alias("own")).unionByName(
        files.select("source_file", F.lit(2).alias("part"), *nothing, closing.alias("own")))
    return _numbered(body.unionByName(ends), "source_file", ["part", *_ORDER.split(", ")], F.coalesce("own", row), body)


LEDGER_SQL = f"""
with i as (select *, {_FILE} as source_file, l_suppkey % 13 + 1 as b, case l_linenumber when 3 then 4 when 7 then 2 else 1 end as n from lineitem),
s as (select *, 2 + sum(n) over (partition by source_file order by {_ORDER} rows unbounded preceding) as last_line from i)
select case l_linenumber when 2 then '2730' when 6 then '2740' else '' end as line_code,
  case l_linenumber when 1 then 'AC.1.TR.' || l_partkey when 2 then 'Business Loans' when 3 then 'AC.1.TR.USD-' || l_partkey || '.3004.X STD'
    when 6 then 'Past due Loans' else 'AC.9.' || l_partkey end as description,
  if(l_linenumber = 6, null, l_extendedprice::decimal(18,2))::double as opening_balance, if(l_linenumber = 6, null, 0)::double as debit_movements,
  if(l_linenumber = 6, null, 0)::double as credit_movements, if(l_linenumber = 6, null, -(l_extendedprice::decimal(18,2)))::double as closing_balance,
  source_file, 'RE000010_' || lpad(cast(b as varchar), 2, '0') || '_CITY' as branch, if(l_linestatus = 'O', 'CRF_GL', 'CRF_PL') as file_type,
  (last_line - if(l_linenumber = 7, 1, 0))::integer as line_seq
from s where l_linenumber not in (4, 5)"""

STATISTICS_SQL = f"""
with r as ({LEDGER_SQL})
select source_file, branch, file_type, count(*) as rows, sum(opening_balance::decimal(18,2))::decimal(28,2) as total_opening_balance,
  sum(debit_movements::decimal(18,2))::decimal(28,2) as total_debit_movements, sum(credit_movements::decimal(18,2))::decimal(28,2) as total_credit_movements,
  sum(closing_balance::decimal(18,2))::decimal(28,2) as total_closing_balance, null::timestamp as file_time
from r group by 1, 2, 3"""

BEST_SQL = f"""
with r as ({LEDGER_SQL}), s as (select right(file_type, 2) as ledger, branch, source_file, count(*) as rows from r group by 1, 2, 3)
select ledger, branch, source_file, rows, rows > if(ledger = 'GL', 654, 242) as is_detailed from s
qualify row_number() over (partition by ledger, branch order by is_detailed desc, source_file desc) = 1"""

_SECTION_OF = "case l_linenumber when 1 then '4310' when 2 then '4320' when 3 then '4380' when 4 then '4450' when 5 then '4490' when 6 then '9999' else '4410' end"


def deposit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per branch: sections with rows, a section total and group totals; section 9999 is not of interest."""
    item = _table(spark, sf_dir, "lineitem").selectExpr(
        "concat('D_', cast(l_suppkey % 13 + 1 as string), '.txt') as source_file", f"{_SECTION_OF} as gl", "l_returnflag", "cast(l_extendedprice as decimal(18,2)) as amt",
        *_ORDER.split(", "))
    acc = F.expr("concat('000000', cast(l_suppkey % 13 + 2 as string), case l_returnflag when 'A' then '6005' when 'N' then '6006' else '7777' end, lpad(cast(l_orderkey as string), 7, '0'))")
    day = F.expr("upper(date_format(l_shipdate, 'd MMM yyyy'))")
    amount = F.format_number(F.expr("cast(l_extendedprice as decimal(18,2))"), 2)
    plain = F.concat(acc, F.lit("   USD  NAME OF "), C("l_partkey"), F.lit("      "), amount, F.lit("     "), amount)
    timed = F.concat(plain, F.lit("   1.5  A1  360"), day, F.lit("  "), day)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in item.schema.fields if f.name in _ORDER.split(", ")]
    none, own = F.lit(None).cast("string").alias("l_returnflag"), F.lit(None).cast("array<string>").alias("own")
    rows = item.select("source_file", "gl", F.lit(1).alias("part"), *_ORDER.split(", "), "l_returnflag", own)
    line = F.array(F.when(C("l_returnflag") == "A", timed).otherwise(plain))
    sums = item.groupBy("source_file", "gl").agg(F.sum("amt").alias("s"))
    heads = sums.select("source_file", "gl", F.lit(0).alias("part"), *nothing, none,
                        F.array(F.concat(C("gl"), F.lit(" Section")), F.lit("PAGE NO 1")).alias("own"))
    # one section's total is off on purpose
    wrong = F.when(C("gl") == "4490", C("s") + 1).otherwise(C("s"))
    totals = sums.filter(C("gl") != "4320").select("source_file", "gl", F.lit(2).alias("part"), *nothing, none, F.array(F.concat(
        F.lit("TOTAL FOR "), C("gl"), F.lit(" Section    "), F.format_number(wrong, 2))).alias("own"))
    demand = item.filter(C("gl").isin("4310", "4320")).groupBy("source_file").agg(F.sum("amt").alias("s")).select(
        "source_file", F.lit("4360").alias("gl"), F.lit(0).alias("part"), *nothing, none,
        F.array(F.concat(F.lit("4360 Total Demand      "), F.format_number("s", 2))).alias("own"))
    pieces = rows.unionByName(heads).unionByName(totals).unionByName(demand)
    return _numbered(pieces, "source_file", ["gl", "part", *_ORDER.split(", ")], F.coalesce("own", line), rows)


DEPOSITS_SQL = f"""
with i as (select *, 'D_' || (l_suppkey % 13 + 1) || '.txt' as source_file, {_SECTION_OF} as gl, lpad(cast(l_suppkey % 13 + 2 as varchar), 2, '0') as br,
  case l_returnflag when 'A' then '6005' when 'N' then '6006' else '7777' end as prod from lineitem)
select case when gl in ('4310', '4320') then 'demand' when gl in ('4380', '4410') then 'time' else 'passbook' end as deposit_type, gl as gl_line,
  case gl when '4310' then 'Gouvernment' when '4320' then 'Business Enterprises' when '4380' then 'Financial Institutions' when '4410' then 'Others'
    when '4450' then 'Passbook Savings' else 'Futuru Saving' end as gl_section_name,
  (l_suppkey % 13 + 2) || prod || lpad(cast(l_orderkey as varchar), 7, '0') as account_number, br as branch_code,
  case br when '02' then 'DIL' when '03' then 'GLN' when '04' then 'MAL' when '05' then 'ALU' when '06' then 'OCS' when '07' then 'BCU' when '08' then 'SAM'
    when '09' then 'ANR' when '10' then 'SUA' when '11' then 'VQQ' when '12' then 'LSP' when '13' then 'LQC' else 'MTT' end as branch_name, prod as product_code,
  case prod when '6005' then 'Passbook Savings' when '6006' then 'Futuru Saving' else 'UNKNOWN_7777' end as product_name, 'USD' as currency,
  'NAME OF ' || l_partkey as customer_name, l_extendedprice::decimal(18,2)::double as currency_amt, l_extendedprice::decimal(18,2)::double as local_ccy_amt,
  if(l_returnflag = 'A', 1.5, null)::double as int_rate, if(l_returnflag = 'A', 'A1', null) as int_type,
  if(l_returnflag = 'A', strftime(l_shipdate, '%Y-%m-%d'), null) as value_date, if(l_returnflag = 'A', strftime(l_shipdate, '%Y-%m-%d'), null) as mat_date, source_file
from i where gl <> '9999'"""

CHECKS_SQL = f"""
with d as ({DEPOSITS_SQL}),
s as (select source_file, gl_line as item, count(*) as rows, sum(local_ccy_amt::decimal(18,2)) as v from d group by 1, 2
      union all select source_file, deposit_type, count(*), sum(local_ccy_amt::decimal(18,2)) from d group by 1, 2)
select source_file, if(len(item) = 4 and item[1] = '4', 'section', 'group') as level, item, rows, v::decimal(28,2) as parsed_sum,
  case when item in ('4320', 'time', 'passbook') then null when item = '4490' then v + 1 else v end::decimal(18,2) as file_total,
  case when item in ('4320', 'time', 'passbook') then 'SKIP' when item = '4490' then 'FAIL' else 'OK' end as status from s"""

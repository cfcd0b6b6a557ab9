"""Registered queries: every mart, report and operator over the given tables, with its DuckDB twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType

from daybook.checks import accounting_sql, bank_views, file_views, log_views, operator_views, report_sql, silver_sql, text_views
from daybook.context import Context
from daybook.plans import MARTS
from daybook.sources import textreports
from daybook.sources.dimensions import store_dimensions

Query = Callable[[SparkSession, str], DataFrame]


def bank(spark: SparkSession, sf_dir: str, **more) -> Context:
    return Context.of_frames(spark, bank_views.frames(spark, sf_dir), bank_views.BUSINESS_DATE, **more)


def flat(df: DataFrame) -> DataFrame:
    """Arrays as text, so that two engines can be compared by value."""
    return df.select(*[F.when(F.col(f.name).isNotNull(), F.array_join(f.name, "|")).alias(f.name)
                       if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in df.schema.fields])


PINS = {"batch": 7}


HISTORY = {"assets_report": "assets_history", "liabilities_report": "liabilities_history"}
OVER_HISTORY = ("assets_compared", "liabilities_compared", "balance_sheet_assets", "balance_sheet_liabilities", "liquidity")


#: Marts and parsers whose keys can outgrow a task: registered once more on the path that cuts such keys into slices.
HOT_MARTS = ("account_statement", "statement_book", "trial_balance_detail", "closed_account_listing")


#: Marts that are registered once more over stored dimensions.
STORED_MARTS = ("statement_book", "account_statement", "large_daily_txn", "lending_arrangements", "acct_cust")
STORED = ("company", "category", "customer", "cus_dist", "cus_subdist", "cus_vill", "transaction", "eb_system_id", "acct_stmt_print", "ac_sub_account", "mnemonic_company",
          "account_statement", "stmt_printed", "company_sms_group", "user", "account")
_stored: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimensions of a folder, stored by the first query of a session that asks for them."""
    session = (spark.sparkContext.applicationId, sf_dir)
    if session not in _stored:
        frames, prefix = bank_views.frames(spark, sf_dir), f"dim_{uuid.uuid4().hex}_"
        _stored[session] = store_dimensions(spark, {name: frames[name] for name in STORED}, prefix)
    return _stored[session]


def _stored_mart(name: str) -> Query:
    return lambda spark, sf_dir: flat(MARTS[name](bank(spark, sf_dir, pins=PINS, stored=stored_dimensions(spark, sf_dir))))


def _mart(name: str, hot: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ctx = bank(spark, sf_dir, pins=PINS, hot=hot)
        if name in OVER_HISTORY:  # compare months of a stored report, not the single day of the ledger
            ctx.marts.update({mart: ctx.dim(view) for mart, view in HISTORY.items()})
        return flat(MARTS[name](ctx))

    return run


#: Reports that compare themselves with their own history: by load date, by report year.
BY_DAY = ("loan_sector_daily", "loan_sector_yearly", "provision", "repayment", "extra_accountable")
BY_YEAR = ("disbursement_consolidation", "monthly_disbursement")
TARGET, YEAR = "1998-06-15", 1998
#: Load dates of the history; the first two are the ones that the previous month and the year before are found at.
LOADS = ("1998-05-31", "1997-05-31", "1998-04-30", "1997-04-30", "1997-12-31", "1998-06-10")
#: Listings of one day only: report, its date column, the day.
ON_DAY = {"closed_account_listing": ("closure_date", "1996-02-06"), "opened_account_listing": ("opening_date", "1995-10-13")}


def _past(name: str) -> Query:
    """The history rows of a report that was loaded on many days before; loads that must not be found hold half of the rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        first = MARTS[name](bank(spark, sf_dir, pins=PINS))
        if name in BY_YEAR:
            ctx = bank(spark, sf_dir, pins=PINS, report_year=YEAR, history={name: first})
        else:
            half = F.pmod(F.xxhash64(*first.columns), F.lit(2)) == 0
            loads = [first.filter(F.lit(True) if i < 2 else half).withColumn("load_date", F.lit(day)) for i, day in enumerate(LOADS)]
            ctx = bank(spark, sf_dir, pins=PINS, target_date=TARGET, history={name: reduce(DataFrame.unionByName, loads)})
        return flat(MARTS[name](ctx).filter("type_period <> 'CURR'"))

    return run


def _past_sql(name: str) -> str:
    if name in BY_YEAR:
        before = f"(select max(report_year) from r where report_year < {YEAR})"
        second = f"(select max(report_year) from r where report_year < {before})"
        parts = [f"select * replace ({YEAR}::integer as report_year, '{tag}' as type_period) from r where report_year = {year}"
                 for tag, year in (("PREV", before), ("YOY", second))]
    else:
        parts = [f"select * replace ('{TARGET}' as load_date, '{tag}' as type_period) from r" for tag in ("PREV", "YOY")]
    return f"with r as (select * from ({report_sql.REPORTS[name]})) " + " union all ".join(parts)


def _on_day(name: str) -> Query:
    return lambda spark, sf_dir: flat(MARTS[name](bank(spark, sf_dir, pins=PINS, target_date=ON_DAY[name][1])))


def _on_day_sql(name: str) -> str:
    column, day = ON_DAY[name]
    return f"select * from ({report_sql.REPORTS[name]}) where {column} = '{day}'"


def _ledger(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    return textreports.parse_ledger(text_views.ledger_lines(spark, sf_dir), text_views.BANK, hot=hot)


def _deposits(spark: SparkSession, sf_dir: str, hot: bool = False) -> textreports.Deposits:
    return textreports.parse_deposits(text_views.deposit_lines(spark, sf_dir), hot=hot)


OPERATORS: dict[str, tuple[Query, str | None]] = {
    "report_parse_ledger": (_ledger, text_views.LEDGER_SQL),
    "report_parse_ledger_hot": (lambda s, d: _ledger(s, d, hot=True), text_views.LEDGER_SQL),
    "report_parse_deposits_hot": (lambda s, d: _deposits(s, d, hot=True).rows, text_views.DEPOSITS_SQL),
    "report_file_statistics": (lambda s, d: textreports.ledger_statistics(_ledger(s, d)), text_views.STATISTICS_SQL),
    "best_file_per_branch": (lambda s, d: textreports.best_files(textreports.ledger_statistics(_ledger(s, d))),
                             text_views.BEST_SQL),
    "report_parse_deposits": (lambda s, d: _deposits(s, d).rows, text_views.DEPOSITS_SQL),
    "report_reconcile": (lambda s, d: _deposits(s, d).checks, text_views.CHECKS_SQL),
    **operator_views.OPERATORS,
    **file_views.FILES,
    **log_views.LOGS,
}


def queries() -> dict[str, Query]:
    return {**{name: _mart(name) for name in MARTS}, **{f"{name}_hot": _mart(name, hot=True) for name in HOT_MARTS},
            **{f"{name}_stored": _stored_mart(name) for name in STORED_MARTS}, **{f"{name}_past": _past(name) for name in (*BY_DAY, *BY_YEAR)}, **{f"{name}_on_day": _on_day(name) for name in ON_DAY},
            **{name: run for name, (run, _) in OPERATORS.items()}}


def oracle_sql() -> dict[str, str]:
    marts = {**{name: silver_sql.silver_sql(name) for name in silver_sql.SILVER}, **report_sql.REPORTS, **accounting_sql.ACCOUNTING}
    return {**marts, **{f"{name}_hot": marts[name] for name in HOT_MARTS}, **{f"{name}_stored": marts[name] for name in STORED_MARTS},
            **{f"{name}_past": _past_sql(name) for name in (*BY_DAY, *BY_YEAR)},
            **{f"{name}_on_day": _on_day_sql(name) for name in ON_DAY}, **{name: sql for name, (_, sql) in OPERATORS.items() if sql}}

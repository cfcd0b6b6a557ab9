"""Registered queries against DuckDB. By default a cross-section; DAYBOOK_ALL=1 runs every one."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from daybook.checks import registry

FOLDER = os.environ.get("DAYBOOK_SF_DIR", "/root/testdata/sf0.001")
CROSS_SECTION = ("acct_cust", "large_daily_txn", "statement_book", "inactive_accounts", "trial_balance_detail", "loan_sector_yearly",
                 "deposit_listing", "savers_by_gender", "remittance_quarterly", "asset_summary", "assets_compared", "earnings_statement",
                 "record_roundtrip_main", "report_parse_ledger", "cdc_latest", "seal_ledger")
QUERIES, EXPECTED = registry.queries(), registry.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, float):
        return format(value, ".9g")
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value if value is None else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


def test_every_query_has_expected_rows():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("DAYBOOK_ALL") else CROSS_SECTION)
def test_query_equals_duckdb(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(EXPECTED[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    want = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall()), key=repr)
    got = sorted((tuple(plain(row[c]) for c in columns) for row in df.collect()), key=repr)
    assert got == want and got


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0

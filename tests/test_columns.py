from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.functions import columns as c


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()] or [F.lit(1)])
    return row.select(column.alias("x")).first()["x"]


def test_keys_and_blanks(spark):
    assert one(spark, c.k("a"), a=" 7 ") == "7"
    assert one(spark, c.blank_null("a"), a="  ") is None
    assert one(spark, c.first_text("a", "b"), a=" ", b="x") == "x"
    assert one(spark, c.first_text("a", "b", blank_is_null=False), a=" ", b="x") == ""
    assert one(spark, c.name_concat("a", "b", "d"), a="Ana", b=" ", d="Cruz ") == "Ana Cruz"


@pytest.mark.parametrize(("text", "want"), [("1,234.50", Decimal("1234.50")), ("x", None), ("", None), (None, None)])
def test_numbers(spark, text, want):
    assert one(spark, c.num_or_null(F.lit(text).cast("string"), "decimal(18,2)")) == want


def test_sides(spark):
    for amount, want in ((-5, (Decimal(5), Decimal(0), "Debit")), (0, (Decimal(0), Decimal(0), "Credit")),
                         (7, (Decimal(0), Decimal(7), "Credit"))):
        assert tuple(one(spark, x) for x in c.dr_cr(F.lit(amount))) == want
    debit, credit, _ = c.dr_cr(F.lit(0), zero=False)
    assert one(spark, debit) is None and one(spark, credit) is None
    debit, credit, side = c.dr_cr(F.lit(None).cast("int"))
    assert (one(spark, debit), one(spark, credit), one(spark, side)) == (Decimal(0), Decimal(0), "Credit")


@pytest.mark.parametrize(("day", "want"), [
    ("2026-01-01", "1st January 2026"), ("2026-02-02", "2nd February 2026"), ("2026-03-03", "3rd March 2026"),
    ("2026-04-11", "11th April 2026"), ("2026-05-12", "12th May 2026"), ("2026-06-13", "13th June 2026"),
    ("2026-07-21", "21st July 2026"), ("2026-08-30", "30th August 2026"), (None, None)])
def test_day_label(spark, day, want):
    assert one(spark, c.day_label(F.lit(day).cast("string"))) == want


def test_age_counts_the_birthday(spark):
    assert one(spark, c.age_at(F.lit("2000-06-15"), F.lit("2020-06-14"))) == 19
    assert one(spark, c.age_at(F.lit("2000-06-15"), F.lit("2020-06-15"))) == 20
    edges = ((5, "0-5"), (10, "6-10"))
    assert [one(spark, c.bucket(F.lit(v).cast("int"), edges, ">10")) for v in (0, 5, 6, 10, 11, None)] == [
        "0-5", "0-5", "6-10", "6-10", ">10", "Unknown"]


def test_ratio_and_key(spark):
    assert one(spark, c.safe_ratio(F.lit(1), F.lit(3))) == Decimal("33.3333")
    assert one(spark, c.safe_ratio(F.lit(1), F.lit(0))) is None
    import hashlib
    want = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-2026-01-01").hexdigest()
    assert one(spark, c.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit("2026-01-01").cast("date"))) == want


@pytest.mark.parametrize(("name", "want"), [("Ana da Cruz da Cruz", "Ana da Cruz"), ("Ana Cruz", "Ana Cruz"),
                                            ("Jo Jo", "Jo Jo"), ("Rui  Sa Sa ", "Rui Sa")])
def test_repeated_tail(spark, name, want):
    assert one(spark, c.collapse_repeated_tail(F.lit(name))) == want


def test_codes(spark):
    assert one(spark, c.company_of_branch(F.lit("RE000010_07_CITY"))) == "TL0010007"
    assert one(spark, c.company_of_branch(F.lit("RE000010_CITY"))) is None
    assert one(spark, c.padded_account(F.lit(" 123 "))) == "00000000000123"
    currency, amount = c.currency_amount(F.lit("USD12.5"))
    assert (one(spark, currency), one(spark, amount)) == ("USD", 12.5)
    assert one(spark, c.currency_amount(F.lit("USD"))[1]) is None


@pytest.mark.parametrize(("text", "want"), [
    ("2024-03-05", date(2024, 3, 5)), ("05/03/2024", date(2024, 3, 5)), ("2024-03-05T10:11:12", date(2024, 3, 5)),
    ("0024-03-05", date(2024, 3, 5)), ("03/05/2024 01:02:03 PM", date(2024, 3, 5)), ("5-3-2024", date(2024, 3, 5)),
    ("3/25/24", date(2024, 3, 25)), ("never", date(1900, 1, 1)), (None, date(1900, 1, 1))])
def test_robust_date(spark, text, want):
    assert one(spark, c.robust_date(F.lit(text).cast("string"), fallback=F.lit("1900-01-01").cast("date"))) == want

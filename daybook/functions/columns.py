"""Column functions shared by marts and reports.

Everything here is a composition of built-in Spark functions, so it stays inside whole-stage
code generation. Casts are the ``try_`` kind: dirty bank data must give null, not stop a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
RATIO = "decimal(18,4)"
# Marker that stands for null inside a surrogate key (fixed value of the key format).
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def k(col: Column | str) -> Column:
    """Trimmed string key, the form in which all business keys are compared."""
    return F.trim(_c(col).cast("string"))


def blank_null(col: Column | str) -> Column:
    """Trimmed text, null when blank."""
    return F.nullif(k(col), F.lit(""))


def item(col: Column | str, index: int = 0) -> Column:
    """Multi-value element, null when the array is null or too short."""
    return F.get(_c(col), F.lit(index))


def first_text(*cols: Column | str, blank_is_null: bool = True) -> Column:
    """First non-null text; with ``blank_is_null=False`` a blank value wins over later ones."""
    pick = blank_null if blank_is_null else k
    return F.coalesce(*[pick(c) for c in cols])


def name_concat(*cols: Column | str, sep: str = " ") -> Column:
    """Join the non-blank parts of a name."""
    return F.trim(F.concat_ws(sep, *[blank_null(c) for c in cols]))


def money(col: Column | str) -> Column:
    return _c(col).try_cast(MONEY)


def num_or_null(col: Column | str, dtype: str, pattern: str | None = None) -> Column:
    """Number with thousands separators removed; null when it does not match or does not cast."""
    text = F.replace(k(col), F.lit(","), F.lit(""))
    number = text.try_cast(dtype)
    return number if pattern is None else F.when(text.rlike(pattern), number)


def as_date(col: Column | str) -> Column:
    return _c(col).try_cast("date")


def iso(col: Column | str) -> Column:
    """Date as yyyy-MM-dd text."""
    return as_date(col).cast("string")


def compact_date(col: Column | str) -> Column:
    """Date as yyyyMMdd text, the partition value of the AML reports."""
    return F.date_format(as_date(col), "yyyyMMdd")


def null_of(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def dr_cr(amount: Column, zero: bool = True) -> tuple[Column, Column, Column]:
    """Debit part, credit part and side label of a signed amount.

    ``zero=True`` fills the other side with 0 and counts zero as credit; ``zero=False`` leaves
    the other side null and gives a zero amount to neither.
    """
    amount = money(amount)
    side = F.when(amount < 0, F.lit("Debit")).otherwise(F.lit("Credit"))
    if zero:
        nil = F.lit(0).cast(MONEY)
        return F.when(amount < 0, F.abs(amount)).otherwise(nil), F.when(amount >= 0, amount).otherwise(nil), side
    return F.when(amount < 0, F.abs(amount)), F.when(amount > 0, amount), side


def later(a: Column | str, b: Column | str) -> Column:
    """Later of two dates, ignoring nulls."""
    return F.greatest(as_date(a), as_date(b))


def part(col: Column | str, sep: str, n: int) -> Column:
    """n-th piece (from 1) of a delimited text; empty text when there is no such piece."""
    return F.split_part(_c(col).cast("string"), F.lit(sep), F.lit(n))


def day_label(col: Column | str) -> Column:
    """'1st January 2026'."""
    d = as_date(col)
    n = F.dayofmonth(d)
    suffix = (F.when(n.isin(11, 12, 13), "th").when(n % 10 == 1, "st")
              .when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th"))
    return F.when(d.isNotNull(), F.concat(n.cast("string"), suffix, F.lit(" "), F.date_format(d, "MMMM yyyy")))


def month_label(col: Column | str) -> Column:
    """'January 2026'."""
    return F.date_format(as_date(col), "MMMM yyyy")


def age_at(born: Column | str, as_of: Column | str) -> Column:
    """Whole years at a date; the birthday itself counts."""
    b, d = as_date(born), as_date(as_of)
    before_birthday = F.month(b) * 100 + F.dayofmonth(b) > F.month(d) * 100 + F.dayofmonth(d)
    return F.year(d) - F.year(b) - before_birthday.cast("int")


def bucket(col: Column | str, edges: Sequence[tuple[int, str]], above: str, missing: str = "Unknown") -> Column:
    """Label of the first edge that is not below the value."""
    v = _c(col)
    out = F.when(v.isNull(), F.lit(missing))
    for edge, label in edges:
        out = out.when(v <= edge, F.lit(label))
    return out.otherwise(F.lit(above))


def lookup(col: Column | str, mapping: dict[str, object], default: Column | object = None) -> Column:
    """Small fixed code map as one expression; ``default`` when the code is not in it."""
    v = _c(col)
    out = None
    for code, value in mapping.items():
        out = (F if out is None else out).when(v == F.lit(code), F.lit(value))
    if out is None:
        return default if isinstance(default, Column) else F.lit(default)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def safe_ratio(num: Column, den: Column, scale: int = 100) -> Column:
    """num / den * scale as decimal(18,4); null when the denominator is 0 or null."""
    quotient = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)) * F.lit(float(scale))
    return quotient.try_cast(RATIO)


def surrogate_key(*cols: Column | str) -> Column:
    """md5 over the '-' joined key parts, nulls replaced by a marker."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def padded_account(col: Column | str) -> Column:
    """14-digit account id from a numeric text; null when it is not a number."""
    return F.lpad(k(col).try_cast("bigint").cast("string"), 14, "0")


def company_of_branch(col: Column | str) -> Column:
    """Company code from a branch text like ``RE000010_02_CITY``; null without a branch number."""
    number = F.regexp_extract(_c(col), r"_(\d{2})_", 1)
    return F.when(number != "", F.concat(F.lit("TL001"), F.lpad(number, 4, "0")))


def collapse_repeated_tail(col: Column | str) -> Column:
    """Clean names whose last words are written twice: 'Ana da Cruz da Cruz' -> 'Ana da Cruz'."""
    return F.trim(F.regexp_replace(_c(col), r"^(.*?)\s+(\S+(?:\s+\S+)*)\s+\2\s*$", "$1 $2"))


def currency_amount(col: Column | str) -> tuple[Column, Column]:
    """Split 'USD123.45' into its currency and amount."""
    text = k(col)
    return F.substring(text, 1, 3), F.nullif(F.substring(text, 4, 20), F.lit("")).try_cast("double")


def any_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


# Date layouts seen in branch and channel files; the first that reads the text wins.
PARSE_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSZ", "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy hh:mm:ss a", "M/d/yyyy h:mm:ss a", "dd/MM/yyyy hh:mm:ss a",
    "d/M/yyyy h:mm:ss a", "yyyy-MM-dd HH:mm:ss.S", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss", "M/d/yy  HH:mm", "MM/dd/yy  HH:mm", "M/d/yy HH:mm", "MM/dd/yy HH:mm",
    "d/M/yy HH:mm", "dd/MM/yy HH:mm", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "MM/dd/yyyy",
    "d-M-yyyy", "d/M/yyyy", "M/d/yy", "d/M/yy", "dd/MM/yy", "MM/dd/yy",
)


# Text shape of each layout letter run.
_SHAPES = {"yyyy": r"\d{4}", "yy": r"\d{2}", "MM": r"\d{2}", "M": r"\d{1,2}", "dd": r"\d{2}", "d": r"\d{1,2}",
           "HH": r"\d{2}", "hh": r"\d{2}", "h": r"\d{1,2}", "mm": r"\d{2}", "ss": r"\d{2}", "SSS": r"\d{3}",
           "S": r"\d", "a": "(AM|PM|am|pm)", "Z": r"[+-]\d{4}"}


def _shape(layout: str) -> str:
    """Regular expression of the texts a layout reads."""
    tokens = re.findall(r"'([^']*)'|([A-Za-z])(\2*)|(.)", layout)
    return "^" + "".join(re.escape(quoted) if quoted else _SHAPES[letter + more] if letter else re.escape(other)
                         for quoted, letter, more, other in tokens) + "$"


def robust_date(col: Column | str, formats: Sequence[str] = PARSE_FORMATS, fallback: Column | None = None) -> Column:
    """First layout that reads the text; years below 100 belong to this century.

    A layout is only tried on texts of its shape, which keeps lenient parsing out of the result.
    """
    text = blank_null(col)
    parsed = F.coalesce(*[F.when(text.rlike(_shape(f)), F.to_date(F.try_to_timestamp(text, F.lit(f)))) for f in formats])
    fixed = F.when(F.year(parsed) < 100, F.add_months(parsed, 24000)).otherwise(parsed)
    return fixed if fallback is None else F.coalesce(fixed, fallback)

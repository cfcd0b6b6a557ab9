"""Credit reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook import specs
from daybook.context import Context
from daybook.functions.columns import (MONEY, blank_null, collapse_repeated_tail, day_label, iso, k, lookup, money,
                                       null_of)
from daybook.operators.frames import (global_row_number, history_triplet, pivot_sums, with_rows, with_totals,
                                      year_triplet)

C = F.col
WIDE = "decimal(28,2)"


def _disbursed(ctx: Context) -> DataFrame:
    """Commitments and distinct loans per year, month, branch and product."""
    granted = ctx.mart("lending_arrangements").filter(blank_null("arrangement").isNotNull()) \
        .select(k("arrangement").alias("arr"), "commitment_amt")
    loan = ctx.mart("loan_risk").filter(C("opening_date").isNotNull() & C("category").isNotNull()
                                        & blank_null("loan_id").isNotNull())
    if ctx.report_year is not None:
        loan = loan.filter(F.year("opening_date") == ctx.report_year)
    joined = loan.join(granted, k("arrangement_id") == C("arr"), "left")
    return joined.groupBy(
        F.year("opening_date").alias("report_year"), F.month("opening_date").alias("report_month"),
        C("company_code").alias("co_code"), C("category").cast("string").alias("category_code"),
    ).agg(F.coalesce(F.sum("commitment_amt"), F.lit(0)).cast(WIDE).alias("amount"),
          F.countDistinct("loan_id").alias("loans"))


def _branch_product_grid(years: DataFrame) -> DataFrame:
    grid = with_rows(years, specs.BRANCHES, ("co_code", "Branch", "branch_seq"))
    return with_rows(grid, specs.LOAN_PRODUCTS, ("category_code", "Credit_Product", "Credit_Product_No"))


def _total_mark() -> Column:
    return (C("Credit_Product") == "TOTAL").cast("int").alias("is_total_row")


def disbursement_consolidation(ctx: Context) -> DataFrame:
    """Year x branch x product with a month pivot of amounts and loans, and branch totals."""
    source = _disbursed(ctx)
    by_month = dict(zip(specs.MONTH_TAGS, range(1, 13)))
    amounts = {f"amount_{tag}": n for tag, n in by_month.items()}
    counts = {f"acct_{tag}": n for tag, n in by_month.items()}
    cells = source.groupBy("report_year", "co_code", "category_code").agg(
        *pivot_sums(C("amount"), C("report_month"), amounts, WIDE),
        *pivot_sums(C("loans"), C("report_month"), counts, "bigint"),
        F.sum("amount").cast(WIDE).alias("amount_total"), F.sum("loans").alias("account_total"))
    grid = _branch_product_grid(source.select("report_year").distinct())
    names = [*amounts, *counts, "amount_total", "account_total"]
    rows = grid.join(cells, ["report_year", "co_code", "category_code"], "left").fillna(0, [*counts, "account_total"])
    rows = rows.select("report_year", "branch_seq", "Branch", "Credit_Product_No", "Credit_Product", *[
        F.coalesce(C(n), F.lit(0)).cast(WIDE if n.startswith("amount") else "bigint").alias(n) for n in names])
    sums = {n: WIDE if n.startswith("amount") else "bigint" for n in names}
    rows = with_totals(rows, ["report_year", "branch_seq", "Branch"], sums, {"Credit_Product": "TOTAL"})
    money_names = [n for n in names if n.startswith("amount")]
    rows = rows.withColumns({n: C(n).cast("double") for n in money_names})
    current = rows.select("report_year", "branch_seq", "Branch", "Credit_Product_No", "Credit_Product", _total_mark(),
                          *names, F.lit("CURR").alias("type_period"),
                          C("report_year").cast("string").alias("report_year_label"))
    return year_triplet(current, ctx.history.get("disbursement_consolidation"), ctx.report_year)


def monthly_disbursement(ctx: Context) -> DataFrame:
    """The same in long form by month; targets are not recorded, so their columns stay null."""
    source = _disbursed(ctx)
    grid = _branch_product_grid(source.select("report_year").distinct())
    grid = with_rows(grid, [(n,) for n in range(1, 13)], ("report_month",))
    keys = ["report_year", "report_month", "co_code", "category_code"]
    rows = grid.join(source, keys, "left").select(
        "report_year", "branch_seq", "report_month", "Branch", "Credit_Product_No", "Credit_Product",
        F.coalesce("amount", F.lit(0)).cast(WIDE).alias("total_disbursement"),
        F.coalesce("loans", F.lit(0)).alias("total_clients"))
    rows = with_totals(rows, ["report_year", "branch_seq", "report_month", "Branch"],
                       {"total_disbursement": WIDE, "total_clients": "bigint"}, {"Credit_Product": "TOTAL"})
    month = lookup(C("report_month"), {n: m for n, m in enumerate(specs.MONTHS, 1)})
    current = rows.select(
        "report_year", "branch_seq", "report_month", "Branch", "Credit_Product_No", "Credit_Product", _total_mark(),
        null_of("double").alias("monthly_target"), C("total_disbursement").cast("double").alias("total_disbursement"),
        "total_clients", null_of("double").alias("variance"), null_of("double").alias("pct"),
        F.lit("CURR").alias("type_period"), F.concat_ws(" ", month, C("report_year")).alias("report_period_label"))
    return year_triplet(current, ctx.history.get("monthly_disbursement"), ctx.report_year)


def _sector_balances(ctx: Context) -> DataFrame:
    balance = F.abs(money("loan_outstanding"))
    return ctx.mart("loan_risk").filter((C("currency") == "USD") & (balance > 0)).select(
        F.coalesce("credit_by_sector", F.lit(specs.OTHER_SECTOR)).alias("credit_by_sector"),
        k("auto_class").alias("asset_class"), balance.alias("balance"), "opening_date")


def _sector_report(grid: DataFrame, cells: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    """Every sector of the grid with its cells (0 when missing) and a grand total per load date."""
    grid = with_rows(grid, specs.SECTORS, ("credit_by_sector", "naran_sector"))
    rows = grid.join(cells, [*keys, "credit_by_sector"], "left").select(
        "load_date", "credit_by_sector", "naran_sector",
        *[F.coalesce(C(a), F.lit(0)).cast(MONEY).alias(a) for a in amounts])
    rows = with_totals(rows, ["load_date"], {a: MONEY for a in amounts},
                       {"credit_by_sector": 0, "naran_sector": "Grand Total"})
    return rows.select("*", F.lit("CURR").alias("type_period"), day_label("load_date").alias("load_date_label"))


def loan_sector_daily(ctx: Context) -> DataFrame:
    """Sector x asset class balances of the load date."""
    base = _sector_balances(ctx).withColumn("load_date", F.lit(ctx.load_day))
    cells = base.groupBy("load_date", "credit_by_sector").agg(
        *pivot_sums(C("balance"), C("asset_class"), specs.ASSET_CLASSES, MONEY))
    current = _sector_report(cells.select("load_date").distinct(), cells, ["load_date"], list(specs.ASSET_CLASSES))
    return history_triplet(current, ctx.history.get("loan_sector_daily"), ctx.target_date, "load_date")


def loan_sector_yearly(ctx: Context) -> DataFrame:
    """Sector x opening month: December before the report year, then January to November."""
    base = _sector_balances(ctx).filter(C("opening_date").isNotNull())
    opened = F.month("opening_date")
    # a December loan belongs to the next report year, which turns the either-or join into an equality
    base = base.withColumn("report_year", F.year("opening_date") + (opened == 12).cast("int")).withColumn("m", opened)
    names = {"month_dec_prior": 12, **{f"month_{tag}": n for n, tag in enumerate(specs.MONTH_TAGS[:11], 1)}}
    cells = base.groupBy("report_year", "credit_by_sector").agg(*pivot_sums(C("balance"), C("m"), names, MONEY))
    if ctx.target_date:
        year = int(ctx.target_date[:4])
        years = ctx.spark.range(1).select(F.lit(year).alias("report_year"), F.lit(ctx.target_date).alias("load_date"))
    else:
        years = base.select(F.year("opening_date").alias("report_year")).distinct() \
            .withColumn("load_date", F.concat(C("report_year").cast("string"), F.lit("-12-31")))
    current = _sector_report(years, cells, ["report_year"], list(names))
    return history_triplet(current, ctx.history.get("loan_sector_yearly"), ctx.target_date, "load_date")


def _amount(col: str) -> Column:
    return F.coalesce(C(col).try_cast("double"), F.lit(0.0))


def _has_amount(col: str) -> Column:
    """Present and not literally '' or '0'; '0.00' counts as present."""
    return C(col).isNotNull() & ~k(col).isin("", "0")


def _branch_name(col: str) -> Column:
    return lookup(k(col), specs.BRANCH_NAME, k(col))


def _loans(ctx: Context) -> DataFrame:
    """Loans with a base amount. The mart has one row per loan, so the loan carries its own
    provision and customer columns and needs no join back to itself."""
    return ctx.mart("loan_risk").filter(blank_null("loan_id").isNotNull() & _has_amount("base_amount"))


def provision(ctx: Context) -> DataFrame:
    """Provision per loan by class rate."""
    loans = _loans(ctx)
    if ctx.target_date:
        as_of = F.lit(ctx.target_date).cast("date")
    else:
        as_of = ctx.mart("loan_risk").agg(F.max("last_date_cr")).scalar()
    rate = lookup(blank_null("auto_class"), specs.PROVISION_RATES, 0.0)
    loans = loans.withColumn("as_of", as_of)
    current = loans.select(
        C("loan_id").try_cast("bigint").cast("string").alias("loan_id"), C("loan_id").alias("original_loan_id"),
        "arrangement_id", C("company_code").alias("branch_code"), _branch_name("company_code").alias("branch_name"),
        C("customer_number").alias("cust_number"), collapse_repeated_tail("customer_name").alias("customer_name"),
        blank_null("category").alias("category"), blank_null("product_name").alias("product_name"), "currency",
        blank_null("auto_class").alias("classification"), _amount("loan_outstanding").alias("local_ccy_amt"),
        _amount("base_amount").alias("base_amount"), _amount("loan_outstanding").alias("outstanding"),
        C("opening_date").alias("value_date"), _amount("commitment").alias("commitment"),
        C("opening_date").alias("start_date"), C("maturity_date").alias("mat_date"),
        (F.abs(_amount("base_amount")) * rate).alias("provision"), C("arrangement_status").alias("status"),
        blank_null("mobile_phone").alias("phone_number"), iso("as_of").alias("load_date"),
        F.lit("CURR").alias("type_period"), day_label("as_of").alias("load_date_label"))
    return history_triplet(current, ctx.history.get("provision"), ctx.target_date, "load_date")


def repayment(ctx: Context) -> DataFrame:
    """Loan repayment view."""
    as_of = F.lit(ctx.target_date).cast("date")
    current = _loans(ctx).select(
        "loan_id", C("loan_id").alias("original_loan_id"), C("loan_id").alias("original_id"),
        C("loan_id").try_cast("bigint").cast("string").alias("loan_id2"), blank_null("category").alias("category"),
        blank_null("product_name").alias("product_name"), C("customer_number").alias("cust_number"),
        F.coalesce(blank_null("account_officer"), C("account_officer")).alias("account_officer"),
        C("currency").alias("ccy"), blank_null("auto_class").alias("classification"),
        F.abs(_amount("loan_outstanding")).alias("outstanding"), blank_null("provision_type").alias("prov_type"),
        F.abs(_amount("base_amount")).alias("base_amount"), _amount("commitment").alias("commitment"), "term",
        "maturity_date", _amount("repayment_amount").alias("last_instalment"), C("last_date_cr").alias("last_rep_date"),
        C("opening_date").alias("start_date"), collapse_repeated_tail("customer_name").alias("customer_name"),
        C("company_code").alias("branch_code"), _branch_name("company_code").alias("branch_name"), "arrangement_id",
        "legal_id", iso(as_of).alias("load_date"), F.lit("CURR").alias("type_period"),
        day_label(as_of).alias("load_date_label"))
    return history_triplet(current, ctx.history.get("repayment"), ctx.target_date, "load_date")


def extra_accountable(ctx: Context) -> DataFrame:
    """Written-off loans, numbered by loan. The officer code serves as branch code, as it always has."""
    as_of = F.coalesce(C("load_date"), F.lit(ctx.target_date).cast("date"))
    rows = ctx.mart("written_off_loans").filter(blank_null("account_id").isNotNull() & _has_amount("loan_amount"))
    rows = global_row_number(rows, ["account_id", "arrangement_id"], "nu")
    principal = F.abs(_amount("wof_balance"))
    current = rows.select(
        "nu", collapse_repeated_tail("customer_name").alias("name"), k("cust_id").alias("cif_cid"),
        k("acct_dao").alias("branch"), _branch_name("acct_dao").alias("branch_name"),
        F.coalesce(blank_null("product_desc"), F.lit("")).alias("credit_type"),
        k("account_id").try_cast("bigint").cast("string").alias("loan_id"), k("account_id").alias("original_loan_id"),
        null_of("string").alias("year_of_write_off"), principal.alias("principal"),
        F.lit(0.0).alias("principal_interest"), null_of("double").alias("penalty_interest"),
        principal.alias("balance_principal_interest_penalty"), null_of("double").alias("total_write_off"),
        iso(as_of).alias("load_date"), F.lit("CURR").alias("type_period"), day_label(as_of).alias("load_date_label"))
    return history_triplet(current, ctx.history.get("extra_accountable"), ctx.target_date, "load_date")

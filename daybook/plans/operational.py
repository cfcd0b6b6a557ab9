"""Operational, anti-money-laundering and treasury reports, and the demo pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daybook import specs
from daybook.context import Context
from daybook.functions.columns import (MONEY, age_at, as_date, blank_null, bucket, compact_date, first_text, iso, k,
                                       lookup, money, null_of, surrogate_key)
from daybook.operators.frames import constants, global_row_number, latest, listing, pivot_sums, with_totals

C = F.col
AGE_EDGES = ((5, "0-5"), (10, "6-10"), (14, "11-14"))
AGE_COLUMNS = {"age_0_5": "0-5", "age_6_10": "6-10", "age_11_14": "11-14", "age_over15": ">15"}


def _on_target(ctx: Context, col: str) -> Column:
    if not ctx.target_date:
        return C(col).isNotNull()
    return as_date(col) == F.lit(ctx.target_date).cast("date")


def closed_account_listing(ctx: Context) -> DataFrame:
    """Closed accounts per closing date and branch with totals."""
    rows = ctx.mart("closed_accounts").filter(_on_target(ctx, "close_date")).select(
        iso("close_date").alias("closure_date"), k("id").alias("account_no"), k("branch_code").alias("branch_no"),
        lookup(k("branch_code"), specs.BRANCH_NAME, k("branch_code")).alias("branch_name"),
        k("customer").alias("customer_id"), blank_null("acct_title").alias("cust_name"),
        null_of("string").alias("id_doc_type"), null_of("string").alias("id_doc_no"),
        F.lit(1).cast(MONEY).alias("row_count"))
    return listing(rows, ["closure_date", "branch_no"], "account_no", {"row_count": MONEY}, hot=ctx.hot)


def opened_account_listing(ctx: Context) -> DataFrame:
    """Opened savings accounts per opening date and branch with totals."""
    gap = null_of("string")
    name = F.trim(F.concat_ws(" ", *[F.coalesce(k(c), F.lit("")) for c in ("name1", "name2", "short_name")]))
    rows = ctx.mart("acct_cust").filter(_on_target(ctx, "opening_date")).select(
        iso("opening_date").alias("opening_date"), k("company").alias("company_branch"),
        k("account_number").alias("account_no"), k("company").alias("branch_no"), gap.alias("branch_name"),
        k("customer_no").alias("customer_id"), name.alias("cust_name"), k("legal_doc_name").alias("id_doc_type"),
        k("legal_id").alias("id_doc_no"), gap.alias("alter_id_type"), gap.alias("alter_id_no"), gap.alias("pep"),
        iso("date_of_birth").alias("dob"), k("nationality").alias("nationality"), k("birth_country").alias("birth_country"),
        "address", k("occupation").alias("occupation"), money("balance").alias("acct_bal"),
        F.lit(0).cast(MONEY).alias("first_deposit_amt"))
    return listing(rows, ["opening_date", "company_branch"], "account_no",
                   {"acct_bal": MONEY, "first_deposit_amt": MONEY}, hot=ctx.hot)


def deposit_listing(ctx: Context) -> DataFrame:
    """Deposit accounts per branch with product label and totals."""
    code = C("category").cast("string")
    rows = ctx.mart("acct_cust").filter(code.isin(*specs.DEPOSIT_PRODUCTS)).select(
        F.lit(ctx.target_date).cast("date").alias("process_date"), C("company").alias("company_branch"),
        C("account_number").alias("account_no"), code.alias("prodcat"),
        lookup(code, specs.DEPOSIT_PRODUCTS, "Unknown").alias("prod_name"), C("customer_no").alias("customer_id"),
        C("short_name").alias("cust_name"), iso("opening_date").alias("opening_date"),
        null_of("string").alias("maturity_date"), iso("date_of_birth").alias("dob"), money("balance").alias("acct_bal"))
    return listing(rows, ["process_date", "company_branch"], "account_no", {"acct_bal": MONEY}, hot=ctx.hot)


def _futuru(ctx: Context) -> DataFrame:
    """Funded accounts of savings category 6006 with their municipality."""
    return ctx.mart("acct_cust").filter((C("category") == 6006) & (C("balance") > 0)).withColumn(
        "municipal", lookup(k("company"), specs.BRANCH_MUNICIPALITY, k("company")))


def _municipal_rows(ctx: Context, cells: DataFrame, amounts: dict[str, str]) -> DataFrame:
    """Every municipality in order (0 when it has none) and a total row."""
    grid = constants(ctx.spark, specs.MUNICIPALITIES, ("sort_order", "municipal"))
    rows = grid.join(cells, "municipal", "left").select(
        F.lit(ctx.load_day).alias("load_date"), "sort_order", "municipal",
        *[F.coalesce(C(n), F.lit(0)).cast(t).alias(n) for n, t in amounts.items()])
    return with_totals(rows, ["load_date"], amounts, {"sort_order": 99, "municipal": "TOTAL"})


def savers_by_age(ctx: Context) -> DataFrame:
    """Municipality x age group counts and balances."""
    group = bucket(age_at("date_of_birth", F.lit(ctx.load_day)), AGE_EDGES, ">15")
    source = _futuru(ctx).withColumn("age_group", group).filter(C("age_group") != "Unknown")
    counts = {f"{n}_count": v for n, v in AGE_COLUMNS.items()}
    sums = {f"{n}_amount": v for n, v in AGE_COLUMNS.items()}
    cells = source.groupBy("municipal").agg(
        *pivot_sums(F.when(C("account_number").isNotNull(), 1).otherwise(0), C("age_group"), counts, "int"),
        *pivot_sums(C("balance"), C("age_group"), sums, MONEY))
    rows = _municipal_rows(ctx, cells, {**{n: "int" for n in counts}, **{n: MONEY for n in sums}})
    zero, nil = F.lit(0).cast("int"), F.lit(0).cast(MONEY)
    return rows.select("*", zero.alias("inactive_count"), nil.alias("inactive_amount"), zero.alias("closed_count"),
                       nil.alias("closed_amount"))


def savers_by_gender(ctx: Context) -> DataFrame:
    """Municipality x gender, accounts opened in the month so far, and the (empty) closing rows."""
    source = _futuru(ctx).withColumn("sex", F.upper(k("gender")))
    sexes = {"male": "MALE", "female": "FEMALE"}
    columns = {}
    for tag in sexes:
        columns |= {f"{tag}_count": "int", f"{tag}_amount": MONEY}
    cells = [*pivot_sums(F.when(C("account_number").isNotNull(), 1).otherwise(0), C("sex"),
                         {f"{t}_count": v for t, v in sexes.items()}, "int"),
             *pivot_sums(C("balance"), C("sex"), {f"{t}_amount": v for t, v in sexes.items()}, MONEY)]
    main = _municipal_rows(ctx, source.groupBy("municipal").agg(*cells), columns).withColumn("row_type", F.lit("MAIN"))
    opened = C("opening_date").isNotNull()
    if ctx.target_date:
        day = F.lit(ctx.target_date).cast("date")
        opened = opened & C("opening_date").between(F.trunc(day, "month"), day)
    change = source.filter(opened).agg(*cells)
    change = change.select(
        F.lit(ctx.load_day).alias("load_date"), F.lit(0).alias("sort_order"), F.lit("Changes in the Period").alias("municipal"),
        *[F.coalesce(C(n), F.lit(0)).cast(t).alias(n) for n, t in columns.items()], F.lit("NEW_ACCOUNTS").alias("row_type"))
    closed = constants(ctx.spark, [("CLOSED_TOTAL",), ("CLOSED_AGE_LIMIT",), ("CLOSED_OTHER",)], ("row_type",))
    closed = closed.select(
        F.lit(ctx.load_day).alias("load_date"), F.lit(0).alias("sort_order"), F.lit("Changes in the Period").alias("municipal"),
        *[F.lit(0).cast(t).alias(n) for n, t in columns.items()], "row_type")
    rows = main.unionByName(change).unionByName(closed)
    return rows.select("load_date", "row_type", "sort_order", "municipal", *columns,
                       (C("male_count") + C("female_count")).cast("int").alias("total_count"),
                       (C("male_amount") + C("female_amount")).cast(MONEY).alias("total_amount"))


def contact_listing(ctx: Context) -> DataFrame:
    """Savings customers' contacts, numbered by name."""
    base = ctx.mart("acct_cust").filter(~F.coalesce(k("account_number"), F.lit("")).isin("", "null")).select(
        first_text("name1", "short_name").alias("name"), k("account_number").alias("account_number"),
        k("customer_no").alias("customer_number"), iso("opening_date").alias("registered_date"),
        blank_null("email").alias("email"), blank_null("sms").alias("contact_number"), null_of("string").alias("obs"),
        k("company").alias("branch_code"),
        lookup(k("company"), specs.BRANCH_MUNICIPALITY, k("company")).alias("municipal"),
        C("category").cast("string").alias("product_code"))
    base = base.withColumn("unnamed", C("name").isNull())  # nameless rows come last
    rows = global_row_number(base, ["unnamed", "name", "account_number"], "nu").drop("unnamed")
    return rows.select(F.lit(ctx.load_day).alias("load_date"), C("nu").cast("int").alias("nu"),
                       *[c for c in rows.columns if c != "nu"])


def _text(**cols: str) -> list[Column]:
    return [k(source).alias(name) for name, source in cols.items()]


def large_txn_report(ctx: Context) -> DataFrame:
    """Entries of accounts whose dollar entries of one day reach the threshold."""
    usd = ctx.mart("large_daily_txn").filter(C("transaction_currency") == "USD")
    totals = usd.groupBy(C("account_id").alias("a"), C("operation_date").alias("d")).agg(F.sum(F.abs("amount")).alias("t"))
    large = totals.filter(C("t") >= specs.LARGE_TXN_TOTAL)
    rows = usd.join(large, (C("account_id") == C("a")) & (C("operation_date") == C("d")), "left_semi")
    return rows.filter(C("debit_credit_indicator").isNotNull()).select(
        surrogate_key("account_id", "operation_date", "transaction_id").alias("report_id"),
        iso("operation_date").alias("txn_date"), *_text(acc_number="account_id", acc_name="acct_name"),
        F.trim(F.coalesce(blank_null("txn_desc"), C("application_id"))).alias("type_of_tranzation"),
        C("amount").cast("double").alias("amount"), k("branch_name").alias("branch"), "dir0")


def inactive_account_report(ctx: Context) -> DataFrame:
    rows = ctx.mart("inactive_accounts").filter(C("inactive_marker").isin("Y", "true"))
    return rows.select(
        surrogate_key("account_id", "dir0").alias("report_id"),
        *_text(branch_name="branch_name", account_number="account_id", customer_number="customer_id",
               customer_name="customer_full_name", account_ccy="account_currency"),
        iso("last_transaction_date").alias("last_txn_date"), C("working_balance").cast("double").alias("acc_balance"),
        iso("opening_date").alias("acc_open_date"), "dir0")


def missing_document_report(ctx: Context) -> DataFrame:
    return ctx.mart("missing_documents").select(
        surrogate_key("customer_id", "account_id", "dir0").alias("report_id"),
        *_text(branch_name="branch_name", customer_number="customer_id", account_number="account_id",
               customer_name="customer_full_name"),
        iso("birth_or_incorp_date").alias("date_of_birth"), iso("opening_date").alias("acc_open_date"),
        *_text(id_doc_type="legal_doc_type", id_doc_number="legal_id"),
        iso("legal_doc_expiry_date").alias("expired_date_doc"), "dir0")


def opened_account_report(ctx: Context) -> DataFrame:
    return ctx.mart("opened_accounts").select(
        surrogate_key("acct_no", "cus_no", "open_acct_date").alias("report_id"),
        *_text(branch_number="branch_no", branch_name="branch_name", account_number="acct_no", customer_number="cus_no",
               customer_name="cus_name"),
        iso("open_acct_date").alias("opening_date"),
        *_text(id_doc_type="ident_doc_type", id_doc_number="ident_doc_no", alter_id_type="alter_id_type",
               alter_id_number="alter_id_no", pep="pep"),
        iso("dob").alias("dob"), *_text(nationality="nationality", birth_country="birth_country", address="address",
                                        occupation="occupation"),
        C("acct_bal").cast("double").alias("account_balance"),
        C("first_deposit_amt").cast("double").alias("first_deposit_amount"), compact_date("open_acct_date").alias("dir0"))


# Display column, mart column.
REMITTANCE_COLUMNS = (
    ("NO", "row_no"), ("DATE TRANSFER", "date_transfer"), ("TRANSACTION REF", "transaction_ref"),
    ("REF NUMBER", "ref_number"), ("ORDERING CUSTOMER", "ordering_customer"),
    ("ORDERING CUSTOMER ACC NO", "ordering_customer_acc_no"), ("SENDER BIC", "sender_bic"),
    ("ORIGIN OF COUNTRY", "origin_of_country"), ("DEBIT ACCOUNT", "debit_account"), ("BENEFICIARY", "beneficiary"),
    ("GENDER", "gender"), ("CREDIT ACCOUNT", "credit_account"), ("DEBIT CCY", "debit_ccy"),
    ("DEBIT AMOUNT", "debit_amount"), ("CHARGE CCY", "charge_ccy"), ("CHARGES", "charges"), ("CREDIT CCY", "credit_ccy"),
    ("CREDIT AMOUNT", "credit_amount"), ("RATE", "rate"), ("REMARK", "remark"),
    ("REMITTANCE INFORMATION", "remittance_information"), ("report_date", "value_date"),
)


def remittance_daily(ctx: Context) -> DataFrame:
    rows = ctx.mart("inward_remittance")
    if ctx.target_date:
        rows = rows.filter(C("date_transfer") == F.lit(ctx.target_date).cast("date"))
    return rows.select(*[C(source).alias(shown) for shown, source in REMITTANCE_COLUMNS])


def remittance_quarterly(ctx: Context) -> DataFrame:
    """Twelve months of the report year with transfers, value and fees, and a total row."""
    year = ctx.report_year or int((ctx.target_date or ctx.business_date)[:4])
    actual = ctx.mart("inward_remittance").filter(F.year("date_transfer") == year) \
        .groupBy(F.month("date_transfer").alias("n")).agg(
            F.countDistinct("transaction_ref").alias("SWIFT Number"),
            F.sum(money("credit_amount")).alias("Value (USD)"), F.sum(money("charges")).alias("Fees"))
    months = constants(ctx.spark, [(n, m) for n, m in enumerate(specs.MONTHS, 1)], ("n", "Month"))
    sums = {"SWIFT Number": "bigint", "Value (USD)": "decimal(28,2)", "Fees": "decimal(28,2)"}
    rows = months.join(actual, "n", "left").select(F.lit(1).alias("one"), "Month", *[
        F.coalesce(C(f"`{c}`"), F.lit(0)).cast(t).alias(c) for c, t in sums.items()])
    total = rows.groupBy("one").agg(*[F.sum(C(f"`{c}`")).cast(t).alias(c) for c, t in sums.items()])
    rows = rows.unionByName(total.withColumn("Month", F.lit("TOTAL")))
    return rows.select("Month", C("`SWIFT Number`"), *[C(f"`{c}`").cast("double").alias(c) for c in ("Value (USD)", "Fees")])


def deposits_by_sector(ctx: Context) -> DataFrame:
    """Deposits by customer sector across the three kinds of feeds."""
    deposit = ctx.read("crb_deposits", None).filter(C("load_date") == ctx.day).select("account_number", money("local_ccy_amt").alias("amt"))
    account = ctx.dim("account").select(C("recid").alias("account_number"), C("customer").alias("customer_id"))
    customer = latest(ctx.dim("customer"), [C("recid")], [C("curr_no")], {"sector_code": C("sector")}, ["customer_id"])
    sector = latest(ctx.pull("sector"), [C("recid")], [C("curr_no")], {"sector_name": C("description")}, ["sector_code"])
    joined = deposit.join(account, "account_number").join(customer, "customer_id").join(sector, "sector_code")
    return joined.groupBy("sector_code", "sector_name").agg(
        F.sum("amt").cast("decimal(28,2)").alias("total_deposit_local"), F.countDistinct("account_number").alias("n_accounts"),
        F.countDistinct("customer_id").alias("n_customers")).withColumn("business_date", ctx.day)


def batch_marker(ctx: Context, record: str = "BNK/DW.EXTRACT.EOD") -> DataFrame:
    """Batch control record together with the snapshot it was read at."""
    return ctx.dim("batch").filter(C("recid") == record).select(
        "recid", "last_run_date", "job_status", F.lit(ctx.business_date).alias("business_date"),
        F.lit(str(ctx.pins.get("batch"))).alias("pinned_snapshot"))

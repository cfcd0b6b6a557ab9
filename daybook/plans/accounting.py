"""Accounting: from trial balance lines to branch reports, statements, ratios and the regulator's return.

Layouts, group maps and leaf maps are seed tables the user loads (see README); the rules that turn
them into figures are here. After the first aggregation of ledger lines every frame is a few
hundred rows per branch and day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.context import Context
from daybook.functions.columns import MONEY, any_of, day_label, k, lookup, money, month_label, null_of, safe_ratio
from daybook.operators.frames import between, long_rows, null_safe_join, range_subtotals, with_rows

C = F.col
WIDE = "decimal(28,2)"
EXCLUDED_BRANCH = "ATAURO"

# Branches that report investment and base capital.
CENTRAL_BRANCHES = ("Head Office", "RE000010_03_SUKURSAL_GLENO")

# Ledger line shown under another line in the branch reports.
ASSET_LINES = {"2850": "2830", "2855": "2845", "2860": "2847", "2865": "2848", "3147": "3130", "3142": "3148",
               "3150": "3146"}
LIABILITY_LINES = dict.fromkeys(("5321", "5327", "5324", "5325", "5341", "5342", "6660", "7160", "5323", "5343",
                                 "5326", "5328"), "5320")

# Classes of loans counted under each loan group.
CLASSES_OF_GROUP = {"CURRENT_LOAN": ("STANDARD", "UNDER-SUPERVISION"),
                    "PAST_DUE": ("DOUBTFUL", "SUB-STANDARD", "LOSS")}

# Branch mnemonic in deposit reports, company code.
DEPOSIT_BRANCHES = {
    "BNK": "TL0010001", "DIL": "TL0010002", "GLN": "TL0010003", "MAL": "TL0010004", "ALU": "TL0010005",
    "OCS": "TL0010006", "BCU": "TL0010007", "SAM": "TL0010008", "ANR": "TL0010009", "SUA": "TL0010010",
    "VQQ": "TL0010011", "LSP": "TL0010012", "LQC": "TL0010013", "MTT": "TL0010014",
}
DEPOSIT_TOTAL_LINES = ("4360", "4430", "4540")

_DUE = ("CALL_DEPOSITS", "OTHERS_DOMESTIC")
_BANKS = (*_DUE, "FOREIGN_CURRENCY")
_LIQUID = ("LIQUID_FUNDS", *_BANKS)
_LOANS = ("CURRENT_LOAN", "PAST_DUE", "PROVISION")
_FIXED = ("FIXED_ASSETS", "RESERVE_DEPR")
_OTHER = ("OTHER_ASSETS", "OFFICE_ACCOUNTS", "ASSET_HELD_DEBT", "MISC_ASSETS")
_ALL_ASSETS = (*_LIQUID, *_LOANS, "ACC_RECEIVABLE", *_FIXED, *_OTHER)

# Summary row, label, groups added up (the last row adds one group for central branches only).
ASSET_SUMMARY = (
    (1, "LIQUID FUNDS (SUM)", _LIQUID), (2, "DuefromCom.Banks (SUM)", _BANKS), (3, "DomesticCurrency", _DUE),
    (4, "CallDeposits (SUM)", ("CALL_DEPOSITS",)), (5, "Other (SUM)", ("OTHERS_DOMESTIC",)),
    (6, "ForeignCurrency (SUM)", ("FOREIGN_CURRENCY",)), (7, "INVESTMENT (SUM)", ("INVESTMENT",)),
    (8, "LOAN,ADV.&DISC. (SUM)", _LOANS), (9, "CURRENTLOAN (SUM)", ("CURRENT_LOAN",)),
    (10, "PASTDUELOANS (SUM)", ("PAST_DUE",)), (11, "PROV.FORL.LOSSES (SUM)", ("PROVISION",)),
    (12, "ACC.RECEIVABLE (SUM)", ("ACC_RECEIVABLE",)), (13, "FIXEDASSETS (SUM)", _FIXED),
    (14, "RESERVEFORDEPREC. (SUM)", ("RESERVE_DEPR",)), (15, "OTHERASSETS (SUM)", _OTHER),
    (16, "OfficeAccounts (SUM)", ("OFFICE_ACCOUNTS",)), (17, "AssetHeldInRes.ofDebt (SUM)", ("ASSET_HELD_DEBT",)),
    (18, "MiscellaneousAssets (SUM)", ("MISC_ASSETS",)), (19, "Total Assets (SUM)", _ALL_ASSETS),
)

_DEPOSITS = ("DEMAND_DEPOSIT", "TIME_DEPOSIT", "PASSBOOK_SAVING")
_UNEARNED = ("UNEARNED_BASE", "LOAN_FEE_ADV")
_SUNDRY = ("SUNDRY_OTHERS", "INTEREST_ACCRUED", "RESTRICTED_DEPOSIT", *_UNEARNED)
_CAPITAL = ("PROVISIONING", "CAPITAL_BASE", "PNL")

# Summary row, label, groups of the amount, groups of the account count.
LIABILITY_SUMMARY = (
    (1, "DEPOSITS (SUM)", _DEPOSITS, _DEPOSITS), (2, "DemandDeposit (SUM)", ("DEMAND_DEPOSIT",), ("DEMAND_DEPOSIT",)),
    (3, "TimeDeposits (SUM)", ("TIME_DEPOSIT",), ("TIME_DEPOSIT",)),
    (4, "Other(PassbookSaving) (SUM)", ("PASSBOOK_SAVING",), ("PASSBOOK_SAVING",)),
    (5, "OtherSundryCurrentLiabilit. (SUM)", _SUNDRY, ()), (6, "InterestAccrued (SUM)", ("INTEREST_ACCRUED",), ()),
    (7, "RESTRICTEDDEPOSIT (SUM)", ("RESTRICTED_DEPOSIT",), ()),
    (8, "UnearnedInterest (SUM)", _UNEARNED, ("LOAN_FEE_ADV",)),
    (9, "LoanCollec.FeeinAdvance (SUM)", ("LOAN_FEE_ADV",), ("LOAN_FEE_ADV",)),
    (10, "OtherLiabilit/DueToBranch (SUM)", ("DUE_TO_BRANCH",), ()), (11, "CAPITALACCOUNTS: (SUM)", _CAPITAL, _CAPITAL),
    (12, "Profits/Losses (SUM)", ("PNL",), ("PNL",)),
    (13, "TotalLiabilities&Capital (SUM)", (*_DEPOSITS, *_SUNDRY, "DUE_TO_BRANCH", "PROVISIONING", "PNL"),
     (*_DEPOSITS, "LOAN_FEE_ADV", *_CAPITAL)),
)


def _ledger(ctx: Context, statement: str) -> DataFrame:
    return ctx.mart("trial_balance_detail").filter((C("load_date") == ctx.day) & (C("statement_type") == statement))


def _group_map(ctx: Context, seed: str) -> DataFrame:
    return ctx.dim(seed).select(k("account_code").alias("line"), "account_name", "parent_group")


def _layout(ctx: Context, seed: str) -> DataFrame:
    return ctx.dim(seed).select(C("order_id").cast("int").alias("order_id"), C("code").cast("string").alias("code"),
                                "description", C("line").cast("string").alias("line"),
                                C("stt_noline").cast("int").alias("stt_noline"))


def _times(spine: DataFrame, layout: DataFrame) -> DataFrame:
    """Every spine row with every row of a report layout. The layout is one array value, so this
    needs neither a cross join nor a shuffle."""
    rows = layout.agg(F.array_sort(F.collect_set(F.struct(*layout.columns)))).scalar()
    return spine.withColumn("_layout", rows).select("*", F.inline("_layout")).drop("_layout")


def loan_counts(ctx: Context) -> DataFrame:
    """Distinct loans per branch and ledger line, by the products seen under the line."""
    groups = _group_map(ctx, "map_total_assets").filter(C("parent_group").isin(*CLASSES_OF_GROUP))
    detail = _ledger(ctx, "GL").filter(C("original_line").isNull() & C("product_key").isNotNull() & C("co_code").isNotNull())
    products = detail.select("load_date", "branch_name", "co_code", C("parent_line").alias("line"), "product_key") \
        .distinct().join(groups, "line")
    # the class decides the loan group, so the either-or condition becomes part of the join key
    group = lookup(C("auto_class"), {c: g for g, classes in CLASSES_OF_GROUP.items() for c in classes})
    loans = ctx.mart("loan_risk").select(C("company_code").alias("co_code"), C("category").cast("string").alias("product_key"),
                                         group.alias("parent_group"), "loan_id")
    return products.join(loans, ["co_code", "product_key", "parent_group"]).groupBy("load_date", "branch_name", "line") \
        .agg(F.countDistinct("loan_id").alias("total_accounts"))


def deposit_counts(ctx: Context) -> DataFrame:
    """Distinct deposit accounts per company and ledger line."""
    rows = ctx.pull("deposit_report").filter(
        C("deposit_type").isin("demand", "time", "passbook") & ~C("gl_line").cast("string").isin(*DEPOSIT_TOTAL_LINES))
    rows = rows.select(C("business_date").alias("load_date"), lookup(C("branch_name"), DEPOSIT_BRANCHES).alias("co_code"),
                       C("gl_line").cast("string").alias("line"), "account_number").filter(C("co_code").isNotNull())
    return rows.groupBy("load_date", "co_code", "line").agg(F.countDistinct("account_number").alias("total_accounts"))


def _branch_companies(ctx: Context) -> DataFrame:
    return ctx.mart("trial_balance_detail").filter(C("co_code").isNotNull() & (C("load_date") == ctx.day)) \
        .select("branch_name", "co_code").distinct()


def _deposit_counts_by_branch(ctx: Context) -> DataFrame:
    return ctx.mart("deposit_counts").join(_branch_companies(ctx), "co_code") \
        .select("load_date", "branch_name", "line", "total_accounts")


def _summary(ctx: Context, seed: str, counts: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """Summary rows per branch: amounts and counts are stacked and added up in one aggregation."""
    groups = _group_map(ctx, seed).select("line", "parent_group")
    amounts = _ledger(ctx, "GL").filter(C("original_line").isNotNull()).select(
        "load_date", "branch_name", C("original_line").alias("line"), money("closing_balance").alias("amt"),
        F.lit(0).cast("bigint").alias("acc"))
    stacked = amounts.unionByName(counts.select("load_date", "branch_name", "line", F.lit(0).cast(MONEY).alias("amt"),
                                                C("total_accounts").alias("acc")))

    def add(value: str, groups_of_row: Sequence[str], extra: Sequence[str], nil: Column) -> Column:
        inside = C("parent_group").isin(*groups_of_row) if groups_of_row else F.lit(False)
        if extra:
            inside = inside | (C("branch_name").isin(*CENTRAL_BRANCHES) & C("parent_group").isin(*extra))
        return F.sum(F.when(inside, C(value)).otherwise(nil))

    sums = []
    for stt, _, of_amount, of_count, extra_amount, extra_count in rows:
        sums.append(F.coalesce(add("amt", of_amount, extra_amount, F.lit(0).cast(MONEY)), F.lit(0)).cast(WIDE).alias(f"a{stt}"))
        sums.append(add("acc", of_count, extra_count, F.lit(0)).cast("bigint").alias(f"n{stt}"))
    wide = stacked.join(groups, "line").groupBy("load_date", "branch_name").agg(*sums)
    cells = F.array(*[F.struct(F.lit(r[0]).alias("stt"), F.lit(r[1]).alias("description"), C(f"a{r[0]}").alias("amount"),
                               C(f"n{r[0]}").alias("total_accounts")) for r in rows])
    return wide.select("load_date", "branch_name", F.inline(cells))


def asset_summary(ctx: Context) -> DataFrame:
    """19 asset summary rows per branch."""
    rows = [(stt, text, groups, groups, ("INVESTMENT",) if stt == 19 else (), ("INVESTMENT",) if stt == 19 else ())
            for stt, text, groups in ASSET_SUMMARY]
    return _summary(ctx, "map_total_assets", ctx.mart("loan_counts"), rows)


def liability_summary(ctx: Context) -> DataFrame:
    """13 liability and capital summary rows per branch."""
    rows = [(stt, text, amount, count, ("CAPITAL_BASE",) if stt == 13 else (), ())
            for stt, text, amount, count in LIABILITY_SUMMARY]
    return _summary(ctx, "map_total_liabilities", _deposit_counts_by_branch(ctx), rows)


def _profit_lines(ctx: Context, seed: str) -> DataFrame:
    sums = _ledger(ctx, "PL").groupBy("load_date", "branch_name", C("original_line").alias("account_code")).agg(
        F.sum(money("closing_balance")).cast(MONEY).alias("closing_balance"))
    names = _group_map(ctx, seed)
    return sums.join(names, C("account_code") == C("line"), "left").select(
        "load_date", "branch_name", "account_code", "account_name", "parent_group", "closing_balance")


def income_lines(ctx: Context) -> DataFrame:
    return _profit_lines(ctx, "map_total_income")


def expense_lines(ctx: Context) -> DataFrame:
    """As income lines; head office carries no amount on line 1890."""
    waived = (C("branch_name") == "Head Office") & (C("account_code") == "1890")
    return _profit_lines(ctx, "map_total_expense").withColumn(
        "closing_balance", F.when(waived, F.lit(0).cast(MONEY)).otherwise(C("closing_balance")))


def _branch_report(ctx: Context, seed: str, remap: Mapping[str, str], counts: DataFrame, summary: DataFrame,
                   residual_row: int, plus: Column, minus: Sequence[Column]) -> DataFrame:
    """Report layout per branch; one row is overwritten by the difference it has to explain."""
    def shown(col: str) -> Column:
        return lookup(C(col), remap, C(col))

    keys = ["load_date", "branch_name", "line"]
    amounts = _ledger(ctx, "GL").filter(C("original_line").isNotNull()).groupBy(
        "load_date", "branch_name", shown("original_line").alias("line")).agg(F.sum(money("closing_balance")).alias("amt"))
    spine = amounts.select("load_date", "branch_name").distinct()
    accounts = counts.groupBy("load_date", "branch_name", shown("line").alias("line")).agg(F.sum("total_accounts").alias("acc"))
    totals = summary.select("load_date", "branch_name", C("stt").alias("stt_noline"), C("amount").alias("total_amt"),
                            C("total_accounts").alias("total_acc"))
    rows = _times(spine, _layout(ctx, seed)).join(amounts, keys, "left").join(accounts, keys, "left") \
        .join(totals, ["load_date", "branch_name", "stt_noline"], "left")
    is_line = C("line").isNotNull()
    rows = rows.withColumn("amount", F.coalesce(F.when(is_line, C("amt")).otherwise(C("total_amt")), F.lit(0)).cast(WIDE))
    rows = rows.withColumn("total_accounts", F.coalesce(F.when(is_line, C("acc")).otherwise(C("total_acc")), F.lit(0)))
    branch = Window.partitionBy("load_date", "branch_name")  # one layout: a few hundred rows

    def picked(which: Column) -> Column:
        return F.max(F.when(which, C("amount")).otherwise(F.lit(0))).over(branch)

    gap = picked(plus)
    for part in minus:
        gap = gap - picked(part)
    return rows.select("load_date", "branch_name", "order_id", "code", "description",
                       F.when(C("order_id") == residual_row, gap).otherwise(C("amount")).cast(WIDE).alias("amount"),
                       "total_accounts", day_label("load_date").alias("load_date_label"))


def assets_report(ctx: Context) -> DataFrame:
    return _branch_report(ctx, "map_detail_assets", ASSET_LINES, ctx.mart("loan_counts"), ctx.mart("asset_summary"),
                          126, C("line") == "3865", [C("stt_noline") == 19])


def liabilities_report(ctx: Context) -> DataFrame:
    return _branch_report(ctx, "map_detail_liabilities", LIABILITY_LINES, _deposit_counts_by_branch(ctx),
                          ctx.mart("liability_summary"), 82, C("stt_noline") == 13,
                          [C("line") == "7240", C("line") == "7045"])


def _profit_report(ctx: Context, seed: str, lines: DataFrame) -> DataFrame:
    """Report layout per branch; lines without bookings are 0, subtotal rows stay null."""
    spine = _ledger(ctx, "PL").select("load_date", "branch_name").distinct()
    amounts = lines.select("load_date", "branch_name", C("account_code").alias("line"), "closing_balance")
    rows = _times(spine, _layout(ctx, seed)).join(amounts, ["load_date", "branch_name", "line"], "left")
    amount = F.when(C("line").isNotNull(), F.coalesce("closing_balance", F.lit(0))).cast(MONEY)
    return rows.select("load_date", "branch_name", "order_id", "code", "description", "line", "stt_noline",
                       amount.alias("amount"), day_label("load_date").alias("load_date_label"))


def income_report(ctx: Context) -> DataFrame:
    return _profit_report(ctx, "map_detail_income", ctx.mart("income_lines"))


def expense_report(ctx: Context) -> DataFrame:
    return _profit_report(ctx, "map_detail_expense", ctx.mart("expense_lines"))


def _compared_periods(ctx: Context, report: DataFrame) -> DataFrame:
    """Month figures next to the month before and the same month a year before.

    Each month's total is handed to the three report months it takes part in, so the comparison is
    one aggregation instead of a range join and a window.
    """
    month = F.trunc(C("load_date").cast("date"), "month")
    monthly = report.groupBy("order_id", "description", month.alias("month")).agg(
        F.sum("amount").alias("amount"), F.sum("total_accounts").alias("accts"))
    months = monthly.select("month")
    if ctx.target_date:
        months = months.filter(C("month") == F.trunc(F.lit(ctx.target_date).cast("date"), "month"))
    month_list = months.agg(F.array_sort(F.collect_set("month"))).scalar()
    spine = report.select("order_id", "description").distinct().withColumn("_m", month_list) \
        .select("order_id", "description", F.explode("_m").alias("start"))
    shifts = F.array(*[F.struct(F.add_months("month", n).alias("start"), F.lit(tag).alias("tag"))
                       for n, tag in ((0, "c"), (1, "p"), (12, "y"))])
    shifted = monthly.select("order_id", "description", "amount", "accts", F.inline(shifts))
    cells = shifted.groupBy("order_id", "description", "start").agg(*[
        F.sum(F.when(C("tag") == t, C(v))).alias(f"{v}_{t}") for t in "cpy" for v in ("amount", "accts")])
    rows = spine.join(cells, ["order_id", "description", "start"], "left").select("order_id", "description", "start", *[
        F.coalesce(C(f"{v}_{t}"), F.lit(0)).cast(WIDE if v == "amount" else "bigint").alias(f"{v}_{t}")
        for t in "cpy" for v in ("amount", "accts")])

    def cell(tag: str, now: str, before: str | None) -> Column:
        amount = C(f"amount_{now}")
        if before is None:
            step, pct = null_of(WIDE), null_of("double")
        else:
            base = C(f"amount_{before}")
            step = (amount - base).cast(WIDE)
            pct = step.cast("double") / F.nullif(base.cast("double"), F.lit(0.0))
        return F.struct(F.lit(tag).alias("type_period"), C(f"accts_{now}").alias("accts"), amount.alias("amount"),
                        step.alias("increase_prev_period"), pct.alias("pct_change_prev_period"))

    long = rows.select("order_id", "description", "start", F.inline(F.array(
        cell("YOY", "y", None), cell("PREV", "p", "y"), cell("CURR", "c", "p"))))
    codes = report.select(C("order_id").alias("o"), C("description").alias("d"), "code").distinct()
    return long.join(codes, (C("order_id") == C("o")) & (C("description") == C("d")), "left").select(
        F.date_format("start", "yyyy-MM").alias("report_month"), "code", "order_id", "description", "type_period", "accts",
        "amount", "increase_prev_period", "pct_change_prev_period", month_label("start").alias("report_month_label"))


def assets_compared(ctx: Context) -> DataFrame:
    return _compared_periods(ctx, ctx.mart("assets_report"))


def liabilities_compared(ctx: Context) -> DataFrame:
    return _compared_periods(ctx, ctx.mart("liabilities_report"))


def _month_label(col: str = "report_month") -> Column:
    return month_label(F.concat(C(col), F.lit("-01")))


def _of_target_month(ctx: Context, df: DataFrame) -> DataFrame:
    return df.filter(C("report_month") == ctx.target_date[:7]) if ctx.target_date else df


# Return code, its label, report rows added up.
ASSET_RETURN = (
    ("1.1.1", "Cash", ("Cash in Vault", "Cash in ATM Vault")),
    ("1.1.2", "Due from Central Bank", ("Due from Central Bank",)),
    ("1.1.3", "Items in Course of Collection", ("Items in course of collect.",)),
    ("1.1.4", "Due from Commercial Banks", ("Due from Com. Banks",)),
    ("1.2", "INVESTMENT", ("INVESTMENT",)),
    ("1.2.1", "Domestic Currency Investments", ("Domestic Currency Investments",)),
    ("1.2.2", "Foreign Currency Investments", ("Foreign Currency Investments",)),
    ("1.2.3", "Less: Provision for Investment Losses", ("Less: Provision for Investment Losses",)),
    ("1.3", "SECURITIES PURCHASED WITH A VIEW TO RESALE", ("SECURITIES PURCHASED WITH A VIEW TO RESALE",)),
    ("1.3.1", "From Central Bank", ("From Central Bank",)), ("1.3.2", "Local", ("Local",)),
    ("1.3.3", "Foreign", ("Foreign",)), ("1.4.1", "Standard Loans", ("CURRENT LOAN",)),
    ("1.4.2", "Past due Loans", ("PAST DUE LOANS",)),
    ("1.4.3", "Less: Provision for Loan Losses", ("PROV. FOR L. LOSSES",)),
    ("1.5.1", "Interest Accrued", ("DueFr.Banks&OtherFin.INst", "PerformingLoans", "Non-PerformingLoans")),
    ("1.5.2", "Commissions", ("DUMMY_LABEL",)), ("1.5.3", "Other Receivables", ("OtherReceivable",)),
    ("1.5.4", "Less: Provision for Losses on Receivables", ("Less: Provision for Losses on Receivables",)),
    ("1.6.2", "Premises", ("Offices/Buildings", "OfficeUnderCunstruction", "LeaseholdImprov.")),
    ("1.6.3", "Furniture and Fixtures", ("FurnetureandFixtures",)),
    ("1.6.4", "Machinery Equipment", ("MachineryandEquip.",)), ("1.6.5", "Vehicles", ("Vehicles",)),
    ("1.6.6", "Non Physical Assets", ("NonPhysicalAsset",)),
    ("1.6.9", "Less: Reserve for Depreciation", ("RESERVE FOR DEPREC.",)),
    ("1.9.1", "Prepaid Expenses", ("PrepaidExpenses",)),
    ("1.9.2", "Inter Branch Transactions (Net)", ("Domestic Currency", "Foreign Currency")),
    ("1.9.3", "Office Accounts", ("OfficeAccounts",)),
    ("1.9.4", "Assets Held in Respect of Debt Satisfaction", ("AssetHeldInRes.ofDebt",)),
    ("1.9.6", "Miscellaneous Assets", ("MiscellaneousAssets",)),
)
NEGATIVE_RETURN_CODES = ("1.4.3", "1.5.4", "1.6.9")
ASSET_RETURN_GROUPS = {"1.1": "Liquid Funds", "1.4": "Loans, Advances and Discount", "1.5": "Accounts Receivable",
                       "1.6": "Fixed Assets", "1.9": "Other Assets"}


def balance_sheet_assets(ctx: Context) -> DataFrame:
    """Regulator's asset sheet. It adds up all three periods of the comparison, as it always has."""
    labels = _of_target_month(ctx, ctx.mart("assets_compared")).groupBy("report_month", "description") \
        .agg(F.sum("amount").alias("total"))
    sums = []
    for code, text, sources in ASSET_RETURN:
        value = -F.abs("total") if code in NEGATIVE_RETURN_CODES else C("total")
        sums.append(F.sum(F.when(C("description").isin(*sources), value).otherwise(F.lit(0))).alias(code))
    wide = labels.groupBy("report_month").agg(*sums)
    lines = [(code, text, C(f"`{code}`")) for code, text, _ in ASSET_RETURN]
    prefixes: dict[tuple[str, str | None], Column] = {}
    for code, _, value in lines:
        # a code without a third level has no group label and so forms a group of its own
        key = (code[:3], ASSET_RETURN_GROUPS.get(code[:3]) if code.count(".") == 2 else None)
        prefixes[key] = prefixes[key] + value if key in prefixes else value
    total = sum(list(prefixes.values())[1:], next(iter(prefixes.values())))
    rows = [*lines, *[(code, text, value) for (code, text), value in prefixes.items()], ("1.0", "TOTAL ASSETS", total)]
    rows = [(code, text, value.cast(WIDE)) for code, text, value in rows]
    long = long_rows(wide, ["report_month"], rows, ("code", "description"), "amount")
    return long.select("code", "description", "report_month", _month_label().alias("report_month_label"), "amount")


_DEMAND = ("Demand Deposit", "Time Deposits", "2.4.1.2.4")
_FOREIGN = ("Resident Foreign Currency", "Non-Resident Foreign Currency")
_OVERAGES = ("Others/Overages", "Overages ATM")
_LIABILITY_LABELS = (*_DEMAND, *_FOREIGN, "Other Sundry Current Liabilit.", "Other liabilit/Due To Branch", *_OVERAGES)
_CAPITAL_LABELS = ("Provisioning", "Capital Paid-up & Assigned", "Capital Reserve/Reserve Legais",
                   "Previeous Financial Year", "Current Financial Year")
_TAX = ("Income Tax", "Income Tax (5182)", "Other Taxes")
_SUSPENSE = ("Items in Suspens", "Salary Payable", "Lease Liability IFRS")
_CHEQUES = "Cheques & Other Items in Course of PMT"

# Return code, its label, report labels and report codes added up.
LIABILITY_RETURN = (
    ("2.1", "DUE TO CENTRAL BANK", (), ()), ("2.1.1", "Loans and Advences", (), ()), ("2.1.2", "Discounts", (), ()),
    ("2.1.3", "Others", (), ()), ("2.2", "DUE TO COMMERCIAL BANKS", (), ()), ("2.2.1", "Local Banks", (), ()),
    ("2.2.2", "Foreign Banks", (), ()), ("2.2.3", "Head Office / Parent Bank", (), ()),
    ("2.3", "SECURITIES SOLD UNDER REPO AGREEMENT", (), ()), ("2.3.1", "To Central Bank", (), ()),
    ("2.3.2", "To Other Country-Party", (), ()), ("2.4", "DEPOSITS", (*_DEMAND, *_FOREIGN), ()),
    ("2.4.1", "Resident Domestic Currency", _DEMAND, ()), ("2.4.2", "Non-Resident Domestic Currency", (), ()),
    ("2.4.3", "Resident Foreign Currency", (), ()), ("2.4.4", "Non-Resident Foreign Currency", (), ()),
    ("2.6", "OTHER SUNDRY CURRENT LIABILITIES",
     (_CHEQUES, *_TAX, "Collected Tax", "Interest Accrued", *_SUSPENSE, "RESTRICTED DEPOSIT", "Unearned Interest",
      "Sundry Liabilities"), ("2.06.2", "2.06.8", "2.06.9")),
    ("2.6.1", _CHEQUES, (_CHEQUES,), ()), ("2.6.2", "Staff Expenses", (), ("2.06.2",)),
    ("2.6.3", "Provision for Taxation", _TAX, ()), ("2.6.4", "Accounts Payable", ("Collected Tax",), ()),
    ("2.6.5", "Interest Accrued", ("Interest Accrued",), ()), ("2.6.6", "Item in Suspens", _SUSPENSE, ()),
    ("2.6.7", "Dividends Payable", (), ()), ("2.6.8", "Restricted Deposits", ("RESTRICTED DEPOSIT",), ("2.06.8",)),
    ("2.6.9", "Unearned Interest", ("Unearned Interest",), ("2.06.9",)),
    ("2.6.10", "Sundry Liabilities", ("Sundry Liabilities",), ()),
    ("2.8", "OTHER LIABILITIES", ("Other Liabilit/Due To Branch", *_OVERAGES), ()),
    ("2.8.1", "Inter Branch Transactin (Net)", ("Other Liabilit/Due To Branch",), ()), ("2.8.2", "Other", _OVERAGES, ()),
    ("3", "CAPITAL ACCOUNTS", (), ()), ("3.1", "Provisioning", ("Provisioning",), ()),
    ("3.1.1", "Provision on Loans", (), ()), ("3.1.2", "Provision on Securities", (), ()),
    ("3.1.3", "Provision on Exchange Rate", (), ()), ("3.1.4", "Other Provision", (), ()),
    ("3.2", "Capital Paid up and Assigned", (), ("3.02",)), ("3.2.1", "Ordinary Shares", (), ("3.02",)),
    ("3.2.2", "Preference Shares", (), ()), ("3.2.3", "Other", (), ()), ("3.3", "Share Premium", (), ()),
    ("3.4", "Reserves", ("Capital Reserve/Reserve Legais",), ()),
    ("3.5", "Retained Earnings / (Accumulated Deficit)", (), ()),
    ("3.6", "Unappropriated Profits / (Losses)", ("Previeous Financial Year", "Current Financial Year"), ()),
    ("3.6.1", "Previous Financial Year", ("Previeous Financial Year",), ()),
    ("3.6.2", "Current Financial Year", ("Current Financial Year",), ()),
    ("TOTAL_LIAB", "TOTAL LIABILITIES", _LIABILITY_LABELS, ()), ("TOTAL_CAP", "TOTAL CAPITAL", _CAPITAL_LABELS, ()),
    ("TOTAL_ALL", "TOTAL LIABILITIES & CAPITAL", (*_LIABILITY_LABELS, *_CAPITAL_LABELS), ()),
)


def _label_or_code(labels: Sequence[str], codes: Sequence[str]) -> Column:
    hits = ([C("description").isin(*labels)] if labels else []) + ([C("code").isin(*codes)] if codes else [])
    return any_of(hits)


def balance_sheet_liabilities(ctx: Context) -> DataFrame:
    """Regulator's liability sheet of the current period."""
    rows = _of_target_month(ctx, ctx.mart("liabilities_compared")).filter(C("type_period") == "CURR")
    sums = [F.sum(F.when(_label_or_code(labels, codes), C("amount")).otherwise(F.lit(0))).cast(WIDE).alias(f"r{i}")
            for i, (_, _, labels, codes) in enumerate(LIABILITY_RETURN)]
    wide = rows.groupBy("report_month").agg(*sums)
    cells = [(code, text, C(f"r{i}")) for i, (code, text, _, _) in enumerate(LIABILITY_RETURN)]
    long = long_rows(wide, ["report_month"], cells, ("code", "description"), "amount")
    return long.select("code", "description", "report_month", "amount", _month_label().alias("report_month_label"))


def liquidity(ctx: Context) -> DataFrame:
    """Liquid assets against liabilities per month."""
    def total(*conditions: Column) -> Column:
        return F.sum(F.when(any_of(conditions), C("amount")).otherwise(F.lit(0)))

    text, code = C("description"), C("code")
    assets = _of_target_month(ctx, ctx.mart("assets_compared")).groupBy("report_month").agg(
        total(text.isin("Cash in Vault", "Cash in ATM Vault")).alias("vault"),
        total(text.isin("Due from Central Bank", "Item in course of collect", "Item in course of collect.",
                        "Items in course of collect.", "Foreign Currency")).alias("central"),
        total(code.isin("I23", "I28", "1.01.4.3"), text.isin("Call Deposits", "Foreign Currency"),
              (code == "1.01.4.1.2") & (text == "OTHERS")).alias("other_fi"))
    liabilities = _of_target_month(ctx, ctx.mart("liabilities_compared")).groupBy("report_month").agg(
        total(text.isin("Demand Deposit", "Time Deposits", "Other (Passbook Saving)", "Other Sundry Current Liabilit.",
                        "Other liabilit/Due To Branch", "Other Liabilit/Due To Branch"),
              code.isin("I201", "I217", "I233")).alias("owed"))
    rows = assets.join(liabilities, "report_month", "left")
    nil = F.lit(0.0)
    liquid = C("vault") + C("central") + C("other_fi")
    owed = F.coalesce("owed", F.lit(0))
    return rows.select(
        "report_month", C("vault").cast("double").alias("Vault_Cash"), nil.alias("Precious_metals"),
        C("central").cast("double").alias("Deposits_with_BCTL"),
        C("other_fi").cast("double").alias("Deposits_in_Other_Financial_Institutions"),
        nil.alias("Readily_Marketable_Securities"), nil.alias("Net_inter_bank_lending_borrowing_1_month"),
        liquid.cast("double").alias("Total_Highly_Liquid_Assets"), owed.cast("double").alias("Total_Liabilities"),
        (liquid.cast("double") / F.nullif(owed.cast("double"), F.lit(0.0))).alias("Liquidity_Ratio"),
        _month_label().alias("report_month_label"))


def _leaves(ctx: Context, source: DataFrame, leaf_map: str) -> DataFrame:
    """Report rows added up to statement rows through a (source, code, description) map; a missing
    code matches a missing code."""
    mapped = ctx.dim(leaf_map).select(C("src_tag").alias("t"), C("code").cast("string").alias("c"),
                                      C("description").alias("d"), C("order_id").cast("int").alias("order_id"))
    rows = source.groupBy("src_tag", "load_date", "code", "description").agg(F.sum("amount").alias("amount"))
    joined = null_safe_join(rows, mapped.filter(C("t").isNotNull() & C("d").isNotNull()),
                            [(C("src_tag"), C("t")), (C("description"), C("d")), (C("code"), C("c"))], "inner")
    return joined.groupBy("load_date", "order_id").agg(F.sum("amount").cast(MONEY).alias("amount"))


def _signed(report: DataFrame, tag: str, sign: int) -> DataFrame:
    return report.filter(C("branch_name") != EXCLUDED_BRANCH).select(
        F.lit(tag).alias("src_tag"), "load_date", "code", "description", (money("amount") * sign).alias("amount"))


def position_leaves(ctx: Context) -> DataFrame:
    """Leaves of the statement of condition; row 82 keeps its historical cent."""
    source = _signed(ctx.mart("assets_report"), "AST", -1).unionByName(_signed(ctx.mart("liabilities_report"), "LIB", 1))
    cent = F.when(C("order_id") == 82, F.lit("0.01").cast(MONEY)).otherwise(F.lit(0))
    return _leaves(ctx, source, "position_leaf_map").withColumn("amount", (C("amount") + cent).cast(MONEY))


# The depreciation row that is taken from one branch only.
DEPRECIATION_ROW, DEPRECIATION_BRANCH = 107, "UPGRADE"
DEPRECIATION_CODE, DEPRECIATION_TEXT = "5.03.7.6", "Depr. Non Physical Assets"


def _depreciation(report: DataFrame, branches: Column) -> DataFrame:
    rows = report.filter(branches & (C("code") == DEPRECIATION_CODE) & (C("description") == DEPRECIATION_TEXT))
    return rows.groupBy("load_date").agg((-F.sum(money("amount"))).cast(MONEY).alias("amount"))


def earnings_leaves(ctx: Context) -> DataFrame:
    """Leaves of the income statement; the depreciation row comes from one branch."""
    expense = ctx.mart("expense_report")
    source = _signed(ctx.mart("income_report"), "INC", 1).unionByName(_signed(expense, "EXP", -1))
    one_branch = _depreciation(expense, C("branch_name") == DEPRECIATION_BRANCH)
    return _leaves(ctx, source, "earnings_leaf_map").unionByName(
        one_branch.select("load_date", F.lit(DEPRECIATION_ROW).alias("order_id"), "amount"))


def _statement(ctx: Context, layout: str, leaves: DataFrame, rows: Mapping[int, Column],
               helpers: DataFrame | None = None) -> DataFrame:
    """Layout per load date filled with leaves and range subtotals, 0 where there is neither."""
    base = leaves if helpers is None else leaves.unionByName(helpers)
    subtotals = range_subtotals(base, ["load_date"], "order_id", "amount", rows)
    amounts = leaves.unionByName(subtotals.select("load_date", "order_id", C("amount").cast(MONEY).alias("amount")))
    shape = ctx.dim(layout).select(C("order_id").cast("int").alias("order_id"), C("section").cast("int").alias("section"),
                                   C("code").cast("string").alias("code"), "description", "row_type")
    frame = _times(leaves.select("load_date").distinct(), shape)
    return frame.join(amounts, ["load_date", "order_id"], "left").select(
        "load_date", "section", "order_id", "code", "description", "row_type",
        F.coalesce("amount", F.lit(0)).cast(MONEY).alias("amount"), day_label("load_date").alias("load_date_label"))


def _span(lo: int, hi: int, *but: int) -> Column:
    return between("order_id", lo, hi, but=but)


def _rows(*order_ids: int) -> Column:
    return F.when(C("order_id").isin(*order_ids), F.lit(1))


def _less(plus: Column, *minus: Column) -> Column:
    out = F.coalesce(plus, F.lit(0))
    for m in minus:
        out = out - F.coalesce(m, F.lit(0))
    return out


def position_statement(ctx: Context) -> DataFrame:
    """Statement of condition with subtotals and a balance check."""
    assets = F.when(C("order_id").between(10, 83) | C("order_id").between(89, 93), F.lit(1))
    owed = _span(108, 156, 146)
    # Subtotal row and the leaf rows it adds up.
    rows = {
        14: _rows(15, 16), 9: _span(10, 16), 18: _rows(19), 21: _span(22, 36), 37: _span(38, 53), 54: _span(55, 57),
        20: _span(22, 57), 58: _span(59, 61), 70: _span(71, 76), 62: _span(63, 76), 80: _span(81, 83), 84: _rows(85, 86),
        88: _span(89, 93), 77: _rows(78, 79, 81, 82, 83, 89, 90, 91, 92, 93), 94: assets, 107: _span(108, 111),
        113: _rows(114, 115), 117: _span(118, 132), 106: _span(108, 132), 133: _span(134, 145), 154: _rows(155, 156),
        150: _span(151, 156), 158: owed, 159: _less(owed, assets),
    }
    return _statement(ctx, "position_layout", ctx.mart("position_leaves"), rows)


# Expense subtotals shared by both income statements.
def _expense_rows() -> dict[int, Column]:
    return {65: _span(66, 68), 69: _rows(70), 64: _span(66, 71), 72: _span(73, 75), 77: _span(78, 84), 86: _span(87, 94),
            85: _span(87, 94), 97: _span(98, 99), 100: _span(101, 102), 103: _span(104, 110), 111: _rows(112),
            113: _span(114, 133), 76: _span(78, 133)}


def earnings_statement(ctx: Context) -> DataFrame:
    """Consolidated income statement."""
    income = _span(9, 61)
    rows = {13: _span(14, 28), 29: _span(30, 44), 12: _span(14, 44), 8: _span(9, 45), 48: _span(49, 57), 46: _span(47, 57),
            58: _span(59, 61), 62: income, **_expense_rows(), 135: _span(136, 138), 139: _span(66, 138),
            140: _less(income, _span(66, 138)), 142: _less(income, _span(66, 141))}
    return _statement(ctx, "earnings_layout", ctx.mart("earnings_leaves"), rows)


def income_statement(ctx: Context) -> DataFrame:
    """Income statement with its own row numbers; its expense total takes depreciation of all branches."""
    number = C("order_id")
    shifted = F.when(number.between(9, 28) | number.between(136, 138) | (number == 141), number - 1).otherwise(number)
    leaves = ctx.mart("earnings_leaves").withColumn("order_id", shifted)
    everywhere = _depreciation(ctx.mart("expense_report"), C("branch_name") != EXCLUDED_BRANCH) \
        .select("load_date", F.lit(-DEPRECIATION_ROW).alias("order_id"), "amount")
    dated = everywhere.join(leaves.select("load_date").distinct(), "load_date", "left_semi")
    income = _span(8, 61)
    expense = F.when((number.between(66, 137) & (number != DEPRECIATION_ROW)) | (number == -DEPRECIATION_ROW), F.lit(1))
    rows = {12: _span(13, 27), 29: _span(30, 45), 11: _span(13, 45), 7: _span(8, 45), 48: _span(49, 57), 46: _span(47, 57),
            58: _span(59, 61), 62: income, **_expense_rows(), 134: _span(135, 137), 138: expense,
            139: _less(income, expense), 141: _less(income, expense, _rows(140))}
    return _statement(ctx, "income_layout", leaves, rows, dated)


# Statement rows used by the ratios.
POSITION_PICKS = {
    "liquid_funds": 9, "items_in_collection": 13, "comm_banks": 14, "current_loans": 21, "seasonal_crop": 22,
    "project_loan": 24, "microfinance": 28, "past_due": 37, "provision": 54, "receivable": 58, "fixed_assets": 62,
    "other_assets": 77, "total_assets": 94, "deposits": 106, "gov_dd": 109, "biz_dd": 110, "gov_td": 114,
    "others_td": 115, "hnf": 127, "bank_garansi": 144, "capital_accounts": 150, "provisioning": 151,
    "capital_paid_up": 152, "capital_reserve": 153, "profits_losses": 154,
}
EARNINGS_PICKS = {"due_from_banks": 9, "income_loans": 13, "op_income": 62, "interest_expense": 64, "indiv_deposits": 65,
                  "op_expenses": 139, "before_tax": 140, "after_tax": 142}

# Id, code, name, section, numerator, denominator, scale.
RATIOS = (
    ("r01", "QR", "Quick Ratio", 1, "liquid_funds", "deposits", 100),
    ("r02", "BK", "Banking Ratio", 1, "gross_loans", "deposits", 100),
    ("r03", "ALR", "Assets to Loan Ratio", 1, "gross_loans", "total_assets", 100),
    ("r04", "CR", "Cash Ratio", 1, "liquid_funds", "seasonal_crop + project_loan + microfinance", 100),
    ("r05", "LDR", "Loan to Deposit Ratio", 1, "gross_loans", "own_deposits", 100),
    ("r06", "PR", "Primary Ratio", 2, "equity", "total_assets", 100),
    ("r07", "RAR", "Risk Assets Ratio", 2, "equity", "total_assets - liquid_funds", 100),
    ("r08", "CR2", "Capital Ratio", 2, "capital_accounts - provision + provisioning", "gross_loans", 100),
    ("r09", "CAR", "Capital Adequacy Ratio", 3, "capital_paid_up + profits_losses", "weighted_assets", 100),
    ("r10", "NPL", "Non-Performing Loan Ratio", 3, "past_due", "gross_loans", 100),
    ("r11", "AQ", "Asset Quality", 3, "-provision", "earning_assets", 100),
    ("r12", "NPM", "Net Profit Margin", 3, "after_tax", "op_income", 100),
    ("r13", "NIM", "Net Interest Margin", 3, "due_from_banks + income_loans - indiv_deposits", "earning_assets", 100),
    ("r14", "ROA", "Return on Assets", 3, "before_tax", "total_assets", 100),
    ("r15", "BOPO", "Cost-to-Income Ratio (BOPO)", 3, "op_expenses", "op_income", 100),
    ("r16", "ROE", "Return on Equity", 3, "after_tax", "equity", 100),
    ("r17", "LDR_C", "LDR (CAMEL)", 3, "gross_loans", "own_deposits", 100),
    ("r18", "IBK", "Interbank Net Obligation", 3, "0", "liquid_funds", 0),
    ("r19", "IER", "Interest Expense Ratio", 3, "interest_expense", "biz_dd + others_td + hnf", 100),
    ("r20", "AT", "Asset Turnover", 4, "op_income", "total_assets", 1),
    ("r21", "VLDR", "Variant LDR", 4, "gross_loans", "own_deposits - gov_dd - 175000000", 1),
)


def _picks(statement: DataFrame, picks: Mapping[str, int]) -> DataFrame:
    return statement.groupBy("load_date").agg(*[
        F.sum(F.when(C("order_id") == row, C("amount")).otherwise(F.lit(0))).cast(WIDE).alias(name)
        for name, row in picks.items()])


def ratio_sheet(ctx: Context) -> DataFrame:
    """21 prudential ratios per load date."""
    values = _picks(ctx.mart("position_statement"), POSITION_PICKS).join(
        _picks(ctx.mart("earnings_statement"), EARNINGS_PICKS), "load_date")
    values = values.selectExpr(
        "*", "current_loans + past_due as gross_loans", "capital_paid_up + capital_reserve + profits_losses as equity",
        "deposits - gov_dd - gov_td + bank_garansi as own_deposits", "current_loans + past_due + comm_banks as earning_assets",
        "cast(0.2 * (items_in_collection + comm_banks) as decimal(28,2)) + current_loans + past_due + provision "
        "+ fixed_assets + receivable + other_assets as weighted_assets")
    cells = []
    for rid, code, name, section, top, bottom, scale in RATIOS:
        up, down = F.expr(top).cast(MONEY), F.expr(bottom).cast(MONEY)
        ratio = safe_ratio(up, down, scale) if scale else F.lit(0).cast("decimal(18,4)")
        cells.append(F.struct(F.lit(rid).alias("ratio_id"), F.lit(code).alias("ratio_code"), F.lit(name).alias("ratio_name"),
                              F.lit(section).alias("section"), up.alias("numerator"), down.alias("denominator"),
                              ratio.alias("ratio_pct")))
    return values.select("load_date", F.inline(F.array(*cells))).withColumn("load_date_label", day_label("load_date"))


# Contingent accounts, in order.
CONTINGENT = (
    ("7", "CONTINGENT ACCOUNTS"), ("7.1", "Acceptances Guarantees & Letters of Credit"), ("7.1.1", "Guarantees Issued"),
    ("7.1.1.1", "Commercial Paper"), ("7.1.1.2", "Other"), ("7.1.2", "Letters of Credit Issued"),
    ("7.2", "Other Confirmed Paper"), ("7.3", "Unused Lines of Credit"), ("7.4", "Undisbursed Loan Funds"),
    ("7.4.1", "Domestic Currency"), ("7.4.2", "Foreign Currency"), ("7.5", "Commitments"), ("7.5.1", "To Grant Loans"),
    ("7.5.1.1", "Domestic Currency"), ("7.5.1.2", "Foreign Currency"), ("7.5.2", "To Buy Securities"),
    ("7.5.3", "To Sell Securities"), ("7.5.4", "To Lease"), ("7.6", "Pending Litigation"),
    ("7.7", "Assets Sold with Recourse"), ("7.8", "Other"),
)
# Memoranda items, in order.
MEMORANDA = (
    ("8", "Memoranda Items"), ("8.1", "Authorized Capital"), ("8.2", "Subscribed Capital"),
    ("8.3", "Paid-Up/Assigned Capital"), ("8.3.1", "Domestic Currency"), ("8.3.2", "Foreign Currency"),
    ("8.4", "Past Due Loan"), ("8.4.1", "90 Days"), ("8.4.2", "90 - 180 Days"), ("8.4.3", "180 - 270 Days"),
    ("8.4.4", "Write-Offs"), ("8.5", "Interest Capitalized During the Month"),
    ("8.6", "Charged off Assets During the Month"), ("8.6.1", "Loans"), ("8.6.2", "Other"),
    ("8.7", "Bad Loans Recovered During the Month"), ("8.8", "Syndicated Loans"), ("8.8.1", "Lead Institution"),
    ("8.8.2", "Participating Institution"), ("8.9", "Loan Participation"), ("8.9.1", "Acquired by the Institution"),
    ("8.9.1.1", "With Recourse"), ("8.9.1.2", "Without Recourse"), ("8.9.2", "Conveyed to Others"),
    ("8.9.2.1", "With Recourse"), ("8.9.2.2", "Without Recourse"), ("8.10", "Credit Card Receivables"),
    ("8.10.1", "Domestic Currency"), ("8.10.2", "Foreign Currency"), ("8.11", "Loan to Staff"),
    ("8.11.1", "Mortgage Loans"), ("8.11.2", "Other Loans"), ("8.12", "Total Credit Facilities"),
    ("8.13", "Investment in Shares"), ("8.13.1", "Quoted"), ("8.13.2", "Unquoted"),
    ("8.14", "Own Securities Assigned as Collateral"), ("8.14.1", "Ordinarily Eligible as Liquid Securities"),
    ("8.14.2", "Other"), ("8.15", "Unused Portion of L/C in Favor Own Institution"), ("8.16", "Assets Held in Trust"),
    ("8.17", "Funding to Connected Parties"), ("8.17.1", "Placements"), ("8.17.2", "Investments"), ("8.17.3", "Credits"),
    ("8.17.4", "Accounts Receivables"), ("8.17.5", "Other"), ("8.18", "Funding from Connected Parties"),
    ("8.18.1", "Capital"), ("8.18.2", "Deposits"), ("8.18.3", "Accounts Payable"), ("8.18.4", "Other"),
)
STAFF_LOAN_ROWS, STAFF_LOAN_CODES = (56, 57, 73, 74), ("8.11", "8.11.2")


def central_bank_return(ctx: Context) -> DataFrame:
    """Seven-section return: assets, liabilities, capital, income, expense, contingent, memoranda."""
    def section(report: DataFrame, number: int, sign: int) -> DataFrame:
        return report.groupBy("load_date", "order_id", "code", "description").agg(
            (F.sum(money("amount")) * sign).cast(WIDE).alias("amount")).withColumn("bctl_section", F.lit(number))

    assets = ctx.mart("assets_report")
    income, expense = section(ctx.mart("income_report"), 4, 1), section(ctx.mart("expense_report"), 5, -1)
    profit = (income.filter(C("code") != "4.0").unionByName(
        expense.filter(C("code") != "5.0").withColumn("amount", -C("amount")))
        .groupBy("load_date").agg(F.sum("amount").alias("profit"), F.max((C("bctl_section") == 4).cast("int")).alias("has_income")))
    profit = profit.filter(C("has_income") == 1).drop("has_income")
    owed = section(ctx.mart("liabilities_report"), 0, 1).join(profit, "load_date", "left")
    owed = owed.withColumn("amount", F.when(C("code") == "3.06.2", F.coalesce("profit", F.lit(0))).otherwise(C("amount")).cast(WIDE))
    side = F.when(C("code").startswith("2.") | C("code").startswith("2-"), 2) \
        .when(C("code").startswith("3.") | C("code").startswith("3-"), 3)
    owed = owed.drop("profit").withColumn("bctl_section", side).filter(C("bctl_section").isNotNull())
    staff = assets.groupBy("load_date").agg(
        (-F.sum(F.when(C("order_id").isin(*STAFF_LOAN_ROWS), money("amount")))).cast(WIDE).alias("staff"))
    names = ("bctl_section", "order_id", "code", "description")
    notes = with_rows(staff, [(7, i, *row) for i, row in enumerate(CONTINGENT, 1)]
                      + [(8, i, *row) for i, row in enumerate(MEMORANDA, 1)], names)
    notes = notes.withColumn("amount", F.when(C("code").isin(*STAFF_LOAN_CODES), F.coalesce("staff", F.lit(0))).cast(WIDE)).drop("staff")
    rows = section(assets, 1, -1)
    for part in (owed, income, expense, notes):
        rows = rows.unionByName(part)

    def total(number: int, which: Column) -> Column:
        return F.coalesce(F.sum(F.when((C("bctl_section") == number) & which, C("amount"))), F.lit(0))

    def top_level(prefix: str) -> Column:
        return C("code").rlike(rf"^{prefix}\.[^.]*$") & (C("code") != f"{prefix}.0")

    totals = rows.groupBy(C("load_date").alias("d")).agg(
        total(1, top_level("1")).alias("t1"), total(2, top_level("2")).alias("t2"),
        total(3, C("code").isin("3.06.1", "3.06.2")).alias("t306"),
        total(3, (C("code").rlike(r"^3\.0[^.]*$") & ~C("code").isin("3.0", "3.06")) | C("code").startswith("3-")).alias("t3"),
        total(4, C("code") != "4.0").alias("t4"), total(5, C("code") != "5.0").alias("t5"))
    # Total code and what it shows.
    shown = {"1.0": C("t1"), "2.0": C("t2") + C("t3") + C("t306"), "3.0": C("t3") + C("t306"), "3.06": C("t306"),
             "4.0": C("t4"), "5.0": C("t5")}
    amount = F.lit(None)
    for code, value in shown.items():
        amount = F.when((C("code") == code) & (C("bctl_section") == int(code[0])), value).otherwise(amount)
    is_total = C("code").isin(*shown) & (C("bctl_section") == F.substring("code", 1, 1).try_cast("int"))
    return rows.join(totals, C("load_date") == C("d"), "left").select(
        "load_date", "bctl_section", "order_id", "code", "description", day_label("load_date").alias("load_date_label"),
        F.when(F.coalesce(is_total, F.lit(False)), amount).otherwise(C("amount")).cast(MONEY).alias("amount"))


REPORTS = (loan_counts, deposit_counts, asset_summary, liability_summary, income_lines, expense_lines, assets_report,
           liabilities_report, income_report, expense_report, assets_compared, liabilities_compared, balance_sheet_assets,
           balance_sheet_liabilities, liquidity, position_leaves, earnings_leaves, position_statement, earnings_statement,
           income_statement, ratio_sheet, central_bank_return)

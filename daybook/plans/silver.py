"""Denormalised marts. Each function takes a Context and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from daybook import specs
from daybook.context import Context
from daybook.functions.columns import (as_date, blank_null, company_of_branch, compact_date,
                                       currency_amount, dr_cr, first_text, item, k, later, lookup, money,
                                       name_concat, null_of, num_or_null, padded_account, part)
from daybook.sources.dimensions import KEY
from daybook.operators.frames import earliest, group_stats, latest, parent_below, running_sum, slices

C = F.col


def _newest(df: DataFrame, prefix: str, order: Sequence[Column] | None = None, key: Column | None = None,
            **cols: Column) -> DataFrame:
    """Newest version per record; the key column is ``<prefix>_key``. Stored dimensions have one row per record already."""
    if KEY in df.columns and key is None:
        return df.select(C(KEY).alias(f"{prefix}_key"), *[c.alias(n) for n, c in cols.items()])
    key = k("recid") if key is None else key
    order = [C("curr_no")] if order is None else order
    return latest(df.filter(key.isNotNull()), [key], order, cols, [f"{prefix}_key"])


NULL_SALTS = 256
ROW_IDS = ("transaction_id", "entry_id", "trans_ref", "arrangement_id")  # columns that tell rows of a mart apart, or nearly


def _enrich(df: DataFrame, dim: DataFrame, prefix: str, on: Column, sparse: bool = False) -> DataFrame:
    """Columns of a dimension for each row. With ``sparse`` many rows have no key: those are spread over keys that match nothing,
    since nulls would all meet in one task."""
    if not sparse:
        return df.join(dim, on == C(f"{prefix}_key"), "left").drop(f"{prefix}_key")
    spread = [c for c in ROW_IDS if c in df.columns] or df.columns
    nowhere = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*spread), F.lit(NULL_SALTS)).cast("string"))
    return df.withColumn("_on", F.coalesce(on, nowhere)).join(dim, C("_on") == C(f"{prefix}_key"), "left").drop("_on", f"{prefix}_key")




def _arrangement_of(col: str = "recid") -> Column:
    return part(col, "-", 1)


def _property_date(col: str = "recid") -> Column:
    """Date part of ``arrangement-PROPERTY-yyyymmdd.seq``."""
    return F.split_part(part(col, "-", 3), F.lit("."), F.lit(1))


def _with_day(ctx: Context, df: DataFrame) -> DataFrame:
    return df.withColumn("business_date", ctx.day)


def _named(name: str) -> Column:
    """Composed name, blank rather than null when the customer is unknown."""
    return F.coalesce(C(name), F.lit("")).alias(name)


def _documents(ctx: Context, prefix: str) -> DataFrame:
    lookups = ctx.pull("eb_lookup").filter(C("recid").startswith(specs.LEGAL_DOC_LOOKUP[:-1]))
    return _newest(lookups, prefix, **{f"{prefix}_text": item("description")})


def acct_cust(ctx: Context) -> DataFrame:
    """Savings accounts with their customer."""
    customer = _newest(
        ctx.versions("customer"), "c", name1=k(item("name_1")), name2=k(item("name_2")), short_name=k(item("short_name")),
        born=F.coalesce(as_date("birth_incorp_date"), as_date("date_of_birth")), nationality=k("nationality"),
        birth_country=k("cust_birth_country"),
        address=first_text(item("street"), item("address"), item("town_country"), blank_is_null=False),
        occupation=k(item("occupation")), legal_doc_name=k(item("legal_doc_name")), legal_id=k(item("legal_id")),
        email=k(item("email_1")), sms=k(item("sms_1")), phone=k(item("phone_1")))
    lo, hi = specs.SAVINGS_CATEGORY_RANGE
    account = ctx.dim("account").filter(blank_null("customer").isNotNull() & k("category").between(lo, hi))
    account = account.select(
        k("recid").alias("account_number"), C("category").try_cast("int").alias("category"),
        k("customer").alias("customer_no"), as_date("opening_date").alias("opening_date"),
        money("working_balance").alias("balance"), k("co_code").alias("company"), k("gender").alias("gender"),
        k(item("alt_acct_id")).alias("iban"))
    joined = _enrich(account, customer, "c", C("customer_no"))
    gaps = {"currency": "string", "interest_rate": "decimal(18,6)", "interest_amount": "decimal(18,2)",
            "value_date": "date", "maturity_date": "date", "branch_name": "string", "product_name": "string"}
    return _with_day(ctx, joined.select(
        "account_number", "category", "customer_no", "opening_date", C("born").alias("date_of_birth"), "name1", "name2",
        "short_name", "balance", "company", "gender", "iban", *[null_of(t).alias(n) for n, t in gaps.items()],
        "nationality", "birth_country", "address", "occupation", "legal_doc_name", "legal_id", "email", "sms", "phone"))


def closed_accounts(ctx: Context) -> DataFrame:
    """Closed accounts up to the business date with their last history image."""
    reasons = _newest(ctx.pull("posting_restrict"), "r", close_reason=k(item("description")))
    closed = latest(ctx.dim("account_closed"), [k("recid")],
                    [blank_null("account_branch").isNotNull().cast("int"), C("business_date")],
                    {"customer": k("customer_id"), "branch_code": k("account_branch"),
                     "close_reason_code": k("closure_reason"), "close_date": as_date("acct_close_date")}, ["id"])
    closed = closed.filter(C("close_date") <= ctx.day).withColumn("acct_id", padded_account("id"))
    image = _newest(
        ctx.dim("account_his"), "h", [C("curr_no").try_cast("int")], part("recid", ";", 1),
        acct_title=name_concat(item("account_title_1"), item("account_title_2")),
        category=num_or_null("category", "int", "^[0-9]+$"), ccy=blank_null("currency"),
        credit_int=num_or_null(item("acct_credit_int"), "decimal(18,2)", r"^-?[0-9]+(\.[0-9]+)?$"),
        closing_bal=money("working_balance"), arrangement_marker=blank_null("arrangement_id"))
    out = _enrich(_enrich(closed, reasons, "r", C("close_reason_code")), image, "h", C("acct_id"))
    return _with_day(ctx, out.select(
        "acct_id", "customer", "branch_code", "acct_title", "category", "ccy", "credit_int", "closing_bal", "close_date",
        "close_reason_code", "close_reason", "arrangement_marker", "id"))


def locked_amounts(ctx: Context) -> DataFrame:
    """Lock events with the account title."""
    account = _newest(ctx.versions("account"), "a", name=k(item("short_title")))
    events = ctx.dim("ac_locked_events").select(
        k("trans_ref").alias("transaction_ref"), k("account_number").alias("account"),
        k("description").alias("reasons_for_locking"), as_date("from_date").alias("from_date"),
        as_date("to_date").alias("to_date"), money("locked_amount").alias("locked_amount"),
        F.when(k("txn_sign") == "CR", "CREDIT").otherwise("DEBIT").alias("reservation_type"))
    out = _enrich(events, account, "a", C("account"))
    return out.select("transaction_ref", "account", "name", "reasons_for_locking", "from_date", "to_date",
                      "locked_amount", "reservation_type")


def category_entry_book(ctx: Context) -> DataFrame:
    """Profit and loss entries, live ones preferred over archived ones."""
    cols = {n: C(n) for n in ("pl_category", "transaction_code", "trans_reference", "their_reference", "value_date",
                              "booking_date", "amount_lcy", "amount_fcy", "currency", "account_number",
                              "company_code", "customer_id", "source")}
    live = ctx.dim("categ_entry").withColumn("source", F.lit("LIVE"))
    archive = ctx.dim("categ_entry_detail").withColumn("source", F.lit("ARCHIVE"))
    both = live.select("recid", *cols).unionByName(archive.select("recid", *cols))
    entry = latest(both, [k("recid")], [(C("source") == "LIVE").cast("int")], cols, ["entry_id"])
    category = _newest(ctx.versions("category"), "g", category_desc=k(item("short_name")))
    txn = _newest(ctx.versions("transaction"), "t", description=k("stmt_narr"))
    xref = _newest(ctx.versions("categ_entry_detail_xref"), "x", [k("detail_id")], detail_xref_id=k("detail_id"))
    out = _enrich(entry.withColumn("category", C("pl_category").try_cast("int")), category, "g", C("category").cast("string"))
    out = _enrich(_enrich(out, txn, "t", k("transaction_code")), xref, "x", C("entry_id"))
    return out.select(
        "entry_id", "source", "category", "category_desc", k("transaction_code").alias("transaction_code"), "description",
        k("trans_reference").alias("trans_ref"), k("their_reference").alias("their_reference"),
        as_date("value_date").alias("value_date"), as_date("booking_date").alias("post_date"),
        money("amount_lcy").alias("amount_lcy"),
        F.when(as_date("value_date") > ctx.day, "*").otherwise("").alias("forward_flag"),
        k("account_number").alias("account_number"), k("company_code").alias("company_code"),
        k("customer_id").alias("customer_id"), "detail_xref_id", k("currency").alias("currency"),
        money("amount_fcy").alias("amount_fcy"), null_of("string").alias("product_name"),
        null_of("string").alias("customer_name"))


def _commitments(ctx: Context) -> DataFrame:
    terms = ctx.dim("aa_arr_term_amount").filter(C("recid").contains("-COMMITMENT-"))
    return _newest(terms, "m", [_property_date(), C("recid")], _arrangement_of(), commitment_amt=money("amount"))


def loan_risk(ctx: Context) -> DataFrame:
    """Lending assets with account, customer, officer, sector, commitment and schedule."""
    schedule = (ctx.dim("aa_arr_payment_schedule").filter(C("recid").contains("-SCHEDULE-"))
                .groupBy(_arrangement_of().alias("s_key")).agg(F.sum(money(item("calc_amount", 1))).alias("rep_amount")))
    category = _newest(ctx.pull("category"), "g", product_name=k(item("short_name")))
    customer = _newest(
        ctx.versions("customer"), "c", officer=k("account_officer"), id_type=k("id_types"), legal_id=k(item("legal_id")),
        employer_name=k("employ_name"), occupation=k(item("occupation")), spouse_name=k("sp_name"),
        mobile_phone=k("tel_mobile"), customer_name=k(item("name_1")), customer_short_name=k(item("name_2")),
        sector=k("sector"))
    details = _newest(ctx.versions("aa_account_details"), "d", [k("recid")], maturity_date=as_date("maturity_date"),
                      arrangement_status=k("arr_age_status"))
    officer = _newest(ctx.pull("dept_acct_officer"), "o", account_officer=k("name"))
    sector = ctx.dim("map_sector_credit").select(C("sector_code").cast("string").alias("e_key"),
                                                 C("credit_by_sector").try_cast("int").alias("credit_by_sector"))
    account = ctx.dim("account").select(
        k("recid").alias("a_key"), C("category").try_cast("int").alias("category"),
        money("working_balance").alias("loan_outstanding"), as_date("date_last_cr_auto").alias("last_date_cr"),
        as_date("opening_date").alias("opening_date"), k("arrangement_id").alias("arrangement_id"))
    asset = ctx.dim("pv_asset_detail").filter((k("product_line") == "LENDING") & blank_null("customer").isNotNull())
    asset = asset.select(
        k("recid").alias("asset_id"), padded_account("recid").alias("loan_id"), k("customer").alias("customer_number"),
        k("currency").alias("currency"), k("auto_class").alias("auto_class"),
        k(item("calc_prov_type")).alias("provision_type"), money(item("calc_base_amt")).alias("base_amount"),
        k("co_code").alias("company_code"))
    out = asset.join(account, C("asset_id") == C("a_key"))
    out = _enrich(out, customer, "c", C("customer_number"))
    out = _enrich(out, details, "d", C("arrangement_id"))
    out = _enrich(out, schedule, "s", C("arrangement_id"))
    out = _enrich(out, _commitments(ctx), "m", C("arrangement_id"))
    out = _enrich(out, category, "g", C("category").cast("string"))
    out = _enrich(_enrich(out, officer, "o", C("officer")), sector, "e", C("sector"))
    gap = null_of
    return _with_day(ctx, out.select(
        "loan_id", "category", "product_name", "customer_number", "account_officer", "currency", "auto_class",
        "loan_outstanding", "provision_type", "base_amount", C("commitment_amt").alias("commitment"),
        gap("int").alias("term"), "maturity_date", "arrangement_status",
        F.coalesce(money("rep_amount"), F.lit(0).cast("decimal(18,2)")).alias("repayment_amount"), "last_date_cr",
        "opening_date", "id_type", "customer_name", "customer_short_name", "company_code", "arrangement_id", "legal_id",
        "employer_name", gap("decimal(18,6)").alias("interest_rate"), gap("decimal(18,2)").alias("current_interest"),
        gap("decimal(18,2)").alias("available_principal"), "occupation", "spouse_name", "mobile_phone",
        gap("string").alias("name_credit_grantor"), "credit_by_sector", gap("string").alias("manner_of_paymt"),
        gap("string").alias("security"), gap("string").alias("desc_of_collateral")))


def lending_arrangements(ctx: Context) -> DataFrame:
    """Open lending arrangements with application, term, group, product, commitment and overdue."""
    loan_app = _newest(ctx.versions("em_lo_application"), "l", rep_start=as_date("rep_start_date"))
    dl_app = _newest(ctx.versions("em_dl_application"), "q", dl_app_date=as_date("app_date"))
    party = _newest(ctx.dim("aa_arr_customer"), "p", [_property_date(), C("recid")], _arrangement_of(),
                    dl_appl_id=k("dl_appl_id"), loan_appl_id=k("loan_appl_id"), group_id=k("group_id"))
    term = _newest(ctx.dim("aa_arr_term_amount").filter(C("recid").contains("-TERM.AMOUNT-")), "t",
                   [_property_date(), C("recid")], _arrangement_of(), term=k("term"))
    dates = ctx.dim("aa_account_details").select(
        k("recid").alias("d_key"), as_date("payment_start_date").alias("pay_start"),
        as_date("maturity_date").alias("maturity_date"))
    customer = _newest(ctx.versions("customer"), "c", owner_name=k(item("name_1")))
    group = _newest(ctx.pull("mcb_group"), "g", [C("recid")], group_name=C("g_name"))
    role = _newest(ctx.versions("aa_customer_role"), "r", [C("recid")], customer_role=item("description"))
    product = _newest(ctx.pull("aa_product"), "u", [C("recid")], product_desc=k(item("description")))
    overdue = (ctx.dim("aa_bill_details").groupBy(k("arrangement_id").alias("b_key"))
               .agg(F.sum(money("os_total_amount")).cast("decimal(28,2)").alias("overdue")))
    arr = ctx.dim("aa_arrangement").filter((k("product_line") == "LENDING")
                                           & ~k("arr_status").isin(*specs.CLOSED_ARRANGEMENTS))
    arr = arr.select(
        k("recid").alias("arr_id"), k("co_code").alias("co_code"), k(item("linked_appl_id")).alias("account"),
        k(item("customer")).alias("customer"), k(item("customer_role")).alias("role_code"),
        k("product_group").alias("product_code"), as_date("start_date").alias("start_date"),
        k("currency").alias("currency"), lookup(k("arr_status"), specs.ARRANGEMENT_STATUS, k("arr_status")).alias("arr_status_disp"))
    out = arr
    for dim, prefix in ((party, "p"), (term, "t"), (dates, "d"), (_commitments(ctx), "m"), (overdue, "b")):
        out = _enrich(out, dim, prefix, C("arr_id"))
    out = _enrich(out, customer, "c", C("customer"))
    out = _enrich(out, loan_app, "l", C("loan_appl_id"))
    out = _enrich(out, dl_app, "q", F.nullif(C("dl_appl_id"), F.lit("")), sparse=True)
    out = _enrich(out, group, "g", C("group_id"))
    out = _enrich(out, role, "r", C("role_code"))
    out = _enrich(out, product, "u", C("product_code"))
    gap = null_of
    return _with_day(ctx, out.select(
        F.lpad("arr_id", 17, " ").alias("arrangement"),
        F.coalesce(F.nullif(C("dl_appl_id"), F.lit("")), C("loan_appl_id")).alias("appl_id"), "co_code", "account",
        "customer", "customer_role", gap("string").alias("account_officer"), "product_desc", "group_id", "group_name",
        C("customer").alias("owner"), "owner_name", "start_date", F.coalesce("rep_start", "pay_start").alias("first_pay_date"),
        "maturity_date", "term", "currency", gap("string").alias("category_code"), "commitment_amt",
        *[gap("decimal(18,2)").alias(n) for n in ("totcommbal", "curraccbal", "due_today")], "overdue",
        gap("string").alias("resch_ind"), "arr_status_disp", "dl_app_date"))


def inward_remittance(ctx: Context, require_current: bool = True) -> DataFrame:
    """Inward funds transfers with both account titles."""
    titles = _newest(ctx.versions("account"), "a", title=k(item("short_title")))
    payer = titles.select(C("a_key").alias("v_key"), C("title").alias("received_from"))
    payee = titles.select(C("a_key").alias("w_key"), C("title").alias("beneficiary"))
    ft = ctx.dim("funds_transfer")
    if require_current:
        ft = ft.filter(k("transaction_type") == "IT")
    charge_ccy, charges = currency_amount("total_charge_amt")
    debit, credit = C("debit_amount").try_cast("double"), C("credit_amount").try_cast("double")
    ft = ft.select(
        null_of("int").alias("row_no"), k("recid").alias("transaction_ref"), k("debit_their_ref").alias("ref_number"),
        k(item("ordering_cust")).alias("ordering_customer"), k("ord_cust_acct").alias("ordering_customer_acc_no"),
        k("inw_send_bic").alias("sender_bic"), k("debit_acct_no").alias("debit_account"),
        k("credit_acct_no").alias("credit_account"), F.when(debit > 0, debit).otherwise(credit).alias("amount"),
        k("debit_currency").alias("debit_ccy"), debit.alias("debit_amount"), charge_ccy.alias("charge_ccy"),
        charges.alias("charges"), k("credit_currency").alias("credit_ccy"),
        currency_amount("amount_credited")[1].alias("credit_amount"), as_date("credit_value_date").alias("value_date"),
        as_date("processing_date").alias("date_transfer"), k("profit_centre_dept").alias("profit_centre"))
    out = _enrich(_enrich(ft, payer, "v", C("debit_account")), payee, "w", C("credit_account"))
    gap = null_of("string")
    return _with_day(ctx, out.select(
        "row_no", "transaction_ref", "ref_number", "ordering_customer", "ordering_customer_acc_no", "sender_bic",
        gap.alias("origin_of_country"), "debit_account", "received_from", "beneficiary", gap.alias("gender"),
        "credit_account", "amount", "debit_ccy", "debit_amount", "charge_ccy", "charges", "credit_ccy", "credit_amount",
        "value_date", "date_transfer", "profit_centre", null_of("double").alias("rate"), gap.alias("remark"),
        gap.alias("remittance_information"), gap.alias("ft_link")))


def inactive_accounts(ctx: Context, recent_days: int = 30) -> DataFrame:
    """Accounts marked inactive whose last movement is close to the newest one in the data."""
    customer = _newest(
        ctx.versions("customer"), "c",
        customer_name=F.trim(F.regexp_replace(F.concat_ws(" ", *[
            F.coalesce(k(x), F.lit("")) for x in (C("title"), item("name_1"), item("name_2"), item("short_name"))]),
            r"\s+", " ")),
        customer_short_name=k(item("short_name")), customer_full_name=k(item("name_1")), legal_id=k(item("legal_id")),
        occupation=k(item("occupation")), customer_gender=k("gender"), born=as_date("date_of_birth"))
    company = _newest(ctx.pull("company"), "o", branch_name=k(item("company_name")))
    marked = ctx.dim("account").filter(k("inactiv_marker") == "Y") \
        .withColumn("last_txn", later("date_last_cr_cust", "date_last_dr_cust"))
    newest = marked.agg(F.max("last_txn")).scalar()
    recent = marked.filter(C("last_txn") >= F.date_add(newest, -recent_days))
    recent = recent.select(
        k("co_code").alias("company_code"), k("recid").alias("account_number"), k("customer").alias("customer_number"),
        k("currency").alias("account_currency"), "last_txn", money("working_balance").alias("account_balance"),
        as_date("opening_date").alias("opening_date"), k(item("account_title_1")).alias("account_title_1"),
        k(item("account_title_2")).alias("account_title_2"), k(item("short_title")).alias("short_title"),
        k("category").alias("account_category"), as_date("date_last_cr_cust").alias("last_credit_date"),
        as_date("date_last_dr_cust").alias("last_debit_date"), k("inactiv_marker").alias("inactive_marker"))
    out = _enrich(_enrich(recent, customer, "c", C("customer_number")), company, "o", C("company_code"))
    idle = F.datediff(ctx.day, C("last_txn"))
    return _with_day(ctx, out.select(
        C("company_code").alias("company_id"), "company_code", "branch_name", "account_number",
        C("account_number").alias("account_id"), "customer_number", C("customer_number").alias("customer_id"),
        _named("customer_name"), "account_currency", C("last_txn").alias("last_transaction_date"), "account_balance",
        C("account_balance").alias("working_balance"), C("opening_date").alias("account_open_date"), "opening_date",
        "account_title_1", "account_title_2", "short_title", "account_category", "last_credit_date", "last_debit_date",
        idle.alias("days_since_last_txn"), "inactive_marker",
        F.when(C("last_txn").isNull() | (idle >= 30), "Y").otherwise("N").alias("is_inactive_30_days"),
        ctx.day.alias("mis_date"), compact_date(ctx.day).alias("dir0"), null_of("string").alias("record_timestamp"),
        "customer_short_name", "customer_full_name", "legal_id", null_of("string").alias("legal_doc_type"),
        null_of("date").alias("legal_doc_expiry_date"), "occupation", C("customer_gender").alias("gender"),
        C("born").alias("birth_or_incorp_date")))


def missing_documents(ctx: Context) -> DataFrame:
    """Customers whose first identity document is missing or expired, with their accounts."""
    expiry = as_date(item("legal_exp_date"))
    customer = _newest(
        ctx.versions("customer"), "c", customer_name=name_concat(C("title"), item("name_1"), item("name_2"), item("short_name")),
        born=F.coalesce(as_date("date_of_birth"), as_date("birth_incorp_date")), doc_code=k(item("legal_doc_name")),
        legal_id=k(item("legal_id")), expiry=expiry, customer_short_name=k(item("short_name")),
        occupation=k(item("occupation")), gender=k("gender"))
    no_id = F.coalesce(C("legal_id"), F.lit("")) == ""
    customer = customer.filter(no_id | (C("expiry") <= ctx.day))
    company = _newest(ctx.pull("company"), "o", branch_name=k(item("company_name")))
    gic = _newest(ctx.pull("gic_id"), "g", gic_text=item("description"))
    ref = _newest(ctx.versions("customer_account"), "r", [k("recid")], cust_account_ref=k("account_number"))
    account = ctx.dim("account").filter(C("category").try_cast("bigint").cast("string").isin(*specs.DOCUMENT_CATEGORIES))
    account = account.select(
        k("customer").alias("holder"), k("co_code").alias("company_code"), k("recid").alias("account_number"),
        as_date("opening_date").alias("opening_date"), k("category").alias("account_category"),
        k("currency").alias("account_currency"), money("working_balance").alias("working_balance"))
    out = account.join(customer, C("holder") == C("c_key")).drop("c_key")
    out = _enrich(out, ref, "r", C("holder"))
    out = _enrich(out, company, "o", C("company_code"))
    out = _enrich(out, _documents(ctx, "d"), "d", F.concat(F.lit(specs.LEGAL_DOC_LOOKUP), C("doc_code")))
    out = _enrich(out, gic, "g", C("doc_code"))
    doc_type = F.coalesce(k("d_text"), k("gic_text"), C("doc_code"))
    gap = null_of("string")
    return _with_day(ctx, out.select(
        C("company_code").alias("comp_id"), "branch_name", C("holder").alias("customer_number"), "account_number",
        "customer_name", C("born").alias("date_of_birth"), C("opening_date").alias("open_account_date"),
        doc_type.alias("id_doc_type"), C("legal_id").alias("id_doc_no"), C("expiry").alias("expired_date_doc"),
        C("holder").alias("customer_id"), C("customer_name").alias("customer_full_name"), "customer_short_name",
        C("born").alias("birth_or_incorp_date"), "legal_id", doc_type.alias("legal_doc_type"),
        C("expiry").alias("legal_doc_expiry_date"), F.when(no_id, "Y").otherwise("N").alias("has_no_legal_id"),
        gap.alias("is_legal_doc_expired"), F.lit("Y").alias("requires_legal_doc_update"), "occupation", "gender",
        gap.alias("customer_type"), gap.alias("customer_status"), null_of("timestamp").alias("record_timestamp"),
        ctx.day.alias("mis_date"), "company_code", C("account_number").alias("account_id"), gap.alias("account_title_1"),
        gap.alias("account_title_2"), "opening_date", "account_category", "account_currency", "working_balance",
        compact_date(ctx.day).alias("dir0"), "cust_account_ref"))


def large_daily_txn(ctx: Context) -> DataFrame:
    """All entries of the day for accounts whose entries add up to the threshold in local currency.

    The account test is a partial aggregation joined back, not a window, so a hot account costs
    nothing extra.
    """
    entry = ctx.event("stmt_entry", "booking_date").withColumn("acct", k("account_number")) \
        .withColumn("amt", money("amount_lcy"))
    per_account = entry.groupBy(C("acct").alias("t_key")).agg(
        F.sum(F.abs("amt")).alias("acct_total"), F.count(F.lit(1)).alias("entry_cnt"),
        F.max(F.struct("recid", "currency"))["currency"].alias("last_ccy"))
    large = per_account.filter((C("acct_total") >= specs.LARGE_TXN_TOTAL) & (C("last_ccy") == "USD")).drop("last_ccy")
    account = ctx.dim("account").select(
        k("recid").alias("a_key"), k(item("account_title_1")).alias("account_title_1"),
        k(item("account_title_2")).alias("account_title_2"), k(item("short_title")).alias("short_title"),
        as_date("opening_date").alias("open_date"), k("customer").alias("customer_no"),
        money("working_balance").alias("working_balance"), k("category").alias("account_category"),
        k("currency").alias("account_currency"))
    customer = _newest(
        ctx.versions("customer"), "c", customer_id=k("recid"),
        cust_name=name_concat(C("title"), item("name_1"), item("name_2"), item("short_name")),
        occupation=k(item("occupation")), legal_id=k(item("legal_id")), doc_code=k(item("legal_doc_name")),
        customer_name_1=k(item("name_1")), customer_name_2=k(item("name_2")),
        customer_full_name=name_concat(item("name_1"), item("name_2")), customer_short_name=k(item("short_name")),
        gender=k("gender"), born=as_date("date_of_birth"))
    txn = _newest(ctx.pull("transaction"), "n", txn_desc=k("stmt_narr"))
    company = _newest(ctx.pull("company"), "o", mnemonic=blank_null("mnemonic"))
    gic = _newest(ctx.pull("gic_id"), "g", gic_text=k(item("description")))
    activity = _newest(ctx.dim("acct_activity"), "v", [k("recid")], part(k("recid"), "-", 1),
                       avg_balance=money(item("balance")))
    teller = ctx.dim("teller").select(k("recid").alias("w_key"),
                                      F.coalesce(blank_null(item("narrative_1")), k(item("narrative_2"))).alias("teller_text"))
    out = entry.join(large, C("acct") == C("t_key")).drop("t_key")
    debit, credit, side = dr_cr(C("amt"))
    out = out.select(
        "acct", "acct_total", "entry_cnt", k("transaction_code").alias("txn_code"), k("trans_reference").alias("trans_ref"),
        as_date("value_date").alias("value_date"), as_date("booking_date").alias("operation_date"),
        F.abs("amt").alias("amount"), debit.alias("dr_amount"), credit.alias("cr_amount"),
        side.alias("debit_credit_indicator"), k("system_id").alias("system"), k(item("narrative")).alias("entry_text"),
        k("company_code").alias("company_code"), k("recid").alias("transaction_id"),
        k("currency").alias("transaction_currency"), money("amount_fcy").alias("amount_ref_currency"))
    out = _enrich(out, account, "a", C("acct"))
    out = _enrich(out, activity, "v", C("acct"))
    out = _enrich(out, customer, "c", C("customer_no"))
    out = _enrich(out, txn, "n", C("txn_code"))
    bare_ref = k(F.split_part(F.split_part("trans_ref", F.lit(";"), F.lit(1)), F.lit("\\"), F.lit(1)))
    out = _enrich(out, teller, "w", F.when(C("system") == "TT", bare_ref), sparse=True)
    out = _enrich(out, _documents(ctx, "d"), "d", F.concat(F.lit(specs.LEGAL_DOC_LOOKUP), C("doc_code")))
    out = _enrich(_enrich(out, gic, "g", C("doc_code")), company, "o", C("company_code"))
    blank_entry = F.coalesce(C("entry_text"), F.lit("")) == ""
    gap = null_of("string")
    return _with_day(ctx, out.select(
        C("acct").alias("account_number"), name_concat(C("account_title_1"), C("short_title")).alias("acct_name"),
        "open_date", "customer_no", _named("cust_name"), "occupation", C("legal_id").alias("tin_id"),
        F.coalesce(blank_null("d_text"), C("gic_text")).alias("legal_type"), "txn_code", "txn_desc", "trans_ref",
        "value_date", "amount", "dr_amount", "cr_amount",
        F.when((C("system") == "TT") & blank_entry, C("teller_text")).otherwise(C("entry_text")).alias("narrative"),
        "working_balance", "avg_balance", "company_code", "entry_cnt", "acct_total", "transaction_id",
        C("txn_code").alias("application_id"), C("company_code").alias("branch_code"),
        F.coalesce("mnemonic", "company_code").alias("branch_name"), C("acct").alias("account_id"),
        C("customer_no").alias("account_customer_id"), "operation_date", "transaction_currency", "amount_ref_currency",
        "debit_credit_indicator", gap.alias("back_office_name"), C("operation_date").alias("transaction_approval_timestamp"),
        compact_date("operation_date").alias("dir0"), "account_title_1", "account_title_2", "short_title",
        "account_category", "account_currency", "customer_id", "customer_name_1", "customer_name_2",
        _named("customer_full_name"), "customer_short_name", "legal_id", C("doc_code").alias("legal_doc_type"),
        null_of("date").alias("legal_doc_expiry_date"), "gender", C("born").alias("birth_or_incorp_date"),
        gap.alias("customer_type")))


def _netted(ctx: Context, cols: Sequence[Column]) -> DataFrame:
    """Detail entries behind the netted ones (marked with '!')."""
    parent = ctx.dim("stmt_entry").filter(C("recid").contains("!")).select(
        k("recid").alias("parent_id"), k("account_number").alias("parent_account"))
    xref = ctx.dim("stmt_entry_detail_xref").select(k("recid").alias("x_id"), k("detail_id").alias("x_detail"))
    detail = ctx.dim("stmt_entry_detail").select(k("recid").alias("detail_key"), *cols)
    return (parent.join(xref, C("parent_id") == C("x_id"))
            .join(detail, C("x_detail") == C("detail_key")))


def opened_accounts(ctx: Context) -> DataFrame:
    """Accounts opened (on the target date, when given) with the first positive deposit."""
    amount, booked = money("amount_lcy").alias("amount_lcy"), as_date("booking_date").alias("booked")
    plain = ctx.dim("stmt_entry").filter(~C("recid").contains("!")) \
        .select(k("account_number").alias("acct"), amount, booked, k("recid").alias("entry"))
    netted = _netted(ctx, [amount, booked]).select(C("parent_account").alias("acct"), "amount_lcy", "booked",
                                                   C("detail_key").alias("entry"))
    first = earliest(plain.unionByName(netted).filter(C("amount_lcy") > 0), [C("acct")], [C("booked"), C("entry")],
                     {"first_deposit_amt": C("amount_lcy")}, ["f_key"])
    customer = _newest(
        ctx.versions("customer"), "c",
        cus_name=F.trim(F.concat_ws(" ", k("title"), k(item("name_1")), k(item("name_2")), k(item("short_name")))),
        doc_1=k(item("legal_doc_name")), doc_2=k(item("legal_doc_name", 1)), ident_doc_no=k(item("legal_id")),
        alter_id_no=k(item("legal_id", 1)), pep=k("pep"),
        dob=F.coalesce(as_date("birth_incorp_date"), as_date("date_of_birth")), nationality=k("nationality"),
        birth_country=k("cust_birth_country"), address=k(item("street")), occupation=k(item("occupation")))
    company = _newest(ctx.pull("company"), "o", branch_name=k(item("company_name")))
    account = ctx.dim("account")
    if ctx.target_date:
        account = account.filter(as_date("opening_date") == F.lit(ctx.target_date).cast("date"))
    account = account.select(
        k("co_code").alias("branch_no"), k("recid").alias("acct_no"), k("customer").alias("cus_no"),
        as_date("opening_date").alias("open_acct_date"), money("working_balance").alias("acct_bal"),
        k("currency").alias("account_ccy"), later("date_last_cr_cust", "date_last_dr_cust").alias("last_txn_date"))
    out = _enrich(account, first, "f", C("acct_no"))
    out = _enrich(_enrich(out, customer, "c", C("cus_no")), company, "o", C("branch_no"))
    prefix = F.lit(specs.LEGAL_DOC_LOOKUP)
    out = _enrich(out, _documents(ctx, "d"), "d", F.concat(prefix, C("doc_1")))
    out = _enrich(out, _documents(ctx, "e"), "e", F.concat(prefix, C("doc_2")))
    return _with_day(ctx, out.select(
        "branch_no", "branch_name", "acct_no", "cus_no", _named("cus_name"), "open_acct_date", k("d_text").alias("ident_doc_type"),
        "ident_doc_no", k("e_text").alias("alter_id_type"), "alter_id_no", "pep", "dob", "nationality", "birth_country",
        "address", "occupation", "acct_bal", "first_deposit_amt", "account_ccy", "last_txn_date",
        null_of("date").alias("process_date")))


def written_off_loans(ctx: Context) -> DataFrame:
    """Arrangements with any write-off activity."""
    history = ctx.dim("aa_activity_history")
    driver = (history.select(k("recid").alias("arrangement_id"), F.explode("activity").alias("act"))
              .filter(F.upper("act").startswith("LENDING-WRITE.OFF")).select("arrangement_id").distinct())
    arr = _newest(ctx.versions("aa_arrangement"), "a", [C("recid")], cust_id=k(item("customer")),
                  product_id=k("product_group"), currency=k("currency"))
    customer = _newest(ctx.versions("customer"), "c", customer_name=k(item("name_1")), officer=k("account_officer"))
    product = _newest(ctx.pull("aa_product"), "u", [C("recid")], product_desc=k(item("description")))
    account = _newest(ctx.dim("aa_arr_account"), "n", [C("recid")], _arrangement_of(), reference=k("account_reference"))
    party = _newest(ctx.dim("aa_arr_customer"), "p", [C("recid")], _arrangement_of(), group_id=k("group_id"))
    adjust = (ctx.dim("aa_arr_balance_maintenance").groupBy(_arrangement_of().alias("b_key"))
              .agg(F.sum(money("net_adjust_amt")).alias("wof_balance")))
    group = _newest(ctx.pull("mcb_group"), "g", [C("recid")], group_name=C("g_name"))
    process = _newest(ctx.dim("aa_process_details"), "r", [C("recid")], _arrangement_of(), wof_process_ref=C("property"))
    activity = _newest(history, "h", [k(item("contract_id"))], k(item("contract_id")),
                       wof_activity_date=item("act_date").cast("string"), wof_type=k(item("activity")),
                       loan_amount=money(item("activity_amt")))
    image = _newest(ctx.dim("account_his"), "i", [C("curr_no").try_cast("int")], part("recid", ";", 1),
                    his_officer=blank_null("account_officer"))
    out = driver
    for dim, prefix in ((arr, "a"), (account, "n"), (party, "p"), (adjust, "b"), (process, "r"), (activity, "h")):
        out = _enrich(out, dim, prefix, C("arrangement_id"))
    out = _enrich(_enrich(out, customer, "c", C("cust_id")), product, "u", C("product_id"))
    out = _enrich(_enrich(out, group, "g", C("group_id")), image, "i", F.lpad("reference", 14, "0"), sparse=True)
    account_id = F.coalesce("reference", "arrangement_id")
    money_gap, gap = null_of("decimal(18,2)"), null_of("string")
    started = F.trim("wof_activity_date")
    return _with_day(ctx, out.select(
        "arrangement_id", "cust_id", "customer_name", F.coalesce("his_officer", "officer").alias("acct_dao"), "group_id",
        "group_name", account_id.alias("account_id"), "product_id", "product_desc", "currency", "loan_amount",
        null_of("date").alias("date_disb"), "wof_activity_date", "wof_type", "wof_balance", "wof_process_ref",
        *[money_gap.alias(n) for n in ("current_balance", "total_arrears", "total_penalty")],
        null_of("int").alias("days_in_arrears"), money_gap.alias("provision_amt"),
        F.lit(ctx.target_date).cast("date").alias("load_date"),
        F.when(F.length(started) >= 4, F.substring(started, 1, 4)).alias("year_of_write_off"), gap.alias("branch"),
        gap.alias("branch_name"), account_id.alias("original_loan_id"), money_gap.alias("principal_interest"),
        money_gap.alias("balance_principal_interest_penalty"), C("wof_balance").alias("total_write_off"),
        gap.alias("type_period"), gap.alias("load_date_label")))


def account_statement(ctx: Context) -> DataFrame:
    """Statement lines with running balance from the brought-forward balance."""
    cols = [as_date("value_date").alias("value_date"), as_date("booking_date").alias("booking_date"),
            k("transaction_code").alias("transaction_code"), C("narrative"), k("trans_reference").alias("trans_reference"),
            F.coalesce(blank_null("amount_fcy"), C("amount_lcy").cast("string")).try_cast("decimal(18,2)").alias("amount"),
            blank_null("currency").alias("entry_ccy"), k("system_id").alias("system_id"),
            k(item("inputter")).alias("inputter_user")]
    plain = ctx.dim("stmt_entry").filter(~C("recid").contains("!")).select(
        k("account_number").alias("account_number"), k("recid").alias("stmt_entry_id"), *cols)
    netted = _netted(ctx, cols).withColumnsRenamed({"parent_account": "account_number", "detail_key": "stmt_entry_id"}) \
        .drop("parent_id", "x_id", "x_detail")
    entries, order = plain.unionByName(netted), ["booking_date", "stmt_entry_id"]
    booked = ctx.dim("stmt_entry").select(k("account_number").alias("account_number"), as_date("booking_date").alias("booking_date"),
                                          k("recid").alias("stmt_entry_id"))
    hot = ctx.hot and slices(entries, ["account_number"], order, sample=booked)
    entries = running_sum(entries, ["account_number"], order, "amount", "run", hot)
    entries = group_stats(entries, ["account_number"], {"period_total": F.sum("amount")}, hot)
    opening = _newest(ctx.versions("account_statement"), "b", bfwd_balance=money("fqu1_last_balance"))
    account = ctx.dim("account").select(
        k("recid").alias("a_key"), k("currency").alias("acct_ccy"), k(item("short_title")).alias("account_short_title"),
        k("customer").alias("customer_id"), k("co_code").alias("co_code")).filter(C("a_key").isNotNull())
    customer = _newest(ctx.versions("customer"), "c", customer_short_name=k(item("short_name")))
    txn = _newest(ctx.versions("transaction"), "n", description=k("stmt_narr"))
    system = ctx.dim("eb_system_id").select(k("recid").alias("s_key"), k("application").alias("drilldown_application"))
    printed = _newest(ctx.versions("stmt_printed"), "p", [k("recid")], last_printed_entry_no=k("stmt_entry_no"))
    sms = _newest(ctx.versions("company_sms_group"), "m", sms_group_description=item("description"))
    user = _newest(ctx.versions("user"), "u", inputter_user_name=k("user_name"))
    forward = (ctx.dim("ac_stmt_parameter").filter(k("recid") == "SYSTEM")
               .agg(F.max(F.struct("curr_no", k("fwd_mvmt_reqd").alias("f")))["f"]).scalar())
    # what an account looks up is joined to accounts: entries are many more and shuffled by account only
    account = _enrich(_enrich(account, customer, "c", C("customer_id")), sms, "m", C("co_code"))
    out = entries
    for dim, prefix in ((opening, "b"), (account, "a"), (printed, "p")):
        out = _enrich(out, dim, prefix, C("account_number"))
    out = _enrich(_enrich(out, txn, "n", C("transaction_code")), system, "s", C("system_id"))
    out = _enrich(out, user, "u", C("inputter_user"))
    return out.select(
        "account_number", "stmt_entry_id", "bfwd_balance", "value_date", "booking_date", "transaction_code", "description",
        "narrative", "trans_reference", "amount", F.coalesce("entry_ccy", "acct_ccy").alias("currency"),
        "account_short_title", "customer_id", "customer_short_name",
        F.when(F.coalesce("customer_id", F.lit("")) != "", C("customer_short_name"))
        .otherwise(C("account_short_title")).alias("display_name"), "drilldown_application",
        (C("bfwd_balance") + C("run")).cast("decimal(28,2)").alias("running_balance"),
        (C("bfwd_balance") + C("period_total")).cast("decimal(28,2)").alias("period_end_total"), "last_printed_entry_no",
        forward.alias("stmt_fwd_mvmt_reqd"), "sms_group_description", "inputter_user_name")


def statement_book(ctx: Context) -> DataFrame:
    """Statement book: amount in the company's currency, running balance, totals by side."""
    company = _newest(ctx.versions("company"), "o", company_name=k(item("company_name")), comp_ccy=k("local_currency"))
    category = _newest(ctx.versions("category"), "g", category_name=k(item("short_name")))
    customer = _newest(ctx.versions("customer"), "c", customer_short_name=k(item("short_name")), customer_name=k(item("name_1")),
                       town=k("suburb_town"), city=k("city_municipal"), province=k("province_state"))
    district = _newest(ctx.versions("cus_dist"), "d", dist_name=k(item("dist_name")))
    subdistrict = _newest(ctx.versions("cus_subdist"), "e", subdist_name=k("district_id"))
    village = _newest(ctx.versions("cus_vill"), "v", [k("recid")], vill_name=k("subdistrict_id"))
    printed = _newest(ctx.versions("acct_stmt_print"), "p", [k("recid")], stmt_print_balance=money("stmt_date_bal"))
    sub = _newest(ctx.versions("ac_sub_account"), "u", [k("recid")], sub_account_ref=k("sub_account"))
    # what an account looks up is joined to accounts: entries are many more and shuffled by account only
    account = ctx.dim("account").select(
        k("recid").alias("a_key"), k("co_code").alias("co_code"), k("customer").alias("customer_id"),
        C("category").try_cast("bigint").cast("string").alias("category"), k(item("alt_acct_id", 1)).alias("iban"))
    account = account.filter(C("a_key").isNotNull())
    account = _enrich(_enrich(account, company, "o", C("co_code")), category, "g", C("category"))
    account = _enrich(_enrich(account, customer, "c", C("customer_id")), district, "d", C("town"))
    account = _enrich(_enrich(account, subdistrict, "e", C("city")), village, "v", C("province"))
    account = _enrich(_enrich(account, printed, "p", C("a_key")), sub, "u", C("a_key"))
    account = account.drop("co_code", "category", "town", "city", "province")
    entry = ctx.dim("stmt_entry").select(
        k("account_number").alias("account"), k("recid").alias("entry_id"), as_date("booking_date").alias("post_date"),
        as_date("value_date").alias("value_date"), k("trans_reference").alias("trans_ref"), "narrative",
        k("transaction_code").alias("txn_code"), k("their_reference").alias("their_reference"),
        k("system_id").alias("system_id"), k("currency").alias("ccy"), money("amount_lcy").alias("lcy"),
        money("amount_fcy").alias("fcy"))
    # a sweep is looked up while rows are narrow; how often it is there is kept, as its rows must not enter the sums
    swept = F.when(C("system_id").isin("ACCP", "ACSW"), F.concat("trans_ref", F.lit("-SW")))
    sweep = ctx.dim("ac_account_sweep_hist").groupBy(k("recid").alias("w_key")).agg(F.count(F.lit(1)).cast("int").alias("sweeps"))
    priced = _enrich(_enrich(entry, sweep, "w", swept, sparse=True), account, "a", C("account"))
    home = F.substring("comp_ccy", 1, 3) == F.substring("ccy", 1, 3)
    priced, order = priced.withColumn("amount", F.when(home, C("lcy")).otherwise(C("fcy"))), ["post_date", "entry_id"]
    hot = ctx.hot and slices(priced, ["account"], order, sample=entry)
    priced = running_sum(priced, ["account"], order, "amount", "running_balance", hot)
    debit, credit, _ = dr_cr(C("amount"), zero=False)
    priced = group_stats(priced, ["account"], {
        "total_dr_amt": F.sum(debit), "total_cr_amt": F.sum(credit),
        "dr_txn_count": F.count(F.when(C("amount") < 0, 1)), "cr_txn_count": F.count(F.when(C("amount") > 0, 1)),
        "balance_at_period_end": F.sum("amount")}, hot)
    txn = _newest(ctx.versions("transaction"), "n", transaction_narrative=k("stmt_narr"))
    system = _newest(ctx.versions("eb_system_id"), "s", [k("recid")], base_appl=k("application"))
    owner = _newest(ctx.versions("mnemonic_company"), "m", [k("recid")], mnemonic_company_ref=k("company"))
    purge = ctx.dim("archive").filter(k("recid") == "STATEMENT").agg(F.max(as_date("purge_date"))).scalar()
    out = _enrich(_enrich(priced, txn, "n", C("txn_code")), system, "s", C("system_id"))
    out = _enrich(out, owner, "m", C("system_id"))
    out = out.withColumn("sweep_ref", F.explode(F.array_repeat(F.when(C("sweeps").isNotNull(), swept), F.coalesce("sweeps", F.lit(1)))))
    gap, money_gap = null_of("string"), null_of("decimal(18,2)")
    return out.select(
        "account", gap.alias("original_acct"), gap.alias("auto_pay_acct"), "category_name", "iban", "customer_id",
        "customer_short_name", "customer_name", "company_name", "comp_ccy",
        F.concat_ws(", ", "dist_name", "subdist_name", "vill_name").alias("customer_address_district"),
        money_gap.alias("opening_balance"), money_gap.alias("locked_amount"), "post_date", "trans_ref",
        "transaction_narrative", "narrative", "value_date", "amount", debit.alias("dr_amt"), credit.alias("cr_amt"),
        C("running_balance").cast("decimal(28,2)").alias("running_balance"), "their_reference", "system_id", "base_appl",
        "total_dr_amt", "total_cr_amt", "dr_txn_count", "cr_txn_count", "balance_at_period_end", "dist_name",
        "subdist_name", "vill_name", "sweep_ref", purge.alias("archive_purge_date"), "stmt_print_balance",
        "sub_account_ref", "mnemonic_company_ref")


def trial_balance_detail(ctx: Context) -> DataFrame:
    """Ledger lines of the day; a detail line belongs to the header line below it."""
    cols = ("line_code", "description", "opening_balance", "debit_movements", "credit_movements", "closing_balance",
            "source_file", "branch", "file_type", "line_seq", "business_date")
    lines = ctx.pull("ledger_gl").select(*cols).unionByName(ctx.pull("ledger_pl").select(*cols))
    lines = lines.select(
        C("business_date").alias("load_date"), F.regexp_replace("branch", "^.*_", "").alias("branch_name"),
        company_of_branch("branch").alias("co_code"), F.regexp_replace("file_type", "^.*_", "").alias("statement_type"),
        "source_file", "line_seq", F.nullif(C("line_code").cast("string"), F.lit("")).alias("original_line"),
        "description", "opening_balance", "debit_movements", "credit_movements", "closing_balance")
    files = ["load_date", "branch_name", "statement_type", "source_file"]
    lines = parent_below(lines, files, "line_seq", "original_line", "parent_line", ctx.hot)
    kind = part("description", ".", 1)

    def piece(pl: int, ac: int | None) -> Column:
        value = F.when(kind == "PL", part("description", ".", pl))
        if ac is not None:
            value = value.when(kind == "AC", part("description", ".", ac))
        return F.nullif(F.when(C("original_line").isNull(), value), F.lit(""))

    return lines.select(
        "load_date", "branch_name", "co_code", "statement_type", "source_file", "line_seq", "original_line", "parent_line",
        "description", "opening_balance", "debit_movements", "credit_movements", "closing_balance",
        piece(3, 5).alias("product_key"), piece(9, 10).alias("loan_aging_status"), piece(2, None).alias("pl_account"))

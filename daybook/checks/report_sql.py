"""DuckDB statements giving the expected rows of credit, operational, AML and treasury reports."""

from __future__ import annotations

from daybook import specs
from daybook.checks.bank_views import BUSINESS_DATE, duck_views
from daybook.checks.silver_sql import D, SILVER

DAY = BUSINESS_DATE
MONTHS = list(zip(specs.MONTH_TAGS, range(1, 13)))


def values(rows, names: str) -> str:
    cells = ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in r) + ")"
                      for r in rows)
    return f"(values {cells}) as t({names})"


def over_marts(marts: str, body: str) -> str:
    """Statement over expected mart rows ``m_<mart>``."""
    needed = []
    for mart in marts.split():
        needed += [v for v in SILVER[mart][0].split() if v not in needed]
    chain = ",\n".join(f"m_{mart} as ({SILVER[mart][1].strip()})" for mart in marts.split())
    return f"with {duck_views(needed)},\n{chain}\nselect * from ({body.strip()})"


def label(expr: str) -> str:
    """'1st January 2026' in DuckDB."""
    n = f"day({expr})"
    return (f"(cast({n} as varchar) || case when {n} in (11, 12, 13) then 'th' when {n} % 10 = 1 then 'st' when {n} % 10 = 2 then 'nd' "
            f"when {n} % 10 = 3 then 'rd' else 'th' end || ' ' || monthname({expr}) || ' ' || year({expr}))")


BRANCH = values(specs.BRANCHES, "co, branch, seq")
PRODUCT = values(specs.LOAN_PRODUCTS, "cat, product, pno")
SECTOR = values(specs.SECTORS, "sec, name")
TOWN = values(list(specs.BRANCH_MUNICIPALITY.items()), "co, town")
TOWNS = values(specs.MUNICIPALITIES, "so, town")

GRANTED = f"""
l as (select year(r.opening_date) as y, month(r.opening_date) as mo, r.company_code as co, cast(r.category as varchar) as cat, r.loan_id, a.commitment_amt as amt
      from m_loan_risk r left join m_lending_arrangements a on trim(a.arrangement) = r.arrangement_id where r.opening_date is not null),
g as (select y, b.*, p.* from (select distinct y from l) cross join (select * from {BRANCH}) b cross join (select * from {PRODUCT}) p)"""

CONSOLIDATION = f"""
with {GRANTED},
rows as (
  select g.y as report_year, g.seq as branch_seq, g.branch as "Branch", g.pno as "Credit_Product_No", g.product as "Credit_Product",
    {', '.join(f"coalesce(sum(amt) filter (mo = {n}), 0) as amount_{t}" for t, n in MONTHS)},
    {', '.join(f"count(distinct loan_id) filter (mo = {n}) as acct_{t}" for t, n in MONTHS)},
    coalesce(sum(amt), 0) as amount_total, {' + '.join(f"count(distinct loan_id) filter (mo = {n})" for _, n in MONTHS)} as account_total
  from g left join l on l.y = g.y and l.co = g.co and l.cat = g.cat group by 1, 2, 3, 4, 5),
al as (select * from rows union all
  select report_year, branch_seq, "Branch", null, 'TOTAL', {', '.join(f"sum(amount_{t})" for t, _ in MONTHS)},
    {', '.join(f"sum(acct_{t})" for t, _ in MONTHS)}, sum(amount_total), sum(account_total) from rows group by 1, 2, 3)
select report_year::integer as report_year, branch_seq, "Branch", "Credit_Product_No", "Credit_Product", ("Credit_Product" = 'TOTAL')::integer as is_total_row,
  {', '.join(f"amount_{t}::double as amount_{t}, acct_{t}::bigint as acct_{t}" for t, _ in MONTHS)}, amount_total::double as amount_total,
  account_total::bigint as account_total, 'CURR' as type_period, cast(report_year as varchar) as report_year_label from al"""

MONTHLY = f"""
with {GRANTED},
rows as (select g.y, g.seq, m.mo, g.branch, g.pno, g.product, coalesce(sum(l.amt), 0) as amt, count(distinct l.loan_id) as n
  from g cross join (select unnest(range(1, 13)) as mo) m left join l on l.y = g.y and l.co = g.co and l.cat = g.cat and l.mo = m.mo group by all),
al as (select * from rows union all select y, seq, mo, branch, null, 'TOTAL', sum(amt), sum(n) from rows group by y, seq, mo, branch)
select y::integer as report_year, seq as branch_seq, mo::integer as report_month, branch as "Branch", pno as "Credit_Product_No", product as "Credit_Product",
  (product = 'TOTAL')::integer as is_total_row, null::double as monthly_target, amt::double as total_disbursement, n::bigint as total_clients,
  null::double as variance, null::double as pct, 'CURR' as type_period, monthname(make_date(2000, mo::integer, 1)) || ' ' || y as report_period_label from al"""

_SECTOR_BASE = "select coalesce(credit_by_sector, 10) as sec, auto_class, abs(loan_outstanding) as bal, opening_date from m_loan_risk where currency = 'USD' and loan_outstanding <> 0"
SECTOR_DAILY = f"""
with b as ({_SECTOR_BASE}),
rows as (select s.sec, s.name, {', '.join(f"coalesce(sum(bal) filter (auto_class = '{c}'), 0) as {n}" for n, c in specs.ASSET_CLASSES.items())}
  from (select * from {SECTOR}) s left join b on b.sec = s.sec group by 1, 2),
al as (select * from rows union all select 0, 'Grand Total', {', '.join(f"sum({n})" for n in specs.ASSET_CLASSES)} from rows)
select '{DAY}' as load_date, sec as credit_by_sector, name as naran_sector, {', '.join(f"{n}::decimal(18,2) as {n}" for n in specs.ASSET_CLASSES)},
  'CURR' as type_period, {label(D)} as load_date_label from al"""

_YM = [("month_dec_prior", "year(opening_date) = y - 1 and month(opening_date) = 12")] + [
    (f"month_{t}", f"year(opening_date) = y and month(opening_date) = {n}") for t, n in MONTHS[:11]]
SECTOR_YEARLY = f"""
with b as ({_SECTOR_BASE}), ys as (select distinct year(opening_date) as y from b),
rows as (select y, s.sec, s.name, {', '.join(f"coalesce(sum(bal) filter ({c}), 0) as {n}" for n, c in _YM)}
  from ys cross join (select * from {SECTOR}) s left join b on b.sec = s.sec and year(b.opening_date) between y - 1 and y group by 1, 2, 3),
al as (select * from rows union all select y, 0, 'Grand Total', {', '.join(f"sum({n})" for n, _ in _YM)} from rows group by y)
select y || '-12-31' as load_date, sec as credit_by_sector, name as naran_sector, {', '.join(f"{n}::decimal(18,2) as {n}" for n, _ in _YM)},
  'CURR' as type_period, {label("make_date(y::integer, 12, 31)")} as load_date_label from al"""

_BRANCH_JOIN = f"left join (select * from {BRANCH}) b on b.co = r.company_code"
PROVISION = f"""
with r as (select *, (select max(last_date_cr) from m_loan_risk) as as_of from m_loan_risk where base_amount is not null)
select cast(r.loan_id::bigint as varchar) as loan_id, r.loan_id as original_loan_id, r.arrangement_id, r.company_code as branch_code, coalesce(b.branch, r.company_code) as branch_name,
  r.customer_number as cust_number, replace(r.customer_name, 'da Cruz da Cruz', 'da Cruz') as customer_name, cast(r.category as varchar) as category, r.product_name, r.currency, r.auto_class as classification,
  r.loan_outstanding::double as local_ccy_amt, r.base_amount::double as base_amount, r.loan_outstanding::double as outstanding, r.opening_date as value_date,
  coalesce(r.commitment, 0)::double as commitment, r.opening_date as start_date, r.maturity_date as mat_date,
  abs(r.base_amount::double) * case r.auto_class when 'LOSS' then 1 when 'DOUBTFUL' then 0.5 when 'SUB-STANDARD' then 0.25 else 0 end::double as provision,
  r.arrangement_status as status, r.mobile_phone as phone_number, cast(as_of as varchar) as load_date, 'CURR' as type_period, {label('as_of')} as load_date_label
from r {_BRANCH_JOIN}"""

REPAYMENT = f"""
select r.loan_id, r.loan_id as original_loan_id, r.loan_id as original_id, cast(r.loan_id::bigint as varchar) as loan_id2, cast(r.category as varchar) as category, r.product_name,
  r.customer_number as cust_number, r.account_officer, r.currency as ccy, r.auto_class as classification, abs(r.loan_outstanding)::double as outstanding,
  r.provision_type as prov_type, abs(r.base_amount)::double as base_amount, coalesce(r.commitment, 0)::double as commitment, r.term, r.maturity_date,
  r.repayment_amount::double as last_instalment, r.last_date_cr as last_rep_date, r.opening_date as start_date, replace(r.customer_name, 'da Cruz da Cruz', 'da Cruz') as customer_name, r.company_code as branch_code,
  coalesce(b.branch, r.company_code) as branch_name, r.arrangement_id, r.legal_id, null::varchar as load_date, 'CURR' as type_period, null::varchar as load_date_label
from m_loan_risk r {_BRANCH_JOIN} where r.base_amount is not null"""

EXTRA = f"""
select row_number() over (order by w.account_id, w.arrangement_id) as nu, replace(w.customer_name, 'da Cruz da Cruz', 'da Cruz') as name, w.cust_id as cif_cid, w.acct_dao as branch,
  coalesce(b.branch, w.acct_dao) as branch_name, coalesce(w.product_desc, '') as credit_type, cast(try_cast(w.account_id as bigint) as varchar) as loan_id,
  w.account_id as original_loan_id, null::varchar as year_of_write_off, coalesce(abs(w.wof_balance), 0)::double as principal, 0::double as principal_interest,
  null::double as penalty_interest, coalesce(abs(w.wof_balance), 0)::double as balance_principal_interest_penalty, null::double as total_write_off,
  null::varchar as load_date, 'CURR' as type_period, null::varchar as load_date_label
from m_written_off_loans w left join (select * from {BRANCH}) b on b.co = w.acct_dao where w.loan_amount is not null"""


def _listing(rows: str, keys: str, total: str) -> str:
    return f"""with r as ({rows}), n as (select *, row_number() over (partition by {keys} order by account_no)::integer as row_no, 'DATA' as row_type from r)
select * from n union all by name select {total}, 'TOTAL' as account_no, 'TOTAL' as row_type from n group by {keys}"""


CLOSED_LIST = _listing(
    f"""select cast(close_date as varchar) as closure_date, id as account_no, branch_code as branch_no, coalesce(b.branch, branch_code) as branch_name,
  customer as customer_id, nullif(trim(acct_title), '') as cust_name, null::varchar as id_doc_type, null::varchar as id_doc_no, 1::decimal(18,2) as row_count
from m_closed_accounts left join (select * from {BRANCH}) b on b.co = branch_code""",
    "closure_date, branch_no", "closure_date, branch_no, sum(row_count)::decimal(18,2) as row_count")

OPENED_LIST = _listing(
    """select cast(opening_date as varchar) as opening_date, company as company_branch, account_number as account_no, company as branch_no, null::varchar as branch_name,
  customer_no as customer_id, trim(coalesce(name1, '') || ' ' || coalesce(name2, '') || ' ' || coalesce(short_name, '')) as cust_name, legal_doc_name as id_doc_type,
  legal_id as id_doc_no, null::varchar as alter_id_type, null::varchar as alter_id_no, null::varchar as pep, cast(date_of_birth as varchar) as dob, nationality,
  birth_country, address, occupation, balance as acct_bal, 0::decimal(18,2) as first_deposit_amt from m_acct_cust""",
    "opening_date, company_branch",
    "opening_date, company_branch, sum(acct_bal)::decimal(18,2) as acct_bal, sum(first_deposit_amt)::decimal(18,2) as first_deposit_amt")

DEPOSIT_LIST = _listing(
    f"""select null::date as process_date, company as company_branch, account_number as account_no, cast(category as varchar) as prodcat, p.lbl as prod_name,
  customer_no as customer_id, short_name as cust_name, cast(opening_date as varchar) as opening_date, null::varchar as maturity_date,
  cast(date_of_birth as varchar) as dob, balance as acct_bal
from m_acct_cust join (select * from {values(list(specs.DEPOSIT_PRODUCTS.items()), 'cat, lbl')}) p on p.cat = cast(category as varchar)""",
    "process_date, company_branch", "process_date, company_branch, sum(acct_bal)::decimal(18,2) as acct_bal")

_SAVER = f"select a.*, coalesce(t.town, a.company) as town from m_acct_cust a left join (select * from {TOWN}) t on t.co = a.company where a.category = 6006 and a.balance > 0"
_AGES = [("age_0_5", "age <= 5"), ("age_6_10", "age between 6 and 10"), ("age_11_14", "age between 11 and 14"), ("age_over15", "age > 14")]
BY_AGE = f"""
with s as (select *, date_diff('year', date_of_birth, {D}) - if(strftime(date_of_birth, '%m%d') > strftime({D}, '%m%d'), 1, 0) as age from ({_SAVER})),
rows as (select m.so, m.town, {', '.join(f"count(account_number) filter ({c}) as {n}_count, coalesce(sum(balance) filter ({c}), 0) as {n}_amount" for n, c in _AGES)}
  from (select * from {TOWNS}) m left join s on s.town = m.town group by 1, 2),
al as (select * from rows union all select 99, 'TOTAL', {', '.join(f"sum({n}_count), sum({n}_amount)" for n, _ in _AGES)} from rows)
select '{DAY}' as load_date, so as sort_order, town as municipal, {', '.join(f"{n}_count::integer as {n}_count, {n}_amount::decimal(18,2) as {n}_amount" for n, _ in _AGES)},
  0::integer as inactive_count, 0::decimal(18,2) as inactive_amount, 0::integer as closed_count, 0::decimal(18,2) as closed_amount from al"""

_SEX = ("count(account_number) filter (upper(gender) = 'MALE') as mc, coalesce(sum(balance) filter (upper(gender) = 'MALE'), 0) as ma, "
        "count(account_number) filter (upper(gender) = 'FEMALE') as fc, coalesce(sum(balance) filter (upper(gender) = 'FEMALE'), 0) as fa")
BY_GENDER = f"""
with s as ({_SAVER}),
rows as (select 'MAIN' as rt, m.so, m.town, {_SEX} from (select * from {TOWNS}) m left join s on s.town = m.town group by 1, 2, 3),
al as (select * from rows union all select 'MAIN', 99, 'TOTAL', sum(mc), sum(ma), sum(fc), sum(fa) from rows
  union all select 'NEW_ACCOUNTS', 0, 'Changes in the Period', {_SEX} from s where opening_date is not null
  union all select unnest(['CLOSED_TOTAL', 'CLOSED_AGE_LIMIT', 'CLOSED_OTHER']), 0, 'Changes in the Period', 0, 0, 0, 0)
select '{DAY}' as load_date, rt as row_type, so as sort_order, town as municipal, mc::integer as male_count, ma::decimal(18,2) as male_amount,
  fc::integer as female_count, fa::decimal(18,2) as female_amount, (mc + fc)::integer as total_count, (ma + fa)::decimal(18,2) as total_amount from al"""

CONTACTS = f"""
with b as (select *, coalesce(nullif(name1, ''), nullif(short_name, '')) as nm from m_acct_cust)
select '{DAY}' as load_date, (row_number() over (order by nm nulls last, account_number))::integer as nu, nm as name, account_number, customer_no as customer_number,
  cast(opening_date as varchar) as registered_date, nullif(trim(email), '') as email, nullif(trim(sms), '') as contact_number, null::varchar as obs,
  company as branch_code, coalesce(t.town, company) as municipal, cast(category as varchar) as product_code
from b left join (select * from {TOWN}) t on t.co = company"""


def _hash(*cols: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in cols) + ")"


LARGE_REPORT = f"""
with u as (select *, sum(abs(amount)) over (partition by account_id, operation_date) as day_total from m_large_daily_txn where transaction_currency = 'USD')
select {_hash('account_id', 'operation_date', 'transaction_id')} as report_id, cast(operation_date as varchar) as txn_date, account_id as acc_number, acct_name as acc_name,
  coalesce(nullif(trim(txn_desc), ''), application_id) as type_of_tranzation, amount::double as amount, branch_name as branch, dir0 from u where day_total >= 9000"""

INACTIVE_REPORT = f"""
select {_hash('account_id', 'dir0')} as report_id, branch_name, account_id as account_number, customer_id as customer_number, customer_full_name as customer_name,
  account_currency as account_ccy, cast(last_transaction_date as varchar) as last_txn_date, working_balance::double as acc_balance,
  cast(opening_date as varchar) as acc_open_date, dir0 from m_inactive_accounts"""

DOCUMENT_REPORT = f"""
select {_hash('customer_id', 'account_id', 'dir0')} as report_id, branch_name, customer_id as customer_number, account_id as account_number, customer_full_name as customer_name,
  cast(birth_or_incorp_date as varchar) as date_of_birth, cast(opening_date as varchar) as acc_open_date, legal_doc_type as id_doc_type, legal_id as id_doc_number,
  cast(legal_doc_expiry_date as varchar) as expired_date_doc, dir0 from m_missing_documents"""

OPENED_REPORT = f"""
select {_hash('acct_no', 'cus_no', 'open_acct_date')} as report_id, branch_no as branch_number, branch_name, acct_no as account_number, cus_no as customer_number,
  cus_name as customer_name, cast(open_acct_date as varchar) as opening_date, ident_doc_type as id_doc_type, ident_doc_no as id_doc_number, alter_id_type,
  alter_id_no as alter_id_number, pep, cast(dob as varchar) as dob, nationality, birth_country, address, occupation, acct_bal::double as account_balance,
  first_deposit_amt::double as first_deposit_amount, strftime(open_acct_date, '%Y%m%d') as dir0 from m_opened_accounts"""

REMIT_DAILY = "select " + ", ".join(f'{c} as "{shown}"' for shown, c in (
    ("NO", "row_no"), ("DATE TRANSFER", "date_transfer"), ("TRANSACTION REF", "transaction_ref"), ("REF NUMBER", "ref_number"),
    ("ORDERING CUSTOMER", "ordering_customer"), ("ORDERING CUSTOMER ACC NO", "ordering_customer_acc_no"), ("SENDER BIC", "sender_bic"),
    ("ORIGIN OF COUNTRY", "origin_of_country"), ("DEBIT ACCOUNT", "debit_account"), ("BENEFICIARY", "beneficiary"), ("GENDER", "gender"),
    ("CREDIT ACCOUNT", "credit_account"), ("DEBIT CCY", "debit_ccy"), ("DEBIT AMOUNT", "debit_amount"), ("CHARGE CCY", "charge_ccy"),
    ("CHARGES", "charges"), ("CREDIT CCY", "credit_ccy"), ("CREDIT AMOUNT", "credit_amount"), ("RATE", "rate"), ("REMARK", "remark"),
    ("REMITTANCE INFORMATION", "remittance_information"), ("report_date", "value_date"))) + " from m_inward_remittance"

REMIT_QUARTERLY = f"""
with a as (select month(date_transfer) as n, count(distinct transaction_ref) as c, sum(credit_amount::decimal(18,2)) as v, sum(charges::decimal(18,2)) as f
           from m_inward_remittance where year(date_transfer) = {DAY[:4]} group by 1),
m as (select monthname(make_date(2000, i::integer, 1)) as "Month", coalesce(c, 0) as c, coalesce(v, 0) as v, coalesce(f, 0) as f
      from (select unnest(range(1, 13)) as i) left join a on a.n = i)
select "Month", c::bigint as "SWIFT Number", v::double as "Value (USD)", f::double as "Fees" from m
union all select 'TOTAL', sum(c)::bigint, sum(v)::double, sum(f)::double from m"""

BY_SECTOR = f"""
select s.recid as sector_code, s.description as sector_name, sum(d.local_ccy_amt)::decimal(28,2) as total_deposit_local, count(distinct d.account_number) as n_accounts,
  count(distinct c.recid) as n_customers, {D} as business_date
from b_crb_deposits d join b_account a on a.recid = d.account_number
join (select * from b_customer qualify row_number() over (partition by recid order by curr_no desc) = 1) c on c.recid = a.customer
join (select * from b_sector where business_date = {D} qualify row_number() over (partition by recid order by curr_no desc) = 1) s on s.recid = c.sector
where d.load_date = {D} group by 1, 2"""

BATCH = f"select recid, last_run_date, job_status, '{DAY}' as business_date, '7' as pinned_snapshot from b_batch where contains(recid, 'EXTRACT')"


def plain(views: str, body: str) -> str:
    return f"with {duck_views(views.split())}\nselect * from ({body.strip()})"


REPORTS = {
    "disbursement_consolidation": over_marts("loan_risk lending_arrangements", CONSOLIDATION),
    "monthly_disbursement": over_marts("loan_risk lending_arrangements", MONTHLY),
    "loan_sector_daily": over_marts("loan_risk", SECTOR_DAILY),
    "loan_sector_yearly": over_marts("loan_risk", SECTOR_YEARLY),
    "provision": over_marts("loan_risk", PROVISION),
    "repayment": over_marts("loan_risk", REPAYMENT),
    "extra_accountable": over_marts("written_off_loans", EXTRA),
    "closed_account_listing": over_marts("closed_accounts", CLOSED_LIST),
    "opened_account_listing": over_marts("acct_cust", OPENED_LIST),
    "deposit_listing": over_marts("acct_cust", DEPOSIT_LIST),
    "savers_by_age": over_marts("acct_cust", BY_AGE),
    "savers_by_gender": over_marts("acct_cust", BY_GENDER),
    "contact_listing": over_marts("acct_cust", CONTACTS),
    "large_txn_report": over_marts("large_daily_txn", LARGE_REPORT),
    "inactive_account_report": over_marts("inactive_accounts", INACTIVE_REPORT),
    "missing_document_report": over_marts("missing_documents", DOCUMENT_REPORT),
    "opened_account_report": over_marts("opened_accounts", OPENED_REPORT),
    "remittance_daily": over_marts("inward_remittance", REMIT_DAILY),
    "remittance_quarterly": over_marts("inward_remittance", REMIT_QUARTERLY),
    "deposits_by_sector": plain("crb_deposits account customer sector", BY_SECTOR),
    "batch_marker": plain("batch", BATCH),
}

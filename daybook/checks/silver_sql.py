"""DuckDB statements giving the expected rows of the silver marts, written independently of them."""

from __future__ import annotations

from daybook.checks.bank_views import BUSINESS_DATE, duck_views

D = f"date '{BUSINESS_DATE}'"


def one(table: str, cols: str, key: str = "trim(recid)", order: str = "curr_no desc", where: str = "true") -> str:
    """Sub-select with one row per key."""
    return (f"(select {key} as k, {cols} from b_{table} where {where} "
            f"qualify row_number() over (partition by {key} order by {order}) = 1)")


def with_views(names: str, body: str, extra: str = "") -> str:
    """Statement over the named bank views, plus further common table expressions."""
    return f"with {duck_views(names.split())}{',' + extra if extra else ''}\n{body}"


DAY = f"business_date = {D}"
ACCT_CUST = f"""
select a.recid as account_number, cast(a.category as integer) as category, trim(a.customer) as customer_no, a.opening_date,
  coalesce(c.birth_incorp_date, c.date_of_birth) as date_of_birth, trim(c.name_1[1]) as name1, trim(c.name_2[1]) as name2,
  trim(c.short_name[1]) as short_name, a.working_balance as balance, a.co_code as company, a.gender, a.alt_acct_id[1] as iban,
  null::varchar as currency, null::decimal(18,6) as interest_rate, null::decimal(18,2) as interest_amount, null::date as value_date,
  null::date as maturity_date, null::varchar as branch_name, null::varchar as product_name, c.nationality, c.cust_birth_country as birth_country,
  coalesce(c.street[1], c.address[1], c.town_country[1]) as address, c.occupation[1] as occupation, c.legal_doc_name[1] as legal_doc_name,
  c.legal_id[1] as legal_id, c.email_1[1] as email, trim(c.sms_1[1]) as sms, c.phone_1[1] as phone, {D} as business_date
from b_account a left join {one('customer', '*')} c on c.k = trim(a.customer)
where a.category between '6006' and '6015' and length(trim(a.customer)) > 0"""

CLOSED = f"""
select lpad(x.k, 14, '0') as acct_id, x.customer_id as customer, trim(x.account_branch) as branch_code,
  h.title as acct_title, try_cast(h.category as integer) as category, h.currency as ccy, try_cast(h.acct_credit_int[1] as decimal(18,2)) as credit_int,
  h.working_balance as closing_bal, x.acct_close_date as close_date, x.closure_reason as close_reason_code, p.description[1] as close_reason,
  nullif(trim(h.arrangement_id), '') as arrangement_marker, x.k as id, {D} as business_date
from {one('account_closed', '*', order="(trim(account_branch) <> '') desc, business_date desc")} x
left join {one('posting_restrict', '*', where=DAY)} p on p.k = x.closure_reason
left join {one('account_his', "*, account_title_1[1] || ' ' || account_title_2[1] as title", "split_part(recid, ';', 1)", 'curr_no::int desc')} h on h.k = lpad(x.k, 14, '0')
where x.acct_close_date <= {D}"""

LOCKED = """
select e.trans_ref as transaction_ref, e.account_number as account, a.short_title[1] as name, e.description as reasons_for_locking,
  e.from_date, e.to_date, e.locked_amount, if(e.txn_sign = 'CR', 'CREDIT', 'DEBIT') as reservation_type
from b_ac_locked_events e left join b_account a on a.recid = e.account_number"""

BOOK = f"""
select e.recid as entry_id, e.src as source, cast(e.pl_category as integer) as category, g.short_name[1] as category_desc,
  trim(e.transaction_code) as transaction_code, t.stmt_narr as description, e.trans_reference as trans_ref, e.their_reference,
  e.value_date, e.booking_date as post_date, e.amount_lcy, if(e.value_date > {D}, '*', '') as forward_flag, e.account_number,
  e.company_code, e.customer_id, x.detail_id as detail_xref_id, e.currency, e.amount_fcy, null::varchar as product_name, null::varchar as customer_name
from (select * from (select *, 'LIVE' as src from b_categ_entry union all select *, 'ARCHIVE' from b_categ_entry_detail)
      qualify row_number() over (partition by recid order by src desc) = 1) e
left join {one('category', '*')} g on g.k = e.pl_category
left join {one('transaction', '*')} t on t.k = trim(e.transaction_code)
left join {one('categ_entry_detail_xref', '*', order='detail_id desc')} x on x.k = e.recid"""

_PROP = "split_part(split_part(recid, '-', 3), '.', 1) desc, recid desc"
_ARR = "split_part(recid, '-', 1)"
RISK = f"""
select p.recid as loan_id, cast(a.category as integer) as category, g.short_name[1] as product_name, p.customer as customer_number,
  o.name as account_officer, p.currency, p.auto_class, a.working_balance as loan_outstanding, p.calc_prov_type[1] as provision_type,
  p.calc_base_amt[1] as base_amount, m.amount as commitment, null::integer as term, d.maturity_date, d.arr_age_status as arrangement_status,
  coalesce(s.total, 0)::decimal(18,2) as repayment_amount, a.date_last_cr_auto as last_date_cr, a.opening_date, c.id_types as id_type,
  trim(c.name_1[1]) as customer_name, trim(c.name_2[1]) as customer_short_name, p.co_code as company_code, a.arrangement_id,
  c.legal_id[1] as legal_id, c.employ_name as employer_name, null::decimal(18,6) as interest_rate, null::decimal(18,2) as current_interest,
  null::decimal(18,2) as available_principal, c.occupation[1] as occupation, c.sp_name as spouse_name, c.tel_mobile as mobile_phone,
  null::varchar as name_credit_grantor, cast(e.credit_by_sector as integer) as credit_by_sector, null::varchar as manner_of_paymt,
  null::varchar as security, null::varchar as desc_of_collateral, {D} as business_date
from b_pv_asset_detail p join b_account a on a.recid = p.recid
left join {one('category', '*', where=DAY)} g on g.k = a.category
left join {one('customer', '*')} c on c.k = p.customer
left join {one('dept_acct_officer', '*', where=DAY)} o on o.k = c.account_officer
left join b_map_sector_credit e on e.sector_code = c.sector
left join b_aa_account_details d on d.recid = a.arrangement_id
left join (select {_ARR} as k, sum(calc_amount[2]) as total from b_aa_arr_payment_schedule where contains(recid, '-SCHEDULE-') group by 1) s on s.k = a.arrangement_id
left join {one('aa_arr_term_amount', '*', _ARR, _PROP, "contains(recid, '-COMMITMENT-')")} m on m.k = a.arrangement_id
where p.product_line = 'LENDING' and p.customer <> ''"""

ARRANGEMENTS = f"""
select lpad(r.recid, 17, ' ') as arrangement, coalesce(nullif(trim(p.dl_appl_id), ''), p.loan_appl_id) as appl_id, r.co_code,
  r.linked_appl_id[1] as account, r.customer[1] as customer, w.description[1] as customer_role, null::varchar as account_officer,
  u.description[1] as product_desc, p.group_id, g.g_name as group_name, r.customer[1] as owner, trim(c.name_1[1]) as owner_name,
  r.start_date, coalesce(l.rep_start_date, d.payment_start_date) as first_pay_date, d.maturity_date, t.term, r.currency,
  null::varchar as category_code, m.amount as commitment_amt, null::decimal(18,2) as totcommbal, null::decimal(18,2) as curraccbal,
  null::decimal(18,2) as due_today, b.total::decimal(28,2) as overdue, null::varchar as resch_ind,
  case r.arr_status when 'AUTH' then 'Not Disbursed' when 'CURRENT' then 'Current' when 'EXPIRED' then 'Expired'
    when 'PENDING.CLOSURE' then 'Pending Closure' else r.arr_status end as arr_status_disp, q.app_date as dl_app_date, {D} as business_date
from b_aa_arrangement r
left join b_aa_arr_customer p on {_ARR.replace('recid', 'p.recid')} = r.recid
left join {one('aa_arr_term_amount', '*', _ARR, _PROP, "contains(recid, '-TERM.AMOUNT-')")} t on t.k = r.recid
left join {one('aa_arr_term_amount', '*', _ARR, _PROP, "contains(recid, '-COMMITMENT-')")} m on m.k = r.recid
left join b_aa_account_details d on d.recid = r.recid
left join {one('customer', '*')} c on c.k = r.customer[1]
left join b_em_lo_application l on l.recid = p.loan_appl_id
left join b_em_dl_application q on q.recid = trim(p.dl_appl_id)
left join {one('mcb_group', '*', order='recid desc, g_name desc', where=DAY)} g on g.k = p.group_id
left join b_aa_customer_role w on w.recid = r.customer_role[1]
left join {one('aa_product', '*', order='recid desc, description[1] desc', where=DAY)} u on u.k = r.product_group
left join (select trim(arrangement_id) as k, sum(os_total_amount) as total from b_aa_bill_details group by 1) b on b.k = r.recid
where r.product_line = 'LENDING' and r.arr_status not in ('UNAUTH', 'CANCELLED', 'CLOSE', 'MATURED')"""

REMITTANCE = f"""
select null::integer as row_no, f.recid as transaction_ref, f.debit_their_ref as ref_number, f.ordering_cust[1] as ordering_customer,
  f.ord_cust_acct as ordering_customer_acc_no, f.inw_send_bic as sender_bic, null::varchar as origin_of_country, f.debit_acct_no as debit_account,
  x.short_title[1] as received_from, y.short_title[1] as beneficiary, null::varchar as gender, f.credit_acct_no as credit_account,
  if(f.debit_amount > 0, f.debit_amount, f.credit_amount)::double as amount, f.debit_currency as debit_ccy, f.debit_amount::double as debit_amount,
  left(f.total_charge_amt, 3) as charge_ccy, try_cast(substr(f.total_charge_amt, 4) as double) as charges, f.credit_currency as credit_ccy,
  try_cast(substr(f.amount_credited, 4) as double) as credit_amount, f.credit_value_date as value_date, f.processing_date as date_transfer,
  f.profit_centre_dept as profit_centre, null::double as rate, null::varchar as remark, null::varchar as remittance_information,
  null::varchar as ft_link, {D} as business_date
from b_funds_transfer f left join b_account x on x.recid = f.debit_acct_no left join b_account y on y.recid = f.credit_acct_no
where f.transaction_type = 'IT'"""

INACTIVE = f"""
with m as (select *, greatest(date_last_cr_cust, date_last_dr_cust) as lt from b_account where inactiv_marker = 'Y')
select m.co_code as company_id, m.co_code as company_code, o.company_name[1] as branch_name, m.recid as account_number, m.recid as account_id,
  trim(m.customer) as customer_number, trim(m.customer) as customer_id,
  trim(regexp_replace(concat_ws(' ', c.title, c.name_1[1], c.name_2[1], c.short_name[1]), '\\s+', ' ', 'g')) as customer_name,
  m.currency as account_currency, m.lt as last_transaction_date, m.working_balance as account_balance, m.working_balance,
  m.opening_date as account_open_date, m.opening_date, m.account_title_1[1] as account_title_1, trim(m.account_title_2[1]) as account_title_2,
  m.short_title[1] as short_title, m.category as account_category, m.date_last_cr_cust as last_credit_date, m.date_last_dr_cust as last_debit_date,
  cast({D} - m.lt as integer) as days_since_last_txn, m.inactiv_marker as inactive_marker, if({D} - m.lt >= 30, 'Y', 'N') as is_inactive_30_days,
  {D} as mis_date, '{BUSINESS_DATE.replace('-', '')}' as dir0, null::varchar as record_timestamp, c.short_name[1] as customer_short_name,
  trim(c.name_1[1]) as customer_full_name, c.legal_id[1] as legal_id, null::varchar as legal_doc_type, null::date as legal_doc_expiry_date,
  c.occupation[1] as occupation, c.gender, c.date_of_birth as birth_or_incorp_date, {D} as business_date
from m left join {one('company', '*', where=DAY)} o on o.k = m.co_code left join {one('customer', '*')} c on c.k = trim(m.customer)
where m.lt >= (select max(lt) - 30 from m)"""

DOCUMENTS = f"""
with c as (select *, concat_ws(' ', nullif(trim(title), ''), trim(name_1[1]), trim(name_2[1]), short_name[1]) as full_name from {one('customer', '*')})
select a.co_code as comp_id, o.company_name[1] as branch_name, c.k as customer_number, a.recid as account_number, c.full_name as customer_name,
  coalesce(c.date_of_birth, c.birth_incorp_date) as date_of_birth, a.opening_date as open_account_date,
  coalesce(l.description[1], g.description[1], c.legal_doc_name[1]) as id_doc_type, c.legal_id[1] as id_doc_no, c.legal_exp_date[1] as expired_date_doc,
  c.k as customer_id, c.full_name as customer_full_name, c.short_name[1] as customer_short_name, coalesce(c.date_of_birth, c.birth_incorp_date) as birth_or_incorp_date,
  c.legal_id[1] as legal_id, coalesce(l.description[1], g.description[1], c.legal_doc_name[1]) as legal_doc_type, c.legal_exp_date[1] as legal_doc_expiry_date,
  if(coalesce(c.legal_id[1], '') = '', 'Y', 'N') as has_no_legal_id, null::varchar as is_legal_doc_expired, 'Y' as requires_legal_doc_update,
  c.occupation[1] as occupation, c.gender, null::varchar as customer_type, null::varchar as customer_status, null::timestamp as record_timestamp,
  {D} as mis_date, a.co_code as company_code, a.recid as account_id, null::varchar as account_title_1, null::varchar as account_title_2,
  a.opening_date, a.category as account_category, a.currency as account_currency, a.working_balance, '{BUSINESS_DATE.replace('-', '')}' as dir0,
  r.account_number as cust_account_ref, {D} as business_date
from c join b_account a on trim(a.customer) = c.k
left join {one('company', '*', where=DAY)} o on o.k = a.co_code
left join {one('eb_lookup', '*', where=DAY)} l on l.k = 'CUS.LEGAL.DOC.NAME*' || c.legal_doc_name[1]
left join {one('gic_id', '*', where=DAY)} g on g.k = c.legal_doc_name[1]
left join b_customer_account r on r.recid = c.k
where a.category in ('6005', '6006', '6007', '6010', '1001', '1002', '1003')
  and (coalesce(c.legal_id[1], '') = '' or c.legal_exp_date[1] <= {D})"""

LARGE = f"""
with e as (
  select *, sum(abs(amount_lcy)) over w as acct_total, count(*) over w as entry_cnt,
    last_value(currency) over (partition by account_number order by recid rows between unbounded preceding and unbounded following) as last_ccy
  from b_stmt_entry where booking_date = {D} window w as (partition by account_number))
select e.account_number, concat_ws(' ', a.account_title_1[1], a.short_title[1]) as acct_name, a.opening_date as open_date, trim(a.customer) as customer_no,
  coalesce(concat_ws(' ', nullif(trim(c.title), ''), trim(c.name_1[1]), trim(c.name_2[1]), c.short_name[1]), '') as cust_name,
  c.occupation[1] as occupation, c.legal_id[1] as tin_id, coalesce(l.description[1], g.description[1]) as legal_type,
  trim(e.transaction_code) as txn_code, t.stmt_narr as txn_desc, e.trans_reference as trans_ref, e.value_date, abs(e.amount_lcy) as amount,
  if(e.amount_lcy < 0, -e.amount_lcy, 0)::decimal(18,2) as dr_amount, if(e.amount_lcy < 0, 0, e.amount_lcy)::decimal(18,2) as cr_amount,
  if(e.system_id = 'TT' and coalesce(e.narrative[1], '') = '', coalesce(w.narrative_1[1], trim(w.narrative_2[1])), e.narrative[1]) as narrative,
  a.working_balance, v.balance[1] as avg_balance, e.company_code, e.entry_cnt, e.acct_total::decimal(28,2) as acct_total, e.recid as transaction_id,
  trim(e.transaction_code) as application_id, e.company_code as branch_code, coalesce(nullif(trim(o.mnemonic), ''), e.company_code) as branch_name,
  e.account_number as account_id, trim(a.customer) as account_customer_id, e.booking_date as operation_date, e.currency as transaction_currency,
  e.amount_fcy as amount_ref_currency, if(e.amount_lcy < 0, 'Debit', 'Credit') as debit_credit_indicator, null::varchar as back_office_name,
  e.booking_date as transaction_approval_timestamp, strftime(e.booking_date, '%Y%m%d') as dir0, a.account_title_1[1] as account_title_1,
  trim(a.account_title_2[1]) as account_title_2, a.short_title[1] as short_title, a.category as account_category, a.currency as account_currency,
  c.k as customer_id, trim(c.name_1[1]) as customer_name_1, trim(c.name_2[1]) as customer_name_2,
  coalesce(concat_ws(' ', trim(c.name_1[1]), trim(c.name_2[1])), '') as customer_full_name, c.short_name[1] as customer_short_name, c.legal_id[1] as legal_id,
  c.legal_doc_name[1] as legal_doc_type, null::date as legal_doc_expiry_date, c.gender, c.date_of_birth as birth_or_incorp_date,
  null::varchar as customer_type, {D} as business_date
from e left join b_account a on a.recid = e.account_number
left join {one('customer', '*')} c on c.k = trim(a.customer)
left join {one('transaction', '*', where=DAY)} t on t.k = trim(e.transaction_code)
left join b_teller w on e.system_id = 'TT' and w.recid = split_part(e.trans_reference, ';', 1)
left join {one('eb_lookup', '*', where=DAY)} l on l.k = 'CUS.LEGAL.DOC.NAME*' || c.legal_doc_name[1]
left join {one('gic_id', '*', where=DAY)} g on g.k = c.legal_doc_name[1]
left join {one('company', '*', where=DAY)} o on o.k = e.company_code
left join {one('acct_activity', '*', _ARR, 'recid desc')} v on v.k = e.account_number
where e.acct_total >= 9000 and e.last_ccy = 'USD'"""

OPENED = f"""
with d as (
  select account_number, amount_lcy, booking_date, recid from b_stmt_entry where not contains(recid, '!')
  union all select s.account_number, n.amount_lcy, n.booking_date, n.recid from b_stmt_entry s
    join b_stmt_entry_detail_xref x on x.recid = s.recid join b_stmt_entry_detail n on n.recid = x.detail_id where contains(s.recid, '!')),
f as (select account_number, first(amount_lcy order by booking_date, recid) as amt from d where amount_lcy > 0 group by 1)
select a.co_code as branch_no, o.company_name[1] as branch_name, a.recid as acct_no, trim(a.customer) as cus_no,
  coalesce(trim(concat_ws(' ', trim(c.title), trim(c.name_1[1]), trim(c.name_2[1]), c.short_name[1])), '') as cus_name, a.opening_date as open_acct_date,
  l1.description[1] as ident_doc_type, c.legal_id[1] as ident_doc_no, l2.description[1] as alter_id_type, c.legal_id[2] as alter_id_no, c.pep,
  coalesce(c.birth_incorp_date, c.date_of_birth) as dob, c.nationality, c.cust_birth_country as birth_country, c.street[1] as address,
  c.occupation[1] as occupation, a.working_balance as acct_bal, f.amt as first_deposit_amt, a.currency as account_ccy,
  greatest(a.date_last_cr_cust, a.date_last_dr_cust) as last_txn_date, null::date as process_date, {D} as business_date
from b_account a left join {one('company', '*', where=DAY)} o on o.k = a.co_code
left join {one('customer', '*')} c on c.k = trim(a.customer)
left join {one('eb_lookup', '*', where=DAY)} l1 on l1.k = 'CUS.LEGAL.DOC.NAME*' || c.legal_doc_name[1]
left join {one('eb_lookup', '*', where=DAY)} l2 on l2.k = 'CUS.LEGAL.DOC.NAME*' || c.legal_doc_name[2]
left join f on f.account_number = a.recid"""

WRITTEN_OFF = f"""
select r.recid as arrangement_id, r.customer[1] as cust_id, trim(c.name_1[1]) as customer_name, coalesce(nullif(trim(i.account_officer), ''), c.account_officer) as acct_dao,
  p.group_id, g.g_name as group_name, coalesce(n.account_reference, r.recid) as account_id, r.product_group as product_id, u.description[1] as product_desc,
  r.currency, h.activity_amt[1] as loan_amount, null::date as date_disb, h.act_date[1] as wof_activity_date, h.activity[1] as wof_type,
  b.total::decimal(28,2) as wof_balance, s.property as wof_process_ref, null::decimal(18,2) as current_balance, null::decimal(18,2) as total_arrears,
  null::decimal(18,2) as total_penalty, null::integer as days_in_arrears, null::decimal(18,2) as provision_amt, null::date as load_date,
  left(h.act_date[1], 4) as year_of_write_off, null::varchar as branch, null::varchar as branch_name, coalesce(n.account_reference, r.recid) as original_loan_id,
  null::decimal(18,2) as principal_interest, null::decimal(18,2) as balance_principal_interest_penalty, b.total::decimal(28,2) as total_write_off,
  null::varchar as type_period, null::varchar as load_date_label, {D} as business_date
from b_aa_activity_history h join b_aa_arrangement r on r.recid = h.recid
left join {one('customer', '*')} c on c.k = r.customer[1]
left join {one('aa_product', '*', order='recid desc, description[1] desc', where=DAY)} u on u.k = r.product_group
left join b_aa_arr_account n on split_part(n.recid, '-', 1) = r.recid
left join b_aa_arr_customer p on split_part(p.recid, '-', 1) = r.recid
left join (select {_ARR} as k, sum(net_adjust_amt) as total from b_aa_arr_balance_maintenance group by 1) b on b.k = r.recid
left join {one('mcb_group', '*', order='recid desc, g_name desc', where=DAY)} g on g.k = p.group_id
left join b_aa_process_details s on split_part(s.recid, '-', 1) = r.recid
left join {one('account_his', '*', "split_part(recid, ';', 1)", 'curr_no::int desc')} i on i.k = n.account_reference
where upper(h.activity[1]) like 'LENDING-WRITE.OFF%' or upper(h.activity[2]) like 'LENDING-WRITE.OFF%'"""

STATEMENT = f"""
with cols as (
  select account_number as acct, recid as id, * from b_stmt_entry where not contains(recid, '!')
  union all select s.account_number, n.recid, n.* from b_stmt_entry s join b_stmt_entry_detail_xref x on x.recid = s.recid
    join b_stmt_entry_detail n on n.recid = x.detail_id where contains(s.recid, '!')),
e as (select *, coalesce(amount_fcy, amount_lcy) as amt from cols)
select e.acct as account_number, e.id as stmt_entry_id, b.fqu1_last_balance as bfwd_balance, e.value_date, e.booking_date, trim(e.transaction_code) as transaction_code,
  t.stmt_narr as description, array_to_string(e.narrative, '|') as narrative, e.trans_reference, e.amt as amount, e.currency, a.short_title[1] as account_short_title,
  trim(a.customer) as customer_id, c.short_name[1] as customer_short_name, if(trim(a.customer) <> '', c.short_name[1], a.short_title[1]) as display_name,
  s.application as drilldown_application,
  (b.fqu1_last_balance + sum(e.amt) over (partition by e.acct order by e.booking_date, e.id rows unbounded preceding))::decimal(28,2) as running_balance,
  (b.fqu1_last_balance + sum(e.amt) over (partition by e.acct))::decimal(28,2) as period_end_total, p.stmt_entry_no as last_printed_entry_no,
  (select max(fwd_mvmt_reqd) from b_ac_stmt_parameter) as stmt_fwd_mvmt_reqd, m.description[1] as sms_group_description, u.user_name as inputter_user_name
from e left join b_account a on a.recid = e.acct left join {one('customer', '*')} c on c.k = trim(a.customer)
left join {one('transaction', '*')} t on t.k = trim(e.transaction_code) left join b_account_statement b on b.recid = e.acct
left join b_eb_system_id s on s.recid = e.system_id left join b_stmt_printed p on p.recid = e.acct
left join {one('company_sms_group', '*')} m on m.k = a.co_code left join b_user u on u.recid = e.inputter[1]"""

STMT_BOOK = f"""
with o as (select * from {one('company', '*')}),
p as (select e.*, a.recid as acc, a.co_code, a.category, a.alt_acct_id[2] as iban, trim(a.customer) as holder, o.company_name[1] as company_name, o.local_currency,
        if(o.local_currency = e.currency, e.amount_lcy, e.amount_fcy) as amt
      from b_stmt_entry e left join b_account a on a.recid = e.account_number left join o on o.k = a.co_code)
select p.account_number as account, null::varchar as original_acct, null::varchar as auto_pay_acct, g.short_name[1] as category_name, p.iban, p.holder as customer_id,
  c.short_name[1] as customer_short_name, trim(c.name_1[1]) as customer_name, p.company_name, p.local_currency as comp_ccy,
  coalesce(concat_ws(', ', d.dist_name[1], s.district_id, v.subdistrict_id), '') as customer_address_district, null::decimal(18,2) as opening_balance,
  null::decimal(18,2) as locked_amount, p.booking_date as post_date, p.trans_reference as trans_ref, t.stmt_narr as transaction_narrative,
  array_to_string(p.narrative, '|') as narrative, p.value_date, p.amt as amount, if(p.amt < 0, -p.amt, null)::decimal(18,2) as dr_amt, if(p.amt > 0, p.amt, null)::decimal(18,2) as cr_amt,
  (sum(p.amt) over (partition by p.account_number order by p.booking_date, p.recid rows unbounded preceding))::decimal(28,2) as running_balance,
  p.their_reference, p.system_id, y.application as base_appl, (sum(-p.amt) filter (p.amt < 0) over w)::decimal(28,2) as total_dr_amt,
  (sum(p.amt) filter (p.amt > 0) over w)::decimal(28,2) as total_cr_amt, count(*) filter (p.amt < 0) over w as dr_txn_count,
  count(*) filter (p.amt > 0) over w as cr_txn_count, (sum(p.amt) over w)::decimal(28,2) as balance_at_period_end, d.dist_name[1] as dist_name,
  s.district_id as subdist_name, v.subdistrict_id as vill_name, h.recid as sweep_ref, (select max(purge_date) from b_archive) as archive_purge_date,
  z.stmt_date_bal::decimal(18,2) as stmt_print_balance, x.sub_account as sub_account_ref, n.company as mnemonic_company_ref
from p left join {one('category', '*')} g on g.k = p.category left join {one('customer', '*')} c on c.k = p.holder
left join {one('transaction', '*')} t on t.k = trim(p.transaction_code) left join b_eb_system_id y on y.recid = p.system_id
left join {one('cus_dist', '*')} d on d.k = c.suburb_town left join {one('cus_subdist', '*')} s on s.k = c.city_municipal
left join b_cus_vill v on v.recid = c.province_state left join b_ac_account_sweep_hist h on p.system_id = 'ACCP' and h.recid = p.trans_reference || '-SW'
left join b_acct_stmt_print z on z.recid = p.acc left join b_ac_sub_account x on x.recid = p.acc left join b_mnemonic_company n on n.recid = p.system_id
window w as (partition by p.account_number)"""

SILVER = {
    "acct_cust": ("account customer", ACCT_CUST),
    "closed_accounts": ("account_closed posting_restrict account_his", CLOSED),
    "locked_amounts": ("ac_locked_events account", LOCKED),
    "category_entry_book": ("categ_entry categ_entry_detail category transaction categ_entry_detail_xref", BOOK),
    "loan_risk": ("pv_asset_detail account category customer dept_acct_officer map_sector_credit aa_account_details "
                  "aa_arr_payment_schedule aa_arr_term_amount", RISK),
    "lending_arrangements": ("aa_arrangement aa_arr_customer aa_arr_term_amount aa_account_details customer em_lo_application "
                             "em_dl_application mcb_group aa_customer_role aa_product aa_bill_details", ARRANGEMENTS),
    "inward_remittance": ("funds_transfer account", REMITTANCE),
    "inactive_accounts": ("account company customer", INACTIVE),
    "missing_documents": ("customer account company eb_lookup gic_id customer_account", DOCUMENTS),
    "large_daily_txn": ("stmt_entry account customer transaction teller eb_lookup gic_id company acct_activity", LARGE),
    "opened_accounts": ("stmt_entry stmt_entry_detail_xref stmt_entry_detail account company customer eb_lookup", OPENED),
    "written_off_loans": ("aa_activity_history aa_arrangement customer aa_product aa_arr_account aa_arr_customer "
                          "aa_arr_balance_maintenance mcb_group aa_process_details account_his", WRITTEN_OFF),
    "account_statement": ("stmt_entry stmt_entry_detail_xref stmt_entry_detail account customer transaction account_statement "
                          "eb_system_id stmt_printed ac_stmt_parameter company_sms_group user", STATEMENT),
    "statement_book": ("stmt_entry account company category customer transaction eb_system_id cus_dist cus_subdist cus_vill "
                       "ac_account_sweep_hist archive acct_stmt_print ac_sub_account mnemonic_company", STMT_BOOK),
}


def silver_sql(name: str) -> str:
    views, body = SILVER[name]
    return with_views(views, f"select * from ({body.strip()})" if body.strip().startswith("with") else body)

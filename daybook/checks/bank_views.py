"""Bank-shaped tables derived from the driver's tables, in SQL that Spark and DuckDB both run.

Only the array constructor differs between the two; it is written ``{arr}`` and filled in. The
views let every mart and report run unchanged on data at any scale.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BUSINESS_DATE = "1998-06-01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

KEY14 = "lpad(cast({0} as string), 14, '0')"
ENTRY_ID = ("concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), "
            "cast(l_suppkey as string), cast(cast(l_extendedprice as decimal(18,2)) as string), "
            "cast(cast(l_shipdate as date) as string), cast(cast(l_quantity as int) as string))")
AMOUNT = "cast(l_extendedprice as decimal(18,2))"
SIGNED = f"case when l_returnflag = 'R' then -{AMOUNT} else {AMOUNT} end"
NETTED = "l_linestatus = 'F' and l_returnflag = 'A'"
MONTH = "cast(date_trunc('month', l_shipdate) as date)"
D = f"date '{BUSINESS_DATE}'"

_ENTRY = f"""
  {KEY14.format('l_orderkey')} as account_number, {SIGNED} as amount_lcy,
  case when l_discount > 0.05 then cast({SIGNED} as decimal(18,2)) end as amount_fcy,
  case when l_tax > 0.06 then 'EUR' else 'USD' end as currency, {MONTH} as booking_date,
  cast(l_shipdate as date) as value_date, concat(' ', cast(l_linenumber as string)) as transaction_code,
  concat('TT', cast(l_suppkey as string), ';1', chr(92), 'B') as trans_reference,
  concat('R', cast(l_partkey as string)) as their_reference,
  case when l_returnflag = 'A' then 'TT' when l_returnflag = 'N' then 'ACCP' else 'FT' end as system_id,
  case when l_discount > 0.02 then {{arr}}(concat('pay ', cast(l_partkey as string)), 'x') end as narrative,
  concat('TL001', lpad(cast(l_suppkey % 14 + 1 as string), 4, '0')) as company_code,
  {{arr}}(concat('U', cast(l_linenumber as string))) as inputter"""

_CUSTOMER = """
  case when c_nationkey < 5 then concat(' ', cast(c_custkey as string)) else cast(c_custkey as string) end as recid,
  '{v}' as curr_no,
  case when c_nationkey < 12 then 'Sr' when c_nationkey < 15 then ' ' end as title,
  {{arr}}(case when c_nationkey < 6 then concat(c_name, ' da Cruz da Cruz') else concat(c_name, ' v{v}') end) as name_1,
  case when c_acctbal > 1000 then {{arr}}(concat(c_mktsegment, ' ')) end as name_2,
  {{arr}}(concat('S', cast(c_custkey as string))) as short_name,
  case when c_acctbal > 500 then {{arr}}(concat('L', cast(c_custkey as string)), 'ALT') when c_acctbal > 0 then {{arr}}('', 'ALT') end as legal_id,
  {{arr}}(concat('DOC', cast(c_nationkey as string)), concat('DOC', cast(c_nationkey + 1 as string))) as legal_doc_name,
  case when c_nationkey > 3 then {{arr}}(date '1997-01-01' + cast(c_nationkey * 40 as int)) end as legal_exp_date,
  {{arr}}(concat(c_mktsegment, ' worker')) as occupation,
  case when c_nationkey > 8 then {{arr}}(concat('Street ', cast(c_nationkey as string))) end as street,
  case when c_nationkey > 4 then {{arr}}('Address') end as address,
  {{arr}}('Town') as town_country,
  case when c_nationkey % 3 = 0 then 'MALE' when c_nationkey % 3 = 1 then 'FEMALE' end as gender,
  case when c_nationkey > 2 then date '1960-01-15' + cast(floor(c_acctbal) as int) end as date_of_birth,
  case when c_nationkey > 20 then date '1990-06-30' end as birth_incorp_date,
  concat('N', cast(c_nationkey as string)) as nationality, 'TL' as cust_birth_country,
  case when c_nationkey = 7 then 'YES' else 'NO' end as pep, cast(c_nationkey as string) as sector,
  cast(c_nationkey as string) as account_officer,
  {{arr}}(concat('c', cast(c_custkey as string), '@example.org')) as email_1, {{arr}}(' ') as sms_1, {{arr}}('77000000') as phone_1,
  concat('ID', cast(c_nationkey as string)) as id_types, 'Employer' as employ_name, cast(null as string) as sp_name,
  case when c_nationkey > 1 then concat('7', cast(c_custkey as string)) end as tel_mobile,
  cast(c_nationkey as string) as suburb_town, cast(c_nationkey + 1 as string) as city_municipal, cast(c_nationkey + 2 as string) as province_state
"""

_DIM = ("concat('{p}', cast({key} as string)) as recid, '{v}' as curr_no, {cols}, "
        f"{D} as business_date from nation")


def _dim(key: str, cols: str, prefix: str = "") -> str:
    """Two versions of a small reference table; the second one of part of the rows wins."""
    one = _DIM.format(p=prefix, key=key, v=1, cols=cols.replace("#", "old"))
    two = _DIM.format(p=prefix, key=key, v=2, cols=cols.replace("#", "new")) + " where n_regionkey > 1"
    stale = f"select concat('{prefix}', cast({key} as string)) as recid, '9' as curr_no, " \
            f"{cols.replace('#', 'other day')}, date '1998-05-01' as business_date from nation"
    return f"select {one} union all select {two} union all {stale}"


_ARR = "concat('AA', lpad(cast(o_orderkey as string), 8, '0'))"
_LOAN = "o_orderpriority in ('4-NOT SPECIFIED', '5-LOW')"

VIEWS: dict[str, str] = {
    "customer_rec": f"select {_CUSTOMER.format(v=1)} from customer union all "
                    f"select {_CUSTOMER.format(v=2)} from customer where c_acctbal > 4000",
    "account": f"""select {KEY14.format('o_orderkey')} as recid, '1' as curr_no,
      case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then ' ' else cast(o_custkey as string) end as customer,
      case o_orderpriority when '1-URGENT' then '6006' when '2-HIGH' then '6010' when '3-MEDIUM' then '6013'
        when '4-NOT SPECIFIED' then concat('300', cast(o_custkey % 9 + 1 as string)) else '6005' end as category,
      case when o_custkey % 5 = 0 then 'EUR' else 'USD' end as currency,
      concat('TL001', lpad(cast(o_custkey % 15 + 1 as string), 4, '0')) as co_code,
      cast(o_orderdate as date) as opening_date,
      case when o_orderstatus = 'P' then -cast(o_totalprice as decimal(18,2)) else cast(o_totalprice as decimal(18,2)) end as working_balance,
      case when o_orderstatus = 'F' then 'male' when o_orderstatus = 'O' then 'FEMALE' end as gender,
      {{arr}}(concat('IB', cast(o_orderkey as string)), concat('TL', cast(o_orderkey as string))) as alt_acct_id,
      {{arr}}(concat('acc ', cast(o_orderkey as string))) as short_title,
      case when o_orderstatus <> 'P' then {{arr}}(concat('title ', o_orderstatus)) end as account_title_1, {{arr}}('  ') as account_title_2,
      case when o_orderstatus = 'F' then 'Y' else 'N' end as inactiv_marker,
      case when o_orderpriority <> '2-HIGH' then cast(o_orderdate as date) + 20 end as date_last_cr_cust,
      case when o_orderpriority <> '3-MEDIUM' then cast(o_orderdate as date) + cast(o_custkey % 40 as int) end as date_last_dr_cust,
      cast(o_orderdate as date) + 7 as date_last_cr_auto, {_ARR} as arrangement_id
      from orders""",
    "stmt_entry": f"select concat({ENTRY_ID}, case when {NETTED} then '!1' else '' end) as recid, {_ENTRY} from lineitem",
    "stmt_entry_detail_xref": f"select concat({ENTRY_ID}, '!1') as recid, concat('D', {ENTRY_ID}) as detail_id from lineitem where {NETTED}",
    "stmt_entry_detail": f"select concat('D', {ENTRY_ID}) as recid, {_ENTRY} from lineitem where {NETTED}",
    "company": _dim("lpad(cast(n_nationkey + 1 as string), 4, '0')", "{arr}(concat(n_name, ' #')) as company_name, "
                    "case when n_regionkey > 0 then concat('M', cast(n_nationkey as string)) else ' ' end as mnemonic, "
                    "case when n_nationkey < 18 then 'USD' else 'EUR' end as local_currency", "TL001"),
    "transaction": _dim("n_nationkey", "concat('txn ', n_name, ' #') as stmt_narr"),
    "eb_lookup": _dim("n_nationkey", "{arr}(concat('Document ', cast(n_nationkey as string), ' #')) as description",
                      "CUS.LEGAL.DOC.NAME*DOC"),
    "gic_id": _dim("n_nationkey", "{arr}(concat('GIC ', n_name, ' #')) as description", "DOC"),
    "category": _dim("3000 + n_nationkey", "{arr}(concat('Category ', n_name, ' #')) as short_name"),
    "dept_acct_officer": _dim("n_nationkey", "concat('Officer ', n_name, ' #') as name"),
    "posting_restrict": _dim("n_nationkey", "{arr}(concat('Reason ', n_name, ' #')) as description"),
    "mcb_group": _dim("n_nationkey", "concat('Group ', n_name, ' #') as g_name", "G"),
    "aa_product": _dim("n_nationkey", "{arr}(concat('Product ', n_name, ' #')) as description", "P"),
    "map_sector_credit": "select cast(n_nationkey as string) as sector_code, cast(n_nationkey % 11 + 1 as string) as credit_by_sector from nation where n_nationkey < 22",
    "acct_activity": " union all ".join(
        f"select concat({KEY14.format('o_orderkey')}, '-1998{m}') as recid, {{arr}}(cast(o_totalprice + {m} as decimal(18,2))) as balance from orders"
        for m in ("03", "05")),
    "teller": "select concat('TT', cast(s_suppkey as string)) as recid, case when s_acctbal > 3000 then {arr}(concat('teller ', s_name)) end as narrative_1, {arr}(' second') as narrative_2 from supplier",
    "account_closed": f"""select cast(o_orderkey as string) as recid, cast(o_custkey as string) as customer_id,
      concat('TL001', lpad(cast(o_custkey % 15 + 1 as string), 4, '0')) as account_branch, cast(o_custkey % 25 as string) as closure_reason,
      cast(o_orderdate as date) + 90 as acct_close_date, {D} as business_date from orders where o_orderstatus = 'F'
      union all select cast(o_orderkey as string), cast(o_custkey as string), ' ', '1', cast(o_orderdate as date) + 95, date '1998-07-01'
      from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'""",
    "account_his": " union all ".join(f"""select concat({KEY14.format('o_orderkey')}, ';{v}') as recid, '{v}' as curr_no,
      {{arr}}('his {v}') as account_title_1, {{arr}}(o_orderpriority) as account_title_2,
      case when o_orderpriority = '5-LOW' then 'n/a' else '6010' end as category, 'USD' as currency,
      {{arr}}(case when o_orderpriority = '2-HIGH' then '1.25' else 'free' end) as acct_credit_int,
      cast(o_totalprice as decimal(18,2)) as working_balance, ' ' as arrangement_id,
      case when o_custkey % 15 < 9 then concat('TL001', lpad(cast(o_custkey % 15 + 1 as string), 4, '0')) else ' ' end as account_officer
      from orders where o_orderstatus = 'F'""" for v in (2, 10)),
    "funds_transfer": f"""select concat('FT', {ENTRY_ID}) as recid, case when l_returnflag = 'R' then 'AC' else 'IT' end as transaction_type,
      concat('REF', cast(l_linenumber as string)) as debit_their_ref, {{arr}}(concat('order ', cast(l_suppkey as string))) as ordering_cust,
      cast(l_suppkey as string) as ord_cust_acct, 'BICXX' as inw_send_bic, {KEY14.format('l_orderkey')} as debit_acct_no,
      {KEY14.format('l_partkey')} as credit_acct_no,
      case when l_discount > 0.04 then cast(l_extendedprice as decimal(18,2)) else cast(0 as decimal(18,2)) end as debit_amount,
      cast(l_extendedprice as decimal(18,2)) as credit_amount, 'USD' as debit_currency, 'USD' as credit_currency,
      case when l_tax > 0.04 then concat('USD', cast(cast(l_tax as decimal(18,2)) as string)) when l_tax > 0.02 then 'USD' end as total_charge_amt,
      concat('USD', cast(cast(l_extendedprice as decimal(18,2)) as string)) as amount_credited,
      cast(l_shipdate as date) as credit_value_date, {MONTH} as processing_date, '1' as profit_centre_dept
      from lineitem""",
    "customer_account": "select cast(o_custkey as string) as recid, max(cast(o_orderkey as string)) as account_number from orders group by o_custkey",
    "pv_asset_detail": f"""select {KEY14.format('o_orderkey')} as recid, case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then '' else cast(o_custkey as string) end as customer,
      'USD' as currency, case o_custkey % 5 when 0 then 'STANDARD' when 1 then 'UNDER-SUPERVISION' when 2 then 'SUB-STANDARD' when 3 then 'DOUBTFUL' else 'LOSS' end as auto_class,
      {{arr}}('GEN') as calc_prov_type, case when o_orderstatus <> 'P' then {{arr}}(cast(o_totalprice as decimal(18,2))) end as calc_base_amt,
      concat('TL001', lpad(cast(o_custkey % 15 + 1 as string), 4, '0')) as co_code, case when {_LOAN} then 'LENDING' else 'DEPOSITS' end as product_line
      from orders""",
    "aa_arrangement": f"""select {_ARR} as recid, {{arr}}(cast(o_custkey as string)) as customer, {{arr}}(case o_custkey % 3 when 0 then 'OWNER' when 1 then 'ASIA' else 'UNKNOWN' end) as customer_role,
      {{arr}}({KEY14.format('o_orderkey')}) as linked_appl_id,
      case o_custkey % 6 when 0 then 'AUTH' when 1 then 'CURRENT' when 2 then 'EXPIRED' when 3 then 'CLOSE' when 4 then 'PENDING.CLOSURE' else 'SUSPENDED' end as arr_status,
      concat('P', cast(o_custkey % 25 as string)) as product_group, case when {_LOAN} then 'LENDING' else 'DEPOSITS' end as product_line,
      'USD' as currency, cast(o_orderdate as date) as start_date, concat('TL001', lpad(cast(o_custkey % 15 + 1 as string), 4, '0')) as co_code
      from orders""",
    "aa_arr_term_amount": f"""select concat({_ARR}, case when l_linestatus = 'O' then '-COMMITMENT-' else '-TERM.AMOUNT-' end,
        replace(cast(cast(l_shipdate as date) as string), '-', ''), '.', cast(l_linenumber as string), '.', {ENTRY_ID}) as recid,
      {AMOUNT} as amount, concat(cast(l_linenumber as string), 'M') as term from lineitem join orders on l_orderkey = o_orderkey where {_LOAN}""",
    "aa_arr_customer": f"""select concat({_ARR}, '-CUSTOMER-', replace(cast(cast(o_orderdate as date) as string), '-', ''), '.1') as recid,
      case when o_orderstatus = 'O' then concat('DL', cast(o_orderkey as string)) else ' ' end as dl_appl_id, concat('LO', cast(o_orderkey as string)) as loan_appl_id,
      concat('G', cast(o_custkey % 25 as string)) as group_id from orders where {_LOAN}""",
    "aa_account_details": f"""select {_ARR} as recid, cast(o_orderdate as date) + 30 as payment_start_date, cast(o_orderdate as date) + 720 as maturity_date,
      case when o_orderstatus = 'F' then 'CUR' else 'DEL' end as arr_age_status from orders where {_LOAN}""",
    "aa_arr_payment_schedule": f"""select concat({_ARR}, case when l_returnflag = 'R' then '-OTHER-' else '-SCHEDULE-' end, {ENTRY_ID}) as recid,
      case when l_returnflag = 'A' then {{arr}}({AMOUNT}) else {{arr}}({AMOUNT}, cast({AMOUNT} - 1 as decimal(18,2))) end as calc_amount
      from lineitem join orders on l_orderkey = o_orderkey where {_LOAN}""",
    "aa_bill_details": f"select concat(' ', {_ARR}) as arrangement_id, {AMOUNT} as os_total_amount from lineitem join orders on l_orderkey = o_orderkey where {_LOAN} and l_returnflag = 'R'",
    "em_dl_application": "select concat('DL', cast(o_orderkey as string)) as recid, '1' as curr_no, cast(o_orderdate as date) - 10 as app_date from orders",
    "em_lo_application": "select concat('LO', cast(o_orderkey as string)) as recid, '1' as curr_no, case when o_orderstatus = 'F' then cast(o_orderdate as date) + 40 end as rep_start_date from orders",
    "aa_customer_role": "select case when r_regionkey = 0 then 'OWNER' else r_name end as recid, {arr}(concat('Role ', r_name)) as description from region",
    "aa_activity_history": f"""select {_ARR} as recid,
      {{arr}}(case when o_orderstatus = 'F' then 'lending-write.off-balance' else 'LENDING-NEW' end, case when o_orderpriority = '5-LOW' then 'LENDING-WRITE.OFF-ALL' else 'LENDING-PAY' end) as activity,
      {{arr}}(replace(cast(cast(o_orderdate as date) as string), '-', '')) as act_date, {{arr}}(cast(o_totalprice as decimal(18,2))) as activity_amt, {{arr}}({_ARR}) as contract_id
      from orders where {_LOAN}""",
    "aa_arr_account": f"select concat({_ARR}, '-ACCOUNT-', replace(cast(cast(o_orderdate as date) as string), '-', ''), '.1') as recid, {KEY14.format('o_orderkey')} as account_reference from orders where {_LOAN} and o_orderstatus <> 'O'",
    "aa_arr_balance_maintenance": f"select concat({_ARR}, '-BALANCE-', {ENTRY_ID}) as recid, {AMOUNT} as net_adjust_amt from lineitem join orders on l_orderkey = o_orderkey where {_LOAN}",
    "aa_process_details": f"select concat({_ARR}, '-', cast(o_custkey as string)) as recid, concat('PROP', cast(o_custkey as string)) as property from orders where {_LOAN}",
    "ac_locked_events": f"select concat('LK', {ENTRY_ID}) as trans_ref, {KEY14.format('l_orderkey')} as account_number, 'hold' as description, cast(l_shipdate as date) as from_date, cast(l_shipdate as date) + 30 as to_date, {AMOUNT} as locked_amount, case when l_returnflag = 'R' then 'CR' else 'DR' end as txn_sign from lineitem where l_linestatus = 'O'",
    "categ_entry": f"select {ENTRY_ID} as recid, cast(3000 + l_linenumber as string) as pl_category, {_ENTRY}, cast(l_suppkey as string) as customer_id from lineitem where l_linestatus = 'F'",
    "categ_entry_detail": f"select {ENTRY_ID} as recid, cast(3000 + l_linenumber as string) as pl_category, {_ENTRY}, cast(l_suppkey as string) as customer_id from lineitem where l_returnflag <> 'N'",
    "categ_entry_detail_xref": f"select {ENTRY_ID} as recid, concat('X', cast(l_partkey as string)) as detail_id from lineitem where l_returnflag = 'R'",
    "account_statement": f"select {KEY14.format('o_orderkey')} as recid, '1' as curr_no, cast(o_totalprice as decimal(18,2)) as fqu1_last_balance from orders where o_orderstatus <> 'P'",
    "stmt_printed": f"select {KEY14.format('o_orderkey')} as recid, concat('PR', cast(o_custkey as string)) as stmt_entry_no from orders where o_orderstatus = 'F'",
    "ac_stmt_parameter": "select 'SYSTEM' as recid, cast(r_regionkey as string) as curr_no, concat('FWD', cast(r_regionkey as string)) as fwd_mvmt_reqd from region",
    "company_sms_group": _dim("lpad(cast(n_nationkey + 1 as string), 4, '0')", "{arr}(concat('sms ', n_name, ' #')) as description", "TL001"),
    "user": "select concat('U', cast(n_nationkey as string)) as recid, '1' as curr_no, concat('user ', n_name) as user_name from nation",
    "eb_system_id": "select 'TT' as recid, concat('TELLER ', max(r_name)) as application from region union all select 'FT', concat('FUNDS ', max(r_name)) from region",
    "cus_dist": _dim("n_nationkey", "{arr}(concat('dist ', n_name, ' #')) as dist_name"),
    "cus_subdist": _dim("n_nationkey", "concat('sub ', n_name, ' #') as district_id"),
    "cus_vill": "select cast(n_nationkey as string) as recid, concat('vill ', n_name) as subdistrict_id from nation",
    "ac_account_sweep_hist": "select concat('TT', cast(s_suppkey as string), ';1', chr(92), 'B-SW') as recid from supplier where s_acctbal > 2000",
    "archive": "select 'STATEMENT' as recid, max(cast(o_orderdate as date)) as purge_date from orders",
    "acct_stmt_print": f"select {KEY14.format('o_orderkey')} as recid, cast(cast(o_totalprice as decimal(18,2)) as string) as stmt_date_bal from orders where o_orderstatus = 'O'",
    "ac_sub_account": f"select {KEY14.format('o_orderkey')} as recid, concat('SUB', cast(o_custkey as string)) as sub_account from orders where o_orderstatus = 'P'",
    "mnemonic_company": "select case when r_regionkey = 0 then 'TT' else r_name end as recid, r_name as company from region",
    "sector": _dim("n_nationkey", "concat('Sector ', n_name, ' #') as description"),
    "crb_deposits": f"select {KEY14.format('l_orderkey')} as account_number, {AMOUNT} as local_ccy_amt, {MONTH} as load_date from lineitem",
    "batch": "select case when r_regionkey = 0 then 'BNK/DW.EXTRACT.EOD' else r_name end as recid, date '1998-06-01' as last_run_date, 'DONE' as job_status from region",
}

# ---- ledger and report layouts -------------------------------------------------------------

def _code(key: str) -> str:
    """Ledger line of a part: mostly 1000 + n, some lines that the reports treat specially."""
    special = ("2850", "2830", "3865", "7240", "7045", "5321", "5320", "1890")
    whens = " ".join(f"when {i} then '{c}'" for i, c in enumerate(special))
    return f"case {key} % 120 {whens} else cast(1000 + {key} % 120 as string) end"


def _names(key: str, names: tuple[str, ...], other: str) -> str:
    whens = " ".join(f"when {i} then '{n}'" for i, n in enumerate(names))
    return f"case {key} {whens} else {other} end" if names else other


_BRANCH_NO = "l_suppkey % 13"
_BRANCH = ("case " + _BRANCH_NO + " when 0 then 'RE000010_Head Office' when 1 then 'RE000010_01_ATAURO' when 2 then 'RE000010_02_UPGRADE' "
           f"else concat('RE000010_', lpad(cast({_BRANCH_NO} as string), 2, '0'), '_CITY', cast({_BRANCH_NO} as string)) end")


def _ledger(kind: str, flag: str) -> str:
    detail = ("concat('PL.', cast(5000 + l_linenumber as string), '.', cast(3001 + l_partkey % 9 as string), '.a.b.c.d.e.', l_returnflag, '.x')"
              if kind == "PL" else "concat('AC.1.TR.USD.', cast(3001 + l_partkey % 9 as string), '.f.g.h.i.', l_returnflag, '.x')")
    return f"""select case when l_linenumber in (2, 5) then {_code('l_partkey')} else '' end as line_code,
      case when l_linenumber in (2, 5) then 'header' when l_returnflag = 'A' and l_linenumber = 1 then 'note' else {detail} end as description,
      cast(0 as double) as opening_balance, l_tax as debit_movements, l_discount as credit_movements,
      case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as closing_balance,
      concat('{kind}_', cast({_BRANCH_NO} as string), '.txt') as source_file, {_BRANCH} as branch, 'CRF_{kind}' as file_type,
      cast(row_number() over (partition by {_BRANCH_NO} order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) as int) as line_seq,
      {D} as business_date from lineitem where l_linestatus = '{flag}'"""


_ASSET_GROUPS = ("LIQUID_FUNDS", "CALL_DEPOSITS", "OTHERS_DOMESTIC", "FOREIGN_CURRENCY", "INVESTMENT", "CURRENT_LOAN", "PAST_DUE", "PROVISION",
                 "ACC_RECEIVABLE", "FIXED_ASSETS", "RESERVE_DEPR", "OTHER_ASSETS", "OFFICE_ACCOUNTS", "ASSET_HELD_DEBT")
_LIAB_GROUPS = ("DEMAND_DEPOSIT", "TIME_DEPOSIT", "PASSBOOK_SAVING", "SUNDRY_OTHERS", "INTEREST_ACCRUED", "RESTRICTED_DEPOSIT", "UNEARNED_BASE",
                "LOAN_FEE_ADV", "DUE_TO_BRANCH", "PROVISIONING", "CAPITAL_BASE")


def _group_seed(groups: tuple[str, ...], last: str) -> str:
    return (f"select distinct {_code('p_partkey')} as account_code, concat('name ', cast(p_partkey % 120 as string)) as account_name, "
            f"{_names(f'p_partkey % 120 % {len(groups) + 1}', groups, repr(last))} as parent_group from part")


def _layout_seed(rows: int, root: str, codes: tuple[str, ...], summary: int, text: tuple[str, ...]) -> str:
    n = f"p_partkey % {rows}"
    return f"""select distinct cast({n} + 1 as int) as order_id,
      {_names(n, codes, f"case when {n} % 17 = 16 then null when {n} % 5 = 0 then concat('{root}.', cast({n} as string)) else concat('{root}.', cast({n} % 9 as string), '.', cast({n} as string)) end")} as code,
      {_names(n, text, f"concat('row ', cast({n} as string))")} as description,
      case when {n} % 3 = 0 then null else {_code(n)} end as line, case when {n} % 3 = 0 then cast({n} % {summary} + 1 as int) end as stt_noline from part"""


def _leaf_map(parts: tuple[tuple[str, str, int, int], ...]) -> str:
    return " union all ".join(
        f"select '{tag}' as src_tag, code, description, cast(order_id % {span} + {start} as int) as order_id from ({VIEWS[layout]}) x{i} where line is not null"
        for i, (tag, layout, span, start) in enumerate(parts))


def _statement_layout(rows: int, start: int) -> str:
    n = f"p_partkey % {rows}"
    return f"""select distinct cast({n} + {start} as int) as order_id, cast({n} % 5 as int) as section, case when {n} % 7 = 0 then null else concat('c', cast({n} as string)) end as code,
      concat('text ', cast({n} as string)) as description, case when {n} % 4 = 0 then 'subtotal' else 'leaf' end as row_type from part"""


_ASSET_TEXT = ("Cash in Vault", "Cash in ATM Vault", "Due from Central Bank", "Items in course of collect.", "CURRENT LOAN", "PAST DUE LOANS",
               "PROV. FOR L. LOSSES", "Foreign Currency", "Call Deposits", "INVESTMENT", "Vehicles", "RESERVE FOR DEPREC.", "PerformingLoans", "OTHERS")
_LIAB_TEXT = ("Demand Deposit", "Time Deposits", "2.4.1.2.4", "Interest Accrued", "Salary Payable", "RESTRICTED DEPOSIT", "Unearned Interest",
              "Other Liabilit/Due To Branch", "Other liabilit/Due To Branch", "Overages ATM", "Provisioning", "Current Financial Year")


def _history(texts: tuple[str, ...], codes: str) -> str:
    n = "l_partkey % 40"
    return f"""select cast(l_shipdate as date) as load_date, {_BRANCH} as branch_name, cast({n} + 1 as int) as order_id, {codes.format(n=n)} as code,
      {_names(n, texts, f"concat('row ', cast({n} as string))")} as description, {SIGNED} as amount, cast(l_linenumber as bigint) as total_accounts from lineitem"""


VIEWS |= {
    "ledger_gl": _ledger("GL", "O"),
    "ledger_pl": _ledger("PL", "F"),
    "deposit_report": f"""select {_names('l_suppkey % 15', ('BNK', 'DIL', 'GLN', 'MAL', 'ALU', 'OCS', 'BCU', 'SAM', 'ANR', 'SUA', 'VQQ', 'LSP', 'LQC', 'MTT'), "'XXX'")} as branch_name,
      {_code('l_partkey')} as gl_line, case l_returnflag when 'A' then 'demand' when 'N' then 'time' else 'loan' end as deposit_type,
      cast(l_orderkey as string) as account_number, {D} as business_date from lineitem""",
    "map_total_assets": _group_seed(_ASSET_GROUPS, "MISC_ASSETS"),
    "map_total_liabilities": _group_seed(_LIAB_GROUPS, "PNL"),
    "map_total_income": _group_seed(("INTEREST_INCOME", "INTEREST_LOAN"), "NON_INTEREST_INCOME") + " where p_size > 10",
    "map_total_expense": _group_seed(("INTEREST_INDIVIDUAL", "INTEREST_LEGAL"), "OPERATING") + " where p_size > 10",
    "map_detail_assets": _layout_seed(130, "1", ("1.0",), 19, ()),
    "map_detail_liabilities": _layout_seed(83, "2", ("2.0", "3.0", "3.06", "3.06.1", "3.06.2", "3-07", "3.02", "2-08"), 13, ()),
    "map_detail_income": _layout_seed(67, "4", ("4.0",), 5, ()),
    "map_detail_expense": _layout_seed(72, "5", ("5.0", "5.03.7.6"), 5, ("EXPENSE", "Depr. Non Physical Assets")),
    "position_layout": _statement_layout(152, 8),
    "earnings_layout": _statement_layout(136, 7),
    "income_layout": _statement_layout(136, 6),
    "assets_history": _history(_ASSET_TEXT, "case {n} when 13 then '1.01.4.1.2' when 14 then 'I23' when 15 then '1.01.4.3' when 16 then null else concat('1.', cast({n} as string)) end"),
    "liabilities_history": _history(_LIAB_TEXT, "case {n} when 20 then '2.06.2' when 21 then '3.02' when 22 then 'I201' when 23 then '2.06.8' else concat('2.', cast({n} as string)) end"),
}
VIEWS |= {
    "position_leaf_map": _leaf_map((("AST", "map_detail_assets", 84, 10), ("LIB", "map_detail_liabilities", 49, 108))),
    "earnings_leaf_map": _leaf_map((("INC", "map_detail_income", 53, 9), ("EXP", "map_detail_expense", 73, 66))),
}

_ALIASES = {"customer": "customer_rec"}


def view_sql(name: str, arr: str) -> str:
    return VIEWS[_ALIASES.get(name, name)].replace("{arr}", arr)


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy bank-shaped frames; each is planned only when a mart reads it."""
    return _Frames(spark, sf_dir)


class _Frames(dict):
    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._tables[name]

    def __missing__(self, name: str) -> DataFrame:
        sql = view_sql(name, "array")
        used = {t: self._table(t) for t in TABLES
                if re.search(rf"\b(from|join|,) {t}\b", sql)}
        for table in used:
            sql = re.sub(rf"\b(from|join|,) {table}\b", rf"\1 {{{table}}}", sql)
        self[name] = self._spark.sql(sql, **used)
        return self[name]


def duck_views(names: list[str]) -> str:
    """The same views as a chain of DuckDB common table expressions."""
    return ",\n".join(f'b_{n} as ({view_sql(n, "list_value")})' for n in names)

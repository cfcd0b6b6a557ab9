"""DuckDB statements giving the expected rows of the accounting chain."""

from __future__ import annotations

from daybook.checks.bank_views import duck_views
from daybook.checks.report_sql import label
from daybook.checks.silver_sql import SILVER
from daybook.plans import accounting as acc

M = "decimal(28,2)"


def quoted(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def picked(groups, value: str) -> str:
    return f"coalesce(sum({value}) filter (g in {quoted(groups)}), 0)" if groups else "0"


TRIAL = """
with u as (select * from b_ledger_gl union all by name select * from b_ledger_pl),
s as (select *, nullif(line_code, '') as h, split_part(branch, '_', -1) as bn, regexp_extract(branch, '_([0-9]{2})_', 1) as no from u),
w as (select *, first(h ignore nulls) over (partition by bn, file_type, source_file order by line_seq rows between current row and unbounded following) as parent,
        if(h is null, split_part(description, '.', 1), '') as kind from s)
select business_date as load_date, bn as branch_name, if(no <> '', 'TL00100' || no, null) as co_code, right(file_type, 2) as statement_type, source_file, line_seq,
  h as original_line, parent as parent_line, description, opening_balance, debit_movements, credit_movements, closing_balance,
  nullif(case kind when 'PL' then split_part(description, '.', 3) when 'AC' then split_part(description, '.', 5) end, '') as product_key,
  nullif(case kind when 'PL' then split_part(description, '.', 9) when 'AC' then split_part(description, '.', 10) end, '') as loan_aging_status,
  nullif(case kind when 'PL' then split_part(description, '.', 2) end, '') as pl_account from w"""

LOANS = """
select t.load_date, t.branch_name, t.parent_line as line, count(distinct r.loan_id) as total_accounts
from m_trial_balance_detail t join b_map_total_assets g on g.account_code = t.parent_line and g.parent_group in ('CURRENT_LOAN', 'PAST_DUE')
join m_loan_risk r on r.company_code = t.co_code and cast(r.category as varchar) = t.product_key
  and (r.auto_class in ('STANDARD', 'UNDER-SUPERVISION')) = (g.parent_group = 'CURRENT_LOAN')
where t.statement_type = 'GL' and t.original_line is null group by 1, 2, 3"""

_MNEMONIC = "(values " + ", ".join(f"('{m}', '{c}')" for m, c in acc.DEPOSIT_BRANCHES.items()) + ") as t(mn, co)"
DEPOSITS = f"""
select r.business_date as load_date, m.co as co_code, r.gl_line as line, count(distinct r.account_number) as total_accounts
from b_deposit_report r join (select * from {_MNEMONIC}) m on m.mn = r.branch_name
where r.deposit_type <> 'loan' and r.gl_line not in ('4360', '4430', '4540') group by 1, 2, 3"""

_GL_SUM = "select load_date, branch_name, original_line as line, sum(closing_balance::decimal(18,2)) as amt from m_trial_balance_detail where statement_type = 'GL' and original_line is not null group by 1, 2, 3"
_COUNT_BY_BRANCH = "select d.load_date, t.branch_name, d.line, d.total_accounts from m_deposit_counts d join (select distinct branch_name, co_code from m_trial_balance_detail) t on t.co_code = d.co_code"


def _summary(seed: str, counts: str, body: str) -> str:
    return f"""with a as (select x.load_date, x.branch_name, s.parent_group as g, sum(x.amt) as amt from ({_GL_SUM}) x join b_{seed} s on s.account_code = x.line group by 1, 2, 3),
c as (select x.load_date, x.branch_name, s.parent_group as g, sum(x.total_accounts) as acc from ({counts}) x join b_{seed} s on s.account_code = x.line group by 1, 2, 3),
f as (select coalesce(a.load_date, c.load_date) as load_date, coalesce(a.branch_name, c.branch_name) as branch_name, coalesce(a.g, c.g) as g, amt, acc
      from a full join c on a.load_date = c.load_date and a.branch_name = c.branch_name and a.g = c.g)
{body}"""


def _stt(rows) -> str:
    return " union all ".join(
        f"select load_date, branch_name, {stt}::integer as stt, '{text.replace(chr(39), chr(39) * 2)}' as description, ({amount})::{M} as amount, "
        f"({count})::bigint as total_accounts from f group by 1, 2" for stt, text, amount, count in rows)


_CENTRAL = "first(branch_name) in ('Head Office', 'RE000010_03_SUKURSAL_GLENO')"
ASSET_SUMMARY = _summary("map_total_assets", "select * from m_loan_counts", _stt([
    (stt, text, picked(g, "amt") + (f" + if({_CENTRAL}, {picked(('INVESTMENT',), 'amt')}, 0)" if stt == 19 else ""),
     picked(g, "acc") + (f" + if({_CENTRAL}, {picked(('INVESTMENT',), 'acc')}, 0)" if stt == 19 else ""))
    for stt, text, g in acc.ASSET_SUMMARY]))
LIABILITY_SUMMARY = _summary("map_total_liabilities", _COUNT_BY_BRANCH, _stt([
    (stt, text, picked(g, "amt") + (f" + if({_CENTRAL}, {picked(('CAPITAL_BASE',), 'amt')}, 0)" if stt == 13 else ""), picked(n, "acc"))
    for stt, text, g, n in acc.LIABILITY_SUMMARY]))


def _lines(seed: str, value: str) -> str:
    return f"""select t.load_date, t.branch_name, t.original_line as account_code, s.account_name, s.parent_group, {value} as closing_balance
from (select load_date, branch_name, original_line, sum(closing_balance::decimal(18,2))::decimal(18,2) as v from m_trial_balance_detail where statement_type = 'PL' group by 1, 2, 3) t
left join b_{seed} s on s.account_code = t.original_line"""


INCOME_LINES = _lines("map_total_income", "t.v")
EXPENSE_LINES = _lines("map_total_expense", "if(t.branch_name = 'Head Office' and coalesce(t.original_line, '') = '1890', 0, t.v)::decimal(18,2)")


def _branch_report(seed: str, remap: dict, counts: str, summary: str, row: int, residual: str) -> str:
    case = "case {c} " + " ".join(f"when '{a}' then '{b}'" for a, b in remap.items()) + " else {c} end"
    return f"""with b as (select load_date, branch_name, {case.format(c='line')} as line, sum(amt) as amt from ({_GL_SUM}) group by 1, 2, 3),
n as (select load_date, branch_name, {case.format(c='line')} as line, sum(total_accounts) as acc from ({counts}) group by 1, 2, 3),
j as (select p.load_date, p.branch_name, s.*, coalesce(if(s.line is null, t.amount, b.amt), 0) as amt, coalesce(if(s.line is null, t.total_accounts, n.acc), 0)::bigint as cnt
      from (select distinct load_date, branch_name from b) p cross join b_{seed} s
      left join b on b.load_date = p.load_date and b.branch_name = p.branch_name and b.line = s.line
      left join n on n.load_date = p.load_date and n.branch_name = p.branch_name and n.line = s.line
      left join m_{summary} t on t.load_date = p.load_date and t.branch_name = p.branch_name and t.stt = s.stt_noline)
select load_date, branch_name, order_id, code, description, if(order_id = {row}, {residual}, amt)::{M} as amount, cnt as total_accounts, {label('load_date')} as load_date_label
from j window w as (partition by load_date, branch_name)"""


ASSETS = _branch_report("map_detail_assets", acc.ASSET_LINES, "select * from m_loan_counts", "asset_summary", 126,
                        "max(if(coalesce(line, '') = '3865', amt, 0)) over w - max(if(coalesce(stt_noline, 0) = 19, amt, 0)) over w")
LIABILITIES = _branch_report("map_detail_liabilities", acc.LIABILITY_LINES, _COUNT_BY_BRANCH, "liability_summary", 82,
                             "max(if(coalesce(stt_noline, 0) = 13, amt, 0)) over w - (max(if(coalesce(line, '') = '7240', amt, 0)) over w + max(if(coalesce(line, '') = '7045', amt, 0)) over w)")


def _profit_report(seed: str, lines: str) -> str:
    return f"""select p.load_date, p.branch_name, s.order_id, s.code, s.description, s.line, s.stt_noline,
  if(s.line is null, null, coalesce(x.closing_balance, 0))::decimal(18,2) as amount, {label('p.load_date')} as load_date_label
from (select distinct load_date, branch_name from m_trial_balance_detail where statement_type = 'PL') p cross join b_{seed} s
left join m_{lines} x on x.load_date = p.load_date and x.branch_name = p.branch_name and x.account_code = s.line"""


def _compared(history: str) -> str:
    return f"""with f as (select *, date_trunc('month', load_date)::date as mon from b_{history}),
ms as (select distinct mon from f),
p as (select mon, mon as start, 'CURR' as tag, 3 as o from ms union all select mon, (mon - interval 1 month)::date, 'PREV', 2 from ms
      union all select mon, (mon - interval 1 year)::date, 'YOY', 1 from ms),
g as (select mon, order_id, description, sum(amount) as amount, sum(total_accounts) as n from f group by 1, 2, 3),
b as (select p.mon, s.order_id, s.description, p.tag, p.o, coalesce(g.amount, 0)::{M} as amount, coalesce(g.n, 0)::bigint as accts
      from p cross join (select distinct order_id, description from f) s left join g on g.mon = p.start and g.order_id = s.order_id and g.description = s.description),
l as (select *, lag(amount) over (partition by mon, order_id, description order by o) as before from b)
select strftime(mon, '%Y-%m') as report_month, c.code, l.order_id, l.description, tag as type_period, accts, amount, (amount - before)::{M} as increase_prev_period,
  (amount - before)::{M}::double / nullif(before::double, 0) as pct_change_prev_period, monthname(mon) || ' ' || year(mon) as report_month_label
from l left join (select distinct order_id, description, code from f) c on c.order_id = l.order_id and c.description = l.description"""


_ML = "monthname((report_month || '-01')::date) || ' ' || left(report_month, 4)"
_RETURN = "(values " + ", ".join(f"('{code}', '{text}', '{src}')" for code, text, sources in acc.ASSET_RETURN for src in sources) + ") as t(code, text, src)"
SHEET_ASSETS = f"""
with r as (select report_month, description, sum(amount) as v from m_assets_compared group by 1, 2),
d as (select t.code, t.text, m.report_month, sum(if(t.code in ('1.4.3', '1.5.4', '1.6.9'), -abs(coalesce(r.v, 0)), coalesce(r.v, 0))) as amount
      from (select * from {_RETURN}) t cross join (select distinct report_month from r) m left join r on r.report_month = m.report_month and r.description = t.src group by 1, 2, 3),
s as (select left(code, 3) as code, case when len(code) < 5 then null when code[1:3] = '1.1' then 'Liquid Funds' when code[1:3] = '1.4' then 'Loans, Advances and Discount'
        when code[1:3] = '1.5' then 'Accounts Receivable' when code[1:3] = '1.6' then 'Fixed Assets' when code[1:3] = '1.9' then 'Other Assets' end as text, report_month, sum(amount) as amount from d group by 1, 2, 3)
select code, text as description, report_month, {_ML} as report_month_label, amount::{M} as amount
from (select * from d union all select * from s union all select '1.0', 'TOTAL ASSETS', report_month, sum(amount) from s group by report_month)"""

_CURR = "select report_month, code as c, description as d, sum(amount) as v from m_liabilities_compared where type_period = 'CURR' group by 1, 2, 3"
SHEET_LIABILITIES = f"with r as ({_CURR}) " + " union all ".join(
    f"select '{code}' as code, '{text}' as description, report_month, coalesce(sum(v) filter ("
    + " or ".join([f"d in {quoted(labels)}"] * bool(labels) + [f"c in {quoted(codes)}"] * bool(codes) or ["false"])
    + f"), 0)::{M} as amount, {_ML} as report_month_label from r group by report_month" for code, text, labels, codes in acc.LIABILITY_RETURN)

LIQUIDITY = f"""
with a as (select report_month, coalesce(sum(amount) filter (description in ('Cash in Vault', 'Cash in ATM Vault')), 0) as vault,
    coalesce(sum(amount) filter (description in ('Due from Central Bank', 'Items in course of collect.', 'Foreign Currency')), 0) as central,
    coalesce(sum(amount) filter (code in ('I23', 'I28', '1.01.4.3') or description in ('Call Deposits', 'Foreign Currency') or (code = '1.01.4.1.2' and description = 'OTHERS')), 0) as fi
  from m_assets_compared group by 1),
l as (select report_month, coalesce(sum(amount) filter (description in ('Demand Deposit', 'Time Deposits', 'Other liabilit/Due To Branch', 'Other Liabilit/Due To Branch') or code = 'I201'), 0) as owed
  from m_liabilities_compared group by 1)
select report_month, vault::double as "Vault_Cash", 0::double as "Precious_metals", central::double as "Deposits_with_BCTL", fi::double as "Deposits_in_Other_Financial_Institutions",
  0::double as "Readily_Marketable_Securities", 0::double as "Net_inter_bank_lending_borrowing_1_month", (vault + central + fi)::double as "Total_Highly_Liquid_Assets",
  coalesce(owed, 0)::double as "Total_Liabilities", (vault + central + fi)::double / nullif(owed::double, 0) as "Liquidity_Ratio", {_ML} as report_month_label
from a left join l using (report_month)"""


def _leaf(parts, leaf_map: str) -> str:
    source = " union all ".join(f"select '{tag}' as t, load_date, code, description, {sign} * amount::decimal(18,2) as v from m_{mart} where branch_name <> 'ATAURO'"
                                for tag, mart, sign in parts)
    return f"""select s.load_date, m.order_id, sum(s.v) as v from ({source}) s join b_{leaf_map} m
  on m.src_tag = s.t and m.description = s.description and m.code is not distinct from s.code group by 1, 2"""


POSITION_LEAVES = f"select load_date, order_id, (v + if(order_id = 82, 0.01, 0))::decimal(18,2) as amount from ({_leaf((('AST', 'assets_report', -1), ('LIB', 'liabilities_report', 1)), 'position_leaf_map')})"
_DEPR = "code = '5.03.7.6' and description = 'Depr. Non Physical Assets'"
EARNINGS_LEAVES = f"""
select load_date, order_id, v::decimal(18,2) as amount from ({_leaf((('INC', 'income_report', 1), ('EXP', 'expense_report', -1)), 'earnings_leaf_map')})
union all select load_date, 107, (-sum(amount))::decimal(18,2) from m_expense_report where branch_name = 'UPGRADE' and {_DEPR} group by 1"""


def _statement(leaves: str, layout: str, rows: dict[int, str], prefix: str = "") -> str:
    subs = " union all ".join(f"select load_date, {row} as order_id, ({expr})::decimal(18,2) as amount from l group by load_date" for row, expr in rows.items())
    return f"""with l as ({leaves}){prefix}, al as (select load_date, order_id, amount from l union all {subs})
select d.load_date, s.section, s.order_id, s.code, s.description, s.row_type, coalesce(al.amount, 0)::decimal(18,2) as amount, {label('d.load_date')} as load_date_label
from (select distinct load_date from l) d cross join b_{layout} s left join al on al.load_date = d.load_date and al.order_id = s.order_id"""


def rng(cond: str) -> str:
    return f"coalesce(sum(amount) filter ({cond}), 0)"


def span(lo: int, hi: int) -> str:
    return rng(f"order_id between {lo} and {hi}")


_TOTAL_ASSETS = rng("order_id between 10 and 83 or order_id between 89 and 93")
_TOTAL_OWED = rng("order_id between 108 and 156 and order_id <> 146")
POSITION = _statement("select * from m_position_leaves", "position_layout", {
    9: span(10, 16), 14: span(15, 16), 18: span(19, 19), 20: span(22, 57), 21: span(22, 36), 37: span(38, 53), 54: span(55, 57), 58: span(59, 61), 62: span(63, 76),
    70: span(71, 76), 77: rng("order_id between 78 and 93 and order_id not between 84 and 88 and order_id <> 80"), 80: span(81, 83), 84: span(85, 86), 88: span(89, 93),
    94: _TOTAL_ASSETS, 106: span(108, 132), 107: span(108, 111), 113: span(114, 115), 117: span(118, 132), 133: span(134, 145), 150: span(151, 156), 154: span(155, 156),
    158: _TOTAL_OWED, 159: f"{_TOTAL_OWED} - {_TOTAL_ASSETS}"})
_EXPENSE = {64: span(66, 71), 65: span(66, 68), 69: span(70, 70), 72: span(73, 75), 76: span(78, 133), 77: span(78, 84), 85: span(87, 94), 86: span(87, 94), 97: span(98, 99),
            100: span(101, 102), 103: span(104, 110), 111: span(112, 112), 113: span(114, 133)}
EARNINGS = _statement("select * from m_earnings_leaves", "earnings_layout", {
    8: span(9, 45), 12: span(14, 44), 13: span(14, 28), 29: span(30, 44), 46: span(47, 57), 48: span(49, 57), 58: span(59, 61), 62: span(9, 61), **_EXPENSE,
    135: span(136, 138), 139: span(66, 138), 140: f"{span(9, 61)} - {span(66, 138)}", 142: f"{span(9, 61)} - {span(66, 141)}"})
_C107 = f"(select coalesce(max(v), 0) from (select load_date as ld, (-sum(amount))::decimal(18,2) as v from m_expense_report where branch_name <> 'ATAURO' and {_DEPR} group by 1) where ld = l.load_date)"
_OPEX = f"({span(66, 137)} - {rng('order_id = 107')} + {_C107})"
INCOME_STATEMENT = _statement(
    "select load_date, case when order_id between 9 and 28 or order_id between 136 and 138 or order_id = 141 then order_id - 1 else order_id end as order_id, amount from m_earnings_leaves",
    "income_layout", {7: span(8, 45), 11: span(13, 45), 12: span(13, 27), 29: span(30, 45), 46: span(47, 57), 48: span(49, 57), 58: span(59, 61), 62: span(8, 61), **_EXPENSE,
                      134: span(135, 137), 138: _OPEX, 139: f"{span(8, 61)} - {_OPEX}", 141: f"{span(8, 61)} - {_OPEX} - {rng('order_id = 140')}"})

RATIOS = f"""
with s as (select load_date, {', '.join(f"coalesce(sum(amount) filter (order_id = {row}), 0) as {n}" for n, row in acc.POSITION_PICKS.items())} from m_position_statement group by 1),
p as (select load_date, {', '.join(f"coalesce(sum(amount) filter (order_id = {row}), 0) as {n}" for n, row in acc.EARNINGS_PICKS.items())} from m_earnings_statement group by 1),
v as (select s.*, p.* exclude (load_date), current_loans + past_due as gl, capital_paid_up + capital_reserve + profits_losses as eq, deposits - gov_dd - gov_td + bank_garansi as dep,
  current_loans + past_due + comm_banks as ea, 0.2 * (items_in_collection + comm_banks) + current_loans + past_due + provision + fixed_assets + receivable + other_assets as atmr from s join p using (load_date)),
r as ({' union all '.join(f"select load_date, '{i}' as ratio_id, '{c}' as ratio_code, '{n}' as ratio_name, {sec}::integer as section, ({a})::decimal(18,2) as numerator, ({b})::decimal(18,2) as denominator, {k}::double as scale from v" for i, c, n, sec, a, b, k in (
    ('r01', 'QR', 'Quick Ratio', 1, 'liquid_funds', 'deposits', 100), ('r02', 'BK', 'Banking Ratio', 1, 'gl', 'deposits', 100), ('r03', 'ALR', 'Assets to Loan Ratio', 1, 'gl', 'total_assets', 100),
    ('r04', 'CR', 'Cash Ratio', 1, 'liquid_funds', 'seasonal_crop + project_loan + microfinance', 100), ('r05', 'LDR', 'Loan to Deposit Ratio', 1, 'gl', 'dep', 100),
    ('r06', 'PR', 'Primary Ratio', 2, 'eq', 'total_assets', 100), ('r07', 'RAR', 'Risk Assets Ratio', 2, 'eq', 'total_assets - liquid_funds', 100),
    ('r08', 'CR2', 'Capital Ratio', 2, 'capital_accounts - provision + provisioning', 'gl', 100), ('r09', 'CAR', 'Capital Adequacy Ratio', 3, 'capital_paid_up + profits_losses', 'atmr', 100),
    ('r10', 'NPL', 'Non-Performing Loan Ratio', 3, 'past_due', 'gl', 100), ('r11', 'AQ', 'Asset Quality', 3, '-provision', 'ea', 100), ('r12', 'NPM', 'Net Profit Margin', 3, 'after_tax', 'op_income', 100),
    ('r13', 'NIM', 'Net Interest Margin', 3, 'due_from_banks + income_loans - indiv_deposits', 'ea', 100), ('r14', 'ROA', 'Return on Assets', 3, 'before_tax', 'total_assets', 100),
    ('r15', 'BOPO', 'Cost-to-Income Ratio (BOPO)', 3, 'op_expenses', 'op_income', 100), ('r16', 'ROE', 'Return on Equity', 3, 'after_tax', 'eq', 100), ('r17', 'LDR_C', 'LDR (CAMEL)', 3, 'gl', 'dep', 100),
    ('r18', 'IBK', 'Interbank Net Obligation', 3, '0', 'liquid_funds', 0), ('r19', 'IER', 'Interest Expense Ratio', 3, 'interest_expense', 'biz_dd + others_td + hnf', 100),
    ('r20', 'AT', 'Asset Turnover', 4, 'op_income', 'total_assets', 1), ('r21', 'VLDR', 'Variant LDR', 4, 'gl', 'dep - gov_dd - 175000000', 1)))})
select load_date, ratio_id, ratio_code, ratio_name, section, numerator, denominator, if(scale = 0, 0, numerator::double / nullif(denominator::double, 0) * scale)::decimal(18,4) as ratio_pct,
  {label('load_date')} as load_date_label from r"""


def _section(mart: str, number: int, sign: str) -> str:
    return f"select load_date, {number} as sec, order_id, code, description, {sign}sum(amount) as amount from m_{mart} group by load_date, order_id, code, description"


def _fixed(number: int, rows) -> str:
    return ", ".join(f"({number}, {i}, '{c}', '{t}')" for i, (c, t) in enumerate(rows, 1))


RETURN = f"""
with pr as (select i.load_date, i.v + coalesce(e.v, 0) as profit from (select load_date, coalesce(sum(amount), 0) as v from m_income_report where code <> '4.0' group by 1) i
            left join (select load_date, sum(amount) as v from m_expense_report where code <> '5.0' group by 1) e using (load_date)),
lb as (select l.load_date, if(code[1] = '2', 2, 3) as sec, order_id, code, description, if(code = '3.06.2', coalesce(pr.profit, 0), amount) as amount
       from ({_section('liabilities_report', 0, '')}) l left join pr using (load_date) where regexp_matches(code, '^[23][.-]')),
st as (select load_date, -sum(amount) filter (order_id in (56, 57, 73, 74)) as v from m_assets_report group by 1),
al as ({_section('assets_report', 1, '-')} union all select * from lb union all {_section('income_report', 4, '')} union all {_section('expense_report', 5, '-')}
  union all select load_date, n.sec, n.o, n.code, n.txt, if(n.code in ('8.11', '8.11.2'), coalesce(st.v, 0), null) from st cross join (values {_fixed(7, acc.CONTINGENT)}, {_fixed(8, acc.MEMORANDA)}) n(sec, o, code, txt)),
t as (select load_date, sum(amount) filter (sec = 1 and code like '1.%' and code not like '1.%.%' and code <> '1.0') as a, sum(amount) filter (sec = 4 and code <> '4.0') as i,
        sum(amount) filter (sec = 5 and code <> '5.0') as e, sum(amount) filter (sec = 3 and code in ('3.06.1', '3.06.2')) as p,
        sum(amount) filter (sec = 3 and ((code like '3.0%' and code not like '3.0%.%' and code not in ('3.0', '3.06')) or code like '3-%')) as c,
        sum(amount) filter (sec = 2 and code like '2.%' and code not like '2.%.%' and code <> '2.0') as l from al group by 1)
select al.load_date, sec::integer as bctl_section, order_id::integer as order_id, code, description, {label('al.load_date')} as load_date_label,
  (case when sec = 1 and code = '1.0' then coalesce(a, 0) when sec = 2 and code = '2.0' then coalesce(l, 0) + coalesce(c, 0) + coalesce(p, 0)
     when sec = 3 and code = '3.0' then coalesce(c, 0) + coalesce(p, 0) when sec = 3 and code = '3.06' then coalesce(p, 0)
     when sec = 4 and code = '4.0' then coalesce(i, 0) when sec = 5 and code = '5.0' then coalesce(e, 0) else amount end)::decimal(18,2) as amount
from al left join t using (load_date)"""

# name: (marts it reads, views it reads, statement)
CHAIN = {
    "trial_balance_detail": ("", "ledger_gl ledger_pl", TRIAL),
    "loan_risk": ("", SILVER["loan_risk"][0], SILVER["loan_risk"][1]),
    "loan_counts": ("trial_balance_detail loan_risk", "map_total_assets", LOANS),
    "deposit_counts": ("", "deposit_report", DEPOSITS),
    "asset_summary": ("trial_balance_detail loan_counts", "map_total_assets", ASSET_SUMMARY),
    "liability_summary": ("trial_balance_detail deposit_counts", "map_total_liabilities", LIABILITY_SUMMARY),
    "income_lines": ("trial_balance_detail", "map_total_income", INCOME_LINES),
    "expense_lines": ("trial_balance_detail", "map_total_expense", EXPENSE_LINES),
    "assets_report": ("trial_balance_detail loan_counts asset_summary", "map_detail_assets", ASSETS),
    "liabilities_report": ("trial_balance_detail deposit_counts liability_summary", "map_detail_liabilities", LIABILITIES),
    "income_report": ("trial_balance_detail income_lines", "map_detail_income", _profit_report("map_detail_income", "income_lines")),
    "expense_report": ("trial_balance_detail expense_lines", "map_detail_expense", _profit_report("map_detail_expense", "expense_lines")),
    "assets_compared": ("", "assets_history", _compared("assets_history")),
    "liabilities_compared": ("", "liabilities_history", _compared("liabilities_history")),
    "balance_sheet_assets": ("assets_compared", "", SHEET_ASSETS),
    "balance_sheet_liabilities": ("liabilities_compared", "", SHEET_LIABILITIES),
    "liquidity": ("assets_compared liabilities_compared", "", LIQUIDITY),
    "position_leaves": ("assets_report liabilities_report", "position_leaf_map", POSITION_LEAVES),
    "earnings_leaves": ("income_report expense_report", "earnings_leaf_map", EARNINGS_LEAVES),
    "position_statement": ("position_leaves", "position_layout", POSITION),
    "earnings_statement": ("earnings_leaves", "earnings_layout", EARNINGS),
    "income_statement": ("earnings_leaves expense_report", "income_layout", INCOME_STATEMENT),
    "ratio_sheet": ("position_statement earnings_statement", "", RATIOS),
    "central_bank_return": ("assets_report liabilities_report income_report expense_report", "", RETURN),
}


def accounting_sql(name: str) -> str:
    order: list[str] = []
    views: list[str] = []

    def visit(mart: str) -> None:
        marts, needed, _ = CHAIN[mart]
        for m in marts.split():
            visit(m)
        views.extend(v for v in needed.split() if v not in views)
        if mart not in order:
            order.append(mart)

    visit(name)
    chain = ",\n".join(f"m_{m} as materialized ({CHAIN[m][2].strip()})" for m in order[:-1])
    return f"with {duck_views(views)}{',' if chain else ''}\n{chain}\nselect * from ({CHAIN[name][2].strip()})"


ACCOUNTING = {name: accounting_sql(name) for name in CHAIN if name != "loan_risk"}

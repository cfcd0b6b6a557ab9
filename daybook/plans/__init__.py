"""Registry of marts and reports by name."""

from daybook.plans import accounting, credit, operational, silver

MARTS = {f.__name__: f for f in (
    silver.acct_cust, silver.closed_accounts, silver.locked_amounts, silver.category_entry_book, silver.loan_risk,
    silver.lending_arrangements, silver.inward_remittance, silver.inactive_accounts, silver.missing_documents,
    silver.large_daily_txn, silver.opened_accounts, silver.written_off_loans, silver.account_statement,
    silver.statement_book, silver.trial_balance_detail,
    credit.disbursement_consolidation, credit.monthly_disbursement, credit.loan_sector_daily, credit.loan_sector_yearly,
    credit.provision, credit.repayment, credit.extra_accountable,
    operational.closed_account_listing, operational.opened_account_listing, operational.deposit_listing,
    operational.savers_by_age, operational.savers_by_gender, operational.contact_listing,
    operational.large_txn_report, operational.inactive_account_report, operational.missing_document_report,
    operational.opened_account_report, operational.remittance_daily, operational.remittance_quarterly,
    operational.deposits_by_sector, operational.batch_marker,
    *accounting.REPORTS)}

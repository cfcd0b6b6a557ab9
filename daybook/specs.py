"""Fixed values of the reports: codes, labels and orders that must stay as they are."""

from __future__ import annotations

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")
MONTH_TAGS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# Company code, branch name, presentation order.
BRANCHES = (
    ("TL0010001", "BNK", 1), ("TL0010002", "DILI", 2), ("TL0010003", "GLENU", 3),
    ("TL0010004", "MALIANA", 4), ("TL0010005", "AILEU", 5), ("TL0010006", "OECUSSE", 6),
    ("TL0010007", "BAUCAU", 7), ("TL0010008", "SAME", 8), ("TL0010009", "AINARO", 9),
    ("TL0010010", "SUAI", 10), ("TL0010011", "VIQUEQUE", 11), ("TL0010012", "LOSPALOS", 12),
    ("TL0010013", "LISQUICA", 13), ("TL0010014", "MANATUTO", 14),
)
BRANCH_NAME = {code: name for code, name, _ in BRANCHES}

# Company code, municipality (as the customer listings use it).
BRANCH_MUNICIPALITY = {
    "TL0010002": "Dili", "TL0010003": "Ermera", "TL0010004": "Bobonaro", "TL0010005": "Manatuto",
    "TL0010006": "Aileu", "TL0010007": "Oecusse", "TL0010008": "Baucau", "TL0010009": "Manufahi",
    "TL0010010": "Ainaro", "TL0010011": "Cova Lima", "TL0010012": "Viqueque", "TL0010013": "Lauten",
    "TL0010014": "Liquica",
}

# Municipalities in report order.
MUNICIPALITIES = (
    (1, "Aileu"), (2, "Ainaro"), (3, "Baucau"), (4, "Bobonaro"), (5, "Cova Lima"), (6, "Dili"),
    (7, "Ermera"), (8, "Liquica"), (9, "Lauten"), (10, "Manufahi"), (11, "Manatuto"),
    (12, "Oecusse"), (13, "Viqueque"),
)

# Loan category, product name, presentation order.
LOAN_PRODUCTS = (
    ("3001", "Market Vendor Loan", 1), ("3002", "Group Loan", 2), ("3003", "Seasonal Loan", 3),
    ("3004", "Business Loan", 4), ("3005", "Transport Loan", 5), ("3006", "Project Loan", 6),
    ("3007", "Investmen Loan", 7), ("3008", "FIAR", 8), ("3009", "Agriculture Loan", 9),
    ("3021", "Multi Purpose Loan", 10), ("3024", "Buka'e", 11), ("3025", "Asuwa'in", 12),
    ("3026", "Pension Loan", 13), ("3027", "Internal Staff Loan", 14), ("3028", "RBL", 15),
)

# Deposit category, product label.
DEPOSIT_PRODUCTS = {
    "1001": "Giro", "1002": "Government", "1003": "Group", "1190": "Time Deposite",
    "6005": "Passbook saving", "6006": "Futuru Savings", "6007": "Eldery Saving",
    "6008": "Pledge Saving", "6009": "Pledge Saving", "6010": "BDM JF", "6011": "BDM",
    "6012": "Asu'wain", "6013": "Pensionista",
}

# Credit sectors; sector 10 collects what is not mapped.
SECTORS = (
    (1, "Agriculture, Water & Forestry"), (2, "Industry"), (3, "Manufacturing"), (4, "Construction"),
    (5, "Transport & Communication"), (6, "Trade & Finance"), (8, "Services"), (9, "Individuals"),
    (10, "Others (Other sectors not in the list)"), (11, "Tourism"),
)
OTHER_SECTOR = 10

# Asset class, provision rate; other classes carry none.
PROVISION_RATES = {"LOSS": 1.0, "DOUBTFUL": 0.50, "SUB-STANDARD": 0.25}
ASSET_CLASSES = {"standard": "STANDARD", "under_supervision": "UNDER-SUPERVISION", "sub_standard": "SUB-STANDARD",
                 "doubtful": "DOUBTFUL", "loss": "LOSS"}

# Arrangement status, display text.
ARRANGEMENT_STATUS = {"AUTH": "Not Disbursed", "CURRENT": "Current", "EXPIRED": "Expired",
                      "PENDING.CLOSURE": "Pending Closure", "UNAUTH": "Unauthorised"}
CLOSED_ARRANGEMENTS = ("UNAUTH", "CANCELLED", "CLOSE", "MATURED")

LARGE_TXN_TOTAL = 9000
SAVINGS_CATEGORY_RANGE = ("6006", "6015")  # compared as text
DOCUMENT_CATEGORIES = ("6005", "6006", "6007", "6010", "1001", "1002", "1003")
LEGAL_DOC_LOOKUP = "CUS.LEGAL.DOC.NAME*"

"""Fixed-layout text reports: general ledger / profit and loss listings and deposit listings.

Files are read line by line, so one huge file is split over many tasks. What a line means may depend
on lines before or after it; that state is carried with the split-safe ``carry`` operator. With ``hot`` long files are cut once for all carries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.functions.columns import MONEY, blank_null, lookup
from daybook.operators.frames import SLICE, carry, numbered, running_sum, slices
from daybook.operators.staging import materialise

C = F.col
# characters that end a line besides newline, as page printers use them
BREAKS = "[\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def read_lines(spark: SparkSession, path: str, hot: bool = False) -> DataFrame:
    """Numbered lines of all files under ``path``: source_file, line_seq (from 1), line.

    Place in the file is (start of the input split, place in the split), which does not depend on
    how splits are packed into tasks.
    """
    raw = spark.read.text(path).select(
        C("_metadata.file_path").alias("file"), C("_metadata.file_name").alias("source_file"),
        C("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"),
        F.posexplode(F.split("value", BREAKS)).alias("piece", "line"))
    seq = numbered(raw, ["file"], ["block", "place", "piece"], "line_seq", hot=hot)
    return seq.select("file", "source_file", "line_seq", "line")


# Line patterns of the ledger listing.
AMOUNT = r"(-?\d{1,3}(?:,\d{3})*\.\d{2})"
FOUR_AMOUNTS = rf"{AMOUNT}\s+{AMOUNT}\s+{AMOUNT}\s+{AMOUNT}\s*$"
ACCOUNT_ROW = rf"^\s+((?:AC|MD)\.[^\s]+)\s+{FOUR_AMOUNTS}"
DATA_ROW = rf"^\s*(\d{{4}})?\s+(.+?)\s+{FOUR_AMOUNTS}"
ACCOUNT_CODE = r"^\s+(AC\.|MD\.)"
CONTINUATION = r"^\s+[.\dTLA-Z]+[\w.]*$"
HEADER_ROW = r"^\s*(\d{4})\s+([A-Za-z\s].+?)\s*$"
REMARK = r"^\s+(?:[A-Z0-9]+\s+)?\([^)]*\)?\s*$|^\s+[a-zA-Z][a-zA-Z\s\-,&./]*\)\s*$"
PAGE_MARKS = ("RE000010", "AREA NAME", "PAGE NO", "LINE  DESCRIPTION", "----  -----------", "PRINTED AT",
              "( IN FULL AMOUNT )", "OPENING BALANCE", "DEBIT MOVEMENTS")
END_MARK = "END OF REPORT"
REPORT_MARK = "RE000010"
HEAD_CHARS, HEAD_LINES = 1500, 30


def _has(marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | C("line").contains(m)
    return out


def _groups(text: Column | str, pattern: str, n: int) -> Column:
    """All groups of a matching text as an array, from a single match; a group that took no part is blank."""
    return F.split(F.regexp_replace(text, pattern, "\x01".join(f"${i}" for i in range(1, n + 1))), "\x01")


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


def file_headers(lines: DataFrame, bank: str) -> DataFrame:
    """Report type and branch per file, from its first lines. ``bank`` is the bank's mark in the title."""
    top = lines.filter(C("line_seq") <= HEAD_CHARS).withColumn("_len", F.length("line") + 1)
    top = running_sum(top, ["file"], ["line_seq"], "_len", "_end", hot=False)  # at most HEAD_CHARS lines per file
    text = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(
        F.when(C("_end") - C("_len") < HEAD_CHARS, F.struct("line_seq", "line")))), lambda x: x["line"]))
    words = F.split(F.regexp_replace("line", r"^\s+|\s+$", ""), r"\s+")
    titled = C("line").rlike(r"^\s*RE\d+") & (F.size(words) >= 2)
    heads = top.groupBy("file").agg(
        F.upper(F.substring(text, 1, HEAD_CHARS)).alias("head"),
        F.min(F.when(titled, F.struct("line_seq", words.alias("words")))).alias("title"),
        F.min(F.when((C("line_seq") > HEAD_LINES) & (F.trim("line") != ""), C("line_seq"))).alias("limit"))
    mark = F.array_position(F.transform("title.words", lambda w: w.contains(bank)), True)
    parts = F.when(mark > 0, F.slice("title.words", 1, (mark - 1).cast("int"))).otherwise(F.slice("title.words", 1, 4))
    name = F.regexp_replace(F.upper(F.regexp_replace(F.array_join(parts, "_"), "[^A-Za-z0-9_]", "_")), "_+", "_")
    in_reach = C("title").isNotNull() & (C("limit").isNull() | (C("title.line_seq") <= C("limit")))
    head = C("head")
    ledger = F.when(head.contains("PROFIT AND LOSS"), "PL").when(head.contains("GENERAL LEDGER"), "GL")
    kind = (F.when(~(head.contains(REPORT_MARK) & head.contains(bank.upper())), "UNKNOWN")
            .when(head.contains("BALANCE DETAILS") & head.contains("IN USD"), "CRB")
            .when(ledger.isNull(), "UNKNOWN")
            .otherwise(F.concat(F.when(head.contains("LIVE SYSTEM"), "CRC_").otherwise("CRF_"), ledger)))
    return heads.select("file", kind.alias("file_type"),
                        F.when(in_reach, F.trim(name, F.lit("_"))).otherwise("UNKNOWN_BRANCH").alias("branch"))


def parse_ledger(lines: DataFrame, bank: str, join_continuations: bool = False, hot: bool = False) -> DataFrame:
    """Ledger rows with their line number.

    A wrapped account code waits (over blank lines and page heads) for the next data row, whose
    description it precedes; continuations in between extend it. A continuation with no code waiting
    is dropped, or with ``join_continuations`` added to the row just above it. (A code made of
    letters, digits and dots only looks like a continuation and counts as one.)
    """
    ends = lines.filter(C("line").contains(END_MARK)).groupBy(C("file").alias("f")).agg(F.min("line_seq").alias("end"))
    headers = file_headers(lines, bank).filter(~C("file_type").isin("CRB", "UNKNOWN"))
    if hot:  # written out, a row per file shows its size, and lines need not meet by file to be joined
        ends, headers = materialise(ends), materialise(headers)
    body = lines.join(ends, C("file") == C("f"), "left").filter(C("end").isNull() | (C("line_seq") < C("end"))).drop("f", "end")
    body = body.join(headers, "file")
    line = C("line")
    kind = (F.when(line.rlike(r"^\s*$") | _has(PAGE_MARKS), "stop").when(line.rlike(REMARK), "remark")
            .when(line.rlike(CONTINUATION), "more").when(line.rlike(ACCOUNT_ROW), "account")
            .when(line.rlike(ACCOUNT_CODE), "code").when(line.rlike(DATA_ROW), "data")
            .when(line.rlike(HEADER_ROW), "header").otherwise("stop"))
    body = body.withColumn("kind", kind)
    # the data row that ends the current stretch, the last code line, the last line that sets the row above
    marks = {"at_data": F.when(C("kind") == "data", C("line_seq")),
             "at_row": F.when(~C("kind").isin("remark", "more"), F.struct("line_seq", "kind"))}
    if hot:
        hot = slices(body.withColumns(marks), ["file"], ["line_seq"], sample=lines)
        body = hot.place(body)
    body = body.withColumns(marks)
    body = carry(body, ["file"], "line_seq", "at_data", "stretch", backward=True, hot=hot)
    body = body.withColumn("at_code", F.when(C("kind") == "code", F.struct("line_seq", F.coalesce("stretch", F.lit(-1)).alias("s"))))
    body = carry(body, ["file"], "line_seq", "at_code", "code", hot=hot)
    body = carry(body, ["file"], "line_seq", "at_row", "above", hot=hot)
    # the classified lines are read three times below
    body = materialise(body.drop("at_data", "at_row", "at_code", SLICE))
    waiting = F.coalesce(C("code.s") == F.coalesce("stretch", F.lit(-1)), F.lit(False))
    text = F.regexp_replace("line", r"^\s+|\s+$", "")

    def joined(pieces: DataFrame, key: Column, name: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("line_seq", text.alias("t"))))
        return pieces.groupBy(C("file").alias("f"), key.alias("at")).agg(
            F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias(name))

    codes = joined(body.filter(waiting & C("stretch").isNotNull() & C("kind").isin("code", "more")
                               & (C("line_seq") >= C("code.line_seq"))), C("stretch"), "waiting_code")
    tails = joined(body.filter((C("kind") == "more") & ~waiting & C("above.kind").isin("account", "data")),
                   C("above.line_seq"), "tail")
    account, data, header = C("kind") == "account", C("kind") == "data", C("kind") == "header"
    nothing = F.lit("")
    # code, description and four amounts, whatever the kind of row
    cells = (F.when(data, _groups("line", DATA_ROW, 6))
             .when(account, F.concat(F.array(nothing), _groups("line", ACCOUNT_ROW, 5)))
             .otherwise(F.concat(_groups("line", HEADER_ROW, 2), F.array(*[nothing] * 4))))
    rows = body.filter(account | data | header).withColumn("cells", cells)
    rows = rows.join(codes, (C("file") == codes["f"]) & (C("line_seq") == codes["at"]), "left").drop("f", "at")
    if join_continuations:
        rows = rows.join(tails, (C("file") == tails["f"]) & (C("line_seq") == tails["at"]), "left").drop("f", "at")
    else:
        rows = rows.withColumn("tail", F.lit(None).cast("string"))
    own = F.trim(C("cells")[1])
    named = F.concat(F.when(data & C("waiting_code").isNotNull(), F.concat("waiting_code", F.lit(" "))).otherwise(""),
                     own, F.coalesce("tail", F.lit("")))
    balances = ("opening_balance", "debit_movements", "credit_movements", "closing_balance")
    return rows.select(C("cells")[0].alias("line_code"), named.alias("description"),
                       *[_number(C("cells")[n]).alias(c) for n, c in enumerate(balances, 2)],
                       "source_file", "branch", "file_type", "line_seq")


def ledger_statistics(rows: DataFrame) -> DataFrame:
    """Rows and balance totals per file, with the time its name carries (two styles)."""
    name = C("source_file")
    stamp = F.coalesce(F.try_to_timestamp(blank_null(F.regexp_extract(name, r"(\d{8}_\d{6})", 1)), F.lit("yyyyMMdd_HHmmss")),
                       F.try_to_timestamp(blank_null(F.regexp_extract(name, r"(\d{8})(?!\d)", 1)), F.lit("yyyyMMdd")))
    sums = [F.sum(C(c).cast(MONEY)).alias(f"total_{c}") for c in
            ("opening_balance", "debit_movements", "credit_movements", "closing_balance")]
    return rows.groupBy("source_file", "branch", "file_type").agg(F.count(F.lit(1)).alias("rows"), *sums) \
        .withColumn("file_time", stamp)


# A listing with more rows than this is a detailed one.
DETAILED_ROWS = {"GL": 654, "PL": 242}


def best_files(statistics: DataFrame) -> DataFrame:
    """Per ledger and branch the newest detailed file, else the newest file."""
    ledger = F.substring_index("file_type", "_", -1)
    detailed = F.coalesce(C("rows") > lookup(ledger, DETAILED_ROWS), F.lit(False))
    best = statistics.groupBy(ledger.alias("ledger"), "branch").agg(F.max(F.struct(
        detailed.cast("int").alias("detailed"), "file_time", "source_file", "rows")).alias("b"))
    return best.select("ledger", "branch", "b.source_file", "b.rows", (C("b.detailed") == 1).alias("is_detailed"))


# Ledger line, section name, deposit type.
SECTIONS = (
    ("4310", "Gouvernment", "demand"), ("4320", "Business Enterprises", "demand"), ("4340", "Group Account", "demand"),
    ("4380", "Financial Institutions", "time"), ("4390", "Government", "time"), ("4400", "Business Enterprises", "time"),
    ("4410", "Others", "time"), ("4450", "Passbook Savings", "passbook"), ("4460", "Pledge Saving Account", "passbook"),
    ("4470", "Elderly Savings", "passbook"), ("4475", "Bolsa da Mae", "passbook"), ("4480", "Deposito Asuwa'in", "passbook"),
    ("4490", "Futuru Saving", "passbook"), ("4500", "Depozitu Poupansa Emigrante", "passbook"),
    ("4505", "Depozitu Matenek", "passbook"), ("4506", "Depozitu Pensionista", "passbook"),
    ("4510", "BDM Jerasaun Foun", "passbook"), ("4520", "Depozitu Fiar", "passbook"),
)
# Ledger line of a group total, deposit type.
GROUP_TOTALS = {"4360": "demand", "4430": "time", "4540": "passbook"}
# Branch number, mnemonic.
BRANCH_MNEMONICS = {"02": "DIL", "03": "GLN", "04": "MAL", "05": "ALU", "06": "OCS", "07": "BCU", "08": "SAM", "09": "ANR",
                    "10": "SUA", "11": "VQQ", "12": "LSP", "13": "LQC", "14": "MTT"}
# Product code, product name.
PRODUCTS = {
    "1001": "Business Enterprises", "1002": "Government", "1003": "Group Account", "1190": "Time Deposit",
    "6005": "Passbook Savings", "6006": "Futuru Saving", "6007": "Elderly Savings", "6008": "Pledge Saving",
    "6009": "Pledge Saving", "6010": "Depozitu Poupansa Emigrante", "6011": "Bolsa da Mae", "6012": "Deposito Asuwa'in",
    "6013": "Depozitu Matenek", "6014": "Depozitu Pensionista", "6015": "BDM Jerasaun Foun", "6016": "Depozitu Fiar",
}
# Line patterns of the deposit listing.
SECTION_HEAD = r"^(\d{4})\s+([A-Za-z'(].+?)\s*$"
SECTION_TOTAL = r"^TOTAL FOR (\d{4})\b.+?(-?[\d,]+\.\d{2})\s*$"
GROUP_TOTAL = r"^(\d{4})\s+Total\s.+?(-?[\d,]+\.\d{2})\s*$"
DEPOSIT_ROW = (r"^(\S+)\s+(USD)\s+(.+?)\s{2,}(-?[\d,]+\.\d{2})\s+(-?[\d,]+\.\d{2})"
               r"(?:\s+(-?[\d.]+)\s+(\S+)\s+([\d]+\s+[A-Z]{3}\s+\d{4})\s+(\d{1,2}\s+[A-Z]{3}\s+\d{4}))?\s*$")
DEPOSIT_MARKS = ("PAGE NO", "PRINTED AT", "RE000010", "----", "TOTAL LINE FOR", "OPENING BALANCE", "DEBIT MOVEMENTS",
                 "CREDIT MOVEMENTS", "CLOSING BALANCE")
TOLERANCE = "0.01"


@dataclass
class Deposits:
    """``rows`` of the listing and the ``checks`` of parsed sums against the totals in the file."""

    rows: DataFrame
    checks: DataFrame


def report_date(text: Column) -> Column:
    """Date with a number glued in front of the day; the last two digits are the day ('36021 MAR 2024' is the 21st)."""
    plain = F.regexp_extract(text, r"(\d{1,2}\s+[A-Z]{3}\s+\d{4})$", 1)
    spaced = F.initcap(F.lower(F.regexp_replace(plain, r"\s+", " ")))
    return F.date_format(F.try_to_timestamp(blank_null(spaced), F.lit("d MMM yyyy")), "yyyy-MM-dd")


def account_parts(raw: Column) -> tuple[Column, Column, Column]:
    """Account without leading zeros, branch (two digits for 10-14, else one) and the four-digit product after it."""
    stripped = F.ltrim(raw, F.lit("0"))
    account = F.when(stripped == "", raw).otherwise(stripped)
    two = account.rlike(r"^1[0-4]")
    short = F.length(account) < 5
    branch = F.when(short, "").when(two, F.substring(account, 1, 2)).otherwise(F.concat(F.lit("0"), F.substring(account, 1, 1)))
    product = F.when(short, "").when(two, F.substring(account, 3, 4)).otherwise(F.substring(account, 2, 4))
    return account, branch, product


def _cell(n: int) -> Column:
    return F.nullif(C("cells")[n - 1], F.lit(""))


def parse_deposits(lines: DataFrame, hot: bool = False) -> Deposits:
    """Deposit rows under the section they stand in, and the checks against the file's own totals."""
    text = F.regexp_replace("line", r"\s+$", "")
    body = lines.withColumn("text", text).filter(C("text") != "")
    kind = (F.when(C("text").rlike(SECTION_TOTAL), "total").when(C("text").rlike(GROUP_TOTAL), "group")
            .when(_has(DEPOSIT_MARKS), "skip").when(C("text").rlike(SECTION_HEAD), "head").otherwise("row"))
    body = body.withColumn("kind", kind)
    section = {line: name for line, name, _ in SECTIONS}
    dtype = {line: kind for line, _, kind in SECTIONS}
    head = F.regexp_extract("text", SECTION_HEAD, 1)
    body = body.withColumn("at_head", F.when(C("kind") == "head", F.struct(F.when(head.isin(*section), head).alias("gl"))))
    body = carry(body, ["file"], "line_seq", "at_head", "section", hot=hot)
    body = materialise(body.select("file", "source_file", "line_seq", "text", "kind", "section"))
    rows = body.filter((C("kind") == "row") & C("section.gl").isNotNull())
    # a text without a match comes back whole, as one cell
    rows = rows.withColumn("cells", _groups("text", DEPOSIT_ROW, 9)).filter(F.size("cells") == 9)
    gl = C("section.gl")
    account, branch, product = account_parts(C("cells")[0])
    rows = rows.select(
        "file", lookup(gl, dtype).alias("deposit_type"), gl.alias("gl_line"), lookup(gl, section).alias("gl_section_name"),
        account.alias("account_number"), branch.alias("branch_code"),
        F.when(branch == "", "UNKNOWN").otherwise(lookup(branch, BRANCH_MNEMONICS, F.concat(F.lit("UNKNOWN_"), branch))).alias("branch_name"),
        product.alias("product_code"), lookup(product, PRODUCTS, F.concat(F.lit("UNKNOWN_"), product)).alias("product_name"),
        _cell(2).alias("currency"), F.trim(C("cells")[2]).alias("customer_name"),
        _number(_cell(4)).alias("currency_amt"), _number(_cell(5)).alias("local_ccy_amt"),
        F.round(_number(_cell(6)), 2).alias("int_rate"), _cell(7).alias("int_type"),
        report_date(_cell(8)).alias("value_date"), report_date(_cell(9)).alias("mat_date"), "source_file")
    section_totals = body.filter((C("kind") == "total")).select(
        "file", "line_seq", F.regexp_extract("text", SECTION_TOTAL, 1).alias("item"),
        _number(F.regexp_extract("text", SECTION_TOTAL, 2)).cast(MONEY).alias("total")).filter(C("item").isin(*section))
    group_totals = body.filter(C("kind") == "group").select(
        "file", "line_seq", lookup(F.regexp_extract("text", GROUP_TOTAL, 1), GROUP_TOTALS).alias("item"),
        _number(F.regexp_extract("text", GROUP_TOTAL, 2)).cast(MONEY).alias("total")).filter(C("item").isNotNull())
    totals = section_totals.unionByName(group_totals).groupBy("file", "item").agg(F.max_by("total", "line_seq").alias("file_total"))
    return Deposits(rows.drop("file"), reconcile(rows, totals))


def reconcile(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Parsed sums per section and per deposit type against file totals; an item without a total is skipped."""
    both = F.array(F.struct(F.lit("section").alias("level"), C("gl_line").alias("item")),
                   F.struct(F.lit("group").alias("level"), C("deposit_type").alias("item")))
    sums = rows.select("file", "source_file", F.inline(both), C("local_ccy_amt").cast(MONEY).alias("amt")) \
        .groupBy("file", "item").agg(F.count("amt").alias("rows"), F.sum("amt").alias("parsed"))
    joined = sums.join(totals, ["file", "item"], "full")
    gap = F.abs(F.coalesce("parsed", F.lit(0)) - C("file_total"))
    return joined.select(
        F.element_at(F.split("file", "/"), -1).alias("source_file"),
        F.when(C("item").rlike("^[0-9]{4}$"), "section").otherwise("group").alias("level"), "item",
        F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("parsed", F.lit(0)).cast("decimal(28,2)").alias("parsed_sum"),
        C("file_total").cast(MONEY).alias("file_total"),
        F.when(C("file_total").isNull(), "SKIP").when(gap > F.lit(TOLERANCE).cast(MONEY), "FAIL").otherwise("OK").alias("status"))


def require_reconciled(checks: DataFrame, show: int = 20) -> None:
    """Raise when any check failed; names the first few."""
    failed = checks.filter(C("status") == "FAIL").orderBy("source_file", "item").limit(show).collect()
    if failed:
        raise ValueError("reconciliation failed: " + "; ".join(
            f"{r.source_file} {r.item}: parsed {r.parsed_sum}, file {r.file_total}" for r in failed))

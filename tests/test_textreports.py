import pytest

from daybook.sources import textreports as t

LEDGER = """RE000010 02 SUKURSAL CITY EXBANK            GENERAL LEDGER
LINE  DESCRIPTION
 AC.1.TR.USD.3004.X.Y.Z.W.STD             10.00        0.00        0.00       10.00
   AC.2-TR.USD

     .3005.X
 PAGE NO 7
  STD                                      1.00        0.00        0.00        1.00
   TAIL.9
 2730 Business Loans                  1,234.00        0.00        5.00    1,229.00
   (a remark)
  2740 Other Loans
 no row here
   END OF REPORT
 2750 After the end                   1.00        0.00        0.00    1.00
"""
PROFIT = LEDGER.replace("GENERAL LEDGER", "PROFIT AND LOSS   LIVE SYSTEM").replace("02 SUKURSAL CITY", "HEAD-OFFICE")
DEPOSITS = """RE000010 PAGE NO 1
4310 Gouvernment
00000021001000123   USD  NAME ONE              100.00        100.00
00000106006000456   USD  NAME TWO              250.00        250.00   1.5  A1  36021 MAR 2024  21 MAR 2026
not a row
TOTAL FOR 4310 Gouvernment                                   350.00
9999 Unknown section
00000021001000999   USD  NAME ONE              100.00        100.00
4320 Business Enterprises
00000119999000001   USD  NAME SIX                5.00        -5.00
4360 Total Demand                                            345.02
"""


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.txt").write_text(text)
    return str(folder)


@pytest.mark.parametrize("hot", [True, False])
def test_ledger(spark, tmp_path, hot):
    path = write(tmp_path, gl=LEDGER, pl=PROFIT, other="hello\nworld\n")
    lines = t.read_lines(spark, path, hot=hot)
    got = t.parse_ledger(lines, "EXBANK", hot=hot).filter("source_file = 'gl.txt'").orderBy("line_seq").collect()
    assert [(r.line_seq, r.line_code, r.description, r.closing_balance) for r in got] == [
        (3, "", "AC.1.TR.USD.3004.X.Y.Z.W.STD", 10.0), (8, "", "AC.2-TR.USD.3005.X STD", 1.0),
        (10, "2730", "Business Loans", 1229.0), (12, "2740", "Other Loans", None)]
    assert {(r.branch, r.file_type) for r in got} == {("RE000010_02_SUKURSAL_CITY", "CRF_GL")}
    profit = t.parse_ledger(lines, "EXBANK").filter("source_file = 'pl.txt'").first()
    assert (profit.branch, profit.file_type) == ("RE000010_HEAD_OFFICE", "CRC_PL")


def test_continuations_can_be_joined(spark, tmp_path):
    lines = t.read_lines(spark, write(tmp_path, gl=LEDGER))
    joined = {r.line_seq: r.description for r in t.parse_ledger(lines, "EXBANK", join_continuations=True).collect()}
    assert joined[8] == "AC.2-TR.USD.3005.X STDTAIL.9"


@pytest.mark.parametrize("hot", [True, False])
def test_deposits(spark, tmp_path, hot):
    lines = t.read_lines(spark, write(tmp_path, d=DEPOSITS), hot=hot)
    out = t.parse_deposits(lines, hot=hot)
    rows = {r.account_number: r for r in out.rows.collect()}
    assert sorted(rows) == ["106006000456", "119999000001", "21001000123"]
    one, two, six = rows["21001000123"], rows["106006000456"], rows["119999000001"]
    assert (one.branch_code, one.branch_name, one.product_code, one.product_name) == ("02", "DIL", "1001", "Business Enterprises")
    assert (two.branch_code, two.branch_name, two.product_name, two.value_date, two.mat_date, two.int_rate) == (
        "10", "SUA", "Futuru Saving", "2024-03-21", "2026-03-21", 1.5)  # the last two digits are the day
    assert (six.product_name, six.local_ccy_amt, six.gl_line) == ("UNKNOWN_9999", -5.0, "4320")
    checks = {r.item: (r.status, r.rows) for r in out.checks.collect()}
    assert checks["4310"] == ("OK", 2) and checks["4320"] == ("SKIP", 1) and checks["demand"] == ("FAIL", 3)
    with pytest.raises(ValueError, match="demand"):
        t.require_reconciled(out.checks)


def test_best_file(spark):
    rows = spark.createDataFrame(
        [("a_20260101.txt", "B", "CRF_GL", 1.0)] * 3 + [("a_20260102.txt", "B", "CRF_GL", 2.0)] * 2,
        "source_file string, branch string, file_type string, opening_balance double")
    for c in ("debit_movements", "credit_movements", "closing_balance"):
        rows = rows.withColumn(c, rows.opening_balance)
    best = t.best_files(t.ledger_statistics(rows)).first()
    assert (best.source_file, best.rows, best.is_detailed) == ("a_20260102.txt", 2, False)

import re

import duckdb
import numpy as np
import pytest

from daybook.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    spots = {}
    for i in range(len(words) - 2):
        spots.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(3)}
    n, chars, symbols = len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>")
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    bad = (100 * symbols > 20 * n or 100 * dup > 50 * len(lines) or 100 * len(re.findall("[A-Z]", text or "")) > 60 * chars
           or chars < 2 * n or chars > 15 * n or max(map(len, words), default=0) > 1000)
    return n, chars, symbols, dup, len(covered), failed, not (failed or bad)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
                   for r in df.collect()), key=repr)


def odd_texts():
    rng = np.random.default_rng(2)
    some = [" ".join(f"w{rng.integers(0, k)}" for _ in range(n)) for k in (2, 5, 40, 1000) for n in (0, 1, 2, 3, 4, 60, 500, 3000)]
    return [*some, None, "", " \n\t\x0b ", "a a a a", "a b c a b c", "a b a b a", "x\ny\nx\n\n \nx ", "é ñ 漢 " * 40, "**&& <b> |$|# " * 30,
            "SHOUT " * 3 + "Loud Words here and there " * 20, "y" * 1500 + " fine words" * 60, "one two three four five " * 4_000,
            " ".join(f"u{i}" for i in range(70)), "nbsp stays joined word"]


def test_measures_equal_brute_force(spark):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, 1, "t", "w", "r") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, t string, w string, _rule_text string")
    assert rows_of(rules.measured(df)) == sorted(((i, *brute(t)) for i, t in enumerate(texts)), key=repr)
    kept = rules.keep_passing(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts) if brute(t)[-1]}
    assert rules.measured(df.limit(0)).count() == 0 and rules.keep_passing(df.limit(0)).count() == 0


def test_every_order_gives_the_same_verdict(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(t or "",) for t in odd_texts()], "t string")
    names = list(rules.RULES)
    want = [r[0] for r in df.select(rules.first_rejecting(names, 't').isNull()).collect()]
    for _ in range(3):
        order = rng.permutation(names).tolist()
        assert [r[0] for r in df.select(rules.first_rejecting(order, 't').isNull()).collect()] == want


def test_rules_are_ordered_by_rejection_per_cost():
    found = [rules.Estimate("dear", 2.0, 0.4), rules.Estimate("idle", 0.1, 0.0), rules.Estimate("cheap", 0.1, 0.1), rules.Estimate("best", 0.1, 0.3)]
    assert rules.ordered(found) == ["best", "cheap", "dear", "idle"]


def test_words_are_cut_once_and_dear_measures_wait(spark):
    """A rule after one that rejects is never evaluated: it would raise an error here."""
    df = spark.createDataFrame([("a b",), ("c",)], "text string")
    broken = {"short": "{n_words} < 50", "broken": "raise_error('reached') is null"}
    assert df.select(rules.first_rejecting(["short", "broken"], rules=broken)).collect() == [("short",), ("short",)]
    with pytest.raises(Exception, match="reached"):
        df.select(rules.first_rejecting(["broken", "short"], rules=broken)).collect()
    for frame in (rules.keep_passing(df), rules.measured(df.selectExpr("1 as doc_id", "text"))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("array_remove") == 1, plan


def test_plan_has_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = rules.measured(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("folder", ["sf0.001"])
def test_documents_equal_duckdb(spark, folder):
    path = f"/root/testdata/{folder}/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    want = sorted(con.execute(rules.ORACLE_SQL).fetchall(), key=repr)
    assert rows_of(rules.measured(spark.read.parquet(path))) == want

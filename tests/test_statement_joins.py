"""Where the statement book is joined and shuffled."""

import pytest

from daybook.checks import registry
from daybook.plans import MARTS

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, keys", [("statement_book", ("c_key", "p_key", "u_key", "w_key")), ("account_statement", ("c_key",))])
def test_entries_are_shuffled_by_account_only(spark, name, keys):
    """What has many rows is joined to accounts, or to entries before they are widened: below the windows, or beside them."""
    df = MARTS[name](registry.bank(spark, FOLDER, pins=registry.PINS))
    found = []

    def walk(node):
        text = node.simpleString(4000)
        if text.startswith("Join") and any(f"= {k}#" in text for k in keys):
            found.append("Window" not in node.children().head().toString())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().optimizedPlan())
    assert found == [True] * len(keys)


def test_stored_entries_are_shuffled_by_account_only(spark):
    stored = registry.stored_dimensions(spark, FOLDER)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = MARTS["statement_book"](registry.bank(spark, FOLDER, pins=registry.PINS, stored=stored))
        plan = df._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    while not plan.nodeName() == "Window":
        plan = plan.children().head()
    below = plan.toString()
    assert all(f"= {k}#" in below for k in ("c_key", "p_key", "u_key", "w_key"))


def test_sweeps_that_repeat_repeat_rows_but_enter_no_sum(spark):
    ctx = registry.bank(spark, FOLDER, pins=registry.PINS)
    once = MARTS["statement_book"](ctx)
    bank = registry.bank(spark, FOLDER, pins=registry.PINS)
    read = bank.read
    twice = read("ac_account_sweep_hist", None)
    bank.read = lambda name, version: twice.unionByName(twice) if name == "ac_account_sweep_hist" else read(name, version)
    doubled = MARTS["statement_book"](bank)
    count = lambda df: (df.filter("sweep_ref is null").count(), df.filter("sweep_ref is not null").count())
    (a, b), (c, d) = count(once), count(doubled)
    assert (c, d) == (a, 2 * b) and b > 0
    assert doubled.distinct().count() == once.distinct().count()

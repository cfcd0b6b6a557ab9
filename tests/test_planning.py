"""What a plan must and must not contain before it runs."""

import pytest

from daybook.checks import bank_views, registry
from daybook.context import Context
from daybook.plans import MARTS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ctx(spark):
    return registry.bank(spark, FOLDER, pins=registry.PINS)


@pytest.mark.parametrize("name", ["asset_summary", "disbursement_consolidation", "income_statement", "account_statement", "closed_account_listing",
                                  "trial_balance_detail", "statement_book"])
def test_planning_starts_no_job(spark, ctx, name):
    MARTS[name](ctx)  # reads the footers of the tables
    group = f"plan-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        MARTS[name](ctx)._jdf.queryExecution().optimizedPlan()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("other", "")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_arrangements_join_their_role_on_a_key(ctx):
    plan = MARTS["lending_arrangements"](ctx)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["large_daily_txn", "statement_book", "written_off_loans", "lending_arrangements"])
def test_rows_without_a_key_are_spread(ctx, name):
    assert "LeftOuter, (_on#" in _plan(MARTS[name](ctx))


def test_staged_marts_are_written_once(spark, ctx):
    own = Context.of_frames(spark, bank_views.frames(spark, FOLDER), bank_views.BUSINESS_DATE, pins=registry.PINS, stage=["loan_counts"])
    assert own.mart("loan_counts") is own.mart("loan_counts")
    assert "Relation" in _plan(own.mart("loan_counts")) and "Join" not in _plan(own.mart("loan_counts"))
    assert sorted(own.mart("loan_counts").collect()) == sorted(MARTS["loan_counts"](ctx).collect())

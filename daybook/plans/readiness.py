"""Readiness ledger: is the business date closed, has the stream caught up, which sources are sealed.

Control tables are small keyed frames. Every function takes frames and returns a frame; store the
result with a change table or any table format.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.functions.columns import item
from daybook.sources.tables import merge_rows
from daybook.streaming.cdc import GLOBAL

C = F.col
CONTROL = ("business_date date, source_table string, flow string, status string, expected_count bigint, "
           "actual_count bigint, l_cob string, snapshot_id bigint, sealed_at timestamp")
RUNS = ("domain string, mart string, layer string, business_date date, status string, models_built int, "
        "started_at timestamp, completed_at timestamp")
INGEST = ("source_name string, flow string, business_date date, is_sync boolean, is_parsed boolean, "
          "synced_at timestamp, parsed_at timestamp")
COB_RECORD = "BNK/COB.INITIALISE"


@dataclass(frozen=True)
class Sources:
    """What a mart reads: snapshot dimensions, day-filtered events with their date column, pulls, text reports."""

    division: str
    dims: tuple[str, ...] = ()
    events: tuple[tuple[str, str], ...] = ()
    pulls: tuple[str, ...] = ()
    reports: tuple[str, ...] = ()


# Marts in scope, their division and sources.
SOURCES = {
    "acct_cust": Sources("operational", ("account", "customer")),
    "closed_accounts": Sources("operational", ("account_closed", "account_his"), pulls=("posting_restrict",)),
    "inward_remittance": Sources("treasury", ("account", "funds_transfer")),
    "inactive_accounts": Sources("aml", ("account", "customer"), pulls=("company",)),
    "missing_documents": Sources("aml", ("account", "customer", "customer_account"), pulls=("company", "eb_lookup", "gic_id")),
    "large_daily_txn": Sources("aml", ("account", "customer", "acct_activity", "teller"), (("stmt_entry", "booking_date"),),
                               ("transaction", "eb_lookup", "gic_id", "company")),
    "opened_accounts": Sources("aml", ("account", "customer", "stmt_entry", "stmt_entry_detail", "stmt_entry_detail_xref"),
                               pulls=("company", "eb_lookup")),
    "loan_risk": Sources("credit", ("account", "customer", "aa_account_details", "aa_arr_payment_schedule", "pv_asset_detail",
                                    "aa_arr_term_amount"), pulls=("category", "dept_acct_officer")),
    "lending_arrangements": Sources("credit", ("customer", "aa_arrangement", "aa_account_details", "aa_arr_customer",
                                               "aa_arr_term_amount", "aa_bill_details", "aa_customer_role",
                                               "em_dl_application", "em_lo_application"), pulls=("aa_product", "mcb_group")),
    "written_off_loans": Sources("credit", ("customer", "account_his", "aa_arrangement", "aa_arr_account", "aa_arr_customer",
                                            "aa_arr_balance_maintenance", "aa_activity_history", "aa_process_details"),
                                 pulls=("aa_product", "mcb_group")),
    "trial_balance_detail": Sources("accounting", reports=("ledger_gl", "ledger_pl")),
}


def source_rows(spark: SparkSession, sources: Mapping[str, Sources] = SOURCES) -> DataFrame:
    """One row per (mart, source table): division, kind and event date column."""
    rows = [(mart, s.division, table, kind, col) for mart, s in sources.items() for table, kind, col in [
        *[(t, "dim", None) for t in s.dims], *[(t, "event", c) for t, c in s.events],
        *[(t, "pull", None) for t in s.pulls], *[(t, "report", None) for t in s.reports]]]
    return spark.createDataFrame(rows, "mart string, division string, source_table string, kind string, date_col string")


def tables_of(rows: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Distinct tables of the given kinds over all marts."""
    return rows.filter(C("kind").isin(*kinds)).select("source_table").distinct()


def misclassified(rows: DataFrame) -> DataFrame:
    """Tables declared both as change-captured and as pulled."""
    captured = C("kind").isin("dim", "event")
    both = rows.groupBy("source_table").agg(F.bool_or(captured).alias("captured"), F.bool_or(C("kind") == "pull").alias("pulled"))
    return both.filter(C("captured") & C("pulled")).select("source_table")


def cob_marker(batch: DataFrame, record: str = COB_RECORD) -> DataFrame:
    """(business_date, l_cob) when the day's closing has finished, no row otherwise."""
    return batch.filter((C("recid") == record) & (item("process_status").cast("string") == "0")).select(
        F.substring(item("last_run_date").cast("string"), 1, 10).alias("business_date"), C("__lsn").alias("l_cob"))


def forced_marker(spark: SparkSession, business_date: str, l_cob: str = "0") -> DataFrame:
    """Marker for a replay: any log position has passed '0', so nothing is waited for."""
    return spark.createDataFrame([(business_date[:10], l_cob)], "business_date string, l_cob string")


def lag(end: DataFrame, committed: DataFrame, topics: DataFrame) -> DataFrame:
    """Unread events per topic; a topic without partitions has none."""
    left = end.join(committed, ["topic", "partition"], "left").groupBy("topic").agg(
        F.sum(C("end_offset") - F.coalesce("committed_offset", F.lit(0))).alias("lag"))
    return topics.join(left, "topic", "left").select("topic", F.coalesce("lag", F.lit(0)).alias("lag"))


def caught_up(tables: DataFrame, progress: DataFrame, lags: DataFrame, l_cob: str) -> DataFrame:
    """Per table: its own position has passed the mark, or the whole stream has and its topic is drained.

    ``tables`` has source_table and topic. Positions are fixed-width text and compared as text.
    """
    whole = progress.filter(C("table_name") == GLOBAL).agg(F.max("max_lsn")).scalar()
    rows = tables.join(progress.withColumnRenamed("table_name", "source_table"), "source_table", "left").join(lags, "topic", "left")
    own = F.coalesce(C("max_lsn") >= F.lit(l_cob), F.lit(False))
    drained = F.coalesce(whole >= F.lit(l_cob), F.lit(False)) & F.coalesce(C("lag") == 0, F.lit(False))
    return rows.select("source_table", "max_lsn", "lag", (own | drained).alias("caught_up"))


def open_pending(control: DataFrame, rows: DataFrame) -> DataFrame:
    """Open (or reopen) sources for a day; a known log position stays when none is given."""
    return merge_rows(control, rows.withColumn("status", F.lit("pending")), ["business_date", "source_table"], ["l_cob"])


def seal(control: DataFrame, rows: DataFrame) -> DataFrame:
    """Mark sources as complete; snapshot and counts stay when none are given."""
    sealed = rows.withColumns({"status": F.lit("sealed"), "sealed_at": F.current_timestamp()})
    return merge_rows(control, sealed, ["business_date", "source_table"], ["snapshot_id", "expected_count", "actual_count", "l_cob"])


def mark_failed(control: DataFrame, rows: DataFrame) -> DataFrame:
    """Mark known sources as failed; unknown ones are not added."""
    known = rows.join(control, ["business_date", "source_table"], "left_semi").select("business_date", "source_table")
    return merge_rows(control, known.withColumn("status", F.lit("failed")), ["business_date", "source_table"])


def all_sealed(control: DataFrame, wanted: DataFrame, business_date: str) -> DataFrame:
    """Per mart: are all its sources sealed for the day?"""
    done = control.filter((C("business_date") == F.lit(business_date).cast("date")) & (C("status") == "sealed")) \
        .select("source_table", F.lit(True).alias("done"))
    return wanted.select("mart", "source_table").distinct().join(done, "source_table", "left") \
        .groupBy("mart").agg(F.bool_and(F.coalesce("done", F.lit(False))).alias("ready"))


def is_sealed(control: DataFrame, sources: Iterable[str], business_date: str) -> bool:
    """Are all named sources sealed? An empty list is."""
    names = sorted(set(sources))
    done = control.filter((C("business_date") == F.lit(business_date).cast("date")) & (C("status") == "sealed")
                          & C("source_table").isin(*names)) if names else None
    return done is None or done.select("source_table").distinct().count() == len(names)


def read_pins(control: DataFrame, business_date: str) -> dict[str, int]:
    """Sealed table -> pinned version; one row per source table."""
    rows = control.filter((C("business_date") == F.lit(business_date).cast("date")) & (C("status") == "sealed")
                          & C("snapshot_id").isNotNull()).select("source_table", "snapshot_id").collect()
    return {r[0]: r[1] for r in rows}


def start_run(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Note runs as started."""
    started = rows.withColumns({"status": F.lit("running"), "started_at": F.current_timestamp(),
                                "completed_at": F.lit(None).cast("timestamp")})
    return merge_rows(runs, started, ["domain", "mart", "layer", "business_date"])


def finish_run(runs: DataFrame, rows: DataFrame) -> DataFrame:
    """Note runs as finished with the status given."""
    return merge_rows(runs, rows.withColumn("completed_at", F.current_timestamp()),
                      ["domain", "mart", "layer", "business_date"], ["models_built"])


def all_built(runs: DataFrame, domain: str, marts: Iterable[str], business_date: str, layer: str = "silver") -> bool:
    """Have all marts of a division succeeded for the day? An empty list has."""
    names = sorted(set(marts))
    if not names:
        return True
    done = runs.filter((C("domain") == domain) & (C("layer") == layer) & (C("status") == "success")
                       & (C("business_date") == F.lit(business_date).cast("date")) & C("mart").isin(*names))
    return done.select("mart").distinct().count() == len(names)


def is_built(runs: DataFrame, domain: str, business_date: str) -> bool:
    """Has the division's report layer succeeded for the day?"""
    return all_built(runs, domain, [""], business_date, "gold")


def mark_synced(log: DataFrame, rows: DataFrame) -> DataFrame:
    return merge_rows(log, rows.withColumns({"is_sync": F.lit(True), "synced_at": F.current_timestamp()}),
                      ["source_name", "flow", "business_date"])


def mark_parsed(log: DataFrame, rows: DataFrame) -> DataFrame:
    """Parsed implies synced for a source not noted before."""
    keys = ["source_name", "flow", "business_date"]
    return merge_rows(log, rows.withColumns({
        "is_sync": F.lit(True), "synced_at": F.lit(None).cast("timestamp"), "is_parsed": F.lit(True),
        "parsed_at": F.current_timestamp()}), keys, ["synced_at"])


def reconcile_counts(rows: DataFrame, expected: DataFrame, business_date: str) -> DataFrame:
    """Rows of the day per source next to the expected count, like with like."""
    actual = rows.filter(C("business_date") == F.lit(business_date).cast("date")).groupBy("source_table") \
        .agg(F.count(F.lit(1)).alias("actual_count"))
    joined = expected.join(actual, "source_table", "left").withColumn("actual_count", F.coalesce("actual_count", F.lit(0)))
    return joined.withColumn("matches", C("expected_count") == C("actual_count"))

"""Time the headline queries and print one JSON line.

Each query is planned and fully executed (nothing is collected) once to warm up, then three times, of which the median counts. When ENOUGH
seconds have passed, later queries are timed once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession, functions as F

HEADLINE = (
    "large_daily_txn", "acct_cust", "loan_risk", "lending_arrangements", "account_statement", "statement_book",
    "category_entry_book", "trial_balance_detail", "inward_remittance", "disbursement_consolidation", "provision",
    "opened_account_listing", "contact_listing", "asset_summary", "assets_compared", "record_roundtrip_main",
    "report_parse_ledger", "report_parse_deposits", "cdc_latest",
)


#: Marts over dimensions that were stored before (not timed), reported beside the headline queries.
STORED = ("statement_book_stored", "large_daily_txn_stored", "lending_arrangements_stored", "account_statement_stored")
ENOUGH = 480


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("daybook-bench")
             .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    start = time.perf_counter()
    run(make())
    return time.perf_counter() - start


def parse_rate(spark: SparkSession, cpus: int, records: int = 20_000, fields: int = 150) -> float:
    """Records of 150 fields parsed per second and core (every tenth field has three values)."""
    from daybook.operators.staging import materialise
    from daybook.sources.records import Field, Spec, parse

    cells = "".join(f'<c{i}>v1</c{i}><c{i} m="2">v2</c{i}><c{i} m="3">v3</c{i}>' if i % 10 == 0 else f"<c{i}>value number {i}</c{i}>"
                    for i in range(1, fields + 1))
    raw = materialise(spark.range(records).repartition(2 * cpus).select(
        F.col("id").cast("string").alias("RECID"), F.concat(F.lit("<row><c0>"), "id", F.lit(f"</c0>{cells}</row>")).alias("XMLRECORD")))
    spec = Spec("BENCH", tuple(Field(f"F.{i}", i, multi=i % 10 == 0) for i in range(1, fields + 1)))
    timed(lambda: parse(raw, spec).main)
    return records / timed(lambda: parse(raw, spec).main) / cpus


def change_rate(spark: SparkSession, folder: str, cpus: int) -> float:
    """Change messages per second and core: decoded and reduced to the last event per key."""
    from daybook.checks.operator_views import messages
    from daybook.operators.staging import materialise
    from daybook.streaming import cdc

    landed = materialise(messages(spark, folder).repartition(2 * cpus))
    timed(lambda: cdc.latest_events(cdc.unwrap(landed, ["topic"]), ["topic", "RECID"]))
    return landed.count() / timed(lambda: cdc.latest_events(cdc.unwrap(landed, ["topic"]), ["topic", "RECID"])) / cpus


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from daybook.checks.registry import queries

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    known = queries()
    begun = time.perf_counter()

    def median(name: str) -> float:
        timed(lambda: known[name](spark, folder))
        runs = [timed(lambda: known[name](spark, folder)) for _ in range(3 if time.perf_counter() - begun < ENOUGH else 1)]
        return round(sorted(runs)[len(runs) // 2], 3)

    times = {name: median(name) for name in names}
    stored = {} if sys.argv[1:] else {name: median(name) for name in STORED}
    rate = parse_rate(spark, int(cpus))
    changes = change_rate(spark, folder, int(cpus))
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "stored_dimensions": stored, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "parse_records_per_second_per_core": round(rate, 1), "change_events_per_second_per_core": round(changes, 1)}))
    spark.stop()


if __name__ == "__main__":
    main()

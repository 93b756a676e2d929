"""Times the headline queries and prints one JSON line.

``derive_events`` makes the event tables from the given ones and ``write_canonical``
their newest versions; both count in the total. Every query then writes to a no-op sink
so that all columns of all rows are computed. The best of the repeats counts, after
one warm-up round. ``first_load`` brings all events but those of the report date into a
root, ``daily_load`` that day's events on top, and ``daily_run`` is a
whole job of the following day: load, checks and, if the gate passes, the four marts.
"""

import json
import os
import sys
import tempfile
import time
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.plans import jobs  # noqa: E402
from tidemark.registry.queries import LOOKBACK, QUERIES, REPORT_DATE, Tables  # noqa: E402
from tidemark.sources import storage  # noqa: E402
from tidemark.sources.driver_tables import event_tables  # noqa: E402

HEADLINE = [
    "refresh_credit",
    "refresh_portfolio",
    "refresh_campaign",
    "refresh_vintage",
    "mart_portfolio",
    "rebuild_range",
    "latest_customer",
    "latest_application",
    "latest_installment",
    "latest_payment",
    "open_installments",
    "paid_as_of",
    "installment_state",
    "join_interval_attribution",
    "last_touch_attribution",
    "agg_ratios",
    "dq_schedule_reconciliation",
    "dq_all",
    "amortization_schedule",
    "payment_allocation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-bench-"))
        .getOrCreate()
    )
    started = time.perf_counter()
    event_tables(spark, sf_dir)
    loaded = time.perf_counter()
    Tables(spark, sf_dir).all()
    timings = {
        "derive_events": round(loaded - started, 3),
        "write_canonical": round(time.perf_counter() - loaded, 3),
    }

    def query(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def refresh_all_marts():
        jobs.refresh_marts(Tables(spark, sf_dir).all(), root, LOOKBACK)

    root = storage.app_folder(spark, "bench")
    events = event_tables(spark, sf_dir)
    batches = {
        day: {n: e.filter(f"batch_id {sign} 'batch:{day}'") for n, e in events.items()}
        for day, sign in ((REPORT_DATE, "<"), (REPORT_DATE + timedelta(days=1), "="))
    }

    def once(name, work):
        begin = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - begin, 3)

    first, second = batches
    same_day = {n: e.filter(f"batch_id = 'batch:{first}'") for n, e in events.items()}
    once("first_load", lambda: jobs.load_events(spark, root, batches[first]))
    once("daily_load", lambda: jobs.load_events(spark, root, same_day))
    once("daily_run", lambda: jobs.run(spark, root, batches[second], second))
    measured = {name: lambda name=name: query(name) for name in HEADLINE}
    measured["refresh_all_marts"] = refresh_all_marts
    for name, work in measured.items():
        runs = []
        for _ in range(repeats + 1):
            begin = time.perf_counter()
            work()
            runs.append(time.perf_counter() - begin)
        timings[name] = round(min(runs[1:]), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr)
    total = sum(timings.values())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

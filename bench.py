"""Timing of the headline queries; prints one JSON line.

Each query is run once untimed, then up to BENCH_RUNS times (5), but no new run
begins after BENCH_SECONDS (15) spent on one query; the median counts. Rows per
second are the rows of the tables that a query reads over that median.

Environment: BENCH_SF_DIR (sample folder), BENCH_CPUS, BENCH_RUNS, BENCH_SECONDS,
BENCH_QUERIES (comma-separated names), BENCH_SHARED (folder for intermediate
tables).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martkit.catalog.oracle import ORACLE_SQL  # noqa: E402
from martkit.catalog.queries import QUERIES  # noqa: E402
from martkit.session import build_session, drop_staged  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()
HEADLINE = [
    "rfm_segments",
    "order_latest_status",
    "shipping_mart",
    "delay_stats",
    "customer_retention",
    "upsert_latest",
    "replace_day",
    "accumulate_batches",
    "courier_ledger",
    "vault_links",
    "group_conversion",
    "nearest_city",
    "user_travel",
    "zone_stats",
    "friend_recommendations",
    "order_enrichment",
    "product_counters",
    "category_counters",
    "vault_uuid5_hubs",
    "global_metrics",
    "row_numbers",
    "quintiles",
    "event_runs",
    "stream_campaigns",
    "stream_counters",
]


def run(spark, name: str, sf: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def input_rows(spark, name: str, sf: str) -> int:
    """Rows of the sample tables in the query's plan."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().analyzed().toString() + ORACLE_SQL.get(name, "")
    tables = {t for t in TABLES if re.search(rf"\b{t}\b", plan)}
    return sum(spark.read.parquet(f"{sf}/{t}.parquet").count() for t in tables)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs, most = int(os.environ.get("BENCH_RUNS", "5")), float(os.environ.get("BENCH_SECONDS", "15"))
    shared = os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="bench-")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "7g", "spark.checkpoint.dir": shared}
    spark = build_session("bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    times, pace, counts = {}, {}, {}
    for name in names:
        run(spark, name, sf)  # compiles its code
        seen: list[float] = []
        while len(seen) < runs and sum(seen) < most:
            seen.append(run(spark, name, sf))
        times[name], counts[name] = round(statistics.median(seen), 3), len(seen)
        pace[name] = round(input_rows(spark, name, sf) / times[name])
        print(f"{name} {times[name]} s, {pace[name]} rows/s, {counts[name]} runs", file=sys.stderr, flush=True)
        drop_staged(spark)
    report = {
        "metric": "sum of median seconds per query",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_second": pace,
        "runs": counts,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()

"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is run to completion into the no-op sink, so all rows and columns are computed and nothing
is sent to Python. The session is warmed up with one small query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from folioforge.plans import QUERIES  # noqa: E402

HEADLINES = (
    "event_month_counts",
    "dedupe_business_key",
    "scd2_merge",
    "version_intervals",
    "restate_fact",
    "dim_asof_join",
    "fact_transactions",
    "fact_upsert",
    "current_hierarchy_query",
    "exposure_by_class",
    "pnl_distribution",
    "var_position_level",
    "var_portfolio_level",
    "svar",
    "risk_by_class",
    "cagr",
    "irr",
    "xirr",
    "vw_portfolio_performance_summary",
    "vw_portfolio_risk_summary",
    "bronze_ingest",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINES
    QUERIES["table_audit_counts"](spark, folder).collect()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4), BENCH_REPEATS (2).
"""

from __future__ import annotations

import json
import os
import re
import time

from txnlake.catalog import queries
from txnlake.session import build_session

HEADLINE = [
    "mart_daily_transaction_summary",
    "mart_merchant_performance",
    "mart_client_360",
    "mart_fraud_analysis",
    "order_fraud_by_risk",
    "resolve_merchant",
    "settlement_batches",
    "refund_reconcile",
    "fraud_velocity",
    "fraud_intl_spree",
    "fraud_account_takeover",
    "fraud_alerts_build",
    "dq_unique_keys",
    "dq_referential",
    "monitor_summary",
    "cdc_decode",
    "cdc_unwrap",
    "cdc_current_state",
    "cdc_dedupe",
    "snapshot_load",
    "lake_sink",
    "cdc_current_state_stream",
    "stream_fraud_rate",
    "stream_fraud_velocity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    messages = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries (best of repeats)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
                "lake_sink_rows_per_sec": round(messages / seconds["lake_sink"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

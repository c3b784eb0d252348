"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Each query is run whole into the no-op sink; the best of BENCH_RUNS runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.catalog import CATALOG, Tables  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = (
    "readings_classified", "customer_standardized", "lineitem_dedup", "quarantine_rejects",
    "reading_sequence_flags", "pit_rolling_30d", "pit_rolling_strict", "device_signals_7d",
    "txn_risk_features", "failure_features", "quarter_region_rollup", "entity_360",
    "targeting_score", "supplier_priority", "risk_profile", "sensor_quality", "asset_health",
    "maintenance_queue", "dq_results_asset", "drift_psi", "masked_customers", "lineage_trace",
    "gap_detection", "gap_aware_mean", "hourly_grid", "sensor_drift", "scd2_history",
    "scd2_asof", "er_golden", "ml_split", "column_medians", "dq_results_provider",
    "dq_results_risk", "stream_bronze", "stream_validated", "ml_score_contract", "rf_importance",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    width = int(cores) if cores.isdigit() else 8
    spark = local_session("bench", cores=cores, shuffle_partitions=width)
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            CATALOG[name].build(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

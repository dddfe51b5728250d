"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time covers declaring its plan and running it to the end into a
``noop`` sink, so every output column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from strataline.session import local_session  # noqa: E402
from strataline.suite.all import QUERIES  # noqa: E402

HEADLINE = (
    "typed_staging", "dedupe_latest", "dup_surplus", "stable_surrogate", "ordered_surrogate",
    "vault_link", "dq_results", "dq_failed_records", "dq_monthly_results", "upsert_hash",
    "scd2_asof_join", "latest_lookup", "replay_months", "fact_activity_flags", "fact_trusted",
    "mart_entity_month", "view_entity_month", "report_attendance_level", "mart_score_domain",
    "monthly_summary_view", "kpi_movement", "kpi_heatmap", "recon_layers",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, name="bench")
    spark.read.parquet(f"{folder}/region.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

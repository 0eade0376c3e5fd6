"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
NAMES = [
    "trips_noncircular", "trips_circular", "trips_all_with_discrepancy", "p50_p95_route_from_positions", "sanitize_spikes", "trip_details", "rules_invalid", "compound_unique_violations", "trip_facts",
    "p50_p95_route", "today_vs_baseline", "route_summary", "live_fleet", "event_rate", "metric_over_time", "notification_decision", "flatten_snapshot",
]


def main() -> None:
    os.environ["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.abspath(__file__)), os.environ.get("PYTHONPATH", "")])
    from busmill.plans.queries import QUERIES
    from busmill.session import session

    spark = session("bench", **{"spark.master": f"local[{CPUS}]", "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    took = {}
    for name in NAMES:
        run(name)  # warm
        took[name] = round(min(run(name) for _ in range(2)), 3)
    print(json.dumps({"metric": "headline queries, warm best of 2, summed", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": SF}))


if __name__ == "__main__":
    main()

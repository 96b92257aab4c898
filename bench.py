"""Headline queries on the test tables; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aquifer.plans import catalog
from aquifer.session import session

HEADLINE = ["hourly_rollup", "gold_hourly", "gold_daily", "gold_alerts", "gold_correlation", "live_timeseries", "latest_wins_dedup", "canonical_city_id", "fk_star_join", "conditional_counts", "correlation_by_key", "validate_route", "late_route", "tumbling_5min"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0)}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is
written to a sink that discards rows, so all its columns are computed. The star is
built first and timed as a query of its own; every other time is the first run of
that query on the built star.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "mart_member_month_pmpm", "claims_enriched", "episodes_enriched", "mart_claims_financials", "mart_high_cost_member",
    "mart_provider_performance", "mart_readmission_queue", "mart_fwa_queue", "mart_hcc_risk", "mart_utilization",
    "provider_scored_sql", "rolling_pmpm", "high_cost_flag", "readmission_30day", "provider_peer_rank",
    "fwa_provider_flags", "hcc_rollup", "feature_episode", "fact_claim", "score_high_cost", "score_provider_anomaly",
]


def main() -> None:
    from payerscope.plans.build import star
    from payerscope.plans.queries import QUERIES
    from payerscope.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=max(8, int(cores)))
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    start = time.perf_counter()
    star(spark, folder).complete()
    times["build_star"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

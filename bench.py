"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Each query is run
once to warm up and then BENCH_RUNS times (default 1); the median counts. Results are written to the ``noop`` sink, so
every row and column is produced but nothing is sent to the driver.
"""

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from riskspark import catalog  # noqa: E402
from riskspark.session import local_session  # noqa: E402

HEADLINE = [
    "sc11_frequency_encoding",
    "sc13_amount_ratio",
    "jn01_identity_join",
    "jn03_null_safe_stats",
    "jn08_column_pairs",
    "ag01_rate_table",
    "ag04_global_stats",
    "ag05_user_stats",
    "ag06_group_block",
    "ag07_entity_degrees",
    "ag08_key_set_features",
    "ag12_histogram",
    "ag15_label_correlation",
    "ag19_hourly",
    "wn04_momentum",
    "wn05_velocity",
    "wn10_window_anomalies",
    "sp02_chronological_split",
    "sp03_stratified_split",
    "ev04_pr_areas",
    "ev09_rank_test",
    "mon04_column_drift",
    "fs03_correlation_prune",
    "fs04_mutual_information",
    "tr05_frequent_itemsets",
    "tr08_behavior_features",
]

#: Timed and reported, but not part of the total, which stays comparable with earlier rounds.
MORE = ["jn07_nearest_neighbours", "tr09_ensemble_features", "str02_velocity_stream", "ag15_wide_correlation", "ml03_logistic_regression"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session("riskspark-bench")
    queries = catalog.queries()
    times = {}
    for name in HEADLINE + MORE:
        taken = []
        for i in range(runs + 1):
            start = time.time()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                taken.append(time.time() - start)
        times[name] = round(statistics.median(taken), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times[n] for n in HEADLINE), 3), "unit": "sec", "queries": times,
                      "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()

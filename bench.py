"""Time the registered queries and print one JSON line.

Each query is built and fully computed (``noop`` sink) after one warm-up run; the reported time is the median of
``BENCH_RUNS`` runs. ``BENCH_QUERIES`` limits the run to names with one of the given prefixes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from adlake.catalog import QUERIES  # noqa: E402
from adlake.session import local_session  # noqa: E402

HEADLINE = """
hourly_win_price rolling_by_dims rolling_by_publisher rolling_events dedupe_keep_first dedupe_drop_all agg_all_functions
output_groupings pivot_trend distribution_shift top_k_other enrich_one enrich_five robust_normalise quantile_buckets
histogram_log density_histograms uplift_dataset uplift_ratio cumulative_share cap_sweep premium_segments decayed_ratio
each_day_vs_test gap_similarity day_matrix implied_decay hourly_vs_daily holt_forecast backtest_mape preference_cosine
supplier_part_cosine overlap_coefficient daily_stability compare_outputs snapshot_diff emb_lookup gradient_sum
adagrad_step ftrl_step mean_pooling weight_norm shuffled_batches training_metrics price_percentiles
latency_summary
""".split()


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = tuple(os.environ.get("BENCH_QUERIES", "").split())
    if wanted == ("all",):
        names = list(QUERIES)
    else:
        names = [n for n in QUERIES if n.startswith(wanted)] if wanted else HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    verbose = bool(os.environ.get("BENCH_VERBOSE"))
    seconds = {}
    for name in names:
        run_once(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
        if verbose:
            print(f"{name:28} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

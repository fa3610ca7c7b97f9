"""Benchmark the headline queries.

Runs every query once to warm up, then three timed runs of a full ``noop``
write (every row and column is produced; ``count()`` would let Catalyst prune
columns), and reports the median per query. The cache is cleared before every
run so sides persisted for a broadcast size check are recomputed each time.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``BENCH_SHUFFLE_ONLY=1`` is the ablation: no measured broadcast and
``autoBroadcastJoinThreshold=-1``, i.e. every join a shuffle join (the source
system's plan shape). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terrace.plans import catalogue  # noqa: E402
from terrace.session import build_session  # noqa: E402

HEADLINE = [
    "gold_sales", "gold_neighbourhood", "gold_real_estate", "gold_sale_prices",
    "agg_null_preserving_sum", "agg_sum_with_names", "agg_count_per_key", "latest_per_key",
    "dedup_keep_first", "scan_parquet_project", "date_string_parse", "impute_median_mode",
    "standardise_columns", "one_hot_categories", "split_by_hash", "clean_features",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run_once(spark, fn, sf: str) -> float:
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": "16g"}
    shuffle_only = os.environ.get("BENCH_SHUFFLE_ONLY", "") == "1"
    if shuffle_only:
        extra.update({"spark.terrace.broadcast": "false",
                      "spark.sql.autoBroadcastJoinThreshold": "-1"})
    spark = build_session(f"local[{cpus}]", app="terrace-bench",
                          shuffle_partitions=max(8, 2 * cpus), extra=extra)
    for name in names:                                # warm-up pass over every query
        run_once(spark, catalogue.QUERIES[name], sf)
    results = {}
    for name in names:
        fn = catalogue.QUERIES[name]
        times = [run_once(spark, fn, sf) for _ in range(RUNS)]
        results[name] = round(statistics.median(times), 3)
    spark.stop()
    sf_label = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf_label,
        "cpus": cpus,
        "shuffle_partitions": max(8, 2 * cpus),
        "headline": "gold_sales",
        "joins": "shuffle_only" if shuffle_only else "measured_broadcast",
    }))


if __name__ == "__main__":
    main()

"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS timed runs per query
after one warm-up (default 1; with more, the median counts), BENCH_KEYS: comma list of keys, or 'all'.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from tablewright import build_session
from tablewright.plans.catalog import REGISTRY

HEADLINE = (
    "scan_table", "table_row_counts", "filter_date_range", "filter_below_average", "distinct_rows",
    "inner_join_using_chain", "left_outer_join", "full_outer_daily_totals", "semi_join_nested", "anti_join_not_in",
    "self_join_pairs", "cross_anti_pairs", "greater_than_all", "correlated_count", "correlated_next_key",
    "composite_key_join", "relational_division", "group_by_year_distinct", "group_sum_m2m", "avg_days_open_or_closed",
    "library_totals", "max_of_group_counts", "concat_ordered", "concat_distinct_two", "median_of_counts",
    "rank_over_aggregate", "row_number_first_per_key", "surrogate_keys", "first_visit_list", "union_max_all",
    "except_distinct", "str_split_dates", "fn_check_dates", "tf_free_key_ranges", "proc_compact_keys",
    "update_from_join", "inc_library_totals", "inc_denormalised_copy", "inc_active_count", "rule_max_active",
    "stream_totals", "dedup_nested_records", "tree_flatten", "palindrome_words", "json_schema_check",
    "status_flow_audit", "html_attr_extract",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_KEYS", "")
    keys = list(REGISTRY) if wanted == "all" else [k for k in wanted.split(",") if k] or list(HEADLINE)
    spark = build_session("bench", f"local[{cpus}]", int(cpus), {"spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")

    def once(key: str) -> float:
        began = time.perf_counter()
        REGISTRY[key].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for key in keys:
        once(key)
        seconds[key] = round(statistics.median(once(key) for _ in range(runs)), 3)
        print(key, seconds[key], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": f"sum of query seconds, median of {runs} after one warm-up",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

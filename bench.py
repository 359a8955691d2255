"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     threads of the local master (default 8)
BENCH_QUERIES  comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from corpusflow.catalog import QUERIES
from corpusflow.session import build_session, release

HEADLINE = [
    "agg01_binary_mapping", "agg06_compile_summary", "agg07_libraries_per_repo", "agg08_corpus_rollup", "agg12_address_sets",
    "agg14_log_series", "agg16_log_snapshot", "agg19_repo_meta", "cls01_clone_outcome", "fil08_build_systems",
    "jn01_requests", "jn02_unprocessed_repos", "jn03_pending_binaries", "jn04_decompiled_for_repo", "jn07_matched_functions",
    "jn08_run_comparison", "jn10_token_positions", "jn11_package_candidates", "jn12_renamed_variables", "jn14_nearest_addresses",
    "js01_decoded_lines", "js02_c_nodes", "js03_subtree_folds", "js04_rebuilt_trees", "ord02_stable_batches",
    "ord03_running_totals", "prj01_repo_names", "prj03_work_plan", "prj06_content_hashes", "stm01_streamed_state",
    "txt01_summaries", "txt05_variables", "txt08_full_names", "txt12_spliced_files", "txt15_token_lines",
    "txt16_functions", "txt17_function_tokens", "txt19_compile_commands", "ups01_add_repos", "ups03_add_binaries",
    "win01_time_budget", "win02_first_claims", "win03_best_packages", "win05_variable_ids",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    shared = tempfile.TemporaryDirectory(prefix="bench-", ignore_cleanup_errors=True)
    spark = build_session(
        f"local[{cpus}]", "bench",
        **{"spark.checkpoint.dir": f"file://{shared.name}"},
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm-up
    seconds: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        release(spark)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    scale = float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

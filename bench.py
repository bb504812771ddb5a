"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from labelmill.plans import registry
from labelmill.session import build_session

HEADLINE = [
    "census_block_kinds", "census_report", "census_problems", "split_counts_orders", "template_counts_zero_filled",
    "joined_view", "unnest_candidates", "assert_controls", "null_gate",
    "block_kinds_parse", "mutations", "first_mutation", "compose_pair", "render_program", "edit_swap_pins", "method_header_refusals",
    "path_findings", "audit_findings", "trusted_sources", "first_hit_per_file", "backfill", "derive_memoised", "size_sha_verify", "form_stats",
    "trace_diff", "on_delay", "press_hold", "steps_until_failure", "api_readback", "config_readback", "csharp_formula_expect",
    "schedule_blocks", "allocate", "frame_pick_fill", "generate_controllers", "entry_parse", "group_counts", "accessories_1nf", "resume_antijoin",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    seconds: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeats):
            started = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "repeats": repeats,
            }
        )
    )


if __name__ == "__main__":
    main()

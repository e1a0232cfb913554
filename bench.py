"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from voxframe.catalog import REGISTRY

HEADLINE = [
    "split_plan_counts",
    "pilot_rows",
    "sampled_rows_per_phase",
    "strict_one_to_one_join",
    "cache_plan_rows",
    "selected_archive_members",
    "fixed_size_shards",
    "phase_tables",
    "length_filtered_rows",
    "round_robin_voices",
    "mean_vector_per_label",
    "utterances_per_speaker",
    "micro_error_rate",
    "word_edit_counts",
    "confusion_tables",
    "flattened_score_summary",
    "latency_summary_by_type",
    "latency_histogram",
    "global_ordinals",
    "dynamic_frame_batches",
    "token_budget_batches",
    "passing_streaks",
    "phase_extremes",
    "asr_normal_forms",
    "frontend_sentence_rows",
    "padded_token_batches",
    "audio_metric_rows",
    "table_digest",
    "request_counts_by_hour",
    "request_lifecycles",
    "declared_stage_chain",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxframe-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    REGISTRY["category_counts"].run(spark, folder).collect()  # start the JVM's code paths
    times = {}
    for name in wanted:
        begin = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

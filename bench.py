"""Time the registered queries and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query, of which the median counts (default 1)
BENCH_QUERIES  comma-separated names (default: the headline queries)
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "next_batches",
    "encode_records",
    "shard_listing",
    "route_to_shard",
    "route_streams",
    "read_limited",
    "read_limited_large",
    "poll_pacing",
    "lease_lookup",
    "map_messages",
    "map_messages_pandas",
    "micro_batches",
    "map_batches",
    "partition_by",
    "resume_read",
    "multi_app_resume",
    "checkpoints_from_acks",
    "checkpoints_contiguous",
    "pending_retries",
    "completed_shards",
    "drop_redelivered",
    "consumer_lag",
    "shard_parents",
    "ready_shards",
    "shard_generations",
    "ordered_replay",
    "create_leases",
    "renew_leases",
    "take_leases",
    "apply_checkpoints_table",
    "lease_actions",
    "fold_leases",
    "stale_leases",
    "consume",
    "consume_leases",
]


def main() -> None:
    from shardweave.workloads.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        # the noop sink computes every row and column without collecting them
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("next_batches")  # start-up of the JVM and the Python workers is not a query's time
    run("map_messages_pandas")
    times = {}
    for name in names.split(",") if names else HEADLINE:
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name:28s} {times[name]:8.3f} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

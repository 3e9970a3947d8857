"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "wide_state", "latest_nonzero_state", "state_after_resets", "state_as_of_block", "account_fields_latest", "block_end_storage",
    "envelope_roundtrip", "persisted_changes", "block_summary_counts", "retry_dedup", "interval_defects",
    "cohort_overlap", "retention_plan", "current_storage", "code_dedup", "state_digest", "state_fingerprint",
    "storage_roots", "page_chunks", "latency_distribution", "stream_fold_state",
]


def main() -> None:
    from chainfold.queries import collection
    from chainfold.session import local_session
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus=cpus, memory="12g", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    wanted = sys.argv[1:] or HEADLINES

    def run(name: str) -> float:
        start = time.perf_counter()
        collection.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("state_after_resets")            # start the JVM's compilers once
    seconds = {name: round(min(run(name), run(name)), 3) for name in wanted}
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "reduction_rows_per_sec": round(rows / seconds["wide_state"]) if "wide_state" in seconds else None}))
    spark.stop()


if __name__ == "__main__":
    main()

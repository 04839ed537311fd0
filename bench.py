"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

import json
import os
import statistics
import sys
import time

from tidemirror.catalog import QUERIES
from tidemirror.session import build_session

HEADLINE = [
    "upsert_merge",
    "upsert_merge_small_batch",
    "reconcile_delete",
    "replace_children",
    "cascade_delete",
    "dedup_multi_view",
    "ingest_pages_explode",
    "active_id_sweep",
    "parse_timestamp",
    "flatten_json_fields",
    "enrich_lookup",
    "surrogate_keys",
    "fact_deal_products",
    "classify_outcome",
    "rate_limit_batch",
    "rate_limit_stream",
    "stream_upsert",
    "load_deals",
    "load_tasks",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(spark, name, sf):
    began = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(spark, name, sf)
        seconds[name] = round(statistics.median(timed(spark, name, sf) for _ in range(RUNS)), 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

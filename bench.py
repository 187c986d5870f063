"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from leafmill.plans.queries import QUERIES  # noqa: E402
from leafmill.session import local_session  # noqa: E402

HEADLINE = [
    "chunk_lines", "chunk_pages", "chunk_stats", "page_elements", "entities_long", "hash_embed",
    "postings", "bm25_topk", "bm25_filtered", "knn_topk", "knn_approximate", "hybrid_topk",
    "upsert_latest", "merge_metadata", "batch_sizes", "normalize_missing", "ingest_conversations",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    # Start the JVM's compiler and the Python workers before the clock.
    QUERIES["hash_embed"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

"""Time the headline queries; prints one JSON line.

Each query is built and run to the end once to warm up and then timed, all of its
columns computed and dropped by Spark's ``noop`` sink.
"""

import json
import os
import time

from folia.checks.catalog import QUERIES
from folia.session import local_session

HEADLINE = (
    "clean_text",
    "doc_metadata",
    "chunk_documents",
    "embed_chunks",
    "process_documents",
    "process_embed_store",
    "read_results",
    "similarity_search",
    "similarity_search_batch",
    "search_by_text_batch",
    "ann_search",
    "pending_files",
    "process_outcomes",
    "notify_filter",
    "notify_stream",
)


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, cores)
    timings = {}
    for name in names:
        run(spark, sf_dir, name)
        timings[name] = round(run(spark, sf_dir, name), 3)
    spark.stop()
    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()

"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs twice on a warm session; the better time counts. Results go to the ``noop`` sink, so
every row is computed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "embed_corpus", "embed_corpus_shapes", "upsert_replace", "upsert_merge", "dedupe_before_embed", "validate_vectors",
    "delete_by_ids", "get_by_ids", "filtered_fetch", "to_documents", "filter_and", "filter_nor", "topk_cosine",
    "batch_topk", "batch_topk_grid", "topk_prefilter", "topk_namespace", "topk_by_text", "mmr", "retrieve",
    "ivf_assign", "ivf_search", "candidate_rerank", "knn_graph", "knn_graph_in_lists",
]


def timed(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, "embed_corpus", folder)  # start the Python workers
    times = {name: round(min(timed(spark, name, folder) for _ in range(2)), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

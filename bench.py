"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from passagework import runtime
from workload.queries import QUERIES

HEADLINE = (
    "unnest_pages",
    "chunk_passages",
    "dedup_passages",
    "passage_ids",
    "hash_embed",
    "topk_inner_product",
    "retrieve",
    "recall_at_k",
    "recall_with_without_rerank",
    "chunk_sweep",
    "normalize_answer",
    "token_f1",
    "vote_consensus",
    "rag_eval",
    "rag_eval_consensus",
    "split_shards",
    "word_stats",
    "common_answers",
    "length_histogram",
    "stream_ingest_dedup",
)


def main() -> None:
    runtime.use_in_local_mode(lambda: tempfile.mkdtemp(prefix="passagework-"))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("passagework-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

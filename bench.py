"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores),
``BENCH_RUNS`` (timed runs per query, the median counts), ``BENCH_LIMIT`` (seconds that a
query's runs may take together; a query beyond it is stopped and has no number).
Progress goes to stderr after each query.
"""

import json
import os
import signal
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "training_rows",
    "clean_text",
    "pair_replies",
    "html_unescape",
    "stratified_quota_sample",
    "train_val_split",
    "history_window",
    "knn_join",
    "retrieve_topk",
    "raft_training_rows",
    "chunk_recursive",
    "chunk_paragraphs",
    "embed_tfidf",
    "word_frequency",
    "gibberish_gate",
    "language_id",
    "sentiment",
    "build_vocab",
    "encode_examples",
    "answer_route",
    "clean_response_v2",
    "extract_links",
    "augment_images",
    "crawl_frontier",
    "stream_chat_turns",
]


def stop_query(number, frame):
    raise TimeoutError


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    limit = int(os.environ.get("BENCH_LIMIT", "120"))
    signal.signal(signal.SIGALRM, stop_query)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("threadloom-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from threadloom.plans.catalog import QUERIES

    seconds: dict[str, float | None] = {}
    for name in HEADLINE:
        times = []
        signal.alarm(limit)
        try:
            for _ in range(runs + 1):
                start = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
        except TimeoutError:
            for stream in spark.streams.active:
                stream.stop()
            spark.sparkContext.cancelAllJobs()
        finally:
            signal.alarm(0)
        measured = times[1:] or times  # the first run warms up
        seconds[name] = round(statistics.median(measured), 3) if measured else None
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(s for s in seconds.values() if s is not None), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()

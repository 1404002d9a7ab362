"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Every query runs twice to its last row (the ``noop`` sink). ``queries`` and ``value`` are the second
runs, ``first_run`` the first ones, which also load and compile code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from mailsift.plans.queries import QUERIES
from mailsift.session import build_session

HEADLINE = (
    "word_count",
    "clean_tokens",
    "feature_dictionary",
    "term_frequency",
    "document_frequency",
    "tfidf",
    "sparse_vectors",
    "nb_train_counts",
    "nb_log_scores",
    "nb_predict",
    "class_metrics",
    "knn_sparse_predict",
    "knn_dense_predict",
    "ovr_score",
    "hashing_tfidf_nb",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "mailsift-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    runs = []
    for _ in range(2):
        seconds = {}
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        runs.append(seconds)
    first, seconds = runs
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

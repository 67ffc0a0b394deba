"""Times the headline queries and prints one JSON line.

Each query is run once, after it has run on the smallest tables to warm the JVM
up, and is read to its last row without collecting it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from termloom.plans.registry import QUERIES  # noqa: E402

HEADLINES = [
    "match_no_stem",
    "match_case_sensitive_no_stem",
    "match_english",
    "match_case_sensitive",
    "match_hierarchy",
    "match_since",
    "match_spoken_terms",
    "highlight_snippets",
    "analyze_english",
    "match_sentences",
    "subset_nlp",
    "overlap_all_terms",
    "percolate_batch",
    "percolate_stream",
    "freshness_summary",
    "upsert_matches",
    "delete_term",
    "ingest_terms",
]


def run(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINES:
            run(QUERIES[name], spark, warm)
    seconds = {name: round(run(QUERIES[name], spark, sf_dir), 3) for name in HEADLINES}
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

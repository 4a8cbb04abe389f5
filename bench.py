"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores,
BENCH_RUNS the timed runs per query (the median counts, after one run of each query to warm up).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from tidemark.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "w9_current_risk",
    "w9_risk_scores",
    "w8_change_points",
    "w1_relative_change",
    "w2_ema",
    "w10_price_matrix",
    "w10_price_matrix_long",
    "a1_latest",
    "a2_resample_daily",
    "d1_keep_last",
    "f6_only_newer",
    "j5_map_names",
    "k1_append_new",
    "k2_reconcile",
    "k3_upsert",
    "k6_news_main",
    "k6_news_sentiment",
    "s4_normalize_us_prices",
    "s6_normalize_json_prices",
    "s7_normalize_news",
    "s8_extract_articles",
    "a6_validate_chat",
    "l6_reassemble_blocks",
    "l7_recent_context",
    "t1_stream_prices",
]


def seconds(spark, name: str, sf: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main(names: list[str]) -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        seconds(spark, name, sf)
    times = {}
    for name in names:
        times[name] = round(statistics.median(seconds(spark, name, sf) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", sf)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1).rstrip(".")) if scale else sf,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)

"""Headline queries at $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from pairforge.queries import QUERIES

#: Scan, text functions, vocabulary, equi-joins, windows, dense and sparse similarity, ranking.
HEADLINE = ["preprocess", "tokenize", "vocabulary", "evidence_score", "ranked_matches", "cosine_dense", "percentile_rank", "sector_score", "decide_g4", "latest_verdict", "majority_vote", "entity_resolution", "quantiles"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["quantiles"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # the session is warm
    taken: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        taken[name] = round(time.perf_counter() - began, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "headline_seconds", "value": round(sum(taken.values()), 3), "unit": "sec", "queries": taken, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

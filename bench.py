"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one warm-up, then the median of three."""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from strata_spark.queries import QUERIES

HEADLINE = ("projection_ratios_long", "household_geo", "sample_exact", "sample_exact_multi_year", "sample_bernoulli", "sampled_households", "sampled_persons", "sampled_dwellings", "flat_sample", "crosstab_all_long", "crosstab_joint")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()

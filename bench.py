"""Times the headline queries on one machine and prints one JSON line.

BENCH_SF_DIR is the table folder (default sf0.1), BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Observation, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from seriesloom.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "silver_build",
    "feature_store",
    "feature_store_keyed",
    "cleaning_cascade",
    "asof_backward",
    "asof_single_series",
    "quantile_trim",
    "rolling_means",
    "rolling_std",
    "row_lags",
    "row_lags_single_series",
    "horizon_targets_keyed",
    "after_stoppage",
    "resample_hourly",
    "describe",
    "drift_monitor",
    "stream_ingest",
    "stream_resample",
    "anomaly_health",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("seriesloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/events.parquet").count()  # the session is up before the clock starts
    times, rows = {}, {}
    for name in HEADLINE:
        start = time.perf_counter()
        # all columns are computed and counted on the way to a sink that drops them
        seen = Observation(name)
        QUERIES[name](spark, sf).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode(
            "overwrite"
        ).save()
        times[name] = round(time.perf_counter() - start, 3)
        rows[name] = seen.get["n"]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows": rows,
                "sf": Path(sf).name,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

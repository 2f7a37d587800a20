"""Times the queries at `$BENCH_SF_DIR` on `local[$BENCH_CPUS]`; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txnlake import session  # noqa: E402
from txnlake.plans import lake  # noqa: E402
from txnlake.plans.queries import queries  # noqa: E402

def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    stream_repeats = int(os.environ.get("BENCH_STREAM_REPEATS", "3"))
    builder = session.apply_cluster_settings(
        SparkSession.builder.master(f"local[{cpus}]").appName("txnlake-bench")
    )
    spark = (
        builder.config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries()
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds: dict[str, float] = {}

    def consume(name):
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds["write_bronze"] = timed(lambda: lake.stored_bronze(spark, sf_dir))
    seconds["write_silver"] = timed(lambda: lake.stored_silver(spark, sf_dir))
    lake.landed_messages(spark, sf_dir)
    for name in registry:
        times = stream_repeats if name.startswith("stream_") else repeats
        seconds[name] = min(timed(lambda name=name: consume(name)) for _ in range(times))

    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf_dir.rsplit("sf", 1)[-1]),
                "input_rows": rows,
                "parse_and_flag_rows_per_sec": round(rows / seconds["silver_fraud_flags"]),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

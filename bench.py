"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per query
(after one that is not timed), BENCH_QUERIES a comma-separated choice or `all`.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from penstock.operators import curated, kpis, raw  # noqa: E402
from penstock.plans import registry  # noqa: E402
from penstock.session import RECOMMENDED, scratch_path  # noqa: E402
from penstock.sources import readings as src  # noqa: E402

HEADLINE = [
    "window_kpis_1m",
    "window_kpis_5m",
    "window_kpis_1h",
    "merge_kpis",
    "curated_from_json",
    "performance_columns",
    "alert_flags",
    "derived_metrics",
    "quality_rejects",
    "dedup_events",
    "enrich_with_plant",
    "minute_series",
    "latest_per_plant",
    "fleet_kpis",
    "health_board",
    "silver_snapshot",
    "top_recent_anomalies",
    "kpi_table_view_5m",
    "rain_power_regression",
    "power_distribution",
    "running_energy",
    "running_oee",
    "maintenance_episodes",
    "maintenance_seconds",
    "stream_curated",
    "stream_window_kpis_5m",
]


def session(cpus: int) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("penstock-bench")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(query, spark: SparkSession, sf_dir: str, runs: int) -> float:
    timed(query, spark, sf_dir)
    return statistics.median(timed(query, spark, sf_dir) for _ in range(runs))


def layer_seconds(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    """Each layer by itself, from the stored layer below it."""
    base = scratch_path(spark, "layers")
    parts = spark.sparkContext.defaultParallelism
    src.event_frame(src.readings(spark, sf_dir)).repartition(parts).write.parquet(f"{base}/log")
    log = spark.read.parquet(f"{base}/log")
    curated.curate(log).repartition(parts).write.parquet(f"{base}/curated")
    stored = spark.read.parquet(f"{base}/curated")
    layers = {
        "raw": lambda spark, sf_dir: raw.raw_project(log),
        "curated": lambda spark, sf_dir: curated.curate(log),
        "kpis_5m": lambda spark, sf_dir: kpis.window_kpis(stored, 5),
        "kpis_1h": lambda spark, sf_dir: kpis.window_kpis(stored, 60),
    }
    return {name: median(layer, spark, sf_dir, runs) for name, layer in layers.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    known = registry.queries()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(known) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    for name in names:
        seconds[name] = round(median(known[name], spark, sf_dir, runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    layers = layer_seconds(spark, sf_dir, runs)
    rates = {name: round(events / taken) for name, taken in layers.items()}
    print(
        json.dumps(
            {
                "metric": "sum of median seconds per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": events,
                "rows_per_second": rates,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

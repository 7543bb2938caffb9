"""Late readings: which stored windows they touch, and repair of those alone.

The curated job writes down, per batch, the windows its readings fall into. What the KPI stream has
given out already and a later batch touches again is out of date. Repair reads those windows from
the curated table, puts them in place of the stored partial rows, and rewrites only the days they lie
in; hours and all other widths are folded from the partial rows and need nothing of their own.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.operators import curated, kpis
from penstock.sources.tables import PARTIAL_MINUTES, partial_scan, table_scan
from penstock.streaming.sinks import BATCH, BatchFunction, write_batch
from penstock.upkeep.files import Folder
from penstock.upkeep.rewrite import batches_of, replace_batches

KEY = ["plant_id", "window_start"]
LEDGER = T.StructType(
    [
        T.StructField("plant_id", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_date", T.DateType()),
        T.StructField(BATCH, T.LongType()),
    ]
)


def windows_of(readings: DataFrame) -> DataFrame:
    """The windows that readings fall into, each once; counted before the shuffle."""
    start = F.window("event_ts", f"{PARTIAL_MINUTES} minutes")["start"]
    touched = readings.select("plant_id", start.alias("window_start")).distinct()
    return touched.withColumn("window_date", F.to_date("window_start"))


def noting(sink: BatchFunction, curated_path: str, ledger: str) -> BatchFunction:
    """`sink`, and then the windows of the batch to the ledger; both replace themselves when the
    batch is repeated. The windows come from two columns of what has just been written."""

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        fields = [f for f in batch.schema.fields if f.name in ("plant_id", "event_ts", "event_date")]
        schema = T.StructType([*fields, T.StructField(BATCH, T.LongType())])
        if not Folder(batch.sparkSession, curated_path).exists():
            return
        written = table_scan(batch.sparkSession, curated_path, schema).filter(F.col(BATCH) == batch_id)
        write_batch(windows_of(written), batch_id, ledger, ["window_date"], "plant_id")

    return run


def dirty_windows(spark: SparkSession, ledger: str, closed_until: Column | None = None) -> DataFrame:
    """Windows noted since the last repair that end by `closed_until`, the time up to which windows
    have been given out (the newest event time less the watermark)."""
    noted = spark.read.schema(LEDGER).parquet(ledger).drop(BATCH).distinct()
    if closed_until is None:
        return noted
    end = F.col("window_start") + F.expr(f"INTERVAL {PARTIAL_MINUTES} MINUTES")
    return noted.filter(end <= closed_until)


def repair(
    spark: SparkSession,
    curated_path: str,
    curated_schema: T.StructType,
    partial_path: str,
    ledger: str,
    closed_until: Column | None = None,
) -> list:
    """Bring the noted windows up to date; returns the days rewritten.

    Refused, before anything changes, where the curated table holds fewer readings of a window than
    the stored row counts: retention has been there, and the row is all that is left. A repair that
    was interrupted is completed by `rewrite.finish` or done again. Run it on closed days, as readers
    of a day see part of it while its folders are swapped."""
    if not Folder(spark, ledger).exists():
        return []
    notes = Folder(spark, ledger)
    taken = [f"{day}/{leaf}" for day in notes.folders() for leaf in notes.below(day).leaves(BATCH)]
    dirty = dirty_windows(spark, ledger, closed_until)
    days = sorted(r.window_date for r in dirty.select("window_date").distinct().collect())
    if not days:
        return []
    table = table_scan(spark, curated_path, curated_schema).filter(F.col("event_date").isin(days))
    start = F.window("event_ts", f"{PARTIAL_MINUTES} minutes")["start"]
    touched = table.withColumn("window_start", start).join(dirty.select(*KEY), KEY, "left_semi")
    fresh = kpis.partial_kpis(curated.dedup_events(touched.drop("window_start")), PARTIAL_MINUTES)
    stored = partial_scan(spark, partial_path).filter(F.col("window_date").isin(days))
    counts = fresh.select(*KEY, F.col("event_count").alias("_now"))
    before = stored.join(dirty.select(*KEY), KEY, "left_semi").join(counts, KEY, "left")
    lost = before.filter(F.coalesce(F.col("_now"), F.lit(0)) < F.col("event_count"))
    if not lost.isEmpty():
        raise ValueError("the curated table no longer holds all readings of a window to repair")
    old = [leaf for day in days for leaf in batches_of(spark, partial_path, "window_date", day)]
    kept = stored.join(dirty.select(*KEY), KEY, "left_anti")
    dated = fresh.withColumn("window_date", F.to_date("window_start"))
    replace_batches(spark, partial_path, old, kept.unionByName(dated), ["window_date"], "plant_id")
    if closed_until is not None:
        # Windows that are still open stay on the ledger, as a batch of their own.
        noted = dirty_windows(spark, ledger)
        write_batch(noted.join(dirty, noted.columns, "left_anti"), -time.time_ns(), ledger, ["window_date"], "plant_id")
    for leaf in taken:
        notes.below(leaf).delete()
    return days

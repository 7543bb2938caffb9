"""The three layers as streaming queries, and the episode table.

Every job takes a stream and returns a started query. `trigger` is passed to the writer, such as
`{"availableNow": True}`; without it the job runs at the interval of the settings. Every table is
written with a batch number, so that a batch repeated after a failure replaces itself. `upkeep`,
such as a retention run, is called after every so many batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from penstock.operators import curated, history, kpis, raw
from penstock.settings import LIMITS, Limits, Settings
from penstock.sources.tables import PARTIAL_MINUTES, table_scan
from penstock.streaming.sinks import BATCH, BatchFunction, batch_writer, every, unique_writer, write_batch
from penstock.upkeep import dirty


def _kept_up(sink: BatchFunction, batches: int, upkeep: Callable[[], None] | None) -> BatchFunction:
    return every(batches, upkeep, sink) if upkeep else sink


def _start(
    stream: DataFrame,
    name: str,
    sink: BatchFunction,
    checkpoint: str,
    seconds: int,
    trigger: dict | None,
) -> StreamingQuery:
    counted = stream.observe(name, F.count(F.lit(1)).alias("rows"))
    return (
        counted.writeStream.queryName(name)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": f"{seconds} seconds"}))
        .start()
    )


def raw_job(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    upkeep: Callable[[], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Log to raw table, by ingest date."""
    sink = batch_writer(path, ["ingest_date"], "kafka_offset")
    sink = _kept_up(sink, settings.raw_maintenance_batches, upkeep)
    stored = raw.raw_project(frame)
    return _start(stored, "raw", sink, checkpoint, settings.raw_trigger_seconds, trigger)


def curated_job(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    limits: Limits = LIMITS,
    dedup: bool = False,
    by: list[str] = ("event_date", "plant_id"),
    upkeep: Callable[[], None] | None = None,
    trigger: dict | None = None,
    ledger: str | None = None,
    unique: bool = False,
) -> StreamingQuery:
    """Log or raw table to curated table, every usable record however late.

    With `unique` the table holds each event once, repeats of any age are looked for in the table.
    Without it repeats are left to readers: KPI streams, rebuild_windows and dedup_events take each
    event once. With `ledger` the windows of each batch are noted there, for the repair of late ones.
    With `dedup` the stream itself drops them, and with them all that is behind the watermark."""
    rows = curated.curate(frame, limits)
    if dedup:
        rows = curated.dedup_stream(rows, settings.watermark)
    sink = batch_writer(path, list(by), "event_id")
    if unique:
        sink = unique_writer(path, list(by), "event_id", "event_id", "event_date", curated.dedup_events)
    if ledger:
        sink = dirty.noting(sink, path, ledger)
    sink = _kept_up(sink, settings.curated_maintenance_batches, upkeep)
    return _start(rows, "curated", sink, checkpoint, settings.curated_trigger_seconds, trigger)


def quarantine_job(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """The records curation leaves out, by reason."""
    sink = batch_writer(path, ["reason"], "kafka_offset")
    rows = curated.quarantine(frame)
    return _start(rows, "quarantine", sink, checkpoint, settings.curated_trigger_seconds, trigger)


def closed_window_kpis(readings: DataFrame, minutes: int, watermark: str) -> DataFrame:
    """KPIs of windows the watermark has passed: each one exactly once, from unique events."""
    return kpis.window_kpis(curated.dedup_stream(readings, watermark), minutes)


def kpi_job(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    minutes: int,
    settings: Settings = Settings(),
    upkeep: Callable[[], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Curated stream to KPI table, by window date. Later data: see upkeep.rebuild."""
    closed = closed_window_kpis(readings, minutes, settings.watermark)
    dated = closed.withColumn("window_date", F.to_date("window_start"))
    sink = batch_writer(path, ["window_date"], "plant_id")
    sink = _kept_up(sink, settings.kpi_maintenance_batches, upkeep)
    name = f"kpis_{minutes}m"
    return _start(dated, name, sink, checkpoint, settings.kpi_trigger_seconds, trigger)


def partial_job(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    upkeep: Callable[[], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Curated stream to partial KPI rows of closed windows, the one store behind all widths.

    One stream and one state of event ids serve the KPI tables of every width, the breaches and the
    repair of late windows: `kpis.fold` adds the rows up, `upkeep.dirty.repair` replaces some."""
    unique = curated.dedup_stream(readings, settings.watermark)
    partials = kpis.partial_kpis(unique, PARTIAL_MINUTES)
    dated = partials.withColumn("window_date", F.to_date("window_start"))
    sink = batch_writer(path, ["window_date"], "plant_id")
    sink = _kept_up(sink, settings.kpi_maintenance_batches, upkeep)
    return _start(dated, "partials", sink, checkpoint, settings.kpi_trigger_seconds, trigger)


def breach_job(
    readings: DataFrame,
    sink: BatchFunction,
    checkpoint: str,
    minutes: int,
    settings: Settings = Settings(),
    limits: Limits = LIMITS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Closed windows above the alert limits, to any sink."""
    closed = closed_window_kpis(readings, minutes, settings.watermark)
    breaches = kpis.alert_breaches(closed, limits)
    return _start(breaches, "breaches", sink, checkpoint, settings.kpi_trigger_seconds, trigger)


def run_job(
    readings: DataFrame,
    curated_path: str,
    path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Status runs by day, for maintenance episodes that grow with the data.

    A batch says which days have changed; the runs of those days are worked out again from the
    curated table and replaced. That takes late readings in, stays right when a batch is repeated,
    and spreads one plant's day over many tasks, which a state per plant would not.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        days = [row.event_date for row in batch.select("event_date").distinct().collect()]
        if not days:
            return
        session = batch.sparkSession
        table = table_scan(session, curated_path, readings.schema)
        changed = table.filter(F.col("event_date").isin(days))
        unique = curated.dedup_events(
            changed.select("plant_id", "event_ts", "event_id", "status", "event_date", "kafka_offset")
        )
        runs = history.day_runs(unique)
        dated = runs.withColumn("event_date", F.date_from_unix_date(F.col("unit").cast("int")))
        write_batch(dated, 0, path, ["event_date"], "start_ts")

    return _start(
        readings, "runs", refresh, checkpoint, settings.kpi_trigger_seconds, trigger
    )


def stored_episodes(spark: SparkSession, path: str) -> DataFrame:
    """Maintenance episodes of the run table."""
    return history.join_runs(spark.read.parquet(path).drop(BATCH, "event_date"))

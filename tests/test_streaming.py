"""Streams against the same transform on a table; repeats, restarts and late events."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penstock.model import CURATED_TABLE, KPI_TABLE, RAW_FRAME
from penstock.operators import curated, history, kpis
from penstock.sources import log, tables
from penstock.sources import readings as src
from penstock.streaming import jobs, sinks
from penstock.streaming.listener import BatchMetrics, batch_metrics

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    """Curated readings of four hours, so that a stream has few partitions to write."""
    start = datetime(2024, 1, 1)
    rows = src.curated(spark, sf_dir)
    squeezed = F.timestamp_seconds(
        F.lit(start.timestamp()) + F.pmod(F.xxhash64("event_id"), F.lit(4 * 3600))
    )
    moved = rows.withColumn("event_ts", squeezed)
    return curated.derive_columns(moved).cache()


def write_in_order(df, path, files):
    """One file per slice of event time, written one after the other."""
    step = timedelta(hours=4) / files
    for i in range(files):
        first = datetime(2024, 1, 1) + i * step
        part = df.filter((F.col("event_ts") >= first) & (F.col("event_ts") < first + step))
        part.coalesce(1).write.mode("append").parquet(path)


def run(query):
    query.awaitTermination()
    return query


def test_curated_stream_equals_batch(spark, sf_dir, tmp_path):
    frame = src.event_frame(src.readings(spark, sf_dir).limit(300))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in RAW_FRAME]
    again = frame.withColumn("offset", F.col("offset") + 10_000)
    frame.union(again).write.parquet(f"{tmp_path}/log")
    stream = log.frame_source(spark, f"{tmp_path}/log", max_files=1)
    run(jobs.curated_job(stream, f"{tmp_path}/curated", f"{tmp_path}/state", trigger=ONCE))
    whole = tables.table_scan(spark, f"{tmp_path}/curated", CURATED_TABLE)
    expected = curated.curate(frame)
    assert whole.count() == 2 * expected.count()
    stored = curated.dedup_events(whole)
    columns = [c for c in CURATED_TABLE.names if c != "kafka_offset"]
    assert stored.count() == expected.count()
    assert stored.select(columns).exceptAll(expected.select(columns)).count() == 0
    # Started again with nothing new, the job adds nothing.
    stream = log.frame_source(spark, f"{tmp_path}/log", max_files=1)
    run(jobs.curated_job(stream, f"{tmp_path}/curated", f"{tmp_path}/state", trigger=ONCE))
    spark.catalog.refreshByPath(f"{tmp_path}/curated")
    assert tables.table_scan(spark, f"{tmp_path}/curated", CURATED_TABLE).count() == whole.count()


def test_late_readings_are_stored(spark, sf_dir, tmp_path):
    frame = src.event_frame(src.readings(spark, sf_dir))
    thirds = frame.withColumn("third", F.ntile(3).over(Window.orderBy(F.col("timestamp").desc(), "offset")))
    for number in (1, 2, 3):  # newest first, one file and batch each
        part = thirds.where(F.col("third") == number).drop("third").coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/log")
        stream = log.frame_source(spark, f"{tmp_path}/log", max_files=1)
        run(jobs.curated_job(stream, f"{tmp_path}/curated", f"{tmp_path}/state", by=["event_date"], trigger=ONCE))
    spark.catalog.refreshByPath(f"{tmp_path}/curated")
    stored = tables.table_scan(spark, f"{tmp_path}/curated", CURATED_TABLE)
    expected = curated.curate(frame)
    assert stored.exceptAll(expected.select(*stored.columns)).count() == 0
    assert stored.count() == expected.count()


def test_repeated_batch_replaces_itself(spark, table, tmp_path):
    path, by = f"{tmp_path}/t", ["event_date", "plant_id"]
    batch = table.limit(50)
    sinks.write_batch(batch, 3, path, by, "event_id")
    sinks.write_batch(batch, 3, path, by, "event_id")
    assert spark.read.parquet(path).count() == 50
    sinks.write_batch(batch, 4, path, by, "event_id")
    spark.catalog.refreshByPath(path)
    assert spark.read.parquet(path).count() == 100


def test_batch_without_rows_writes_nothing(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_batch(table.limit(0), 0, path, ["event_date"], "event_id")
    assert [p.name for p in (tmp_path / "t").iterdir() if "=" in p.name] == []


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(300_000).select(F.lit("one").alias("plant_id"), "id", F.rand(1).alias("v"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512k")
    try:
        sinks.write_batch(hot, 0, f"{tmp_path}/t", ["plant_id"], "id")
    finally:
        spark.conf.set(key, before)
    files = list((tmp_path / "t" / "plant_id=one").rglob("*.parquet"))
    assert len(files) >= 4
    sizes = [f.stat().st_size for f in files]
    assert max(sizes) < sum(sizes) / 2


def test_closed_windows_once_each(spark, table, tmp_path):
    """Eight micro-batches, every reading twice; a window is given out once and complete."""
    write_in_order(table.union(table), f"{tmp_path}/curated", 8)
    stream = tables.table_stream(spark, f"{tmp_path}/curated", CURATED_TABLE, max_files=1)
    query = run(jobs.kpi_job(stream, f"{tmp_path}/kpis", f"{tmp_path}/state", 5, trigger=ONCE))
    found = tables.kpi_scan(spark, f"{tmp_path}/kpis")
    newest = table.agg(F.max("event_ts")).first()[0]
    expected = kpis.window_kpis(table, 5).filter(F.col("window_end") <= newest - timedelta(minutes=10))
    key = ["plant_id", "window_start", "event_count", "critical_count", "power_max_mw"]
    assert found.count() == found.dropDuplicates(["plant_id", "window_start"]).count()
    assert sorted(map(tuple, found.select(key).collect())) == sorted(
        map(tuple, expected.select(key).collect())
    )
    assert found.schema.names == KPI_TABLE.names
    assert sum(batch_metrics(p)["late_rows"] for p in query.recentProgress) == 0


def test_late_event_is_dropped_and_counted(spark, table, tmp_path):
    path = f"{tmp_path}/curated"
    newest = table.agg(F.max("event_ts")).first()[0]
    table.coalesce(1).write.parquet(path)
    late = (
        table.limit(1)
        .withColumn("event_id", F.lit("late"))
        .withColumn("event_ts", F.lit(newest - timedelta(hours=2)))
    )
    reported = []
    listener = BatchMetrics(reported.append)
    spark.streams.addListener(listener)
    try:
        for extra in (None, late):
            if extra is not None:
                extra.coalesce(1).write.mode("append").parquet(path)
            stream = tables.table_stream(spark, path, CURATED_TABLE)
            run(jobs.kpi_job(stream, f"{tmp_path}/kpis", f"{tmp_path}/state", 60, trigger=ONCE))
    finally:
        spark.streams.removeListener(listener)
    total = tables.kpi_scan(spark, f"{tmp_path}/kpis").agg(F.sum("event_count")).first()[0]
    closed = kpis.window_kpis(table, 60).filter(F.col("window_end") <= newest - timedelta(minutes=10))
    assert total == closed.agg(F.sum("event_count")).first()[0]
    mine = [m for m in reported if m["query"] == "kpis_60m"]
    assert sum(m["late_rows"] for m in mine) == 1
    assert sum(m["input_rows"] for m in mine) == table.count() + 1
    assert any(m["written"].get("kpis_60m", {}).get("rows") for m in mine)


def test_breaches_of_a_stream(spark, table, tmp_path):
    table.coalesce(1).write.parquet(f"{tmp_path}/curated")
    stream = tables.table_stream(spark, f"{tmp_path}/curated", CURATED_TABLE)
    sink = sinks.batch_writer(f"{tmp_path}/breaches", ["plant_id"], "window_start")
    run(jobs.breach_job(stream, sink, f"{tmp_path}/state", 60, trigger=ONCE))
    newest = table.agg(F.max("event_ts")).first()[0]
    expected = kpis.alert_breaches(kpis.window_kpis(table, 60)).filter(
        F.col("window_end") <= newest - timedelta(minutes=10)
    )
    found = spark.read.parquet(f"{tmp_path}/breaches")
    assert found.count() == expected.count() > 0
    assert found.filter("critical_rate_pct <= 5 AND vibration_max_mm_s <= 4.5").count() == 0


def test_episode_table_follows_the_data(spark, table, tmp_path):
    """A second wave of readings falls into days and episodes the first has already written."""
    spread = table.withColumn(
        "event_ts", F.col("event_ts") + F.expr("make_dt_interval(0, 0, 0, 5 * unix_millis(event_ts) % 86400)")
    )
    spread = curated.derive_columns(spread)
    path = f"{tmp_path}/curated"
    waves = [spread.filter("kafka_offset % 3 = 0"), spread.filter("kafka_offset % 3 <> 0")]
    for number, wave in enumerate(waves):
        sinks.write_batch(wave, number, path, ["event_date"], "event_id")
        stream = tables.table_stream(spark, path, CURATED_TABLE)
        run(jobs.run_job(stream, path, f"{tmp_path}/runs", f"{tmp_path}/state", trigger=ONCE))
    spark.catalog.refreshByPath(f"{tmp_path}/runs")
    columns = ["plant_id", "start_ts", "end_ts", "resumed_ts", "readings"]
    found = jobs.stored_episodes(spark, f"{tmp_path}/runs").select(columns)
    expected = history.maintenance_episodes(spread).select(columns)
    assert found.count() == expected.count() > 0
    assert found.exceptAll(expected).count() == 0


def test_task_after_every_third_batch():
    done, written = [], []
    sink = sinks.every(3, lambda: done.append(len(written)), lambda df, i: written.append(i))
    for batch_id in range(7):
        sink(None, batch_id)
    assert done == [3, 6]


def test_kafka_options():
    options = log.kafka_options("host:1", "t")
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    assert log.kafka_options("host:1", "t", max_offsets=9)["maxOffsetsPerTrigger"] == "9"
    assert log.sink_options("host:1", "t")["kafka.acks"] == "all"


def test_kafka_needs_its_package(spark):
    try:
        log.kafka_source(spark, "host:1", "t", starting_offsets="earliest")
    except AnalysisException as error:
        assert "kafka" in str(error)

"""One store of partial rows for all widths, and repair of the windows that late readings touch."""

import os

import pytest
from pyspark.sql import functions as F

from penstock.model import CURATED_TABLE
from penstock.operators import kpis
from penstock.sources import readings as src
from penstock.sources import tables
from penstock.streaming import jobs
from penstock.streaming.sinks import batch_writer, write_batch
from penstock.upkeep import dirty

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    days = ("2024-01-03", "2024-01-04", "2024-01-05")
    return src.curated(spark, sf_dir).filter(F.col("event_date").cast("string").isin(*days)).persist()


def as_rows(df):
    settled = df.withColumns({c: F.round(c, 6) for c, kind in df.dtypes if kind == "double"})
    return sorted(map(str, settled.collect()))


def days_of(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("window_date")}


@pytest.fixture
def layers(spark, rows, tmp_path):
    """Curated readings without some of one day, and the partial rows of what is there."""
    base = str(tmp_path)
    late = (F.col("event_date") == "2024-01-04") & (F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0)
    sink = dirty.noting(batch_writer(f"{base}/curated", ["event_date"], "event_id"), f"{base}/curated", f"{base}/ledger")
    sink(rows.filter(~late), 0)
    stored = tables.table_scan(spark, f"{base}/curated", CURATED_TABLE)
    partials = kpis.partial_kpis(stored, 5).withColumn("window_date", F.to_date("window_start"))
    write_batch(partials, 0, f"{base}/partials", ["window_date"], "plant_id")
    assert dirty.repair(spark, f"{base}/curated", CURATED_TABLE, f"{base}/partials", f"{base}/ledger")
    return base, sink, rows.filter(late)


def test_late_readings_rewrite_their_day_only(spark, rows, layers):
    base, sink, late = layers
    before = days_of(f"{base}/partials")
    for _ in range(2):  # a batch that is repeated notes and stores nothing twice
        sink(late, 1)
    args = (spark, f"{base}/curated", CURATED_TABLE, f"{base}/partials", f"{base}/ledger")
    assert [str(d) for d in dirty.repair(*args)] == ["2024-01-04"]
    after = days_of(f"{base}/partials")
    assert {d for d in after if after[d] != before[d]} == {"window_date=2024-01-04"}
    assert dirty.repair(*args) == []  # the ledger is empty now
    spark.catalog.refreshByPath(f"{base}/partials")
    for minutes in (5, 15, 60):
        found = kpis.fold(tables.partial_scan(spark, f"{base}/partials"), minutes)
        assert as_rows(found) == as_rows(kpis.window_kpis(rows, minutes))


def test_open_windows_stay_on_the_ledger(spark, rows, layers):
    base, sink, late = layers
    sink(late, 1)
    args = (spark, f"{base}/curated", CURATED_TABLE, f"{base}/partials", f"{base}/ledger")
    noon = F.lit("2024-01-04 12:00:00").cast("timestamp")
    assert len(dirty.repair(*args, closed_until=noon)) == 1
    spark.catalog.refreshByPath(f"{base}/ledger")
    left = dirty.dirty_windows(spark, f"{base}/ledger")
    assert left.count() == dirty.windows_of(late.filter(F.col("event_ts") >= noon)).count()
    assert left.filter(F.col("window_start") < noon).isEmpty()
    dirty.repair(*args)
    spark.catalog.refreshByPath(f"{base}/partials")
    found = kpis.fold(tables.partial_scan(spark, f"{base}/partials"), 60)
    assert as_rows(found) == as_rows(kpis.window_kpis(rows, 60))


def test_a_day_partly_gone_is_not_repaired(spark, rows, layers):
    base, sink, late = layers
    sink(rows.filter("event_date = '2024-01-04'"), 1)  # all windows of the day are touched again
    one = rows.filter("event_date = '2024-01-04'").limit(1).first()
    path = f"{base}/thinned"
    write_batch(rows.filter(F.col("event_id") == one.event_id), 0, path, ["event_date"], "event_id")
    before = days_of(f"{base}/partials")
    with pytest.raises(ValueError):
        dirty.repair(spark, path, CURATED_TABLE, f"{base}/partials", f"{base}/ledger")
    assert days_of(f"{base}/partials") == before


def test_one_stream_serves_all_widths(spark, rows, tmp_path):
    """Several batches, every reading sent twice; one state of ids in the stream's plan."""
    base = str(tmp_path)
    for day in ("2024-01-03", "2024-01-04", "2024-01-05"):
        for half in (0, 1):
            part = rows.filter((F.col("event_date") == day) & ((F.col("event_hour") >= 12).cast("int") == half))
            part.union(part).coalesce(1).write.mode("append").parquet(f"{base}/readings")
    stream = tables.table_stream(spark, f"{base}/readings", CURATED_TABLE, max_files=1)
    query = jobs.partial_job(stream, f"{base}/partials", f"{base}/state", trigger=NOW)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 4
    operators = [o.operatorName for o in query.lastProgress.stateOperators]
    assert sorted(operators) == ["dedupeWithinWatermark", "stateStoreSave"]
    closed = rows.agg(F.max("event_ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    for minutes in (5, 60):
        expected = kpis.window_kpis(rows, minutes).filter(F.col("window_end") <= closed)
        found = kpis.fold(tables.partial_scan(spark, f"{base}/partials"), minutes, F.lit(closed))
        assert as_rows(found) == as_rows(expected)


def test_the_curated_job_notes_the_windows(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    frame = src.event_frame(src.readings(spark, sf_dir).filter("event_ts < '2024-01-03'"))
    frame.write.parquet(f"{base}/log")
    from penstock.sources import log

    jobs.curated_job(
        log.frame_source(spark, f"{base}/log"), f"{base}/curated", f"{base}/state", by=["event_date"],
        trigger=NOW, ledger=f"{base}/ledger",
    ).awaitTermination()
    stored = tables.table_scan(spark, f"{base}/curated", CURATED_TABLE)
    noted = dirty.dirty_windows(spark, f"{base}/ledger")
    assert sorted(map(tuple, noted.collect())) == sorted(map(tuple, dirty.windows_of(stored).collect()))

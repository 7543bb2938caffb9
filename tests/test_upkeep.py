"""Retention, rewrites and file listings, with an injected clock."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from penstock.model import CURATED_TABLE
from penstock.operators import curated, kpis
from penstock.sources import readings as src
from penstock.sources import tables
from penstock.streaming.sinks import write_batch
from penstock.upkeep import freshness, retention, rewrite
from penstock.upkeep.files import Folder

NOW = datetime(2024, 5, 10, 5, 0)


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    """Curated readings moved into two days."""
    rows = src.curated(spark, sf_dir)
    moved = F.lit(datetime(2024, 5, 1)) + F.make_dt_interval(
        hours=F.pmod(F.xxhash64("event_id"), F.lit(48)).cast("int")
    )
    return curated.derive_columns(rows.withColumn("event_ts", moved)).cache()


def folders(path, names):
    for name in names:
        (path / name).mkdir(parents=True)
        (path / name / "part.parquet").write_text("")


def left(path):
    return sorted(p.name for p in path.iterdir())


def test_raw_retention(spark, tmp_path):
    """Two days back from 5 in the morning: the 8th began more than two days ago."""
    names = [f"ingest_date=2024-05-{d:02d}" for d in (6, 7, 8, 9, 10)]
    folders(tmp_path, names + ["ingest_date=oops", "other=2024-01-01", "_spark_metadata"])
    gone = retention.raw_retention(spark, str(tmp_path), NOW)
    assert gone == [date(2024, 5, 6), date(2024, 5, 7), date(2024, 5, 8)]
    assert left(tmp_path) == sorted(names[3:] + ["ingest_date=oops", "other=2024-01-01", "_spark_metadata"])


@pytest.mark.parametrize(("hour", "kept"), [(5, [9, 10]), (7, [10])])
def test_curated_retention(spark, tmp_path, hour, kept):
    """Six hours back from 5 in the morning is still the day before."""
    folders(tmp_path, [f"event_date=2024-05-{d:02d}/plant_id=a" for d in (8, 9, 10)])
    retention.curated_retention(spark, str(tmp_path), NOW.replace(hour=hour))
    assert left(tmp_path) == [f"event_date=2024-05-{d:02d}" for d in kept]


def test_kpi_retention(spark, tmp_path):
    folders(tmp_path, [f"window_date=2024-05-{d:02d}" for d in (2, 3, 4)])
    retention.kpi_retention(spark, str(tmp_path), NOW)
    assert left(tmp_path) == ["window_date=2024-05-03", "window_date=2024-05-04"]


def test_retention_of_nothing(spark, tmp_path):
    assert retention.raw_retention(spark, f"{tmp_path}/none", NOW) == []


def test_compaction(spark, table, tmp_path):
    path, by = f"{tmp_path}/t", ["event_date", "plant_id"]
    for i in range(3):
        write_batch(table.filter(F.pmod("kafka_offset", F.lit(3)) == i), i, path, by, "event_id")
    day = date(2024, 5, 1)
    files = len(list((tmp_path / "t").rglob("*.parquet")))
    merged = rewrite.compact(spark, path, CURATED_TABLE, "event_date", [day], by, "event_id")
    assert merged == 15  # three batches of five plants
    spark.catalog.refreshByPath(path)
    stored = tables.table_scan(spark, path, CURATED_TABLE)
    assert stored.count() == table.count()
    assert stored.exceptAll(table).count() == 0
    assert len(list((tmp_path / "t").rglob("*.parquet"))) < files
    assert Folder(spark, path).below("_staged").folders() == []
    # Five folders are left, one per plant; merging again is allowed.
    assert rewrite.compact(spark, path, CURATED_TABLE, "event_date", [day], by, "event_id") == 5


def interrupted(spark, monkeypatch, path, table, day):
    """A compaction that stops after its files and its list of old batches are written."""
    with monkeypatch.context() as patch:
        patch.setattr(rewrite, "_swap", lambda *args: None)
        rewrite.compact(spark, path, CURATED_TABLE, "event_date", [day], ["event_date"], "event_id")


def test_interrupted_compaction_is_finished(spark, table, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    for i in range(2):
        write_batch(table.filter(F.pmod("kafka_offset", F.lit(2)) == i), i, path, ["event_date"], "event_id")
    interrupted(spark, monkeypatch, path, table, date(2024, 5, 1))
    # A batch arrives between the interruption and its completion.
    late = table.limit(1).withColumn("event_id", F.lit("late"))
    write_batch(late, 7, path, ["event_date"], "event_id")
    # Some old folder may be gone already.
    Folder(spark, path).below("event_date=2024-05-01/batch_id=0").delete()
    assert rewrite.finish(spark, path) == 1
    spark.catalog.refreshByPath(path)
    stored = tables.table_scan(spark, path, CURATED_TABLE)
    assert stored.count() == table.count() + 1
    assert stored.exceptAll(table.union(late)).count() == 0
    assert rewrite.finish(spark, path) == 0


def test_unfinished_files_are_dropped(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    write_batch(table.limit(5), 0, path, ["event_date"], "event_id")
    write_batch(table.limit(5), -1, f"{path}/_staged/x", ["event_date"], "event_id")
    assert spark.read.parquet(path).count() == 5
    rewrite.finish(spark, path)
    assert not os.path.exists(f"{path}/_staged/x")
    assert spark.read.parquet(path).count() == 5


def test_rebuilt_windows_hold_late_readings(spark, table, tmp_path):
    curated_path, kpi_path = f"{tmp_path}/curated", f"{tmp_path}/kpis"
    write_batch(table, 0, curated_path, ["event_date", "plant_id"], "event_id")
    windows = kpis.window_kpis(table, 60).withColumn("window_date", F.to_date("window_start"))
    write_batch(windows, 0, kpi_path, ["window_date"], "plant_id")
    late = table.limit(20).withColumn("event_id", F.concat(F.lit("late"), "event_id"))
    write_batch(late, 1, curated_path, ["event_date", "plant_id"], "event_id")
    for _ in range(2):  # a second time changes nothing
        rewrite.rebuild_windows(
            spark, curated_path, CURATED_TABLE, kpi_path, 60, date(2024, 5, 1), date(2024, 5, 2)
        )
    spark.catalog.refreshByPath(kpi_path)
    found = tables.kpi_scan(spark, kpi_path)
    assert found.agg(F.sum("event_count")).first()[0] == table.count() + 20
    assert found.count() == found.dropDuplicates(["plant_id", "window_start"]).count()


def test_freshness(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    table.limit(3).coalesce(1).write.parquet(path)
    (file,) = (tmp_path / "t").glob("*.parquet")
    os.utime(file, (1_700_000_000, 1_700_000_000))
    spark.catalog.refreshByPath(path)
    layers = {"fresh": (path, 300), "stale": (path, 299), "absent": (f"{tmp_path}/no", 300)}
    now = F.timestamp_seconds(F.lit(1_700_000_299))
    rows = {r.layer: r for r in freshness.layer_freshness(spark, layers, now).collect()}
    assert {k: r.healthy for k, r in rows.items()} == {"fresh": True, "stale": False, "absent": False}
    assert rows["fresh"].age_seconds == 299 and rows["absent"].files == 0


def test_recent_files_and_census(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    for i in range(4):
        table.limit(i + 1).select("event_id").withColumn("day", F.lit(f"0{i}")).coalesce(
            1
        ).write.partitionBy("day").mode("append").parquet(path)
    for i, file in enumerate(sorted((tmp_path / "t").rglob("*.parquet"))):
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    hidden = tmp_path / "t" / "_temporary"
    hidden.mkdir()
    (hidden / "x.parquet").write_text("not a table")
    (tmp_path / "t" / "day=09").mkdir()
    (tmp_path / "t" / "day=09" / "broken.parquet").write_text("not a table")
    os.utime(tmp_path / "t" / "day=09" / "broken.parquet", (1_800_000_000, 1_800_000_000))
    schema = "event_id string, day string"
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.recent_files_scan(spark, path, schema, 3).collect()
    newest = tables.recent_files_scan(spark, path, schema, 3, skip_unreadable=True)
    assert sorted({r.day for r in newest.collect()}) == ["02", "03"]  # text, as declared
    assert newest.count() == 3 + 4
    assert tables.data_files(spark, path).count() == 5
    (tmp_path / "t" / "day=09" / "broken.parquet").unlink()
    spark.catalog.refreshByPath(path)
    census = tables.file_census({"t": tables.table_scan(spark, path, tables.schema_probe(spark, path))})
    assert tuple(census.first()) == ("t", 4, 10)


def test_text_bounds(spark):
    rows = spark.createDataFrame(
        [("2024-05-01 10:00:00", "2024-05-01 10:05:00"), ("soon", "later"), (None, None)],
        "window_start string, window_end string",
    )
    (row,) = tables.text_window_bounds(rows).collect()
    assert row.window_end - row.window_start == timedelta(minutes=5)


def test_days_without_readings_are_not_rebuilt(spark, table, tmp_path):
    curated_path, kpi_path = f"{tmp_path}/curated", f"{tmp_path}/kpis"
    windows = kpis.window_kpis(table, 60).withColumn("window_date", F.to_date("window_start"))
    write_batch(windows, 0, kpi_path, ["window_date"], "plant_id")
    newest = table.agg(F.max("event_date")).first()[0]
    write_batch(table.where(F.col("event_date") == newest), 0, curated_path, ["event_date", "plant_id"], "event_id")
    with pytest.raises(ValueError):
        rewrite.rebuild_windows(
            spark, curated_path, CURATED_TABLE, kpi_path, 60, date(1970, 1, 1), date(9999, 12, 31)
        )
    assert tables.kpi_scan(spark, kpi_path).count() == windows.count()

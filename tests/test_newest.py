"""Newest rows and recent windows of a table by date: exact, and every scan under a date filter."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from penstock.operators import insight
from penstock.sources import newest, tables

START = datetime(2024, 3, 1)
SCHEMA = (
    T.StructType()
    .add("event_id", "string")
    .add("event_ts", "timestamp")
    .add("plant_id", "string")
    .add("power_mw", "double")
    .add("is_anomaly", "boolean")
    .add("event_date", "date")
)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Forty days of ten readings; many share the last time of a day, few are anomalies."""
    rows = []
    for day in range(40):
        for i in range(10):
            ts = START + timedelta(days=day, hours=23 if i > 5 else i)
            rows.append((f"e{day:02d}{i}", ts, f"p{i % 2}", float(i), day % 9 == 0 and i == 3, ts.date()))
    path = str(tmp_path_factory.mktemp("newest") / "curated")
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("event_date").parquet(path)
    return path, rows


def dates_read(df):
    """The dates that each scan of the plan may read, from the filters in it."""
    text = df._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    assert found and all("event_date" in f for f in found), text
    return found


@pytest.mark.parametrize("n", [1, 4, 7, 10, 11, 35, 399])
def test_last_n(spark, table, n):
    path, rows = table
    part = newest.newest_rows(spark, path, SCHEMA, n)
    found = insight.last_n_by_time(part, n)
    expected = sorted(rows, key=lambda r: (-r[1].timestamp(), r[0]))[:n]
    assert sorted(r.event_id for r in found.collect()) == sorted(r[0] for r in expected)
    first = newest.date_holding(spark, path, SCHEMA, n)
    assert first == (START + timedelta(days=39 - (n - 1) // 10)).date()
    assert all(str(first) in f for f in dates_read(found))


def test_more_than_there_are(spark, table):
    path, rows = table
    assert newest.date_holding(spark, path, SCHEMA, 401) is None
    assert insight.last_n_by_time(newest.newest_rows(spark, path, SCHEMA, 401), 401).count() == 400


@pytest.mark.parametrize("n", [1, 3, 5])
def test_newest_anomalies(spark, table, n):
    path, rows = table
    part = newest.newest_rows(spark, path, SCHEMA, n, F.col("is_anomaly"))
    found = insight.top_recent_anomalies(part, n)
    expected = sorted((r for r in rows if r[4]), key=lambda r: (-r[1].timestamp(), r[0]))[:n]
    assert found.count() == len(expected) == n
    assert all(str(expected[-1][5]) in f for f in dates_read(found))


@pytest.mark.parametrize("minutes, count", [(0, 4), (15, 4), (60 * 24, 14), (60 * 24 * 3, 34)])
def test_recent_window(spark, table, minutes, count):
    path, _ = table
    found = insight.recent_window(newest.recent_days(spark, path, SCHEMA, minutes), minutes)
    assert found.count() == count
    earliest = (START + timedelta(days=39 - -(-minutes // 1440))).date()
    assert all(str(earliest) in f or "Subquery" in f for f in dates_read(found))
    assert str(earliest) in "".join(dates_read(found))


def test_an_empty_newest_date_is_passed_over(spark, table, tmp_path):
    path, rows = table
    copy = str(tmp_path / "curated")
    data = spark.createDataFrame(rows, SCHEMA).filter("event_date < '2024-03-04'")
    data.write.partitionBy("event_date").parquet(copy)
    spark.createDataFrame([], SCHEMA).drop("event_date").write.parquet(f"{copy}/event_date=2024-03-09")
    assert newest.newest_date(spark, copy).isoformat() == "2024-03-09"
    assert newest.date_holding(spark, copy, SCHEMA, 1).isoformat() == "2024-03-03"
    when = tables.table_scan(spark, copy, SCHEMA).select(newest.newest_time(spark, copy, SCHEMA).alias("t"))
    assert when.first().t == datetime(2024, 3, 3, 23)


def test_recent_or_last_chooses_when_read(spark, table):
    path, rows = table
    whole, part = tables.table_scan(spark, path, SCHEMA), newest.newest_rows(spark, path, SCHEMA, 12)
    last = START + timedelta(days=39, hours=23)
    assert insight.recent_or_last(whole, last, 15, 12, part).count() == 4
    assert insight.recent_or_last(whole, last + timedelta(days=5), 15, 12, part).count() == 12
    text = insight.recent_or_last(whole, last, 15, 12, part)._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: []") == 0


def test_fallback_has_one_schema(spark, table):
    path, _ = table
    curated = tables.table_scan(spark, path, SCHEMA).withColumn("efficiency", F.lit(0.9))
    kpis = curated.select("plant_id", F.col("event_ts").alias("window_start"), F.lit(1.5).alias("power_avg_mw"))
    now = START + timedelta(days=39, hours=23)
    filled, empty = (insight.source_fallback(k, curated, now) for k in (kpis, kpis.limit(0)))
    assert filled.schema == empty.schema
    assert {r.source for r in filled.collect()} == {"kpis"} and filled.count() == 400
    assert {(r.source, r.plant_id) for r in empty.collect()} == {("curated", "p0"), ("curated", "p1")}

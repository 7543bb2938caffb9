"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import pathlib
import re

import pytest

from penstock.model import CURATED_TABLE
from penstock.operators import enrich, insight, kpis
from penstock.operators.curated import quality_filter
from penstock.plans import registry
from penstock.session import small_side
from penstock.sources import readings as src
from penstock.sources import tables
from penstock.streaming.sinks import write_batch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layers") / "curated")
    write_batch(src.curated(spark, sf_dir), 0, path, ["event_date"], "event_id")
    return tables.table_scan(spark, path, CURATED_TABLE)


def test_partitions_are_pruned_and_columns_narrowed(stored):
    day = stored.filter("event_date = DATE'2024-01-05' AND power_mw > 10")
    text = plan(day.select("event_id"))
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date#\d+\), \(event_date#\d+ = 2024-01-05\)", text)
    assert "GreaterThan(power_mw,10.0)" in text
    assert "ReadSchema: struct<event_id:string,power_mw:double>" in text


def test_quality_filter_reaches_the_scan(stored):
    text = plan(quality_filter(stored).select("event_id"))
    assert "IsNotNull(event_id)" in text and "GreaterThanOrEqual(power_mw,0.0)" in text


def test_series_reads_three_columns(stored):
    text = plan(insight.minute_series(stored, 15))
    reads = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert max(len(read.split(",")) for read in reads) == 3


def test_recent_window_prunes_dates_by_the_cutoff(stored):
    text = plan(insight.recent_window(stored, 15))
    assert re.search(r"PartitionFilters: \[.*event_date#\d+ >= .*Subquery", text)


def test_known_small_dimension_is_broadcast_without_hint(spark, stored):
    slim = stored.select("event_id", "plant_id")
    text = plan(enrich.enrich_with_plant(slim, src.adapter_plants(spark)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_dimension_is_not_broadcast(spark, stored):
    slim = stored.select("event_id", "plant_id")
    plants = src.adapter_plants(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(enrich.enrich_with_plant(slim, plants))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_side_is_counted_first(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    few = small_side(spark.range(10).withColumnRenamed("id", "k"), most_rows=10)
    many = small_side(spark.range(11).withColumnRenamed("id", "k"), most_rows=10)
    assert "ResolvedHint (strategy=broadcast)" in few._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in many._jdf.queryExecution().analyzed().toString()
    assert (big.join(few, "k").count(), big.join(many, "k").count()) == (10, 11)


def test_kpis_shuffle_once(stored):
    assert plan(kpis.window_kpis(stored, 5)).count("Exchange hashpartitioning") == 1


def test_latest_state_needs_no_sort(stored):
    text = plan(insight.latest_per_plant(kpis.window_kpis(stored, 60), ["power_avg_mw"]))
    assert "Sort" not in text.replace("SortAggregate", "!") and "!" not in text


QUERIES = registry.queries()
STREAMS = [n for n in QUERIES if n.startswith("stream_")]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(STREAMS)))
def test_no_cross_joins_and_no_python_rows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


@pytest.fixture
def many_files(spark, tmp_path, monkeypatch):
    """Events in several files, and a session that cuts them into small pieces."""
    monkeypatch.setattr(registry, "scratch_path", lambda _, label: f"{tmp_path}/{label}")
    rows = spark.range(3000).selectExpr(
        "id AS event_id",
        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, id * 2) AS ts",
        "id % 7 AS user_id",
        "CASE id % 3 WHEN 0 THEN 'error' WHEN 1 THEN 'view' ELSE 'signup' END AS event_type",
        "CAST(id % 90 AS DOUBLE) AS value",
    )
    rows.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    small = {"spark.sql.files.maxPartitionBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield str(tmp_path)
    for key, value in before.items():
        spark.conf.set(key, value)


def test_readings_of_kpi_streams_are_written_by_many_tasks(spark, many_files):
    found = registry.queries()["stream_window_kpis_1h"](spark, many_files)
    wanted = registry.queries()["window_kpis_1h"](spark, many_files)
    last = wanted.agg({"window_end": "max"}).first()[0]
    counted = wanted.where(wanted["window_end"] < last).select("plant_id", "window_start", "event_count")
    assert sorted(found.select(*counted.columns).collect()) == sorted(counted.collect())
    assert len(list(pathlib.Path(many_files, "partials", "readings").glob("*.parquet"))) > 16


def test_log_of_the_curated_stream_is_cut_by_size(spark, many_files):
    found = registry.queries()["stream_curated"](spark, many_files).select("event_id", "kafka_offset").collect()
    wanted = registry.queries()["curated_from_json"](spark, many_files).select("event_id", "kafka_offset").collect()
    assert sorted(found) == sorted(wanted)
    assert len(list(pathlib.Path(many_files, "curated", "log").glob("*.parquet"))) > 8

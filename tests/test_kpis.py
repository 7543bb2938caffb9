"""Window KPIs: edges, merging, latest state."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from penstock.model import KPI_TABLE
from penstock.operators import insight, kpis
from penstock.sources import readings as src

START = datetime(2024, 5, 1, 10)


@pytest.fixture(scope="module")
def curated(spark, sf_dir):
    return src.curated(spark, sf_dir).cache()


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-9, abs=1e-9)
    return a == b


def same(left, right, keys):
    a = {tuple(r[k] for k in keys): r for r in left.collect()}
    b = {tuple(r[k] for k in keys): r for r in right.collect()}
    assert a.keys() == b.keys() and a
    for key, row in a.items():
        other = b[key]
        wrong = [c for c in left.columns if not close(row[c], other[c])]
        assert not wrong, (key, {c: (row[c], other[c]) for c in wrong})


def test_schema(curated):
    built = kpis.window_kpis(curated, 5).schema
    assert [(f.name, f.dataType) for f in built] == [(f.name, f.dataType) for f in KPI_TABLE]


def test_window_edge_and_single_reading(curated):
    row = curated.limit(1)
    edge = row.withColumn("event_ts", F.lit(START + timedelta(minutes=5)))
    inside = row.withColumn("event_ts", F.lit(START + timedelta(minutes=4, seconds=59)))
    found = kpis.window_kpis(edge.union(inside), 5).orderBy("window_start").collect()
    assert [r.window_start for r in found] == [START, START + timedelta(minutes=5)]
    assert [r.event_count for r in found] == [1, 1]
    assert [r.power_stddev_mw for r in found] == [None, None]


def test_empty_input_gives_the_schema(curated):
    empty = kpis.window_kpis(curated.limit(0), 5)
    assert empty.count() == 0 and empty.schema.names == KPI_TABLE.names


@pytest.mark.parametrize("minutes", [5, 60])
def test_merged_parts_equal_one_pass(curated, minutes):
    """Partial KPIs of three arbitrary parts of the readings."""
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    partials = None
    for i in range(3):
        one = kpis.partial_kpis(curated.filter(part == i), 5)
        partials = one if partials is None else partials.unionByName(one)
    same(
        kpis.merge_kpis(partials, minutes),
        kpis.window_kpis(curated, minutes),
        ["plant_id", "window_start"],
    )


def test_equal_readings_have_no_spread(curated):
    row = curated.limit(1).withColumn("power_mw", F.lit(5678.91)).withColumn("event_ts", F.lit(START))
    again = row.withColumn("event_ts", F.lit(START + timedelta(minutes=30)))
    merged = kpis.merge_kpis(kpis.partial_kpis(row.union(again).union(again), 5), 60)
    assert merged.first().power_stddev_mw == 0.0


def test_aggregation_is_combined_before_the_shuffle(curated, spark, sf_dir):
    plan = kpis.window_kpis(src.curated(spark, sf_dir), 5)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert text.index("partial_count") > text.index("Exchange")


def test_latest_takes_an_older_value_where_the_newest_is_null(spark):
    rows = [("a", START, 1.0), ("a", START + timedelta(hours=1), None), ("b", START, None)]
    table = spark.createDataFrame(rows, "plant_id string, window_start timestamp, oee_avg double")
    found = {r.plant_id: r.oee_avg for r in insight.latest_per_plant(table, ["oee_avg"]).collect()}
    assert found == {"a": 1.0, "b": None}


def test_latest_equals_ranking(curated):
    table = kpis.window_kpis(curated, 60)
    ranked = table.withColumn(
        "rn", F.expr("row_number() OVER (PARTITION BY plant_id ORDER BY window_start DESC)")
    )
    same(
        insight.latest_per_plant(table, ["event_count", "power_avg_mw"]),
        ranked.filter("rn = 1").select("plant_id", "event_count", "power_avg_mw"),
        ["plant_id"],
    )


def test_snapshot_needs_its_columns(curated):
    assert insight.silver_snapshot(curated.drop("efficiency"), START).count() == 0


def test_snapshot_without_optional_columns(curated):
    slim = curated.select("event_id", "event_ts", "power_mw", "plant_id", "efficiency")
    row = insight.silver_snapshot(slim, START).first()
    assert row.oee_avg == 0.0 and row.anomaly_count == 0 and row.energy_mwh == 0.0


def test_snapshot_clock(curated):
    newest = curated.agg(F.max("event_ts")).first()[0]
    recent = insight.recent_or_last(curated, newest + timedelta(minutes=15))
    assert recent.count() == curated.filter(F.col("event_ts") >= newest).count()
    assert insight.recent_or_last(curated, newest + timedelta(days=9), n=10).count() == 10


def test_source_fallback(curated):
    table = kpis.window_kpis(curated, 5)
    assert insight.source_fallback(table, curated, START).first().source == "kpis"
    assert insight.source_fallback(table.limit(0), curated, START).first().source == "curated"


def test_table_view_is_safe_to_show(spark):
    rows = [(START, "a", float("nan"), 7.0, float("nan")), (START, "b", None, -1.0, None)]
    table = spark.createDataFrame(
        rows,
        "window_start timestamp, plant_id string, health_score double, oee_avg double,"
        " critical_rate_pct double",
    )
    shown = insight.kpi_table_view(table).orderBy("plant_id").collect()
    assert [r.health_score for r in shown] == [0.0, 0.0]
    assert [r.oee_avg for r in shown] == [1.0, 0.0]
    assert [r.critical_rate_pct for r in shown] == [0.0, 0.0]
    assert shown[0].window_start == "10:00 01/05"


def test_regression_needs_two_windows(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "rain_avg_mm_h double, power_avg_mw double")
    assert insight.rain_power_regression(one).first().slope is None
    two = one.union(spark.createDataFrame([(3.0, 8.0)], one.schema))
    fit = insight.rain_power_regression(two)
    line = insight.trend_line(fit).orderBy("point").collect()
    assert len(line) == 50
    assert (line[0].power_mw, line[-1].power_mw) == (pytest.approx(2.0), pytest.approx(8.0))


def test_recent_window_prunes_and_uses_no_join(curated, spark, sf_dir):
    plan = insight.recent_window(src.curated(spark, sf_dir).drop("event_date"))._jdf
    text = plan.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "Subquery" in text


def test_top_anomalies_do_not_sort_the_table(spark, sf_dir):
    top = insight.top_recent_anomalies(src.curated(spark, sf_dir))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()

"""Work in blocks against one window per plant, also where one plant holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from penstock.operators import distribution, history, prefix

START = datetime(2024, 5, 1)
SCHEMA = (
    "plant_id string, event_ts timestamp, event_id string, status string, energy_mwh double,"
    " power_mw double"
)


def made_up(seed, count, plants=("a", "a", "a", "b", "c")):
    pick = random.Random(seed)
    rows = []
    for i in range(count):
        resting = pick.random() < 0.4
        rows.append(
            (
                pick.choice(plants),
                START + timedelta(seconds=pick.randrange(count)),  # some times are equal
                f"e{i:05d}",
                "MANUTENCAO" if resting else "OPERANDO",
                float(pick.randrange(100)),
                0.0 if resting else float(pick.randrange(50)),
            )
        )
    return rows


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(made_up(7, 3000), SCHEMA).cache()


def episodes_by_hand(rows):
    found = []
    for plant in sorted({r[0] for r in rows}):
        line = sorted((r[1], r[2], r[3]) for r in rows if r[0] == plant)
        open_ = None
        for ts, _, status in line:
            if status == "MANUTENCAO":
                open_ = open_ or [plant, ts, ts, None, 0]
                open_[2] = ts
                open_[4] += 1
            elif open_:
                found.append(tuple(open_[:3] + [ts] + open_[4:]))
                open_ = None
        if open_:
            found.append(tuple(open_))
    return sorted(found, key=str)


def collected(episodes):
    columns = ["plant_id", "start_ts", "end_ts", "resumed_ts", "readings"]
    return sorted((tuple(r) for r in episodes.select(*columns).collect()), key=str)


@pytest.mark.parametrize("seconds", [60, 300, 86_400])
def test_running_energy(readings, seconds):
    line = Window.partitionBy("plant_id").orderBy("event_ts", "event_id")
    plain = readings.withColumn(
        "expected", F.sum("energy_mwh").over(line.rowsBetween(Window.unboundedPreceding, 0))
    )
    both = history.running_energy(readings, seconds=seconds).join(
        plain.select("event_id", "expected"), "event_id"
    )
    assert both.count() == 3000
    assert both.filter("cumulative_energy_mwh <> expected").count() == 0


def test_rows_without_key_or_time_are_totalled_too(spark):
    rows = [(None, START, "b", 1.0), (None, None, "a", 2.0), (None, START + timedelta(days=9), "c", 4.0), ("p", START, "d", 8.0)]
    df = spark.createDataFrame(rows, "plant_id string, event_ts timestamp, event_id string, energy_mwh double")
    found = {r.event_id: r.cumulative_energy_mwh for r in history.running_energy(df).collect()}
    assert found == {"a": 2.0, "b": 3.0, "c": 7.0, "d": 8.0}


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """Three days, one plant with nine in ten rows; the readings stored by day."""
    pick = random.Random(5)
    rows = [
        (
            "big" if i % 10 else "small",
            START + timedelta(seconds=86_400 * 3 * i // 4000),
            f"e{i:05d}",
            "MANUTENCAO" if pick.random() < 0.3 else "OPERANDO",
            float(pick.randrange(9)),
            float(pick.randrange(50)),
        )
        for i in range(4000)
    ]
    path = str(tmp_path_factory.mktemp("history"))
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"installed_mw": F.lit(60.0), "event_date": F.to_date("event_ts")}
    )
    df.write.partitionBy("event_date").parquet(f"{path}/readings")
    return spark.read.parquet(f"{path}/readings"), f"{path}/sums"


def test_a_day_is_appended_with_the_stored_sums(spark, days):
    """Day by day, with one day repeated after late rows; each day reads itself and the sums only."""
    readings, path = days
    whole = {
        "energy": history.running_energy(readings),
        "oee": history.running_oee(readings).drop("power_mw", "installed_mw", "status"),
    }
    expected = {name: {tuple(r) for r in df.collect()} for name, df in whole.items()}
    found = {"energy": set(), "oee": set()}
    for n in range(3):
        date = (START + timedelta(days=n)).date()
        day = readings.filter(F.col("event_date") == date)
        if n == 1:
            history.store_history(day.limit(50), path)
        history.store_history(day, path)
        sums = history.stored_history(spark, path, F.lit(date))
        running = history.running_energy(day, sums)
        text = running._jdf.queryExecution().executedPlan().toString()
        filters = [line for line in text.splitlines() if "PartitionFilters" in line]
        assert filters and all(str(date) in line for line in filters)
        found["energy"] |= {tuple(r) for r in running.collect()}
        oee = history.running_oee(day, sums).drop("power_mw", "installed_mw", "status")
        found["oee"] |= {tuple(r) for r in oee.collect()}
    assert found == expected


def test_a_large_plant_is_worked_on_in_many_tasks(spark, days):
    readings, _ = days
    placed = prefix.bucketed(readings.filter("plant_id = 'big'"))
    assert max(r["count"] for r in placed.groupBy("bucket").count().collect()) < 20
    assert placed.select("bucket").distinct().count() > 800


def test_history_keeps_no_scratch(spark, days):
    """No sample and no checkpoint: the whole plan is there, down to the tables."""
    readings, _ = days
    for df in (history.running_energy(readings), history.maintenance_episodes(readings)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in text and "ExistingRDD" not in text and "CartesianProduct" not in text


def test_availability(readings):
    last = history.running_availability(readings, seconds=900).groupBy("plant_id").agg(
        F.max("total_readings").alias("total"), F.max("available_readings").alias("available")
    )
    expected = readings.groupBy("plant_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") != "MANUTENCAO").alias("available")
    )
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("seconds", [1, 10, 3600])
def test_episodes(spark, seed, seconds):
    rows = made_up(seed, 200)
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(history.maintenance_episodes(df, seconds)) == episodes_by_hand(rows)


def test_episodes_over_years(spark):
    """All levels take part: hours, days, months and decades apart, before and after 1970."""
    pick = random.Random(9)
    rows = []
    for i in range(400):
        hours = pick.choice([1, 30, 24 * 50, 24 * 365 * 7]) * pick.randrange(1, 8)
        ts = datetime(1960, 1, 1) + timedelta(hours=hours, seconds=i)
        rows.append((pick.choice("ab"), ts, f"e{i:05d}", pick.choice(["MANUTENCAO", "OPERANDO"]), 0.0, 0.0))
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(history.maintenance_episodes(df)) == episodes_by_hand(rows)


def test_runs_merge_in_any_grouping(spark):
    rows = made_up(3, 300, plants=("a",))
    runs = history.bucket_runs(spark.createDataFrame(rows, SCHEMA), 5)
    for fans in ((None,), (2, None), (3, 5, None), (100, None)):
        merged = runs
        for fan in fans:
            merged = history.merge_runs(merged, fan)
            borders = merged.filter("first or last").groupBy("plant_id", "unit").count()
            assert borders.filter("count > 2").isEmpty()
        found = merged.filter("maintenance").withColumn("resumed_ts", F.col("next_ts"))
        assert collected(found) == episodes_by_hand(rows)


@pytest.mark.parametrize("status", ["MANUTENCAO", "OPERANDO"])
def test_one_status_throughout(spark, status):
    rows = [("a", START + timedelta(seconds=i), f"e{i}", status, 1.0, 1.0) for i in range(30)]
    found = collected(history.maintenance_episodes(spark.createDataFrame(rows, SCHEMA), 5))
    assert found == episodes_by_hand(rows)


def test_episodes_by_day_join_over_midnight(spark):
    rows = [
        ("a", START + timedelta(hours=h), f"e{h:03d}", "MANUTENCAO" if 20 <= h < 60 else "OPERANDO", 1.0, 1.0)
        for h in range(72)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    runs = None
    for day in range(3):
        one = df.filter(F.to_date("event_ts") == (START + timedelta(days=day)).date())
        part = history.day_runs(one)
        runs = part if runs is None else runs.unionByName(part)
    assert collected(history.join_runs(runs)) == episodes_by_hand(rows)


def test_seconds_are_cut_at_the_hour(spark):
    times = [0, 3000, 5400, 9000]
    statuses = ["OPERANDO", "MANUTENCAO", "MANUTENCAO", "OPERANDO"]
    rows = [
        ("a", START + timedelta(seconds=t), f"e{i}", s, 1.0, 1.0)
        for i, (t, s) in enumerate(zip(times, statuses))
    ]
    episodes = history.maintenance_episodes(spark.createDataFrame(rows, SCHEMA))
    found = history.maintenance_seconds(episodes).orderBy("window_start").collect()
    assert [r.maintenance_seconds for r in found] == [600.0, 3600.0, 1800.0]


def quantile(values, share, method):
    n = len(values)
    place = share * (n - 1) if method == "linear" else max(0.0, min(n * share - 0.5, n - 1))
    low = int(place)
    high = min(low + 1, n - 1) if place > low else low
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("method", ["linear", "midpoint"])
@pytest.mark.parametrize("count", [1, 2, 5, 400])
def test_distribution(spark, method, count):
    """Two in five values are the same 0, as of a plant at rest."""
    rows = made_up(count, count)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.plant_id: r for r in distribution.power_distribution(df, method=method).collect()}
    assert set(found) == {r[0] for r in rows}
    for plant, row in found.items():
        values = sorted(r[5] for r in rows if r[0] == plant)
        q1, q2, q3 = (quantile(values, s, method) for s in (0.25, 0.5, 0.75))
        assert (row.q1, row.median, row.q3, row.n) == (
            pytest.approx(q1),
            pytest.approx(q2),
            pytest.approx(q3),
            len(values),
        )
        inside = [v for v in values if row.lower_fence <= v <= row.upper_fence]
        assert (row.whisker_low, row.whisker_high) == (min(inside), max(inside))
        assert row.outliers == len(values) - len(inside)


def test_outliers(spark):
    rows = [("a", START, f"e{i}", "OPERANDO", 1.0, float(i % 10)) for i in range(100)]
    rows += [("a", START, "far", "OPERANDO", 1.0, 500.0), ("b", START, "b", "OPERANDO", 1.0, 3.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.event_id for r in distribution.power_outliers(df).collect()] == ["far"]


@pytest.mark.parametrize("cells", [2, 7, 4096])
def test_selection_by_counting(spark, cells):
    """Few cells, so that both rounds and the last order have work; values far apart and a null key."""
    pick = random.Random(cells)
    rows = []
    for key in ("a", "b", None):
        rows += [(key, pick.choice([pick.gauss(0, 1), pick.gauss(0, 1) * 1e6, 5.0, -0.0])) for _ in range(301)]
    rows += [("one", 3.5), ("a", None), ("none", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "plant_id string, power_mw double")
    shares = {"low": 0.0, "q": 0.3, "median": 0.5, "high": 1.0}
    found = {r.plant_id: r for r in distribution.exact_quantiles(df, "plant_id", "power_mw", shares, cells=cells).collect()}
    assert set(found) == {"a", "b", None, "one"}
    for key, row in found.items():
        values = sorted(v for k, v in rows if k == key and v is not None and v == v)
        assert row.n == len(values)
        for name, share in shares.items():
            assert row[name] == pytest.approx(quantile(values, share, "linear")), (key, name)


def test_distribution_reads_once_and_keeps_no_scratch(spark, days):
    readings, _ = days
    found = distribution.power_distribution(readings)
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "rangepartitioning" not in text and "ExistingRDD" not in text
    assert len([line for line in text.splitlines() if "FileScan" in line]) == 1, text


def test_sketch_error_and_merge(spark):
    """Daily sketches of values over ten decades, with negative ones and zeros, merged in any order."""
    pick = random.Random(8)
    rows = [
        (pick.choice("ab"), day, pick.choice([0.0, pick.lognormvariate(0, 4), -pick.lognormvariate(2, 3), 7.0]))
        for day in range(6)
        for _ in range(500)
    ]
    df = spark.createDataFrame(rows, "plant_id string, day int, power_mw double")
    parts = [distribution.quantile_sketch(df.filter(F.col("day") == d), "plant_id", "power_mw") for d in (3, 1, 5, 0, 2, 4)]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    merged = distribution.merge_sketches(stacked, "plant_id")
    whole = distribution.quantile_sketch(df, "plant_id", "power_mw")
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    shares = {f"p{k}": k / 100 for k in range(0, 101, 5)}
    for row in distribution.sketched_quantiles(merged, "plant_id", shares).collect():
        values = sorted(r[2] for r in rows if r[0] == row.plant_id)
        assert row.n == len(values)
        for name, share in shares.items():
            true = values[int(share * (len(values) - 1))]
            assert abs(row[name] - true) <= distribution.ERROR * abs(true) * 1.0001, (name, row[name], true)

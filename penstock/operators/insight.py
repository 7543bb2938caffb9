"""Operational questions over the curated and KPI tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penstock.functions.alerts import graded
from penstock.functions.numbers import (
    clamp,
    is_true,
    number_or_zero,
    settled_round,
    unit_interval,
)
from penstock.model import ATTENTION, CRITICAL, MAINTENANCE, NORMAL
from penstock.settings import LIMITS

# --- Fixed values ---
SERIES_MINUTES = 15
SNAPSHOT_ROWS = 5000
SNAPSHOT_MINUTES = 5
TOP_ANOMALIES = 30
TABLE_ROWS = 200
TREND_POINTS = 50
PALETTE_SIZE = 5
ANOMALY_COLUMNS = [
    "event_ts",
    "plant_id",
    "anomaly_kind",
    "alert_level",
    "power_mw",
    "efficiency",
    "turbine_temp_c",
    "vibration_mm_s",
]
KPI_VIEW_COLUMNS = [
    "window_start",
    "plant_id",
    "event_count",
    "power_avg_mw",
    "power_max_mw",
    "efficiency_avg",
    "oee_avg",
    "heat_rate_avg",
    "wear_avg",
    "energy_mwh",
    "anomaly_count",
    "critical_rate_pct",
    "health_score",
    "temperature_max_c",
    "vibration_max_mm_s",
    "flow_avg_m3_s",
    "rain_avg_mm_h",
]
# --- end of fixed values ---


# Recent windows ---------------------------------------------------------------------------------


def recent_window(readings: DataFrame, minutes: int = SERIES_MINUTES) -> DataFrame:
    """Readings of the last minutes of the data itself, both ends included.

    The newest time is a scalar subquery; no join. A table partitioned by event_date is also
    pruned by date.
    """
    cutoff = readings.agg(F.max("event_ts") - F.expr(f"INTERVAL {minutes} MINUTES")).scalar()
    recent = readings.filter(F.col("event_ts") >= cutoff)
    if "event_date" in readings.columns:
        recent = recent.filter(F.col("event_date") >= cutoff.cast("date"))
    return recent


def recent_window_summary(readings: DataFrame, minutes: int = SERIES_MINUTES) -> DataFrame:
    return recent_window(readings, minutes).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("plant_id").alias("plant_count"),
        (F.max("event_ts") - F.expr(f"INTERVAL {minutes} MINUTES")).alias("window_start"),
        F.max("event_ts").alias("anchor_ts"),
    )


def last_n_by_time(readings: DataFrame, n: int = SNAPSHOT_ROWS) -> DataFrame:
    return readings.orderBy(F.col("event_ts").desc_nulls_last(), "event_id").limit(n)


def recent_or_last(
    readings: DataFrame,
    now: datetime | Column,
    minutes: int = SERIES_MINUTES,
    n: int = SNAPSHOT_ROWS,
    newest: DataFrame | None = None,
) -> DataFrame:
    """Readings of the last minutes before `now`, or the newest n when there are none.

    Which of the two is settled when the result is read, by a scalar subquery over the recent part.
    `newest` may name a part of the table that holds its n newest rows (`sources.newest`), so that
    the other branch need not look at all of them."""
    cutoff = F.lit(now) - F.expr(f"INTERVAL {minutes} MINUTES")
    recent = readings.filter(F.col("event_ts") >= cutoff)
    if "event_date" in readings.columns:
        recent = recent.filter(F.col("event_date") >= cutoff.cast("date"))
    none = recent.agg(F.count(F.lit(1))).scalar() == 0
    source = readings if newest is None else newest
    # Inside the sort, so that nothing is sorted when there are recent readings.
    return recent.unionByName(last_n_by_time(source.filter(none), n))


def minute_series(readings: DataFrame, minutes: int = SERIES_MINUTES) -> DataFrame:
    per_minute = (
        recent_window(readings, minutes)
        .groupBy(F.date_trunc("minute", "event_ts").alias("minute"), "plant_id")
        .agg(
            F.avg("power_mw").alias("power_avg_mw"),
            F.max("power_mw").alias("power_max_mw"),
            F.count("power_mw").alias("event_count"),
        )
    )
    return per_minute.orderBy("plant_id", "minute")


# Latest state -----------------------------------------------------------------------------------


def latest_per_plant(kpis: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per plant, the newest value of each column that is not null.

    One pass with max_by per column, combined before the shuffle; a null ordering value keeps a
    null out of the running. KPI tables hold one row per plant and window, so there are no ties.
    """
    wanted = columns or [c for c in kpis.columns if c != "plant_id"]
    return kpis.groupBy("plant_id").agg(*[_latest(c).alias(c) for c in wanted])


def _latest(name: str) -> Column:
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("window_start")))


def fleet_kpis(kpis: DataFrame) -> DataFrame:
    """Fleet totals of the newest window of each plant, and the energy of all windows."""
    latest = ["power_avg_mw", "oee_avg", "health_score", "flow_avg_m3_s"]
    counts = ["anomaly_count", "critical_count"]
    per_plant = kpis.groupBy("plant_id").agg(
        *[_latest(c).alias(c) for c in latest + counts], F.sum("energy_mwh").alias("energy_mwh")
    )
    return per_plant.agg(
        F.sum("power_avg_mw").alias("power_mw"),
        F.sum("energy_mwh").alias("energy_mwh"),
        F.avg("oee_avg").alias("oee"),
        F.avg("health_score").alias("health_score"),
        F.avg("flow_avg_m3_s").alias("flow_m3_s"),
        *[F.sum(c).alias(c) for c in counts],
    )


def alert_totals_per_plant(kpis: DataFrame) -> DataFrame:
    """Anomalies, critical and maintenance readings of the newest window, one row each."""
    counts = ["anomaly_count", "critical_count", "maintenance_count"]
    latest = latest_per_plant(kpis, counts)
    return latest.unpivot("plant_id", counts, "kind", "readings")


def health_board(kpis: DataFrame) -> DataFrame:
    """Value, reference, distance from it and band of each metric of each plant."""
    # Metric, column, factor, reference, limits of the bands
    high_wear = [(LIMITS.wear_critical, CRITICAL), (0.35, ATTENTION)]
    high_temp = [
        (LIMITS.temperature_critical_c, CRITICAL),
        (LIMITS.temperature_attention_c, ATTENTION),
    ]
    metrics = [
        ("capacity_pct", "capacity_factor_avg", 100.0, 80.0, None),
        ("oee_pct", "oee_avg", 100.0, 70.0, None),
        ("efficiency_pct", "efficiency_avg", 100.0, 88.0, None),
        ("wear", "wear_avg", 1.0, LIMITS.wear_critical, high_wear),
        ("temperature_c", "temperature_max_c", 1.0, LIMITS.temperature_critical_c, high_temp),
        ("heat_rate_kj_kwh", "heat_rate_avg", 1.0, float(round(3600 / 0.93)), None),
        ("vibration_mm_s", "vibration_max_mm_s", 1.0, 5.0, None),
        ("flow_m3_s", "flow_avg_m3_s", 1.0, None, None),
        ("rain_mm_h", "rain_avg_mm_h", 1.0, None, None),
    ]
    latest = latest_per_plant(kpis, [column for _, column, _, _, _ in metrics])

    def entry(metric, column, factor, reference, steps):
        value = F.coalesce(F.col(column), F.lit(0.0)) * factor
        if metric == "capacity_pct":
            band = graded(value, [(75.0, NORMAL), (50.0, ATTENTION)], CRITICAL)
        else:
            band = graded(value, steps, NORMAL) if steps else F.lit(None).cast("string")
        target = F.lit(reference).cast("double")
        return F.struct(
            F.lit(metric).alias("metric"),
            value.alias("value"),
            target.alias("reference"),
            (value - target).alias("distance"),
            band.alias("band"),
        )

    return latest.select("plant_id", F.inline(F.array(*[entry(*m) for m in metrics])))


def silver_snapshot(
    readings: DataFrame,
    now: datetime | Column,
    compat: bool = False,
    n: int = SNAPSHOT_ROWS,
    newest: DataFrame | None = None,
) -> DataFrame:
    """KPIs per plant straight from the curated table, while no KPI table exists yet; `newest` as in
    `recent_or_last`.

    `compat=True` keeps what older readers got: means in the columns named max and energy, and 0
    for critical and maintenance readings.
    """
    needed = {"event_ts", "power_mw", "plant_id", "efficiency"}
    if not needed.issubset(readings.columns):
        return readings.limit(0).select()
    have = set(readings.columns)

    def of(aggregate, column):
        return aggregate(column) if column in have else F.lit(0.0)

    def counted(column, predicate):
        return F.count_if(predicate) if column in have else F.lit(0).cast("bigint")

    peak = F.avg if compat else F.max
    total = F.avg if compat else F.sum
    none = F.lit(0).cast("bigint")
    recent = recent_or_last(readings, now, n=n, newest=newest)
    grouped = recent.groupBy("plant_id").agg(
        F.avg("power_mw").alias("power_avg_mw"),
        F.max("power_mw").alias("power_max_mw"),
        F.avg("efficiency").alias("efficiency_avg"),
        F.count("power_mw").alias("event_count"),
        of(F.avg, "oee").alias("oee_avg"),
        of(F.avg, "wear_index").alias("wear_avg"),
        of(F.avg, "heat_rate_kj_kwh").alias("heat_rate_avg"),
        of(peak, "turbine_temp_c").alias("temperature_max_c"),
        of(peak, "vibration_mm_s").alias("vibration_max_mm_s"),
        of(F.avg, "flow_m3_s").alias("flow_avg_m3_s"),
        of(F.avg, "rain_mm_h").alias("rain_avg_mm_h"),
        of(F.avg, "capacity_factor").alias("capacity_factor_avg"),
        of(total, "energy_mwh").alias("energy_mwh"),
        of(F.avg, "relative_efficiency").alias("relative_efficiency_avg"),
        counted("is_anomaly", F.col("is_anomaly")).alias("anomaly_count"),
        (none if compat else counted("alert_level", F.col("alert_level") == CRITICAL)).alias(
            "critical_count"
        ),
        (none if compat else counted("status", F.col("status") == MAINTENANCE)).alias(
            "maintenance_count"
        ),
    )
    score = clamp(F.col("oee_avg"), 0.0, 1.0) * 0.5 + clamp(F.col("efficiency_avg"), 0.0, 1.0) * 0.5
    rate = F.try_divide(F.col("critical_count") * F.lit(100.0), F.col("event_count"))
    return grouped.withColumns(
        {
            "health_score": settled_round(score, 4),
            "critical_rate_pct": F.lit(0.0) if compat else F.round(F.coalesce(rate, F.lit(0.0)), 2),
            "window_start": F.lit(now) - F.expr(f"INTERVAL {SNAPSHOT_MINUTES} MINUTES"),
            "window_end": F.lit(now),
            "window_minutes": F.lit(SNAPSHOT_MINUTES),
        }
    )


def source_fallback(kpis: DataFrame, curated: DataFrame, now: datetime | Column) -> DataFrame:
    """KPIs where there are any, else the snapshot; `source` tells which. Both have the columns of
    the KPI table, null where the snapshot knows nothing, and the choice is made when it is read."""
    empty = kpis.select("plant_id").limit(1).agg(F.count(F.lit(1))).scalar() == 0
    snapshot = silver_snapshot(curated.filter(empty), now)
    known = [
        (F.col(f.name) if f.name in snapshot.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in kpis.schema
    ]
    return kpis.withColumn("source", F.lit("kpis")).unionByName(
        snapshot.select(*known).withColumn("source", F.lit("curated"))
    )


# Anomalies --------------------------------------------------------------------------------------


def anomaly_filter(readings: DataFrame, column: str = "is_anomaly") -> DataFrame:
    """Rows flagged as anomaly; a boolean column reaches the table scan as a predicate."""
    if dict(readings.dtypes)[column] == "boolean":
        return readings.filter(F.col(column))
    return readings.filter(is_true(F.col(column)))


def _newest_anomalies(readings: DataFrame, n: int) -> DataFrame:
    return (
        anomaly_filter(readings)
        .orderBy(F.col("event_ts").desc_nulls_last(), "event_id")
        .limit(n)
    )


def top_recent_anomalies(readings: DataFrame, n: int = TOP_ANOMALIES) -> DataFrame:
    shown = project_existing(_newest_anomalies(readings, n), ANOMALY_COLUMNS)
    rounded = {c: F.round(c, 3) for c, kind in shown.dtypes if kind in ("double", "float")}
    return shown.withColumns(
        {"event_time": F.date_format("event_ts", "HH:mm:ss"), **rounded}
    ).drop("event_ts")


def anomaly_level_counts(readings: DataFrame, n: int = TOP_ANOMALIES) -> DataFrame:
    return _newest_anomalies(readings, n).agg(
        F.count_if(F.col("alert_level") == CRITICAL).alias("critical"),
        F.count_if(F.col("alert_level") == ATTENTION).alias("attention"),
    )


def anomaly_scan_coverage(table: DataFrame) -> DataFrame:
    """Rows and files looked at. `table` must be read from files."""
    per_file = table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return per_file.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))


# Plants -----------------------------------------------------------------------------------------


def distinct_plants(readings: DataFrame) -> DataFrame:
    return readings.select("plant_id").dropna().distinct().orderBy("plant_id")


def plant_palette_index(readings: DataFrame, size: int = PALETTE_SIZE) -> DataFrame:
    """Place of each plant in the sorted list, repeated over the palette.

    The list of plants is counted in one task; it is as long as the fleet, whatever the readings."""
    plants = readings.select("plant_id").dropna().distinct()
    place = F.row_number().over(Window.orderBy("plant_id")) - 1
    return plants.select("plant_id", (place % size).cast("int").alias("palette_index"))


def active_plants_filter(readings: DataFrame, plant_ids: list[str]) -> DataFrame:
    return readings.filter(F.col("plant_id").isin(plant_ids))


# Rain and power ---------------------------------------------------------------------------------


def rain_power_regression(kpis: DataFrame, by: list[str] = ()) -> DataFrame:
    """Least squares line of power over rain, from two windows on; the range of rain with it."""
    pairs = kpis.dropna(subset=["rain_avg_mm_h", "power_avg_mw"])
    enough = F.count(F.lit(1)) >= 2
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("windows"),
        F.when(enough, F.regr_slope("power_avg_mw", "rain_avg_mm_h")).alias("slope"),
        F.when(enough, F.regr_intercept("power_avg_mw", "rain_avg_mm_h")).alias("intercept"),
        F.min("rain_avg_mm_h").alias("rain_min"),
        F.max("rain_avg_mm_h").alias("rain_max"),
    )


def trend_line(regression: DataFrame, points: int = TREND_POINTS) -> DataFrame:
    """Evenly spaced points on the regression line, ends included."""
    step = (F.col("rain_max") - F.col("rain_min")) / (points - 1)
    by = [c for c in regression.columns if c == "plant_id"]
    spread = regression.dropna(subset=["slope"]).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    )
    placed = spread.withColumn("rain_mm_h", F.col("rain_min") + F.col("point") * step)
    fitted = F.col("slope") * F.col("rain_mm_h") + F.col("intercept")
    return placed.select(*by, "point", "rain_mm_h", fitted.alias("power_mw"))


# Tables for reading -----------------------------------------------------------------------------


def newest_first(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy(F.col("window_start").desc_nulls_last(), "plant_id")


def kpi_table_view(kpis: DataFrame, n: int = TABLE_ROWS) -> DataFrame:
    """The newest windows, formatted; shares kept in [0, 1] whatever the input holds."""
    shown = project_existing(newest_first(kpis).limit(n), KPI_VIEW_COLUMNS)
    changed = {c: settled_round(F.col(c), 4) for c, kind in shown.dtypes if kind == "double"}
    for name in ("health_score", "oee_avg"):
        if name in shown.columns:
            changed[name] = unit_interval(changed.get(name, F.col(name)))
    if "critical_rate_pct" in shown.columns:
        rate = changed.get("critical_rate_pct", F.col("critical_rate_pct"))
        changed["critical_rate_pct"] = number_or_zero(rate)
    changed["window_start"] = F.date_format("window_start", "HH:mm dd/MM")
    return shown.withColumns(changed)


def project_existing(
    df: DataFrame, columns: list[str], names: dict[str, str] | None = None
) -> DataFrame:
    kept = df.select(*[c for c in columns if c in df.columns])
    return kept.withColumnsRenamed(names or {})


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Tables stacked by column name; a column one of them lacks is null there."""
    stacked = first
    for other in others:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked

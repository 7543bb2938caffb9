"""Event-time KPIs per plant and tumbling window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penstock.functions.numbers import settled_round
from penstock.model import KPI_AGGREGATES, KPI_TABLE
from penstock.settings import LIMITS, Limits

# Metrics by window width, as documented for readers of the KPI tables. Fixed values.
DOCUMENTED_5M = ["power_avg_mw", "power_max_mw", "efficiency_avg"]
DOCUMENTED_1H = [
    "energy_mwh",
    "anomaly_count",
    "maintenance_seconds",
    "critical_rate_pct",
    "temperature_max_c",
    "vibration_max_mm_s",
    "rain_avg_mm_h",
    "flow_avg_m3_s",
]


def _aggregate(kind: str, source: str | None) -> Column:
    if kind == "rows":
        return F.count(F.lit(1))
    if kind == "count_if":
        return F.count_if(F.expr(source))
    return getattr(F, kind)(source)


def _finish(grouped: DataFrame, minutes: int) -> DataFrame:
    rate = F.try_divide(F.col("critical_count") * F.lit(100.0), F.col("event_count"))
    rated = grouped.withColumn("critical_rate_pct", F.round(F.coalesce(rate, F.lit(0.0)), 2))
    calm = 1.0 - F.least(F.lit(1.0), F.col("critical_rate_pct") / 100.0)
    # Weights of the health score
    score = (
        F.col("oee_avg") * 0.40
        + F.col("relative_efficiency_avg") * 0.30
        + (1.0 - F.col("wear_avg")) * 0.20
        + calm * 0.10
    )
    return rated.withColumns(
        {
            "health_score": settled_round(score, 5),
            "window_minutes": F.lit(minutes),
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
        }
    ).select(*KPI_TABLE.names)


def window_kpis(curated: DataFrame, minutes: int) -> DataFrame:
    """All KPIs for one window width. The same code serves a table and a watermarked stream.

    Every aggregate is combined before the shuffle, so what travels is one row per task, plant
    and window however many readings a plant sends.
    """
    grouped = curated.groupBy(
        F.window("event_ts", f"{minutes} minutes"), "plant_id", "plant_name"
    ).agg(*[_aggregate(kind, source).alias(name) for _, name, kind, source in KPI_AGGREGATES])
    return _finish(grouped, minutes)


def partial_kpis(curated: DataFrame, minutes: int) -> DataFrame:
    """KPIs in a form that can be added up: sums, counts, extremes and squared deviations."""
    columns = []
    for _, name, kind, source in KPI_AGGREGATES:
        if kind in ("avg", "stddev"):
            columns += [F.sum(source).alias(f"{name}__sum"), F.count(source).alias(f"{name}__n")]
            if kind == "stddev":
                deviations = F.var_pop(source) * F.count(source)
                columns.append(deviations.alias(f"{name}__squares"))
        else:
            columns.append(_aggregate(kind, source).alias(name))
    grouped = curated.groupBy(
        F.window("event_ts", f"{minutes} minutes"), "plant_id", "plant_name"
    ).agg(*columns)
    return grouped.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")


def merge_kpis(partials: DataFrame, minutes: int) -> DataFrame:
    """KPIs of equal or wider windows out of partial ones, from any number of batches.

    The spread is merged about the mean of the whole window; squares of raw values would lose
    the digits that matter.
    """
    window = F.window("window_start", f"{minutes} minutes")
    keyed = partials.withColumn("window", window)
    group = ["window", "plant_id", "plant_name"]
    whole = Window.partitionBy(*group)
    columns = []
    for _, name, kind, _ in KPI_AGGREGATES:
        total, n = F.col(f"{name}__sum"), F.col(f"{name}__n")
        if kind == "avg":
            columns.append(F.try_divide(F.sum(total), F.sum(n)).alias(name))
        elif kind == "stddev":
            mean = F.sum(total).over(whole) / F.sum(n).over(whole)
            between = F.coalesce(n * F.pow(total / n - F.col("_mean"), 2), F.lit(0.0))
            keyed = keyed.withColumn("_mean", F.when(n > 0, mean))
            keyed = keyed.withColumn("_spread", F.when(n > 0, between))
            squares = F.sum(F.col(f"{name}__squares")) + F.sum("_spread")
            columns.append(F.sqrt(F.try_divide(squares, F.nullif(F.sum(n), F.lit(1)) - 1)).alias(name))
        elif kind in ("min", "max"):
            columns.append(getattr(F, kind)(name).alias(name))
        else:
            columns.append(F.sum(name).alias(name))
    return _finish(keyed.groupBy(*group).agg(*columns), minutes)


def fold(partials: DataFrame, minutes: int, closed_until: Column | None = None) -> DataFrame:
    """KPIs of a width out of stored partial rows; of windows that end by `closed_until` if given."""
    whole = merge_kpis(partials, minutes)
    return whole if closed_until is None else whole.filter(F.col("window_end") <= closed_until)


def alert_breaches(kpis: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Windows above the critical rate or the vibration limit."""
    return kpis.filter(
        (F.col("critical_rate_pct") > limits.critical_rate_pct)
        | (F.col("vibration_max_mm_s") > limits.vibration_critical_mm_s)
    )


def documented_kpis_5m(kpis_5m: DataFrame) -> DataFrame:
    return kpis_5m.select("plant_id", "window_start", *DOCUMENTED_5M)


def documented_kpis_1h(kpis_1h: DataFrame, seconds: DataFrame) -> DataFrame:
    """Hourly metrics with the seconds in maintenance; an hour without any has 0, and an hour of
    maintenance without a reading has the seconds alone."""
    joined = kpis_1h.join(seconds, ["plant_id", "window_start"], "full")
    filled = joined.withColumn(
        "maintenance_seconds", F.coalesce(F.col("maintenance_seconds"), F.lit(0.0))
    )
    return filled.select("plant_id", "window_start", *DOCUMENTED_1H)


def energy_balance(readings: DataFrame, minutes: int) -> DataFrame:
    """Rise of the cumulative energy counter per plant and window."""
    grouped = readings.groupBy(F.window("event_ts", f"{minutes} minutes"), "plant_id").agg(
        (F.max("cumulative_energy_mwh") - F.min("cumulative_energy_mwh")).alias(
            "energy_balance_mwh"
        )
    )
    return grouped.select(
        "plant_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "energy_balance_mwh",
    )

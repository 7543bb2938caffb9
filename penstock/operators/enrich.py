"""Plant attributes and the metrics that need them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.functions import alerts, machine
from penstock.settings import CURVE, LIMITS, EfficiencyCurve, Limits, Settings


def enrich_with_plant(readings: DataFrame, plants: DataFrame, how: str = "left") -> DataFrame:
    """Plant attributes added to the readings; one a reading already has wins over the plant's.

    No broadcast hint: Spark knows the size of the dimension and broadcasts it while it is below
    the session's threshold. Works for a stream joined with a table as well.
    """
    attributes = [c for c in plants.columns if c != "plant_id"]
    given = plants.select("plant_id", *[F.col(c).alias(f"_plant_{c}") for c in attributes])
    joined = readings.join(given, "plant_id", how)
    filled = {
        c: F.coalesce(F.col(c), F.col(f"_plant_{c}"))
        if c in readings.columns
        else F.col(f"_plant_{c}")
        for c in attributes
    }
    return joined.withColumns(filled).drop(*[f"_plant_{c}" for c in attributes])


def flag_unknown_plants(readings: DataFrame, plants: DataFrame) -> DataFrame:
    known = plants.select("plant_id", F.lit(True).alias("_known"))
    joined = readings.join(known, "plant_id", "left")
    return joined.withColumn("plant_known", F.col("_known").isNotNull()).drop("_known")


def unknown_plants(readings: DataFrame, plants: DataFrame) -> DataFrame:
    return readings.join(plants.select("plant_id"), "plant_id", "left_anti")


def derived_metrics(
    df: DataFrame,
    limits: Limits = LIMITS,
    curve: EfficiencyCurve = CURVE,
    settings: Settings = Settings(),
) -> DataFrame:
    """The per-reading metrics, from measurements and plant attributes.

    A column the reading already has is kept where it is not null: this fills in what an event of
    the older generation lacks. `oee` takes full availability; see `history.running_oee`.
    """
    c = F.col
    present = set(df.columns)

    def given_or(name, value):
        return F.coalesce(c(name), value) if name in present else value

    density = given_or("water_density_kg_m3", F.lit(settings.water_density_kg_m3))
    gravity = given_or("gravity_m_s2", F.lit(settings.gravity_m_s2))
    power = c("power_mw")
    full_load = machine.hydraulic_power_mw(
        c("base_efficiency"), density, gravity, c("max_flow_m3_s"), c("head_m")
    )
    metrics = {
        "water_density_kg_m3": density,
        "gravity_m_s2": gravity,
        "capacity_factor": machine.capacity_factor(power, full_load),
        "energy_mwh": machine.incremental_energy_mwh(power, settings.step_seconds),
        "reactive_power_mvar": machine.reactive_power_mvar(power),
        "hydraulic_yield": machine.hydraulic_yield(
            power, density, gravity, c("flow_m3_s"), c("head_m")
        ),
        "heat_rate_kj_kwh": machine.heat_rate(c("efficiency")),
        "wear_index": machine.wear_index(
            c("vibration_mm_s"), c("turbine_temp_c"), c("is_anomaly")
        ),
        "casing_pressure_kpa": machine.casing_pressure_kpa(
            density, gravity, c("head_m"), c("flow_m3_s"), c("max_flow_m3_s")
        ),
        "oee": machine.oee(F.lit(1.0), power, c("installed_mw")),
        "alert_level": alerts.alert_level(
            c("status"),
            c("is_anomaly"),
            c("turbine_temp_c"),
            c("vibration_mm_s"),
            c("efficiency"),
            limits,
        ),
    }
    return df.withColumns(
        {
            name: value
            if name in ("water_density_kg_m3", "gravity_m_s2")
            else given_or(name, value)
            for name, value in metrics.items()
        }
    )


def efficiency_residual(df: DataFrame, curve: EfficiencyCurve = CURVE) -> DataFrame:
    expected = machine.expected_efficiency(
        F.col("flow_m3_s"),
        F.col("max_flow_m3_s"),
        F.col("base_efficiency"),
        F.col("head_m"),
        curve,
    )
    with_curve = df.withColumn("expected_efficiency", expected)
    return with_curve.withColumn(
        "efficiency_residual", F.col("efficiency") - F.col("expected_efficiency")
    )

"""Alert flags and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from penstock.model import ATTENTION, CRITICAL, INFO, MAINTENANCE, NORMAL
from penstock.settings import LIMITS, Limits


def graded(value: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step the value reaches, steps given from the highest down."""
    (least, name), *lower = steps
    label = F.when(value >= least, name)
    for least, name in lower:
        label = label.when(value >= least, name)
    return label.otherwise(otherwise)


def efficiency_band(efficiency: Column) -> Column:
    # Fixed values
    return graded(efficiency, [(0.88, "ALTA"), (0.80, "MEDIA")], "BAIXA")


def temperature_alert(temp_c: Column, limits: Limits = LIMITS) -> Column:
    return graded(
        temp_c,
        [(limits.temperature_critical_c, CRITICAL), (limits.temperature_attention_c, ATTENTION)],
        NORMAL,
    )


def vibration_alert(vibration: Column, limits: Limits = LIMITS) -> Column:
    return graded(
        vibration,
        [(limits.vibration_critical_mm_s, CRITICAL), (limits.vibration_attention_mm_s, ATTENTION)],
        NORMAL,
    )


def wear_alert(wear: Column, limits: Limits = LIMITS) -> Column:
    return graded(wear, [(limits.wear_critical, CRITICAL)], NORMAL)


def or_unknown(value: Column, alert: Column) -> Column:
    """Optional reading of the flags: a missing measurement is UNKNOWN instead of NORMAL."""
    return F.when(value.isNull(), "UNKNOWN").otherwise(alert)


def is_anomaly_critical(is_anomaly: Column, alert_level: Column) -> Column:
    return is_anomaly & (alert_level == CRITICAL)


def power_pct_capacity(capacity_factor: Column) -> Column:
    return F.round(capacity_factor * 100.0, 2)


def alert_level(
    status: Column,
    is_anomaly: Column,
    temp_c: Column,
    vibration: Column,
    efficiency: Column,
    limits: Limits = LIMITS,
) -> Column:
    critical = (
        is_anomaly
        | (temp_c >= limits.temperature_critical_c)
        | (vibration >= limits.vibration_critical_mm_s)
        | (efficiency < limits.efficiency_critical)
    )
    attention = (
        (temp_c >= limits.temperature_attention_c)
        | (vibration >= limits.vibration_attention_mm_s)
        | (efficiency < limits.efficiency_attention)
    )
    return (
        F.when(status == MAINTENANCE, INFO)
        .when(critical, CRITICAL)
        .when(attention, ATTENTION)
        .otherwise(NORMAL)
    )


def oee_below_min(oee: Column, limits: Limits = LIMITS) -> Column:
    return oee < limits.oee_min

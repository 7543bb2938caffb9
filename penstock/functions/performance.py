"""Performance columns of the curated layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
EFFICIENCY_CEILING = 0.97
WATTS_PER_MEGAWATT = 1_000_000


def relative_efficiency(efficiency: Column) -> Column:
    return F.round(efficiency / EFFICIENCY_CEILING, 5)


def apparent_power(power_mw: Column, reactive_mvar: Column) -> Column:
    return F.round(F.sqrt(power_mw * power_mw + reactive_mvar * reactive_mvar), 4)


def power_factor(power_mw: Column, apparent_mva: Column) -> Column:
    """Null for an idle machine."""
    return F.when(apparent_mva > 0, F.round(F.try_divide(power_mw, apparent_mva), 5))


def water_power_mw(density: Column, gravity: Column, flow_m3_s: Column, head_m: Column) -> Column:
    """Power of the falling water before any loss."""
    return density * gravity * flow_m3_s * head_m / WATTS_PER_MEGAWATT


def power_loss(
    density: Column, gravity: Column, flow_m3_s: Column, head_m: Column, efficiency: Column
) -> Column:
    available = water_power_mw(density, gravity, flow_m3_s, head_m)
    return F.round(available * (F.lit(1.0) - efficiency), 4)

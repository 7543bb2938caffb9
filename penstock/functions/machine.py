"""Metrics of one reading, given the plant it belongs to."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from penstock.functions.numbers import at_most, clamp
from penstock.functions.performance import WATTS_PER_MEGAWATT, water_power_mw
from penstock.settings import CURVE, EfficiencyCurve


def hydraulic_power_mw(
    efficiency: Column, density: Column, gravity: Column, flow_m3_s: Column, head_m: Column
) -> Column:
    return F.round(efficiency * density * gravity * flow_m3_s * head_m / WATTS_PER_MEGAWATT, 4)


def capacity_factor(power_mw: Column, full_load_mw: Column, digits: int = 5) -> Column:
    share = F.round(F.try_divide(power_mw, full_load_mw), digits)
    return F.when(full_load_mw > 0, share).otherwise(0.0)


def incremental_energy_mwh(power_mw: Column, step_seconds: int = 1) -> Column:
    return F.round(power_mw * (step_seconds / 3600.0), 6)


def reactive_power_mvar(power_mw: Column, power_factor: float = 0.95) -> Column:
    if not 0 < power_factor < 1:
        return F.lit(0.0)
    return F.round(power_mw * math.tan(math.acos(power_factor)), 4)


def hydraulic_yield(
    power_mw: Column, density: Column, gravity: Column, flow_m3_s: Column, head_m: Column
) -> Column:
    available = water_power_mw(density, gravity, flow_m3_s, head_m)
    share = F.round(at_most(F.try_divide(power_mw, available), 1.0), 5)
    return F.when(available <= 0, 0.0).otherwise(share)


def heat_rate(efficiency: Column) -> Column:
    rate = F.round(F.try_divide(F.lit(3600.0), efficiency), 2)
    return F.when(efficiency <= 0, 0.0).otherwise(rate)


def wear_index(vibration: Column, temp_c: Column, is_anomaly: Column) -> Column:
    # Weights, vibration limit, temperature range and anomaly surcharge
    shaking = at_most(vibration / 4.5, 1.0) * 0.60
    heating = clamp((temp_c - 50.0) / 40.0, 0.0, 1.0) * 0.40
    surcharge = F.when(is_anomaly, 0.15).otherwise(0.0)
    return F.round(at_most(shaking + heating + surcharge, 1.0), 5)


def casing_pressure_kpa(
    density: Column, gravity: Column, head_m: Column, flow_m3_s: Column, max_flow_m3_s: Column
) -> Column:
    load = relative_load(flow_m3_s, max_flow_m3_s)
    return F.round(density * gravity * head_m * load / 1000.0, 2)


def oee(availability: Column, power_mw: Column, installed_mw: Column) -> Column:
    """Availability times load; quality is 1, since a plant makes no rejects."""
    load = at_most(F.try_divide(power_mw, installed_mw), 1.0)
    return F.round(availability * load, 5)


def relative_load(flow_m3_s: Column, max_flow_m3_s: Column) -> Column:
    share = F.try_divide(flow_m3_s, max_flow_m3_s)
    return F.when(max_flow_m3_s > 0, share).otherwise(0.0)


def expected_efficiency(
    flow_m3_s: Column,
    max_flow_m3_s: Column,
    base_efficiency: Column,
    head_m: Column,
    curve: EfficiencyCurve = CURVE,
) -> Column:
    low_head = head_m < curve.low_head_below_m
    optimum = F.when(low_head, curve.low_head_optimum).otherwise(curve.optimum)
    width = F.when(low_head, curve.low_head_width).otherwise(curve.width)
    distance = relative_load(flow_m3_s, max_flow_m3_s) - optimum
    bell = F.exp(-(distance * distance) / width)
    value = (base_efficiency - curve.drop) + bell * curve.gain
    if curve.digits is not None:
        value = F.round(value, curve.digits)
    return clamp(value, curve.floor, curve.ceiling)


def event_key(plant_id: Column, sim_step: Column, event_ts: Column) -> Column:
    return F.concat_ws("-", plant_id, sim_step.cast("string"), F.unix_millis(event_ts))

"""Per-reading formulas against plain arithmetic."""

import math

import pytest
from pyspark.sql import functions as F

from penstock.functions import alerts, machine, numbers
from penstock.settings import CURVE_V2, LIMITS_V2, Settings


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def lit(x):
    return F.lit(x).cast("double")


def test_hydraulic_power(spark):
    got = value(
        spark, machine.hydraulic_power_mw(lit(0.9), lit(1000), lit(9.81), lit(500), lit(100))
    )
    assert got == 441.45


def test_heat_rate(spark):
    assert value(spark, machine.heat_rate(lit(0.93))) == 3870.97
    assert value(spark, machine.heat_rate(lit(0))) == 0.0
    assert value(spark, machine.heat_rate(lit(None))) is None


def test_reactive_power(spark):
    assert value(spark, machine.reactive_power_mvar(lit(100))) == 32.8684
    assert value(spark, machine.reactive_power_mvar(lit(100), 1.0)) == 0.0


def test_hydraulic_yield(spark):
    water = (lit(1000), lit(9.81))
    assert value(spark, machine.hydraulic_yield(lit(10), *water, lit(0), lit(50))) == 0.0
    assert value(spark, machine.hydraulic_yield(lit(1e6), *water, lit(10), lit(50))) == 1.0


@pytest.mark.parametrize(
    ("vibration", "temp", "anomaly", "expected"),
    [(0.0, 50.0, False, 0.0), (4.5, 90.0, True, 1.0), (9.0, 40.0, False, 0.6), (2.25, 70.0, True, 0.65)],
)
def test_wear(spark, vibration, temp, anomaly, expected):
    assert value(spark, machine.wear_index(lit(vibration), lit(temp), F.lit(anomaly))) == expected


def test_wear_of_an_unmeasured_machine_is_unknown(spark):
    assert value(spark, machine.wear_index(lit(2), lit(None), F.lit(False))) is None


def test_capacity_and_pressure_without_plant_data(spark):
    assert value(spark, machine.capacity_factor(lit(5), lit(0))) == 0.0
    water = (lit(1000), lit(9.81), lit(100))
    assert value(spark, machine.casing_pressure_kpa(*water, lit(5), lit(0))) == 0.0
    assert value(spark, machine.casing_pressure_kpa(*water, lit(50), lit(100))) == 490.5


def test_oee_is_capped(spark):
    assert value(spark, machine.oee(lit(0.5), lit(300), lit(100))) == 0.5


@pytest.mark.parametrize("flow", [0.0, 360.0, 500.0])
@pytest.mark.parametrize("head", [15.0, 100.0])
def test_expected_efficiency(spark, flow, head):
    load = flow / 500
    best, width = (0.78, 0.030) if head < 25 else (0.72, 0.025)
    curve = round(0.93 - 0.04 + 0.05 * math.exp(-((load - best) ** 2) / width), 5)
    got = value(spark, machine.expected_efficiency(lit(flow), lit(500), lit(0.93), lit(head)))
    assert got == pytest.approx(min(0.97, max(0.75, curve)), abs=1e-12)
    old = value(
        spark, machine.expected_efficiency(lit(flow), lit(500), lit(0.93), lit(head), CURVE_V2)
    )
    bell = math.exp(-((load - 0.72) ** 2) / 0.025)
    assert old == pytest.approx(min(0.96, max(0.72, 0.93 - 0.05 + 0.06 * bell)), abs=1e-12)


def test_event_key(spark):
    ts = F.lit("2024-05-01 00:00:00.123").cast("timestamp")
    assert value(spark, machine.event_key(F.lit("jirau"), F.lit(7), ts)) == "jirau-7-1714521600123"


@pytest.mark.parametrize(
    ("status", "anomaly", "temp", "vibration", "efficiency", "new", "old"),
    [
        ("MANUTENCAO", True, 90, 9, 0, "INFO", "INFO"),
        ("OPERANDO", True, 50, 1, 0.9, "CRITICO", "CRITICO"),
        ("OPERANDO", False, 79, 1, 0.9, "ATENCAO", "CRITICO"),
        ("OPERANDO", False, 71, 1, 0.9, "NORMAL", "ATENCAO"),
        ("OPERANDO", False, 50, 4.5, 0.9, "CRITICO", "CRITICO"),
        ("OPERANDO", False, 50, 1, 0.825, "ATENCAO", "NORMAL"),
        ("OPERANDO", False, None, 1, 0.9, "NORMAL", "NORMAL"),
        ("OPERANDO", False, None, 3.0, 0.9, "ATENCAO", "ATENCAO"),
    ],
)
def test_alert_level(spark, status, anomaly, temp, vibration, efficiency, new, old):
    columns = (F.lit(status), F.lit(anomaly), lit(temp), lit(vibration), lit(efficiency))
    assert value(spark, alerts.alert_level(*columns)) == new
    assert value(spark, alerts.alert_level(*columns, LIMITS_V2)) == old


def test_optional_unknown(spark):
    flag = alerts.or_unknown(lit(None), alerts.wear_alert(lit(None)))
    assert value(spark, flag) == "UNKNOWN"
    assert value(spark, alerts.oee_below_min(lit(0.69))) is True


@pytest.mark.parametrize(
    ("text", "number", "share"),
    [
        ("0.5", 0.5, 0.5),
        ("x", 0.0, 0.0),
        (None, 0.0, 0.0),
        ("NaN", 0.0, 0.0),
        ("7", 7.0, 1.0),
        ("Infinity", math.inf, 1.0),
        ("-3", -3.0, 0.0),
    ],
)
def test_lenient_numbers(spark, text, number, share):
    assert value(spark, numbers.number_or_zero(F.lit(text))) == number
    assert value(spark, numbers.unit_interval(F.lit(text))) == share


def test_settled_round_ignores_noise(spark):
    assert value(spark, numbers.settled_round(lit(0.12345499999999999), 5)) == 0.12346
    assert value(spark, numbers.settled_round(lit(0.123455), 5)) == 0.12346


def test_label(spark):
    assert value(spark, numbers.plant_label(F.lit("belo_monte"))) == "Belo Monte"


def test_settings_from_environment():
    found = Settings.from_env({"TOPIC": "t", "MAX_OFFSETS_PER_TRIGGER": "9"})
    assert (found.topic, found.max_offsets_per_trigger, found.step_seconds) == ("t", 9, 1)
    with pytest.raises(ValueError):
        Settings.from_env({"STEP_SECONDS": "x"})
